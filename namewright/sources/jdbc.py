"""JDBC scans (SRC1, SRC2).

A table is named ``jdbc:<url>#<table>``.  A large one is read in ``n_parts`` ranges of
its id, one predicate per partition (``read_ranges``).  The ranges are measured: the
database counts ids per bucket between its least and largest id, buckets that hold too
many rows are counted again in finer buckets, and neighbouring buckets are put together
until a range has its share.  So negative, sparse and clustered ids give even partitions;
only a single id is never split.  The first and last range are open, and rows
without id are read with the first.

``read_jdbc`` with a bucket column is the plain form: ``MOD(id, 1000)`` as an extra column
(``bucket_query``), split by Spark between given bounds.  Credentials come from the
caller's ``props``; nothing is stored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from namewright.sources.tables import BUCKETS

BUCKET = "partition_id"


def split_spec(spec: str) -> tuple[str, str]:
    """``jdbc:<url>#<table>`` as (url, table)."""
    url, mark, table = spec.rpartition("#")
    if not mark or not table:
        raise ValueError(f"{spec!r} names no table: use jdbc:<url>#<table>")
    return url, table


def bucket_query(table: str, columns: Iterable[str], id_col: str, quote: str = '"') -> str:
    """The subquery with the wanted columns and the bucket of ``id_col``."""
    q = lambda c: f"{quote}{c}{quote}"
    return f"(SELECT {', '.join(map(q, columns))}, MOD({q(id_col)}, {BUCKETS}) AS {q(BUCKET)} FROM {table}) bucketed"


def read_jdbc(spark: SparkSession, url: str, query: str, bucket_col: str | None = None,
              n_parts: int = 1, props: dict | None = None, lower: int = 0,
              upper: int = BUCKETS, fetchsize: int = 10000) -> DataFrame:
    """SRC1/SRC2: a (possibly range-partitioned) JDBC table or subquery scan."""
    props = dict(props or {})
    props.setdefault("fetchsize", str(fetchsize))
    if bucket_col is None or n_parts <= 1:
        return spark.read.jdbc(url, query, properties=props)
    return spark.read.jdbc(url, query, column=bucket_col, lowerBound=lower,
                           upperBound=upper, numPartitions=n_parts, properties=props)


# a bucket holding more than this part of a partition's share is counted again
FINE = 4


def _histogram(spark: SparkSession, url: str, table: str, id_col: str, segments: list[tuple[int, int]], props: dict, quote: str) -> list[tuple[int, int, int]]:
    """(first id, id after the last, rows) of the non-empty buckets of each segment [low, high), counted by the database."""
    q = f"{quote}{id_col}{quote}"
    parts, widths = [], []
    for k, (low, high) in enumerate(segments):
        width = -(-(high - low) // BUCKETS)
        widths.append(width)
        parts.append(f"SELECT {k} AS seg, FLOOR(({q} - ({low})) / {width}) AS bucket FROM {table} WHERE {q} >= {low} AND {q} < {high}")
    counted = f"(SELECT seg, bucket, COUNT(*) AS n FROM ({' UNION ALL '.join(parts)}) b GROUP BY seg, bucket) counted"
    out = []
    for seg, bucket, n in spark.read.jdbc(url, counted, properties=props).collect():  # at most BUCKETS rows a segment
        low, high = segments[int(seg)]
        first = low + int(bucket) * widths[int(seg)]
        out.append((first, min(high, first + widths[int(seg)]), int(n)))
    return sorted(out)


def id_ranges(spark: SparkSession, url: str, table: str, id_col: str, n_parts: int, props: dict | None = None, quote: str = '"') -> list[str]:
    """Predicates that cut a table into at most ``n_parts`` ranges of its id with about equally many rows."""
    q, props = f"{quote}{id_col}{quote}", dict(props or {})
    low, high, rows = spark.read.jdbc(url, f"(SELECT MIN({q}) AS low, MAX({q}) AS high, COUNT({q}) AS n FROM {table}) ends", properties=props).first()
    if not rows or n_parts <= 1:
        return ["1 = 1"]
    share = int(rows) / n_parts
    done, todo = [], [(math.floor(low), math.floor(high) + 1)]
    while todo:
        found = _histogram(spark, url, table, id_col, todo, props, quote)
        todo = [(a, b) for a, b, n in found if n > share / FINE and b - a > 1]
        done += [x for x in found if x[:2] not in todo]
    cuts, held = [], 0
    for a, _, n in sorted(done):
        # a range ends where the next bucket would take it further above its share than it now lies below
        if held and held + n - share > share - held and len(cuts) < n_parts - 1:
            cuts.append(a)
            held = 0
        held += n
    if not cuts:
        return ["1 = 1"]
    inner = [f"{q} >= {a} AND {q} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{q} < {cuts[0]} OR {q} IS NULL", *inner, f"{q} >= {cuts[-1]}"]


def read_ranges(spark: SparkSession, url: str, table: str, columns: Iterable[str], id_col: str, n_parts: int, props: dict | None = None, quote: str = '"', fetchsize: int = 10000) -> DataFrame:
    """SRC1/SRC2: the ``columns`` of a large table, a task per measured range of its id."""
    columns, props = list(columns), {"fetchsize": str(fetchsize), **(props or {})}
    predicates = id_ranges(spark, url, table, id_col, n_parts, props, quote)
    query = f"(SELECT {', '.join(f'{quote}{c}{quote}' for c in columns)} FROM {table}) ranged"
    return spark.read.jdbc(url, query, predicates=predicates, properties=props)


def read_bucketed(spark: SparkSession, spec: str, columns: Iterable[str], id_col: str, n_parts: int,
                  props: dict | None = None, quote: str = '"') -> DataFrame:
    """SRC1/SRC2: the ``columns`` of the table ``spec`` in ``n_parts`` partitions."""
    url, table = split_spec(spec)
    return read_ranges(spark, url, table, columns, id_col, n_parts, props, quote)
