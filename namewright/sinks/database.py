"""JDBC sinks (SNK2, SNK5): staging rows replaced without loss, status moved in place.

Spark's JDBC writer commits each task on its own, so writing straight into the staging table would show half a run, lose the old rows
when the append fails, and double rows when a task that had committed is run again.  Here the tasks append
to a side table, every row under the run's id and numbered by the database.  When all rows are there, one transaction
deletes the load sets' old rows, inserts the run's rows (the first of each load set and curve: a repeated task's rows come
second) and empties the run's part of the side table.  Readers see the old rows or the new ones, and a run that
fails at any point leaves the old ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIDE_SUFFIX = "_INCOMING"
ROW_NUMBER, RUN_ID = "row_no", "run_id"
_SIZED, _SCALED = (1, 12, -15, -9), (2, 3)   # java.sql.Types: CHAR, VARCHAR, NCHAR, NVARCHAR; NUMERIC, DECIMAL


@contextmanager
def connection(spark: SparkSession, url: str, props: Mapping[str, object] | None = None) -> Iterator:
    """A JDBC connection of the driver, in one transaction: committed at the end, rolled back on an error."""
    jvm, given = spark.sparkContext._jvm, dict(props or {})
    if "driver" in given:
        jvm.java.lang.Class.forName(given["driver"])
    properties = jvm.java.util.Properties()
    for k, v in given.items():
        properties.setProperty(k, str(v))
    made = jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        made.setAutoCommit(False)
        yield made
        made.commit()
    except BaseException:
        made.rollback()
        raise
    finally:
        made.close()


def _quoted(quote: str, names: Iterable[str]) -> str:
    return ", ".join(f"{quote}{n}{quote}" for n in names)


def _execute(made, sql: str, *values) -> int:
    statement = made.prepareStatement(sql)
    try:
        for k, v in enumerate(values, start=1):
            statement.setString(k, v) if isinstance(v, str) else statement.setLong(k, int(v))
        return statement.executeUpdate()
    finally:
        statement.close()


def _column_types(made, table: str, columns: Iterable[str], quote: str) -> dict[str, str]:
    """The types of a table's columns as DDL."""
    columns = list(columns)
    statement = made.prepareStatement(f"SELECT {_quoted(quote, columns)} FROM {table} WHERE 1 = 0")
    try:
        found = statement.executeQuery().getMetaData()
        out = {}
        for k, name in enumerate(columns, start=1):
            kind, code, size, scale = found.getColumnTypeName(k), found.getColumnType(k), found.getPrecision(k), found.getScale(k)
            out[name] = f"{kind}({size})" if code in _SIZED else f"{kind}({size}, {scale})" if code in _SCALED and 0 < size <= 38 else kind
        return out
    finally:
        statement.close()


def ensure_side_table(spark: SparkSession, url: str, table: str, columns: Iterable[str], props: Mapping | None = None, quote: str = '"') -> str:
    """The name of the side table of ``table``, which is made where it does not exist."""
    side = table + SIDE_SUFFIX
    try:
        with connection(spark, url, props) as made:
            _column_types(made, side, [ROW_NUMBER, RUN_ID], quote)
    except Exception:  # noqa: BLE001  it is not there
        with connection(spark, url, props) as made:
            types = _column_types(made, table, columns, quote)
            own = f"{quote}{ROW_NUMBER}{quote} BIGINT GENERATED ALWAYS AS IDENTITY, {quote}{RUN_ID}{quote} VARCHAR(64) NOT NULL"
            _execute(made, f"CREATE TABLE {side} ({own}, " + ", ".join(f"{quote}{c}{quote} {t}" for c, t in types.items()) + ")")
    return side


def append_rows(rows: DataFrame, url: str, side: str, run: str, props: Mapping | None = None, batchsize: int = 1000) -> None:
    """Append rows to the side table under a run's id, one transaction per task."""
    rows.withColumn(RUN_ID, F.lit(run)).write.jdbc(url, side, mode="append", properties={"batchsize": str(batchsize), **{k: str(v) for k, v in (props or {}).items()}})


def swap_in(spark: SparkSession, url: str, table: str, side: str, run: str, columns: Iterable[str], load_set_ids: Iterable[int], key: Iterable[str],
            props: Mapping | None = None, quote: str = '"', expected: int | None = None) -> int:
    """In one transaction: the load sets' old rows out, the run's rows in, its part of the side table empty.  Returns the rows put in;
    if they are not the ``expected`` number, nothing is changed."""
    cols, run_col = _quoted(quote, columns), f"{quote}{RUN_ID}{quote}"
    number = f"{quote}{ROW_NUMBER}{quote}"
    with connection(spark, url, props) as made:
        for k in load_set_ids:
            _execute(made, f"DELETE FROM {table} WHERE {quote}load_set_id{quote} = ?", k)
        first = f"SELECT MIN({number}) FROM {side} WHERE {run_col} = ? GROUP BY {_quoted(quote, key)}"
        put = _execute(made, f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {side} WHERE {number} IN ({first})", run)
        if expected is not None and put != expected:
            raise RuntimeError(f"run {run} has {put} rows in {side}, not {expected}; {table} is left as it was")
        _execute(made, f"DELETE FROM {side} WHERE {run_col} = ?", run)
    return put


def forget_run(spark: SparkSession, url: str, side: str, run: str, props: Mapping | None = None, quote: str = '"') -> None:
    """Remove what a failed run has left in the side table."""
    with connection(spark, url, props) as made:
        _execute(made, f"DELETE FROM {side} WHERE {quote}{RUN_ID}{quote} = ?", run)


def replace_rows(rows: DataFrame, url: str, table: str, load_set_ids: Iterable[int], key: Iterable[str], props: Mapping | None = None, batchsize: int = 1000,
                 quote: str = '"', expected: Callable[[], int] | None = None) -> int:
    """SNK2: replace the load sets' rows of ``table`` by ``rows`` (unique by ``key``), or leave them as they are on any failure."""
    spark, columns, run = rows.sparkSession, rows.columns, uuid.uuid4().hex
    side = ensure_side_table(spark, url, table, columns, props, quote)
    try:
        append_rows(rows, url, side, run, props, batchsize)
        return swap_in(spark, url, table, side, run, columns, sorted(set(load_set_ids)), key, props, quote, expected() if expected else None)
    except BaseException:
        forget_run(spark, url, side, run, props, quote)
        raise


def move_status(spark: SparkSession, url: str, table: str, outcomes: Mapping[int, bool], ready: int, done: int, failed: int, props: Mapping | None = None, quote: str = '"') -> int:
    """SNK5 in the database: load sets whose status is ``ready`` become ``done`` or ``failed``, in one transaction; returns the rows moved."""
    status, load_set = f"{quote}curvename_status_id{quote}", f"{quote}load_set_id{quote}"
    with connection(spark, url, props) as made:
        sql = f"UPDATE {table} SET {status} = ? WHERE {load_set} = ? AND {status} = ?"
        return sum(_execute(made, sql, done if ok else failed, k, ready) for k, ok in sorted(outcomes.items()))
