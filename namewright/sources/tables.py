"""Scans, decoding, scope and basic filters (SRC3-7, FLT1-4).

Input tables (any source Spark reads: parquet, catalog tables, JDBC):

  object_meta     object_id, object_type_id, attribute, verb, ric, element_id,
                  element, element_name
  load_set_curve  load_set_id, curve_id
  curve_dict      element_id, abbr
  curve_rule      load_set_id, longname_rule_exp, shortname_rule_exp,
                  desc_rule_exp, curvename_status_id
  curve_name      load_set_id, curve_id, curve_name, short_curve_name,
                  curve_description

Filters are plain ``filter`` calls on scans so Catalyst pushes them into the
parquet reader (or the JDBC query) and prunes columns.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namewright.functions.text import empty_if_null

ALL = "all"
CURVE_TYPE_ID = 1
BUCKETS = 1000
# columns and types of the two large tables
META_COLUMNS = {"object_id": "long", "object_type_id": "int", "attribute": None, "verb": None, "ric": None,
                "element_id": "long", "element": None, "element_name": None}
NAME_COLUMNS = {"load_set_id": "int", "curve_id": "long", "curve_name": None, "short_curve_name": None,
                "curve_description": None}


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """SRC3: a plain scan; the joins and groups run in Spark, not in the source."""
    return spark.read.format(fmt).load(path)


def _decoded(df: DataFrame, columns: dict[str, str | None]) -> DataFrame:
    return df.select(*[F.col(c).cast(kind).alias(c) if kind else F.col(c) for c, kind in columns.items()])


def decode_meta(df: DataFrame) -> DataFrame:
    """SRC7: metadata with integral ids (a DECIMAL(p,0) from JDBC becomes long)."""
    return _decoded(df, META_COLUMNS)


def decode_names(df: DataFrame) -> DataFrame:
    """SRC7: published names with integral ids."""
    return _decoded(df, NAME_COLUMNS)


def with_bucket(df: DataFrame, id_col: str, n: int = BUCKETS, name: str = "partition_id") -> DataFrame:
    """SRC4: ``mod(id, n)``; ``%`` keeps the dividend's sign like Oracle's MOD."""
    return df.withColumn(name, F.col(id_col) % F.lit(n))


def only_curves(meta: DataFrame, type_id: int | None = CURVE_TYPE_ID) -> DataFrame:
    """FLT1: keep one object type (the export job keeps curves, type 1)."""
    if type_id is None:
        return meta
    return meta.filter(F.col("object_type_id") == F.lit(type_id))


def in_load_set(df: DataFrame, load_set_ids) -> DataFrame:
    """FLT2: keep one load set, or several (a list)."""
    if load_set_ids is None or load_set_ids == ALL:
        return df
    if isinstance(load_set_ids, (list, tuple, set, frozenset)):
        return df.filter(F.col("load_set_id").isin(sorted(load_set_ids)))
    return df.filter(F.col("load_set_id") == F.lit(load_set_ids))


def scope(df: DataFrame, load_set_id) -> DataFrame:
    """SRC6: one load set, or the literal ``'all'``."""
    return in_load_set(df, None if load_set_id == ALL else load_set_id)


def null_to_empty(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """FLT3: null to empty string on the named columns."""
    cols = list(cols)
    return df.select(*[empty_if_null(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def read_rules(rules: DataFrame, load_set_ids=None) -> DataFrame:
    """SRC5: the naming rules of the requested load sets (one row expected per set)."""
    return in_load_set(rules, load_set_ids).select(
        F.col("load_set_id").cast("int").alias("load_set_id"),
        "longname_rule_exp", "shortname_rule_exp", "desc_rule_exp",
        F.col("curvename_status_id").cast("int").alias("curvename_status_id"),
    )


def repeated_rule_sets(rules: DataFrame) -> DataFrame:
    """LIM1: load sets with more than one rule row (must be empty)."""
    return rules.groupBy("load_set_id").count().filter(F.col("count") > 1)
