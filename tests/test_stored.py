"""The naming queries at size: what they read several times is written once, long texts are dealt out before they are made."""

import re

import pytest
from pyspark.sql import functions as F

from namewright.operators import attrs as A
from namewright.operators import quality as Q
from namewright.plans import jobs
from namewright.plans import registry as R
from namewright.sources import fixture_views as fv

ENTRIES = "load_set_id int, curve_id long, key string, fullname string, shortname string, abbr string"


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A few dozen parts of every size, some with equal names, as the driver's tables."""
    at = str(tmp_path_factory.mktemp("small"))
    spark.range(1, 121).selectExpr(
        "id AS p_partkey", "concat('part ', id % 40) AS p_name", "concat('Brand#', id % 3) AS p_brand", "concat('TYPE ', id % 4) AS p_type",
        "CAST(id % 50 + 1 AS INT) AS p_size").write.parquet(f"{at}/part.parquet")
    spark.range(1, 13).selectExpr("id AS s_suppkey", "concat('Supplier#', id) AS s_name", "CAST(id % 5 AS INT) AS s_nationkey").write.parquet(f"{at}/supplier.parquet")
    spark.range(0, 900).selectExpr("id % 120 + 1 AS l_partkey", "id % 12 + 1 AS l_suppkey").write.parquet(f"{at}/lineitem.parquet")
    spark.range(0, 5).selectExpr("CAST(id AS INT) AS n_nationkey", "concat('NATION ', id) AS n_name").write.parquet(f"{at}/nation.parquet")
    return at


def rows(df):
    return sorted(map(repr, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_from(df):
    return {re.sub(r".*/namewright/([a-z_]+)-.*", r"\1", f) for f in df.inputFiles()}


def test_staging_table_keeps_every_load_set(spark, small):
    v = fv.all_views(spark, small)
    staged = jobs.stage_names(v["object_meta"], v["load_set_curve"], v["curve_dict"], v["curve_rule"])
    found = R.q_staging_table(spark, small)
    assert {r[0] for r in found.select("load_set_id").distinct().collect()} == {0, 1, 2, 3}
    assert rows(found.select(staged.columns)) == rows(staged)


@pytest.mark.parametrize("name", ["dup_long", "staged_names", "staged_names_skew", "staged_names_colocated", "load_set_report"])
def test_duplicate_searches_read_stored_flags(spark, small, name):
    assert read_from(R.QUERIES[name](spark, small)) == {"flags"}


def test_status_after_reads_stored_flags(spark, small):
    assert "flags" in read_from(R.q_status_after(spark, small)) and "lineitem" not in plan(R.q_status_after(spark, small))


def test_attr_map_rows_reads_the_stored_metadata_and_builds_the_maps_once(spark, small):
    found = R.q_attr_map_rows(spark, small)
    assert read_from(found) == {"object_meta", "load_set_curve", "curve_dict"}
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("map_from_entries") == 2
    v = fv.all_views(spark, small)
    assert rows(found) == rows(A.numbered_keys(A.entries(v["object_meta"], v["load_set_curve"], v["curve_dict"])).select(found.columns))


def test_numbered_keys_reads_stored_entries(spark, small):
    assert read_from(R.q_numbered_keys(spark, small)) <= {"entries", "ranges"}


def test_usual_and_huge_curves_are_numbered_alike(spark):
    data = [(k % 2, k % 3 if k % 4 else 9, ("K.is", "K.is1", "G.in")[k % 3], "abc"[k % 3] * (k % 5), "s" * (k % 2), " ") for k in range(300)]
    data += [(None, 9, "K.is", str(k), "", " ") for k in range(60)]
    ent = spark.createDataFrame(data, ENTRIES)
    usual, huge = A._by_size(ent, 50)
    assert usual.count() + huge.count() == len(data) and huge.count() > 0
    one = A.number_repeats(ent, sized=A._by_size(ent, 50))
    assert rows(one) == rows(A.number_repeats(ent))


def test_rule_failures_are_told_by_the_errors_alone(spark, small):
    views = fv.pattern_views(spark, small)
    named = R._named(views)
    found = Q.rule_failures(named)
    failed = "long_reason = 'rule_error' OR short_reason = 'rule_error' OR desc_reason = 'rule_error'"
    assert rows(found) == rows(Q.length_flags(named).where(failed)) and 0 < found.count() < named.count()
    # no pattern is run to tell whether a row is kept
    filters = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if " Filter " in f" {line} "]
    assert filters and not any("regexp" in line for line in filters)
    assert {r["load_set_id"] for r in R.q_rule_failures(spark, small).select("load_set_id").distinct().collect()} == {3, 10, 11, 12, 13, 14, 15, 17}


def test_parts_are_dealt_out_before_their_notes(spark, small, monkeypatch):
    monkeypatch.setattr(fv, "PARTS_PER_TASK", 10)
    views = fv.pattern_views(spark, small)
    assert views["object_meta"].rdd.getNumPartitions() == 13
    assert R.q_rule_patterns(spark, small).count() == 120
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    assert spark.conf.get(key) == "true"


def test_parts_are_dealt_out_before_their_rows(spark, small, monkeypatch):
    before = rows(fv.object_meta(spark, small))
    monkeypatch.setattr(fv, "PARTS_AT_ONCE", 10)
    dealt = fv.object_meta(spark, small)
    own = [r["count"] for r in dealt.filter("verb NOT IN ('in', 'at') AND object_type_id = 1").groupBy(F.spark_partition_id()).count().collect()]
    assert len(own) > 6 and max(own) < 120 * 12 / 3
    assert rows(dealt) == before


def test_metadata_of_repeated_and_missing_keys_is_that_of_the_definition(spark, tmp_path):
    tables = {
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int", [(1, "a", "b", "c", 20), (1, "a", "b", "c", 20), (2, None, None, None, None)]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int", [(5, "s", 1), (5, "s", 2), (5, "t", 1), (6, None, None), (6, "u", 1), (None, "v", 1)]),
        "nation": ("n_nationkey int, n_name string", [(1, "N"), (1, "N"), (1, "M"), (2, None)]),
        "lineitem": ("l_partkey long, l_suppkey long", [(1, 5), (1, 5), (2, 6), (None, 6), (1, None), (1, 7)]),
    }
    for name, (schema, data) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    text = fv.FIXTURE_SQL.replace(fv._NUMBERED, fv._SPARK_NUMBERED)
    for name in tables:
        spark.read.parquet(f"{tmp_path}/{name}.parquet").createOrReplaceTempView(name)
    want = spark.sql(f"WITH {text} SELECT * FROM object_meta")
    assert rows(fv.object_meta(spark, str(tmp_path))) == rows(want)
    for name in tables:
        spark.catalog.dropTempView(name)
