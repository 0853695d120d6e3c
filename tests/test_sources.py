"""Scans and filters: bucket key, scope, load-set filters, decode, rules."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from namewright.sources import jdbc
from namewright.sources import tables as T

from .conftest import meta_row


def test_bucket_keeps_dividend_sign(spark):
    df = spark.createDataFrame([(1234,), (-1234,), (999,)], "object_id long")
    got = [r["partition_id"] for r in T.with_bucket(df, "object_id").collect()]
    assert got == [234, -234, 999]          # like MOD, unlike pmod


def test_scope_and_load_set_filters(spark, tables):
    t = tables([], [(1, 10), (2, 20), (3, 30)], [])
    m = t["members"]
    assert T.scope(m, "all").count() == 3
    assert [r["curve_id"] for r in T.scope(m, 2).collect()] == [20]
    assert sorted(r["curve_id"] for r in T.in_load_set(m, [1, 3]).collect()) == [10, 30]


def test_decode_from_decimal_ids(spark):
    df = spark.createDataFrame(
        [(Decimal("12"), Decimal("1"), "P", "is", None, Decimal("7"), "e", "n")],
        "object_id decimal(38,0), object_type_id decimal(38,0), attribute string, verb string, "
        "ric string, element_id decimal(38,0), element string, element_name string")
    out = T.decode_meta(df)
    assert dict(out.dtypes)["object_id"] == "bigint" and dict(out.dtypes)["element_id"] == "bigint"
    assert out.collect()[0]["object_id"] == 12


def test_only_curves_and_null_to_empty(spark, tables):
    t = tables([meta_row(1, "P", "is", None), meta_row(2, "P", "is", "x", typ=2)], [], [])
    curves = T.only_curves(t["meta"])
    assert [r["object_id"] for r in curves.collect()] == [1]
    row = T.null_to_empty(curves, ["element_name", "ric"]).collect()[0]
    assert row["element_name"] == "" and row["ric"] == ""


DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def _sizes(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


@pytest.mark.parametrize("ids", [
    "id - 5000",                                                             # negative and positive
    "CASE WHEN id < 9000 THEN id * 1000 ELSE -4000000000000 - id * 1000 END",  # one bucket of MOD(id, 1000), two far clusters
    "id * id * id",                                                          # denser and denser towards zero
    "CASE WHEN id % 2 = 0 THEN id ELSE 9000000000000000 + id END",
])
def test_measured_ranges_are_even(spark, ids):
    url = f"jdbc:derby:memory:nwranges{abs(hash(ids))};create=true"
    rows = spark.range(10_000).selectExpr(f"{ids} AS object_id", "concat('n', id) AS element_name")
    rows.write.jdbc(url, "META", mode="overwrite", properties=DERBY)
    got = jdbc.read_bucketed(spark, f"{url}#META", ["object_id", "element_name"], "object_id", 8, DERBY)
    sizes = _sizes(got)
    assert sum(sizes) == 10_000 and len(sizes) == 8 and max(sizes) <= 2 * 10_000 / 8 and min(sizes) >= 10_000 / 16
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))


def test_ranges_of_awkward_tables(spark):
    url = "jdbc:derby:memory:nwawkward;create=true"
    hot = [(7, "x")] * 500 + [(None, "no id")] * 20 + [(k, "y") for k in range(100, 200)]
    for name, rows in (("HOT", hot), ("NO_ROWS", []), ("ONE_ROW", [(3, "z")]), ("NULL_IDS", [(None, "n")] * 5)):
        spark.createDataFrame(rows, "curve_id long, v string").write.jdbc(url, name, mode="overwrite", properties=DERBY)
        got = jdbc.read_bucketed(spark, f"{url}#{name}", ["curve_id", "v"], "curve_id", 4, DERBY)
        assert sorted(map(str, got.collect())) == sorted(str(r) for r in spark.createDataFrame(rows, "curve_id long, v string").collect())
    # one id is never split, the others still are
    assert _sizes(jdbc.read_bucketed(spark, f"{url}#HOT", ["curve_id", "v"], "curve_id", 4, DERBY))[-1] == 520
    decimals = spark.createDataFrame([(Decimal(f"{k}.5"), "d") for k in range(-300, 300)], "curve_id decimal(20,2), v string")
    decimals.write.jdbc(url, "DECIMALS", mode="overwrite", properties=DERBY)
    sizes = _sizes(jdbc.read_bucketed(spark, f"{url}#DECIMALS", ["curve_id", "v"], "curve_id", 4, DERBY))
    assert sum(sizes) == 600 and len(sizes) == 4 and max(sizes) <= 300


def test_repeated_rule_rows_are_reported(spark, tables):
    rule = ("a", "b", "c", 1)
    t = tables([], [], [(1,) + rule, (1,) + rule, (2,) + rule])
    assert [r["load_set_id"] for r in T.repeated_rule_sets(t["rules"]).collect()] == [1]
