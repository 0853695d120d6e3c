from pyspark.sql import functions as F

from namewright.functions import text as X


def one(spark, col, data=None, schema="s string"):
    df = spark.createDataFrame(data or [("x",)], schema)
    return df.select(col.alias("r")).collect()[0]["r"]


def test_normalize_key(spark):
    assert one(spark, X.normalize_key(F.lit('"Value.Frequency.is":'))) == "ValueFrequencyis"


def test_attr_entry_and_nulls(spark):
    c = X.attr_entry(F.lit("P.is"), F.lit(None).cast("string"), F.lit("s"), F.lit(" "))
    assert one(spark, c) == '"P.is":{fullname:"",shortname:"s",abbr:" "}'


def test_default_abbr(spark):
    df = spark.createDataFrame([(None,), ("",), ("b2",)], "a string")
    got = [r[0] for r in df.select(X.default_abbr("a")).collect()]
    assert got == [" ", " ", "b2"]


def test_nth_position_literal(spark):
    df = spark.createDataFrame([("a.b|a.b|xa.b",), ("none",)], "s string")
    got = [r[0] for r in df.select(X.nth_position("s", "a.b", 2)).collect()]
    assert got == [4, None]
    got3 = [r[0] for r in df.select(X.nth_position("s", "a.b", 3)).collect()]
    assert got3 == [9, None]


def test_rename_nth(spark):
    df = spark.createDataFrame([('"G.is":1,"G.is":2,"G.is":3',), ("x",)], "s string")
    got = [r[0] for r in df.select(X.rename_nth("s", '"G.is":', 2, '"G.is1":')).collect()]
    assert got == ['"G.is":1,"G.is1":2,"G.is":3', "x"]


def test_entry_keys(spark):
    s = '"A.is":{fullname:"a",shortname:"b",abbr:" "},"B.of":{fullname:"c",shortname:"d",abbr:"e"}'
    assert one(spark, X.entry_keys(F.lit(s))) == ["A.is", "B.of"]


def test_clip(spark):
    assert one(spark, X.clip(F.lit("c" * 5000))) == "c" * 4000


def test_messages(spark):
    assert one(spark, F.expr(X.sql_msg_too_long("short", "7", "'n'", 32))) == (
        "Failed to generate short curve name for the curve:7 because its result name n is longer than 32 characters")
    assert one(spark, F.expr(X.sql_msg_duplicate("long", "13", "12"))) == (
        "Failed to generate long curve name for the curve:13 because its result name is same as curve:12")
    assert one(spark, F.expr(X.sql_msg_whole("desc", "3", "'boom'"))) == (
        "Failed to generate descripton for the curve:3 because of exception:boom")
