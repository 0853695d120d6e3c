"""Catalogue inputs derived from the driver's TPC-H-style tables.

The driver provides ``part supplier lineitem nation ...`` as parquet.  These
builders turn them into the five catalogue tables (parts are curves, their
brand / type / name / size and the nations and suppliers of their line items
are attributes).  ``FIXTURE_SQL`` is the one definition, run by Spark
(``spark.sql`` over the scanned DataFrames) and by the DuckDB oracle, so both
sides start from identical inputs.

Every row of the tables is used; gaps come from nulls, from the choice of the
attribute name or verb, and from ids that match nothing.  Dictionary ids
repeat, values hold markup characters, and load sets 3 to 5 have rules that
fail, are missing or come twice.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from namewright.session import materialized

_SOURCES = ("part", "supplier", "lineitem", "nation")


PARTS_AT_ONCE = 20_000    # a part has a dozen rows of its own


def _spark_sql() -> str:
    """The shared definition with the clauses that Spark writes differently."""
    text = FIXTURE_SQL.replace(_NUMBERED, _SPARK_NUMBERED)
    for duck, own in ((f"n_name, n_name FROM {_PART_NATIONS}\n", f"n_name, n_name FROM {_SPARK_PART_NATIONS}\n"),
                      (f"s_name, s_name FROM {_PART_SUPPLIERS}\n", f"s_name, s_name FROM {_SPARK_PART_SUPPLIERS}\n")):
        text = text.replace(duck, own)
    return text.replace(f"UNION ALL SELECT {_DISTINCT}l_partkey", "UNION ALL SELECT l_partkey")


def _view(spark: SparkSession, sf_dir: str, name: str, deal: bool = False) -> DataFrame:
    """One catalogue view, from the shared definition, in one analysis.

    ``deal``: the parts are dealt out over tasks first, however few files they lie in."""
    text = re.sub(r"\b(" + "|".join(_SOURCES) + r")\b", r"{\1}", _spark_sql())
    text = text.replace("{", "{{").replace("}", "}}")
    text = re.sub(r"\{\{(" + "|".join(_SOURCES) + r")\}\}", r"{\1}", text)
    dfs = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _SOURCES}
    if deal and (tasks := dfs["part"].count() // PARTS_AT_ONCE) > 1:
        dfs["part"] = dfs["part"].repartition(tasks, "p_partkey")
    return spark.sql(f"WITH {text} SELECT * FROM {name}", **dfs)


def object_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "object_meta", deal=True)


def load_set_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "load_set_curve")


def curve_dict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "curve_dict")


def curve_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "curve_name")


# ---------------------------------------------------------------------------
# The naming rules of the fixture load sets.  0-2 work (2 is already done), 3 fails in
# three ways, 4 lacks a rule, 5 has two rows.
# ---------------------------------------------------------------------------
RULES = [
    (0,
     "concat(curve['Provider.is'].fullname,' ',curve['Commodity.is'].fullname,' ',curve['Variable.is'].fullname)",
     "concat(curve['Provider.is'].shortname,' ',curve['Provider.is'].abbr,curve['Provider.is1'].abbr)",
     "concat('Curve of ',var['Commodityis'].fullname,' ',var['Geographyin2'].shortname)",
     1),
    (1,
     "concat(curve['Provider.is'].shortname,' ',curve['Geography.in'].fullname,' ',curve['Geography.in1'].fullname)",
     "concat(curve['Commodity.is'].shortname,' ',curve['Geography.in'].fullname,' ',"
     "curve['Geography.in1'].fullname,' ',curve['Geography.in2'].fullname)",
     "rpad(concat_ws(' ',curve['Variable.is'].fullname,curve['Unit.is'].fullname),4500,'-')",
     1),
    (2,
     "concat(curve['Commodity.is'].fullname,' ',curve['Unit.is'].fullname,' ',curve['Facility.at'].fullname,' ',"
     "curve['Facility.at1'].fullname,' ',curve['Geography.in'].fullname)",
     "concat(curve[concat('Provider','.is1')].shortname,' ',curve['Unit.is'].shortname)",
     "split_part(curve['Facility.at'].fullname,'#',2)",
     2),
    (3, "java_method('java.lang.System','exit',0)", "upper(curve['Provider.is'].fullname,'x')",
     "length(curve['Provider.is'].fullname)", 1),
    (4, "curve['Provider.is'].fullname", None, "curve['Provider.is'].fullname", 1),
    (5, "curve['Provider.is'].fullname", "curve['Provider.is'].shortname", "curve['Provider.is'].fullname", 1),
    (5, "curve['Unit.is'].fullname", "curve['Unit.is'].shortname", "curve['Unit.is'].fullname", 1),
]
RULE_SCHEMA = ("load_set_id int, longname_rule_exp string, shortname_rule_exp string, "
               "desc_rule_exp string, curvename_status_id int")


def curve_rule(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    """The rules control table (one row per load set)."""
    return spark.createDataFrame(RULES, RULE_SCHEMA)


# ---------------------------------------------------------------------------
# Rules over one free text per part (``note_meta``), whose patterns are refused or run on long values.
# ---------------------------------------------------------------------------
_NOTE = "curve['Note.is'].fullname"
PATTERN_RULES = [
    (10, f"regexp_replace({_NOTE},'(a|b)*c','x')", f"regexp_extract({_NOTE},'([a-z]+)',1)", f"regexp_replace({_NOTE},'[aeiou]+','')", 1),
    (11, f"regexp_replace({_NOTE},'(a+)+b','x')", f"regexp_extract({_NOTE},'^([^ ]*) (.*)$',1)", f"case when {_NOTE} like '%a%b%c%' then 'x' end", 1),
    (12, f"regexp_replace({_NOTE},'a*b','x')", f"regexp_extract({_NOTE},'#([A-Z]+)',1)",
     f"replace(replace({_NOTE},'a','aaaaaaaaaaa'),'a','aaaaaaaaaaa')", 1),
    (13, f"regexp_extract({_NOTE},'(?=a)(a)',1)", f"case when {_NOTE} like '%#%' then 'marked' end", f"regexp_replace({_NOTE},'[a-z]+$','')", 1),
    (14, f"regexp_replace({_NOTE},'^(.*)#(.*)$','x')", f"regexp_extract({_NOTE},'^([^#]*)#(.*)$',2)", f"replace({_NOTE},' ',{_NOTE})", 1),
    (15, f"regexp_replace({_NOTE},'a{{2,}}','x')", f"regexp_replace({_NOTE},'(?:green|blue|red)?#','/')", f"regexp_replace({_NOTE},'{'a?' * 14}b','x')", 1),
    (16, f"regexp_replace({_NOTE},'[a-z]{{1,9}}#','*')", f"regexp_extract({_NOTE},'(ab)(ab)?(ab)?',3)", f"regexp_replace({_NOTE},'a.*','')", 1),
    (17, f"regexp_replace({_NOTE},'(a|b|ab)+','x')", f"regexp_extract({_NOTE},'([a-z]*)(#.*)',1)", f"case when {_NOTE} like '%%%%%a' then 'x' end", 1),
]
PATTERN_SQL = """
note_meta AS (
  SELECT p_partkey AS object_id, 1 AS object_type_id, 'Note' AS attribute, 'is' AS verb, CAST(NULL AS STRING) AS ric,
         CAST(1 AS BIGINT) AS element_id, p_brand AS element,
         CASE WHEN p_size > 20 AND p_size % 10 = 0 THEN rpad(p_name || '#' || p_type, 100000, 'ab') ELSE p_name || '#' || p_type END AS element_name
  FROM part
),
note_curve AS (SELECT CAST(10 + p_size % 8 AS INTEGER) AS load_set_id, p_partkey AS curve_id FROM part)"""


PARTS_PER_TASK = 2_000    # a part's note has up to 100,000 characters, its row in the file a hundred


def pattern_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The tables of a naming run whose rules are about patterns.

    The parts are dealt out before their long notes are made, so a task's memory stays the same however many parts there are."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_brand", "p_size", "p_name", "p_type")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), part.count() // PARTS_PER_TASK + 1)
    part = part.repartition(n, "p_partkey")
    text = PATTERN_SQL.replace("FROM part", "FROM {part}")
    meta, members = (spark.sql(f"WITH {text} SELECT * FROM {name}", part=part) for name in ("note_meta", "note_curve"))
    return {"object_meta": meta, "load_set_curve": members, "curve_dict": materialized(curve_dict(spark, sf_dir), "curve_dict"),
            "curve_rule": spark.createDataFrame(PATTERN_RULES, RULE_SCHEMA)}


def all_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "object_meta": object_meta(spark, sf_dir),
        "load_set_curve": load_set_curve(spark, sf_dir),
        "curve_dict": curve_dict(spark, sf_dir),
        "curve_name": curve_name(spark, sf_dir),
        "curve_rule": curve_rule(spark, sf_dir),
    }


# The same derivation as SQL (runs in DuckDB over the driver's views).
# What each part says about itself, as SQL: attribute, verb, element id, element, element name.
_PART_ROWS = [
    ("'Provider'", "'is'", "p_size", "p_brand", "p_brand"),
    ("'Commodity'", "'is'", "100 + p_size", "substring(p_type,1,3)", "p_type"),
    ("CASE WHEN p_size % 13 = 0 THEN 'Variant' ELSE 'Variable' END", "'is'", "200 + p_size", "p_name", "CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_name END"),
    ("'Unit'", "CASE WHEN p_size % 7 = 0 THEN 'was' ELSE 'is' END", "300 + p_size % 4", "'U'", "CASE WHEN p_size % 4 = 0 THEN 'MWh' ELSE 'GJ' END"),
    ("'Color'", "'is'", "400", "'c'", "'ignored'"),
    ("'Timezone'", "'is'", "900", "'s'", "CASE WHEN p_size % 3 = 0 THEN NULL ELSE 'TZ ' || p_name END"),
    ("'Value.Frequency'", "'is'", "901", "'s'", "CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_name || ' daily' END"),
    ("'Status'", "'is'", "902", "'s'", "CASE WHEN p_size % 5 = 0 THEN NULL ELSE 'Active ' || p_name END"),
    ("'Issue.Frequency'", "'is'", "903", "'s'", "CASE WHEN p_size % 6 = 0 THEN NULL ELSE p_name || ' weekly' END"),
    ("'Technology'", "'is'", "904", "'s'", "CASE WHEN p_size % 7 = 0 THEN NULL ELSE '<' || p_name || ' & \"co\">' END"),
    ("'FacilityType'", "'is'", "905", "'s'", "CASE WHEN p_size % 8 = 0 THEN NULL ELSE 'Plant of ' || p_name END"),
    ("'Variable.Specification'", "'is'", "906", "'s'", "CASE WHEN p_size % 9 = 0 THEN NULL ELSE p_name || ' > best' END"),
]


def _of_row(k: int) -> str:
    return "CASE i " + " ".join(f"WHEN {n} THEN {row[k]}" for n, row in enumerate(_PART_ROWS)) + " END"


# One row per part and number 0, 1 ..; the only clause that the two engines write differently.
_NUMBERED = f"(SELECT *, unnest(range({len(_PART_ROWS)})) AS i FROM part) numbered"
_SPARK_NUMBERED = f"(SELECT *, explode(sequence(0, {len(_PART_ROWS) - 1})) AS i FROM part) numbered"

# The nations and the suppliers of a part, each once.  DuckDB tells rows apart by all their texts, Spark by the keys and the name they are
# made of, and before the texts are made (suppliers: before they are joined).
_DISTINCT = "DISTINCT "
_PART_NATIONS = "lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey"
_PART_SUPPLIERS = "lineitem JOIN supplier ON s_suppkey = l_suppkey"
_SPARK_PART_NATIONS = f"(SELECT DISTINCT l_partkey, n_nationkey, n_name FROM {_PART_NATIONS}) part_nations"
_SPARK_PART_SUPPLIERS = """(SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) part_suppliers
         JOIN (SELECT DISTINCT s_suppkey, s_name FROM supplier) suppliers ON s_suppkey = l_suppkey"""

FIXTURE_SQL = f"""
object_meta AS (
  SELECT p_partkey AS object_id, 1 AS object_type_id, {_of_row(0)} AS attribute, {_of_row(1)} AS verb, CAST(NULL AS STRING) AS ric,
         CAST({_of_row(2)} AS BIGINT) AS element_id, {_of_row(3)} AS element, {_of_row(4)} AS element_name
  FROM {_NUMBERED}
  UNION ALL SELECT s_suppkey, 2, 'Provider', 'is', CAST(NULL AS STRING), CAST(500 AS BIGINT), 'S', s_name FROM supplier
  UNION ALL SELECT {_DISTINCT}l_partkey, 1, CASE WHEN (l_partkey + n_nationkey) % 6 = 0 THEN 'Geography' ELSE 'Region' END, 'in',
         CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE 'G' || CAST(n_nationkey AS STRING) END,
         CAST(600 + n_nationkey AS BIGINT), n_name, n_name FROM {_PART_NATIONS}
  UNION ALL SELECT {_DISTINCT}l_partkey, 1, CASE WHEN (l_partkey + s_suppkey) % 9 = 0 THEN 'Facility' ELSE 'Site' END, 'at',
         CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE 'F' || CAST(s_suppkey AS STRING) END,
         CAST(10000 + s_suppkey AS BIGINT), s_name, s_name FROM {_PART_SUPPLIERS}
),
load_set_curve AS (SELECT CAST(p_size % 6 AS INTEGER) AS load_set_id, p_partkey AS curve_id FROM part),
curve_dict AS (
  SELECT DISTINCT CAST(p_size AS BIGINT) AS element_id, CASE WHEN p_size % 2 = 0 THEN 'b' || CAST(p_size AS STRING) END AS abbr FROM part
  UNION ALL SELECT DISTINCT CAST(p_size AS BIGINT), CASE WHEN p_size % 3 = 0 THEN '' ELSE 'alt' END FROM part
  UNION ALL SELECT CAST(600 + n_nationkey AS BIGINT), CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE 'N' || CAST(n_nationkey AS STRING) END FROM nation
),
curve_name AS (
  SELECT CAST(p_size % 6 AS INTEGER) AS load_set_id, CASE WHEN p_partkey % 5 = 0 THEN -1 - p_partkey ELSE p_partkey END AS curve_id,
         p_name || ' ' || p_type AS curve_name, p_brand AS short_curve_name,
         CASE WHEN p_size % 8 = 0 THEN NULL ELSE 'size <' || CAST(p_size AS STRING) || '>' END AS curve_description FROM part
)"""


def rules_values_sql() -> str:
    """``curve_rule`` as a literal VALUES list for the oracle."""
    def q(s: str | None) -> str:
        return "NULL" if s is None else "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({r[0]}, {q(r[1])}, {q(r[2])}, {q(r[3])}, {r[4]})" for r in RULES)
    return (f"curve_rule AS (SELECT * FROM (VALUES {rows}) AS t(load_set_id, longname_rule_exp, "
            "shortname_rule_exp, desc_rule_exp, curvename_status_id))")
