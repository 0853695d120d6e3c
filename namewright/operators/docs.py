"""Search documents (FLT5, AGG4-6, JN4, XML1).

One aggregate per curve builds every element list; the names are joined on
the curve id afterwards, so the names side is the only one shuffled to meet
the aggregate's partitioning (or broadcast, when AQE measures it as small).

Order inside a document, which the reference leaves to arrival order:
single-valued elements by their rank in ``SINGLE_ELEMENTS`` then by value;
pipe lists by (name, code).  Lists are sorted with ``sort_array`` on structs
that end in the emitted values, so equal keys give equal text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namewright.functions.text import empty_if_null, sql_str
from namewright.functions.xml import (PAIR_SEP, PAIRED_ELEMENTS, SINGLE_ELEMENTS, SINGLE_VERB,
                                      sql_doc_open, sql_escape, sql_name_part)
from namewright.operators.attrs import semi_members
from namewright.sources.tables import ALL, CURVE_TYPE_ID, only_curves

def doc_meta(meta: DataFrame, members: DataFrame | None = None, load_set_id=ALL,
             type_id: int = CURVE_TYPE_ID) -> DataFrame:
    """SRC6 + FLT1 + JN3 + FLT3: the export job's metadata rows
    (curve_id, attr, verb, name, code), nulls as empty strings.  For one load
    set, objects are kept by a semi join with that set's members; for
    ``'all'`` every curve-type object is kept."""
    m = only_curves(meta, type_id)
    if load_set_id != ALL:
        m = semi_members(m, members, load_set_id)
    return m.select(
        F.col("object_id").cast("long").alias("curve_id"),
        empty_if_null("attribute").alias("attr"),
        empty_if_null("verb").alias("verb"),
        empty_if_null("element_name").alias("name"),
        empty_if_null("ric").alias("code"),
    )


def _rank_sql() -> str:
    singles = " ".join(
        f"WHEN attr = {sql_str(a)} AND verb = {sql_str(SINGLE_VERB)} THEN {i}"
        for i, (a, _t) in enumerate(SINGLE_ELEMENTS, start=1))
    pairs = " ".join(
        f"WHEN attr = {sql_str(a)} THEN {j}"
        for j, (a, _n, _c) in enumerate(PAIRED_ELEMENTS, start=len(SINGLE_ELEMENTS) + 1))
    return f"CASE WHEN name = '' THEN CAST(NULL AS INT) {singles} {pairs} END"


def element_rank() -> Column:
    """FLT5: rank 1..11 for single-valued elements (verb ``is``), 12 for
    Geography and 13 for Facility (any verb); null when the row is not
    exported.  Case-sensitive, empty names never exported."""
    return F.expr(_rank_sql())


def _tag_sql() -> str:
    return "CASE rank " + " ".join(
        f"WHEN {i} THEN {sql_str(t)}" for i, (_a, t) in enumerate(SINGLE_ELEMENTS, start=1)) + " END"


def select_doc_attrs(dm: DataFrame) -> DataFrame:
    """FLT5 as rows: the exported metadata rows with their rank."""
    return dm.select("*", element_rank().alias("rank")).filter(F.col("rank").isNotNull())


def curve_elements(dm: DataFrame, mode: str = "reference", bundles: int | None = None) -> DataFrame:
    """AGG4-6 in one aggregate per curve: ``n_rows`` (metadata size),
    ``singles`` (concatenated single-valued elements, AGG5), and for each
    paired element a sorted list of (name, code) structs (AGG6).  Every curve
    with metadata gets a row, even when nothing is exported.

    With ``bundles`` the rows are clustered into that many hash partitions of
    the curve id for the aggregate (one bundle per partition).  Rows that are
    not exported only count, so they cross that shuffle as an id and nulls."""
    ranked = _ranked(dm)
    if bundles is not None:
        ranked = ranked.repartition(bundles, "curve_id")
    return ranked.groupBy("curve_id").agg(F.expr("count(1) AS n_rows"), *_list_aggs(mode))


def _ranked(dm: DataFrame) -> DataFrame:
    """Every metadata row with its element's rank; the texts only of rows that are exported."""
    return dm.select("curve_id", "name", "code", element_rank().alias("rank")).selectExpr(
        "curve_id", "rank", "CASE WHEN rank IS NOT NULL THEN name END AS name",
        "CASE WHEN rank IS NOT NULL THEN code END AS code")


def _list_aggs(mode: str) -> list[Column]:
    """The aggregates of one curve's element lists."""
    val = sql_escape("name") if mode == "clean" else "name"
    tag = _tag_sql()
    xml = f"concat('<', {tag}, '>', {val}, '</', {tag}, '>')"
    aggs = [f"array_join(transform(sort_array(collect_list(CASE WHEN rank <= {len(SINGLE_ELEMENTS)} "
            f"THEN struct(rank, name, {xml} AS xml) END)), s -> s.xml), '') AS singles"]
    for j, (a, _n, _c) in enumerate(PAIRED_ELEMENTS, start=len(SINGLE_ELEMENTS) + 1):
        aggs.append(f"sort_array(collect_list(CASE WHEN rank = {j} THEN struct(name, code) END)) "
                    f"AS _pairs_{a}")
    return [F.expr(x) for x in aggs]


def _paired_sql(pairs: str, names_tag: str, codes_tag: str, escape: bool) -> str:
    n = sql_escape("p.name") if escape else "p.name"
    c = sql_escape("p.code") if escape else "p.code"
    return (f"CASE WHEN size({pairs}) > 0 THEN concat("
            f"{sql_str('<' + names_tag + '>')}, array_join(transform({pairs}, p -> {n}), {sql_str(PAIR_SEP)}), "
            f"{sql_str('</' + names_tag + '><' + codes_tag + '>')}, "
            f"array_join(transform({pairs}, p -> {c}), {sql_str(PAIR_SEP)}), {sql_str('</' + codes_tag + '>')}) "
            f"ELSE '' END")


def join_names(elements: DataFrame, names: DataFrame) -> DataFrame:
    """JN4: left outer join on curve_id.  A curve without names still gets a
    document; a name without metadata gets none; several name rows give
    several documents."""
    n = names.select(F.col("curve_id").cast("long").alias("curve_id"),
                     F.lit(True).alias("has_name"),
                     "curve_name", "short_curve_name", "curve_description")
    return elements.join(n, "curve_id", "left")


def render_doc(mode: str = "reference") -> Column:
    """XML1: the whole document from ``curve_elements`` joined with names."""
    escape = mode == "clean"
    names = (f"CASE WHEN has_name THEN concat('<name>', {sql_name_part('curve_name', mode)}, "
             f"'</name><shortname>', {sql_name_part('short_curve_name', mode)}, "
             f"'</shortname><description>', {sql_name_part('curve_description', mode)}, "
             f"'</description>') ELSE '' END")
    parts = [sql_doc_open("curve_id", mode), names, "singles"]
    parts += [_paired_sql(f"_pairs_{a}", ntag, ctag, escape) for a, ntag, ctag in PAIRED_ELEMENTS]
    parts.append(sql_str("</DOC>"))
    return F.expr("concat(" + ", ".join(parts) + ")")


def curve_docs(meta: DataFrame, members: DataFrame | None, names: DataFrame,
               load_set_id=ALL, mode: str = "reference", bundles: int | None = None) -> DataFrame:
    """JOB2 body: (curve_id, doc), one row per curve and name row.

    With ``bundles`` the metadata rows are clustered into that many hash
    partitions of the curve id before the per-curve aggregate (this is the
    aggregate's shuffle, not an extra one); the names are shuffled to match,
    so each output partition is one bundle of documents."""
    dm = doc_meta(meta, members, load_set_id)
    el = curve_elements(dm, mode, bundles)
    nm = names if load_set_id == ALL else names.filter(F.col("load_set_id") == F.lit(load_set_id))
    j = join_names(el, nm)
    return j.select("curve_id", render_doc(mode).alias("doc"))


# Fixed values of the bundles' spread: a prime below which ids are taken, and an odd multiplier.
SPREAD_PRIME, SPREAD_FACTOR, SPREAD_SHIFT = 1_000_003, 2_654_435_761, 12


def bundle_of(curve_id: str, n: int) -> Column:
    """Bundle 0 .. n - 1 of a curve: spread by multiplication, so that dense, sparse and clustered ids all fill the bundles evenly."""
    spread = F.pmod(F.col(curve_id), F.lit(SPREAD_PRIME)) * F.lit(SPREAD_FACTOR)
    return (F.shiftright(spread, SPREAD_SHIFT) % F.lit(n)).cast("int")


def bundled_docs(meta: DataFrame, members: DataFrame | None, names: DataFrame, bundles: int,
                 load_set_id=ALL, mode: str = "reference") -> DataFrame:
    """JOB2 body for the export: (bundle, curve_id, doc), partition k holding bundle k.

    Metadata and names meet in the one aggregate per curve (JN4 without a join: a curve's name rows are a list of
    its group, opened again afterwards), so both are shuffled once, to their bundle, and the documents never."""
    ranked = _ranked(doc_meta(meta, members, load_set_id))
    nm = names if load_set_id == ALL else names.filter(F.col("load_set_id") == F.lit(load_set_id))
    published = nm.select(F.col("curve_id").cast("long").alias("curve_id"), F.struct("curve_name", "short_curve_name", "curve_description").alias("published"))
    rows = ranked.withColumn("own", F.lit(True)).unionByName(published.withColumn("own", F.lit(False)), allowMissingColumns=True)
    rows = rows.withColumn("bundle", F.coalesce(bundle_of("curve_id", bundles), F.lit(0))).repartitionById(bundles, F.col("bundle"))
    el = rows.groupBy("bundle", "curve_id").agg(F.count_if("own").alias("n_rows"), *_list_aggs(mode), F.sort_array(F.collect_list("published")).alias("published"))
    el = el.filter("n_rows > 0").withColumn("published", F.explode_outer("published"))
    named = el.select("*", F.col("published").isNotNull().alias("has_name"), "published.*")
    return named.select("bundle", "curve_id", render_doc(mode).alias("doc"))
