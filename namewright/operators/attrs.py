"""Per-curve attribute gathering (JN1-3, STR1, ORD1, AGG1-3).

Plan shape at scale
-------------------
* ``join_dictionary`` comes first and adds the abbreviation by element id.  The
  dictionary's size is not assumed: Spark broadcasts it when it measures it as
  small and shuffles otherwise; a hot element id is then split by AQE.
* When the rules name their keys literally, ``first_entries`` keeps, per object
  and key, only as many entries as the rules can reach.  It is a ``row_number``
  filter, which Spark also applies before the shuffle (window group limit): an
  object or key with a huge share of the rows sends a few rows per map task.
  Every run takes this path; nothing depends on counts taken beforehand.
* ``join_members`` is an equi-join of the reduced rows on the curve id; neither
  side is forced to broadcast.
* A run over named load sets drops other curves' rows first (``maybe_members``): a
  Bloom filter of the members' ids, as a DataFrame of at most 2^FILTER_BITS / 64
  rows of bits, is broadcast to the scan, whatever the number of members.  It lets a
  few other rows through, which the membership join then drops.
* Everything after the membership join is keyed by (load_set_id, curve_id).
  The join's hash partitioning on curve id already satisfies every later
  window and aggregate keyed by a superset of curve id.
* Per-curve lists hold what the rules can read.  Only rules with computed keys
  need a curve's full map, which is one value of one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from namewright.functions.text import attr_entry, attr_key, default_abbr, empty_if_null, normalize_key
from namewright.session import materialized

ENTRY_VALUE = ["fullname", "shortname", "abbr"]


# ---------------------------------------------------------------------------
# joins
# ---------------------------------------------------------------------------
def join_members(meta: DataFrame, members: DataFrame) -> DataFrame:
    """JN1: metadata rows of the curves in each load set (inner, object_id = curve_id).
    A curve in several load sets appears once per load set."""
    m = members.select(F.col("load_set_id").cast("int").alias("load_set_id"),
                       F.col("curve_id").cast("long").alias("curve_id"))
    return meta.join(m, meta["object_id"] == m["curve_id"], "inner").drop("object_id")


def join_dictionary(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """JN2: left outer join to the dictionary on element_id; repeated dictionary
    rows fan out, as an outer join does."""
    d = dictionary.select(F.col("element_id").cast("long").alias("element_id"), "abbr")
    return rows.join(d, "element_id", "left")


def semi_members(meta: DataFrame, members: DataFrame, load_set_id=None, few: bool = False) -> DataFrame:
    """JN3: ``object_id IN (SELECT curve_id FROM members [WHERE load_set_id = x])``.

    For one load set, or ``few`` members, other objects' rows go where the metadata is scanned.  The rest is then
    joined with the distinct ids: a semi join would be moved below that filter by the optimizer."""
    m = members
    if load_set_id is not None and load_set_id != "all":
        m, few = m.filter(F.col("load_set_id") == F.lit(load_set_id)), True
    ids = m.select(F.col("curve_id").cast("long").alias("_member_id"))
    if not few:
        return meta.join(ids, meta["object_id"] == ids["_member_id"], "left_semi")
    kept, ids = maybe_members(meta, m), ids.distinct()
    return kept.join(ids, kept["object_id"] == ids["_member_id"]).select(*meta.columns)


FILTER_BITS = 24     # 262,144 rows of 16 bytes at most; 4 million members let through about a fifth of the others


def member_bits(members: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """A Bloom filter of the members' curve ids with one hash: (word, set bits of these 64 places)."""
    place = F.pmod(F.xxhash64(F.col("curve_id").cast("long")), F.lit(1 << bits)).alias("_place")
    words = members.select(place).selectExpr("shiftright(_place, 6) AS _word", "shiftleft(1L, CAST(_place & 63 AS INT)) AS _bit")
    return words.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))


def maybe_members(meta: DataFrame, members: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The metadata rows whose object may be a member: all of the members' rows and a few others, without a shuffle of ``meta``.

    The broadcast side is bounded by ``bits``, so the hint holds for any number of members."""
    found = F.broadcast(member_bits(members, bits))
    placed = meta.withColumn("_place", F.pmod(F.xxhash64(F.col("object_id").cast("long")), F.lit(1 << bits)))
    kept = placed.withColumn("_word", F.shiftright("_place", 6)).join(found, "_word")
    return kept.filter("shiftrightunsigned(_bits, CAST(_place & 63 AS INT)) & 1 = 1").select(*meta.columns)


# ---------------------------------------------------------------------------
# entries
# ---------------------------------------------------------------------------
def object_entries(meta: DataFrame, dictionary: DataFrame, type_id: int | None = None,
                   attributes: list[str] | None = None) -> DataFrame:
    """Attribute entries per object: raw key ``attribute.verb``
    and the (fullname, shortname, abbr) value, nulls made empty, abbr defaulted.

    ``type_id`` restricts the object type (off by default, as in the staging
    job); ``attributes`` is an optional ``attribute IN (...)`` scan filter."""
    m = meta
    if type_id is not None:
        m = m.filter(F.col("object_type_id") == F.lit(type_id))
    if attributes is not None:
        cond = F.col("attribute").isin(sorted(set(attributes)))
        if "" in attributes:
            cond = cond | F.col("attribute").isNull()
        m = m.filter(cond)
    rows = join_dictionary(m.select("object_id", "attribute", "verb", "element_id", "element", "element_name"), dictionary)
    return rows.select(
        "object_id",
        attr_key("attribute", "verb").alias("key"),
        empty_if_null("element_name").alias("fullname"),
        empty_if_null("element").alias("shortname"),
        default_abbr("abbr").alias("abbr"),
    )


def entries(meta: DataFrame, members: DataFrame, dictionary: DataFrame,
            type_id: int | None = None, attributes: list[str] | None = None) -> DataFrame:
    """Attribute entries per (load_set_id, curve_id)."""
    ent = join_members(object_entries(meta, dictionary, type_id, attributes), members)
    return ent.select("load_set_id", "curve_id", "key", *ENTRY_VALUE)


def first_entries(ent: DataFrame, most: int) -> DataFrame:
    """The first ``most`` entries of every (object, key), in numbering order.  An
    entry among the first of its normalised key is among the first of its raw
    key, so one bound serves both maps."""
    w = Window.partitionBy("object_id", "key").orderBy(*ENTRY_VALUE)
    return ent.select("*", F.row_number().over(w).alias("_rn")).filter(F.col("_rn") <= F.lit(most)).drop("_rn")


def with_entry_text(ent: DataFrame) -> DataFrame:
    """STR1: add the serialised text of each entry."""
    return ent.withColumn("entry", attr_entry("key", "fullname", "shortname", "abbr"))


# an entry with empty parts and a one-character key: no entry text is shorter
SHORTEST_ENTRY = len('".":{fullname:"",shortname:"",abbr:""}')


def attr_string(ent: DataFrame, max_chars: int | None = None) -> DataFrame:
    """AGG1/AGG2: comma-joined entry texts per curve, in entry-text order
    (the reference leaves the order open).  With ``max_chars`` the text is cut
    to that many characters and ``truncated`` says whether it was longer."""
    txt = with_entry_text(ent)
    if max_chars is not None:
        return _attr_prefix(txt, max_chars)
    return txt.groupBy("load_set_id", "curve_id").agg(F.expr("listagg(entry, ',') WITHIN GROUP (ORDER BY entry)").alias("attr"))


def _attr_prefix(txt: DataFrame, max_chars: int) -> DataFrame:
    """The first ``max_chars`` characters of each curve's attribute text, without the text.

    Entries have a least length, so only the first so many of a curve can reach the cut: a row_number filter, which
    Spark also applies before the shuffle, keeps those, and a running length keeps the ones whose comma stands before the cut.  Whether
    there was more comes from partial sums of lengths.  A curve of any size sends a few entries per map task."""
    ids = ["load_set_id", "curve_id"]
    most = max_chars // (SHORTEST_ENTRY + 1) + 1
    by_entry = Window.partitionBy(*ids).orderBy("entry")
    heads = txt.select(*ids, "entry", F.row_number().over(by_entry).alias("_rn")).filter(F.col("_rn") <= F.lit(most))
    before = F.sum(F.length("entry") + F.lit(1)).over(by_entry.rowsBetween(Window.unboundedPreceding, -1))
    heads = heads.select(*ids, "entry", F.coalesce(before, F.lit(0)).alias("_start")).filter(F.col("_start") <= F.lit(max_chars))
    cut = heads.select(*ids, F.left("entry", F.lit(max_chars)).alias("entry"))
    cut = cut.groupBy(*ids).agg(F.expr("listagg(entry, ',') WITHIN GROUP (ORDER BY entry)").alias("attr"))
    total = attr_text_length(txt)
    return cut.join(total, ids).select(*ids, F.left("attr", F.lit(max_chars)).alias("attr"),
                                       (F.col("attr_chars") > F.lit(max_chars)).alias("truncated"))


def attr_text_length(ent: DataFrame) -> DataFrame:
    """Length of the serialised attribute text per curve, from partial sums
    (no list is built): sum of entry lengths plus the separating commas."""
    txt = with_entry_text(ent)
    return txt.groupBy("load_set_id", "curve_id").agg(
        (F.sum(F.length("entry")) + F.count(F.lit(1)) - F.lit(1)).alias("attr_chars"))


# ---------------------------------------------------------------------------
# numbering (ORD1) and maps (AGG3)
# ---------------------------------------------------------------------------
def _numbered(ent: DataFrame, key_col: str, out: str) -> DataFrame:
    """ORD1 numbering only: ``_n`` (0 for the first entry of a key) and the
    numbered key ``out``.  The window's partitioning by (load_set_id, curve_id,
    key) is served by the clustering that the membership join made."""
    by_entry = Window.partitionBy("load_set_id", "curve_id", key_col).orderBy(*ENTRY_VALUE)
    return _with_number(ent.select("*", (F.row_number().over(by_entry) - F.lit(1)).alias("_n")), key_col, out)


def _with_number(ent: DataFrame, key_col: str, out: str) -> DataFrame:
    return ent.select("*", F.expr(f"CASE WHEN _n = 0 THEN {key_col} ELSE concat({key_col}, CAST(_n AS STRING)) END").alias(out))


def _numbered_by_ranges(ent: DataFrame, key_col: str, out: str) -> DataFrame:
    """``_numbered`` in two levels, so that one huge curve, or one key of it, is numbered by many tasks.

    The rows are cut into ranges of (load set, curve, key, value), as many as there are shuffle partitions and about
    equally long whatever the skew.  Each range numbers its own rows of a key; how many rows of that key lie
    in earlier ranges comes from the counts per (key, range), a few rows per key.  The ranges are
    written, since a second evaluation could cut them elsewhere."""
    spark, ids = ent.sparkSession, ["load_set_id", "curve_id", key_col]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialized(ent.repartitionByRange(n, *ids, *ENTRY_VALUE).withColumn("_range", F.spark_partition_id()), "ranges")
    earlier = Window.partitionBy(*ids).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy(*ids, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = counts.select(*ids, "_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")).filter("_before > 0")
    own = Window.partitionBy(*ids, "_range").orderBy(*ENTRY_VALUE)
    rows = ranged.join(before, [*ids, "_range"], "left")
    rows = rows.select(*ent.columns, (F.row_number().over(own) - F.lit(1) + F.coalesce("_before", F.lit(0))).alias("_n"))
    return _with_number(rows, key_col, out)


# curves with more entries are numbered by ranges
HUGE_CURVE = 100_000


def _by_size(ent: DataFrame, huge_curve: int = HUGE_CURVE) -> tuple[DataFrame, DataFrame]:
    """The entries of curves of up to ``huge_curve`` entries, dealt by curve, and those of the others.

    The list of huge curves is at most a ``huge_curve``-th of the entries long, so the hint holds."""
    ids = ["load_set_id", "curve_id"]
    huge = F.broadcast(ent.groupBy(*ids).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > F.lit(huge_curve)).select(*ids))
    return ent.join(huge, ids, "left_anti").repartition(*ids), ent.join(huge, ids, "left_semi")


def _first_of_final(numbered: DataFrame, out: str) -> DataFrame:
    by_final = Window.partitionBy("load_set_id", "curve_id", out).orderBy("_n", *ENTRY_VALUE)
    return numbered.select("*", F.row_number().over(by_final).alias("_rn")).filter("_rn = 1").drop("_rn", "_n")


def number_repeats(ent: DataFrame, key_col: str = "key", out: str = "final_key", sized: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """ORD1 as rows: the 1st entry of a key keeps it, the 2nd becomes ``K1``,
    the 3rd ``K2``; order inside a key is (fullname, shortname, abbr).  One
    entry per (load set, curve, final key) survives, an unnumbered (literal)
    key winning over a numbered one that spells the same text.

    Usual curves are dealt by curve once, which serves both windows; huge ones are cut into ranges."""
    usual, huge = sized or _by_size(ent)
    return _first_of_final(_numbered(usual, key_col, out), out).unionByName(_first_of_final(_numbered_by_ranges(huge, key_col, out), out))


def numbered_keys(ent: DataFrame) -> DataFrame:
    """Rows of the ``curve`` map (raw keys, numbered) and the ``var`` map
    (normalised keys, numbered), one row per map entry.  The entries are read
    several times, so they should be stored."""
    sized = _by_size(ent)
    curve_rows = number_repeats(ent, "key", sized=sized).select(
        "load_set_id", "curve_id", F.lit("curve").alias("map_name"),
        F.col("final_key").alias("map_key"), *ENTRY_VALUE)
    keyed = tuple(part.withColumn("nkey", normalize_key("key")) for part in sized)
    var_rows = number_repeats(ent, "nkey", sized=keyed).select(
        "load_set_id", "curve_id", F.lit("var").alias("map_name"),
        F.col("final_key").alias("map_key"), *ENTRY_VALUE)
    return curve_rows.unionByName(var_rows)


MAP_TYPE = "map<string,struct<fullname:string,shortname:string,abbr:string>>"


def _sorted_entries(key_col: str, keep: Column, n_col: str) -> Column:
    """Aggregate: one curve's kept entries as (final key, repeat number,
    value), sorted, so the first entry of each final key is the one to keep
    (a literal key, number 0, wins over a numbered one spelling the same
    text)."""
    entry = F.struct(F.col(key_col).alias("k"), F.col(n_col).alias("n"),
                     F.struct(*ENTRY_VALUE).alias("v"))
    return F.array_sort(F.collect_list(F.when(keep, entry)))


def _map_from_sorted(col: str) -> Column:
    """Map from a sorted entry list: the first entry of each key only, so
    duplicate keys never reach ``map_from_entries``.  The lambda reads the
    list through its column (O(1) per element), so this is linear."""
    arr = F.col(col)
    firsts = F.filter(arr, lambda x, i: F.when(i == 0, F.lit(True))
                      .otherwise(F.element_at(arr, i)["k"] != x["k"]))
    return F.map_from_entries(F.transform(firsts, lambda x: F.struct(x["k"], x["v"])))


def attribute_maps(meta: DataFrame, members: DataFrame, dictionary: DataFrame,
                   keys=None, type_id: int | None = None,
                   max_attr_chars: int | None = None, few: bool = False) -> DataFrame:
    """AGG3: one row per (load_set_id, curve_id) holding

    * ``curve``: map raw key (numbered) -> struct(fullname, shortname, abbr)
    * ``var``:   map normalised key (numbered) -> the same struct

    Every curve with at least one metadata row in its load set appears.
    ``keys`` (from ``rules.referenced_keys``) restricts the maps to entries the
    rules can read; None keeps all.  Both maps come out of one aggregate over
    the numbered entries, on the partitioning the membership join already made.
    With ``max_attr_chars``, ``attr_too_long`` marks curves whose serialised
    attribute text is wider than that.  ``few`` says that ``members`` are a small part
    of the catalogue: other objects' rows then go where the metadata is scanned."""
    from namewright.operators.rules import entries_needed, key_candidates  # local: avoid a cycle

    restricted = keys is not None and keys.restricted
    need_curve = keys is None or keys.needs_curve
    need_var = keys is None or keys.needs_var
    attributes = keys.attribute_candidates() if restricted and not keys.var_keys else None

    # full maps leave every entry of a curve in, so curves outside the load sets go first
    known = semi_members(meta, members, few=few) if not restricted else maybe_members(meta, members) if few else meta
    ent = object_entries(known, dictionary, type_id, attributes)
    if restricted:
        wanted = F.lit(False)
        if need_curve:
            wanted = wanted | F.col("key").isin(sorted(key_candidates(keys.curve_keys)))
        if need_var:
            wanted = wanted | normalize_key("key").isin(sorted(key_candidates(keys.var_keys)))
        most = max([1, *entries_needed(keys.curve_keys).values(), *entries_needed(keys.var_keys).values()])
        ent = first_entries(ent.filter(wanted), most)
    ent = join_members(ent, members)

    aggs = []
    if need_curve:
        ent = _numbered(ent, "key", "_ckey").withColumnRenamed("_n", "_cn")
        keep = F.col("_ckey").isin(sorted(keys.curve_keys)) if restricted else F.lit(True)
        aggs.append(_sorted_entries("_ckey", keep, "_cn").alias("_curve_entries"))
    if need_var:
        ent = _numbered(ent.select("*", normalize_key("key").alias("_nkey")), "_nkey", "_vkey")
        keep = F.col("_vkey").isin(sorted(keys.var_keys)) if restricted else F.lit(True)
        aggs.append(_sorted_entries("_vkey", keep, "_n").alias("_var_entries"))
    if not aggs:
        aggs.append(F.count(F.lit(1)).alias("_rows"))
    ids = ["load_set_id", "curve_id"]
    maps = ent.groupBy(*ids).agg(*aggs)
    maps = maps.select(
        *ids,
        *([_map_from_sorted("_curve_entries").alias("curve")] if need_curve else []),
        *([_map_from_sorted("_var_entries").alias("var")] if need_var else []))

    if restricted or max_attr_chars is not None:
        # every curve with metadata, also those with no needed entry: distinct
        # object ids first (column-pruned scan, partial aggregation before the
        # shuffle: one row per object and map task), then the membership join
        # on the already-clustered ids
        m = maybe_members(meta, members) if few else meta
        m = m if type_id is None else m.filter(F.col("object_type_id") == F.lit(type_id))
        curves = join_members(m.select("object_id").distinct(), members).distinct()
        if max_attr_chars is not None:
            lengths = attr_text_length(entries(meta, members, dictionary, type_id)).select(
                *ids, (F.col("attr_chars") > F.lit(max_attr_chars)).alias("attr_too_long"))
            curves = curves.join(lengths, ids, "left")
        maps = curves.join(maps, ids, "left")

    empty = F.create_map().cast(MAP_TYPE)
    cols = [*ids,
            (F.coalesce(F.col("curve"), empty) if need_curve else empty).alias("curve"),
            (F.coalesce(F.col("var"), empty) if need_var else empty).alias("var")]
    if max_attr_chars is not None:
        cols.append(F.coalesce(F.col("attr_too_long"), F.lit(False)).alias("attr_too_long"))
    return maps.select(*cols)
