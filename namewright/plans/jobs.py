"""The two jobs and the run report (JOB1, JOB2, RPT1).

JOB1 ``stage_names``: SRC5 > RUL5 > JN1 > JN2 > ORD1 > AGG3 > RUL1 > STR6 >
DUP1 (long, short) > JN5 > PRJ2 > STR8, for any number of load sets in one
pass.  JOB2 ``build_docs``: SRC6 > FLT1 > JN3 > FLT3 > FLT5 > AGG4-6 > JN4 >
XML1.  Both return DataFrames; ``run_staging`` / ``run_export`` write them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from namewright.functions.text import LONG_NAME_MAX, SHORT_NAME_MAX
from namewright.operators import quality
from namewright.operators.attrs import attribute_maps
from namewright.operators.docs import bundled_docs, curve_docs
from namewright.operators.rules import KINDS, KeyUse, RuleSet, apply_rules, collect_rules, referenced_keys
from namewright.session import materialized
from namewright.sinks import writers
from namewright.sources.jdbc import split_spec
from namewright.sources.tables import ALL, in_load_set


@dataclass
class StagingRun:
    checked: DataFrame          # flags, reasons and texts per (load set, curve)
    staged: DataFrame           # rows of the staging table
    flags: DataFrame            # per (load set, curve), before the duplicate search
    rule_sets: list[RuleSet]    # with per-load-set errors (RUL5)
    persisted: list = None      # DataFrames to unpersist when the run is written
    metrics: dict = None        # whole-run counts observed during the staging write

    def release(self) -> None:
        for df in self.persisted or []:
            df.unpersist()
        self.persisted = []

    @property
    def failed_load_sets(self) -> list[int]:
        return [r.load_set_id for r in self.rule_sets if r.error is not None]

    @property
    def good_load_sets(self) -> list[int]:
        return [r.load_set_id for r in self.rule_sets if r.error is None]


# distinct rule texts compiled into one projection; beyond this, load sets are
# evaluated in several projections so no generated method grows without bound
MAX_TEXTS_PER_PASS = 64


def rule_chunks(rule_sets: list[RuleSet], max_texts: int = MAX_TEXTS_PER_PASS) -> list[list[RuleSet]]:
    """Split the usable rule sets into projections of at most ``max_texts`` distinct
    texts per kind; load sets sharing all three texts stay together."""
    good = sorted((r for r in rule_sets if r.error is None),
                  key=lambda r: (tuple(r.texts[k] for k in KINDS), r.load_set_id))
    chunks: list[list[RuleSet]] = []
    cur: list[RuleSet] = []
    texts = {k: set() for k in KINDS}
    for r in good:
        grown = {k: texts[k] | {r.texts[k]} for k in KINDS}
        if cur and any(len(v) > max_texts for v in grown.values()):
            chunks.append(cur)
            cur, grown = [], {k: {r.texts[k]} for k in KINDS}
        cur.append(r)
        texts = grown
    if cur:
        chunks.append(cur)
    return chunks


def by_key_use(rule_sets: list[RuleSet], restrict_keys: bool) -> list[tuple[list[RuleSet], KeyUse | None]]:
    """The usable rule sets whose keys are all literal, with those keys, and the
    others (a computed key needs the full maps of its own load set only)."""
    literal, computed = [], []
    for r in rule_sets:
        if r.error is None:
            own = referenced_keys(list(r.texts.values())).restricted and restrict_keys
            (literal if own else computed).append(r)
    parts = [(literal, referenced_keys([t for r in literal for t in r.texts.values()]))] if literal else []
    return parts + ([(computed, None)] if computed else [])


def named_curves(meta: DataFrame, members: DataFrame, dictionary: DataFrame,
                 rule_sets: list[RuleSet], type_id: int | None = None,
                 max_attr_chars: int | None = None, restrict_keys: bool = True,
                 max_texts: int = MAX_TEXTS_PER_PASS, persisted: list | None = None,
                 few: bool = False) -> DataFrame:
    """RUL1-4 over the attribute maps: (load_set_id, curve_id, <kind>_value,
    <kind>_error ...) for the load sets with usable rules.

    Load sets with literal keys share pruned maps; those with a computed key get
    full maps of their own.  With more than ``max_texts`` distinct rule texts the
    maps are evaluated in several projections over disjoint load sets; with
    ``persisted`` (a list the caller releases) these read one persisted copy of
    the maps, otherwise each projection builds its own.  ``few``: the load sets are
    a small part of the catalogue (``attrs.maybe_members``)."""
    parts = []
    for sets, keys in by_key_use(rule_sets, restrict_keys) or [([], None)]:
        m = in_load_set(members, [r.load_set_id for r in sets])
        attrs = attribute_maps(meta, m, dictionary, keys=keys, type_id=type_id, max_attr_chars=max_attr_chars,
                               few=few)
        chunks = rule_chunks(sets, max_texts) or [[]]
        if len(chunks) > 1 and persisted is not None:
            attrs = attrs.persist(StorageLevel.MEMORY_AND_DISK)
            persisted.append(attrs)
        parts += [apply_rules(attrs, chunk) for chunk in chunks]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stage(meta: DataFrame, members: DataFrame, dictionary: DataFrame, rules: DataFrame,
          load_set_ids=None, long_max: int = LONG_NAME_MAX, short_max: int = SHORT_NAME_MAX,
          type_id: int | None = None, max_attr_chars: int | None = None,
          restrict_keys: bool = True, persist: bool = False, stored: bool = False) -> StagingRun:
    """JOB1 with everything the callers need (checked rows, staged rows, rules).

    With named load sets the other curves' rows go where the metadata is scanned, so
    a run over one of thousands of sets shuffles that set's rows.

    ``persist`` (MAT1) keeps the per-curve naming result (MEMORY_AND_DISK) so
    the three branches that read it (staged rows, long owners, short owners)
    share one computation; call ``run.release()`` after writing.  ``stored`` writes it
    into the shared folder instead, for results that are read after this call."""
    every = load_set_ids is None or load_set_ids == ALL
    rule_sets = collect_rules(rules, None if every else load_set_ids)
    kept = []
    named = named_curves(meta, members, dictionary, rule_sets, type_id, max_attr_chars, restrict_keys,
                         persisted=kept if persist else None, few=not every)
    flags = quality.length_flags(named, long_max, short_max)
    if persist:
        flags = flags.persist(StorageLevel.MEMORY_AND_DISK)
        kept.append(flags)
    elif stored:
        flags = materialized(flags, "flags")
    checked = quality.checked_names(named, long_max, short_max, flags=flags)
    return StagingRun(checked, quality.staged_rows(checked), flags, rule_sets, kept)


def stage_names(meta: DataFrame, members: DataFrame, dictionary: DataFrame, rules: DataFrame,
                load_set_ids=None, long_max: int = LONG_NAME_MAX, short_max: int = SHORT_NAME_MAX,
                type_id: int | None = None, max_attr_chars: int | None = None, stored: bool = False) -> DataFrame:
    """JOB1: staging rows (curve_id, curve_name, short_curve_name,
    curve_description, load_set_id, is_valid) for the requested load sets
    (None or 'all': every load set in ``rules``)."""
    return stage(meta, members, dictionary, rules, load_set_ids, long_max, short_max,
                 type_id, max_attr_chars, stored=stored).staged


def load_set_report(checked: DataFrame) -> DataFrame:
    """RPT1: counts per load set, by outcome, in one aggregate."""
    def n(cond):
        return F.count_if(cond)
    aggs = [F.count(F.lit(1)).alias("curves")]
    for kind in ("long", "short"):
        r = F.col(f"{kind}_reason")
        aggs += [n(r.isNull()).alias(f"{kind}_valid"),
                 n(r == quality.NO_VALUE).alias(f"{kind}_no_value"),
                 n(r == quality.RULE_ERROR).alias(f"{kind}_rule_error"),
                 n(r == quality.TOO_LONG).alias(f"{kind}_too_long"),
                 n(r == quality.DUPLICATE).alias(f"{kind}_duplicate")]
    aggs += [n(F.col("desc_reason").isNotNull()).alias("desc_failed"),
             n(F.col("long_ok") & F.col("short_ok")).alias("valid_y")]
    return checked.groupBy("load_set_id").agg(*aggs)


def run_outcomes(spark, run: StagingRun) -> DataFrame:
    """(load_set_id, succeeded) for every load set the run looked at."""
    rows = [(r.load_set_id, r.error is None) for r in run.rule_sets]
    return spark.createDataFrame(rows, "load_set_id int, succeeded boolean")


def outcome_map(run: StagingRun) -> dict:
    """{load_set_id: succeeded}; bounded by the number of load sets."""
    return {r.load_set_id: r.error is None for r in run.rule_sets}


def run_staging(meta: DataFrame, members: DataFrame, dictionary: DataFrame, rules: DataFrame,
                staging_path: str, status_path: str, load_set_ids=None,
                report_path: str | None = None, jdbc_props: dict | None = None, jdbc_quote: str = '"', **kw) -> StagingRun:
    """JOB1 end to end: staging rows replaced per load set, the optional run
    report (RPT1), then the status snapshot last.  The per-curve naming
    result is persisted (MAT1, MEMORY_AND_DISK) for the duration, so the
    staging write, its duplicate searches and the report all read one
    computation; a lost executor only costs a recompute of its blocks.  A run
    that fails leaves the staged rows as they were (in a JDBC table too: its rows
    are swapped in by one transaction), moves its load sets to -1 and raises.
    ``staging_path`` and ``status_path`` may be ``jdbc:<url>#<table>``; a rules
    table's status is then moved in place, where it still is 1."""
    kw.setdefault("persist", True)
    run = stage(meta, members, dictionary, rules, load_set_ids, **kw)
    # RPT1 totals ride along with the write (no extra job)
    obs = Observation("staging")
    observed = run.staged.observe(obs, F.count(F.lit(1)).alias("rows"),
                                  F.count_if(F.col("is_valid") == "Y").alias("valid_y"))
    try:
        present = [r[0] for r in run.flags.select("load_set_id").distinct().collect()]
        if staging_path.startswith("jdbc:"):
            url, table = split_spec(staging_path)
            writers.write_staging_jdbc(observed, url, table, jdbc_props, processed_load_sets=run.good_load_sets,
                                       quote=jdbc_quote, expected=lambda: obs.get["rows"])
        else:
            writers.write_staging(observed, staging_path, run.good_load_sets, present)
        run.metrics = dict(obs.get)
        if report_path:
            load_set_report(run.checked).write.mode("overwrite").parquet(report_path)
    except Exception:
        # the old rows are still there; every load set of the run goes to -1
        failed = {r.load_set_id: False for r in run.rule_sets}
        writers.write_status(rules, failed, status_path, jdbc_props, jdbc_quote)
        raise
    finally:
        run.release()
    writers.write_status(rules, outcome_map(run), status_path, jdbc_props, jdbc_quote)
    return run


def run_report(meta: DataFrame, members: DataFrame, dictionary: DataFrame, rules: DataFrame,
               load_set_ids=None, **kw) -> DataFrame:
    """RPT1 without staging: the per-load-set counts, one row per load set.  The
    per-curve result is persisted while they are made."""
    kw.setdefault("persist", True)
    run = stage(meta, members, dictionary, rules, load_set_ids, **kw)
    try:
        report = load_set_report(run.checked)
        return meta.sparkSession.createDataFrame(report.collect(), report.schema)
    finally:
        run.release()


def build_docs(meta: DataFrame, members: DataFrame | None, names: DataFrame,
               load_set_id=ALL, mode: str = "reference", bundles: int | None = None) -> DataFrame:
    """JOB2: (curve_id, doc) for one load set or ``'all'``; with ``bundles``,
    on that many hash partitions of the curve id (one bundle each)."""
    return curve_docs(meta, members, names, load_set_id, mode, bundles)


def run_export(meta: DataFrame, members: DataFrame | None, names: DataFrame, out_path: str,
               bundles: int, load_set_id=ALL, mode: str = "reference", bundle_bytes: int | None = None) -> None:
    """JOB2 end to end, ``<DOCS>`` .. ``</DOCS>`` files, in one action: one file per bundle, or with ``bundle_bytes`` as many
    files of at most that size (and one document) as a bundle needs.  Metadata and names are shuffled once, to their bundle; the
    documents are never shuffled after they are rendered."""
    docs = bundled_docs(meta, members, names, bundles, load_set_id, mode)
    if bundle_bytes:
        writers.write_sized_bundles(docs, out_path, bundle_bytes)
    else:
        writers.write_partition_bundles(docs, out_path)
