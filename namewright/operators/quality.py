"""Name quality: length limits, failure texts, duplicates, staged rows
(STR6-8, FLT6, PRJ1-2, AGG7, DUP1, JN5).

Duplicates at scale
-------------------
The owner of a name is the smallest curve id holding it among the valid
names of one load set.  It comes from a ``groupBy(load_set_id, ok, name)``
``min(curve_id), count`` aggregate (partial aggregation before the shuffle,
so a name shared by millions of curves costs one row per map task).  Only
names held more than once are joined back, by a plain equi-join without
hints: Spark broadcasts the owners when it measures them as small and
otherwise shuffles both sides.  The join key includes a hash of the name, so
that both sides get exchanges of their own and AQE can split a name's
partition when it is skewed.  Rows without a valid name carry their own
curve id as key, so they spread evenly instead of piling up on one reducer.
Long and short duplicates are found independently from the same rows (a
curve that loses its long name may still own its short name).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namewright.functions.text import (LONG_NAME_MAX, REASON_NO_VALUE, SHORT_NAME_MAX, clip,
                                       sql_msg_duplicate, sql_msg_exception, sql_msg_too_long,
                                       sql_msg_whole, sql_str)

IDS = ["load_set_id", "curve_id"]

# reason codes (null = valid)
NO_VALUE, RULE_ERROR, TOO_LONG, ATTR_TEXT, DUPLICATE = (
    "no_value", "rule_error", "too_long", "attr_text", "duplicate")


def length_flags(named: DataFrame, long_max: int = LONG_NAME_MAX,
                 short_max: int = SHORT_NAME_MAX) -> DataFrame:
    """STR6/STR7: per kind, ``<kind>_ok``, ``<kind>_text`` (the name, or the
    failure message) and ``<kind>_reason``; the description has no limit and
    never invalidates a curve.  Input: the output of ``rules.apply_rules``."""
    limits = {"long": long_max, "short": short_max}
    attr_bad = "attr_too_long" if "attr_too_long" in named.columns else "false"
    attr_reason = sql_str("attribute text is wider than the scan allows")
    no_value = sql_str(REASON_NO_VALUE)
    exprs = list(IDS)
    for kind in ("long", "short", "desc"):
        v, e = f"{kind}_value", f"{kind}_error"
        reason = (f"CASE WHEN {attr_bad} THEN {sql_str(ATTR_TEXT)} "
                  f"WHEN {e} IS NOT NULL THEN {sql_str(RULE_ERROR)} "
                  f"WHEN {v} IS NULL THEN {sql_str(NO_VALUE)} ")
        text = (f"CASE WHEN {attr_bad} THEN {sql_msg_whole(kind, 'curve_id', attr_reason)} "
                f"WHEN {e} IS NOT NULL THEN {sql_msg_exception(kind, 'curve_id', e)} "
                f"WHEN {v} IS NULL THEN {sql_msg_exception(kind, 'curve_id', no_value)} ")
        if kind in limits:
            # the limit counts UTF-16 units: a supplementary character counts twice
            over = f"octet_length(encode({v}, 'UTF-16BE')) > {2 * limits[kind]}"
            reason += f"WHEN {over} THEN {sql_str(TOO_LONG)} "
            text += f"WHEN {over} THEN {sql_msg_too_long(kind, 'curve_id', v, limits[kind])} "
        exprs += [reason + f"END AS {kind}_reason", text + f"ELSE {v} END AS {kind}_text"]
        if kind in limits:
            exprs.append(f"({reason}END) IS NULL AS {kind}_ok")
    return named.selectExpr(*exprs)


def rule_failures(named: DataFrame, long_max: int = LONG_NAME_MAX, short_max: int = SHORT_NAME_MAX) -> DataFrame:
    """The flags of the curves with a failed rule (reason ``rule_error``), told by the load sets' errors before any text is made."""
    failed = " OR ".join(f"{kind}_error IS NOT NULL" for kind in ("long", "short", "desc"))
    return length_flags(named.filter(failed), long_max, short_max)


def valid_names(flags: DataFrame, kind: str) -> DataFrame:
    """FLT6/PRJ1: (load_set_id, curve_id, name) of the valid names of one kind."""
    return flags.filter(F.col(f"{kind}_ok")).select(*IDS, F.col(f"{kind}_text").alias("name"))


def name_owners(flags: DataFrame, kind: str) -> DataFrame:
    """AGG7: the first (smallest) curve id per (load set, valid name), with the
    number of rows holding the name; partial aggregation before the shuffle."""
    return (flags.filter(F.col(f"{kind}_ok"))
            .groupBy("load_set_id", F.col(f"{kind}_ok").alias("_ok"),
                     F.col(f"{kind}_text").alias("_key"))
            .agg(F.min("curve_id").alias("_owner"), F.count(F.lit(1)).alias("_holders")))


def _with_owner(flags: DataFrame, kind: str) -> DataFrame:
    """Every row of ``flags`` with ``_owner``: the owner of its valid name where
    several rows hold it, else null."""
    hashed = "xxhash64(load_set_id, _ok, _key) AS _hash"
    shared = name_owners(flags, kind).filter("_holders > 1").drop("_holders").selectExpr("*", hashed)
    keyed = flags.selectExpr(
        "*", f"{kind}_ok AS _ok", f"CASE WHEN {kind}_ok THEN {kind}_text ELSE CAST(curve_id AS STRING) END AS _key")
    j = keyed.selectExpr("*", hashed).join(shared, ["load_set_id", "_hash", "_ok", "_key"], "left")
    return j.select(*flags.columns, "_owner")


def duplicates(flags: DataFrame, kind: str) -> DataFrame:
    """DUP1: every valid name that is not its owner's, with the message."""
    j = _with_owner(flags.filter(F.col(f"{kind}_ok")), kind)
    return j.filter(F.col("_owner") != F.col("curve_id")).selectExpr(
        *IDS, f"{kind}_text AS name", "_owner AS owner",
        sql_msg_duplicate(kind, "curve_id", "_owner") + " AS message")


def mark_duplicates(flags: DataFrame, kind: str) -> DataFrame:
    """JN5 for one kind: bring each row its name's owner and overwrite flag,
    text and reason where another curve owns the name."""
    j = _with_owner(flags, kind)
    dup = "coalesce(_owner <> curve_id, false)"
    replaced = {
        f"{kind}_text": f"CASE WHEN {dup} THEN {sql_msg_duplicate(kind, 'curve_id', '_owner')} "
                        f"ELSE {kind}_text END",
        f"{kind}_reason": f"CASE WHEN {dup} THEN {sql_str(DUPLICATE)} ELSE {kind}_reason END",
        f"{kind}_ok": f"{kind}_ok AND NOT {dup}",
    }
    return j.selectExpr(*[f"{replaced[c]} AS {c}" if c in replaced else c for c in flags.columns])


def validity_flag(long_ok, short_ok) -> Column:
    """PRJ2: ``Y`` when both names are valid; the description never counts."""
    return F.when(F.col(long_ok) & F.col(short_ok), F.lit("Y")).otherwise(F.lit("N"))


def checked_names(named: DataFrame, long_max: int = LONG_NAME_MAX,
                  short_max: int = SHORT_NAME_MAX, flags: DataFrame | None = None) -> DataFrame:
    """All checks, keeping flags and reason codes (used by staging and the report).

    ``flags`` may be given (e.g. persisted) to avoid recomputing the per-curve
    work in each of the three branches that read it (main, long owners,
    short owners)."""
    if flags is None:
        flags = length_flags(named, long_max, short_max)
    # both duplicate searches see the same original flags (do not chain the
    # short search on the long result; the long marking does not touch short_*)
    out = mark_duplicates(flags, "long")
    return mark_duplicates(out, "short")


def staged_rows(checked: DataFrame) -> DataFrame:
    """STR8 + PRJ2: rows of the staging table, texts cut to 4000 characters."""
    return checked.select(
        "curve_id",
        clip("long_text").alias("curve_name"),
        clip("short_text").alias("short_curve_name"),
        clip("desc_text").alias("curve_description"),
        "load_set_id",
        validity_flag("long_ok", "short_ok").alias("is_valid"),
    )
