"""URL filtering: explicit host and path rules, and association rules mined from labels.

Spark's FP-growth mines combinations of URL tokens that are frequent among the labelled bad
URLs. Tokens that occur in the very same labelled URLs (a host and its labels, the keys of one template) count as one item there, since
every combination would otherwise come once per subset of them: n such tokens in 2^n - 1 ways. A rule then asks for at least one token
of each of its items, which blocks what all those combinations would. Each combination is then counted among all labelled URLs; as rules are kept those with
enough support and confidence (the share of bad URLs among those that match), without a shorter rule of
at least the same confidence inside them. Rules are matched through an inverted index: each rule
is filed under its rarest token, a URL meets only the rules filed under one of its tokens, and
holds a rule if it has all of its tokens.

Everything runs as DataFrame operations and Spark's own FP-growth. Scale: URLs are made distinct
before tokens are exploded, so that a common URL is matched once; pages meet the few matching URLs in a join
that adaptive execution splits when one URL is hot. Mining reads the labelled bad URLs only.

Defined cases: a null url or one without ``://`` has empty host and path, no rule and no tokens, and is allowed.
Conflicting or repeated labels of a document count as bad if any is; null labels are ignored. With
fewer than ``min_count`` bad URLs nothing is mined. Repeated pages repeat their result.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namewright.llm.common import written

# Fixed values of the contract: (verdict, host, path).
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
MIN_SUPPORT, MIN_COUNT, MIN_CONFIDENCE = 0.01, 5, 0.5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_urls(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with host and path (both empty for null and where there is no ``://``)."""
    rest = F.expr(f"CASE WHEN instr(`{url}`, '://') > 0 THEN substring(`{url}`, instr(`{url}`, '://') + 3) ELSE '' END")
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return pages.withColumn("host", F.translate(host, _UPPER, _LOWER)).withColumn("path", path)


def explicit_rule(rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits columns host and path; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is tested first
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, F.lit(host + path)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def tokens(url: str = "url") -> Column:
    """The distinct tokens of a URL: host, its parents and labels, path words (numbers as #), query keys, query keys with their values, fragment."""
    labels = F.split("host", r"\.")
    words = F.transform(F.filter(F.split("path", "[/._-]+"), lambda w: w != ""), lambda w: F.concat(F.lit("p:"), F.regexp_replace(w, "[0-9]+", "#")))
    query = F.regexp_extract(F.col(url), r"\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda w: w != "")
    parts = F.concat(
        F.array(F.concat(F.lit("h:"), "host")),
        F.transform(labels, lambda w: F.concat(F.lit("l:"), w)),
        words,
        F.transform(pairs, lambda w: F.concat(F.lit("q:"), F.substring_index(w, "=", 1))),
        F.transform(F.filter(pairs, lambda w: w.contains("=")), lambda w: F.concat(F.lit("v:"), w)),
        F.transform(F.filter(F.array(F.regexp_extract(F.col(url), r"#(.*)", 1)), lambda w: w != ""), lambda w: F.concat(F.lit("f:"), w)),
    )
    return F.when(F.col("host") != "", F.array_distinct(parts)).otherwise(F.array().cast("array<string>"))


def matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The rows of ``urls`` (with tokens) beside each of the ``rules`` (rule_id, items, filed) that they hold."""
    spread = urls.withColumn("filed", F.explode("tokens"))
    return spread.join(rules, "filed").where(F.size(F.array_except("items", "tokens")) == 0).drop("filed")


def token_classes(rows: DataFrame, least: int, most: float) -> DataFrame:
    """Tokens of ``rows`` (at, tokens) that occur in at least ``least`` and fewer than ``most`` rows, those of the very same rows
    in one class: class (its smallest token), n (rows) and members. Rows are told apart by two 64-bit sums over their numbers' hashes."""
    spread = rows.select("at", F.explode("tokens").alias("token"))
    counted = spread.groupBy("token").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("at")).alias("x"), F.bit_xor(F.xxhash64("at", F.lit(1))).alias("y"))
    counted = counted.where((F.col("n") >= least) & (F.col("n") < most))
    # The tokens of a class stand together in one URL, so their list is as short as a URL.
    return counted.groupBy("n", "x", "y").agg(F.min("token").alias("class"), F.collect_set("token").alias("members")).select("class", "n", "members")


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame | None:
    """Rules (rule_id, items, alternatives, filed, support, confidence) from rows with tokens and bad (0 or 1); None if there is too little to learn from.

    Items are classes of tokens that no labelled row tells apart, each named by its smallest token; ``alternatives`` are all
    tokens of each. A rule stands for every choice of one token of each class: all have its support and confidence."""
    n, bad = labelled.agg(F.count("*"), F.sum("bad")).first()
    if not bad or bad < min_count:
        return None
    rows = written(labelled.select("tokens", "bad").withColumn("at", F.monotonically_increasing_id()), "rows")
    classes = written(token_classes(rows, min_count, 0.9 * n), "classes")  # a token of nearly all URLs tells nothing
    of_token = classes.select("class", F.explode("members").alias("token"))
    held = rows.select("at", "bad", F.explode("tokens").alias("token")).join(of_token, "token").groupBy("at", "bad").agg(F.collect_set("class").alias("tokens"))
    held = written(held.select("bad", "tokens"), "held")
    found = FPGrowth(itemsCol="tokens", minSupport=max(min_support, min_count / bad)).fit(held.where("bad = 1").select("tokens")).freqItemsets
    # FP-growth takes its share of the rows with items; a support below the asked one only adds rules that are counted next.
    sets = written(found.select(F.xxhash64(F.array_sort("items")).alias("rule_id"), "items"), "itemsets")
    sizes = sets.select("rule_id", F.explode("items").alias("class")).join(classes, "class")
    filed = sizes.groupBy("rule_id").agg(F.min_by("class", F.struct("n", "class")).alias("filed"), F.map_from_entries(F.collect_list(F.struct("class", "members"))).alias("of"))
    filed = sets.join(filed, "rule_id").withColumn("alternatives", F.transform("items", lambda c: F.element_at("of", c))).drop("of")
    filed = written(filed, "filed")
    scored = matches(held, filed.select("rule_id", "items", "filed")).groupBy("rule_id").agg(F.count("*").alias("support"), F.avg("bad").alias("confidence"))
    least = max(min_count, math.ceil(min_support * bad))
    good = filed.join(scored.where((F.col("support") * F.col("confidence") >= least) & (F.col("confidence") >= min_confidence)), "rule_id")
    good = written(good, "rules")
    # A rule inside another one with at least its confidence makes the longer one needless.
    short = good.select(F.col("rule_id").alias("id2"), F.col("items").alias("items2"), F.col("confidence").alias("confidence2"), "filed")
    inside = good.select("rule_id", "items", "confidence", F.explode("items").alias("filed")).join(short, "filed")
    needless = inside.where((F.size(F.array_except("items2", "items")) == 0) & (F.size("items2") < F.size("items")) & (F.col("confidence2") >= F.col("confidence"))).select("rule_id")
    return good.join(needless.distinct(), "rule_id", "left_anti")


def rule_hits(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The rows of ``urls`` (with tokens) beside each mined rule that they hold, perhaps more than once: at least one token of each of its classes."""
    by_token = rules.withColumn("filed", F.explode(F.element_at("alternatives", F.array_position("items", F.col("filed")).cast("int"))))
    met = urls.withColumn("filed", F.explode("tokens")).join(by_token, "filed")
    return met.where(F.forall("alternatives", lambda some: F.arrays_overlap(some, F.col("tokens")))).drop("filed")


def judge(pages: DataFrame, labels: DataFrame, keep: list[str], url: str = "url", label_id: str = "doc_id", bad: str = "quality = 0", rules: list[tuple[str, str, str]] = RULES, **options) -> DataFrame:
    """The ``keep`` columns of ``pages`` with host, path, rule, verdict and confidence (of the best mined rule that the url holds).

    A url belongs to the labelled document whose id is the last whole number of its path."""
    named = split_urls(pages.select(*keep, F.col(url).alias("__url")), "__url")
    urls = named.select("__url", "host", "path").where("host != ''").distinct().withColumn("tokens", tokens("__url"))
    marks = labels.where(F.expr(f"({bad}) IS NOT NULL")).groupBy(F.col(label_id).cast("long").alias("doc")).agg(F.max(F.expr(f"CAST({bad} AS INT)")).alias("bad"))
    of_doc = F.expr(r"try_cast(regexp_extract(path, '([0-9]+)[^0-9]*\\z', 1) AS BIGINT)")
    labelled = written(urls.withColumn("doc", of_doc).join(marks, "doc").select("tokens", "bad"), "labelled")
    mined = mine(labelled, **options)
    rule, verdict = explicit_rule(rules)
    if mined is None:
        judged = named.withColumn("confidence", F.lit(None).cast("double"))
    else:
        hits = rule_hits(urls.select("__url", "tokens"), mined.select("items", "alternatives", "filed", "confidence"))
        judged = named.join(hits.groupBy("__url").agg(F.max("confidence").alias("confidence")), "__url", "left")
    learnt = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return judged.select(*keep, "host", "path", rule.alias("rule"), F.coalesce(verdict, learnt).alias("verdict"), "confidence")
