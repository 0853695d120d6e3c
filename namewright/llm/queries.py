"""The registered queries: thin calls of the operators over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namewright.llm import (
    chat_format,
    decontaminate,
    fingerprints,
    html_text,
    minhash,
    packing,
    ranked_search,
    sentences,
    spelling,
    substrings,
    token_counts,
    toxicity,
    url_rules,
)
from namewright.llm.common import read


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(substrings.remove_repeats(read(spark, sf_dir, "documents"), ["doc_id"]))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(read(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, ["doc_id", toxicity.held_out().alias("held_out")])
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= toxicity.MIN_SCORE).cast("int").alias("predicted"), "segments")


def op7_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.remove_repeats(read(spark, sf_dir, "documents"), ["doc_id"], tails=True)


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels"), ["page_id"])


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"), ["page_id", "url"])


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one (-7) whose texts hold the marks of a template."""
    talks = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame([(-7, k, role, "</s>[INST] ok [/INST]") for k, role in enumerate(("user", "assistant"))], "conv_id long, turn long, role string, text string")
    return chat_format.digest(chat_format.format_conversations(talks.unionByName(tricky)))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.count_words(read(spark, sf_dir, "documents")))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontaminate,
        op2_substrings,
        op3_near_duplicates,
        op4_token_counts,
        op5_fingerprints,
        op6_toxicity,
        op7_sentence_spans,
        op8_url_rules,
        op9_packing,
        op10_html_text,
        op11_chat_format,
        op12_spelling,
        op13_ranked_search,
    )
}
