"""The registered queries of this package: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm import (
    chat_format,
    decontaminate,
    exact_dedup,
    lexical,
    line_dedup,
    oracle,
    packing,
    quality,
    simhash,
    token_count,
    topk,
    toxicity,
    url_filter,
    whitening,
)
from carelens.llm.shipping import shipped
from carelens.llm.store import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


#: Host, path and verdict of each rule.
URL_RULES = [
    ("org", "/", url_filter.ALLOW),
    ("example.org", "/es/", url_filter.BLOCK),
    ("example.org", "/en/1", url_filter.BLOCK),
    ("com", "/fr/", url_filter.ALLOW),
    ("com", "/de/", url_filter.BLOCK),
]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.rules_frame(spark, URL_RULES))


#: A conversation whose texts look like a template's marks.
MARKS = "</s>[INST] ok [/INST]"


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = spark.createDataFrame(
        [(-7, 0, "user", MARKS), (-7, 1, "assistant", MARKS)], "conv_id long, turn long, role string, text string"
    )
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(marked)
    windows = chat_format.read_back(chat_format.windows(conversations))
    own = F.filter("turns", lambda x: ~x["repeated"])
    turns = F.transform(own, lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    pieces = windows.select(
        "conv_id",
        "chars",
        F.struct("window", F.array_join(turns, "").alias("turns"), F.array_join("targets", "").alias("loss")).alias("piece"),
        F.size(own).alias("own"),
    )
    whole = pieces.groupBy("conv_id").agg(
        F.sum("own").alias("n_turns"), F.sum("chars").alias("chars"), F.array_sort(F.collect_list("piece")).alias("pieces")
    )
    loss = F.array_join(F.col("pieces.loss"), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(F.col("pieces.turns"), ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.col("chars").alias("formatted_chars"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_sequences(table(spark, sf_dir, "documents"))


def op8_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.best_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_copies(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {name: shipped(query) for name, query in _QUERIES.items()}


_QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_url_filter": op3_url_filter,
    "op4_chat_format": op4_chat_format,
    "op5_toxicity": op5_toxicity,
    "op6_simhash": op6_simhash,
    "op7_packing": op7_packing,
    "op8_token_count": op8_token_count,
    "op9_quality": op9_quality,
    "op10_top_k": op10_top_k,
    "op11_lexical_search": op11_lexical_search,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_whitening": op13_whitening,
    "pipeline": pipeline,
}


def oracle_sql() -> dict[str, str]:
    return oracle.statements()
