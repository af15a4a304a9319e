"""From raw documents to packed training sequences, in stages that each write what they keep.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame: the columns of ``documents`` of what it keeps, the
last one the packed pieces. A document that a stage drops is seen by no later one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm import decontaminate, line_dedup, near_copies, packing, quality
from carelens.llm.shipping import shipped
from carelens.llm.store import stored, table


@shipped
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


@shipped
def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that the largest of at least three holders keeps. n_chars follows the text."""
    kept = line_dedup.dedup_lines(docs)
    own = {"n_chars": F.char_length("text").cast(docs.schema["n_chars"].dataType)}
    return kept.select(*(own[c].alias(c) if c in own else F.col(c) for c in docs.columns))


@shipped
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts whose five-word shingles have a Jaccard similarity of 0.8 or more.

    SimHash proposes candidates, MinHash bands those beyond its radius, and exact shingle sets decide.
    """
    return near_copies.one_per_group(docs)


@shipped
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


@shipped
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents left, placed in sequences."""
    return packing.packed_sequences(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_shared_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]

#: A trained classifier, SimHash and a tokenizer are beyond SQL; tests hold each stage to a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return docs
