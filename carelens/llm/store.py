"""Intermediate results in the shared folder, and folds of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.session import scratch_path

#: Labelled rows whose crc32 of the id falls into this fold are never learned from.
FOLDS, HELD_OUT_FOLD = 5, 0


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    This cuts the lineage: what follows reads files that outlive any executor, and a
    retried task sees the same rows.
    """
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str | Column) -> Column:
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string")) % FOLDS == HELD_OUT_FOLD, F.lit(False))
