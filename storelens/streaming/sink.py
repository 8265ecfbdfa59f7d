"""Idempotent appends of micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def committed_append(df: DataFrame, path: str, batch_id: int, *by: str) -> None:
    """Writes a micro-batch to its own partition, below those of ``by``; a repeat with the same values replaces it."""
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by, "batch_id")
        .parquet(path)
    )
