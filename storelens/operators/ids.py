"""Dense integer ids without a pass through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

#: hash buckets; the offset table has this many rows, whatever the data
BUCKETS = 4096


def dense_ids(df: DataFrame, key: str, out: str) -> DataFrame:
    """Distinct values of ``key`` with ids 0..n-1: offset of the hash bucket plus place in it."""
    keys = df.select(key).distinct()
    keys = keys.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int"))
    sizes = keys.groupBy("_bucket").agg(F.count("*").alias("n"))
    offsets = sizes.select(
        "_bucket", (F.sum("n").over(W.orderBy("_bucket")) - F.col("n")).alias("_offset")
    )
    place = F.row_number().over(W.partitionBy("_bucket").orderBy(key)) - 1
    return keys.join(F.broadcast(offsets), "_bucket").select(
        key, (F.col("_offset") + place).alias(out)
    )
