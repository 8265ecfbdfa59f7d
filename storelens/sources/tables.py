"""Table sources: named Parquet tables, declared schemas, constant tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def configure(spark: SparkSession) -> SparkSession:
    """Session settings the plans rely on; sizes stay as the cluster sets them."""
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }.items():
        spark.conf.set(key, value)
    return spark


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def read_tables(spark: SparkSession, directory: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {n: read_table(spark, directory, n) for n in names}


def string_schema(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def ensure_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Creates an empty Parquet table of a declared schema unless it is there."""
    if not spark.catalog.tableExists(name):
        spark.createDataFrame([], schema).write.format("parquet").saveAsTable(name)


def split_source(spark: SparkSession, text: str, column: str, sep: str = ",") -> DataFrame:
    """One row per element of a delimited setting, such as a list of recipients."""
    one = spark.range(1).select(F.lit(text).alias("text"))
    return one.select(F.explode(F.split("text", sep)).alias(column))
