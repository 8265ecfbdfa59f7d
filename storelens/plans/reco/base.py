"""The candidate row contract and parts shared by the logics."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from storelens.functions.timewin import in_window
from storelens.plans.reco.shared import WindowScan

Tables = Mapping[str, DataFrame]

CANDIDATE_SCHEMA = T.StructType(
    [
        T.StructField("key_type", T.StringType()),
        T.StructField("key_value", T.StringType()),
        T.StructField("logic_name", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("rank_in_logic", T.IntegerType()),
        T.StructField("reco_reason", T.StringType()),
    ]
)


def candidates(
    df: DataFrame, key_type: str, logic: str, score: Column, reason: Column | str
) -> DataFrame:
    """Rows with ``key_value, product_id, rank_in_logic`` as candidate rows."""
    return df.select(
        F.lit(key_type).alias("key_type"),
        F.col("key_value").cast("string").alias("key_value"),
        F.lit(logic).alias("logic_name"),
        F.col("product_id").cast("string").alias("product_id"),
        score.cast("double").alias("score"),
        F.col("rank_in_logic").cast("int").alias("rank_in_logic"),
        (F.lit(reason) if isinstance(reason, str) else reason).alias("reco_reason"),
    )


def by_rank() -> Column:
    return F.lit(1.0).cast("double") / F.col("rank_in_logic")


def rows_in(t: Tables, name: str, spec: str, as_of: datetime, tz: str) -> DataFrame:
    """Rows of a table in a window; from the run's shared scan where there is one."""
    if isinstance(t, WindowScan):
        return t.window(name, spec, as_of, tz)
    return in_window(t[name], spec, as_of, tz)


def weblog(t: Tables, cfg, as_of: datetime, key: str | None = None) -> DataFrame:
    """Web events in the logic's window that carry its key, as ``key_value``."""
    key = key or cfg.key_column
    rows = rows_in(t, "weblog", cfg.window, as_of, cfg.tz)
    return rows.filter(F.col(key).isNotNull()).withColumn("key_value", F.col(key))


def purchases(t: Tables, cfg, as_of: datetime) -> DataFrame:
    return rows_in(t, "purchases", cfg.window, as_of, cfg.tz)


def owned(t: Tables, cfg, as_of: datetime) -> DataFrame:
    """Distinct (key_value, product_id) bought by members in the window."""
    rows = purchases(t, cfg, as_of)
    return rows.select(F.col("member_id").alias("key_value"), "product_id").distinct()


def active_keys(t: Tables, cfg, as_of: datetime, days: int) -> DataFrame:
    rows = rows_in(t, "weblog", f"-{days}d", as_of, cfg.tz)
    key = F.col(cfg.key_column)
    return rows.filter(key.isNotNull()).select(key.alias("key_value")).distinct()
