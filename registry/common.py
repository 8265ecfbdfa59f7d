"""Shared pieces of the query registry."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from storelens.sources.views import AS_OF, views, with_views

__all__ = ["AS_OF", "LOCAL_MIDNIGHT", "candidate_sql", "rounded", "views", "win", "with_views"]

NOW = "timestamp '2024-01-31 00:00:00'"
#: local midnight (Asia/Tokyo) of the run day, as a UTC wall time
LOCAL_MIDNIGHT = datetime(2024, 1, 30, 15)


def win(days: int, now: bool = False, ts: str = "ts") -> str:
    """Oracle predicate of the last ``days`` local days."""
    start = LOCAL_MIDNIGHT - timedelta(days=days)
    end = datetime(2024, 1, 31) if now else LOCAL_MIDNIGHT
    return f"{ts} >= timestamp '{start}' and {ts} < timestamp '{end}'"


def rounded(df: DataFrame, *cols: str, digits: int = 8) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in cols})


def candidate_sql(body: str, key_type: str, logic: str, score: str, reason: str) -> str:
    """Candidate rows from a body that yields key_value, product_id, rank_in_logic."""
    return f"""
        select '{key_type}' as key_type, key_value, '{logic}' as logic_name, product_id,
               round(cast({score} as double), 8) as score,
               cast(rank_in_logic as integer) as rank_in_logic, {reason} as reco_reason
        from ({body}) b"""
