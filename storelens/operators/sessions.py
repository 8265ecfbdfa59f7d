"""Gap-based sessions of an event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from storelens.functions.timewin import epoch


def sessionize(
    df: DataFrame,
    key: str,
    gap_seconds: int,
    order: list[str],
    fill: str | None = None,
) -> DataFrame:
    """Adds session columns; a session ends at a pause of more than ``gap_seconds``.

    Added: ``session_id``, ``session_start``, ``session_end`` (epoch seconds),
    ``session_num`` (row number in the session by time and ``order``),
    ``browsing_sec`` (seconds to the next row) and, with ``fill``, ``<fill>_comp``
    (the value, or the largest one of the session).

    Time is cut into slices of the gap's length. Two events of one slice are
    never further apart than the gap, so a (key, slice) group lies in exactly one
    session. Sessions are found on the slice summaries, one row per key and
    slice; event rows are only sorted inside their slice. A key with a third of
    all events is therefore spread over all of its slices.
    """
    rows = df.withColumns(
        {"_t": epoch("ts"), "_slice": F.floor(epoch("ts") / F.lit(gap_seconds))}
    )
    best = {"_fill": F.max(fill)} if fill else {}
    slices = rows.groupBy(key, "_slice").agg(
        F.min("_t").alias("first_t"),
        F.max("_t").alias("last_t"),
        F.count("*").alias("n"),
        *[v.alias(k) for k, v in best.items()],
    )
    by_time = W.partitionBy(key).orderBy("_slice")
    pause = F.col("first_t") - F.lag("last_t").over(by_time)
    starts = F.when(pause.isNull() | (pause > gap_seconds), F.col("first_t"))
    slices = slices.withColumn("_start", starts).withColumn(
        "session_start", F.max("_start").over(by_time.rowsBetween(W.unboundedPreceding, 0))
    )
    session = W.partitionBy(key, "session_start")
    in_order = session.orderBy("_slice")
    slices = slices.select(
        key,
        "_slice",
        "session_start",
        F.max("last_t").over(session).alias("session_end"),
        F.coalesce(
            F.sum("n").over(in_order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
        F.lead("first_t").over(in_order).alias("_next_t"),
        *[F.max(k).over(session).alias(k) for k in best],
    )
    here = W.partitionBy(key, "_slice").orderBy("_t", *order)
    out = (
        rows.join(slices, [key, "_slice"])
        .withColumns(
            {
                "session_num": F.col("_before") + F.row_number().over(here),
                "browsing_sec": F.coalesce(F.lead("_t").over(here), F.col("_next_t"))
                - F.col("_t"),
                "session_id": F.sha2(
                    F.concat_ws("|", F.col(key), F.col("session_start").cast("string")), 256
                ),
            }
        )
    )
    if fill:
        out = out.withColumn(f"{fill}_comp", F.coalesce(fill, "_fill"))
    return out.drop("_t", "_slice", "_before", "_next_t", "_fill")
