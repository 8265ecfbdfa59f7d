"""Top-k, latest-row, quantile-tile and slot-pivot building blocks."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from storelens.operators.staging import stage


def topk_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank_in_logic"
) -> DataFrame:
    """The first ``k`` rows of each key, numbered from 1.

    The filter sits directly on ``row_number``, so Spark plans a
    WindowGroupLimit on the map side: each task sends at most ``k`` rows per key
    to the shuffle, and a hot key never reaches one task as a whole.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return topk_per_key(df, keys, order, 1, "_rn").drop("_rn")


def global_topn(
    df: DataFrame, order: Sequence[Column], n: int, rank: str = "rank_in_logic"
) -> DataFrame:
    """The first ``n`` rows of all, numbered; only these ``n`` rows meet in one task."""
    top = df.orderBy(*order).limit(n)
    return top.withColumn(rank, F.row_number().over(W.orderBy(*order)))


def give_to_all(keys: DataFrame, few: DataFrame) -> DataFrame:
    """Every row of ``few`` for every row of ``keys``.

    ``few`` must be bounded by construction (a top-n, an arm list, recipients).
    It becomes one array value of a scalar subquery that each key row unfolds,
    so no join and no shuffle of ``keys`` happens.
    """
    items = few.agg(F.array_sort(F.collect_list(F.struct(*few.columns))).alias("items")).scalar()
    return keys.select("*", F.explode(items).alias("_item")).select(*keys.columns, "_item.*")


#: ranges of cells that are numbered independently
RANGES = 512


def _into_ranges(cells: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """Adds ``rng``, the index of the range between two cuts (binary search in the JVM)."""
    out = None
    for measure, values in cuts.items():
        splits = [float("-inf"), *sorted(set(values)), float("inf")]
        bucketizer = Bucketizer(splits=splits, inputCol="v", outputCol="rng")
        part = bucketizer.transform(cells.filter(F.col("measure") == measure))
        out = part if out is None else out.unionByName(part)
    return cells.withColumn("rng", F.lit(0.0)) if out is None else out


def ntiles(df: DataFrame, key: str, measures: dict[str, Column], tiles: int = 5) -> DataFrame:
    """Exact ``ntile`` of several measures over the whole table, without one global sort.

    ``measures`` maps an output name to the ascending sort value; NULL comes after all values. Equal values
    are ordered by ``md5(key)``, a NULL key before all others. Rows are counted per cell (value, first two hex
    digits of the md5); cells are grouped into ranges of near-equal cell count;
    prefix sums over ranges and cells give each cell its global offset, and
    only rows of one cell are sorted together.
    """
    names = list(measures)
    last = F.lit(float("inf"))  # where NULL is sorted
    df = stage(df.select(F.col(key), *[F.coalesce(measures[n].cast("double"), last).alias(n) for n in names]))
    long = (
        df.select(
            F.col(key).cast("string").alias("_key"),
            F.coalesce(F.md5(F.col(key).cast("string")), F.lit("")).alias("_md5"),
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(n).alias("measure"), F.col(n).alias("v"))
                        for n in names
                    ]
                )
            ).alias("m"),
        )
        .select("_key", "_md5", "m.measure", "m.v")
        .withColumn("cell", F.substring("_md5", 1, 2))
    )
    cells = stage(long.groupBy("measure", "v", "cell").agg(F.count("*").alias("n")))
    # the cuts are a fixed number of values per measure
    probabilities = [i / RANGES for i in range(1, RANGES)]
    cuts = cells.groupBy("measure").agg(F.percentile_approx("v", probabilities).alias("cuts"))
    cuts = {r.measure: [c for c in r.cuts if math.isfinite(c)] for r in cuts.collect()}
    cells = _into_ranges(cells, cuts)
    # at most RANGES ranges per measure, so this window is bounded by construction
    per_range = (
        cells.groupBy("measure", "rng")
        .agg(F.sum("n").alias("rn_rows"))
        .withColumn("rng_end", F.sum("rn_rows").over(W.partitionBy("measure").orderBy("rng")))
        .withColumn("total", F.sum("rn_rows").over(W.partitionBy("measure")))
        .select("measure", "rng", (F.col("rng_end") - F.col("rn_rows")).alias("rng_start"), "total")
    )
    in_range = W.partitionBy("measure", "rng").orderBy("v", "cell")
    offsets = (
        cells.withColumn("cell_end", F.sum("n").over(in_range))
        .join(F.broadcast(per_range), ["measure", "rng"])
        .select(
            "measure",
            "v",
            "cell",
            "total",
            (F.col("rng_start") + F.col("cell_end") - F.col("n")).alias("before"),
        )
    )
    in_cell = W.partitionBy("measure", "v", "cell").orderBy("_md5", "_key")
    i = F.col("before") + F.row_number().over(in_cell) - 1
    q, r = F.expr(f"total div {tiles}"), F.col("total") % tiles
    numbered = long.join(offsets, ["measure", "v", "cell"]).select(
        "_key", "measure", i.alias("i"), q.alias("q"), r.alias("r")
    )
    tile = F.expr(
        "case when i < r * (q + 1) then i div (q + 1) + 1 else r + (i - r * (q + 1)) div q + 1 end"
    )
    return (
        numbered.withColumn("tile", tile)
        .groupBy(F.col("_key").alias(key))
        .agg(*[F.max(F.when(F.col("measure") == n, F.col("tile"))).alias(n) for n in names])
    )


def pivot_slots(
    df: DataFrame, key: str, slot: str, values: dict[str, str], slots: Sequence[int] = (1, 2, 3, 4)
) -> DataFrame:
    """Long slots to wide columns; ``values`` maps a column to a name with ``{n}``."""
    aggs = [
        F.max(F.when(F.col(slot) == n, F.col(src))).alias(pattern.format(n=n))
        for n in slots
        for src, pattern in values.items()
    ]
    return df.groupBy(key).agg(*aggs)
