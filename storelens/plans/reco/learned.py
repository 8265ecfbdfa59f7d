"""Logics that learn: purchase probability and matrix factorisation (Spark ML)."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame, functions as F

from storelens.functions.timewin import in_range, window_bounds
from storelens.operators.ids import dense_ids
from storelens.operators.joins import salted_join, salts_for
from storelens.operators.ranking import topk_per_key
from storelens.operators.staging import checkpoint_home, stage
from storelens.plans.reco.base import CANDIDATE_SCHEMA, Tables, candidates, purchases, rows_in
from storelens.plans.reco.factors import best_unowned, shrunk_biases

#: blocks of a factorisation at least, and ratings of a block, about
BLOCKS, BLOCK_RATINGS = 10, 1 << 18

FEATURES = [
    "pv_count",
    "session_count",
    "distinct_category_count",
    "distinct_brand_count",
    "avg_dwell_seconds",
]


def _stitched(t: Tables, cfg, as_of: datetime) -> DataFrame:
    """Web events with the member their cookie belongs to."""
    rows = rows_in(t, "weblog", cfg.window, as_of, cfg.tz).drop("member_id")
    return salted_join(rows, t["id_mapping"].select("member_id", "cookie"), "cookie", "ts")


def _mean(column: str):
    """The mean of doubles, not dependent on the order of rows: whole and broken parts of 2^-20 add up without rounding."""
    scaled = F.col(column).cast("double") * F.lit(float(1 << 20))
    whole = F.floor(scaled).cast("double")
    return (F.sum(whole) + F.sum(scaled - whole)) / F.lit(float(1 << 20)) / F.nullif(F.count(column), F.lit(0))


def ml_features(t: Tables, cfg, as_of: datetime) -> DataFrame:
    """One row per member: web, purchase and profile features, zero when absent."""
    web = (
        _stitched(t, cfg, as_of)
        .groupBy("member_id")
        .agg(
            F.count("*").alias("pv_count"),
            F.count_distinct("session_id").alias("session_count"),
            F.count_distinct("category_id").alias("distinct_category_count"),
            F.count_distinct("brand_id").alias("distinct_brand_count"),
            _mean("dwell_seconds").alias("avg_dwell_seconds"),
        )
    )
    bought = (
        purchases(t, cfg, as_of)
        .groupBy("member_id")
        .agg(
            F.count_distinct("order_id").alias("purchase_count"),
            F.sum("amount").cast("double").alias("total_amount"),
            F.max("ts").alias("last_purchase_time"),
        )
    )
    zero = {c: 0 for c in [*FEATURES, "purchase_count", "total_amount"]}
    return (
        t["members"]
        .select("member_id", "gender", "age_band", "member_rank")
        .join(web, "member_id", "left")
        .join(bought, "member_id", "left")
        .fillna(zero)
    )


def purchase_probability(t: Tables, cfg, as_of: datetime) -> DataFrame:
    """(member_id, purchase_probability) from gradient-boosted trees.

    With ``prediction_window_days`` the label is a purchase in the days after
    the feature window and the model is then applied to the latest features;
    with 0 the label is a purchase inside the feature window itself.
    """
    scoring = ml_features(t, cfg, as_of)
    if cfg.prediction_window_days > 0:
        start, end = window_bounds(f"-{cfg.prediction_window_days}d", as_of, cfg.tz)
        buyers = in_range(t["purchases"], start, end).select("member_id").distinct()
        cut = as_of - timedelta(days=cfg.prediction_window_days)
        training = ml_features(t, cfg, cut).join(
            buyers.withColumn("label", F.lit(1.0)), "member_id", "left"
        ).fillna({"label": 0.0})
    else:
        scoring = scoring.withColumn("label", (F.col("purchase_count") > 0).cast("double"))
        scoring = training = stage(scoring)
    model = Pipeline(
        stages=[
            VectorAssembler(inputCols=FEATURES, outputCol="features"),
            GBTClassifier(
                labelCol="label", maxIter=cfg.max_iter, maxDepth=3, stepSize=0.1, seed=cfg.seed
            ),
        ]
    ).fit(training)
    return model.transform(scoring).select(
        "member_id", vector_to_array("probability")[1].alias("purchase_probability")
    )


def member_category_scores(
    t: Tables, cfg, as_of: datetime, probability: DataFrame, categories: int = 3
) -> DataFrame:
    """Each member's probability spread over the categories they viewed most."""
    liked = topk_per_key(
        _stitched(t, cfg, as_of)
        .filter(F.col("category_id").isNotNull())
        .groupBy("member_id", "category_id")
        .agg(F.count("*").alias("views")),
        ["member_id"],
        [F.desc("views"), F.asc("category_id")],
        categories,
        "interest_rank",
    )
    # the viewing order breaks the tie between categories of equal probability
    return liked.join(probability, "member_id").select(
        "member_id", "category_id", "purchase_probability", "interest_rank"
    )


def scores_to_candidates(t: Tables, cfg, as_of: datetime, scores: DataFrame) -> DataFrame:
    """Three best categories per member times three bestsellers per category."""
    tie = [F.asc("interest_rank")] if "interest_rank" in scores.columns else []
    sold = (
        purchases(t, cfg, as_of)
        .groupBy("category_id", "product_id")
        .agg(F.sum("amount").alias("total"))
    )
    best = topk_per_key(
        sold, ["category_id"], [F.desc("total"), F.asc("product_id")], 3, "rank_in_category"
    ).select("category_id", "product_id", "rank_in_category")
    top = topk_per_key(
        scores.withColumnRenamed("member_id", "key_value"),
        ["key_value"],
        [F.desc("purchase_probability"), *tie, F.asc("category_id")],
        3,
        "category_rank",
    )
    ranked = topk_per_key(
        salted_join(top, best, "category_id", "key_value"),
        ["key_value"],
        [
            F.desc("purchase_probability"),
            F.asc("rank_in_category"),
            F.asc("category_rank"),
            F.asc("product_id"),
        ],
        cfg.top_n,
    )
    return candidates(
        ranked,
        cfg.key_column,
        "ml_purchase_probability",
        F.col("purchase_probability"),
        "ml_purchase_probability",
    )


def ml_purchase_probability(t: Tables, cfg, as_of: datetime) -> DataFrame:
    probability = purchase_probability(t, cfg, as_of)
    scores = member_category_scores(t, cfg, as_of, probability)
    return scores_to_candidates(t, cfg, as_of, scores)


def interactions(t: Tables, cfg, as_of: datetime) -> DataFrame:
    """Quantity and distinct orders per member and product, positive only."""
    return (
        purchases(t, cfg, as_of)
        .filter(F.col("member_id").isNotNull() & F.col("product_id").isNotNull())
        .groupBy("member_id", "product_id")
        .agg(
            F.sum("quantity").alias("interaction_value"),
            F.count_distinct("order_id").alias("purchase_count"),
        )
        .filter(F.col("interaction_value") > 0)
    )


def ratings(rows: DataFrame) -> DataFrame:
    """Interaction strength scaled to 1..5 by the largest one."""
    value = F.col("interaction_value").cast("double")
    most = rows.agg(F.greatest(F.max("interaction_value").cast("double"), F.lit(1.0)).alias("m")).scalar()
    scaled = F.lit(1.0) + F.lit(4.0) * value / most
    return rows.withColumn("rating", F.least(F.greatest(scaled, F.lit(1.0)), F.lit(5.0)))


def factor_blocks(ratings: int) -> int:
    """Blocks of members and of products, each a task of the factorisation: ``BLOCKS``, more where a block has over ``BLOCK_RATINGS``."""
    return max(BLOCKS, -(-ratings // BLOCK_RATINGS))


def user_based_cf(t: Tables, cfg, as_of: datetime) -> DataFrame:
    """Unowned products with the best predicted rating: mean, member bias and product bias, and factors of the rest (ALS).

    Mean and member bias are the same for all products of a member, so product bias and factor product order a
    member's list; the bias stands in the vectors as one more factor, and ``best_unowned`` finds the best
    products without scoring all pairs.
    """
    spark = t["purchases"].sparkSession
    checkpoint_home(spark)
    rows = interactions(t, cfg, as_of).filter(F.col("interaction_value") >= cfg.min_interactions)
    rated = stage(ratings(rows).select("member_id", "product_id", "rating"))
    if rated.isEmpty():
        return spark.createDataFrame([], CANDIDATE_SCHEMA)
    member_bias, product_bias = shrunk_biases(rated, "member_id", "product_id")
    # every join below has the rows of ``rated`` on its big side
    by_member, by_product = salts_for(rated, "member_id"), salts_for(rated, "product_id")
    known = salted_join(rated, member_bias, "member_id", "product_id", by_member)
    known = salted_join(known, product_bias, "product_id", "member_id", by_product)
    level = F.col("mean") + F.col("user_bias")
    rest = (F.col("rating") - level - F.col("item_bias")).alias("rest")
    known = known.select("member_id", "product_id", level.alias("level"), "item_bias", rest)
    coded = salted_join(known, dense_ids(rated, "member_id", "u"), "member_id", "product_id", by_member)
    coded = salted_join(coded, dense_ids(rated, "product_id", "i"), "product_id", "member_id", by_product)
    coded = stage(coded.withColumns({"u": F.col("u").cast("int"), "i": F.col("i").cast("int")}))
    blocks = factor_blocks(coded.count())
    model = ALS(
        userCol="u",
        itemCol="i",
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        ratingCol="rest",
        rank=cfg.n_factors,
        maxIter=cfg.n_epochs,
        regParam=0.1,
        seed=cfg.seed,
        coldStartStrategy="drop",
    ).fit(coded)
    members = coded.groupBy("u").agg(F.first("member_id").alias("key_value"), F.first("level").alias("level"))
    products = coded.groupBy("i").agg(F.first("product_id").alias("name"), F.first("item_bias").alias("item_bias"))
    factors = F.col("features").cast("array<double>")
    users = model.userFactors.select(F.col("id").alias("u"), F.concat(factors, F.array(F.lit(1.0))).alias("vector"))
    items = model.itemFactors.withColumnRenamed("id", "i").join(products, "i")
    items = items.select("i", "name", F.concat(factors, F.array("item_bias")).alias("vector"))
    best = best_unowned(stage(users), stage(items), coded.select("u", "i"), cfg.top_n)
    ranked = best.join(members, "u").withColumnsRenamed({"name": "product_id", "score": "rest", "rank": "rank_in_logic"})
    est = F.least(F.greatest(F.col("level") + F.col("rest"), F.lit(1.0)), F.lit(5.0))
    return candidates(ranked, "member_id", "user_based_cf", est / 5.0, "matrix_factorization")
