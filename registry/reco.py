"""Recommendation queries and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.common import AS_OF, NOW, candidate_sql, rounded, views, win, with_views
from storelens import config as C
from storelens.operators.staging import stage
from storelens.plans.reco import association, behaviour, bestsellers, factors, final, learned
from storelens.plans.reco import similarity, stages
from storelens.plans.reco.shared import share_windows
from storelens.sources.tables import read_tables

YEARS = 3650
SEASONS = {
    "spring": ("STANDARD",),
    "summer": ("ECONOMY", "LARGE"),
    "autumn": ("MEDIUM",),
    "winter": ("PROMO", "SMALL"),
}
REPURCHASE = C.RepurchaseConfig(lookback_days=YEARS)
COOC = C.CooccurrenceConfig(lookback_days=YEARS, min_cooccurrence_count=2)
BASKET = C.BasketConfig(lookback_days=YEARS, min_support_count=2)
DENSE = C.BasketConfig(lookback_days=YEARS, min_support_count=20, min_lift=1.0)
JACCARD = C.UserCfConfig(lookback_days=YEARS)
SEASON = C.SeasonConfig(season_categories=SEASONS)
BANDIT = C.BanditConfig(enabled=True, min_impressions=20)
RFM = C.RfmConfig()
PROBABILITY = C.ProbabilityConfig(enabled=True)
CF = C.UserCfConfig(lookback_days=365)
FINAL = C.FinalConfig(exclude_purchased_within_days=30)
#: the thirteen logics that are on by default, similar buyers in the form that SQL has
MERGED = {
    **{n: fn for n, fn in final.LOGICS.items() if n not in ("ml_purchase_probability", "bandit_optimization")},
    "user_based_cf": association.user_based_cf_jaccard,
}

WEB = ("products", "purchases", "members", "weblog", "impressions", "id_mapping")


def _logic(fn, cfg, *names):
    def run(spark, sf):
        t = views(spark, sf, *names)
        t.setdefault("purchases", t.get("sales"))
        t.setdefault("weblog", t.get("clicks"))
        return rounded(fn(t, cfg, AS_OF), "score")

    return run


def _dense(spark, sf):
    """Basket association between suppliers, whose pairs are much denser."""
    t = views(spark, sf, "sales")
    sold = t["sales"].withColumn("product_id", F.col("supplier_id"))
    return rounded(association.basket_pairs({"purchases": sold}, DENSE, AS_OF), "support", "confidence", "lift")


def _reco_config():
    return C.RecoConfig(
        repurchase=REPURCHASE,
        item_cooccurrence=COOC,
        basket_association=BASKET,
        user_based_cf=JACCARD,
        time_seasonality=SEASON,
        final=FINAL,
    )


def _pool(spark, sf):
    t = share_windows(views(spark, sf, "products", "purchases", "members", "weblog"), _reco_config(), AS_OF, MERGED)
    # scores to eight digits, as the oracle has them
    return t, rounded(final.candidate_pool(t, _reco_config(), AS_OF, MERGED), "score")


def pool_query(spark, sf):
    return _pool(spark, sf)[1]


def weighted_query(spark, sf):
    _, pool = _pool(spark, sf)
    return rounded(final.normalize_weight(stage(pool), FINAL), "weighted_score", digits=7)


def _staged(spark, sf):
    t, pool = _pool(spark, sf)
    pool = stage(pool)
    # rounding makes ranks independent of the last bit of a floating sum
    df = rounded(final.normalize_weight(pool, FINAL), "weighted_score", digits=7)
    return t, pool, df


def dedup_query(spark, sf):
    _, _, df = _staged(spark, sf)
    return final.dedup_best_logic(df, FINAL)


def stock_query(spark, sf):
    t, _, df = _staged(spark, sf)
    return final.stock_and_sale_filter(final.dedup_best_logic(df, FINAL), t, FINAL)


def exclusion_query(spark, sf):
    t, _, df = _staged(spark, sf)
    df = final.stock_and_sale_filter(final.dedup_best_logic(df, FINAL), t, FINAL)
    return final.recent_purchase_exclusion(df, t, FINAL, AS_OF)


def _capped(t, df):
    df = final.stock_and_sale_filter(final.dedup_best_logic(df, FINAL), t, FINAL)
    df = final.recent_purchase_exclusion(df, t, FINAL, AS_OF)
    return final.diversity_cap(df, FINAL)


def cap_query(spark, sf):
    t, _, df = _staged(spark, sf)
    return _capped(t, df)


def final_query(spark, sf):
    t, _, df = _staged(spark, sf)
    return final.final_topn(_capped(t, df), FINAL)


def quality_query(spark, sf):
    t, pool, df = _staged(spark, sf)
    result = final.final_topn(_capped(t, df), FINAL)
    return final.reco_quality_report(pool, result, t, FINAL, AS_OF)


def run_reco_query(spark, sf):
    """All fifteen logics, the learned ones included, to the final list."""
    t = views(spark, sf, *WEB)
    cfg = C.RecoConfig(
        repurchase=REPURCHASE,
        item_cooccurrence=COOC,
        basket_association=BASKET,
        user_based_cf=CF,
        ml_purchase_probability=PROBABILITY,
        time_seasonality=SEASON,
        bandit_optimization=BANDIT,
    )
    return rounded(final.run_reco(t, cfg, AS_OF), "weighted_score", digits=6)


def features_query(spark, sf):
    t = views(spark, sf, *WEB)
    df = learned.ml_features(t, PROBABILITY, AS_OF)
    df = df.withColumn("last_purchase_time", F.unix_seconds("last_purchase_time"))
    return rounded(df, "avg_dwell_seconds", "total_amount", digits=4)


def scores_query(spark, sf):
    t = views(spark, sf, "purchases", "weblog")
    scores = (
        t["weblog"]
        .groupBy("member_id", "category_id")
        .agg((F.count("*") / F.lit(1000.0)).alias("purchase_probability"))
    )
    return rounded(learned.scores_to_candidates(t, PROBABILITY, AS_OF, scores), "score")


def interactions_query(spark, sf):
    return learned.interactions(views(spark, sf, "purchases"), CF, AS_OF)


def ratings_query(spark, sf):
    rows = learned.interactions(views(spark, sf, "purchases"), CF, AS_OF)
    return rounded(learned.ratings(rows).select("member_id", "product_id", "rating"), "rating")


def biases_query(spark, sf):
    rated = stage(learned.ratings(learned.interactions(views(spark, sf, "purchases"), CF, AS_OF)))
    users, items = factors.shrunk_biases(rated, "member_id", "product_id", rounds=2)
    users = users.select(F.lit("member").alias("kind"), F.col("member_id").alias("id"), F.col("user_bias").alias("bias"))
    items = items.select(F.lit("product").alias("kind"), F.col("product_id").alias("id"), F.col("item_bias").alias("bias"))
    return rounded(users.unionByName(items), "bias")


def best_unowned_query(spark, sf):
    """Factors taken from customers and parts, whole numbers so that every engine scores them alike."""
    t = read_tables(spark, sf, ("customer", "part", "orders", "lineitem"))
    number = lambda c: F.floor(c).cast("double")
    users = t["customer"].select(
        F.col("c_custkey").alias("u"),
        F.array(
            number(F.col("c_nationkey") - 12), number(F.col("c_acctbal").cast("double") / 1000), F.lit(1.0)
        ).alias("vector"),
    )
    items = t["part"].select(
        F.col("p_partkey").alias("i"),
        F.col("p_partkey").cast("string").alias("name"),
        F.array(
            number(F.col("p_size")), number(F.col("p_retailprice").cast("double") / 50), number(F.col("p_partkey") % 64)
        ).alias("vector"),
    )
    owned = t["orders"].join(t["lineitem"], F.col("o_orderkey") == F.col("l_orderkey"))
    owned = owned.select(F.col("o_custkey").alias("u"), F.col("l_partkey").alias("i"))
    return factors.best_unowned(users, items, owned, 10, block=256).drop("name")


def probability_query(spark, sf):
    t = views(spark, sf, *WEB)
    return rounded(learned.purchase_probability(t, PROBABILITY, AS_OF), "purchase_probability", digits=4)


def _counts(name, rows):
    """``(logic, metric, value)`` rows from a frame of one row of counts."""
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("bigint").alias("value")) for c in rows.columns])
    return rows.select(F.lit(name).alias("logic"), F.explode(pairs).alias("p")).select("logic", "p.metric", "p.value")


def _list_counts(name, rows, owned):
    """Faults of ranked lists: gaps in ranks, repeated or owned products, scores out of range; members served."""
    rows = stage(rows)
    per_member = rows.groupBy("key_value").agg(
        F.count("*").alias("n"), F.max("rank_in_logic").alias("last"), F.count_distinct("product_id").alias("products")
    )
    lists = per_member.agg(
        F.count("*").alias("members"),
        F.count_if(F.col("n") != F.col("last")).alias("rank_gaps"),
        F.count_if(F.col("n") != F.col("products")).alias("repeats"),
        F.count_if(F.col("n") > 10).alias("too_long"),
    )
    scores = rows.agg(F.count_if(~F.col("score").between(0, 1)).alias("bad_scores"))
    own = rows.join(owned, ["key_value", "product_id"], "left_semi").agg(F.count("*").alias("owned"))
    return _counts(name, lists).unionByName(_counts(name, scores)).unionByName(_counts(name, own))


def cf_properties(spark, sf):
    t = {"purchases": views(spark, sf, "sales")["sales"]}
    owned = learned.interactions(t, CF, AS_OF).select(F.col("member_id").alias("key_value"), "product_id")
    return _list_counts("user_based_cf", learned.user_based_cf(t, CF, AS_OF), owned)


def probability_properties(spark, sf):
    t = views(spark, sf, *WEB)
    chance = learned.purchase_probability(t, PROBABILITY, AS_OF).agg(
        F.count("*").alias("rows"),
        F.count_distinct("member_id").alias("members"),
        F.count_if(~F.coalesce(F.col("purchase_probability").between(0, 1), F.lit(False))).alias("bad_scores"),
    )
    return _counts("purchase_probability", chance)


def rfm_query(spark, sf):
    """Quintiles where some buyers have no amounts and some purchases no member."""
    sold = views(spark, sf, "purchases")["purchases"]
    number = F.col("member_id").cast("int")
    sold = sold.withColumn("amount", F.when(number % 7 != 0, F.col("amount")))
    sold = sold.withColumn("member_id", F.when(number % 50 != 1, F.col("member_id")))
    return stages.rfm_scores({"purchases": sold}, RFM, AS_OF)


def _pairs(spark, sf):
    t = views(spark, sf, "sales")
    return rounded(
        association.basket_pairs({"purchases": t["sales"]}, BASKET, AS_OF), "support", "confidence", "lift"
    )


QUERIES = {
    "L01_bestseller_overall": _logic(bestsellers.bestseller_overall, C.BestsellerConfig(), "sales", "clicks"),
    "L02_bestseller_category": _logic(bestsellers.bestseller_category, C.LogicConfig(), "purchases", "weblog"),
    "L03_bestseller_brand": _logic(bestsellers.bestseller_brand, C.LogicConfig(), "purchases", "weblog"),
    "L04_browsing_history": _logic(behaviour.browsing_history, C.BrowsingConfig(), "clicks"),
    "L05_cart_favorite": _logic(behaviour.cart_favorite, C.LogicConfig(), "sales", "clicks"),
    "L06_repurchase": _logic(behaviour.repurchase, REPURCHASE, "sales"),
    "L07_item_cooccurrence": _logic(association.item_cooccurrence, COOC, "sales", "clicks"),
    "L08_basket_association": _logic(association.basket_association, BASKET, "sales"),
    "L08_basket_pairs": _pairs,
    "L08_basket_pairs_dense": _dense,
    "L09_attribute_fit": _logic(bestsellers.attribute_fit, C.LogicConfig(), "sales", "members"),
    "L10_rfm_stage": _logic(stages.rfm_stage, RFM, "sales"),
    "L10_rfm_scores": rfm_query,
    "L11_ml_purchase_probability": _logic(learned.ml_purchase_probability, PROBABILITY, *WEB),
    "L12a_user_based_cf": _logic(learned.user_based_cf, CF, "sales"),
    "L12a_user_based_cf_properties": cf_properties,
    "K02_purchase_probability_properties": probability_properties,
    "L12b_user_based_cf_jaccard": _logic(association.user_based_cf_jaccard, JACCARD, "sales"),
    "L13_attribute_similarity": _logic(
        similarity.attribute_similarity, C.SimilarityConfig(), "products", "sales", "clicks"
    ),
    "L14_time_seasonality": _logic(bestsellers.time_seasonality, SEASON, "products", "sales", "clicks"),
    "L15_bandit_optimization": _logic(stages.bandit_optimization, BANDIT, "impressions", "clicks"),
    "L16_candidate_pool": pool_query,
    "L17_normalize_weight": weighted_query,
    "L18_dedup_best_logic": dedup_query,
    "L19_stock_and_sale_filter": stock_query,
    "L20_recent_purchase_exclusion": exclusion_query,
    "L21_diversity_cap": cap_query,
    "L22_final_topn": final_query,
    "L22_run_reco": run_reco_query,
    "L23_reco_quality_report": quality_query,
    "K01_ml_features": features_query,
    "K02_purchase_probability": probability_query,
    "K03_scores_to_candidates": scores_query,
    "K04_interactions": interactions_query,
    "K05_ratings": ratings_query,
    "K06_biases": biases_query,
    "K06_best_unowned": best_unowned_query,
}

# ---------------------------------------------------------------- oracles

ACTIVE_30 = f"(select distinct member_id as key_value from weblog where {win(30)})"


def _first(n: int, select: str, rank: str, source: str, by: str = "") -> str:
    part = f"partition by {by} " if by else ""
    return f"""select * from (select {select}, row_number() over ({part}order by {rank}) as rank_in_logic
               from {source}) r where rank_in_logic <= {n}"""


def _favourite(group: str, logic: str, reason: str) -> str:
    body = f"""
        with liked as (
            select member_id as key_value, {group} as g, count(*) as views from weblog
            where {win(30)} and {group} is not null group by 1, 2
            qualify row_number() over (partition by key_value order by views desc, g) <= 3),
        sold as (
            select {group} as g, product_id, sum(amount) as total from purchases
            where {win(30)} group by 1, 2
            qualify row_number() over (partition by g order by total desc, product_id) <= 10)
        select key_value, product_id,
               row_number() over (partition by key_value order by total desc, product_id) as rank_in_logic
        from liked join sold using (g)
        qualify rank_in_logic <= 10"""
    return candidate_sql(body, "member_id", logic, "1.0 / rank_in_logic", f"'{reason}'")


OVERALL = candidate_sql(
    f"""with top as (
            select product_id,
                   sum(cast(amount as double)
                       * power(0.5, epoch({NOW} - ts) / (14 * 86400.0))) as decayed
            from sales where {win(30)} group by product_id
            order by decayed desc, product_id limit 10)
        select key_value, product_id, decayed / (select max(decayed) from top) as score,
               row_number() over (partition by key_value order by decayed desc, product_id) as rank_in_logic
        from (select distinct member_id as key_value from clicks where {win(30)}) cross join top""",
    "member_id",
    "bestseller_overall",
    "score",
    "'overall_bestseller'",
)
BROWSING = candidate_sql(
    f"""select cookie as key_value, product_id,
               row_number() over (partition by cookie
                   order by count(*) desc, floor(epoch(max(ts))) desc, product_id) as rank_in_logic
        from weblog where {win(7)} and event_type in ('view', 'pageview')
        group by cookie, product_id qualify rank_in_logic <= 10""",
    "cookie",
    "browsing_history",
    "1.0 / rank_in_logic",
    "'recently_viewed'",
)
CART_FAVORITE = candidate_sql(
    f"""with marked as (
            select member_id as key_value, product_id, floor(epoch(ts)) as seen_at,
                   if(event_type = 'cart_add', 2, 1) as w
            from weblog where {win(30)} and event_type in ('cart_add', 'favorite_add'))
        select key_value, product_id, max(w) as weight,
               row_number() over (partition by key_value
                   order by max(w) desc, max(seen_at) desc, product_id) as rank_in_logic
        from marked
        where (key_value, product_id) not in (
            select (member_id, product_id) from purchases where {win(30)})
        group by key_value, product_id qualify rank_in_logic <= 10""",
    "member_id",
    "cart_favorite",
    "weight / 2.0",
    "'cart_or_favorite'",
)
REPURCHASE_SQL = candidate_sql(
    f"""with gaps as (
            select member_id as key_value, product_id, ts,
                   epoch(ts) - epoch(lag(ts) over (partition by member_id, product_id order by ts)) as gap
            from purchases where {win(YEARS)}),
        due as (
            select key_value, product_id,
                   epoch({NOW} - max(ts)) / 86400.0 - avg(gap / 86400.0) as past_due
            from gaps where gap is not null group by all having count(*) + 1 >= 2)
        select key_value, product_id,
               row_number() over (partition by key_value order by past_due desc, product_id) as rank_in_logic
        from due where past_due > -30 qualify rank_in_logic <= 10""",
    "member_id",
    "repurchase",
    "1.0 / rank_in_logic",
    "'repurchase_timing'",
)
COOC_SQL = candidate_sql(
    f"""with touched as (
            select key_value, product_id, max(seen_at) as seen_at from (
                select member_id as key_value, product_id, floor(epoch(ts)) as seen_at
                from purchases where {win(YEARS)}
                union all
                select member_id, product_id, floor(epoch(ts)) from weblog where {win(YEARS)})
            group by all),
        partners as (
            select a.product_id as base, b.product_id as partner, count(*) as n
            from touched a join touched b on a.key_value = b.key_value and a.product_id <> b.product_id
            group by 1, 2 having count(*) >= 2
            qualify row_number() over (partition by base order by n desc, partner) <= 5)
        select key_value, partner as product_id,
               row_number() over (partition by key_value
                   order by max(n) desc, max(seen_at) desc, partner) as rank_in_logic
        from touched join partners on product_id = base
        group by key_value, partner qualify rank_in_logic <= 10""",
    "member_id",
    "item_cooccurrence",
    "1.0 / rank_in_logic",
    "'bought_viewed_together'",
)


def _pairs_sql(item: str, source: str, support: int, lift: float) -> str:
    return f"""
        with items as (select distinct order_id, {item} as item from {source} where {win(YEARS)}),
        total as (select count(distinct order_id) as baskets from items),
        single as (select item, count(*) as n from items group by item),
        pairs as (
            select a.item as base_id, b.item as assoc_id, count(*) as overlap
            from items a join items b on a.order_id = b.order_id and a.item <> b.item
            group by all having count(*) >= {support})
        select base_id, assoc_id, overlap, overlap / baskets as support,
               overlap / x.n as confidence,
               (overlap / baskets) / ((x.n / baskets) * (y.n / baskets)) as lift
        from pairs cross join total
             join single x on x.item = base_id join single y on y.item = assoc_id
        where (overlap / baskets) / ((x.n / baskets) * (y.n / baskets)) >= {lift}"""


def _round_pairs(body: str) -> str:
    return f"""select base_id, assoc_id, overlap, round(support, 8) as support,
                      round(confidence, 8) as confidence, round(lift, 8) as lift from ({body}) p"""


BASKET_SQL = candidate_sql(
    f"""with rules as ({_pairs_sql("product_id", "purchases", 2, 1.2)}),
        found as (
            select member_id as key_value, assoc_id as product_id, max(lift) as lift
            from (select distinct member_id, product_id from purchases where {win(YEARS)})
                 join rules on base_id = product_id
            group by all)
        select key_value, product_id, lift / (select max(lift) from found) as score,
               row_number() over (partition by key_value order by lift desc, product_id) as rank_in_logic
        from found qualify rank_in_logic <= 10""",
    "member_id",
    "basket_association",
    "score",
    "'basket_association'",
)
FIT = candidate_sql(
    f"""with best as (
            select gender, age_band, product_id, sum(amount) as total,
                   row_number() over (partition by gender, age_band
                       order by sum(amount) desc, product_id) as rank_in_logic
            from purchases join members using (member_id) where {win(30)}
            group by gender, age_band, product_id qualify rank_in_logic <= 10)
        select member_id as key_value, product_id, rank_in_logic
        from members join best using (gender, age_band)
        where not exists (select 1 from purchases p
                          where p.member_id = members.member_id
                            and p.product_id = best.product_id and {win(30, ts="p.ts")})""",
    "member_id",
    "attribute_fit",
    "1.0 / rank_in_logic",
    "'attribute_segment_fit'",
)
RFM_SQL = f"""
    with base as (
        select member_id as key_value, epoch({NOW} - max(ts)) / 86400.0 as recency,
               count(distinct order_id) as frequency, cast(sum(amount) as double) as monetary
        from purchases where {win(365)} group by member_id),
    scored as (
        select key_value,
               ntile(5) over (order by recency nulls last, coalesce(md5(key_value), '')) as r_score,
               ntile(5) over (order by frequency desc nulls last, coalesce(md5(key_value), '')) as f_score,
               ntile(5) over (order by monetary desc nulls last, coalesce(md5(key_value), '')) as m_score
        from base)
    select *, case when greatest(r_score, f_score, m_score) <= 2 then 'loyal'
                   when r_score > 3 and f_score < 3 then 'at_risk'
                   when r_score > 3 and f_score > 3 then 'dormant'
                   else 'regular' end as stage
    from scored"""
RFM_STAGE_SQL = candidate_sql(
    f"""select key_value, product_id, rank_in_logic, stage
        from ({RFM_SQL}) s cross join (
            {_first(10, "product_id", "total desc, product_id",
                    f"(select product_id, sum(amount) as total from purchases where {win(365)} group by product_id)")}) t""",
    "member_id",
    "rfm_stage",
    "1.0 / rank_in_logic",
    "'rfm_stage_' || stage",
)
JACCARD_SQL = candidate_sql(
    f"""with has as (select distinct member_id as u, product_id as p from purchases where {win(YEARS)}),
        size as (select u, count(*) as n from has group by u),
        near as (
            select a.u as target, b.u as neighbour,
                   count(*) / (any_value(x.n) + any_value(y.n) - count(*)) as jaccard
            from has a join has b on a.p = b.p and a.u <> b.u
                 join size x on x.u = a.u join size y on y.u = b.u
            group by 1, 2 having count(*) >= 3
            qualify row_number() over (partition by target order by jaccard desc, neighbour) <= 20),
        found as (
            select target as key_value, p as product_id,
                   cast(sum(cast(jaccard as decimal(20, 16))) as double) as total
            from near join has on has.u = neighbour
            where (target, p) not in (select (u, p) from has)
            group by all)
        select key_value, product_id, total / (select max(total) from found) as score,
               row_number() over (partition by key_value order by total desc, product_id) as rank_in_logic
        from found qualify rank_in_logic <= 10""",
    "member_id",
    "user_based_cf",
    "score",
    "'similar_user_purchased'",
)
SIMILARITY_SQL = candidate_sql(
    f"""with last3 as (
            select member_id as key_value, product_id as base from weblog where {win(30)}
            group by 1, 2
            qualify row_number() over (partition by key_value
                        order by floor(epoch(max(ts))) desc, base) <= 3),
        scored as (
            select key_value, c.product_id,
                   max(0.4 + if(c.brand_id = b.brand_id, 0.3, 0)
                       + if(c.gender_target = b.gender_target, 0.1, 0)
                       + if(abs(c.price - b.price) / b.price <= 0.2, 0.2, 0)) as score
            from last3 join products b on b.product_id = base
                 join products c on c.category_id = b.category_id and c.product_id <> base
            group by all)
        select key_value, product_id, score,
               row_number() over (partition by key_value order by score desc, product_id) as rank_in_logic
        from scored
        where (key_value, product_id) not in (
            select (member_id, product_id) from purchases where {win(30)})
        qualify rank_in_logic <= 10""",
    "member_id",
    "attribute_similarity",
    "score",
    "'similar_attribute_substitute'",
)
SEASON_SQL = candidate_sql(
    f"""select key_value, product_id, rank_in_logic from {ACTIVE_30} cross join (
            {_first(10, "product_id", "total desc, product_id",
                    f'''(select s.product_id, sum(amount) as total
                         from purchases s join products m on s.product_id = m.product_id
                         where {win(365)} and m.category_id in ('PROMO', 'SMALL')
                         group by s.product_id)''')}) t""",
    "member_id",
    "time_seasonality",
    "1.0 / rank_in_logic",
    "'seasonal_bestseller'",
)
BANDIT_SQL = candidate_sql(
    f"""with stats as (
            select product_id, count(*) filter (event_type = 'impression') as shown,
                   count(*) filter (event_type = 'purchase') as bought
            from impressions where {win(30)} group by product_id),
        arms as (
            (select product_id, 'exploit' as arm, bought / greatest(shown, 1) as rate
             from stats where shown >= 20 order by rate desc, product_id limit 8)
            union all
            (select product_id, 'explore', 0 from stats where shown < 20
             order by md5(product_id || '|42'), product_id limit 2)),
        ranked as (
            select *, row_number() over (order by arm = 'explore', rate desc, product_id) as rank_in_logic
            from arms)
        select key_value, product_id, rank_in_logic, arm,
               if(arm = 'exploit', greatest(rate, 0.01), 0.01) as score
        from {ACTIVE_30} cross join ranked""",
    "member_id",
    "bandit_optimization",
    "score",
    "'bandit_' || arm",
)
CATEGORY_SQL = _favourite("category_id", "bestseller_category", "category_bestseller")
BRAND_SQL = _favourite("brand_id", "bestseller_brand", "brand_bestseller")
POOL_SQL = " union all ".join(
    f"select * from ({s}) u"
    for s in [
        OVERALL,
        CATEGORY_SQL,
        BRAND_SQL,
        BROWSING,
        CART_FAVORITE,
        REPURCHASE_SQL,
        COOC_SQL,
        BASKET_SQL,
        FIT,
        RFM_STAGE_SQL,
        JACCARD_SQL,
        SIMILARITY_SQL,
        SEASON_SQL,
    ]
)
WEIGHT_ROWS = ", ".join(f"('{k}', {v})" for k, v in C.LOGIC_WEIGHTS.items())
WEIGHTED_SQL = f"""
    with pool as materialized ({POOL_SQL})
    select key_type, key_value, pool.logic_name, product_id, reco_reason,
           round((score - low) / greatest(high - low, 0.000001) * weight, 7) as weighted_score
    from pool
         join (select logic_name, min(score) as low, max(score) as high
               from pool group by logic_name) span using (logic_name)
         join (values {WEIGHT_ROWS}) w(logic_name, weight) using (logic_name)"""
DEDUP_SQL = f"""
    select * from ({WEIGHTED_SQL}) w
    qualify row_number() over (partition by key_value, product_id
                order by weighted_score desc, logic_name, key_type) = 1"""
STOCK_SQL = f"""
    select d.*, category_id, brand_id from ({DEDUP_SQL}) d join products using (product_id)
    where sale_status = 'on_sale' and stock_qty > 0"""
EXCLUDED_SQL = f"""
    select * from ({STOCK_SQL}) s
    where (key_value, product_id) not in (
        select (member_id, product_id) from purchases where {win(30)})"""
CAPPED_SQL = f"""
    select * from (
        select *, row_number() over (partition by key_value, category_id
                      order by weighted_score desc, product_id) as category_rank,
               row_number() over (partition by key_value, brand_id
                      order by weighted_score desc, product_id) as brand_rank
        from ({EXCLUDED_SQL}) e) r
    where category_rank <= 3 and brand_rank <= 2"""
FINAL_SQL = f"""
    select key_type, key_value,
           row_number() over (partition by key_value order by weighted_score desc, product_id) as final_rank,
           product_id, category_id, brand_id, logic_name as adopted_logic, reco_reason, weighted_score
    from ({CAPPED_SQL}) c qualify final_rank <= 5"""
QUALITY_SQL = f"""
    with pool as materialized ({POOL_SQL}), fin as materialized ({FINAL_SQL})
    select 'candidate_rows' as metric, count(*) as value from pool
    union all select 'null_keys', count(*) from pool where coalesce(key_value, '') = ''
    union all select 'unweighted_rows', 0
    union all select 'final_rows', count(*) from fin
    union all select 'duplicate_pairs', count(*) from
        (select 1 from fin group by key_value, product_id having count(*) > 1)
    union all select 'owned_rows', count(*) from fin
        where (key_value, product_id) in (
            select (member_id, product_id) from purchases where {win(30)})
    union all select 'unsellable_rows', count(*) from fin join products using (product_id)
        where sale_status <> 'on_sale' or stock_qty <= 0
    union all select 'category_cap_breaks', count(*) from
        (select 1 from fin group by key_value, category_id having count(*) > 3)
    union all select 'brand_cap_breaks', count(*) from
        (select 1 from fin group by key_value, brand_id having count(*) > 2)
    union all select 'top_n_breaks', count(*) from
        (select 1 from fin group by key_value having count(*) > 5)"""
FEATURES_SQL = f"""
    select member_id, gender, age_band, member_rank,
           coalesce(pv_count, 0) as pv_count, coalesce(session_count, 0) as session_count,
           coalesce(cats, 0) as distinct_category_count, coalesce(brands, 0) as distinct_brand_count,
           round(coalesce(dwell, 0), 4) as avg_dwell_seconds,
           coalesce(n_orders, 0) as purchase_count,
           round(cast(coalesce(spent, 0) as double), 4) as total_amount,
           cast(last_at as bigint) as last_purchase_time
    from members left join (
        select i.member_id, count(*) as pv_count, count(distinct session_id) as session_count,
               count(distinct category_id) as cats, count(distinct brand_id) as brands,
               avg(dwell_seconds) as dwell
        from weblog w join id_mapping i on i.cookie = w.cookie
        where {win(90)} group by i.member_id) using (member_id)
    left join (
        select member_id, count(distinct order_id) as n_orders, sum(amount) as spent,
               floor(epoch(max(ts))) as last_at
        from purchases where {win(90)} group by member_id) using (member_id)"""
SCORES_SQL = candidate_sql(
    f"""with scores as (
            select member_id, category_id, count(*) / 1000.0 as p from weblog group by 1, 2
            qualify row_number() over (partition by member_id order by p desc, category_id) <= 3),
        best as (
            select category_id, product_id,
                   row_number() over (partition by category_id
                       order by sum(amount) desc, product_id) as r
            from purchases where {win(90)} group by category_id, product_id qualify r <= 3),
        ordered as (
            select *, row_number() over (partition by member_id order by p desc, category_id) as c
            from scores)
        select member_id as key_value, product_id, p,
               row_number() over (partition by member_id order by p desc, r, c, product_id) as rank_in_logic
        from ordered join best using (category_id) qualify rank_in_logic <= 10""",
    "member_id",
    "ml_purchase_probability",
    "p",
    "'ml_purchase_probability'",
)
INTERACTIONS_SQL = f"""
    select member_id, product_id, sum(quantity) as interaction_value,
           count(distinct order_id) as purchase_count
    from purchases where {win(365)} group by all having sum(quantity) > 0"""
RATINGS_SQL = f"""
    with i as ({INTERACTIONS_SQL})
    select member_id, product_id,
           round(1 + 4 * interaction_value / (select greatest(max(interaction_value), 1) from i), 8)
               as rating
    from i"""
BIASES_SQL = f"""
    with i as ({INTERACTIONS_SQL}),
    r as (
        select member_id, product_id,
               1 + 4 * cast(interaction_value as double) / (select greatest(max(interaction_value), 1) from i) as rating
        from i where member_id is not null and product_id is not null),
    d as (select member_id, product_id, rating - (select avg(rating) from r) as rest from r),
    i1 as (select product_id, sum(rest) / (count(*) + 10) as b from d group by 1),
    u1 as (select member_id, sum(rest - b) / (count(*) + 15) as b from d join i1 using (product_id) group by 1),
    i2 as (select product_id, sum(rest - b) / (count(*) + 10) as b from d join u1 using (member_id) group by 1),
    u2 as (select member_id, sum(rest - b) / (count(*) + 15) as b from d join i2 using (product_id) group by 1)
    select 'member' as kind, member_id as id, round(b, 8) as bias from u2
    union all select 'product', product_id, round(b, 8) from i2"""
BEST_UNOWNED_SQL = """
    select u, i, score, rank from (
        select c_custkey as u, p_partkey as i, score,
               cast(row_number() over (partition by c_custkey order by score desc, cast(p_partkey as varchar)) as integer)
                   as rank
        from (select c_custkey, p_partkey,
                     cast((c_nationkey - 12) * p_size
                          + floor(cast(c_acctbal as double) / 1000) * floor(cast(p_retailprice as double) / 50)
                          + p_partkey % 64 as double) as score
              from customer, part) scored
        where not exists (select 1 from orders join lineitem on o_orderkey = l_orderkey
                          where o_custkey = c_custkey and l_partkey = p_partkey)) ranked
    where rank <= 10"""

#: every member with a positive quantity in the window and a product not yet bought is served
CF_PROPERTIES = f"""
    with i as (
        select member_id, product_id from purchases
        where {win(365)} and member_id is not null and product_id is not null
        group by all having sum(quantity) > 0),
    served as (
        select count(*) as n from (select member_id, count(*) as own from i group by 1) m
        where own < (select count(distinct product_id) from i))
    select 'user_based_cf' as logic, metric, value from (
        select 'members' as metric, n as value from served
        union all select unnest(['rank_gaps', 'repeats', 'too_long', 'bad_scores', 'owned']), 0) x"""
PROBABILITY_PROPERTIES = """
    select 'purchase_probability' as logic, metric, value from (
        select 'rows' as metric, count(*) as value from members
        union all select 'members', count(distinct member_id) from members
        union all select 'bad_scores', 0) x"""

ORACLES = {
    "L01_bestseller_overall": OVERALL,
    "L02_bestseller_category": CATEGORY_SQL,
    "L03_bestseller_brand": BRAND_SQL,
    "L04_browsing_history": BROWSING,
    "L05_cart_favorite": CART_FAVORITE,
    "L06_repurchase": REPURCHASE_SQL,
    "L07_item_cooccurrence": COOC_SQL,
    "L08_basket_association": BASKET_SQL,
    "L08_basket_pairs": _round_pairs(_pairs_sql("product_id", "sales", 2, 1.2)),
    "L08_basket_pairs_dense": _round_pairs(_pairs_sql("supplier_id", "sales", 20, 1.0)),
    "L09_attribute_fit": FIT,
    "L10_rfm_stage": RFM_STAGE_SQL,
    "L10_rfm_scores": RFM_SQL.replace(
        "from purchases",
        """from (select * replace (if(cast(member_id as integer) % 7 <> 0, amount, null) as amount,
                                   if(cast(member_id as integer) % 50 <> 1, member_id, null) as member_id)
                 from purchases) n""",
    ),
    "L12b_user_based_cf_jaccard": JACCARD_SQL,
    "L12a_user_based_cf_properties": CF_PROPERTIES,
    "K02_purchase_probability_properties": PROBABILITY_PROPERTIES,
    "L13_attribute_similarity": SIMILARITY_SQL,
    "L14_time_seasonality": SEASON_SQL,
    "L15_bandit_optimization": BANDIT_SQL,
    "L16_candidate_pool": POOL_SQL,
    "L17_normalize_weight": WEIGHTED_SQL,
    "L18_dedup_best_logic": DEDUP_SQL,
    "L19_stock_and_sale_filter": STOCK_SQL,
    "L20_recent_purchase_exclusion": EXCLUDED_SQL,
    "L21_diversity_cap": CAPPED_SQL,
    "L22_final_topn": FINAL_SQL,
    "L23_reco_quality_report": QUALITY_SQL,
    "K01_ml_features": FEATURES_SQL,
    "K03_scores_to_candidates": SCORES_SQL,
    "K04_interactions": INTERACTIONS_SQL,
    "K05_ratings": RATINGS_SQL,
    "K06_biases": BIASES_SQL,
    "K06_best_unowned": BEST_UNOWNED_SQL,
}
ORACLES = {k: with_views(v) for k, v in ORACLES.items()}
