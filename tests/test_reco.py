"""Properties of the recommendation plans, and the learned logics."""

import math
import random

import pytest
from pyspark.sql import functions as F

from registry import reco
from registry.common import AS_OF, views
from storelens import config as C
from storelens.plans.reco import association, final, learned, similarity
from storelens.plans.reco.base import CANDIDATE_SCHEMA

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["L02_bestseller_category", "L07_item_cooccurrence", "L12a_user_based_cf"])
def test_candidates_keep_the_contract(spark, name):
    df = reco.QUERIES[name](spark, SF)
    assert [f.name for f in df.schema] == [f.name for f in CANDIDATE_SCHEMA]
    rows = df.collect()
    assert rows
    by_key = {}
    for r in rows:
        assert r.key_value and r.product_id and math.isfinite(r.score)
        by_key.setdefault(r.key_value, []).append(r.rank_in_logic)
    assert all(sorted(v) == list(range(1, len(v) + 1)) and len(v) <= 10 for v in by_key.values())


def test_matrix_factorisation_leaves_owned_products_out(spark):
    t = views(spark, SF, "purchases")
    out = learned.user_based_cf(t, reco.CF, AS_OF)
    own = learned.interactions(t, reco.CF, AS_OF).select(
        F.col("member_id").alias("key_value"), "product_id"
    )
    assert out.join(own, ["key_value", "product_id"]).count() == 0
    low, high = out.agg(F.min("score"), F.max("score")).first()
    assert 0.2 <= low <= high <= 1.0


def test_mean_does_not_depend_on_the_order_of_rows(spark):
    values = [random.Random(n).randrange(20_000) / 100 for n in range(999)]
    want = math.fsum(values) / len(values)
    for seed in range(3):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame([(v,) for v in [*values, None]], "x double").repartition(5)
        assert df.agg(learned._mean("x")).first()[0] == want
    assert df.filter("x is null").agg(learned._mean("x")).first()[0] is None
    odd = spark.createDataFrame([(float("inf"),), (1.5,)], "x double")
    assert odd.agg(learned._mean("x")).first()[0] == math.inf


def test_blocks_of_the_factorisation_follow_the_ratings(spark, monkeypatch):
    assert [learned.factor_blocks(n) for n in (0, 10 << 18, (10 << 18) + 1, 60 << 18)] == [10, 10, 11, 60]
    asked = []

    class Stopped(Exception):
        pass

    def factorise(**given):
        asked.append((given["numUserBlocks"], given["numItemBlocks"]))
        raise Stopped

    monkeypatch.setattr(learned, "ALS", factorise)
    monkeypatch.setattr(learned, "BLOCK_RATINGS", 20)
    t = {"purchases": views(spark, SF, "purchases")["purchases"]}
    n = learned.interactions(t, reco.CF, AS_OF).count()
    with pytest.raises(Stopped):
        learned.user_based_cf(t, reco.CF, AS_OF)
    assert asked == [(-(-n // 20),) * 2] and asked[0][0] > 10


def test_matrix_factorisation_of_nothing(spark):
    t = {"purchases": views(spark, SF, "purchases")["purchases"].limit(0)}
    out = learned.user_based_cf(t, reco.CF, AS_OF)
    assert out.count() == 0 and out.schema == CANDIDATE_SCHEMA


def test_probability_with_a_later_label(spark):
    t = views(spark, SF, *reco.WEB)
    cfg = C.ProbabilityConfig(lookback_days=60, prediction_window_days=15, max_iter=3)
    p = learned.purchase_probability(t, cfg, AS_OF)
    low, high, n = p.agg(F.min("purchase_probability"), F.max("purchase_probability"), F.count("*")).first()
    assert 0 <= low <= high <= 1 and n == t["members"].count()


def test_final_list_properties(spark):
    out = reco.run_reco_query(spark, SF)
    report = {
        r.metric: r.value
        for r in final.reco_quality_report(
            reco.pool_query(spark, SF), out, views(spark, SF, "products", "purchases"), C.FinalConfig(), AS_OF
        ).collect()
    }
    assert report["final_rows"] > 0
    for check in ("null_keys", "duplicate_pairs", "unsellable_rows", "category_cap_breaks",
                  "brand_cap_breaks", "top_n_breaks"):
        assert report[check] == 0, check


def test_key_type_can_separate_lists(spark):
    pool = spark.createDataFrame(
        [("member_id", "1", "browsing_history", "p", 1.0, 1, "r"),
         ("cookie", "1", "browsing_history", "p", 1.0, 1, "r")],
        CANDIDATE_SCHEMA,
    )
    weighted = final.normalize_weight(pool, C.FinalConfig())
    assert final.dedup_best_logic(weighted, C.FinalConfig()).count() == 1
    assert final.dedup_best_logic(weighted, C.FinalConfig(include_key_type=True)).count() == 2


def similar_by_hand(products, base, need, tol):
    b = products[base]

    def score(c):
        off = abs(c[3] - b[3]) / b[3] if b[3] else None
        return round(
            0.4 + 0.3 * (b[1] is not None and b[1] == c[1]) + 0.1 * (b[2] is not None and b[2] == c[2])
            + 0.2 * (off is not None and off <= tol), 6)

    found = [(-score(c), p) for p, c in products.items() if p != base and c[0] == b[0]]
    return [(p, -s) for s, p in sorted(found)[:need]]


@pytest.mark.parametrize("seed", range(2))
def test_similar_products_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    products = {
        f"p{i:03d}": (
            rng.choice(["c1", "c1", "c2"]),
            rng.choice(["b1", "b2", None]),
            rng.choice(["0", "1"]),
            rng.choice([0.0, 100.0, 100.0, 120.0, 80.0, 125.0, round(rng.uniform(50, 200), 2)]),
        )
        for i in range(160)
    }
    df = spark.createDataFrame(
        [(p, *v) for p, v in products.items()],
        "product_id string, category_id string, brand_id string, gender_target string, price double",
    )
    needs = {p: rng.choice([1, 5, 40]) for p in rng.sample(sorted(products), 25)}
    bases = spark.createDataFrame(list(needs.items()), "base_id string, need long")
    got = {}
    for r in similarity.similar_products(df, bases, 0.2).orderBy("base_id", "r").collect():
        got.setdefault(r.base_id, []).append((r.product_id, r.score))
    for base, need in needs.items():
        assert got.get(base, []) == similar_by_hand(products, base, need, 0.2), base


def jaccard_by_hand(rows, low, neighbours, top):
    has = {}
    for u, p in rows:
        has.setdefault(u, set()).add(p)
    totals = {}
    for u, own in has.items():
        near = sorted(
            (-len(own & other) / len(own | other), v)
            for v, other in has.items()
            if v != u and len(own & other) >= low
        )[:neighbours]
        for j, v in near:
            for p in has[v] - own:
                totals.setdefault(u, {}).setdefault(p, []).append(-j)
    sums = {u: {p: round(math.fsum(js), 9) for p, js in d.items()} for u, d in totals.items()}
    best = max(x for d in sums.values() for x in d.values())
    return {
        (u, p): (rank, round(s / best, 6))
        for u, d in sums.items()
        for rank, (s, p) in enumerate(sorted((-s, p) for p, s in d.items())[:top], start=1)
        for s in [-s]
    }


@pytest.mark.parametrize("heavy", [4, 60, 1_000])
def test_jaccard_equals_brute_force(spark, monkeypatch, heavy):
    """With a low limit one neighbour, or several, take the way of heavy ones."""
    monkeypatch.setattr(association, "HEAVY_NEIGHBOUR", heavy)
    monkeypatch.setattr(association, "NEIGHBOUR_PART", 7)
    rng = random.Random(heavy)
    rows = {(f"u{rng.randrange(25)}", f"p{rng.randrange(60):02d}") for _ in range(260)}
    rows |= {("hot", f"p{i:02d}") for i in range(0, 70)} | {(f"u{i}", "p00") for i in range(25)}
    df = spark.createDataFrame(sorted(rows), "member_id string, product_id string")
    t = {"purchases": df.withColumn("ts", F.lit("2024-01-29 00:00:00").cast("timestamp"))}
    cfg = C.UserCfConfig(min_common_products=3, max_similar_users=5, top_n=6)
    got = {
        (r.key_value, r.product_id): (r.rank_in_logic, round(r.score, 6))
        for r in association.user_based_cf_jaccard(t, cfg, AS_OF).collect()
    }
    assert got == jaccard_by_hand(rows, 3, 5, 6)
