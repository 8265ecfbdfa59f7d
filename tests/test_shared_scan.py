from datetime import datetime, timedelta, timezone

import pytest

from registry import reco
from registry.common import AS_OF, views
from storelens.functions.timewin import in_window
from storelens.plans.reco import bestsellers, final
from storelens.plans.reco.shared import WindowScan, share_windows, windows_of

SF = "/root/testdata/sf0.001"
TZ = "Asia/Tokyo"


@pytest.fixture(scope="module")
def rows(spark):
    at = datetime(2024, 1, 31, tzinfo=timezone.utc)
    data = [(at - timedelta(hours=7 * k), f"m{k % 5}", f"p{k % 11}") for k in range(400)] + [(None, "m0", "p0")]
    return spark.createDataFrame(data, "ts timestamp, member_id string, product_id string")


@pytest.mark.parametrize("spec", ["-30d", "-90d", "-1d", "-7d/now", "0d/now"])
def test_a_windows_bit_gives_the_rows_of_the_window(spark, rows, spec):
    t = WindowScan({"purchases": rows, "weblog": rows}, [("-30d", TZ), ("-90d", TZ), ("-1d", TZ), ("-7d/now", TZ)], AS_OF)
    got = t.window("purchases", spec, AS_OF, TZ)
    want = in_window(rows, spec, AS_OF, TZ)
    assert got.columns == want.columns
    assert sorted(got.collect()) == sorted(want.collect()) and want.count() > 0


def test_a_column_named_like_the_mask_stays(spark, rows):
    t = WindowScan({"purchases": rows.selectExpr("*", "7 as windows0")}, [("-30d", TZ)], AS_OF)
    got = t.window("purchases", "-30d", AS_OF, TZ)
    assert got.columns[-1] == "windows0" and {r.windows0 for r in got.collect()} == {7}
    assert t.window("purchases", "-30d", AS_OF - timedelta(days=1), TZ).count() != 0  # from the given table


def test_logics_read_the_staged_rows_alone(spark):
    cfg = reco._reco_config()
    given = views(spark, SF, "products", "purchases", "members", "weblog")
    t = share_windows(given, cfg, AS_OF, reco.MERGED)
    assert len(t.bits) == len(windows_of(cfg, reco.MERGED)) < len(reco.MERGED)
    shared = bestsellers.bestseller_overall(t, cfg.bestseller_overall, AS_OF)
    plan = shared._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "o_orderkey" not in plan
    apart = bestsellers.bestseller_overall(given, cfg.bestseller_overall, AS_OF)
    key = lambda r: (r.key_value, r.rank_in_logic)
    a, b = sorted(shared.collect(), key=key), sorted(apart.collect(), key=key)
    assert [(r.key_value, r.product_id) for r in a] == [(r.key_value, r.product_id) for r in b] and a


def test_the_final_windows_need_one_shuffle(spark):
    t, _, df = reco._staged(spark, SF)
    capped = final.final_topn(final.diversity_cap(final.stock_and_sale_filter(df, t, reco.FINAL), reco.FINAL), reco.FINAL)
    plan = capped._jdf.queryExecution().executedPlan().toString()
    windows = plan[: plan.index("REPARTITION_BY_COL")]
    assert windows.count("Exchange") == 1, windows
