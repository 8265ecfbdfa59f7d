"""Registered queries against their SQL; all of them with STORELENS_ALL=1."""

import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

HOME = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(HOME / "checks"))

import __spark_entry__ as entry
from compare import check
from storelens.sources.views import TABLES

SF = os.environ.get("STORELENS_SF", "/root/testdata/sf0.001")
QUICK = [
    "L01_bestseller_overall",
    "L02_bestseller_category",
    "L05_cart_favorite",
    "L06_repurchase",
    "L08_basket_pairs",
    "L09_attribute_fit",
    "L10_rfm_scores",
    "L13_attribute_similarity",
    "L14_time_seasonality",
    "L15_bandit_optimization",
    "L22_final_topn",
    "K01_ml_features",
    "M01_prepare_web_events",
    "M02_classify_source_medium",
    "M03_sessionize_weblog",
    "M17_push_send_list",
    "N1_base_feed",
    "N3a_feed_google_merchant",
    "N5_add_utm",
    "N7_extract_links",
    "N9_content_consistency",
    "M26_ingest_grid",
    "M27_segment_fewer_than",
    "E04_exact_ntile",
    "I01_stream_cart_sessions",
]
NAMES = sorted(entry.queries()) if os.environ.get("STORELENS_ALL") else QUICK


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    assert check(spark, con, SF, name, entry.queries()[name], entry.oracle_sql().get(name))


def test_queries_can_be_listed_without_a_session():
    code = "import __spark_entry__ as e; print('NAMES', len(e.queries()), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=HOME, capture_output=True, text=True, timeout=120)
    assert f"NAMES {len(entry.queries())} {len(entry.oracle_sql())}" in said.stdout, said.stderr


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize(
    "name", ["L01_bestseller_overall", "L13_attribute_similarity", "M13_cart_pivot", "N1_base_feed"]
)
def test_plans_have_no_cross_join(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
