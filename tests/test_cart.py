"""Edge tables of the cart job."""

import json
import time
from datetime import datetime, timedelta, timezone

import pandas as pd
import pytest
from pyspark.sql import functions as F

from storelens.config import CartConfig
from storelens.plans.cart import payload, sendlist, targets, weblog
from storelens.streaming import cart_sessions

UTC = timezone.utc
CFG = CartConfig()
NOW = datetime(2024, 1, 31, 1, 30, tzinfo=UTC)  # 10:30 local time
BASE = dict(
    td_ssc_id=None, td_client_id="c1", td_global_id=None, hashedmailaddress="u1",
    td_url="https://shop.example.com/cart", td_path="/cart", td_referrer=None, td_title=None,
    td_description=None, td_ip=None, td_os=None, td_user_agent=None, td_browser=None,
    td_screen=None, td_viewport=None, items=None,
)
SCHEMA = "event_id long, ts timestamp, " + ", ".join(f"{c} string" for c in BASE)
RANGES = "lo long, hi long, country string, prefecture string, city string"


def events(spark, *rows):
    data = []
    for i, (at, change) in enumerate(rows):
        data.append((i, at, *{**BASE, **change}.values()))
    return spark.createDataFrame(data, SCHEMA)


def log_of(spark, *rows, cfg=CFG):
    ranges = spark.createDataFrame([], RANGES)
    prepared = weblog.prepare_web_events(events(spark, *rows), ranges, cfg, NOW)
    return weblog.sessionize_weblog(prepared, cfg, NOW)


def items(*ids):
    return json.dumps([{"item_id": i, "item_name": f"n{i}", "price": 5} for i in ids])


def at(hour, minute=0, second=0):
    """Local (Tokyo) time of the run day."""
    return datetime(2024, 1, 31, hour, minute, second, tzinfo=UTC) - timedelta(hours=9)


def test_item_lists_of_all_kinds_keep_the_row(spark):
    lists = [None, "broken", "[]", '{"a": 1}', items("a", "b"), '[{"item_id": 7}]']
    rows = [(at(9, i), {"items": x}) for i, x in enumerate(lists)]
    got = [
        (r.event_id, r.td_item_id, r.td_item_ord)
        for r in log_of(spark, *rows).orderBy("event_id", "td_item_ord").collect()
    ]
    assert got == [(0, None, None), (1, None, None), (2, None, None), (3, None, None),
                   (4, "a", 1), (4, "b", 2), (5, "7", 1)]


def test_bots_and_missing_clients_are_left_out(spark):
    rows = [
        (at(9), {}),
        (at(9), {"td_client_id": None}),
        (at(9), {"td_client_id": "undefined"}),
        (at(9), {"td_client_id": "00000000-0000-4000-8000-000000000000"}),
        (at(9), {"td_browser": "Googlebot-Image"}),
        (at(9), {"td_browser": "Googlebotish"}),
        (at(9), {"td_user_agent": "Mozilla/5.0 (compatible; bingbot/2.0)"}),
    ]
    assert sorted(r.event_id for r in log_of(spark, *rows).collect()) == [0, 5]


@pytest.mark.parametrize(
    "change, medium",
    [
        ({"td_url": "https://a.test/?utm_source=s&utm_medium=m"}, "s/m"),
        ({"td_url": "https://a.test/?utm_medium=m"}, "(none)/m"),
        ({"td_url": "https://a.test/?ldtag_cl=1"}, "line/ad"),
        ({"td_url": "https://a.test/?twclid=1"}, "x/ad"),
        ({"td_referrer": "https://shop.example.com/x"}, "(direct)/(none)"),
        ({"td_referrer": "https://mail.yahoo.co.jp/"}, "yahoo/mail"),
        ({"td_referrer": "https://www.instagram.com/"}, "instagram/social"),
        ({"td_referrer": "https://search.rakuten.co.jp/"}, "rakuten/organic"),
        ({"td_referrer": "https://x.test/"}, "x.test/referral"),
        ({"td_referrer": "not a url"}, "(direct)/(none)"),
    ],
)
def test_source_medium(spark, change, medium):
    assert log_of(spark, (at(9), change)).first().td_source_medium == medium


def targets_of(spark, log, now=NOW, cfg=CFG, **tables):
    none = {
        "orders": "ts timestamp, email string, cancelled_at string, created_at string",
        "identity": "email string, td_llm_uid string, updated_at string, prefectures string",
        "suppression": "prefecture string, effective_to string",
    }
    t = {k: spark.createDataFrame(tables.get(k, []), s) for k, s in none.items()}
    found = targets.target_sessions(
        targets.last_in_cart(log, cfg),
        targets.candidate_session(targets.last_session(log), cfg, now),
        targets.purchase_session(log),
        targets.recent_purchasers(t["orders"], cfg, now),
        t["identity"],
        t["suppression"],
        cfg,
    )
    return sorted((r.last_item_id, r.seq_no) for r in found.collect())


THANKS = {"td_url": "https://shop.example.com/checkouts/1/thank-you", "td_path": "/checkouts/1/thank-you"}


def test_purchase_in_the_session_stops_the_mail(spark):
    cart = (at(10), {"items": items("a")})
    assert targets_of(spark, log_of(spark, cart)) == [("a", 1)]
    assert targets_of(spark, log_of(spark, cart, (at(10, 9), THANKS))) == []


def test_session_must_be_idle(spark):
    """The last event exactly 20 minutes ago is not older than 20 minutes."""
    assert targets_of(spark, log_of(spark, (at(10, 10), {"items": items("a")}))) == []
    assert targets_of(spark, log_of(spark, (at(10, 9, 59), {"items": items("a")}))) == [("a", 1)]


def test_cart_keeps_the_last_view_and_four_items(spark):
    log = log_of(
        spark,
        (at(9), {"items": items("a", "b", "x", "y")}),
        (at(9, 5), {"items": items("c", "a", "a", "")}),
    )
    assert targets_of(spark, log) == [("a", 2), ("b", 3), ("c", 1), ("x", 4)]


def test_suppressions(spark):
    log = log_of(spark, (at(9), {"items": items("a")}))
    user = [("u1", "id", "2024-01-01 00:00:00", "Tokyo")]
    assert targets_of(spark, log, identity=user, suppression=[("Tokyo", None)]) == []
    assert targets_of(spark, log, identity=user, suppression=[("Tokyo", "2024-01-01")]) == [("a", 1)]
    unknown = [("u1", "id", None, None), ("u1", "id", None, "")]
    assert targets_of(spark, log, identity=unknown, suppression=[("", None)]) == [("a", 1)]
    assert targets_of(spark, log, cfg=CFG.but(excluded_users=("u1",))) == []


def test_recent_purchasers_edges(spark):
    stamp = "%Y-%m-%d %H:%M:%S"
    limit = NOW - timedelta(hours=48)
    rows = [
        (NOW - timedelta(hours=1), "a", None, limit.strftime(stamp)),
        (NOW - timedelta(hours=1), "b", "", (limit - timedelta(seconds=1)).strftime(stamp)),
        (NOW - timedelta(hours=1), "c", "2024-01-30", NOW.strftime(stamp)),
        (NOW - timedelta(hours=1), "d", None, "no time"),
        (NOW - timedelta(hours=1), "", None, NOW.strftime(stamp)),
    ]
    orders = spark.createDataFrame(
        rows, "ts timestamp, email string, cancelled_at string, created_at string"
    )
    got = targets.recent_purchasers(orders, CFG, NOW)
    want = spark.createDataFrame([("a",)], "e string").select(F.sha2("e", 256)).first()[0]
    assert [r.hashed_email for r in got.collect()] == [want]


def test_frequency_cap_edges(spark):
    people = "mid before roll old browse2 browse1 free".split()
    candidates = spark.createDataFrame([(p, 1) for p in people], "email string, seq_no int")
    sent = spark.createDataFrame(
        [("mid", "2024-01-31 00:00:00"), ("before", "2024-01-30 23:59:59"),
         ("roll", "2024-01-30 10:30:00"), ("old", "2024-01-30 10:29:59")],
        "email string, scheduled_time string",
    )
    seen = spark.createDataFrame(
        [("browse2", "2024-01-31 08:00:00")] * 2 + [("browse1", "2024-01-31 08:00:00")],
        "email string, scheduled_time string",
    )

    def left(cfg):
        capped = sendlist.frequency_cap(candidates, sent, seen, cfg, NOW)
        return sorted(r.email for r in capped.collect())

    assert left(CFG) == ["before", "browse1", "free", "old", "roll"]
    assert left(CFG.but(rolling_cap=True)) == ["browse1", "free", "old"]


def test_slots_after_repeats(spark):
    found = spark.createDataFrame(
        [("e", "a", 9.0, 1), ("e", "a", 8.0, 1), ("e", "b", 5.0, 2), ("e", "c", 4.0, 2), ("e", "d", 3.0, 3)],
        "email string, item_id string, score double, pri int",
    )

    def slots(cfg):
        return sorted((r.seq_no, r.item_id) for r in sendlist._number_slots(found, cfg).collect())

    assert slots(CFG) == [(1, "a"), (3, "b"), (4, "c")]
    assert slots(CFG.but(compact_slots=True)) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_coupon_ends(spark):
    one = spark.createDataFrame([("f0",)], "cart_abandon_rfm_segment string")

    def code(day):
        columns = payload.coupon_columns(CFG.but(coupon_expiry_date=day), NOW)
        return one.select(columns["coupon_code"].alias("c")).first().c

    assert code("2024-01-31") == "<COUPON_CODE_F0>" and code("2024-01-30") == ""


def test_send_list_and_history_columns(spark):
    assert len(sendlist.PUSH_COLUMNS) == 41 and len(payload.HISTORY_COLUMNS) == 87


def test_delivery_batches(spark):
    rows = spark.range(2345).select(F.concat(F.lit("m"), "id").alias("email"))
    sizes = sendlist.delivery_batches(rows, 100).groupBy("batch_no").count().collect()
    assert sorted(r["count"] for r in sizes) == [45] + [100] * 23


def _sends(spark, path):
    rows = spark.read.schema(cart_sessions.HISTORY).parquet(path).collect()
    return sorted((r.email, r.scheduled_time, r.batch_id) for r in rows)


def test_stream_batches_count_once(spark, tmp_path):
    path, at = str(tmp_path / "history"), [NOW]
    cart_sessions.open_history(spark, path)
    browsed = spark.createDataFrame([], "email string, scheduled_time string")
    run = cart_sessions.send_batches(CFG, path, browsed, lambda: at[0])
    batch = spark.createDataFrame([("u1",), ("u1",), ("u2",), (None,)], "user_id_comp string")
    for batch_id in (0, 0, 1):  # the first batch is repeated, the second holds the same users
        run(batch, batch_id)
    assert [(e, n) for e, _, n in _sends(spark, path)] == [("u1", 0), ("u2", 0)]
    cart_sessions.open_history(spark, path)  # keeps what is there
    at[0] = NOW + timedelta(days=1)
    run(batch, 0)  # repeated on the next day
    assert len(_sends(spark, path)) == 2
    run(batch, 2)
    assert [n for *_, n in _sends(spark, path)] == [0, 2, 0, 2]


def test_caps_read_the_days_that_count(spark, tmp_path):
    path, at = str(tmp_path / "history"), [NOW - timedelta(days=9)]
    cart_sessions.open_history(spark, path)
    browsed = spark.createDataFrame([], "email string, scheduled_time string")
    batch = spark.createDataFrame([("u1",)], "user_id_comp string")
    rolling = CFG.but(rolling_cap=True)
    for no in range(10):
        cart_sessions.send_batches(rolling, path, browsed, lambda: at[0])(batch, no)
        at[0] += timedelta(days=1)
    history = spark.read.schema(cart_sessions.HISTORY).parquet(path)
    for cfg, days in ((CFG, 1), (rolling, 2)):
        near = cart_sessions.counted_days(history, cfg, NOW)
        plan = near._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(sent_on" in plan
        assert near.select(F.input_file_name()).distinct().count() == near.select("sent_on").distinct().count() <= days


STREAM_SCHEMA = "ts timestamp, event_id bigint, cookie string, user_id string, td_path string, items string, ecommerce string"


def _streamed(spark, tmp_path, *files):
    """Released carts of a stream that reads the files one by one; minutes after noon stand for times."""
    home = tmp_path / "events"
    for no, rows in enumerate(files):
        full = [
            (datetime(2024, 1, 30, 12, tzinfo=timezone.utc) + timedelta(minutes=m), n, cookie, user, path, items, buy)
            for m, n, cookie, user, path, items, buy in rows
        ]
        spark.createDataFrame(full, STREAM_SCHEMA).coalesce(1).write.parquet(f"{home}/{no}")
        for f in (home / str(no)).glob("part-*"):
            f.rename(home / f"{no}.parquet")
    stream = spark.readStream.schema(STREAM_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{home}/*.parquet")
    out = cart_sessions.run_to_end(cart_sessions.due_carts(stream, CFG.but(session_gap_seconds=1800)), "test")
    items = cart_sessions.cart_items(out, CFG)
    return sorted((r.email, r.last_item_id, r.seq_no) for r in items.collect())


def _cart(*names):
    return json.dumps([{"item_id": n, "item_name": n.lower(), "item_category": "c"} for n in names])


def test_streamed_cart_has_every_item_of_the_session(spark, tmp_path):
    rows = [
        (0, 1, "a", "ua", "/cart", _cart("A"), None),
        (5, 2, "a", None, "/cart", _cart("B", "C"), None),
        (6, 3, "a", None, "/cart", "no list", None),
        (0, 4, "b", "ub", "/cart", _cart("A"), None),
        (3, 5, "b", "ub", "/thanks", None, "order"),
        (40, 6, "clock", "uc", "/", None, None),
    ]
    assert _streamed(spark, tmp_path, rows) == [("ua", "A", 3), ("ua", "B", 1), ("ua", "C", 2)]


def test_a_cart_comes_out_twenty_minutes_after_its_last_event(spark, tmp_path):
    first = [(0, 1, "a", "ua", "/cart", _cart("A"), None), (0, 2, "clock", "uc", "/", None, None)]
    for minute, released in ((20, []), (22, [("ua", "A", 1)])):
        clock = [(minute, 3, "clock", "uc", "/", None, None)]
        assert _streamed(spark, tmp_path / str(minute), first, clock) == released


def test_a_cookie_with_a_third_of_all_events_reaches_its_state_as_a_row_per_slice(spark):
    noon = 1_706_616_000
    rows = [
        (noon + k % 600, k, "hot" if k % 3 == 0 else f"c{k}", f"u{k % 7}", "/cart", _cart(f"I{k % 5}"), None) for k in range(9000)
    ]
    made = spark.createDataFrame(rows, STREAM_SCHEMA.replace("ts timestamp", "ts bigint"))
    events = made.withColumn("ts", F.timestamp_seconds("ts")).repartition(3, "event_id")
    got = cart_sessions.slices(events, CFG).filter("cookie = 'hot'").collect()
    assert 10 <= len(got) <= 3 * 10  # ten minutes, three tasks
    assert sum(r.n for r in got) == 3000
    newest = {}
    for r in got:
        for name, row in json.loads(r.cart).items():
            newest[name] = max(newest.get(name, row), row)
    want = {}
    for t, k, cookie, *_ in rows:
        if cookie == "hot":
            want[f"I{k % 5}"] = max(want.get(f"I{k % 5}", [0]), [t * 10**6, 0, k])
    assert {name: row[:3] for name, row in newest.items()} == want
    assert max(r.user for r in got) == "u6" and min(r.first for r in got) == noon * 10**6


def _item_rows(k):
    base = {"cookie": "a", "slice": 1, "up": 0, "item_name": "x", "item_category": None, "user": "", "bought": False}
    row = lambda item, n, event: {**base, "item_id": item, "n": n, "at": k, "first": k, "last": k, "event_id": event}
    return [row("A", 1, k), row("A", 1, 10 + k), row("B", 1, 20 + k)]


def test_slices_summed_up_in_several_steps_are_the_same(spark, monkeypatch):
    events = spark.createDataFrame(
        [(datetime(2024, 1, 30, 12, 0, k % 60), k, None if k % 4 == 0 else f"c{k % 4}", None, "/cart", _cart("A", "B"), "") for k in range(400)],
        STREAM_SCHEMA,
    ).coalesce(1)
    whole = sorted(cart_sessions.slices(events, CFG).collect(), key=str)
    assert len(whole) == 4 and {r.n for r in whole} == {100}
    frames = [pd.DataFrame(_item_rows(k)) for k in range(3)]
    assert cart_sessions._summed(pd.concat(frames))["n"].tolist() == [6, 3]
    step = cart_sessions._summed(pd.concat([cart_sessions._summed(pd.concat(frames[:2])), frames[2]]))
    assert step["n"].tolist() == [6, 3] and step["event_id"].tolist() == [12, 22]
    with pytest.raises(ValueError, match="idle"):
        cart_sessions.slices(events, CFG.but(slice_seconds=100_000))


def test_late_rows_are_left_to_the_batch(spark, tmp_path):
    first = [(0, 1, "a", "ua", "/cart", _cart("A"), None), (60, 2, "clock", "uc", "/", None, None)]
    late = [(2, 3, "a", "ua", "/cart", _cart("LATE"), None), (3, 4, "z", "uz", "/cart", _cart("Z"), None)]
    clock = [(120, 5, "clock", "uc", "/", None, None)]
    assert _streamed(spark, tmp_path, first, late, clock) == [("ua", "A", 1)]


def test_products_and_people_of_a_send_list_are_made_once(spark, monkeypatch):
    from registry import cart as queries
    from registry.common import views
    from storelens.plans.cart import run

    made = []
    for module, name in ((sendlist, "product_dedup"), (sendlist, "identity_dedup"), (targets, "identity_dedup")):
        def counted(rows, name=name, fn=getattr(module, name)):
            made.append(name)
            return fn(rows)

        monkeypatch.setattr(module, name, counted)
    t = views(spark, "/root/testdata/sf0.001", *queries.RECO_TABLES)
    run.push_list(t, queries.CFG, queries.AS_OF)
    assert sorted(made) == ["identity_dedup", "product_dedup"]


def test_stock_is_not_repeated_where_no_item_is_hot(spark):
    shared = "x string, item_id string, is_available string, low_stock string, taxin_price string, " \
        "taxin_compare_at_price string, sale_flag string, discount_rate string"
    stock = spark.createDataFrame([("", f"h{i}", "1", "", "5", "6", "0", None) for i in range(50)], shared)
    urls = [c.format(n=n) for n in sendlist.SLOTS for c in ("cart_item_seq{n}_item_url", "cart_abandon_recommend_seq{n}_item_url")]
    push = spark.createDataFrame([("a", *["https://s/products/h1"] * 8)], "email string, " + ", ".join(f"{u} string" for u in urls))
    got = payload.with_stock(push, stock)
    assert "_salt" not in got._jdf.queryExecution().analyzed().toString()
    assert [(r.cart1_price, r.reco4_price_org) for r in got.collect()] == [("5", "6")]


def test_profiles_are_ranked_for_asked_addresses_only(spark):
    rows = [("a", datetime(2024, 1, 1), "old"), ("a", datetime(2024, 1, 2), "new"), ("b", datetime(2024, 1, 1), "other")]
    attributes = spark.createDataFrame(rows, "email string, ts timestamp, member_name string")
    asked = spark.createDataFrame([("a",), (None,), ("c",)], "email string")
    got = payload.latest_attributes(attributes, asked).collect()
    assert [(r.email, r.member_name) for r in got] == [("a", "new")]


def test_slices_are_summed_up_without_a_call_per_group():
    rows = pd.DataFrame([r for k in range(300) for r in _item_rows(k)]).assign(user=[f"=u{k % 7}" for k in range(900)])
    rows["slice"] = rows["at"] // 2
    got = cart_sessions._summed(rows)
    again = rows.groupby(["cookie", "slice", "item_id"], sort=False)
    assert len(got) == 300 and got["n"].sum() == rows["n"].sum()
    assert got["user"].tolist() == again["user"].agg("max").tolist()
    assert got["event_id"].tolist() == again["event_id"].agg("max").tolist()
    began = time.process_time()
    wide = pd.concat([rows.assign(cookie=f"c{k}") for k in range(100)])
    assert len(cart_sessions._summed(wide)) == 30_000
    assert time.process_time() - began < 1.5
