"""Who gets a cart mail now, with which cart items and which recommendations."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from storelens.functions.text import not_blank, or_empty
from storelens.functions.timewin import as_utc, in_window, local_midnight, local_text
from storelens.operators.joins import salted_join
from storelens.operators.ranking import latest_by, pivot_slots, topk_per_key
from storelens.operators.staging import stage
from storelens.plans.cart.targets import identity_dedup

SLOTS = (1, 2, 3, 4)
TIME = "%Y-%m-%d %H:%M:%S"
# Purchase segments, the one with more purchases wins.
SEGMENTS = ["unknown", "f0", "f1", "f3plus"]
# Partner tables, their item and score, and the bought column that asks for ``item_a``.
PARTNERS = {
    "coview": ("item_b", "co_view_sessions", "handle"),
    "fbt": ("item_b_handle", "co_purchase_users", "product_id"),
}

PUSH_COLUMNS = [
    "email",
    "cart_abandon_rfm_segment",
    *[
        f"cart_abandon_{c}"
        for c in ("item_id", "item_name", "item_category", "image_url", "item_url", "brand")
    ],
    *[
        f"cart_item_seq{n}_{c}"
        for n in SLOTS
        for c in ("image_url", "item_name", "item_url", "item_brand")
    ],
    *[
        f"cart_abandon_recommend_seq{n}_{c}"
        for n in SLOTS
        for c in ("image_url", "item_name", "item_url", "item_brand")
    ],
    "cart_abandon_detected_at",
]


def frequency_cap(
    candidates: DataFrame, cart_history: DataFrame, browser_history: DataFrame, cfg, as_of: datetime
) -> DataFrame:
    """Drops users at the cart-mail limit or at the limit of all mails of the day.

    Cart mails count since local midnight, or over the last 24 hours with
    ``rolling_cap``; browser mails always count since local midnight.
    """
    today = local_text(local_midnight(as_of, cfg.tz), TIME, cfg.tz)
    since = (
        local_text(as_utc(as_of) - timedelta(hours=24), TIME, cfg.tz) if cfg.rolling_cap else today
    )
    mails = (
        cart_history.filter(F.col("scheduled_time") >= since)
        .select("email", F.lit(1).alias("cart"), F.lit(0).alias("browser"))
        .unionByName(
            browser_history.filter(F.col("scheduled_time") >= today).select(
                "email", F.lit(0).alias("cart"), F.lit(1).alias("browser")
            )
        )
    )
    full = (
        mails.groupBy("email")
        .agg(F.sum("cart").alias("cart"), F.sum("browser").alias("browser"))
        .filter(
            (F.col("cart") >= cfg.cart_mails_per_day)
            | (F.col("cart") + F.col("browser") >= cfg.mails_per_day)
        )
    )
    return candidates.filter(not_blank("email")).join(full.select("email"), "email", "left_anti")


def product_dedup(detail: DataFrame) -> DataFrame:
    """One row per item: the largest value of each column."""
    columns = ["item_name", "image_url", "item_url", "brand_name"]
    return detail.groupBy("item_id").agg(*[F.max(c).alias(c) for c in columns])


def cart_pivot(capped: DataFrame, products: DataFrame) -> DataFrame:
    """One row per user: up to four cart items with their product data (a row per item), and the segment.

    Product data is looked up once in long form, before the slots become columns. ``capped`` should be staged.
    """
    looked_up = salted_join(
        capped.select("email", "seq_no", F.col("last_item_id").alias("item_id")),
        products.drop("item_name"),
        "item_id",
        "email",
        salts=None,
    )
    products = pivot_slots(
        looked_up,
        "email",
        "seq_no",
        {
            "image_url": "cart_item_seq{n}_image_url",
            "item_url": "cart_item_seq{n}_item_url",
            "brand_name": "cart_item_seq{n}_item_brand",
        },
        SLOTS,
    )
    level = F.array_position(F.array(*map(F.lit, SEGMENTS)), F.col("rfm_segment"))
    first = F.col("seq_no") == 1
    named = capped.groupBy("email").agg(
        F.element_at(F.array(*map(F.lit, SEGMENTS)), F.max(level).cast("int")).alias("rfm_segment"),
        F.max(F.when(first, F.col("last_item_category"))).alias("last_item_category"),
        *[
            F.max(F.when(F.col("seq_no") == n, F.col(src))).alias(f"cart_item_seq{n}_{out}")
            for n in SLOTS
            for src, out in (("last_item_id", "item_id"), ("last_item_name", "item_name"))
        ],
    )
    return named.join(products, "email", "left")


def products_of(t: dict) -> DataFrame:
    """A row per item; the shared one where there is one."""
    return t["products"] if "products" in t else product_dedup(t["product_detail"])


def people_of(t: dict) -> DataFrame:
    """A person per address; the shared table where there is one."""
    return t["people"] if "people" in t else identity_dedup(t["identity_map"])


def _offers(t: dict) -> DataFrame:
    """Items that may be recommended: with a picture and available."""
    if "offers" in t:
        return t["offers"]
    available = t["product_stock"].filter(F.col("is_available") == "1").select("item_id")
    return products_of(t).filter(F.col("image_url").isNotNull()).join(available, "item_id", "left_semi")


def _lists(rows: DataFrame, offers: DataFrame, by: str, depth: int) -> DataFrame:
    """The ``depth`` best offered items per ``by`` of rows (by, item_id, score)."""
    return topk_per_key(
        rows.join(offers.select("item_id"), "item_id", "left_semi"),
        [by],
        [F.desc("score"), F.asc("item_id")],
        depth,
        "_place",
    ).select(by, "item_id", "score")


def _best_offers(t: dict, name: str, cfg) -> DataFrame:
    """The best offers per category (popularity), or per handle (coview) or product (fbt) that was bought."""
    if f"best_{name}" in t:
        return t[f"best_{name}"]
    if name == "popularity":
        rows = t[name].select(
            F.col("item_category").alias("last_item_category"),
            "item_id",
            F.col("popularity_score").cast("double").alias("score"),
        )
        return _lists(rows, _offers(t), "last_item_category", _depth(cfg))
    item, score, on = PARTNERS[name]
    rows = t[name].filter(not_blank(item)).select(
        F.col("item_a").alias(on), F.col(item).alias("item_id"), F.col(score).cast("double").alias("score")
    )
    return _lists(rows, _offers(t), on, _depth(cfg))


def share_offers(t: dict, cfg) -> dict:
    """``t`` with what the carts and all recommendations read, each made and staged once."""
    t = {**t, "products": stage(products_of(t)), "people": stage(people_of(t))}
    t["offers"] = stage(_offers(t))
    return {**t, **{f"best_{name}": stage(_best_offers(t, name, cfg)) for name in ("popularity", *PARTNERS)}}


def _depth(cfg) -> int:
    """List length that surely leaves four items after own and repeated ones are dropped."""
    return 3 * len(SLOTS) + 1 if cfg.compact_slots else len(SLOTS) + 1


def _not_own(df: DataFrame) -> DataFrame:
    return df.filter(F.col("item_id") != F.col("cart_item_seq1_item_id"))


def _cart_key(carts: DataFrame, segments: list[str]) -> DataFrame:
    return carts.filter(F.col("rfm_segment").isin(segments)).select(
        "email", "rfm_segment", "last_item_category", "cart_item_seq1_item_id"
    )


def _with_product(slots: DataFrame, offers: DataFrame) -> DataFrame:
    return salted_join(stage(slots), offers, "item_id", "email", salts=None).select(
        "email", "image_url", "item_name", "item_url", "brand_name", "seq_no"
    )


def segment_reco_new(carts: DataFrame, t: dict, cfg) -> DataFrame:
    """No or one purchase: the most viewed items of the cart item's category."""
    found = salted_join(
        _cart_key(carts, ["unknown", "f0"]), _best_offers(t, "popularity", cfg), "last_item_category", "email"
    )
    slots = topk_per_key(
        _not_own(found), ["email"], [F.desc("score"), F.asc("item_id")], len(SLOTS), "seq_no"
    )
    return _with_product(slots.select("email", "item_id", "seq_no"), _offers(t))


def _number_slots(found: DataFrame, cfg) -> DataFrame:
    """Slots by priority and score; a repeated item keeps its first place.

    By default places are given before repeats are dropped, so slots can stay
    empty; ``compact_slots`` drops repeats first.
    """
    order = [F.asc("pri"), F.desc("score"), F.asc("item_id")]
    if cfg.compact_slots:
        found = latest_by(found, ["email", "item_id"], order)
        return topk_per_key(found, ["email"], order, len(SLOTS), "seq_no")
    placed = topk_per_key(found, ["email"], order, len(SLOTS), "seq_no")
    # four rows per user are left here
    return latest_by(placed, ["email", "item_id"], [F.asc("seq_no")])


def bought_by(carts: DataFrame, t: dict, cfg, as_of: datetime, segments: list[str]) -> DataFrame:
    """Purchases of the carts' users of some segments in the history window, not cancelled."""
    if "bought" in t:
        return t["bought"].filter(F.col("rfm_segment").isin(segments))
    rows = in_window(t["order_history"], cfg.history_window, as_of, cfg.tz).filter(
        F.col("cancelled_at").isNull() & not_blank("handle")
    )
    return (
        _cart_key(carts, segments)
        .join(people_of(t), "email")
        .join(rows.select("td_llm_uid", "product_id", "handle", "ts"), "td_llm_uid")
        .drop("td_llm_uid")
    )


def _related(bought: DataFrame, lists: DataFrame, on: str, pri: int, weight: float) -> DataFrame:
    """Best partners (item_id, score) of each bought item; a weight above 0 leaves their order."""
    asked = stage(bought.select("email", "cart_item_seq1_item_id", on).distinct())
    found = salted_join(asked, lists, on, "email", salts=None)
    return _not_own(found).select("email", "item_id", (F.col("score") * weight).alias("score"), F.lit(pri).alias("pri"))


def _segment_reco(carts: DataFrame, bought: DataFrame, t: dict, cfg, segment: str, order) -> DataFrame:
    popular = salted_join(
        _cart_key(carts, [segment]), _best_offers(t, "popularity", cfg), "last_item_category", "email"
    )
    found = _not_own(popular).select("email", "item_id", "score", F.lit(3).alias("pri"))
    for pri, (name, weight) in enumerate(order, start=1):
        lists = _best_offers(t, name, cfg)
        found = found.unionByName(_related(bought, lists, PARTNERS[name][2], pri, weight))
    slots = _number_slots(found, cfg)
    return _with_product(slots.select("email", "item_id", "seq_no"), _offers(t))


def segment_reco_f1(carts: DataFrame, t: dict, cfg, as_of: datetime) -> DataFrame:
    """Two purchases: viewed, then bought with the last purchase, then popular."""
    bought = bought_by(carts, t, cfg, as_of, ["f1"])
    last = latest_by(bought, ["email"], [F.desc("ts"), F.asc("product_id")])
    return _segment_reco(carts, last, t, cfg, "f1", [("coview", 1.0), ("fbt", 1.0)])


def segment_reco_f3plus(carts: DataFrame, t: dict, cfg, as_of: datetime) -> DataFrame:
    """Three and more: bought with any recent purchase, then viewed, then popular."""
    bought = bought_by(carts, t, cfg, as_of, ["f3plus"])
    return _segment_reco(carts, bought, t, cfg, "f3plus", [("fbt", 2.0), ("coview", 1.0)])


def push_send_list(
    carts: DataFrame, recos: list[DataFrame], cfg, as_of: datetime
) -> DataFrame:
    """The wide send list of 41 text columns."""
    every = recos[0]
    for part in recos[1:]:
        every = every.unionByName(part)
    wide = pivot_slots(
        every,
        "email",
        "seq_no",
        {
            "image_url": "reco{n}_image_url",
            "item_name": "reco{n}_item_name",
            "item_url": "reco{n}_item_url",
            "brand_name": "reco{n}_item_brand",
        },
        SLOTS,
    )
    rows = carts.filter(not_blank("email")).join(wide, "email", "left")
    out: dict[str, Column] = {
        "cart_abandon_rfm_segment": F.col("rfm_segment"),
        "cart_abandon_item_id": F.col("cart_item_seq1_item_id"),
        "cart_abandon_item_name": F.col("cart_item_seq1_item_name"),
        "cart_abandon_item_category": F.col("last_item_category"),
        "cart_abandon_image_url": F.col("cart_item_seq1_image_url"),
        "cart_abandon_item_url": F.col("cart_item_seq1_item_url"),
        "cart_abandon_brand": F.col("cart_item_seq1_item_brand"),
        "cart_abandon_detected_at": F.lit(local_text(as_of, TIME, cfg.tz)),
    }
    for n in SLOTS:
        for c in ("image_url", "item_name", "item_url", "item_brand"):
            out[f"cart_item_seq{n}_{c}"] = or_empty(f"cart_item_seq{n}_{c}")
            default = F.lit(cfg.cart_url if c == "item_url" else "")
            out[f"cart_abandon_recommend_seq{n}_{c}"] = F.coalesce(F.col(f"reco{n}_{c}"), default)
    return rows.select("email", *[out[c].alias(c) for c in PUSH_COLUMNS if c != "email"])


def delivery_batches(payload: DataFrame, size: int = 1000) -> DataFrame:
    """Adds ``batch_no``: about ``size`` rows per batch, without a global order.

    Rows get a hash bucket of 4096, buckets are numbered on from each other, so a
    batch number needs one small prefix sum and no single-task sort.
    """
    rows = payload.withColumn("_bucket", F.pmod(F.xxhash64("email"), F.lit(4096)))
    sizes = rows.groupBy("_bucket").agg(F.count("*").alias("n"))
    offsets = sizes.select(
        "_bucket", (F.sum("n").over(W.orderBy("_bucket")) - F.col("n")).alias("_offset")
    )
    place = F.row_number().over(W.partitionBy("_bucket").orderBy("email")) - 1
    return (
        rows.join(F.broadcast(offsets), "_bucket")
        .withColumn("batch_no", F.floor((F.col("_offset") + place) / size))
        .drop("_bucket", "_offset")
    )
