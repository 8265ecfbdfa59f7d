"""Mail payloads, the send history, and sample payloads for test mails."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from storelens.functions.text import comma_price, email_hash, not_blank, or_empty, product_handle
from storelens.functions.timewin import as_utc, local_text
from storelens.operators.joins import salted_join
from storelens.operators.ranking import (
    give_to_all,
    global_topn,
    latest_by,
    pivot_slots,
)
from storelens.operators.staging import stage
from storelens.plans.cart.sendlist import SLOTS, TIME

PARTS = ("image_url", "item_name", "item_url", "item_brand")
STOCK_PARTS = ("low_stock", "price", "price_org", "sale_flag", "discount_rate")
RECO_STOCK_PARTS = STOCK_PARTS[1:]
PROFILE_SLOTS = (5, 6, 7, 8)


def _stock_columns(stock: DataFrame, available_only: bool = True) -> DataFrame:
    """Availability and price texts per item.

    With ``available_only`` an unavailable item has no prices; its low stock still
    counts for the mail flag, as ``any_low``.
    """
    sale = F.col("sale_flag") == "1"
    shown = F.col("is_available") == "1" if available_only else F.lit(True)
    columns = {
        "is_available": F.when(F.col("is_available") == "1", "1"),
        "low_stock": or_empty("low_stock"),
        "price": comma_price("taxin_price"),
        "price_org": comma_price("taxin_compare_at_price"),
        "sale_flag": F.when(sale, "1").otherwise(""),
        "discount_rate": F.when(sale, or_empty("discount_rate")).otherwise(""),
    }
    return stock.select(
        "item_id",
        or_empty("low_stock").alias("any_low"),
        *[F.when(shown, c).alias(name) for name, c in columns.items()],
    )


def with_stock(push: DataFrame, stock: DataFrame, available_only: bool = True) -> DataFrame:
    """Adds, for every cart and recommendation slot, availability, price and sale columns.

    The eight slots become rows, meet the stock table in one join, and become
    columns again; each person's row is matched by ``email``.
    """
    slots = F.array(
        *[
            F.struct(F.lit(f"{kind}{n}").alias("slot"), F.col(col.format(n=n)).alias("url"))
            for n in SLOTS
            for kind, col in (
                ("cart", "cart_item_seq{n}_item_url"),
                ("reco", "cart_abandon_recommend_seq{n}_item_url"),
            )
        ]
    )
    long = (
        push.select("email", F.explode(slots).alias("s"))
        .select("email", "s.slot", product_handle("s.url").alias("item_id"))
        .filter(F.col("item_id").isNotNull())
    )
    looked_up = salted_join(stage(long), _stock_columns(stock, available_only), "item_id", "email", salts=None)
    names = [f"{kind}{n}" for n in SLOTS for kind in ("cart", "reco")]
    wide = looked_up.groupBy("email").agg(
        F.max(F.when(F.col("slot").startswith("cart"), F.col("any_low"))).alias("any_low"),
        *[
            F.max(F.when(F.col("slot") == s, F.col(c))).alias(f"{s}_{c}")
            for s in names
            for c in ("is_available", *STOCK_PARTS)
        ],
    )
    return (
        push.join(wide, "email", "left")
        .withColumn("has_low_stock", F.when(F.col("any_low") == "1", "1").otherwise(""))
        .withColumns({f"{s}_{c}": or_empty(f"{s}_{c}") for s in names for c in STOCK_PARTS})
        .drop("any_low")
    )


def _by_segment(values: dict[str, str], default: str) -> Column:
    chain = F.lit(default)
    for segment, value in values.items():
        chain = F.when(F.col("cart_abandon_rfm_segment") == segment, value).otherwise(chain)
    return chain


def coupon_columns(cfg, as_of: datetime) -> dict[str, Column]:
    """Coupon texts by segment; all empty once the coupon is over."""
    today = date.fromisoformat(local_text(as_of, "%Y-%m-%d", cfg.tz))
    names = ("coupon_code", "coupon_image_url", "coupon_description", "coupon_expiry")
    if date.fromisoformat(cfg.coupon_expiry_date) < today:
        return {n: F.lit("") for n in names}
    return dict(
        zip(
            names,
            (
                _by_segment(cfg.coupon_codes, ""),
                _by_segment(cfg.coupon_images, cfg.coupon_image_default),
                _by_segment(cfg.coupon_texts, ""),
                F.lit(cfg.coupon_expiry_label),
            ),
        )
    )


def subscribers(customers: DataFrame) -> DataFrame:
    """Distinct addresses with consent, and their hash."""
    rows = customers.filter(F.col("email_marketing_consent") == "SUBSCRIBED")
    return rows.select(F.col("email").alias("raw_email")).distinct().withColumn(
        "email", email_hash("raw_email")
    )


def _points(attributes: DataFrame) -> DataFrame:
    return attributes.groupBy("email").agg(F.max("pointsapproved").alias("points"))


def _points_text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("0"))


def _enriched(
    push: DataFrame, attributes: DataFrame, stock: DataFrame, cfg, as_of: datetime
) -> DataFrame:
    rows = with_stock(push.filter(F.col("email").isNotNull()), stock)
    return (
        rows.join(_points(attributes), "email", "left")
        .withColumn("pointsapproved", _points_text("points"))
        .withColumns(coupon_columns(cfg, as_of))
    )


def send_payload(
    push: DataFrame,
    customers: DataFrame,
    attributes: DataFrame,
    stock: DataFrame,
    cfg,
    as_of: datetime,
) -> DataFrame:
    """What the mailer needs per subscriber; slots of unavailable items are blank."""
    rows = _enriched(push, attributes, stock, cfg, as_of).join(subscribers(customers), "email")

    def shown(slot: str, c: str) -> Column:
        return F.when(F.col(f"{slot}_is_available") == "1", or_empty(c)).otherwise("")

    columns = [
        F.col("raw_email").alias("email"),
        "pointsapproved",
        "has_low_stock",
        *coupon_columns(cfg, as_of),
    ]
    for n in SLOTS:
        columns += [
            shown(f"cart{n}", f"cart_item_seq{n}_{p}").alias(f"cart_item_seq{n}_{p}") for p in PARTS
        ]
        columns += [F.col(f"cart{n}_{p}").alias(f"cart_item_seq{n}_{p}") for p in STOCK_PARTS]
    for n in SLOTS:
        columns += [
            shown(f"reco{n}", f"cart_abandon_recommend_seq{n}_{p}").alias(f"recommend_seq{n}_{p}")
            for p in PARTS
        ]
        columns += [F.col(f"reco{n}_{p}").alias(f"recommend_seq{n}_{p}") for p in RECO_STOCK_PARTS]
    return rows.select(*columns)


def latest_attributes(attributes: DataFrame, asked: DataFrame) -> DataFrame:
    """The latest attributes of the addresses in ``asked``; the rows are wide, so others are left out before the shuffle."""
    order = [F.desc_nulls_last("ts"), F.asc("member_name")]
    return latest_by(attributes.join(asked.select("email"), "email", "left_semi"), ["email"], order)


def _profile_columns(cfg) -> list[Column]:
    return [
        F.coalesce(
            F.col(f"recommend_seq{n}_{p}"), F.lit(cfg.home_url if p == "item_url" else "")
        ).alias(f"recommend_seq{n}_{p}")
        for n in PROFILE_SLOTS
        for p in PARTS
    ]


def _cart_reco_columns() -> list[Column]:
    return [
        F.col(f"cart_abandon_recommend_seq{n}_{p}").alias(f"recommend_seq{n}_{p}")
        for n in SLOTS
        for p in PARTS
    ]


def send_payload_low_stock(
    push: DataFrame, customers: DataFrame, attributes: DataFrame, cfg
) -> DataFrame:
    """Payload for frequent buyers: four cart and four profile recommendations."""
    rows = push.filter(
        F.col("email").isNotNull() & (F.col("cart_abandon_rfm_segment") == "f3plus")
    )
    rows = rows.join(subscribers(customers), "email").join(
        latest_attributes(attributes, rows).drop("ts"), "email", "left"
    )
    return rows.select(
        F.col("raw_email").alias("email"),
        or_empty("member_name").alias("member_name"),
        _points_text("pointsapproved").alias("pointsapproved"),
        *_cart_reco_columns(),
        *_profile_columns(cfg),
    )


HISTORY_COLUMNS = [
    "email",
    "send_type",
    "workflow_name",
    "rfm_segment",
    "template_event_id",
    "template_id",
    "pointsapproved",
    "has_low_stock",
    "coupon_code",
    "coupon_image_url",
    "coupon_description",
    "coupon_expiry",
    *[f"cart_abandon_{c}" for c in ("item_id", "item_name", "image_url", "item_url", "brand")],
    *[f"cart_item_seq{n}_{p}" for n in SLOTS for p in (*PARTS, *STOCK_PARTS)],
    *[
        c
        for n in SLOTS
        for c in (
            *[f"cart_abandon_recommend_seq{n}_{p}" for p in PARTS],
            *[f"recommend_seq{n}_{p}" for p in RECO_STOCK_PARTS],
        )
    ],
    "cart_abandon_detected_at",
    "scheduled_time",
]


def send_history(
    push: DataFrame, attributes: DataFrame, stock: DataFrame, cfg, as_of: datetime
) -> DataFrame:
    """Rows to append to the send history, which is also the state of the frequency cap."""
    rows = _enriched(push, attributes, stock, cfg, as_of)
    renamed = {
        f"{kind}{n}_{p}": f"{out}_seq{n}_{p}"
        for n in SLOTS
        for kind, out, parts in (
            ("cart", "cart_item", STOCK_PARTS),
            ("reco", "recommend", RECO_STOCK_PARTS),
        )
        for p in parts
    }
    rows = rows.withColumnsRenamed(renamed).withColumns(
        {
            "send_type": F.lit(cfg.send_type),
            "workflow_name": F.lit(cfg.workflow_name),
            "rfm_segment": F.col("cart_abandon_rfm_segment"),
            "template_event_id": F.lit(cfg.template_event_id),
            "template_id": F.lit(cfg.template_id),
            "scheduled_time": F.lit(local_text(as_utc(as_of), TIME, cfg.tz)),
        }
    )
    return rows.select(*[F.col(c).cast("string").alias(c) for c in HISTORY_COLUMNS])


def _filled(names: list[str], counts: dict[int, str], none: str) -> Column:
    """Label of the longest full run of slots; ``counts`` maps a length to its label."""
    chain = F.lit(none)
    for n in sorted(counts):
        full = not_blank(names[0])
        for c in names[1:n]:
            full = full & not_blank(c)
        chain = F.when(full, counts[n]).otherwise(chain)
    return chain


def classify_patterns(history: DataFrame, attributes: DataFrame) -> DataFrame:
    """Send history with the latest profile and labels of what is filled in."""
    profile = latest_attributes(attributes, history).drop("ts")
    rows = history.drop("pointsapproved").join(profile, "email", "left")
    cart = [f"cart_abandon_recommend_seq{n}_image_url" for n in SLOTS]
    own = [f"recommend_seq{n}_image_url" for n in PROFILE_SLOTS]
    points = F.col("pointsapproved").cast("string")
    return rows.withColumns(
        {
            "reco_pattern": _filled(cart, {1: "only1", 2: "only2", 4: "all4"}, "none"),
            "ps_pattern": _filled(own, {1: "ps_partial", 4: "ps_all4"}, "ps_none"),
            "pts_pattern": F.when(points.isNotNull() & (points != "0"), "pts").otherwise("nopts"),
        }
    )


PATTERN = ["rfm_segment", "reco_pattern", "ps_pattern", "pts_pattern"]


def pattern_sample(
    history: DataFrame,
    attributes: DataFrame,
    cfg,
    segments: list[str],
    alias: str,
    keep: list[tuple[str, str, str, str]] | None = None,
    recipients: DataFrame | None = None,
) -> DataFrame:
    """The newest history row of every pattern, addressed to a test mailbox.

    ``keep`` limits the patterns; ``recipients`` (email_address) sends each
    pattern to every one of them, otherwise one fixed mailbox is used. Real
    addresses never leave this function.
    """
    rows = classify_patterns(history.filter(F.col("rfm_segment").isin(segments)), attributes)
    if keep is not None:
        wanted = [F.struct(*[F.lit(v) for v in p]) for p in keep]
        rows = rows.filter(F.struct(*PATTERN).isin(wanted) if wanted else F.lit(False))
    newest = latest_by(rows, PATTERN, [F.desc("scheduled_time"), F.asc("email")])
    label = F.concat(F.lit(f"+{alias}_"), F.concat_ws("_", *PATTERN))
    columns = [
        F.coalesce("member_name", F.lit("テストユーザー")).alias("member_name"),
        _points_text("pointsapproved").alias("pointsapproved"),
        *_cart_reco_columns(),
        *_profile_columns(cfg),
    ]
    if recipients is None:
        address = F.concat(F.lit("test-recipient"), label, F.lit("@example.com"))
        return newest.select(address.alias("email"), *columns)
    few = recipients.select("email_address")
    at = F.instr("email_address", "@")
    address = F.concat(
        F.substring("email_address", F.lit(1), at - 1),
        "_label",
        F.substring("email_address", at, F.length("email_address")),
    )
    named = newest.select(label.alias("_label"), *columns)
    return give_to_all(named, few).select(address.alias("email"), *named.columns[1:])


# The four assembled payloads. Cart slots name the n-th product
# (prod) or the n-th low-stock product (low); reco is how many are shown.
ASSEMBLED = [
    ("cart1_reco0_lowstock", "unknown", "0", ["low1"], 0),
    ("cart2_reco0_normal", "f0", "250", ["prod1", "prod2"], 0),
    ("cart3_reco1_mixed", "f1", "500", ["prod3", "prod4", "low2"], 1),
    ("cart4_reco2_normal", "f3plus", "1200", ["prod5", "prod6", "prod7", "prod8"], 2),
]


def fixture_payloads(
    history: DataFrame, stock: DataFrame, recipients: DataFrame, cfg, as_of: datetime, seed: int = 42
) -> DataFrame:
    """Four payloads put together from real products, for every recipient."""
    spark = history.sparkSession
    published = stock.filter(F.col("is_published") == "1")
    items = (
        history.filter(not_blank("cart_abandon_image_url") & not_blank("cart_abandon_item_url"))
        .select(
            F.col("cart_abandon_item_id").alias("item_id"),
            F.col("cart_abandon_image_url").alias("image_url"),
            F.col("cart_abandon_item_name").alias("item_name"),
            F.col("cart_abandon_item_url").alias("item_url"),
            F.col("cart_abandon_brand").alias("item_brand"),
        )
        .distinct()
        .join(published.select("item_id", or_empty("low_stock").alias("low_stock")), "item_id")
    )
    order = [F.asc(c) for c in ("item_id", "item_name", "image_url", "item_url", "item_brand")]
    prod = global_topn(items, order, 8, "no").filter(F.col("low_stock") != "1")
    low = global_topn(items.filter(F.col("low_stock") == "1"), order, 2, "no")
    chosen = prod.select("*", F.lit("prod").alias("kind")).unionByName(
        low.select("*", F.lit("low").alias("kind"))
    )
    slots = spark.createDataFrame(
        [(p[0], n, s) for p in ASSEMBLED for n, s in enumerate(p[3], start=1)],
        "pattern string, slot int, source string",
    )
    wide = pivot_slots(
        slots.join(
            chosen.withColumn("source", F.concat("kind", F.col("no").cast("string"))), "source", "left"
        ),
        "pattern",
        "slot",
        {**{p: "cart_item_seq{n}_" + p for p in PARTS}, "low_stock": "cart_item_seq{n}_low_stock"},
        SLOTS,
    )
    newest = history.filter(
        not_blank("cart_abandon_recommend_seq1_image_url")
        & not_blank("cart_abandon_recommend_seq2_image_url")
    ).withColumn("_handle", product_handle("cart_abandon_recommend_seq1_item_url"))
    newest = newest.join(
        published.select(F.col("item_id").alias("_handle")), "_handle", "left_semi"
    )
    reco = global_topn(newest, [F.desc("scheduled_time"), F.asc("email")], 1, "no").select(
        *[
            F.col(f"cart_abandon_recommend_seq{n}_{p}").alias(f"shown{n}_{p}")
            for n in (1, 2)
            for p in PARTS
        ]
    )
    heads = spark.createDataFrame(
        [(p[0], p[1], p[2], p[4]) for p in ASSEMBLED],
        "pattern string, cart_abandon_rfm_segment string, pointsapproved string, n_reco int",
    )
    rows = heads.join(wide, "pattern")
    plain = rows.filter("n_reco = 0").select("*", *[F.lit("").alias(c) for c in reco.columns])
    shown = give_to_all(rows.filter("n_reco > 0"), reco)
    rows = plain.unionByName(shown).withColumns(coupon_columns(cfg, as_of))
    for n in SLOTS:
        for p in PARTS:
            value = (
                F.when(F.col("n_reco") >= n, F.col(f"shown{n}_{p}")).otherwise("")
                if n <= 2
                else F.lit("")
            )
            rows = rows.withColumn(f"cart_abandon_recommend_seq{n}_{p}", value)
    rows = rows.withColumns(
        {f"cart_item_seq{n}_{p}": or_empty(f"cart_item_seq{n}_{p}") for n in SLOTS for p in PARTS}
    )
    # the pattern name stands for the person in the stock lookup
    priced = with_stock(rows.withColumn("email", F.col("pattern")), stock, available_only=False)
    tag = F.substring(
        F.sha2(F.concat_ws("|", "pattern", "email_address", F.lit(str(seed))), 256), 1, 3
    )
    at = F.instr("email_address", "@")
    address = F.concat(
        F.substring("email_address", F.lit(1), at - 1),
        F.lit("+ca_v2_"),
        "pattern",
        F.lit("-"),
        tag,
        F.substring("email_address", at, F.length("email_address")),
    )
    out = give_to_all(priced, recipients.select("email_address"))
    columns = [address.alias("email"), "pointsapproved", "has_low_stock", *coupon_columns(cfg, as_of)]
    for n in SLOTS:
        columns += [f"cart_item_seq{n}_{p}" for p in PARTS]
        columns += [or_empty(f"cart_item_seq{n}_low_stock").alias(f"cart_item_seq{n}_low_stock")]
        columns += [F.col(f"cart{n}_{p}").alias(f"cart_item_seq{n}_{p}") for p in RECO_STOCK_PARTS]
    for n in SLOTS:
        columns += [
            F.col(f"cart_abandon_recommend_seq{n}_{p}").alias(f"recommend_seq{n}_{p}") for p in PARTS
        ]
        columns += [F.col(f"reco{n}_{p}").alias(f"recommend_seq{n}_{p}") for p in RECO_STOCK_PARTS]
    return out.select(*columns)
