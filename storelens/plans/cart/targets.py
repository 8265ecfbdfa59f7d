"""Sessions with an abandoned cart, after all suppressions."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from storelens.functions.text import email_hash, not_blank
from storelens.functions.timewin import as_utc, in_window, ts_lit
from storelens.operators.ranking import latest_by, topk_per_key

SESSION = ["user_id_comp", "session_id"]


def last_session(sessions: DataFrame) -> DataFrame:
    """Time of the last event per user and session."""
    return sessions.groupBy(*SESSION).agg(F.max("ts").alias("last_session_time"))


def purchase_session(sessions: DataFrame) -> DataFrame:
    """Sessions with a purchase, with the time of the last one."""
    bought = sessions.filter(not_blank("ecommerce"))
    return bought.groupBy(*SESSION).agg(F.max("ts").alias("last_purchase_time"))


def candidate_session(last: DataFrame, cfg, as_of: datetime) -> DataFrame:
    """Sessions whose last event is older than the idle time."""
    idle = ts_lit(as_utc(as_of) - timedelta(minutes=cfg.idle_minutes))
    return last.filter(F.col("last_session_time") < idle)


def last_in_cart(sessions: DataFrame, cfg) -> DataFrame:
    """Up to ``max_items`` items of the cart as seen last, one row per item."""
    order = [F.desc("ts"), F.asc("td_item_ord"), F.desc("event_id")]
    seen = sessions.filter((F.col("td_path") == cfg.cart_path) & not_blank("td_item_id"))
    items = latest_by(
        seen.select(
            *SESSION,
            "td_item_id",
            "td_item_name",
            "td_item_category",
            "td_item_price",
            "td_item_ord",
            "ts",
            "event_id",
        ),
        [*SESSION, "td_item_id"],
        order,
    )
    numbered = topk_per_key(items, SESSION, order, cfg.max_items, "seq_no")
    return numbered.select(
        *SESSION,
        F.col("td_item_id").alias("last_item_id"),
        F.col("td_item_name").alias("last_item_name"),
        F.col("td_item_category").alias("last_item_category"),
        F.col("td_item_price").cast("string").alias("last_item_price"),
        "ts",
        "seq_no",
    )


def recent_purchasers(orders: DataFrame, cfg, as_of: datetime) -> DataFrame:
    """Hashed addresses with an order, not cancelled, in the last hours."""
    since = ts_lit(as_utc(as_of) - timedelta(hours=cfg.purchase_hours))
    rows = in_window(orders, cfg.order_window, as_of, cfg.tz).filter(
        not_blank("email")
        & ~not_blank("cancelled_at")
        & (F.try_to_timestamp("created_at", F.lit("yyyy-MM-dd HH:mm:ss")) >= since)
    )
    return rows.select(email_hash("email").alias("hashed_email")).distinct()


def target_sessions(
    cart: DataFrame,
    candidate: DataFrame,
    purchased: DataFrame,
    purchasers: DataFrame,
    identity: DataFrame,
    suppression: DataFrame,
    cfg,
) -> DataFrame:
    """Carts of idle sessions without purchase, minus excluded, buying and suppressed users.

    A user without a known region is not suppressed.
    """
    open_sessions = (
        candidate.select("session_id")
        .distinct()
        .join(purchased.select("session_id"), "session_id", "left_anti")
    )
    rows = cart.join(open_sessions, "session_id", "left_semi")
    if cfg.excluded_users:
        rows = rows.filter(~F.col("user_id_comp").isin(list(cfg.excluded_users)))
    active = suppression.filter(F.col("effective_to").isNull()).select("prefecture")
    held_back = identity.filter(not_blank("prefectures")).join(
        active, F.col("prefectures") == F.col("prefecture"), "left_semi"
    )
    user = F.col("user_id_comp")
    return rows.join(purchasers, user == F.col("hashed_email"), "left_anti").join(
        held_back.select(F.col("email").alias("_email")), user == F.col("_email"), "left_anti"
    )


def identity_dedup(identity: DataFrame) -> DataFrame:
    """One person id per hashed address: newest update, then smallest id."""
    when = F.coalesce(
        F.unix_seconds(F.try_to_timestamp("updated_at", F.lit("yyyy-MM-dd HH:mm:ss"))), F.lit(0)
    )
    rows = identity.filter(not_blank("email")).select("email", "td_llm_uid", when.alias("_at"))
    return latest_by(rows, ["email"], [F.desc("_at"), F.asc("td_llm_uid")]).drop("_at")


def candidate_send_list(
    targets: DataFrame, identity: DataFrame, rfm: DataFrame, cfg, people: DataFrame | None = None
) -> DataFrame:
    """Items of each user's latest target session, with the purchase segment.

    ``people`` is ``identity_dedup(identity)`` where it is there already.
    """
    known = targets.filter(not_blank("user_id_comp"))
    latest = known.groupBy("user_id_comp").agg(
        F.max(F.struct("ts", "session_id"))["session_id"].alias("session_id")
    )
    items = known.filter(F.col("seq_no") <= cfg.max_items).join(latest, SESSION, "left_semi")
    segment = rfm.filter(F.col("brand") == cfg.brand).select(
        "td_llm_uid",
        F.when(F.col("frequency_all") == 1, "f0")
        .when(F.col("frequency_all") == 2, "f1")
        .otherwise("f3plus")
        .alias("segment"),
    )
    people = identity_dedup(identity) if people is None else people
    people = people.join(segment, "td_llm_uid").select("email", "segment")
    return (
        items.withColumnRenamed("user_id_comp", "email")
        .join(people, "email", "left")
        .select(
            "email",
            "ts",
            "session_id",
            "last_item_id",
            "last_item_name",
            "last_item_category",
            "last_item_price",
            "seq_no",
            F.coalesce("segment", F.lit("unknown")).alias("rfm_segment"),
        )
    )
