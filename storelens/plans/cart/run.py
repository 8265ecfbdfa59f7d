"""The cart-abandonment job from web events to the send list and its history rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from storelens.operators.staging import stage
from storelens.plans.cart import payload, sendlist, targets, weblog


def sessions(t: dict, cfg, as_of: datetime) -> DataFrame:
    prepared = weblog.prepare_web_events(t["source_web_events"], t["ip_ranges"], cfg, as_of)
    return weblog.sessionize_weblog(prepared, cfg, as_of)


def cart_targets(t: dict, log: DataFrame, cfg, as_of: datetime) -> DataFrame:
    return targets.target_sessions(
        targets.last_in_cart(log, cfg),
        targets.candidate_session(targets.last_session(log), cfg, as_of),
        targets.purchase_session(log),
        targets.recent_purchasers(t["orders_raw"], cfg, as_of),
        t["identity_map"],
        t["suppression"],
        cfg,
    )


def capped_candidates(t: dict, log: DataFrame, cfg, as_of: datetime) -> DataFrame:
    rows = stage(cart_targets(t, log, cfg, as_of))
    found = targets.candidate_send_list(rows, t["identity_map"], t["rfm"], cfg, t.get("people"))
    return sendlist.frequency_cap(found, t["cart_history"], t["browser_history"], cfg, as_of)


def carts(t: dict, log: DataFrame, cfg, as_of: datetime) -> DataFrame:
    return sendlist.cart_pivot(stage(capped_candidates(t, log, cfg, as_of)), sendlist.products_of(t))


def push_list(t: dict, cfg, as_of: datetime, log: DataFrame | None = None) -> DataFrame:
    """The whole job up to the send list; what several steps read is made once and staged."""
    log = stage(sessions(t, cfg, as_of)) if log is None else log
    t = sendlist.share_offers(t, cfg)
    wide = stage(carts(t, log, cfg, as_of))
    t["bought"] = stage(sendlist.bought_by(wide, t, cfg, as_of, ["f1", "f3plus"]))
    recos = [
        sendlist.segment_reco_new(wide, t, cfg),
        sendlist.segment_reco_f1(wide, t, cfg, as_of),
        sendlist.segment_reco_f3plus(wide, t, cfg, as_of),
    ]
    return sendlist.push_send_list(wide, recos, cfg, as_of)


def run_cart(t: dict, cfg, as_of: datetime) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Send list, payload, and the rows to append to the send history."""
    push = stage(push_list(t, cfg, as_of))
    mails = payload.send_payload(
        push, t["customers"], t["attributes"], t["product_stock"], cfg, as_of
    )
    history = payload.send_history(push, t["attributes"], t["product_stock"], cfg, as_of)
    return push, mails, history
