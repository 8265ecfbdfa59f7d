"""Abandoned carts from a stream of web events (Structured Streaming).

The batch job re-reads the current day every hour. Here the tasks that read the events sum them up by visitor and
short slice of time; the open sessions are state by cookie, into which slices are taken, and an event-time timer
releases a cart as soon as its visitor has been idle for ``idle_minutes``. Slices later than the watermark are left to the night batch.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from datetime import datetime, timedelta
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from storelens.functions.text import not_blank
from storelens.functions.timewin import as_utc
from storelens.operators.shipping import ship
from storelens.operators.staging import staging_path
from storelens.plans.cart import sendlist
from storelens.streaming.sink import committed_append

MICROS = 1_000_000
STATE = "start bigint, last bigint, n bigint, user string, bought boolean, told boolean, cart string"
OUT = (
    "session_id string, cookie string, user_id_comp string, session_start timestamp, "
    "last_session_time timestamp, n bigint, items string"
)
ITEM = "array<struct<item_id:string,item_name:string,item_category:string>>"


def _listed(items: Column) -> Column:
    """Items of a page in order; nothing where the text is no list."""
    listed = F.from_json(items, "array<string>")
    fields = ("item_id", "item_name", "item_category")
    return F.transform(listed, lambda x: F.struct(*[F.get_json_object(x, f"$.{f}").alias(f) for f in fields]))


class Slice(NamedTuple):
    """A slice as the state function reads it."""

    first: int
    last: int
    n: int
    user: str | None
    bought: bool
    cart: str


class _Session:
    """A session so far; ``cart`` has the newest row of every item: time, place, event, name, category."""

    def __init__(self, state: tuple) -> None:
        self.start, self.last, self.n, self.user, self.bought, self.told, cart = state
        self.cart: dict[str, list] = json.loads(cart)

    def state(self) -> tuple:
        return (self.start, self.last, self.n, self.user, self.bought, self.told, json.dumps(self.cart))

    @staticmethod
    def opened(at: int) -> _Session:
        return _Session((at, at, 0, None, False, False, "{}"))

    def add(self, part: Slice) -> None:
        """Takes in a slice: its first and last time, events, largest user, purchase, and newest row of each item."""
        self.last, self.n, self.told = max(self.last, part.last), self.n + part.n, False
        self.bought |= bool(part.bought)
        if isinstance(part.user, str) and (self.user is None or part.user > self.user):
            self.user = part.user
        for name, row in json.loads(part.cart).items():
            if name not in self.cart or row[:3] > self.cart[name][:3]:
                self.cart[name] = row

    def release(self, cookie: str) -> list[tuple]:
        """The cart, unless there is none, it was bought, or it was released since the last event."""
        due = not (self.told or self.bought) and bool(self.cart)
        self.told = True
        if not due:
            return []
        newest = sorted(self.cart.items(), key=lambda x: x[1][:3], reverse=True)
        items = [{"item_id": k, "item_name": v[3], "item_category": v[4]} for k, v in newest]
        code = hashlib.sha256(f"{cookie}|{self.start // MICROS}".encode()).hexdigest()
        start, last = (pd.Timestamp(t, unit="us") for t in (self.start, self.last))
        return [(code, cookie, self.user, start, last, self.n, json.dumps(items))]


_PER_ITEM = ["cookie", "slice", "item_id"]
_NEWEST = ["at", "up", "event_id"]
SLICE = "cookie string, until timestamp, first bigint, last bigint, n bigint, user string, bought boolean, cart string"
#: rows that a task gathers before it sums them up
GATHERED = 200_000


def _reduced(rows: pd.DataFrame, keys: list[str], order: list[str]) -> pd.DataFrame:
    """The last row by ``order`` of each group, with the sums of the group.

    Groups are runs of a sorted array: a group is a row or two, so a call for each of them would take most of the time.
    Users are compared as numbers in the order of their texts.
    """
    group = rows.groupby(keys, sort=False).ngroup().to_numpy()
    by = np.lexsort((*(rows[c].to_numpy() for c in reversed(order)), group))
    group = group[by]
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    out = rows.iloc[by[np.append(starts[1:], len(by)) - 1]][[*keys, *order, "item_name", "item_category"]]
    user, users = pd.factorize(rows["user"], sort=True)
    sums = {
        "first": np.minimum.reduceat(rows["first"].to_numpy()[by], starts),
        "last": np.maximum.reduceat(rows["last"].to_numpy()[by], starts),
        "n": np.add.reduceat(rows["n"].to_numpy()[by], starts),
        "user": users.to_numpy(object)[np.maximum.reduceat(user[by], starts)],
        "bought": np.logical_or.reduceat(rows["bought"].to_numpy(bool)[by], starts),
    }
    return out.reset_index(drop=True).assign(**sums)


def _summed(rows: pd.DataFrame) -> pd.DataFrame:
    """One row per cookie, slice and item, with the item's newest row; rows that are summed already may be among them."""
    return _reduced(rows, _PER_ITEM, _NEWEST)


def _listed_slices(rows: pd.DataFrame) -> pd.DataFrame:
    """A row per cookie and slice; its items are listed in it. The empty item stands for events without one."""
    keys = ["cookie", "slice"]
    out = _reduced(rows, keys, [])
    carts: dict[tuple, dict[str, list]] = {}
    items = rows[rows["item_id"] != ""]
    names = [*keys, "item_id", *_NEWEST, "item_name", "item_category"]
    for cookie, at_slice, name, *row in zip(*(items[c].tolist() for c in names)):
        carts.setdefault((cookie, at_slice), {})[name] = row
    out["cart"] = [json.dumps(carts.get(key, {})) for key in zip(out["cookie"].tolist(), out["slice"].tolist())]
    out["until"] = pd.to_datetime(out["last"], unit="us")
    out["cookie"] = [c or None for c in out["cookie"]]
    out["user"] = [u[1:] if u else None for u in out["user"]]
    return out[[c.split()[0] for c in SLICE.split(", ")]]


def _slices_of_task(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    gathered: list[pd.DataFrame] = []
    count = 0
    for rows in parts:
        gathered.append(rows)
        count += len(rows)
        if count >= GATHERED:
            gathered = [_summed(pd.concat(gathered))]
            count = len(gathered[0])
            if 2 * count >= GATHERED:  # they do not get fewer
                yield _listed_slices(gathered.pop())
                count = 0
    if count:
        yield _listed_slices(_summed(pd.concat(gathered)))


def slices(events: DataFrame, cfg) -> DataFrame:
    """Events summed up by cookie and slice of ``slice_seconds``, in the tasks that read them.

    However many events of a cookie fall into a slice, a task makes one row of them (more only if it reads
    very many slices), so a cookie with a third of all events reaches its state as a row per slice and
    task. A slice is no longer than the idle time, so no visitor falls idle within one. Needs no state, so
    it can stand before the sessions.
    """
    if not 0 < cfg.slice_seconds <= cfg.idle_minutes * 60:
        raise ValueError("a slice has to be as short as the idle time")
    ship(events.sparkSession)
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    listed = F.when(F.col("td_path") == cfg.cart_path, _listed(F.col("items")))
    each = events.filter(F.col("ts").isNotNull()).select(
        F.coalesce("cookie", F.lit("")).alias("cookie"),
        at.alias("at"),
        F.coalesce("event_id", F.lit(0)).cast("bigint").alias("event_id"),
        F.coalesce(F.concat(F.lit("="), F.col("user_id")), F.lit("")).alias("user"),
        not_blank("ecommerce").alias("bought"),
        F.posexplode_outer(listed).alias("place", "item"),
    )
    rows = each.select(
        "cookie",
        F.floor(F.col("at") / F.lit(cfg.slice_seconds * MICROS)).cast("bigint").alias("slice"),
        F.coalesce("item.item_id", F.lit("")).alias("item_id"),
        "at",
        F.coalesce(-F.col("place"), F.lit(0)).cast("bigint").alias("up"),
        "event_id",
        "item.item_name",
        "item.item_category",
        F.col("at").alias("first"),
        F.col("at").alias("last"),
        F.when(F.coalesce("place", F.lit(0)) == 0, 1).otherwise(0).cast("bigint").alias("n"),
        "user",
        "bought",
    )
    return rows.mapInPandas(_slices_of_task, SLICE)


def due_carts(events: DataFrame, cfg, delay: str = "1 minute") -> DataFrame:
    """A row for each time a session with a cart and no purchase falls idle.

    ``events`` is a stream of ts, event_id, cookie, user_id, td_path, items and
    ecommerce. A session ends at a pause of more than ``session_gap_seconds``; a visitor who
    comes back before that continues it, and its cart may fall due once more. The cart holds the
    newest row of every item seen in the session, newest items first. The state function gets a row per slice
    and reading task (``slices``), not one per event.
    """
    idle, gap = cfg.idle_minutes * 60 * MICROS, cfg.session_gap_seconds * MICROS

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        cookie, out = key[0], []
        now = state.getCurrentWatermarkMs() * 1000
        session = _Session(state.get) if state.exists else None
        if state.hasTimedOut:
            out += session.release(cookie)
        else:
            rows = [Slice(*x) for rows in parts for x in zip(*(rows[c].tolist() for c in Slice._fields))]
            # Spark itself drops what ends before the watermark of the batch before
            for part in sorted((x for x in rows if x.last >= now), key=lambda x: x[:2]):
                if session is not None and part.first - session.last > idle:
                    out += session.release(cookie)
                    if part.first - session.last > gap:
                        session = None
                session = session or _Session.opened(part.first)
                session.add(part)
        if session is not None and now > session.last + idle:
            out += session.release(cookie)
        if session is None or now > session.last + gap:
            if state.exists:
                state.remove()
        else:
            state.update(session.state())
            state.setTimeoutTimestamp((session.last + (gap if session.told else idle)) // 1000 + 1)
        if out:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")])

    return (
        slices(events, cfg)
        .withWatermark("until", delay)
        .groupBy("cookie")
        .applyInPandasWithState(run, OUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    )


def cart_items(sessions: DataFrame, cfg) -> DataFrame:
    """Up to ``max_items`` numbered items of each released cart."""
    items = F.slice(F.from_json("items", ITEM), 1, cfg.max_items)
    rows = sessions.select("*", F.posexplode(items).alias("_pos", "_item"))
    return rows.select(
        "session_id",
        F.col("user_id_comp").alias("email"),
        F.col("last_session_time").alias("ts"),
        F.col("_item.item_id").alias("last_item_id"),
        F.col("_item.item_name").alias("last_item_name"),
        F.col("_item.item_category").alias("last_item_category"),
        (F.col("_pos") + 1).alias("seq_no"),
    )


HISTORY = "email string, scheduled_time string, sent_on string, batch_id long"


def counted_days(history: DataFrame, cfg, as_of: datetime) -> DataFrame:
    """Those local days of the history that a cap at ``as_of`` counts: today, with ``rolling_cap`` yesterday too."""
    first = as_utc(as_of) - timedelta(hours=24) if cfg.rolling_cap else as_of
    return history.filter(F.col("sent_on") >= sendlist.local_text(first, "%Y-%m-%d", cfg.tz))


def open_history(spark: SparkSession, path: str) -> None:
    """An empty history of sends, by local day and batch."""
    spark.createDataFrame([], HISTORY).write.mode("ignore").partitionBy("sent_on", "batch_id").parquet(path)


def send_batches(cfg, history_path: str, browser_history: DataFrame, clock):
    """``foreachBatch`` function: caps the users of a batch and appends them to the history.

    ``clock()`` gives the run time. The history (``open_history``) is partitioned by the local day of the send
    and by batch, so a batch reads the sends of the days that count and not the whole history, however long that
    is. A batch that the history has already is not sent again, also not when its repeat falls on another day.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        as_of: datetime = clock()
        history = batch.sparkSession.read.schema(HISTORY).parquet(history_path)
        if not history.filter(F.col("batch_id") == batch_id).isEmpty():
            return
        users = batch.filter(not_blank("user_id_comp")).select(F.col("user_id_comp").alias("email")).distinct()
        due = sendlist.frequency_cap(users, counted_days(history, cfg, as_of), browser_history, cfg, as_of)
        stamps = {"scheduled_time": sendlist.TIME, "sent_on": "%Y-%m-%d"}
        stamped = due.withColumns({c: F.lit(sendlist.local_text(as_of, f, cfg.tz)) for c, f in stamps.items()})
        committed_append(stamped, history_path, batch_id, "sent_on")

    return run


def run_to_end(stream: DataFrame, name: str) -> DataFrame:
    """Feeds all data that is there through a stream and returns what came out."""
    spark = stream.sparkSession
    home = staging_path(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{home}/out")
        .option("checkpointLocation", f"{home}/state")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{home}/out")
