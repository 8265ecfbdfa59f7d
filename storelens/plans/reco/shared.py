"""One pass over purchases and one over the web log for all logics of a run.

Each logic reads its own window of the same two tables, and these are often joins themselves. Here each
table is read once: a row gets a bit for every window that holds it, rows in no window are left out, and the
rest is staged. A logic then reads the rows with its window's bit.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from storelens.functions.timewin import in_window, ts_lit, window_bounds
from storelens.operators.staging import stage

SHARED = ("purchases", "weblog")


class WindowScan(dict):
    """Tables of a run, of which ``purchases`` and ``weblog`` are staged with the windows that were asked for.

    ``bits`` has the place of each window (its text and zone) in the mask of a row. Other windows are read from the given tables.
    """

    def __init__(self, t: dict[str, DataFrame], windows: Iterable[tuple[str, str]], as_of: datetime) -> None:
        super().__init__(t)
        self.as_of = as_of
        self.bits = {w: k for k, w in enumerate(sorted(set(windows)))}
        if len(self.bits) > 63:
            raise ValueError("a mask has 63 windows at most")
        self.staged = {name: self._marked(t[name]) for name in SHARED if name in t}

    def _marked(self, rows: DataFrame) -> DataFrame:
        free = next(n for n in (f"windows{k}" for k in range(len(rows.columns) + 1)) if n not in rows.columns)
        bits = []
        for (spec, tz), place in self.bits.items():
            start, end = window_bounds(spec, self.as_of, tz)
            inside = F.lit(True)
            if start is not None:
                inside &= F.col("ts") >= ts_lit(start)
            if end is not None:
                inside &= F.col("ts") < ts_lit(end)
            bits.append(F.when(inside, F.lit(1 << place)).otherwise(F.lit(0)).cast("bigint"))
        mask = reduce(lambda a, b: a.bitwiseOR(b), bits)
        return stage(rows.withColumn(free, mask).filter(F.col(free) != 0))

    def window(self, name: str, spec: str, as_of: datetime, tz: str) -> DataFrame:
        """Rows of a table in a window."""
        place = self.bits.get((spec, tz))
        if place is None or as_of != self.as_of or name not in self.staged:
            return in_window(self[name], spec, as_of, tz)
        rows = self.staged[name]
        mask = rows.columns[-1]
        return rows.filter(F.col(mask).bitwiseAND(F.lit(1 << place)) != 0).drop(mask)


def windows_of(cfg, names: Iterable[str]) -> set[tuple[str, str]]:
    """The windows of the enabled logics and of the final list."""
    found = set()
    for part in [getattr(cfg, n) for n in names if getattr(cfg, n).enabled]:
        found.add((part.window, part.tz))
        found |= {(f"-{getattr(part, d)}d", part.tz) for d in ("lookback_days", "active_days") if getattr(part, d, 0)}
    if cfg.final.exclude_purchased_within_days > 0:
        found.add((f"-{cfg.final.exclude_purchased_within_days}d", cfg.final.tz))
    return found


def share_windows(t: dict[str, DataFrame], cfg, as_of: datetime, names: Iterable[str]) -> WindowScan:
    """The tables of a run of the logics ``names``, read once."""
    return WindowScan(dict(t), windows_of(cfg, names), as_of)
