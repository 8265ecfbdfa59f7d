"""Periodic runs of words: block matches at dyadic scales seed them, and they are extended to their full length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from storelens.llm.ntt import occurrences
from storelens.llm.pieces import text_runs
from storelens.llm.workers import map_batches

#: a run is at least this many words long, and this many times its period
SHORTEST, REPEATS = 6, 4
#: bytes of text whose runs are looked for together
STEP_BYTES = 1 << 20
#: values that one step of an extension compares
COMPARED = 1 << 20


def next_same(values: np.ndarray) -> np.ndarray:
    """Distance from each value to the next equal one; more than all there are where none follows."""
    out = np.full(len(values), 4 * len(values) + 4, np.int64)
    order = np.argsort(values, kind="stable")
    same = np.flatnonzero(values[order][1:] == values[order][:-1])
    out[order[same]] = order[same + 1] - order[same]
    return out


def _reach(values: np.ndarray, at: np.ndarray, distance: np.ndarray, step: int) -> np.ndarray:
    """How many values from ``at`` on, upwards or downwards, equal those ``distance`` further up."""
    out = np.zeros(len(at), np.int64)
    active, width = np.arange(len(at)), 8
    while len(active):
        still = []
        rows = max(1, COMPARED // width)
        for a in range(0, len(active), rows):
            part = active[a : a + rows]
            place = (at[part] + step * out[part])[:, None] + step * np.arange(width)
            other = place + distance[part][:, None]
            valid = (place >= 0) & (other < len(values))
            same = valid & (values[np.where(valid, place, 0)] == values[np.where(valid, other, 0)])
            whole = same.all(axis=1)
            out[part] += np.where(whole, width, same.argmin(axis=1))
            still.append(part[whole])
        active, width = np.concatenate(still), min(2 * width, 1 << 14)
    return out


class _Known:
    """Runs of smaller periods. At most one of them holds a stretch of twice their greatest period."""

    def __init__(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        order = np.argsort(start, kind="stable")
        self.start, self.end, self.period = start[order], end[order], period[order]
        # of the runs that start up to a place, the one that ends last
        best = np.maximum.accumulate(self.end) if len(order) else self.end
        new = np.concatenate([[True], best[1:] > best[:-1]]) if len(order) else np.empty(0, bool)
        self.farthest = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))

    def around(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """End and period of the run that starts up to each place and ends last; 0 and 1 where there is none."""
        if not len(self.start):
            return np.zeros(len(at), np.int64), np.ones(len(at), np.int64)
        place = np.searchsorted(self.start, at, side="right") - 1
        run = self.farthest[np.maximum(place, 0)]
        return np.where(place >= 0, self.end[run], 0), np.where(place >= 0, self.period[run], 1)


def periodic_runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of all maximal runs, by start and period.

    A run of period ``q`` with ``size <= q < 2 * size`` is at least four periods long, so it holds a whole block of ``size`` values
    (blocks begin at multiples of it) together with its copy ``q`` values on. Thus all distances at which blocks
    stand again within ``[size, 2 * size)`` are found for each power of two; blocks that follow each other with one distance are one
    seed, which reaches less than a block beyond its ends. A block in which some value has no equal one within
    twice the size cannot stand again there and is not transformed, nor one that lies
    with its window inside a run found before: its copies are that run's.
    """
    n = len(values)
    gap = next_same(values)
    none = np.empty(0, np.int64)
    start, end, period = none, none, none
    size = 1
    while REPEATS * size <= n:
        known = _Known(start, end, period)
        blocks = np.arange(n // size, dtype=np.int64) * size
        worst = gap[: len(blocks) * size].reshape(-1, size).max(axis=1)
        blocks = blocks[(worst < 2 * size) & (blocks + 2 * size <= n)]
        blocks = blocks[known.around(blocks)[0] < blocks + 3 * size - 1]
        at, distance = occurrences(values, blocks, size)
        last, of = known.around(at)
        new = (last < at + distance + size) | (distance % of != 0)
        at, distance = at[new], distance[new]
        if len(at):
            order = np.lexsort((at, distance))
            at, distance = at[order], distance[order]
            head = np.concatenate([[True], (distance[1:] != distance[:-1]) | (at[1:] != at[:-1] + size)])
            tail = np.concatenate([head[1:], [True]])
            low, high, distance = at[head], at[tail] + size, distance[head]
            may = high - low + 2 * (size - 1) + distance >= np.maximum(SHORTEST, REPEATS * distance)
            low, high, distance = low[may], high[may], distance[may]
            first = low - _reach(values, low - 1, distance, -1)
            beyond = high + _reach(values, high, distance, 1) + distance
            kept = beyond - first >= np.maximum(SHORTEST, REPEATS * distance)
            start = np.concatenate([start, first[kept]])
            end = np.concatenate([end, beyond[kept]])
            period = np.concatenate([period, distance[kept]])
            # a stretch that repeats with several distances is a run of the smallest
            order = np.lexsort((period, end, start))
            start, end, period = start[order], end[order], period[order]
            own = np.concatenate([[True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])]) if len(start) else none > 0
            start, end, period = start[own], end[own], period[own]
        size *= 2
    order = np.lexsort((period, start))
    return start[order], (end - start)[order], period[order]


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"
ADDED = f"n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs {RUN}, collapsed string"


def _described(texts: list[str]) -> list[tuple]:
    """Rows of ``ADDED`` for some texts, whose words are laid behind each other with a mark of its own after each text."""
    words = [t.encode().split() for t in texts]  # bytes: blanks and the controls 9 to 13 alone separate
    numbers = _Numbers()
    stretches = [np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in words]
    begins = np.cumsum([0, *(len(w) + 1 for w in words)])
    values = np.empty(int(begins[-1]), np.int64)
    for k, (a, s) in enumerate(zip(begins.tolist(), stretches)):
        values[a : a + len(s)] = s
        values[a + len(s)] = len(numbers) + k
    start, length, period = periodic_runs(values)
    owner = np.searchsorted(begins, start, side="right") - 1
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
    out = []
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if a == b:
            out.append((len(words[k]), 0, None, None, None, None, [], b" ".join(words[k]).decode()))
            continue
        s, m, q = (start[a:b] - begins[k]).tolist(), length[a:b].tolist(), period[a:b].tolist()
        runs = list(zip(s, m, q))
        best = runs[0]
        for run in runs[1:]:  # by start and period, so the first of equals stays
            if run[1] * best[2] > best[1] * run[2]:
                best = run
        edges = np.zeros(len(words[k]) + 1, np.int64)
        np.add.at(edges, [x + z for x, _, z in runs], 1)
        np.add.at(edges, [x + y for x, y, _ in runs], -1)
        left = [w for w, inside in zip(words[k], np.cumsum(edges[:-1]).tolist()) if not inside]
        rows = [{"start": x, "length": y, "period": z} for x, y, z in runs]
        out.append((len(words[k]), len(runs), *best, 1000 * best[1] // best[2], rows, b" ".join(left).decode()))
    return out


def find_runs(docs: DataFrame) -> DataFrame:
    """``docs`` without ``text``, with all periodic runs of the words of each text.

    Words are what blanks and the controls 9 to 13 leave between them. A run is a stretch of words with a smallest period ``q``, at least
    ``max(6, 4 * q)`` words long, that no neighbouring word continues. Added: ``n_words``, ``n_runs``, the run of the
    greatest exponent (``start``, ``length``, ``period``, ``exponent_milli``; of equals the first, then the one with the smallest
    period; nulls without a run), ``runs`` (all of them by start and period) and ``collapsed`` (the words, joined by one blank, without those that
    repeat the first period of a run). A null text has no words. Each row counts by itself: repeated
    rows and null ids stay, an empty table gives an empty one, columns of the new names are replaced.
    """
    new = StructType.fromDDL(ADDED)
    others = [c for c in docs.columns if c not in ("text", *new.names)]
    source = docs.select(*others, F.coalesce("text", F.lit("")).alias("text"))
    schema = StructType([docs.schema[c] for c in others] + new.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        types = to_arrow_schema(new).types
        for whole in batches:
            for batch in text_runs(whole, len(others), STEP_BYTES):
                rows = _described(batch.column(len(others)).to_pylist())
                columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*others, *new.names])

    return map_batches(source, run, schema)


def repeating(docs: DataFrame, share: int = 10) -> DataFrame:
    """``docs`` in which the text of every document whose id has a crc32 divisible by ``share`` repeats some of its words.

    With ``n`` words, ``g = floor(crc32(id) / share)``, ``a = g % n`` and ``p = 1 + floor((n - a) / (3 + g % 8))`` each word
    from number ``a`` on becomes the word ``a + (i - a) % p``. Null texts and texts without words stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / F.lit(share)).cast("bigint")

    def repeat(words: Column) -> Column:
        n = F.size(words).cast("bigint")
        a = F.pmod(g, n)
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
        unit = F.slice(words, (a + 1).cast("int"), p.cast("int"))
        tail = F.flatten(F.array_repeat(unit, F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), F.lit(1), F.size(words)), " ")

    # bound to a lambda's variable, the words are found once
    words = F.transform(F.array(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), 0)), repeat)[0]
    chosen = (F.pmod(h, F.lit(share)) == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return docs.withColumn("text", F.when(chosen, words).otherwise(F.col("text")))
