"""Benchmark passages in documents, found by joined winnowed fingerprints and extended word by word."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from storelens.llm.columns import set_aside
from storelens.llm.words import PUNCTUATION, hashes, mix, pieces, spans, windows
from storelens.llm.workers import map_batches
from storelens.operators.staging import stage

#: words in a window that counts as a leak; words in a k-gram, whose smallest hash stands for the window
WINDOW, GRAM = 10, 4
#: words that a window can reach beyond its fingerprint's k-gram on either side
REACH = WINDOW - GRAM
#: words of 64 bits in the filter of benchmark windows: 8 MB, whatever the benchmark's size
SLOT_BITS = 20
#: bytes of a word that are compared as they are; of longer words a digest is
WORD_BYTES = 16

PRINT = [
    ("at", pa.int32()),
    ("size", pa.int32()),
    ("key", pa.int64()),
    ("context", pa.binary()),
    ("left", pa.list_(pa.binary())),
    ("right", pa.list_(pa.binary())),
]
PRINT_SQL = "at int, size int, key bigint, context binary, left array<binary>, right array<binary>"


class _Text:
    """The words of several texts: hashes, and the words around a place."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.starts, self.ends, self.begin = spans(data, offsets, PUNCTUATION)
        self.h, self.raw = hashes(data, self.starts, self.ends), data
        self.stop = np.repeat(self.begin[1:], np.diff(self.begin))

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each run of ``size`` words, and whether it lies in one text."""
        keys = windows(self.h, size)
        keys = mix(keys + np.uint64(size * 0x9E3779B97F4A7C15 % 2**64))
        return keys, np.arange(size, len(keys) + size) <= self.stop[: len(keys)]

    def winnowed(self, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Place and key of the fingerprint of each run of ``size`` words that begins at ``at``.

        Of a full window it is the smallest hash of its k-grams, the last one among equals; a shorter run, all of a
        short item, is its own.
        """
        if size < WINDOW:
            return at, self.windows(size)[0][at]
        grams = windows(self.h, GRAM)
        around = grams[at[:, None] + np.arange(REACH, -1, -1)]
        places = at + REACH - np.argmin(around, axis=1)
        return places, mix(grams[places] ^ np.uint64(size))

    def word(self, i: int) -> bytes:
        w = self.raw[self.starts[i] : self.ends[i]].tobytes().lower()
        return w if len(w) <= WORD_BYTES else b"\0" + hashlib.blake2b(w, digest_size=16).digest()

    def prints(self, places: np.ndarray, keys: np.ndarray, size: int) -> tuple[np.ndarray, list[tuple]]:
        """Number of the text of each place, and the fields of its fingerprint: the words left of it, nearest
        first, and those from it on, as far as a window can reach."""
        text = np.searchsorted(self.begin, places, side="right") - 1
        out = []
        for row, p, key in zip(text.tolist(), places.tolist(), keys.view(np.int64).tolist()):
            low, high = int(self.begin[row]), int(self.begin[row + 1])
            reach = REACH if size == WINDOW else 0
            left = [self.word(i) for i in range(p - 1, max(low, p - reach) - 1, -1)]
            right = [self.word(i) for i in range(p, min(high, p + size))]
            parts = [size.to_bytes(1, "little"), len(left).to_bytes(1, "little"), *left, *right]
            context = hashlib.blake2b(b" ".join(parts), digest_size=16).digest()
            out.append((p - low, size, key, context, left, right))
        return text, out


def _columns(rows: list[tuple]) -> list[pa.Array]:
    return [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(PRINT)]


def item_prints(benchmark: DataFrame) -> DataFrame:
    """``(item_id, windows, at, size, key, context, left, right)``: an item's winnowed fingerprints.

    A fingerprint stands for a stretch of windows that share it; ``windows`` are their hashes. An item of
    fewer than ``WINDOW`` words has one. Ids are strings; a null id is the empty string. Items without words give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in pieces(batch.column(1)):
                text = _Text(data, offsets)
                counts = np.minimum(np.diff(text.begin), WINDOW)
                owners, prints, covered = [], [], []
                for size in np.unique(counts[counts > 0]).tolist():
                    whole, inside = text.windows(size)
                    mine = np.repeat(counts, np.diff(text.begin))[: len(whole)] == size
                    at = np.flatnonzero(inside & mine)
                    places, keys = text.winnowed(at, size)
                    # windows that share a fingerprint follow one another
                    new = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
                    rows, found = text.prints(places[new], keys[new], size)
                    owners += (rows + first).tolist()
                    prints += found
                    covered += [w.view(np.int64) for w in np.split(whole[at], new[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(owners, pa.int64())),
                        pa.array(covered, pa.list_(pa.int64())),
                        *_columns(prints),
                    ],
                    ["item_id", "windows", *(n for n, _ in PRINT)],
                )

    source = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    return map_batches(source, run, f"item_id string, windows array<bigint>, {PRINT_SQL}")


def window_filter(items: DataFrame) -> np.ndarray:
    """A bit set of the items' windows: ``2 ** SLOT_BITS`` numbers of 64 bits, put together on the executors."""
    slot = F.shiftrightunsigned("key", 64 - SLOT_BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("key").bitwiseAND(F.lit(63).cast("long")).cast("int"))
    keys = items.select(F.explode("windows").alias("key"))
    rows = keys.groupBy(slot.alias("slot")).agg(F.bit_or(bit).alias("bits")).toPandas()
    out = np.zeros(1 << SLOT_BITS, np.uint64)
    out[rows["slot"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def _maybe(filter_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slots = filter_[(keys >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
    return slots >> (keys & np.uint64(63)) & np.uint64(1) == 1


def document_prints(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``(row, doc_id, text_hash, n_words, prints)`` for each document.

    ``prints`` are its winnowed fingerprints, without those all of whose windows the filter shows to be in no item.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(window_filter(items))
    # the lengths of short items are a few numbers below WINDOW
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for whole in batches:
            for first, data, offsets in pieces(whole.column(3)):
                batch = whole.slice(first, len(offsets) - 1)
                text = _Text(data, offsets)
                owners, prints = [np.empty(0, np.int64)], []
                for size in sizes:
                    keys, inside = text.windows(size)
                    at = np.flatnonzero(inside & _maybe(known, keys))
                    if len(at):
                        places, keys = text.winnowed(at, size)
                        places, once = np.unique(places, return_index=True)
                        rows, found = text.prints(places, keys[once], size)
                        owners.append(rows)
                        prints += found
                owners = np.concatenate(owners)
                order = np.argsort(owners, kind="stable")
                places = np.searchsorted(owners[order], np.arange(len(batch) + 1)).astype(np.int32)
                values = pa.StructArray.from_arrays(_columns([prints[i] for i in order.tolist()]), fields=[pa.field(*f) for f in PRINT])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:3], pa.array(np.diff(text.begin)), pa.ListArray.from_arrays(pa.array(places), values)],
                    ["row", "doc_id", "text_hash", "n_words", "prints"],
                )

    text = F.coalesce("text", F.lit(""))
    source = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text")
    )
    id_type = source.schema["doc_id"].dataType.simpleString()
    fields = PRINT_SQL.replace(" ", ":").replace(",:", ",")
    schema = f"row bigint, doc_id {id_type}, text_hash bigint, n_words bigint, prints array<struct<{fields}>>"
    return map_batches(source, run, schema)


def _common(a: str, b: str) -> Column:
    """Number of leading entries in which two arrays agree."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False))
    return F.when(differ > 0, differ - 1).otherwise(F.size(a)).cast("int")


def extended(prints: DataFrame, items: DataFrame) -> DataFrame:
    """``(context, item_context, before, after)``: fingerprints of documents joined with those of items and extended.

    A meeting is followed word by word to the left and from the k-gram on to the right, as far as the texts agree and a window can
    reach; it stays if that holds a window. Each surrounding is compared once, however many documents or items have it.
    """
    ours = prints.select("key", "size", "context", "left", "right").dropDuplicates(["context"])
    theirs = items.select(
        "key", "size", F.col("context").alias("item_context"), F.col("left").alias("t_left"), F.col("right").alias("t_right")
    ).dropDuplicates(["item_context"])
    met = ours.join(theirs, ["key", "size"])
    met = met.withColumns({"before": _common("left", "t_left"), "after": _common("right", "t_right")})
    return met.filter(F.col("before") + F.col("after") >= F.col("size")).select("context", "item_context", "before", "after")


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, n_words, n_hit, n_items, item_ids, spans)`` for every row of ``docs``.

    Texts are lower-cased (A-Z) and split into runs of letters, digits and
    characters beyond ASCII. A document word is hit if it lies in a run of ``WINDOW``
    words that an item has too, or in all words of a shorter item. A run of so many shared words has the same fingerprint
    in both texts, so joining fingerprints misses none. ``item_ids`` are
    sorted strings, ``spans`` the ``(start, size)`` of the extended meetings. Null and empty texts
    have no words and no hits; an empty benchmark hits nothing; repeated rows
    and items each count. Other columns are not read.
    """
    items = stage(item_prints(benchmark))
    seen = stage(document_prints(docs, items))
    asked = seen.filter(F.size("prints") > 0).select("row", F.explode("prints").alias("p")).select("row", "p.*")
    met = stage(extended(asked, items))
    reach = met.groupBy("context").agg(F.collect_set(F.struct("before", "after")).alias("reach"))  # at most 49
    places = asked.select("row", "at", "context").join(reach, "context").select("row", "at", F.explode("reach").alias("r"))
    span = F.struct((F.col("at") - F.col("r.before")).alias("start"), (F.col("r.before") + F.col("r.after")).alias("size"))
    places = places.groupBy("row").agg(F.collect_set(span).alias("spans"))
    holders = met.join(items.select(F.col("context").alias("item_context"), "item_id").distinct(), "item_context")
    named = (
        asked.select("row", "context")
        .distinct()
        .join(holders.select("context", "item_id").distinct(), "context")
        .select("row", "item_id")
        .distinct()
        .groupBy("row")
        .agg(F.sort_array(F.collect_list("item_id")).alias("item_ids"))
    )
    words = F.array_distinct(
        F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["size"] - 1)))
    )
    found = places.withColumn("n_hit", F.size(words).cast("long")).join(named, "row")
    none = F.array().cast("array<string>")
    return (
        seen.drop("prints")
        .join(found, "row", "left")
        .select(
            "doc_id",
            "text_hash",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("item_ids", none).alias("item_ids"),
            F.sort_array("spans").alias("spans"),
        )
    )


@set_aside("_id", "_hash", "_own")
def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, in which no word is hit."""
    leaks = find_leaks(docs.select("doc_id", "text"), benchmark).filter("n_hit > 0")
    bad = leaks.select("doc_id", "text_hash").distinct().toDF("_id", "_hash")
    own = docs.withColumn("_own", F.xxhash64(F.coalesce("text", F.lit(""))))
    return own.join(bad, own["doc_id"].eqNullSafe(bad["_id"]) & (own["_own"] == bad["_hash"]), "left_anti").drop("_own")
