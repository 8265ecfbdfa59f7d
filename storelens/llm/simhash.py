"""Near copies by SimHash fingerprints and covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from storelens.llm.columns import set_aside
from storelens.llm.components import components
from storelens.llm.workers import map_batches
from storelens.operators.staging import stage

#: words in a shingle, differing bits that still link, seed of the shingle hash
SHINGLE, RADIUS, SEED = 3, 2, 42
BITS = 64
#: shingles that are counted bit by bit in one step
STEP = 1 << 17


def shingle_hashes(text: str | None, k: int) -> list[int]:
    """XXH64 of each run of ``k`` lower-cased words, repeats included; all words where there are fewer."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return []
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= k:
        return [digest(joined, SEED)]
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    return [digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[k - 1 :])]


def majorities(values: list[int], counts: list[int]) -> np.ndarray:
    """A fingerprint for each run of ``counts`` hashes: bits that are set in over half of the run."""
    out = np.zeros(len(counts), np.uint64)
    sizes = np.asarray(counts, np.int64)
    filled = np.flatnonzero(sizes)
    if len(filled):
        h = np.array(values, "<u8")
        bits = np.zeros((len(filled), BITS), np.int64)
        ends = np.cumsum(sizes[filled])
        # a very long text is counted in steps, so the unpacked bits stay small
        for low in range(0, len(h), STEP):
            high = min(low + STEP, len(h))
            unpacked = np.unpackbits(h[low:high].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            a, b = np.searchsorted(ends, low, side="right"), np.searchsorted(ends, high - 1, side="right")
            begins = np.concatenate([[low], ends[a:b]]) - low
            bits[a : b + 1] += np.add.reduceat(unpacked, begins, axis=0, dtype=np.int32)
        most = (2 * bits > sizes[filled][:, None]).astype(np.uint8)
        out[filled] = np.packbits(most, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """``(doc_id, text_hash, fp)`` of every row; a text without words (or null) has fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, values, counts = [], [], []
            for text in batch.column("text"):
                got = shingle_hashes(text.as_py(), k)
                values += got
                counts.append(len(got))
                if len(values) >= STEP:
                    found.append(majorities(values, counts))
                    values, counts = [], []
            found.append(majorities(values, counts))
            fp = np.concatenate(found).view(np.int64)
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(fp)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "fp"])

    source = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    id_type = source.schema["doc_id"].dataType.simpleString()
    return map_batches(source, run, f"doc_id {id_type}, text_hash bigint, fp bigint")


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """Bit masks such that any two values that differ in at most ``radius`` bits agree under one of them.

    Each position gets a nonzero vector of ``radius + 1`` bits, all vectors about
    equally often. There is a mask for each nonzero vector: the positions whose
    vector has an odd product with it. ``radius`` positions span at most
    ``radius`` dimensions, so some mask misses all of them.
    """
    vectors = [1 + i % ((2 << radius) - 1) for i in range(bits)]
    return [
        sum(1 << i for i in range(bits) if bin(vectors[i] & v).count("1") % 2)
        for v in range(1, 2 << radius)
    ]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges ``(u, v)`` that join all fingerprints (column ``fp``, distinct) within ``radius`` differing bits.

    Fingerprints meet in the tables of ``covering_masks``. Within a bucket the
    masked bits agree, and each member stands under all values that differ from
    it in up to ``radius // 2`` of the other bits (for an odd radius the last step is
    checked). Two members within the radius meet under such a value, and those
    that meet are within it, so each meeting is a star to its smallest member. A
    meeting has a fixed largest size, so work is linear however full a bucket is.
    """
    if radius not in (0, 1, 2):
        raise ValueError("the radius is 0, 1 or 2")
    masks = covering_masks(radius)
    rows = prints.select(
        "fp",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("key"))
                    for t, m in enumerate(masks)
                ]
            )
        ).alias("b"),
    ).select("fp", "b.t", "b.key")
    shared = rows.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1").select("t", "key")
    members = rows.join(shared, ["t", "key"], "left_semi")
    free = [[0, *(_signed(1 << i) for i in range(BITS) if not m >> i & 1)] for m in masks]
    flips = F.array(*[F.array(*[F.lit(x).cast("long") for x in (f if radius else [0])]) for f in free])
    met = members.select("t", "fp", F.explode(F.get(flips, F.col("t"))).alias("flip")).select(
        "t", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("at")
    )
    meetings = met.groupBy("t", "at").agg(F.collect_set("fp").alias("all")).filter(F.size("all") > 1)
    edges = meetings.select(F.explode("all").alias("u"), F.array_min("all").alias("v")).filter("u <> v")
    if radius == 1:  # the two values that meet may be two bits apart: keep those that are not
        edges = meetings.select(F.explode("all").alias("u"), "all").select(
            "u", F.explode("all").alias("v")
        ).filter((F.col("u") > F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= 1))
    return edges.distinct()


def _classes(prints: DataFrame, radius: int) -> DataFrame:
    """``(fp, best)``: for each fingerprint the first row ``(no id, doc_id, text_hash)`` of its component."""
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    nodes = stage(prints.groupBy("fp").agg(F.min(row).alias("first")))
    found = components(links(nodes.select("fp"), radius)).toDF("fp", "root")
    rooted = stage(
        nodes.join(found, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    )
    best = rooted.groupBy("root").agg(F.min("first").alias("best"))
    return rooted.join(best, "root").select("fp", "best")


def groups(docs: DataFrame, k: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``(text_hash, group)``, staged: a row for each text; texts that fingerprints within ``radius`` bits link have one group."""
    prints = stage(fingerprints(docs.select("doc_id", "text"), k).select("text_hash", "fp").distinct())
    found = components(links(stage(prints.select("fp").distinct()), radius)).toDF("fp", "root")
    return stage(prints.join(found, "fp", "left").select("text_hash", F.coalesce("root", "fp").alias("group")))


def near_copies(docs: DataFrame, k: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, fp, component_id)``: documents linked by fingerprints within ``radius`` bits.

    ``component_id`` is the smallest ``doc_id`` reachable, null only where all ids of
    the component are null. Exact copies share a fingerprint and are one node, so
    a group of copies costs one row. Repeated rows each get their row; an empty
    table gives no rows; other columns are not read.
    """
    prints = stage(fingerprints(docs, k))
    classes = stage(_classes(prints, radius).select("fp", F.col("best.doc_id").alias("component_id")))
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


@set_aside("_id", "_hash", "_hash_")
def drop_near_copies(docs: DataFrame, k: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    All columns of ``docs`` stay. A null id comes after all others; ties of the id are
    broken by the text, and of rows with the same id and text one stays.
    """
    best = _classes(stage(fingerprints(docs.select("doc_id", "text"), k)), radius)
    best = best.select("best.doc_id", "best.text_hash").distinct().toDF("_id", "_hash")
    own = docs.withColumn("_hash_", F.xxhash64(F.coalesce("text", F.lit(""))))
    same = own["doc_id"].eqNullSafe(best["_id"]) & (own["_hash_"] == best["_hash"])
    return own.join(best, same, "left_semi").dropDuplicates(["doc_id", "_hash_"]).drop("_hash_")
