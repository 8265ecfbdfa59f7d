"""Passages that repeat across documents, by content-defined chunks of a gear rolling hash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from storelens.llm.blocks import ask, block_number, blocks_of, total_of, with_replies
from storelens.llm.columns import set_aside
from storelens.llm.words import POWERS, WHITE, hashes, mix, pieces, spans
from storelens.llm.workers import map_batches
from storelens.operators.staging import stage

#: words in the rolling window; a cut lies behind one in CUT_ONE_IN windows
GEAR_WORDS, CUT_ONE_IN = 3, 3
#: words in a chunk: it ends at the first cut from the least on, at the latest after the most; overlaps are wanted
LEAST, MOST = 20, 64
#: places in a window that has a cut in any case, so a chunk ends after ``MOST`` words at the latest
WINDOW = MOST - LEAST

#: an entry is the smallest document with a digest in a block, and how far the largest is above it
DIGEST, ENTRY = "<u8", np.dtype([("least", "<i8"), ("above", "<i8")])


def _force(cut: np.ndarray, gear: np.ndarray) -> None:
    """Sets cuts at the smallest hashes of all windows that have none; they depend on the words near by alone."""
    cuts = np.flatnonzero(cut)
    for i in np.flatnonzero(np.diff(cuts) > WINDOW).tolist():
        g = gear[cuts[i] + 1 : cuts[i + 1]]
        least = sliding_window_view(g, WINDOW).min(axis=1)
        edge = np.zeros(WINDOW - 1, np.uint64)
        # a place is the smallest of a window if the largest of its windows' minima is its own hash
        cut[cuts[i] + 1 : cuts[i + 1]] = sliding_window_view(np.concatenate([edge, least, edge]), WINDOW).max(axis=1) == g


def chunks(h: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, digests and texts of the chunks of many texts, given their words' hashes.

    The gear hash of a place adds the hashes of the words before it, each shifted
    once more than the next; where it is small there is a cut. Cuts depend on the
    ``GEAR_WORDS`` words before them alone, so an insertion moves only those next to it. A chunk starts at
    each cut and each text's start and holds ``LEAST`` words or more, thus chunks overlap, and a
    repeated passage has the same chunks from its first cut on, wherever it stands. Where a window of
    ``WINDOW`` places has no cut, as in text of few repeated words, its smallest gear hashes are cuts as well, all
    of them if they are alike. So chunks leave no word out of a text of ``LEAST`` words or more.
    """
    n = len(h)
    sizes = np.diff(begin)
    place = np.arange(n) - np.repeat(begin[:-1], sizes)
    gear = np.zeros(n + 1, np.uint64)
    for j in range(min(GEAR_WORDS, n)):  # no word of the text before
        gear[1 + j :] += np.where(place[j:] >= j, h[: n - j] << np.uint64(j), np.uint64(0))
    gear = mix(gear)
    cut = gear < np.uint64((1 << 64) // CUT_ONE_IN)
    cut[begin] = True  # starts of texts, and the end
    _force(cut, gear)
    cuts = np.flatnonzero(cut)
    stop = np.repeat(begin[1:], sizes)
    starts = cuts[cuts < n]
    starts = starts[starts + LEAST <= stop[starts]]
    owner = np.searchsorted(begin, starts, side="right") - 1
    ends = cuts[np.searchsorted(cuts, starts + LEAST)] if len(starts) else starts
    if len(starts):  # a text's last chunk reaches to its end
        last = np.flatnonzero(np.concatenate([owner[1:] != owner[:-1], [True]]))
        ends[last] = stop[starts[last]]
    ends = np.minimum(ends, starts + MOST)
    up, down = POWERS.get(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(h * up[:n], out=total[1:])
    digests = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return starts, ends, digests, owner


def _union(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans joined where they overlap or touch; both arrays are in order."""
    if not len(starts):
        return starts, ends
    reach = np.maximum.accumulate(ends)
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    first = np.flatnonzero(new)
    return starts[first], reach[np.concatenate([first[1:] - 1, [len(starts) - 1]])]


def _holders(keys: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """0 where one document alone has the key, 1 in the block of the smallest document that has it, 2 in the others."""
    order = np.argsort(keys, kind="stable")
    k, low = keys[order], entries["least"][order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.empty(0, np.int64)
    out = np.zeros(len(keys), np.uint8)
    if len(first):
        sizes = np.diff([*first, len(k)])
        least = np.repeat(np.minimum.reduceat(low, first), sizes)
        most = np.repeat(np.maximum.reduceat(low + entries["above"][order], first), sizes)
        out[order] = np.where(least == most, 0, np.where(low == least, 1, 2))
    return out


def _sorted(batch: pa.RecordBatch | pa.Table, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted digests of a block's chunks, their documents, the order that sorts them, and where each digest begins."""
    digests = np.frombuffer(batch.column(batch.schema.get_field_index("digests"))[row].as_py(), DIGEST)
    owner = np.frombuffer(batch.column(batch.schema.get_field_index("owner"))[row].as_py(), "<i4")
    ids = np.array(batch.column(batch.schema.get_field_index("ids"))[row].as_py(), np.int64)
    order = np.argsort(digests, kind="stable")
    digests = digests[order]
    first = np.flatnonzero(np.concatenate([[True], digests[1:] != digests[:-1]])) if len(digests) else np.empty(0, np.int64)
    return digests, ids[owner[order]], order, first


def _entries(batch: pa.RecordBatch | pa.Table, row: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct digests of a block, each once however often the block has it, and their entries."""
    digests, ids, _, first = _sorted(batch, row)
    entries = np.zeros(len(first), ENTRY)
    if len(first):
        entries["least"] = np.minimum.reduceat(ids, first)
        entries["above"] = np.maximum.reduceat(ids, first) - entries["least"]
    return digests[first], entries


def _pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    partition = TaskContext.get().partitionId()
    for number, block in enumerate(blocks_of(batches, "text")):
        starts, ends, begin = spans(block.data, block.offsets, WHITE)
        first, last, digests, owner = chunks(hashes(block.data, starts, ends), begin)
        ids = block.rows.column("id").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([block_number(partition, number)], pa.int64()),
                pa.array([len(np.unique(digests))], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([block.rows.column("no_id").to_pylist()], pa.list_(pa.bool_())),
                pa.array([block.rows.column("text_hash").to_pylist()], pa.list_(pa.int64())),
                pa.array([np.diff(begin).tolist()], pa.list_(pa.int64())),
                pa.array([(first - begin[owner]).astype("<i4").tobytes()], pa.binary()),
                pa.array([(last - first).astype("<i4").tobytes()], pa.binary()),
                pa.array([owner.astype("<i4").tobytes()], pa.binary()),
                pa.array([digests.astype(DIGEST).tobytes()], pa.binary()),
            ],
            ["block", "n", "ids", "no_id", "text_hash", "words", "starts", "sizes", "owner", "digests"],
        )


PACKED = (
    "block bigint, n bigint, ids array<bigint>, no_id array<boolean>, text_hash array<bigint>, "
    "words array<bigint>, starts binary, sizes binary, owner binary, digests binary"
)
FOUND = (
    "doc_id bigint, text_hash bigint, n_words bigint, n_chunks bigint, n_shared_words bigint, "
    "n_dropped_words bigint, dropped array<struct<start:int,end:int>>"
)


def _finish(block: pa.Table, flags: np.ndarray) -> pa.Table:
    row = block.combine_chunks().to_batches()[0]
    field = {name: row.column(i)[0] for i, name in enumerate(row.schema.names)}
    starts, sizes, owner = (np.frombuffer(field[c].as_py(), "<i4").astype(np.int64) for c in ("starts", "sizes", "owner"))
    digests, holders, order, first = _sorted(row, 0)
    flag = np.zeros(len(order), np.uint8)
    if len(first):
        runs = np.diff([*first, len(digests)])
        told, least = np.repeat(flags, runs), np.repeat(np.minimum.reduceat(holders, first), runs)
        flag[order] = np.where(told == 0, 0, np.where((told == 1) & (holders == least), 1, 2))
    words = np.array(field["words"].as_py(), np.int64)
    n = len(words)
    base = np.cumsum(words) - words + np.arange(n)  # a gap between texts, so spans of two never touch
    a, b = starts + base[owner], starts + sizes + base[owner]

    def spans_of(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        low, high = _union(a[chosen], b[chosen])
        text = np.searchsorted(base, low, side="right") - 1 if n else low
        return low, high, text, np.bincount(text, high - low, minlength=n).astype(np.int64)

    _, _, _, shared = spans_of(flag > 0)
    low, high, text, gone = spans_of(flag == 2)
    places = np.searchsorted(text, np.arange(n + 1)).astype(np.int32)
    inner = pa.StructArray.from_arrays(
        [pa.array((low - base[text]).astype(np.int32)), pa.array((high - base[text]).astype(np.int32))], names=["start", "end"]
    )
    ids = pa.array([None if none else i for i, none in zip(field["ids"].as_py(), field["no_id"].as_py())], pa.int64())
    return pa.table(
        {
            "doc_id": ids,
            "text_hash": pa.array(field["text_hash"].as_py(), pa.int64()),
            "n_words": pa.array(words),
            "n_chunks": pa.array(np.bincount(owner, minlength=n).astype(np.int64)),
            "n_shared_words": pa.array(shared),
            "n_dropped_words": pa.array(gone),
            "dropped": pa.ListArray.from_arrays(pa.array(places), inner),
        }
    )


def find_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, n_words, n_chunks, n_shared_words, n_dropped_words, dropped)`` for every row.

    Words are ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased. ``n_shared_words`` counts words in chunks that another
    document has, too; ``n_dropped_words`` those in chunks that a document with a smaller
    id has, and ``dropped`` are their spans of words. ``doc_id`` is a whole number; rows with one id are one
    document, and rows with a null id are one that comes last. Null, empty and short texts
    have no chunks. Other columns are not read.
    """
    source = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1)).alias("id"),
        F.col("doc_id").isNull().alias("no_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        "text",
    )
    blocks = stage(map_batches(source, _pack_rows, PACKED), compression="zstd")
    total = total_of(blocks, "n")
    asked = blocks.select("block", "ids", "owner", "digests")
    replies = stage(ask(asked, _entries, total, _holders, ENTRY, "u1"))
    return with_replies(blocks, replies, _finish, "u1", FOUND)


@set_aside("_id", "_hash", "_own", "dropped")
def drop_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the words of ``dropped`` taken out of ``text``, all other columns as they are.

    A span goes from its first word to the start of the word that follows it.
    """
    found = find_repeats(docs).filter("n_dropped_words > 0")
    found = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "dropped")
    found = found.dropDuplicates(["_id", "_hash"])
    own = docs.drop("dropped", "_own").withColumn("_own", F.xxhash64(F.coalesce("text", F.lit(""))))
    same = own["doc_id"].eqNullSafe(found["_id"]) & (own["_own"] == found["_hash"])
    joined = own.join(found, same, "left").drop("_id", "_hash", "_own")
    others = [c for c in docs.columns if c not in ("text", "dropped")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first, data, offsets in pieces(whole.column(len(others))):
                batch = whole.slice(first, len(offsets) - 1)
                starts, _, begin = spans(data, offsets, WHITE)
                texts = []
                for i, (text, gone) in enumerate(zip(batch.column(len(others)), batch.column(len(others) + 1))):
                    if not gone.is_valid:
                        texts.append(text.as_py())
                        continue
                    own_starts = [*(starts[begin[i] : begin[i + 1]] - offsets[i]).tolist(), int(offsets[i + 1] - offsets[i])]
                    raw, kept, at = text.as_py().encode(), [], 0
                    for s in gone.as_py():
                        kept.append(raw[at : own_starts[s["start"]]])
                        at = own_starts[s["end"]]
                    texts.append(b"".join([*kept, raw[at:]]).decode())
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], pa.array(texts, pa.string())], [*others, "text"])

    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([docs.schema[c] for c in others] + [StructField("text", StringType())])
    return map_batches(joined.select(*others, "text", "dropped"), run, schema).select(*[c for c in docs.columns if c != "dropped"])
