"""Keys of many documents asked about together: blocks of documents send their distinct keys and get aligned answers.

A row per key would cost several times the text in shuffles. Here a block of a few
megabytes of text sends one row per bucket of keys, with the keys as one sorted
binary value, and the answer comes back in the same order without the keys. Blocks and buckets both have a
bounded size, and their number grows with the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from storelens.llm.words import pieces
from storelens.llm.workers import map_batches, ship

#: bytes of text in a block, keys in a bucket
BLOCK_BYTES, BUCKET_KEYS = 6 << 20, 1 << 19


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as bytes by place value: high bytes, mostly alike, lie together and compress well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def unpacked(data: bytes | pa.Buffer, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(data, np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind)[:, 0]


def packed_sorted(keys: np.ndarray) -> bytes:
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, "<u8"), dtype=np.uint64)


class Block:
    """Documents that are handled together."""

    def __init__(self, rows: list[pa.RecordBatch], data: list[np.ndarray], offsets: list[np.ndarray]) -> None:
        self.rows = pa.Table.from_batches(rows).combine_chunks()
        self.data = np.concatenate(data)
        shifts = np.cumsum([0, *(len(d) for d in data)])
        self.offsets = np.concatenate(
            [np.zeros(1, np.int64), *(o[1:] + s for o, s in zip(offsets, shifts[:-1]))]
        )


def blocks_of(batches: Iterator[pa.RecordBatch], text: str, apart: str | None = None) -> Iterator[Block]:
    """Blocks of about ``BLOCK_BYTES`` of the column ``text``; rows whose column ``apart`` is true go to blocks of their own."""
    waiting: dict[bool, tuple[list, list, list]] = {}
    for batch in batches:
        marks = [False] if apart is None else [False, True]
        for mark in marks:
            part = batch if apart is None else batch.filter(pa.compute.equal(batch.column(apart), mark))
            for first, data, offsets in pieces(part.column(part.schema.get_field_index(text))):
                rows, datas, places = waiting.setdefault(mark, ([], [], []))
                rows.append(part.slice(first, len(offsets) - 1).drop_columns([text]))
                datas.append(data.copy())
                places.append(offsets)
                if sum(map(len, datas)) >= BLOCK_BYTES:
                    yield Block(*waiting.pop(mark))
    for left in waiting.values():
        yield Block(*left)


Answer = Callable[[np.ndarray, np.ndarray], np.ndarray]


def ask(
    blocks: DataFrame,
    entries: Callable[[pa.RecordBatch, int], tuple[np.ndarray, np.ndarray]],
    total: int,
    answer: Answer,
    kind: str,
    reply: str,
    summary: Callable[[np.ndarray, np.ndarray], int] | None = None,
) -> DataFrame:
    """``(block, bucket, reply, extra)``: for each block the answers to its sorted keys, in runs by bucket.

    ``entries(batch, row)`` gives a block's sorted keys and their values of numpy type ``kind``;
    ``answer(keys, values)`` gets all entries of a bucket, block after block, and returns an
    array of type ``reply`` as long. A key's entries are at most one per block or document, so a
    bucket stays bounded however common a key is in the text. ``total`` is the number of all entries.
    ``summary`` of a bucket's entries is in ``extra`` of one of its rows, which is 0 elsewhere.
    """
    bits = max(0, (max(total, 1) - 1) // BUCKET_KEYS).bit_length()

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                keys, values = entries(batch, row)
                bucket = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
                names, first = np.unique(bucket, return_index=True)
                cuts = [*first.tolist(), len(keys)]
                runs = list(zip(cuts, cuts[1:]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.int64()),
                        pa.array([batch.column(0)[row].as_py()] * len(names), pa.int64()),
                        pa.array([packed_sorted(keys[a:b]) for a, b in runs], pa.binary()),
                        pa.array([packed(values[a:b]) for a, b in runs], pa.binary()),
                    ],
                    ["bucket", "block", "keys", "entries"],
                )

    def reply_to(asked: pa.Table) -> pa.Table:
        asked = asked.sort_by("block")
        keys = [unpacked_sorted(x) for x in asked.column("keys").to_pylist()]
        values = [unpacked(x, kind) for x in asked.column("entries").to_pylist()]
        sizes = np.cumsum([len(k) for k in keys])[:-1]
        keys, values = np.concatenate(keys), np.concatenate(values)
        answers = np.split(answer(keys, values).astype(reply), sizes)
        extra = np.zeros(len(answers), np.int64)
        if summary is not None:
            extra[0] = summary(keys, values)
        return pa.table(
            {
                "block": asked.column("block"),
                "bucket": asked.column("bucket"),
                "reply": pa.array([packed(a) for a in answers], pa.binary()),
                "extra": pa.array(extra),
            }
        )

    ship(blocks.sparkSession)
    asked = map_batches(blocks, send, "bucket bigint, block bigint, keys binary, entries binary")
    return asked.groupBy("bucket").applyInArrow(reply_to, "block bigint, bucket bigint, reply binary, extra bigint")


def with_replies(
    blocks: DataFrame, replies: DataFrame, finish: Callable[[pa.Table, np.ndarray], pa.Table], reply: str, schema: str
) -> DataFrame:
    """``finish(block, answers)`` for each block: its row as a table, and the answers to all its sorted keys."""

    def run(block: pa.Table, told: pa.Table) -> pa.Table:
        told = told.sort_by("bucket").column("reply")
        parts = [unpacked(x.as_buffer(), reply) for x in told]
        return finish(block, np.concatenate(parts) if parts else np.empty(0, reply))

    ship(blocks.sparkSession)
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, schema)


def block_number(partition: int, count: int) -> int:
    return partition << 32 | count


def first_field(replies: DataFrame, fields: int) -> DataFrame:
    """Replies of ``fields`` equally wide fields cut to the first one; its bytes come first in each value."""
    width = F.floor(F.octet_length("reply") / fields).cast("int")
    return replies.select("block", "bucket", F.substring("reply", F.lit(1), width).alias("reply"))


def total_of(blocks: DataFrame, column: str) -> int:
    return blocks.agg(F.coalesce(F.sum(column), F.lit(0))).first()[0]
