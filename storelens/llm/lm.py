"""Language-model scores by deleted interpolation of word pairs, words and a uniform share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from storelens.llm.blocks import (
    Block,
    ask,
    block_number,
    blocks_of,
    first_field,
    packed,
    packed_sorted,
    total_of,
    unpacked,
    unpacked_sorted,
    with_replies,
)
from storelens.llm.words import WHITE, hashes, mix, spans
from storelens.llm.workers import map_batches
from storelens.operators.staging import stage

#: folds of documents by the checksum of their id; one is held out, one of the others teaches the mixture weights
FOLDS, HELD_OUT, DELETED = 7, 2, 3
#: steps per octave of the probabilities in the histogram from which the weights are learned
STEPS = 8
#: context-frequency buckets: one per power of two
BUCKETS = 64
#: rounds of expectation-maximisation at most, and the change that ends them
ROUNDS, CLOSE = 200, 1e-7
#: least weight of the uniform share, so no text has probability zero
FLOOR = 1e-6

#: keys of words are odd, those of pairs and of the text's start are even
END_KEY = np.uint64(0xE1D5_0F7E_0000_0001)
START_KEY = np.uint64(0x57A2_70F7_E870_0002)
ENTRY = REPLY = "<u8,<u8"


def _pack(block: Block, number: int, deleted: bool) -> pa.RecordBatch:
    """A block's documents as numbers of its distinct words."""
    starts, ends, begin = spans(block.data, block.offsets, WHITE)
    h = hashes(block.data, starts, ends) | np.uint64(1)
    n = len(begin) - 1
    lengths = np.diff(begin) + 1  # an end for each text
    tokens = np.full(len(h) + n, END_KEY)
    last = np.cumsum(lengths) - 1
    inner = np.ones(len(tokens), bool)
    inner[last] = False
    tokens[inner] = h
    keys, places = np.unique(tokens, return_inverse=True)
    pairs = np.unique(_codes(places, lengths, len(keys)))
    fold = np.array(block.rows.column("fold").to_pylist(), np.int64)
    taught = np.repeat(fold != HELD_OUT, lengths)

    def one(values: pa.Array | pa.ChunkedArray) -> pa.ListArray:
        flat = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
        return pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), flat)

    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()),
            pa.array([deleted]),
            pa.array([len(keys) + 1 + len(pairs)], pa.int64()),
            pa.array([int(taught.sum())], pa.int64()),
            pa.array([int(taught.sum()) if deleted else 0], pa.int64()),
            one(block.rows.column("doc_id")),
            one(pa.array(fold)),
            one(pa.array(lengths)),
            pa.array([packed_sorted(keys)], pa.binary()),
            pa.array([packed(places.astype("<u4"))], pa.binary()),
        ],
        ["block", "deleted", "n_keys", "n_train", "n_deleted", "ids", "folds", "lengths", "words", "tokens"],
    )


def _codes(places: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Each token with the one before it (``n`` at a text's start) as one number."""
    before = np.concatenate([[n], places[:-1]]).astype(np.int64)
    before[np.cumsum(lengths)[:-1]] = n
    return before * (n + 1) + places


class _Opened:
    """A packed block with its keys: distinct words, the start, distinct pairs."""

    def __init__(self, batch: pa.RecordBatch, row: int) -> None:
        field = {name: batch.column(i)[row] for i, name in enumerate(batch.schema.names)}
        words = unpacked_sorted(field["words"].as_py())
        self.tokens = unpacked(field["tokens"].as_buffer(), "<u4")
        self.lengths = np.array(field["lengths"].as_py(), np.int64)
        self.folds = np.array(field["folds"].as_py(), np.int64)
        self.ids = field["ids"].values
        n = len(words)
        codes, pair = np.unique(_codes(self.tokens, self.lengths, n), return_inverse=True)
        self.pair = pair.astype(np.int32)
        self.singles = np.concatenate([words, [START_KEY]])
        self.context = (codes // (n + 1)).astype(np.int32)
        self.word = (codes % (n + 1)).astype(np.int32)
        del codes, pair
        pairs = mix(self.singles[self.context] * np.uint64(0x9E3779B97F4A7C15) + words[self.word]) & ~np.uint64(1)
        self.keys = np.concatenate([self.singles, pairs])
        self.order = np.argsort(self.keys, kind="stable").astype(np.int32)

    def counts(self) -> np.ndarray:
        """Of each key in sorted order: tokens (texts for the start) in training, and those in the deleted fold."""
        out = np.empty(len(self.keys), ENTRY)
        for name, texts in (("f0", self.folds != HELD_OUT), ("f1", self.folds == DELETED)):
            weight = np.repeat(texts, self.lengths).astype(np.float64)
            n = len(self.singles)
            words = np.bincount(self.tokens, weight, minlength=n)
            words[n - 1] = texts.sum()
            pairs = np.bincount(self.pair, weight, minlength=len(self.context))
            out[name] = np.concatenate([words, pairs])[self.order].astype(np.uint64)
        return out

    def told(self, answers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Corpus counts of the single keys and of the pairs."""
        found = np.empty(len(self.keys), np.int64)
        found[self.order] = answers
        return found[: len(self.singles)], found[len(self.singles) :]


def _entries(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray]:
    opened = _Opened(batch, row)
    return opened.keys[opened.order], opened.counts()


def _sums(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each entry's key's sum over all entries."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    sizes = np.diff([*first, len(k)])
    out = np.empty(len(keys), REPLY)
    for name in ("f0", "f1"):
        out[name][order] = np.repeat(np.add.reduceat(counts[name][order], first), sizes)
    return out


def _known_words(keys: np.ndarray, counts: np.ndarray) -> int:
    taught = keys[(keys & np.uint64(1) == 1) & (counts["f0"] > 0)]
    return len(np.unique(taught))


def bucket_of(count: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else one more than the whole part of the base-2 logarithm of its count."""
    return np.where(count > 0, np.floor(np.log2(np.maximum(count, 1))) + 1, 0).astype(np.int64)


def _steps(part: np.ndarray, whole: np.ndarray | float) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        steps = np.rint(-STEPS * np.log2(part / whole))
    return np.where(part > 0, steps, -1).astype(np.int64)


HISTOGRAM = "bucket bigint, pair bigint, word bigint, n bigint"


def learn_weights(rows: dict[str, np.ndarray], words: int) -> np.ndarray:
    """Weights ``[bucket, (pair, word, uniform)]`` by expectation-maximisation.

    ``rows`` counts the deleted fold's tokens by context bucket and by the rounded
    logarithms of their pair and word estimates (-1: never seen). Buckets without tokens take the weights of the bucket
    below.
    """
    bucket, n = rows["bucket"], rows["n"].astype(np.float64)
    pair = np.where(rows["pair"] >= 0, 2.0 ** (-rows["pair"] / STEPS), 0.0)
    word = np.where(rows["word"] >= 0, 2.0 ** (-rows["word"] / STEPS), 0.0)
    parts = np.stack([pair, word, np.full(len(n), 1.0 / (words + 1))], axis=1)
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = [0, 0.5, 0.5]  # no estimate from a context that was never seen
    size = np.bincount(bucket, n, minlength=BUCKETS)
    for _ in range(ROUNDS):
        share = weights[bucket] * parts
        share *= (n / share.sum(axis=1))[:, None]
        new = np.stack([np.bincount(bucket, share[:, i], minlength=BUCKETS) for i in range(3)], axis=1)
        new = np.where(size[:, None] > 0, new / np.maximum(size, 1)[:, None], weights)
        change = np.abs(new - weights).max()
        weights = new
        if change < CLOSE:
            break
    for b in range(1, BUCKETS):
        if not size[b] and b > 1:
            weights[b] = weights[b - 1]
    weights[:, 2] = np.maximum(weights[:, 2], FLOOR)
    return weights / weights.sum(axis=1, keepdims=True)


def score_documents(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every whole text.

    Tokens are words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, and an end for each text. Texts whose id
    has a checksum of remainder ``HELD_OUT`` teach nothing. ``base_score`` adds the
    decimal logarithms of (count + 1) / (tokens + known words + 1). ``score`` does so
    for a mixture of the pair's, the word's and a uniform estimate; its weights depend on
    how often the context was seen, and are learned on the fold ``DELETED`` against
    the counts of the other training texts. Then all training texts give the estimates.

    A null or empty text is an end alone; the checksum of a null id is that of the empty
    string; repeated rows each count and each get a row. An empty table gives no rows. Other columns are not read.
    """
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))
    source = docs.select("doc_id", fold.alias("fold"), (fold == DELETED).alias("deleted"), "text")
    id_type = source.schema["doc_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        for number, block in enumerate(blocks_of(batches, "text", apart="deleted")):
            yield _pack(block, block_number(partition, number), bool(block.rows.column("deleted")[0].as_py()))

    schema = (
        f"block bigint, deleted boolean, n_keys bigint, n_train bigint, n_deleted bigint, ids array<{id_type}>, "
        "folds array<bigint>, lengths array<bigint>, words binary, tokens binary"
    )
    blocks = stage(map_batches(source, pack, schema), compression="zstd")
    replies = stage(
        ask(blocks, _entries, total_of(blocks, "n_keys"), _sums, ENTRY, REPLY, _known_words), compression="zstd"
    )
    tokens, deleted_tokens = total_of(blocks, "n_train"), total_of(blocks, "n_deleted")
    words = total_of(replies, "extra")
    others = float(max(tokens - deleted_tokens, 1))

    def histogram(block: pa.Table, answers: np.ndarray) -> pa.Table:
        own = _Opened(block.combine_chunks().to_batches()[0], 0)
        single, pair = own.told(answers["f0"] - answers["f1"])
        seen = np.bincount(own.pair, minlength=len(pair))
        context = single[own.context]
        cells = np.stack(
            [bucket_of(context), _steps(pair, np.maximum(context, 1)), _steps(single[own.word], others)], axis=1
        )
        cells, place = np.unique(cells, axis=0, return_inverse=True)
        n = np.bincount(place.ravel(), seen, minlength=len(cells)).astype(np.int64)
        return pa.table({"bucket": cells[:, 0], "pair": cells[:, 1], "word": cells[:, 2], "n": n})

    taught = blocks.filter("deleted")
    mine = replies.join(taught.select("block"), "block", "left_semi").select("block", "bucket", "reply")
    cells = with_replies(taught, mine, histogram, REPLY, HISTOGRAM)
    # as many rows as there are buckets times steps, however large the corpus
    rows = cells.groupBy("bucket", "pair", "word").agg(F.sum("n").alias("n")).toPandas()
    weights = learn_weights({c: rows[c].to_numpy(np.int64) for c in rows.columns}, words)

    def finish(block: pa.Table, answers: np.ndarray) -> pa.Table:
        own = _Opened(block.combine_chunks().to_batches()[0], 0)
        single, pair = own.told(answers)
        bucket = bucket_of(single)[own.context]
        mixed = weights[bucket, 0] * pair / np.maximum(single, 1)[own.context]
        mixed += (weights[:, 1] / max(tokens, 1))[bucket] * single[own.word]
        mixed += (weights[:, 2] / (words + 1))[bucket]
        mixed = np.log10(mixed)
        text = np.repeat(np.arange(len(own.lengths)), own.lengths)
        n = len(own.lengths)
        count = single[own.tokens]
        base = np.log10((count + 1) / (tokens + words + 1))
        return pa.table(
            {
                "doc_id": own.ids,
                "held_out": pa.array(own.folds == HELD_OUT),
                "n_tokens": pa.array(own.lengths),
                "n_known": pa.array(np.bincount(text, count > 0, minlength=n).astype(np.int64)),
                "train_tokens": pa.array(np.full(n, tokens, np.int64)),
                "base_score": pa.array(np.bincount(text, base, minlength=n)),
                "score": pa.array(np.bincount(text, mixed[own.pair], minlength=n)),
            }
        )

    return with_replies(
        blocks,
        first_field(replies, 2),
        finish,
        "<u8",
        f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double",
    )
