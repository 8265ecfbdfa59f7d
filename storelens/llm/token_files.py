"""Token ids of documents in ORC files, in order of the documents, and reading them back."""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from storelens.llm.words import pieces
from storelens.llm.workers import map_batches

#: id appended to each document
END = 0
#: stretches of text that a worker remembers in each of two generations, besides those of one batch
MEMORY = 200_000
#: bytes of text in an output batch
STEP_BYTES = 1 << 21
#: rows of a row-index entry, bytes of a stripe, and the Bloom filters' rate of false hits
ORC_OPTIONS = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
}


# Fixed value: the pattern of pre-tokens that byte-level tokenizers share.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_signs() -> dict[int, str]:
    """The character by which byte-level tokenizers write each byte: itself where it is printable, else one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


def byte_level_spec(path: str) -> dict:
    """Content of a tokenizer file, which has to be byte-level and without normalisation."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    before, model = spec["pre_tokenizer"] or {}, spec["model"]
    plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    if not plain or spec["normalizer"] or model.get("dropout") or model.get("ignore_merges"):
        raise ValueError("a byte-level tokenizer without normalisation is needed")
    return spec


def plain_encoding(spec: dict) -> tuple[tiktoken.Encoding, list[bytes]]:
    """The file's merges without its added tokens, whose strings are text, and the bytes of each id."""
    model, signs = spec["model"], {s: b for b, s in byte_signs().items()}
    added = {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(map(signs.get, t)): i for t, i in model["vocab"].items() if t not in added}
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if merged != sorted(merged) or len(ranks) != len(merged) + 256 or merged and merged[0] < 256:
        raise ValueError("ids in the order of the merges are needed")
    names = [b""] * (max(ranks.values()) + 1)
    for data, i in ranks.items():
        names[i] = data
    return tiktoken.Encoding("plain", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={}), names


#: a blank beside other white space, or at the end
BESIDE = re.compile(r"\s | \s| \Z")


class TextEncoder:
    """Ids of texts by a byte-level tokenizer file, with stretches between single blanks remembered.

    The file's pre-tokenizer joins one blank to the characters after it, and no
    pre-token holds a single blank behind another character. So a text can be cut before such blanks, and the
    ids of the stretches are put together; a text in which a blank meets other white space is not cut. Texts with added tokens go to the library whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = byte_level_spec(path)
        if any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens may not take blanks")
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.plain, names = plain_encoding(spec)
        self.sizes = np.array([len(x) for x in names], np.int64)
        self.now: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _plain(self, text: str) -> bytes:
        return array("I", self.plain.encode_ordinary(text)).tobytes()

    def _learn(self, stretches: list[str]) -> None:
        """Encodes new stretches, one behind the other with a blank before each, and cuts the ids where the stretches end."""
        ids = self.plain.encode_ordinary(f" {' '.join(stretches)}")
        ends = np.cumsum(self.sizes[ids])
        cuts = np.searchsorted(ends, np.cumsum([len(s.encode()) + 1 for s in stretches]), side="right")
        data, at = array("I", ids).tobytes(), 0
        for stretch, cut in zip(stretches, (4 * cuts).tolist()):
            self.now[stretch] = data[at:cut]
            at = cut

    def _parts(self, text: str) -> list[str] | None:
        """The text cut at its blanks; none where a blank meets other white space, or an added token stands in the text."""
        if any(t in text for t in self.added):
            return None
        return None if BESIDE.search(text) else text.split(" ")

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as unsigned 32-bit numbers."""
        cut = [self._parts(t) for t in texts]
        wanted = set().union(*[parts[1:] for parts in cut if parts])
        new = wanted - self.now.keys()
        if len(self.now) + len(new) > MEMORY:
            self.before, self.now = self.now, {}
            new = wanted
        old = {s: self.before[s] for s in new if s in self.before}
        self.now.update(old)
        if len(old) < len(new):
            self._learn([s for s in new if s not in old])
        now = self.now
        for text, parts in zip(texts, cut):
            if parts is not None:
                yield self._plain(parts[0]) + b"".join([now[s] for s in parts[1:]])
            elif any(t in text for t in self.added):
                yield array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
            else:
                yield self._plain(text)

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))


@lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    return TextEncoder(path)


def encode_documents(docs: DataFrame, tokenizer: str, end: int = END) -> DataFrame:
    """``(doc_id, part, first, n_tokens, ids)`` in ascending order of ``doc_id``.

    ``part`` numbers the ranges of ids, one per task; ``first`` is the number of ids before the document
    within its part. A null or empty text has the end id alone. Null ids come
    first, and rows with one id stand in the order of their texts. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        last = np.array([end], "<u4").tobytes()
        before = 0
        for whole in batches:
            for row, _, offsets in pieces(whole.column(1), STEP_BYTES):
                batch = whole.slice(row, len(offsets) - 1)
                found = [x + last for x in own.encode_all(batch.column(1).to_pylist())]
                ends = np.cumsum([len(x) // 4 for x in found])
                ids = pa.array(np.frombuffer(b"".join(found), "<i4"))
                places = np.concatenate([[0], ends])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(2),
                        pa.array(before + places[:-1]),
                        pa.array(np.diff(places)),
                        pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), ids),
                    ],
                    ["doc_id", "part", "first", "n_tokens", "ids"],
                )
                before += int(places[-1])

    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ordered = (
        source.repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .withColumn("part", F.spark_partition_id())
    )
    id_type = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, part int, first bigint, n_tokens bigint, ids array<int>"
    return map_batches(ordered, run, schema)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end: int = END) -> None:
    """Writes the ids of all documents as ORC files below ``path``, one range of ids a file.

    Integer runs are length-encoded by the format; stripes can be read in
    parallel; the row index and Bloom filters on ``doc_id`` let readers skip what
    they do not look for.
    """
    encode_documents(docs, tokenizer, end).write.options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` from the files; ``start`` counts the ids of all documents before.

    A condition on ``doc_id`` is pushed to the files. The offsets of the parts
    are as many rows as there are files, so they are broadcast.
    """
    rows = spark.read.orc(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    up_to = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(up_to), F.lit(0)).alias("_offset"))
    chosen = rows if where is None else rows.filter(where)
    return chosen.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("_offset") + F.col("first")).alias("start"), "n_tokens", "ids"
    )


def checksums(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ``ids`` replaced by ``ids_crc32``, over the ids as little-endian 32-bit numbers."""
    others = [c for c in tokens.columns if c != "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(others))
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            places = lists.offsets.to_pylist()
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(places, places[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sums, pa.int64())], [*others, "ids_crc32"])

    source = tokens.select(*others, "ids")
    kinds = ", ".join(f"{c} {source.schema[c].dataType.simpleString()}" for c in others)
    return map_batches(source, run, f"{kinds}, ids_crc32 bigint")
