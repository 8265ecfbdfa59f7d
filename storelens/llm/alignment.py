"""Token links between a byte-level and a piece tokenizer, counted over documents by bitmaps of id pairs.

A block of documents is tokenized twice and inverted: each id pair gets a compressed bitmap of the block's documents that hold it
linked, and planes of the binary digits of its further links in each. The union of a pair's bitmaps, whose blocks have no
document in common, is popcounted block by block; Spark adds the counts. Then the postings go through
once more, next to the counts, and return each document's scores. The pairs are as many as the two vocabularies
allow, however large the corpus; blocks have a bounded size, and groups of blocks, too.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from storelens.llm.blocks import block_number, packed, unpacked
from storelens.llm.pieces import SPACE, text_runs
from storelens.llm.token_files import byte_level_spec, plain_encoding
from storelens.llm.words import mix
from storelens.llm.workers import map_batches, ship
from storelens.operators.staging import stage

#: bytes of text and documents of a block (places of documents take 16 bits)
BLOCK_BYTES, BLOCK_DOCS = 8 << 20, 1 << 16
#: groups of pairs, and blocks that are scored together
BUCKETS, TOGETHER = 16, 16
#: distinct segments that are encoded with one call
TOGETHER_SEGMENTS = 5000


class Aligner:
    """Tokens of distinct segments by both tokenizers, and their groups and links.

    A text is cut before each white space that no token of either tokenizer joins to a character before it, so the tokens of a text are
    those of its segments: white space and what follows it; at the end of a text white space alone. For the same
    reason segments can be encoded one behind the other, whatever texts they come from.
    """

    def __init__(self, byte_tokenizer: str, piece_model: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as schema

        self.a, self.a_bytes = plain_encoding(byte_level_spec(byte_tokenizer))
        pieces = schema.ModelProto()
        with open(piece_model, "rb") as f:
            pieces.ParseFromString(f.read())
        kinds, norm = schema.ModelProto.SentencePiece, pieces.normalizer_spec
        own = norm.name == "identity" and not norm.precompiled_charsmap and not norm.remove_extra_whitespaces
        if not own or not norm.escape_whitespaces or not norm.add_dummy_prefix or not pieces.trainer_spec.byte_fallback:
            raise ValueError("a piece model with byte fallback and a leading blank, without normalisation, is needed")
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        self.b_bytes = [b""] * len(pieces.pieces)
        joined: set[str] = set()  # white space inside pieces
        for i, p in enumerate(pieces.pieces):
            if p.type == kinds.BYTE:
                self.b_bytes[i] = bytes([int(p.piece[1:-1], 16)])
            elif p.type == kinds.NORMAL:
                self.b_bytes[i] = p.piece.replace(SPACE, " ").encode()
                if SPACE in p.piece.lstrip(SPACE):
                    raise ValueError("blanks are expected at the start of pieces only")
                if len(p.piece) > 1:
                    joined.update(c for c in p.piece if c.isspace())
            elif p.type not in (kinds.CONTROL, kinds.UNKNOWN):
                raise ValueError("user-defined and unused pieces are not supported")
        self.blank = self.b.piece_to_id(SPACE)
        self.sizes = [np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes)]
        self.names = np.array([str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))], object)
        more = rf"(?:[{re.escape(''.join(sorted(joined)))}]\s*\S*)*" if joined else ""
        self.segments = re.compile(rf"\s*\S+{more}|\s+\Z")

    def tokens(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids by both tokenizers of a text that starts with white space; none where the bytes of a tokenizer differ.

        The piece model puts a blank before a text. A blank that stands there already is left to it; before other white
        space its blank is a piece of its own and left out.
        """
        a = self.a.encode_ordinary(text)
        if text == " ":
            b = [self.blank]
        else:
            b = self.b.encode(text[1:]) if text[0] == " " else self.b.encode(text)[1:]
        data = text.encode()
        same = b"".join([self.a_bytes[i] for i in a]) == data and b"".join([self.b_bytes[i] for i in b]) == data
        return (a, b) if same else None

    def encode(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all segments by both tokenizers, one behind the other, and whether a segment has none."""
        parts: list[tuple[list[int], list[int]]] = []
        bad = np.zeros(len(segments), bool)
        # white space at the end, and the sign that pieces write for a blank, need a call of their own
        alone = [s[-1].isspace() or SPACE in s for s in segments]
        cuts = sorted({0, len(segments), *range(0, len(segments), TOGETHER_SEGMENTS), *(
            k + d for k, x in enumerate(alone) if x for d in (0, 1)
        )})
        for x, y in zip(cuts, cuts[1:]):
            got = self.tokens("".join(segments[x:y]))
            if got is not None:
                parts.append(got)
                continue
            for k in range(x, y):
                got = self.tokens(segments[k])
                bad[k] = got is None
                parts.append(got or ([], []))
        return (*(np.array([i for p in parts for i in p[k]], np.int64) for k in (0, 1)), bad)

    def align(self, segments: list[str]) -> Aligned:
        """Counts, groups and links of distinct segments, all at once from the byte offsets at which tokens end."""
        a, b, bad = self.encode(segments)
        sizes = np.array([0 if x else len(s.encode()) for s, x in zip(segments, bad.tolist())], np.int64)
        last = np.cumsum(sizes)
        ends_a, ends_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        if not np.isin(last[sizes > 0], common, assume_unique=True).all():
            raise AssertionError("a token reaches beyond its segment")
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        owner = np.searchsorted(last, common)
        counts = [np.bincount(owner[g], minlength=len(segments)) for g in (group_a, group_b)]
        counts.append(np.bincount(owner, minlength=len(segments)))
        # between two neighbouring ends lies one stretch of one token of each; a linked pair shares one such stretch
        every = np.union1d(ends_a, ends_b)
        links = a[np.searchsorted(ends_a, every)] << 32 | b[np.searchsorted(ends_b, every)]
        begin = np.searchsorted(np.searchsorted(last, every), np.arange(len(segments) + 1))
        # the groups written out: A's tokens of a group, then B's
        of = np.concatenate([group_a, group_b])
        order = np.argsort(2 * of + np.repeat([0, 1], [len(a), len(b)]), kind="stable")
        of, second, ids = of[order], order >= len(a), np.concatenate([a, b])[order]
        ends_group = np.append(of[1:] != of[:-1], True) if len(of) else np.empty(0, bool)
        ends_segment = np.append(owner[of[1:]] != owner[of[:-1]], True) if len(of) else np.empty(0, bool)
        turns = np.append(second[1:] != second[:-1], True) if len(of) else np.empty(0, bool)
        marks = np.array([",", "|", ";", "\n"], object)[np.where(ends_segment, 3, np.where(ends_group, 2, turns))]
        written = iter("".join((self.names[ids] + marks).tolist()).split("\n"))
        groups = [next(written) if n else "" for n in sizes.tolist()]
        return Aligned(counts, groups, links, begin, bad)


class Aligned(NamedTuple):
    """Of some segments: numbers of A and B tokens and groups, groups as text, links with where each segment's begin, and those without tokens."""

    counts: list[np.ndarray]
    groups: list[str]
    links: np.ndarray
    begin: np.ndarray
    bad: np.ndarray


@lru_cache(maxsize=2)
def aligner(byte_tokenizer: str, piece_model: str) -> Aligner:
    return Aligner(byte_tokenizer, piece_model)


class _Numbers(dict):
    def __missing__(self, segment: str) -> int:
        self[segment] = number = len(self)
        return number


def pack_plane(pair: np.ndarray, doc: np.ndarray, n_pairs: int, n_docs: int) -> tuple[bytes, bytes, bytes]:
    """Documents of each pair (entries sorted by pair and document): their numbers, then places of few, then bits of many."""
    counts = np.bincount(pair, minlength=n_pairs)
    width = -(-n_docs // 8)
    dense = 2 * counts > width
    many = dense[pair]
    row = (np.cumsum(dense) - 1)[pair[many]]
    bits = np.zeros(int(dense.sum()) * width, np.uint8)
    np.bitwise_or.at(bits, row * width + (doc[many] >> 3), (1 << (doc[many] & 7)).astype(np.uint8))
    return packed(counts.astype("<u4")), doc[~many].astype("<u2").tobytes(), bits.tobytes()


def unpack_plane(counts: bytes, places: bytes, bits: bytes, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Pair and document of each entry, in no order."""
    sizes = unpacked(counts, "<u4").astype(np.int64)
    width = -(-n_docs // 8)
    dense = 2 * sizes > width
    pair, doc = np.repeat(np.flatnonzero(~dense), sizes[~dense]), np.frombuffer(places, "<u2").astype(np.int64)
    if dense.any():
        maps = np.frombuffer(bits, np.uint8).reshape(-1, width)
        row, place = np.nonzero(np.unpackbits(maps, axis=1, bitorder="little"))
        pair, doc = np.concatenate([pair, np.flatnonzero(dense)[row]]), np.concatenate([doc, place])
    return pair, doc


COUNTED = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint"
POSTINGS = (
    "array<struct<bucket:int,pairs:array<bigint>,n_documents:array<bigint>,n_links:array<bigint>,"
    "planes:array<struct<counts:binary,places:binary,bits:binary>>>>"
)


def _postings(pair_of: np.ndarray, doc_of: np.ndarray, links: np.ndarray, n_docs: int) -> list[dict]:
    """The inverted index of a block, by bucket of pairs: the first plane has the documents, the next the digits of ``links - 1``."""
    key, times = np.unique(pair_of * n_docs + doc_of, return_counts=True)
    pair, doc = np.divmod(key, n_docs)
    bucket = (mix(links.astype(np.uint64)) % np.uint64(BUCKETS)).astype(np.int64)
    held = np.bincount(pair, minlength=len(links)) > 0
    made = []
    for b in range(BUCKETS):
        own = np.flatnonzero((bucket == b) & held)
        if not len(own):
            continue
        number = np.full(len(links), -1)
        number[own] = np.arange(len(own))
        inside = bucket[pair] == b
        p, d, t = number[pair[inside]], doc[inside], times[inside]
        planes = [pack_plane(p, d, len(own), n_docs)]
        rest = t - 1
        while rest.any():
            odd = (rest & 1).astype(bool)
            planes.append(pack_plane(p[odd], d[odd], len(own), n_docs))
            rest = rest >> 1
        made.append(
            {
                "bucket": b,
                "pairs": links[own],
                "n_documents": np.bincount(p, minlength=len(own)),
                "n_links": np.bincount(p, t, minlength=len(own)).astype(np.int64),
                "planes": [dict(zip(("counts", "places", "bits"), x)) for x in planes],
            }
        )
    return made


def _block_row(own: Aligner, texts: list[str], digests: bool) -> tuple[dict[str, list], list[dict]]:
    """Counts and groups of each text of a block, and the block's postings."""
    numbers, none = _Numbers(), np.empty(0, np.int64)
    split = [np.array([numbers[s] for s in own.segments.findall(f" {t}")], np.int64) if t else none for t in texts]
    aligned = own.align(list(numbers))
    if aligned.bad.any():
        split = [none if aligned.bad[s].any() else s for s in split]
    parts = np.concatenate(split)
    of = np.repeat(np.arange(len(split)), [len(s) for s in split])
    many = np.diff(aligned.begin)[parts]
    sums = [np.bincount(of, per[parts], minlength=len(split)) for per in [*aligned.counts, np.diff(aligned.begin)]]
    added = dict(zip(("n_a", "n_b", "n_groups", "n_links"), (x.astype(np.int64) for x in sums)))
    # the links of each segment in turn
    place = np.arange(int(many.sum())) + np.repeat(aligned.begin[parts] - (np.cumsum(many) - many), many)
    links, pair = np.unique(aligned.links, return_inverse=True)
    groups = [";".join([aligned.groups[k] for k in s.tolist()]) for s in split]
    if digests:
        groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
    added["groups"] = groups
    return added, _postings(pair[place], np.repeat(of, many), links, len(split))


def _inverted(docs: DataFrame, byte_tokenizer: str, piece_model: str, digests: bool) -> DataFrame:
    """A row per block: ``block``, ``n_docs``, its documents in turn with their counts and groups, and its postings."""
    others = [c for c in docs.columns if c != "text"]
    source = docs.select(*others, F.coalesce("text", F.lit("")).alias("text"))
    # the caller's columns travel under numbers, so none can clash
    names = [f"c{k}" for k in range(len(others))]
    row = StructType([StructField(n, source.schema[c].dataType) for n, c in zip(names, others)])
    row = StructType(row.fields + StructType.fromDDL(f"{COUNTED}, groups string").fields)
    schema = StructType.fromDDL(f"block bigint, n_docs int, postings {POSTINGS}").add("docs", ArrayType(row))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        struct = target.field("docs").type.value_type
        partition, made = TaskContext.get().partitionId(), 0
        align = aligner(byte_tokenizer, piece_model)

        def finish(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(parts).combine_chunks()
            added, postings = _block_row(align, table.column(len(others)).to_pylist(), digests)
            columns = [table.column(k).combine_chunks() for k in range(len(others))]
            columns += [pa.array(added[n], struct.field(n).type) for n in ("n_a", "n_b", "n_groups", "n_links", "groups")]
            columns = [c.cast(f.type) for c, f in zip(columns, struct)]
            inner = pa.StructArray.from_arrays(columns, fields=list(struct))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([block_number(partition, made)], pa.int64()),
                    pa.array([len(table)], pa.int32()),
                    pa.array([postings], target.field("postings").type),
                    pa.ListArray.from_arrays(pa.array([0, len(table)], pa.int32()), inner).cast(target.field("docs").type),
                ],
                schema=target,
            )

        waiting, size, count = [], 0, 0
        for whole in batches:
            for batch in text_runs(whole, len(others)):
                for at in range(0, batch.num_rows, BLOCK_DOCS // 4):
                    part = batch.slice(at, BLOCK_DOCS // 4)
                    if waiting and (size >= BLOCK_BYTES or count + part.num_rows > BLOCK_DOCS):
                        yield finish(waiting)
                        waiting, size, count, made = [], 0, 0, made + 1
                    waiting.append(part)
                    size += pa.compute.sum(pa.compute.binary_length(part.column(len(others)))).as_py() or 0
                    count += part.num_rows
        if waiting:
            yield finish(waiting)

    return map_batches(source, run, schema)


def _counts(postings: DataFrame) -> DataFrame:
    """``(bucket, pair, n_documents, n_links)`` over all blocks; added up on the map side first."""
    each = postings.select("bucket", F.explode(F.arrays_zip("pairs", "n_documents", "n_links")).alias("x"))
    return each.select("bucket", "x.*").groupBy("bucket", F.col("pairs").alias("pair")).agg(
        F.sum("n_documents").alias("n_documents"), F.sum("n_links").alias("n_links")
    )


def _opened(blocks: DataFrame) -> DataFrame:
    return blocks.select("block", "n_docs", F.explode("postings").alias("p")).select("block", "n_docs", "p.*")


def count_pairs(docs: DataFrame, byte_tokenizer: str, piece_model: str) -> DataFrame:
    """``(a, b, n_documents, n_links)``: for each linked id pair the documents that hold it, and its links in all of them."""
    counts = _counts(_opened(stage(_inverted(docs.select("text"), byte_tokenizer, piece_model, True), compression="zstd")))
    a, b = F.shiftright("pair", 32), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    return counts.select(a.alias("a"), b.alias("b"), "n_documents", "n_links")


def _packed_counts(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("pair")
    best = rows.column("best").cast(pa.int8()).to_numpy()
    return pa.table(
        {
            "bucket": rows.column("bucket").slice(0, 1),
            "pairs": pa.array([rows.column("pair").to_numpy().astype("<i8").tobytes()], pa.binary()),
            "counts": pa.array([rows.column("n_documents").to_numpy().astype("<i8").tobytes()], pa.binary()),
            "best": pa.array([best.tobytes()], pa.binary()),
        }
    )


def _scored(posted: pa.Table, told: pa.Table) -> pa.Table:
    """For each block the scores that its documents get from one bucket of pairs."""
    known = np.frombuffer(told.column("known")[0].as_buffer(), "<i8")
    counts = np.frombuffer(told.column("counts")[0].as_buffer(), "<i8")
    best = np.frombuffer(told.column("best")[0].as_buffer(), np.int8).astype(np.int64)
    sums, bests = [], []
    for k in range(len(posted)):
        n_docs = posted.column("n_docs")[k].as_py()
        at = np.searchsorted(known, posted.column("pairs")[k].values.to_numpy())
        total, top = np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64)
        for digit, plane in enumerate(posted.column("planes")[k].as_py()):
            pair, doc = unpack_plane(**plane, n_docs=n_docs)
            weight = 1 << max(0, digit - 1)
            np.add.at(total, doc, counts[at[pair]] * weight)
            np.add.at(top, doc, best[at[pair]] * weight)
        sums.append(packed(total))
        bests.append(packed(top))
    return pa.table({"block": posted.column("block"), "sums": pa.array(sums, pa.binary()), "bests": pa.array(bests, pa.binary())})


def _align(docs: DataFrame, byte_tokenizer: str, piece_model: str, digests: bool) -> DataFrame:
    spark = docs.sparkSession
    blocks = stage(_inverted(docs, byte_tokenizer, piece_model, digests), compression="zstd")
    n_blocks = blocks.count()
    groups = max(1, -(-n_blocks // TOGETHER))
    postings = _opened(blocks).withColumn("part", F.pmod(F.xxhash64("block"), F.lit(groups)))
    counts = _counts(postings)
    a = Window.partitionBy(F.shiftright("pair", 32))
    best = counts.withColumn("best", F.col("n_documents") == F.max("n_documents").over(a))
    ship(spark)
    told = best.groupBy("bucket").applyInArrow(
        _packed_counts, "bucket int, pairs binary, counts binary, best binary"
    )
    asked = postings.select("part", "bucket").distinct().join(stage(told, compression="zstd"), "bucket")
    asked = asked.withColumnsRenamed({"part": "of_part", "bucket": "of_bucket", "pairs": "known"})
    scores = (
        postings.select("part", "bucket", "block", "n_docs", "pairs", "planes")
        .groupBy("part", "bucket")
        .cogroup(asked.groupBy("of_part", "of_bucket"))
        .applyInArrow(_scored, "block bigint, sums binary, bests binary")
    )
    others = [c for c in docs.columns if c != "text"]
    replaced = {*StructType.fromDDL(COUNTED).names, "n_best", "count_sum", "groups", "groups_sha256"}
    kept = [k for k, c in enumerate(others) if c not in replaced]
    name = "groups_sha256" if digests else "groups"
    added = StructType.fromDDL(f"{COUNTED}, {name} string, n_best bigint, count_sum bigint")
    numbered = StructType([docs.schema[others[k]] for k in kept] + added.fields)

    def finish(block: pa.Table, told: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        rows = block.column("docs").combine_chunks().flatten()
        total, top = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for k in range(len(told)):
            total += unpacked(told.column("sums")[k].as_buffer(), "<i8")
            top += unpacked(told.column("bests")[k].as_buffer(), "<i8")
        fields = rows.flatten()
        columns = [fields[k] for k in kept] + list(fields[len(others) :]) + [pa.array(top), pa.array(total)]
        return pa.Table.from_arrays(columns, schema=to_arrow_schema(numbered))

    return blocks.select("block", "docs").groupBy("block").cogroup(scores.groupBy("block")).applyInArrow(finish, numbered)


def align_documents(docs: DataFrame, byte_tokenizer: str, piece_model: str) -> DataFrame:
    """``docs`` without ``text``, with ``n_a, n_b, n_groups, n_links, groups, n_best, count_sum`` added.

    The byte-level tokenizer encodes a blank and the text (A), the piece model the text (B). Byte offsets at which tokens of both end
    cut them into groups, ``a1,a2|b1;a3|b2,b3``. Tokens whose bytes overlap are linked. A pair's count is the number of rows
    that hold it linked; ``count_sum`` adds up the counts of a document's links, ``n_best`` counts the links of the highest
    count that their A id has anywhere, ties included. Strings of special tokens are text. A null or empty text, and one whose bytes a
    tokenizer does not give back, has no tokens: zeros and no groups. Every row is a document of its own, repeated and null ids
    included; other columns stay, those of the new names are replaced; an empty table gives an empty one.
    """
    return _align(docs, byte_tokenizer, piece_model, False)


def align_digests(docs: DataFrame, byte_tokenizer: str, piece_model: str) -> DataFrame:
    """As ``align_documents``, with ``groups_sha256`` in place of the groups; empty, not a digest, without tokens."""
    return _align(docs, byte_tokenizer, piece_model, True)
