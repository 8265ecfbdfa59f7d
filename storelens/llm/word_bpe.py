"""Encoding with word-end merges (byte pairs), fragment by fragment between forced boundaries, and decoding."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from storelens.llm.pieces import text_runs
from storelens.llm.token_files import byte_signs
from storelens.llm.workers import map_batches

#: runs, and fragments, that a worker remembers in each of two generations
MEMORY = 200_000
#: longer ones are encoded each time
LONGEST_KEPT = 64
#: symbols from which on the merges of a fragment are found with a heap
HEAP_FROM = 40

#: characters that end a run: Unicode's White_Space
RUNS = re.compile(r"[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: letters beyond ASCII that normalisation and lower-casing keep single letters (Latin, Cyrillic)
_LETTERS = r"\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f\u0400-\u0481\u048a-\u052f"
#: runs of printable ASCII and these letters, and the file's pattern for words, once they are lower-cased
PLAIN = re.compile(rf"[!-~{_LETTERS}]+\Z")
PLAIN_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LETTERS}]+|[0-9]|[^a-z0-9{_LETTERS}]+")


class WordEncoder:
    """Exact encoder for a tokenizer file of merges with a word-end mark.

    A merged token is an entry of the vocabulary, so two neighbouring bytes that stand together inside no entry
    are never merged into one token. Each such pair is a forced boundary: the word is cut there, the fragments
    are encoded by themselves, and their ids are put together. The last byte of a word carries the word-end
    mark and counts as a symbol of its own.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, self.end = spec["model"], spec["model"]["end_of_word_suffix"]
        if model["type"] != "BPE" or not self.end or model["dropout"] or model["ignore_merges"] or spec["decoder"]:
            raise ValueError("merges with a word-end mark, and no decoder, are needed")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens may not depend on what is around them")
        self.library = Tokenizer.from_file(path)
        self.vocabulary: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in self.vocabulary.items()} | {i: t for t, i in self.added.items()}
        self.added_at = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        #: ranks of the pairs of ids that merge, and the ids that they merge to, by rank
        self.ranks: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks.setdefault((self.vocabulary[left], self.vocabulary[right]), rank)
            self.merged.append(self.vocabulary[left + right])
        #: neighbours inside some entry; the second one of a word's end is marked
        self.inside: set[tuple[str, str]] = set()
        for entry in self.vocabulary:
            symbols = self.symbols_of(entry)
            self.inside.update(zip(symbols, symbols[1:]))
        self.signs = byte_signs()
        self.fragments: tuple[dict[str, list[int]], dict[str, list[int]]] = ({}, {})
        self.runs: tuple[dict[str, tuple], dict[str, tuple]] = ({}, {})

    def symbols_of(self, entry: str) -> list[str]:
        if entry.endswith(self.end) and len(entry) > len(self.end):
            return self.marked(entry[: -len(self.end)])
        return list(entry)

    def marked(self, word: str) -> list[str]:
        return [*word[:-1], word[-1] + self.end]

    def merge(self, symbols: list[str]) -> list[int]:
        """Ids of the symbols by merging: the lowest rank first, of equal ranks the leftmost."""
        ids = [self.vocabulary[s] for s in symbols]
        if len(ids) >= HEAP_FROM:
            return self._merge_long(ids)
        rank_of, none = self.ranks.get, len(self.merged)
        ranks = [rank_of(pair, none) for pair in zip(ids, ids[1:])]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            at = ranks.index(least)
            ids[at : at + 2] = [self.merged[least]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank_of((ids[at], ids[at + 1]), none)
            if at:
                ranks[at - 1] = rank_of((ids[at - 1], ids[at]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of possible merges and links between what is left."""
        ranks, n = self.ranks, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[p], at, p) for at, p in enumerate(zip(ids, ids[1:])) if p in ranks]
        heapq.heapify(heap)
        while heap:
            rank, at, pair = heapq.heappop(heap)
            right = after[at]
            if right >= n or (ids[at], ids[right]) != pair:
                continue  # one of the two has been merged since
            ids[at], ids[right] = self.merged[rank], -1
            after[at] = after[right]
            if after[at] < n:
                before[after[at]] = at
            for left in (before[at], at):
                if left >= 0 and after[left] < n:
                    new = (ids[left], ids[after[left]])
                    if new in ranks:
                        heapq.heappush(heap, (ranks[new], left, new))
        return [i for i in ids if i >= 0]

    def _remember(self, key: str, ids: list[int]) -> list[int]:
        now, _ = self.fragments
        if len(key) <= LONGEST_KEPT:
            if len(now) >= MEMORY:
                self.fragments = now, _ = {}, now
            now[key] = ids
        return ids

    def _fragment(self, symbols: list[str]) -> list[int]:
        """Ids of a fragment inside a word."""
        key = "".join(symbols)
        now, old = self.fragments
        return now.get(key) or self._remember(key, old.get(key) or self.merge(symbols))

    def word_ids(self, word: str) -> list[int]:
        """Ids of a word, written in the signs of its bytes."""
        key = word + "\n"  # words, as fragments that end one; a byte's sign is never a line feed
        now, old = self.fragments
        return now.get(key) or self._remember(key, old.get(key) or self._cut(self.marked(word)))

    def _cut(self, symbols: list[str]) -> list[int]:
        inside = self.inside
        if inside.issuperset(zip(symbols, symbols[1:])):
            return self.merge(symbols)
        ids: list[int] = []
        start = 0
        for at, pair in enumerate(zip(symbols, symbols[1:]), 1):
            if pair not in inside:
                ids += self._fragment(symbols[start:at])
                start = at
        return ids + self.merge(symbols[start:])

    def _words(self, part: str) -> list[str]:
        if PLAIN.match(part):
            found = PLAIN_WORDS.findall(part.lower())
            return found if part.isascii() else [w.encode().decode("latin-1").translate(self.signs) for w in found]
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))]

    def _run(self, run: str) -> tuple[int, bytes, str]:
        now, old = self.runs
        got = old.get(run)
        if got is None:
            ids: list[int] = []
            for part in self.added_at.split(run) if "<" in run else [run]:
                if part in self.added:
                    ids.append(self.added[part])
                elif part:
                    for word in self._words(part):
                        ids += self.word_ids(word)
            got = len(ids), struct.pack(f"<{len(ids)}I", *ids), self.decode(ids)
        if len(run) <= LONGEST_KEPT:
            if len(now) >= MEMORY:
                self.runs = now, _ = {}, now
            now[run] = got
        return got

    def encode(self, text: str) -> tuple[int, bytes, str]:
        """Number of ids, the ids as little-endian 32-bit numbers, and what they decode to.

        White space is in no token, so each run without it is encoded by itself, and remembered.
        """
        get = self.runs[0].get
        found = [get(r) or self._run(r) for r in RUNS.findall(text)]
        if not found:
            return 0, b"", ""
        sizes, ids, decoded = zip(*found)
        return sum(sizes), b"".join(ids), " ".join(decoded)

    def decode(self, ids: list[int]) -> str:
        """The entries, joined by blanks, word-end marks included: the file names no decoder. Unknown ids are left out."""
        return " ".join([self.names[i] for i in ids if i in self.names])


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``docs`` with ``ids`` (array of ints) and ``decoded`` added; see ``encode_digests``."""

    def made(n: int, ids: bytes, decoded: str) -> tuple:
        return list(struct.unpack(f"<{n}I", ids)), decoded

    return _encoded(docs, tokenizer, "ids array<int>, decoded string", made)


def encode_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``docs`` without ``text``, with ``n_tokens, ids_sha256, decoded_sha256`` added.

    Whole texts; a null or empty text has no ids and decodes to the empty string. Every row is encoded by
    itself: repeated rows and null ids stay as they are, an empty table gives an empty one, other columns stay and
    those of the new names are replaced. The tokenizer file has to be at the same path on all machines.
    """

    def made(n: int, ids: bytes, decoded: str) -> tuple:
        return n, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    return _encoded(docs, tokenizer, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", made)


def _encoded(docs: DataFrame, tokenizer: str, added: str, made: Callable[[int, bytes, str], tuple]) -> DataFrame:
    new = StructType.fromDDL(added)
    keep_text = "ids" in new.names
    others = [c for c in docs.columns if c not in new.names and (keep_text or c != "text")]
    # the text to encode comes last, under a name of its own
    source = docs.select(*others, F.coalesce("text", F.lit("")).alias("\ttext"))
    schema = StructType([docs.schema[c] for c in others] + new.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        types, own = to_arrow_schema(new).types, encoder(tokenizer)
        for whole in batches:
            for batch in text_runs(whole, len(others)):
                rows = [made(*own.encode(t)) for t in batch.column(len(others)).to_pylist()]
                columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*others, *new.names])

    return map_batches(source, run, schema)
