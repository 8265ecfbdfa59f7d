"""Word-piece token counts by a linear longest-match automaton."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from storelens.llm.workers import map_batches

#: words that a worker remembers
MEMORY = 400_000
#: longer words are counted each time
LONGEST_KEPT = 64
#: added to the count of a word that cannot be split into pieces
UNKNOWN = 1 << 40


class LongestMatch:
    """Greedy longest-match lengths of words, in time linear in their characters.

    The pieces are a trie with two roots: one for pieces that start a word, one for
    pieces that continue it. Where a node has no child for the next character, its failure link leads to the node of
    what is left after the longest pieces are popped, and a stored number says
    how many were. So a word is read once, and no piece is built.
    """

    def __init__(self, first: Iterable[str], later: Iterable[str]) -> None:
        self.child: list[dict[str, int]] = [{}, {}]
        whole = [False, False]
        for root, pieces in enumerate((first, later)):
            for piece in pieces:
                node = root
                for c in piece:
                    node = self.child[node].setdefault(c, len(self.child))
                    if node == len(self.child):
                        self.child.append({})
                        whole.append(False)
                if node > 1:
                    whole[node] = True
        self.link = [-1] * len(self.child)
        self.popped = [0] * len(self.child)
        todo = deque([0, 1])  # by length, so the links of shorter strings are there
        while todo:
            above = todo.popleft()
            for c, node in self.child[above].items():
                todo.append(node)
                if whole[node]:
                    self.link[node], self.popped[node] = 1, 1
                    continue
                z, more = self.link[above], 0
                while z >= 0 and c not in self.child[z]:
                    more += self.popped[z]
                    z = self.link[z]
                if z >= 0:
                    self.link[node] = self.child[z][c]
                    self.popped[node] = self.popped[above] + more

    def count(self, word: str) -> int:
        """Number of pieces; one piece plus ``UNKNOWN`` where the word has no split."""
        child, link, popped = self.child, self.link, self.popped
        node = total = 0
        for c in word:
            while (below := child[node].get(c)) is None:
                total += popped[node]
                node = link[node]
                if node < 0:
                    return 1 + UNKNOWN
            node = below
        while node > 1:  # the end of the word
            total += popped[node]
            node = link[node]
        return total if node == 1 else 1 + UNKNOWN


class _Memory(dict):
    def __init__(self, automaton: LongestMatch) -> None:
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(word.decode("utf-8", "replace"))
        if len(word) <= LONGEST_KEPT:
            if len(self) >= MEMORY:
                self.clear()
            self[word] = n
        return n


def model_pieces(model: str) -> tuple[list[str], list[str]]:
    """Pieces of a SentencePiece model file that start a word, without the space sign, and those that continue one."""
    from sentencepiece import sentencepiece_model_pb2 as schema

    spec = schema.ModelProto()
    with open(model, "rb") as f:
        spec.ParseFromString(f.read())
    plain = [p.piece for p in spec.pieces if p.type == schema.ModelProto.SentencePiece.NORMAL]
    first = [p[1:] for p in plain if p.startswith("▁") and len(p) > 1 and "▁" not in p[1:]]
    return first, [p for p in plain if "▁" not in p]


@lru_cache(maxsize=2)
def _memory(model: str) -> _Memory:
    return _Memory(LongestMatch(*model_pieces(model)))


def count_tokens(docs: DataFrame, model: str) -> DataFrame:
    """``(doc_id, n_words, n_tokens, n_unknown)`` of every whole text.

    Words are ``[^\\x20\\x09-\\x0D]+``. Each word is split greedily into the longest
    pieces; a word that has no split is one unknown token. Null and empty texts
    have none of all three. Each row is counted by itself, so there is no shuffle, and repeated rows or
    null ids are nothing special; other columns are not read. The model file has to be at the same path on all machines.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens_of = _memory(model).__getitem__
        for batch in batches:
            words, sums = [], []
            for text in batch.column(1):
                found = (text.as_py() or "").encode().split()  # bytes part at ASCII white space only
                words.append(len(found))
                sums.append(sum(map(tokens_of, found)))
            sums = np.array(sums, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(sums % UNKNOWN), pa.array(sums // UNKNOWN)],
                ["doc_id", "n_words", "n_tokens", "n_unknown"],
            )

    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    return map_batches(source, run, f"doc_id {id_type}, n_words bigint, n_tokens bigint, n_unknown bigint")
