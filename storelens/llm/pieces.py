"""Merge-type (SentencePiece) encoding and decoding by backtracking over longest matches."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from storelens.llm.words import pieces
from storelens.llm.workers import map_batches

SPACE = "▁"
#: runs that a worker remembers in each of two generations, and pairs of neighbours
MEMORY, PAIRS = 150_000, 400_000
#: longer runs are encoded each time
LONGEST_KEPT = 64
#: bytes of text in an output batch
STEP_BYTES = 1 << 21


class PieceEncoder:
    """Exact merge-type encoder for one model file.

    A sequence of pieces is what merging gives if and only if each two
    neighbours, merged again from their characters, come out as these two. The encoder takes the longest piece at each
    place (matches of one Aho-Corasick pass), then shorter ones, and steps back where no piece fits; a bitfield
    remembers the places from which it stepped back, so each place fails once.
    """

    def __init__(self, model: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as schema

        spec = schema.ModelProto()
        with open(model, "rb") as f:
            spec.ParseFromString(f.read())
        norm, kinds = spec.normalizer_spec, schema.ModelProto.SentencePiece
        plain = norm.name == "identity" and not norm.precompiled_charsmap and not norm.remove_extra_whitespaces
        if spec.trainer_spec.model_type != 2 or not plain or not norm.escape_whitespaces:
            raise ValueError("a merge-type model without text normalisation is needed")
        if spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("white space is expected at the start of pieces")
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes: dict[int, int] = {}
        for i, p in enumerate(spec.pieces):
            if p.type == kinds.NORMAL:
                self.scores[p.piece], self.ids[p.piece] = p.score, i
            elif p.type == kinds.BYTE:
                self.bytes[int(p.piece[1:-1], 16)] = i
            elif p.type not in (kinds.CONTROL, kinds.UNKNOWN):
                raise ValueError("user-defined and unused pieces are not supported")
        if any(SPACE in p.lstrip(SPACE) for p in self.scores):
            raise ValueError("white space is expected at the start of pieces only")
        if len(self.bytes) != 256:
            raise ValueError("a model with a piece for each byte is needed")
        #: the two parts of a piece's last merge; pieces of equal scores are left out, their order depends on the place
        self.last_merge: dict[str, tuple[str, str]] = {}
        reached = []
        for p in self.scores:
            steps: list[tuple[str, str]] = []
            if self.merge(p, steps) != [p]:
                continue
            reached.append(p)
            if steps and all(len(x) == 1 or self.scores[x] > self.scores[p] for x in steps[-1]):
                self.last_merge[p] = steps[-1]
        counts = Counter(self.scores.values())
        self.tied = {p for p in reached if counts[self.scores[p]] > 1 or len(p) > 1 and p not in self.last_merge}
        kept = set(reached)
        #: length of the next shorter piece that starts the same, or 0
        self.shorter = {p: next((n for n in range(len(p) - 1, 0, -1) if p[:n] in kept), 0) for p in reached}
        self.matcher = ahocorasick.Automaton()
        for p in reached:
            self.matcher.add_word(p, len(p))
        self.matcher.make_automaton()
        self.known = {c for p in self.scores for c in p}
        self.inside = {pair for p in self.scores for pair in zip(p, p[1:])}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.texts = {p: str(i) for p, i in self.ids.items()}
        self.parts_now: dict[str, tuple[tuple[int, ...], str]] = {}
        self.parts_before: dict[str, tuple[tuple[int, ...], str]] = {}
        self.runs_now: dict[str, tuple[tuple[int, ...], str]] = {}
        self.runs_before: dict[str, tuple[tuple[int, ...], str]] = {}

    def merge(self, text: str, steps: list | None = None) -> list[str]:
        """Pieces by plain merging: the best-scored neighbours first, of equals the leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            if steps is not None:
                steps.append((parts[at], parts[at + 1]))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def merges_apart(self, a: str, b: str) -> bool:
        """Whether merging the characters of ``a + b`` ends in these two pieces.

        Runs the merges backwards: of the two pieces at the seam the one that was
        merged last is taken apart. If the pieces that then meet at the seam make a piece
        with a better score, merging would have joined them first.
        """
        scores, parts = self.scores, self.last_merge
        if a in self.tied or b in self.tied:
            return self.merge(a + b) == [a, b]
        if a + b in scores:
            return False
        while True:
            split_a, split_b = parts.get(a), parts.get(b)
            if split_a is None and split_b is None:
                return True
            # of equal pieces the right one is merged later
            if split_b is None or split_a is not None and scores[a] < scores[b]:
                limit, a = scores[a], split_a[1]
                if scores.get(a + b, limit) > limit:
                    return False
            else:  # the seam lies left of the merge that is undone, so it wins a tie, too
                limit, b = scores[b], split_b[0]
                if scores.get(a + b, -math.inf) >= limit:
                    return False

    def fits(self, a: str, b: str) -> bool:
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        fit = self.pairs[a, b] = self.merges_apart(a, b)
        return fit

    def segment(self, text: str) -> list[str]:
        """Pieces of a text of known characters."""
        n = len(text)
        longest = [0] * n
        for end, size in self.matcher.iter(text):  # matches that start at one place come from short to long
            longest[end - size + 1] = size
        pairs, shorter = self.pairs, self.shorter
        failed = 0  # a bit for each place from which no way led to the end
        out: list[str] = []
        last, at, size = "", 0, longest[0]
        while True:
            while size:
                piece = text[at : at + size]
                if not failed >> (at + size) & 1:
                    fit = pairs.get((last, piece)) if last else True
                    if fit or fit is None and self.fits(last, piece):
                        break
                size = shorter[piece]
            if size:
                at += size
                out.append(piece)
                if at == n:
                    return out
                last, size = piece, longest[at]
            else:
                failed |= 1 << at
                at -= len(last)
                size = shorter[out.pop()]
                last = out[-1] if out else ""

    def _part(self, part: str) -> tuple[tuple[int, ...], str]:
        """Ids, and the decimal ids joined by commas, of known characters or of one unknown one."""
        got = self.parts_before.get(part)
        if got is None:
            if part[0] in self.known:
                found = self.segment(part)
                got = tuple([self.ids[p] for p in found]), ",".join([self.texts[p] for p in found])
            else:
                ids = tuple(self.bytes[b] for b in part.encode())
                got = ids, ",".join(map(str, ids))
        if len(part) <= LONGEST_KEPT:
            if len(self.parts_now) >= MEMORY:
                self.parts_before, self.parts_now = self.parts_now, {}
            self.parts_now[part] = got
        return got

    def parts(self, run: str) -> list[str]:
        """Stretches of a run across which nothing merges.

        Where two neighbouring characters stand together in no piece, nothing merges
        across them; the run is cut there. An unknown character is a part of its own.
        """
        inside, out, start = self.inside, [], 0
        for end, pair in enumerate(zip(run, run[1:]), 1):
            if pair not in inside:
                out.append(run[start:end])
                start = end
        out.append(run[start:])
        return out

    def _run(self, key: str) -> tuple[tuple[int, ...], str]:
        """Ids, and the decimal ids joined by commas, of a run with its leading spaces; one space may be left out."""
        got = self.runs_before.get(key)
        if got is None:
            run = key if key[0] == SPACE or not self.prefix else SPACE + key
            found = [self.parts_now.get(p) or self._part(p) for p in self.parts(run)]
            if len(found) == 1:
                got = found[0]
            else:
                ids, texts = zip(*found)
                got = tuple(chain.from_iterable(ids)), ",".join(texts)
        if len(key) <= LONGEST_KEPT:
            if len(self.runs_now) >= MEMORY:
                self.runs_before, self.runs_now = self.runs_now, {}
            self.runs_now[key] = got
        return got

    def encode_ids(self, text: str) -> tuple[list[int], str]:
        """Ids, and the decimal ids joined by commas.

        No piece has a space after another character, so nothing merges across the
        start of a run of spaces: each run is encoded by itself, and remembered.
        """
        if not text:
            return [], ""
        single = self.prefix and text[0] != " " and text[-1] != " " and "  " not in text and SPACE not in text
        runs = text.split(" ") if single else _RUNS.findall(self.prefix + text.replace(" ", SPACE))
        ids, texts = zip(*[self.runs_now.get(r) or self._run(r) for r in runs])
        return list(chain.from_iterable(ids)), ",".join(texts)

    def encode(self, text: str) -> tuple[int, str]:
        """Number of ids, and the decimal ids joined by commas."""
        ids, joined = self.encode_ids(text)
        return len(ids), joined


_RUNS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def text_runs(batch: pa.RecordBatch, column: int, size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch as runs of whole rows with about ``size`` bytes of text each."""
    for first, _, offsets in pieces(batch.column(column), size):
        yield batch.slice(first, len(offsets) - 1)


@lru_cache(maxsize=2)
def encoder(model: str) -> PieceEncoder:
    return PieceEncoder(model)


@lru_cache(maxsize=2)
def library(model: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=model)


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """``docs`` with ``ids`` (array of ints) and ``decoded`` added; see ``encode_digests`` for the short form."""
    return _encoded(docs, model, "ids array<int>, decoded string", _full)


def encode_digests(docs: DataFrame, model: str) -> DataFrame:
    """``docs`` without ``text``, with ``n_tokens, ids_sha256, decoded_sha256`` added.

    Whole texts; a null or empty text has no ids and decodes to the empty string. Every row is
    encoded by itself, so repeated rows, ties and null ids give no trouble; columns of the new names are replaced. The model file
    has to be at the same path on all machines.
    """
    return _encoded(docs, model, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", _digest)


def _full(ids: list[int], text: str, decoded: str) -> tuple:
    return ids, decoded


def _digest(ids: list[int], text: str, decoded: str) -> tuple:
    return len(ids), hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def _encoded(docs: DataFrame, model: str, added: str, make) -> DataFrame:
    from pyspark.sql.types import StructType

    new = StructType.fromDDL(added)
    others = [c for c in docs.columns if c not in ("text", *new.names)]
    source = docs.select(*others, F.coalesce("text", F.lit("")).alias("text"))
    schema = StructType([source.schema[c] for c in others] + new.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        types = to_arrow_schema(new).types
        own, theirs = encoder(model), library(model)
        for whole in batches:
            for batch in text_runs(whole, len(others)):
                made = []
                for ids, text in map(own.encode_ids, batch.column(len(others)).to_pylist()):
                    made.append(make(ids, text, theirs.decode(ids) if ids else ""))
                columns = [pa.array(list(c), t) for c, t in zip(zip(*made), types)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*others, *new.names])

    return map_batches(source, run, schema)
