import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.orc
import sentencepiece
from tokenizers import Tokenizer, models

from storelens.llm import pieces, token_counts, token_files
from storelens.operators.staging import staging_path
from pyspark.sql import functions as F
from tests.llm.common import EDGES, documents, prose

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
BITS = [" ", "  ", "▁", "\n", "a", "the", " th", "in", "er", "é", "１", "😀", "\x00", "<s>", "aaaa", "x", "ing", "\t", "ß",
        "ing ", "'s", " ", "\x1c", "12", "?!", "<|endoftext|>", "  \n", "▁▁▁"]


def mixed(n, seed=0):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_pieces_equal_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    own = pieces.encoder(PIECES)
    texts = mixed(3000) + [" " * 500, "a" * 3000, "ab" * 1500, " a" * 300 + " " * 37] + [t for _, t in prose(5, 200)]
    for t in texts:
        ids = library.encode(t)
        assert own.encode(t) == (len(ids), ",".join(map(str, ids)))


def test_remembered_runs_hold_their_ids(monkeypatch):
    monkeypatch.setattr(pieces, "MEMORY", 20)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    own = pieces.PieceEncoder(PIECES)
    texts = ["the same words", "the same words", " the same  words ", "▁the same", "the\nsame, words 😀", "é", "😀😀 x"] + mixed(60, 9)
    for t in texts * 2:
        ids = library.encode(t)
        assert own.encode_ids(t) == (ids, ",".join(map(str, ids)))
    assert max(len(own.runs_now), len(own.runs_before), len(own.parts_now), len(own.parts_before)) <= 20


def test_seam_check_equals_merging_again():
    own = pieces.encoder(PIECES)
    rng = random.Random(1)
    names = sorted(own.shorter)
    for _ in range(4000):
        a, b = rng.choice(names), rng.choice(names)
        assert own.merges_apart(a, b) == (own.merge(a + b) == [a, b])


def test_encode_digests_and_round_trip(spark):
    rows = EDGES + list(enumerate(mixed(50, 3), 100))
    docs = documents(spark, rows).selectExpr("*", "'old' as n_tokens", "1 as decoded")
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = []
    for i, t in rows:
        ids = library.encode(t or "")
        sums = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids) if ids else "")]
        want.append((i, len(ids), *sums))
    got = pieces.encode_digests(docs, PIECES).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    full = pieces.encode_documents(documents(spark, [(1, "a plain text"), (2, None)]), PIECES).orderBy("doc_id").collect()
    assert full[0].decoded == "a plain text" and full[1].ids == []
    assert pieces.encode_digests(docs.limit(0), PIECES).count() == 0


def test_files_hold_the_library_s_ids_in_order(spark):
    rows = EDGES + list(enumerate(mixed(400, 4), 100))
    library = Tokenizer.from_file(BYTES)
    path = staging_path(spark, "tokens")
    token_files.write_tokens(documents(spark, rows).selectExpr("*", "1 as part", "2 as ids"), path, BYTES)
    got = token_files.checksums(token_files.read_tokens(spark, path)).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, want = 0, []
    for i, t in ordered:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    one = token_files.read_tokens(spark, path, F.col("doc_id") == 300)
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,300)" in one._jdf.queryExecution().toString()
    assert [r.start for r in one.collect()] == [w[1] for w in want if w[0] == 300]


def test_files_have_an_index(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    token_files.write_tokens(documents(spark, list(enumerate(mixed(3000, 5)))), path, BYTES)
    files = sorted(tmp_path.glob("t/*.orc"))
    sizes = [pyarrow.orc.ORCFile(f) for f in files]
    assert sum(f.nrows for f in sizes) == 3000
    assert all(f.row_index_stride == 1000 for f in sizes)
    assert b"BLOOM" not in b"" and all(f.nstripes >= 1 for f in sizes)
    empty = staging_path(spark, "tokens")
    token_files.write_tokens(documents(spark, [(1, "a")]).limit(0), empty, BYTES)
    assert token_files.read_tokens(spark, empty).count() == 0


def greedy(word, first, later):
    """Number of pieces, or None."""
    n, at = 0, 0
    while at < len(word):
        pool = later if at else first
        size = next((s for s in range(len(word) - at, 0, -1) if word[at : at + s] in pool), 0)
        if not size:
            return None
        at += size
        n += 1
    return n


def test_counts_equal_greedy_and_the_library():
    first, later = token_counts.model_pieces(PIECES)
    automaton = token_counts.LongestMatch(first, later)
    heads, tails = set(first), set(later)
    vocabulary = {x: i for i, x in enumerate(["[UNK]", *heads, *("##" + t for t in tails)])}
    library = models.WordPiece(vocabulary, unk_token="[UNK]", max_input_chars_per_word=10_000)
    words = [w for t in mixed(800, 6) + [t for _, t in prose(7, 100)] for w in t.split()] + ["a" * 300, "ё" * 50, "tionin" * 40]
    for w in words:
        want = greedy(w, heads, tails)
        assert automaton.count(w) == (1 + token_counts.UNKNOWN if want is None else want)
        assert len(library.tokenize(w)) == (want or 1)
    small = token_counts.LongestMatch(["a", "abcdx"], ["b", "c", "cdy", "dz"])
    assert [small.count(w) & 0xFF for w in ("abcdx", "abcdz", "abcdy", "a", "abcd", "b")] == [1, 4, 3, 1, 1, 1]
    assert small.count("abcd") == small.count("b") == 1 + token_counts.UNKNOWN


def test_count_tokens(spark):
    docs = documents(spark, EDGES).selectExpr("*", "5 as n_words")
    got = token_counts.count_tokens(docs, PIECES).collect()
    first, later = map(set, token_counts.model_pieces(PIECES))
    want = []
    for i, t in EDGES:
        w = [x.decode() for x in (t or "").encode().split()]
        n = [greedy(x, first, later) for x in w]
        want.append((i, len(w), sum(x or 1 for x in n), sum(x is None for x in n)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_counts.count_tokens(docs.limit(0), PIECES).count() == 0
