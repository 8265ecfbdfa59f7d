import hashlib
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from storelens.llm import queries, word_bpe
from tests.llm.common import EDGES, documents

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = list("aabcdeехз 'stre\n\t09.,!<|>/w") + [
    "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "</w>", "é", "é", "İ", "ß", "Σ", "ς", "가", "하",
    "😀", "\x1c", "\x85", "　", "'LL", "'re", "ſ", "K", "ͅ", "x" * 50,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(1)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(5000)]
    for n in (39, 40, 41, 100, 1000, 5000):
        made += ["x" * n, "".join(rng.choice("ab") for _ in range(n)), "".join(rng.choice("etaoin") for _ in range(n))]
    return made


def test_ids_and_decoded_texts_are_the_librarys(library):
    own = word_bpe.WordEncoder(PATH)
    for text in texts():
        want = library.encode(text, add_special_tokens=False).ids
        n, ids, decoded = own.encode(text)
        assert list(struct.unpack(f"<{n}I", ids)) == want, text
        assert decoded == library.decode(want, skip_special_tokens=False), text


def test_any_ids_decode_as_in_the_library(library):
    own, rng = word_bpe.WordEncoder(PATH), random.Random(2)
    for _ in range(300):
        ids = [rng.randrange(49_500) for _ in range(rng.randint(0, 12))]
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_fragments_end_at_forced_boundaries_only(monkeypatch):
    own = word_bpe.WordEncoder(PATH)
    word, parts, plain = "qzjxthe", [], own.merge  # a fragment is merged once, so none stands twice
    whole = plain(own.marked(word))
    monkeypatch.setattr(own, "merge", lambda symbols: parts.append(symbols) or plain(symbols))
    assert own.word_ids(word) == whole
    assert len(parts) > 1 and sum(parts, []) == own.marked(word)
    for left, right in zip(parts, parts[1:]):
        assert (left[-1], right[0]) not in own.inside


def test_every_letter_that_is_not_normalised_by_the_library(library):
    own = word_bpe.WordEncoder(PATH)
    for sign in map(chr, range(1, 0x600)):
        text = f"a{sign}b {sign}'s{sign}9"
        assert own.encode(text)[0] == len(library.encode(text, add_special_tokens=False).ids), hex(ord(sign))
        assert own.encode(text)[2] == library.decode(library.encode(text, add_special_tokens=False).ids, skip_special_tokens=False)


def test_small_memory_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(word_bpe, "MEMORY", 3)
    own = word_bpe.WordEncoder(PATH)
    for text in texts()[:500]:
        assert own.encode(text)[0] == len(library.encode(text, add_special_tokens=False).ids)


def test_query_over_a_whole_table(spark, tmp_path, library):
    rows = [*EDGES, *((100 + i, t) for i, t in enumerate(texts()))]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        digest = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        want.append((i, len(ids), digest, hashlib.sha256(decoded.encode()).hexdigest()))
    got = queries.op11_word_bpe(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_clashing_columns_empty_tables_and_full_output(spark):
    docs = documents(spark, EDGES).selectExpr("*", "'mine' as ids_sha256", "2 as n_tokens", "3 as `\ttext2`")
    got = word_bpe.encode_digests(docs, PATH)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "\ttext2", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert got.count() == len(EDGES) and got.filter("ids_sha256 = 'mine'").count() == 0
    assert word_bpe.encode_digests(docs.limit(0), PATH).count() == 0
    full = word_bpe.encode_documents(documents(spark, EDGES), PATH).collect()
    one = next(r for r in full if r.doc_id == 4)
    assert one.ids == [637] or len(one.ids) == 1
    assert next(r for r in full if r.doc_id == 1).ids == []
