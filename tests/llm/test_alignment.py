import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from storelens.llm import alignment, queries
from storelens.llm.token_files import byte_signs
from tests.llm.common import EDGES, documents, prose

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = list("aabcdeех 'stre\n\t09.,!<|>/w") + [
    "  ", "\n ", " \n", "   ", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x0A>", "é", "é", "ß", "가", "😀", "\x1c",
    "\x85", "　", "\xa0", " the", " and", "\r\n", ");\r", "\r", "\x00", "​", "▁",
]


@pytest.fixture(scope="module")
def both():
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=B)


def placed(tokens):
    out, at = [], 0
    for i, data in tokens:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def brute(rows, both):
    """Per text: tokens of both libraries, groups, and all overlapping pairs, by comparing each with each."""
    first, second = both
    signs = {s: b for b, s in byte_signs().items()}
    docs = []
    for text in rows:
        a = b = []
        if text:
            a = [(i, bytes(signs[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
            for i in second.encode(text):
                p = second.id_to_piece(i)
                b = [*b, (i, bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode())]
            whole = (" " + text).encode()
            if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
                a = b = []
        a, b = placed(a), placed(b)
        groups, start = [], 0
        for end in sorted({e for _, _, e in a} & {e for _, _, e in b}):
            sides = [",".join(str(i) for i, s, e in side if s >= start and e <= end) for side in (a, b)]
            groups.append("|".join(sides))
            start = end
        links = collections.Counter((i, j) for i, s, e in a for j, u, v in b if s < v and u < e)
        docs.append((len(a), len(b), groups, links))
    count = collections.Counter(p for d in docs for p in d[3])
    top = {}
    for (i, _), n in count.items():
        top[i] = max(top.get(i, 0), n)
    out = []
    for n_a, n_b, groups, links in docs:
        best = sum(n for p, n in links.items() if count[p] == top[p[0]])
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        total = sum(n * count[p] for p, n in links.items())
        out.append((n_a, n_b, len(groups), sum(links.values()), best, total, digest, ";".join(groups)))
    return out, count, sum((d[3] for d in docs), collections.Counter())


def rows_of(n, seed=5):
    rng = random.Random(seed)
    rows = ["".join(rng.choice(PARTS[:-1] if k % 3 else PARTS) for _ in range(rng.randint(0, 40))) for k in range(n)]
    rows += [None, "", " ", "  ", "\n", "\r", "a ", "a  ", " a", "the " * 100, "x" * 2000, "▁", "a▁b"]
    return rows + [t for _, t in prose(2, 60)]


def test_query_matches_brute_force_over_several_blocks(spark, tmp_path, both, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 4000)
    rows = [r for r in EDGES if r[1] is None or len(r[1]) < 10_000] + [(100 + k, t) for k, t in enumerate(rows_of(1200))]
    documents(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_alignment(spark, str(tmp_path))
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert set(got.columns) == {"doc_id", *names}
    want, _, _ = brute([t for _, t in rows], both)
    want = [(i, *w[:7]) for (i, _), w in zip(rows, want)]
    assert sorted(map(tuple, got.select("doc_id", *names).collect()), key=str) == sorted(want, key=str)


def test_pairs_are_counted_over_all_documents(spark, both):
    rows = rows_of(300)
    _, count, links = brute(rows, both)
    got = alignment.count_pairs(documents(spark, list(enumerate(rows))).repartition(4), A, B).collect()
    assert {(r.a, r.b): (r.n_documents, r.n_links) for r in got} == {p: (n, links[p]) for p, n in count.items()}
    assert len(got) == len(count)


def test_full_output_clashing_columns_and_empty_tables(spark, both):
    rows = rows_of(50)
    docs = documents(spark, list(enumerate(rows))).selectExpr("*", "'mine' as groups", "1 as n_a", "2 as block", "array(3) as c0")
    got = alignment.align_documents(docs, A, B)
    assert got.columns == [
        "doc_id", "lang", "source", "n_chars", "block", "c0", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum",
    ]
    want, _, _ = brute(rows, both)
    assert {r.doc_id: r.groups for r in got.collect()} == {k: w[7] for k, w in enumerate(want)}
    assert alignment.align_digests(docs.limit(0), A, B).count() == 0
    assert alignment.count_pairs(docs.limit(0), A, B).count() == 0


def test_planes_keep_every_entry():
    rng = np.random.default_rng(1)
    for n_docs in (1, 7, 300, 70_000 // 2):
        pair, doc = np.nonzero(rng.random((40, n_docs)) < rng.choice([0.001, 0.05, 0.9], (40, 1)))
        got = alignment.unpack_plane(*alignment.pack_plane(pair, doc, 40, n_docs), n_docs)
        assert sorted(zip(*(x.tolist() for x in got))) == list(zip(pair.tolist(), doc.tolist()))
