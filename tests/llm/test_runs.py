import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from storelens.llm import ntt, queries, runs
from tests.llm.common import EDGES, documents, prose


def brute(w):
    """All maximal runs by comparing every word with every later one."""
    n, got = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                got.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in got.items())


def periodic(rng, most):
    k, w = rng.choice([1, 2, 3, 5, 40]), []
    size = rng.randint(0, most)
    while len(w) < size:
        unit = [rng.randrange(k) for _ in range(rng.randint(1, 14))]
        w += (unit * rng.randint(1, 9))[: rng.randint(1, 90)]
    return w


def as_rows(values):
    return list(zip(*(x.tolist() for x in runs.periodic_runs(np.array(values, np.int64)))))


def test_runs_match_brute_force():
    rng = random.Random(3)
    for _ in range(800):
        w = periodic(rng, 150)
        assert as_rows(w) == brute(w), w


def test_long_periods_and_nested_runs_match_brute_force():
    rng = random.Random(4)
    unit = [rng.randrange(300) for _ in range(90)]
    nested = ([1] * 20 + [2, 3] * 9 + unit[:11]) * 6
    for w in (unit * 5, unit[:7] + unit * 4 + unit[:50], nested, [0] * 700, ([0] * 30 + [1]) * 12):
        assert as_rows(w) == brute(w)


def test_a_long_text_of_one_word_is_one_run():
    assert as_rows([5] * 300_000) == [(0, 300_000, 1)]


@pytest.mark.parametrize("size", [1, 2, 8, 64])
def test_transforms_find_the_blocks_that_stand_again(size):
    rng = np.random.default_rng(size)
    values = np.tile(rng.integers(0, 1 << 20, 3 * size + 1), 4)
    values[::7] = 3
    starts = np.arange(0, len(values) - 2 * size, size)
    want = [
        (s, d)
        for s in starts.tolist()
        for d in range(size, 2 * size)
        if s + d + size <= len(values) and (values[s : s + size] == values[s + d : s + d + size]).all()
    ]
    got = ntt.occurrences(values, starts, size)
    assert sorted(zip(*(x.tolist() for x in got))) == want


def test_backward_undoes_forward():
    rows = np.random.default_rng(1).integers(0, 1 << 28, (3, 64))
    for prime, generator in ntt.PRIMES:
        assert (ntt.backward(ntt.forward(rows, prime, generator), prime, generator) == rows % prime).all()


def words_of(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def expected(doc_id, text):
    w = words_of(doc_id, text)
    found = brute(w)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = (None,) * 4
    if found:
        s, m, q = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]))
        best = (s, m, q, 1000 * m // q)
    sums = ["".join(f"{s},{m},{q}\n" for s, m, q in found), " ".join(x for i, x in enumerate(w) if i not in gone)]
    return (doc_id, len(found), *best, *(hashlib.sha256(x.encode()).hexdigest() for x in sums))


def test_query_over_a_whole_table(spark, tmp_path):
    rng = random.Random(6)
    rows = [r for r in EDGES if r[1] is None or len(r[1]) < 10_000]
    rows += [(100 + i, t) for i, t in prose(3, 600, words=120)]
    rows += [(5000 + i, " ".join(f"w{x}" for x in periodic(rng, 300))) for i in range(300)]
    rows += [(7000 + i, "\n".join("same" for _ in range(i))) for i in range(12)]
    documents(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_periodic_runs(spark, str(tmp_path))
    assert got.columns == (
        ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    )
    want = [expected(*r) for r in rows]
    assert sum(r[1] for r in want) > 300 and sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 50
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_equal_exponents_are_won_by_the_first_run_and_output_is_whole(spark):
    text = "a a a a a a x b b b b b b"
    row = runs.find_runs(documents(spark, [(1, text), (2, None)])).orderBy("doc_id").collect()
    assert [tuple(r) for r in row[0].runs] == [(0, 6, 1), (7, 6, 1)]
    assert (row[0].start, row[0].exponent_milli, row[0].collapsed, row[0].n_words) == (0, 6000, "a x b", 13)
    assert (row[1].n_runs, row[1].start, row[1].runs, row[1].collapsed) == (0, None, [], "")


def test_clashing_columns_and_empty_tables(spark):
    docs = documents(spark, EDGES).selectExpr("*", "-7 as start", "1 as runs", "2 as collapsed", "4 as words")
    got = runs.find_runs(runs.repeating(docs))
    assert got.count() == len(EDGES) and got.columns[:5] == ["doc_id", "lang", "source", "n_chars", "words"]
    assert got.filter("start = -7").count() == 0
    assert runs.find_runs(runs.repeating(docs.limit(0))).count() == 0
