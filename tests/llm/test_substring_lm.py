import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from storelens.llm import blocks, lm, substring
from tests.llm.common import EDGES, documents, prose


@pytest.fixture(autouse=True)
def small_blocks(monkeypatch):
    """Many blocks and buckets even for small tables."""
    monkeypatch.setattr(blocks, "BUCKET_KEYS", 2000)


def words(text):
    return (text or "").encode().lower().split()


def test_packing_is_lossless():
    rng = np.random.default_rng(1)
    keys = np.sort(rng.integers(0, 2**64, 1000, np.uint64))
    assert (blocks.unpacked_sorted(blocks.packed_sorted(keys)) == keys).all()
    pair = np.zeros(5, lm.ENTRY)
    pair["f1"] = [1, 2**40, 3, 4, 5]
    assert (blocks.unpacked(blocks.packed(pair), lm.ENTRY) == pair).all()


def planted(n=60, size=55):
    rng = random.Random(3)
    rows = prose(21, n, words=200, vocabulary=20_000)
    passages = [" ".join(f"p{k}w{rng.randrange(5000)}" for _ in range(size)) for k in range(8)]
    out = []
    for i, (_, t) in enumerate(rows):
        w = t.split()
        a = rng.randrange(len(w) + 1)
        if i < 32:
            w[a:a] = passages[i % 8].upper().replace(" ", "\n" if i % 2 else " ").split("\0")
        out.append((100 + i, " ".join(w)))
    return out, passages


def test_repeated_passages_are_found_and_clean_texts_left_alone(spark):
    rows, _ = planted()
    rows += [(i, t) for i, t in EDGES if i not in (5,)] + [(900, rows[50][1]), (901, rows[0][1])]
    got = {r.doc_id: r for r in substring.find_repeats(documents(spark, rows)).collect()}
    holders = defaultdict(list)
    for i in range(32):
        holders[i % 8].append(100 + i)
    for ids in holders.values():
        first = min(ids)
        assert got[first].n_dropped_words == 0 and got[first].n_shared_words >= 20
        for i in ids:
            if i != first:
                assert 20 <= got[i].n_dropped_words <= 55
    for i in range(32, 60):
        if i != 50:
            assert got[100 + i].n_shared_words == 0
    n = len(words(rows[50][1]))
    if n >= 20:
        assert got[900].n_dropped_words == n and got[150].n_dropped_words == 0
    assert got[901].n_dropped_words == len(words(rows[0][1]))


def brute_chunks(w):
    """Chunks by the stated rule, from the words' own hashes."""
    h = [int(x) for x in word_hashes(w)]
    mask = 2**64 - 1
    cut, mixed = {0, len(w)}, {}
    for i in range(1, len(w) + 1):
        gear = sum(h[i - 1 - j] << j for j in range(substring.GEAR_WORDS) if i - 1 - j >= 0) & mask
        mixed[i] = int(substring.mix(np.array([gear], np.uint64))[0])
        if mixed[i] < (1 << 64) // substring.CUT_ONE_IN:
            cut.add(i)
    # a window without a cut is cut at all its smallest hashes
    natural = sorted(cut)
    for low, high in zip(natural, natural[1:]):
        for first in range(low + 1, high - substring.WINDOW + 1):
            window = range(first, first + substring.WINDOW)
            least = min(mixed[i] for i in window)
            cut.update(i for i in window if mixed[i] == least)
    out = []
    for a in sorted(cut):
        if a + substring.LEAST <= len(w):
            b = min(min(c for c in cut if c >= a + substring.LEAST), a + substring.MOST)
            out.append((a, b))
    if out:
        out[-1] = (out[-1][0], min(len(w), out[-1][0] + substring.MOST))
    return out


def word_hashes(w):
    data = np.frombuffer(b" ".join(w), np.uint8)
    s, e, _ = substring.spans(data, np.array([0, len(data)]), substring.WHITE)
    return substring.hashes(data, s, e)


def test_repeats_match_brute_force(spark):
    rows, _ = planted(40, 30)
    rows += [(500 + i, rows[i][1]) for i in range(5)] + [(77, "same words " * 60), (78, "same words " * 60), (79, None)]
    held = defaultdict(set)
    chunks = {}
    for i, t in rows:
        w = words(t)
        chunks[i] = [(a, b, tuple(w[a:b])) for a, b in brute_chunks(w)]
        for _, _, c in chunks[i]:
            held[c].add(i)
    for r in substring.find_repeats(documents(spark, rows)).collect():
        mine = chunks[r.doc_id]
        shared = {x for a, b, c in mine if len(held[c]) > 1 for x in range(a, b)}
        gone = {x for a, b, c in mine if min(held[c]) < r.doc_id for x in range(a, b)}
        assert gone == {x for s in r.dropped for x in range(s.start, s.end)}
        assert (r.n_chunks, r.n_shared_words, r.n_dropped_words) == (len(mine), len(shared), len(gone))


def test_dropping_repeats_keeps_the_rest(spark):
    rows, passages = planted()
    docs = documents(spark, rows + EDGES).selectExpr("*", "1 as words", "2 as n")
    out = substring.drop_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(rows) + len(EDGES)
    kept = {r.doc_id: r.text for r in out.collect()}
    found = {r.doc_id: r for r in substring.find_repeats(docs).collect()}
    for i, t in rows:
        w, gone = words(t), {x for s in found[i].dropped for x in range(s.start, s.end)}
        assert words(kept[i]) == [x for k, x in enumerate(w) if k not in gone]
    assert substring.find_repeats(docs.limit(0)).count() == 0


def brute_lm(rows):
    end = b"\n end"
    texts = [(i, zlib.crc32(b"" if i is None else str(i).encode()) % 7, words(t) + [end]) for i, t in rows]

    def counts(folds):
        one, two, starts = Counter(), Counter(), 0
        for _, f, w in texts:
            if f in folds:
                starts += 1
                one.update(w)
                two.update(zip([None, *w], w))
        one[None] = starts
        return one, two

    return texts, counts


def test_scores_match_brute_force(spark):
    rng = random.Random(9)
    rows = prose(31, 300, words=80, vocabulary=150)
    rows = [(rng.randrange(10**6), t) for _, t in rows] + EDGES
    texts, counts = brute_lm(rows)
    one, two = counts({f for f in range(7) if f != 2})
    known = {w for w, n in one.items() if n and w is not None}
    total = sum(n for w, n in one.items() if w is not None)
    one_a, two_a = counts({f for f in range(7) if f not in (2, 3)})
    total_a = sum(n for w, n in one_a.items() if w is not None)
    cells = Counter()
    for _, f, w in texts:
        if f == 3:
            for v, x in zip([None, *w], w):
                q = lambda a, b: -1 if not a else round(-8 * math.log2(a / b))
                c = one_a[v]
                cells[int(lm.bucket_of(np.array([c]))[0]), q(two_a[v, x], max(c, 1)), q(one_a[x], total_a)] += 1
    keys = np.array(sorted(cells))
    weights = lm.learn_weights(
        {"bucket": keys[:, 0], "pair": keys[:, 1], "word": keys[:, 2], "n": np.array([cells[tuple(k)] for k in keys.tolist()])},
        len(known),
    )
    want = []
    for i, f, w in texts:
        base = sum(math.log10((one[x] + 1) / (total + len(known) + 1)) for x in w)
        score = 0.0
        for v, x in zip([None, *w], w):
            l2, l1, l0 = weights[int(lm.bucket_of(np.array([one[v]]))[0])]
            score += math.log10(l2 * two[v, x] / max(one[v], 1) + l1 * one[x] / total + l0 / (len(known) + 1))
        want.append((i, f == 2, len(w), sum(one[x] > 0 for x in w), total, base, score))
    got = lm.score_documents(documents(spark, rows).selectExpr("*", "1 as fold", "2 as block")).collect()
    order = lambda r: (str(r[0]), r[2], r[5])
    for a, b in zip(sorted(map(tuple, got), key=order), sorted(want, key=order), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_mixture_beats_the_base_on_held_out_texts(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(200)]
    follow = {v: rng.sample(vocab, 4) for v in vocab}
    rows = []
    for i in range(700):
        w = [rng.choice(vocab)]
        while len(w) < 60:
            w.append(rng.choice(follow[w[-1]]))
        rows.append((i, " ".join(w)))
    got = [r for r in lm.score_documents(documents(spark, rows)).collect() if r.held_out]
    assert len(got) > 50 and sum(r.score for r in got) > 0.5 * sum(r.base_score for r in got)


def test_edge_tables(spark):
    assert lm.score_documents(documents(spark, EDGES).limit(0)).count() == 0
    only = lm.score_documents(documents(spark, [(2, "no training text here")])).collect()
    assert len(only) == 1 and math.isfinite(only[0].score)
    held = [i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 2]
    none = lm.score_documents(documents(spark, [(i, "a b") for i in held])).collect()
    assert all(r.held_out and r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in none)


def chunked(texts):
    made = [word_hashes(t.encode().split()) for t in texts]
    begin = np.cumsum([0, *map(len, made)])
    starts, ends, digests, owner = substring.chunks(np.concatenate(made), begin)
    out = [[] for _ in texts]
    for a, b, d, o in zip(starts, ends, digests, owner):
        out[o].append((int(a - begin[o]), int(b - begin[o]), int(d)))
    return out


def repeating(seed):
    """Texts of 20 words and more, many of them of one short phrase over and over."""
    rng = random.Random(seed)
    out = []
    for _ in range(300):
        phrase = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice((1, 1, 2, 3, 5, 8)))]
        out.append(" ".join((phrase * 400)[: rng.randint(20, 400)]))
    return out


def test_every_word_lies_in_a_chunk():
    texts = repeating(1) + [t for _, t in prose(2, 100, words=300, vocabulary=3000) if len(t.split()) >= 20]
    for t, found in zip(texts, chunked(texts)):
        assert {x for a, b, _ in found for x in range(a, b)} == set(range(len(t.split())))
        assert all(substring.LEAST <= b - a <= substring.MOST for a, b, _ in found)


def test_repeated_phrases_match_wherever_they_stand():
    """No run of 51 words that another text has, too, lies outside the chunks that both have."""
    rng = random.Random(3)
    for t in [t for t in repeating(4) if len(t.split()) >= 100][:150]:
        w = t.split()
        cut = rng.randrange(20)
        before, behind = (" ".join(f"x{rng.randrange(10**6)}" for _ in range(30)) for _ in range(2))
        one, two = chunked([f"{before} {t}", f"{' '.join(w[cut:])} {behind}"])
        held = {d for _, _, d in one}
        shared = {x for a, b, d in two if d in held for x in range(a, b)}
        n = len(w) - cut
        assert all(shared & set(range(x, x + 51)) for x in range(n - 50))


def test_a_block_sends_a_digest_once():
    ids = [7, -3, 2**63 - 1, 9]
    digests, owner = np.array([5, 9, 5, 5, 9, 1], np.uint64), np.array([0, 0, 2, 1, 0, 3], "<i4")
    block = pa.table({"ids": [ids], "owner": [owner.tobytes()], "digests": [digests.tobytes()]}).to_batches()[0]
    keys, entries = substring._entries(block, 0)
    assert keys.tolist() == [1, 5, 9]
    sent = blocks.unpacked(blocks.packed(entries), substring.ENTRY)
    assert [(int(e["least"]), int(e["least"] + e["above"])) for e in sent] == [(9, 9), (-3, 2**63 - 1), (7, 7)]


def test_flags_of_merged_digests_match_brute_force(spark):
    """Texts with a passage many times over, in one document and in many; chunks are those of ``chunks``."""
    rows, passages = planted(40, 30)
    rows += [(500 + i, rows[i][1]) for i in range(5)] + [(-4, f"{passages[0]} {passages[0]}"), (76, "same " * 150)]
    rows += [(77 + i, "same words " * 60) for i in range(3)] + [(90, "an own phrase of few words " * 30)]
    held = defaultdict(set)
    found = dict(zip([i for i, _ in rows], chunked([t for _, t in rows])))
    for i, mine in found.items():
        for _, _, d in mine:
            held[d].add(i)
    for r in substring.find_repeats(documents(spark, rows)).collect():
        mine = found[r.doc_id]
        shared = {x for a, b, d in mine if len(held[d]) > 1 for x in range(a, b)}
        gone = {x for a, b, d in mine if min(held[d]) < r.doc_id for x in range(a, b)}
        assert gone == {x for s in r.dropped for x in range(s.start, s.end)}
        assert (r.n_chunks, r.n_shared_words, r.n_dropped_words) == (len(mine), len(shared), len(gone))
