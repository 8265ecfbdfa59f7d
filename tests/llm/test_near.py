import itertools
import random

import corpus_pipeline
from storelens.llm import near
from tests.llm.common import EDGES, documents, prose


def grams(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def alike(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def brute_kept(rows):
    """Ids that stay: the smallest of each component of pairs with a similarity of 0.8 or more."""
    sets = [(i, grams(t)) for i, t in rows]
    at = list(range(len(rows)))

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if alike(sets[a][1], sets[b][1]):
            at[find(a)] = find(b)
    groups = {}
    for x, (i, _) in enumerate(sets):
        groups.setdefault(find(x), []).append(i)
    return sorted(min((i for i in g if i is not None), default=-1) for g in groups.values())


def edited(words, rng, most):
    out = list(words)
    for n in range(rng.randint(1, most)):
        out[rng.randrange(len(out))] = f"edit{rng.randrange(10**6)}"
    return " ".join(out)


def test_planted_near_copies_match_brute_force(spark):
    rng = random.Random(12)
    rows = prose(5, 80, words=400, vocabulary=3000)
    rows = [(i, t) for i, t in rows if len(t.split()) > 20]
    rows += [(1000 + n, edited(t.split(), rng, max(1, len(t.split()) // 45))) for n, (_, t) in enumerate(rows * 3)]
    # chains: each is near the one before, ends are apart
    step = prose(6, 1, words=400, vocabulary=3000)[0][1].split() * 2
    for n in range(30):
        step = edited(step, rng, 3).split()
        rows.append((3000 + n, " ".join(step)))
    rng.shuffle(rows)
    want = brute_kept(rows)
    assert len(want) < len(rows) * 0.6
    kept = near.drop_near_copies(documents(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == want
    assert {(r.doc_id, r.text) for r in kept} <= set(rows)


def test_members_far_from_a_buckets_pivot_are_still_linked(spark, monkeypatch):
    """One band of one shingle puts texts that share a passage into common buckets."""
    monkeypatch.setattr(near, "PIVOTS", 2)
    rng = random.Random(4)
    shared = " ".join(f"s{i}" for i in range(40))
    rows = []
    for n in range(25):
        own = " ".join(f"o{n}x{i}" for i in range(12))
        rows += [(10 * n, f"{shared} {own}"), (10 * n + 1, f"{shared} {own} tail{n}"), (10 * n + 2, f"{shared} {own}")]
    rng.shuffle(rows)
    want = brute_kept(rows)
    assert sorted(r.doc_id for r in near.drop_near_copies(documents(spark, rows)).collect()) == want


def test_edge_rows_and_clashing_columns(spark):
    docs = documents(spark, EDGES + [(70, "four words stand here"), (71, "Four words\nSTAND here")])
    docs = docs.selectExpr("*", "1 as fp", "2 as root", "'x' as text_hash", "3 as key")
    kept = near.drop_near_copies(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id for r in kept.collect()), key=str)
    assert got == sorted([1, 4, 5, 5, None, 8, 9, 11, 70], key=str)
    assert near.drop_near_copies(docs.limit(0)).count() == 0


def test_the_pipelines_stage_drops_copies_with_a_few_edited_words(spark):
    rng = random.Random(7)
    words = prose(8, 1, words=400, vocabulary=3000)[0][1].split() * 3
    words = [f"{w}{i % 89}" for i, w in enumerate(words)][:300]
    rows = [(1, " ".join(words))] + [(2 + n, edited(words, rng, 4)) for n in range(12)]
    assert len(words) > 200 and brute_kept(rows) == [1]
    assert [r.doc_id for r in corpus_pipeline.near_copies(spark, documents(spark, rows), "").collect()] == [1]


def test_common_shingles_are_counted_by_blocks(monkeypatch):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(near, "COLUMNS", 7)
    rng = random.Random(5)
    sets = [sorted(rng.sample(range(60), rng.randint(0, 40))) for _ in range(30)]
    packed = [np.array(x, "<u8").tobytes() for x in sets]
    ours, theirs = pa.chunked_array([packed[:12]], pa.binary()), pa.chunked_array([packed[12:]], pa.binary())
    counts = near._shared(ours, theirs)
    assert counts.tolist() == [[len(set(a) & set(b)) for b in sets[12:]] for a in sets[:12]]


def test_block_links_name_one_pivot_of_each_other_component():
    import numpy as np
    import pyarrow as pa

    def table(side, rows):
        names = ["key", "part", "block", "fp", "root", "n", "members"]
        full = [(1, 0, 0, fp, root, len(x), np.array(sorted(x), "<u8").tobytes()) for fp, root, x in rows]
        return pa.table({f"{side}_{c}": [r[i] for r in full] for i, c in enumerate(names)})

    base = set(range(20))
    pivots = table("v", [(1, 1, base), (2, 1, base | {30}), (3, 3, base | {31}), (4, 4, {40, 41})])
    members = table("u", [(9, 1, base), (10, 10, base | {50}), (11, 11, set(range(100, 120)))])
    links = near._block_links(members, pivots).to_pylist()
    assert sorted((r["u"], r["v"]) for r in links) == [(9, 3), (10, 1), (10, 3)]
    assert near._block_links(members.slice(0, 0), pivots).num_rows == 0
