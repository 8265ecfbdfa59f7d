import itertools
import random

import numpy as np
import xxhash

from storelens.llm import simhash
from storelens.llm.components import components
from tests.llm.common import EDGES, documents, prose


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    at = {p: p for p in prints}

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    for a, b in itertools.combinations(list(at), 2):
        if bin(a ^ b).count("1") <= 2:
            at[find(a)] = find(b)
    return {p: find(p) for p in at}


def near(rows, seed):
    """Rows with copies: exact, one word changed, and chains of such changes."""
    rng = random.Random(seed)
    out = list(rows)
    for i in range(len(rows)):
        words = rng.choice(rows)[1].split()
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = "changed"
        out.append((1000 + i, " ".join(words)))
    return out


def test_matches_brute_force(spark):
    rows = near(prose(1, 150, words=400), 2) + EDGES
    got = simhash.near_copies(documents(spark, rows)).collect()
    want = {}
    for i, t in rows:
        want.setdefault(i, set()).add(brute_print(t))
    assert len(got) == len(rows)
    assert all(r.fp & (2**64 - 1) in want[r.doc_id] for r in got)
    roots = brute_components({p for s in want.values() for p in s})
    least = {}
    for i, t in rows:
        if i is not None:
            root = roots[brute_print(t)]
            least[root] = min(i, least.get(root, i))
    assert all(r.component_id == least.get(roots[r.fp & (2**64 - 1)]) for r in got)


def test_every_pair_within_the_radius_shares_a_table():
    for radius in (1, 2):
        masks = simhash.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for bits in itertools.combinations(range(64), radius):
            differing = sum(1 << b for b in bits)
            assert any(m & differing == 0 for m in masks)


def test_links_join_exactly_the_near_prints(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(20)]
    prints = set(base)
    for b in base:  # full buckets: many prints around one
        for _ in range(60):
            prints.add(b ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(1, 2))) & (2**64 - 1))
    signed = np.array(sorted(prints), np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    for radius in (0, 1, 2):
        edges = simhash.links(frame, radius)
        got = edges.collect()
        assert all(bin((r.u ^ r.v) & (2**64 - 1)).count("1") <= radius for r in got)
        roots = {r.node: r.root for r in components(edges).collect()}
        want = {
            (a, b)
            for a, b in itertools.combinations(signed, 2)
            if bin((a ^ b) & (2**64 - 1)).count("1") <= radius
        }
        assert all(roots[a] == roots[b] for a, b in want)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(5000, 6000 + i) for i in range(300)] + [(7, 7), (-3, 9000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {i: 0 for i in range(201)} | {i: 5000 for i in [5000, *range(6000, 6300)]} | {-3: -3, 9000: -3}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_one_document_of_each_group_stays(spark):
    rows = near(prose(4, 60, words=300), 5) + EDGES
    docs = documents(spark, rows)
    ids = {r.component_id for r in simhash.near_copies(docs).collect()}
    kept = simhash.drop_near_copies(docs).collect()
    assert {r.doc_id for r in kept if r.doc_id is not None} == ids - {None}
    assert kept[0].asDict().keys() == set(docs.columns)
    assert simhash.drop_near_copies(docs.limit(0)).count() == 0


def test_clashing_columns_and_empty_table(spark):
    docs = documents(spark, EDGES).selectExpr("*", "1 as fp", "2 as component_id", "'x' as text_hash")
    assert simhash.near_copies(docs).count() == len(EDGES)
    assert simhash.near_copies(docs.limit(0)).count() == 0
