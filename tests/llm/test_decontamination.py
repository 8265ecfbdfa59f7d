import random
import re
from collections import defaultdict

from storelens.llm.decontamination import WINDOW, decontaminate, document_prints, find_leaks, item_prints
from tests.llm.common import EDGES, documents, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[a : a + n])].add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w = words(t)
        hit, found = set(), set()
        for n in range(1, 11):
            for a in range(len(w) - n + 1):
                if tuple(w[a : a + n]) in windows:
                    hit.update(range(a, a + n))
                    found |= windows[tuple(w[a : a + n])]
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def tables(spark):
    rng = random.Random(7)
    items = prose(11, 40, words=60, vocabulary=400)
    items += [(None, items[0][1]), (77, items[1][1]), (78, "Short Item é"), (79, ""), (80, None), (81, "!!"), (82, "y" * 30)]
    items += [(9, items[2][1]), (9, items[2][1])]
    docs = prose(12, 80, words=120, vocabulary=400)
    for i in range(40):
        w = rng.choice(items[:40])[1].split()
        n = rng.randint(1, 25)
        a = rng.randrange(max(1, len(w) - n))
        part = [x.upper() + rng.choice([",", "", "\n"]) for x in w[a : a + n]]
        docs.append((200 + i, " ".join(["front"] * rng.randint(0, 3) + part + ["short", "ITEM-É", "short", "item", "é"])))
    return docs + EDGES, items


def test_matches_brute_force(spark):
    docs, items = tables(spark)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    rows = find_leaks(documents(spark, docs), benchmark).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in rows), key=str)
    assert got == brute(docs, items)
    assert sum(r.n_hit > 0 for r in rows) > 30


def test_clean_documents_stay_whole(spark):
    docs, items = tables(spark)
    frame = documents(spark, docs).selectExpr("*", "1 as row", "2 as hits", "'x' as item_ids")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    left = decontaminate(frame, benchmark)
    assert left.columns == frame.columns
    clean = {i: h for i, _, h, _ in brute([d for d in docs if d[0] not in (5, None)], items)}
    kept = {r.doc_id for r in left.collect()}
    assert {i for i, h in clean.items() if not h} == kept - {5, None}


def test_empty_tables(spark):
    docs, items = tables(spark)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    assert find_leaks(documents(spark, docs).limit(0), benchmark).count() == 0
    none = find_leaks(documents(spark, docs), benchmark.limit(0)).collect()
    assert len(none) == len(docs) and all(r.n_hit == 0 and r.item_ids == [] for r in none)


def test_fingerprints_are_thinned_and_meetings_reach_whole_passages(spark):
    rng = random.Random(3)
    item = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    items = item_prints(benchmark)
    rows = items.collect()
    assert 50 < len(rows) < 200  # one per run of windows that share it, not one per window
    assert sum(len(r.windows) for r in rows) == len(item) - WINDOW + 1
    docs = [(i, " ".join(["x"] * i + item[7 * i : 7 * i + n] + ["y"])) for i, n in enumerate([9, 10, 11, 16, 40, 300])]
    for r in find_leaks(documents(spark, docs), benchmark).collect():
        n = [9, 10, 11, 16, 40, 300][r.doc_id]
        assert r.n_hit == (n if n >= WINDOW else 0)
        if r.n_hit:
            assert min(s.start for s in r.spans) == r.doc_id
            assert max(s.start + s.size for s in r.spans) == r.doc_id + n
    seen = document_prints(documents(spark, docs), items).collect()
    assert all(len(r.prints) < max(2, r.n_words / 2) for r in seen)


def test_repeated_words_and_long_words(spark):
    long = "q" * 4000
    items = [(1, "the " * 30), (2, " ".join([long, *"abcdefghi"])), (3, "a b a b a b a b a b a b a")]
    docs = [(1, "the " * 500), (2, " ".join(["z", long, *"abcdefghi", "z"])), (3, "b a " * 40), (4, " ".join([long + "q", *"abcdefghi"]))]
    rows = find_leaks(documents(spark, docs), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in rows) == brute(docs, items)
