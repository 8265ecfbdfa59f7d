import math
import re
from collections import Counter

import xxhash

from storelens.llm import quality
from tests.llm.common import EDGES, documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = re.compile(r"[#*$%&|<>]")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    repeat = {i + k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    counts = (len(w), sum(map(len, w)), len(SYMBOLS.findall(text)), len(lines) - len(set(lines)), len(repeat))
    return counts, len(w) < 10 or 100 * len(repeat) > 20 * len(w)


def signed(x):
    return x - 2**64 if x >> 63 else x


def features(text, buckets):
    """Bucket numbers of words and neighbouring words, with the hash the engine has."""
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in WORD.findall(text or "")]
    pairs = []
    for a, b in zip(h, h[1:]):
        seed = xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)
        pairs.append(xxhash.xxh64_intdigest(b.to_bytes(8, "little"), seed))
    return [signed(x) % buckets for x in [*h, *pairs]]


def rows_and_labels():
    rows = prose(41, 120, words=150, vocabulary=400)
    rows += [(500 + i, "<junk> " * (i % 30) + "### $$$ | " * 12 + f"x{i}") for i in range(30)]
    rows += [(600, "a b c d e f g " * 4 + " ".join(map(str, range(60)))), (601, "same line\n" * 9 + "\n \n" + "other words " * 3)]
    rows += [(602, "one two three four five six one two three four five"), (603, " ".join("aab" for _ in range(7)))]
    rows += [(604, "tail  \x0b\x0c words"), (605, "no break\x85here")] + EDGES
    labels = [(i, int(i < 500), 0) for i, _ in rows if i is not None and i % 3 == 0] + [(None, 1, 0), (9999, 1, 0), (3, None, None)]
    return rows, labels


def test_counts_and_verdicts_match_brute_force(spark):
    rows, labels = rows_and_labels()
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    buckets = 500
    got = quality.judge(documents(spark, rows).selectExpr("*", "1 as kept", "2 as _x"), frame, buckets).collect()
    assert len(got) == len(rows)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    raw, target = Counter(), Counter()
    for i, t in rows:
        f = features(t, buckets)
        raw.update(f)
        if i in good:
            target.update(f)
    raw_all, target_all, prior = sum(raw.values()) + buckets, sum(target.values()), 20 * buckets

    def ratio(b):
        share = (raw[b] + 1) / raw_all
        return round((math.log((target[b] + prior * share) / (target_all + prior)) - math.log(share)) * quality.UNIT)

    want = []
    for i, t in rows:
        counts, failed = base(t)
        f = features(t, buckets)
        total = sum(map(ratio, f))
        kept = not failed and total >= int(quality.THRESHOLD * quality.UNIT) * len(f)
        want.append((i, counts, failed, kept, round(total / quality.UNIT / len(f), 4) if f else 0.0))
    mine = [
        (r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words), r.base_failed, r.kept, round(r.log_ratio, 4))
        for r in got
    ]
    assert sorted(mine, key=str) == sorted(want, key=str)
    assert 0 < sum(r.kept for r in got) < len(got)


def test_edges(spark):
    rows, labels = rows_and_labels()
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    assert quality.judge(documents(spark, rows).limit(0), frame).count() == 0
    flat = quality.judge(documents(spark, rows), frame.limit(0)).collect()
    assert len(flat) == len(rows) and all(r.kept == (not r.base_failed) for r in flat)
    assert quality.trusted_ids(frame, 5).count() == 5


def test_a_filter_on_the_verdict_is_not_copied(spark):
    rows, labels = rows_and_labels()
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    plan = quality.judge(documents(spark, rows), frame, 50).filter("kept").select("doc_id")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("regexp") + text.count("split(") <= 6
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
