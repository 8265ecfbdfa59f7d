from collections import defaultdict

from storelens.llm.line_dedup import dedup_lines
from tests.llm.common import EDGES, documents


def brute(rows, min_chars=20, min_docs=3):
    holders = defaultdict(set)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(lower)

    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    keeper = {k: max(x for x in s if x is not None) for k, s in holders.items() if len(s) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if key(x) not in keeper or keeper[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=str)


def test_matches_brute_force(spark):
    shared = "A line that MANY documents share é"
    rows = EDGES + [
        (20 + i, f"own {i}\n {shared.upper().replace('É', 'é')}\t\n{shared}\nshort line\n{shared if i % 2 else 'x' * 19}")
        for i in range(40)
    ]
    rows += [(70, shared), (71, "only two documents hold this"), (72, "only two documents hold this"), (None, shared)]
    rows += [(73, "Ünï" + "c" * 20), (74, "ünï" + "c" * 20), (75, "Ünï" + "C" * 20)]
    docs = documents(spark, rows)
    got = dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_extra_columns_and_empty_table(spark):
    docs = documents(spark, EDGES).selectExpr("*", "7 as pos", "'a' as key", "1 as k1", "2 as kept_text", "3 as keeper")
    out = dedup_lines(docs)
    assert out.count() == len(EDGES)
    assert {"pos", "key", "k1", "keeper", "kept_text"} <= set(out.columns)
    assert dedup_lines(docs.limit(0)).count() == 0
