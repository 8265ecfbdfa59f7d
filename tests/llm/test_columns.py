import pytest

from storelens.llm import decontamination, line_dedup, near, quality, simhash, substring
from tests.llm.common import EDGES, documents, prose

HELPERS = (
    "_id _hash _drop _text_hash _lines _own dropped _hash_ _w _h _p _n _g _s _t _mask _ratios _sum _trusted "
    "_text id_hash fp key row hits root _id0 _HASH0"
).split()


def functions(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id bigint, text string")
    labels = spark.createDataFrame([(40, 1), (41, 0)], "doc_id bigint, quality int")
    return {
        "dedup_lines": lambda d: line_dedup.dedup_lines(d),
        "drop_repeats": lambda d: substring.drop_repeats(d),
        "simhash": lambda d: simhash.drop_near_copies(d),
        "near": lambda d: near.drop_near_copies(d),
        "decontaminate": lambda d: decontamination.decontaminate(d, items),
        "judge": lambda d: quality.judge(d, labels),
    }


@pytest.mark.parametrize("name", ["dedup_lines", "drop_repeats", "simhash", "near", "decontaminate", "judge"])
def test_columns_with_helper_names_keep_their_content(spark, name):
    passage = " ".join(f"w{i}" for i in range(80))
    rows = EDGES + [(40 + i, t) for i, t in prose(4, 12)] + [(70, passage), (71, f"{passage} end"), (72, passage)]
    docs = documents(spark, rows)
    run = functions(spark)[name]
    wide = docs.selectExpr("*", *[f"concat('{h}', coalesce(doc_id, -1)) as {h}" for h in HELPERS])
    plain, out = run(docs), run(wide)
    assert out.columns[: len(wide.columns)] == wide.columns or set(wide.columns) <= set(out.columns)
    narrow = plain.columns
    assert sorted(map(repr, out.select(*narrow).collect())) == sorted(map(repr, plain.collect()))
    for r in out.select("doc_id", *HELPERS).collect():
        assert list(r)[1:] == [f"{h}{-1 if r.doc_id is None else r.doc_id}" for h in HELPERS]
