import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from storelens.llm import queries
from tests.llm.common import documents
from tests.llm.test_decontamination import brute as brute_leaks
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_near import brute_kept
from tests.llm.test_quality import rows_and_labels
from storelens.llm import quality


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("tables")
    rows, labels = rows_and_labels()
    seen = set()
    rows = [r for r in rows if r[0] is not None and not (r[0] in seen or seen.add(r[0]))]
    rng = random.Random(8)
    vocabulary = [w for _, t in rows[:120] for w in t.split()]

    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    line = " ".join(vocabulary[:9])
    rows += [(2000 + i, f"{text(80)}\n{line}") for i in range(40)]
    rows += [(3000 + i, t) for i, (_, t) in enumerate(rows[-20:])]
    items = [(i, text(30)) for i in range(10)] + [(10, None)]
    rows += [(4000 + i, f"{text(20)}\n{t} {text(20)}") for i, t in items[:10]]
    documents(spark, rows).write.parquet(f"{home}/documents.parquet")
    labels += [(i, 1, 0) for i, _ in rows if i >= 2000]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{home}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{home}/benchmark.parquet")
    return str(home), rows, items


def test_stages_and_order():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and names[0] == "quality rules" and names[-1].startswith("SentencePiece")


def test_run_matches_the_stages_by_brute_force(spark, sf):
    home, rows, items = sf
    labels = spark.read.parquet(f"{home}/labels.parquet")
    kept = {r.doc_id for r in quality.judge(documents(spark, rows), labels).filter("kept").collect()}
    left = [(i, t) for i, t in rows if i in kept]
    assert 0 < len(left) < len(rows)
    left = [(i, t) for i, _, n, t in brute_lines(left) if n == 0 or t.split()]
    first = set(brute_kept(left))
    assert len(first) < len(left)
    left = [(i, t) for i, t in left if i in first]
    leaks = {i for i, _, hit, _ in brute_leaks(left, items) if hit}
    assert leaks
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = []
    for i, t in left:
        if i not in leaks:
            ids = library.encode(t)
            sums = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
            want.append((i, len(ids), *sums))
    got = corpus_pipeline.run(spark, home).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_near_copies_are_linked_by_simhash_and_by_shingles(spark):
    """5 and 3 are mostly one passage and have one fingerprint, their shingle sets are far apart; 5 and 1 have one set, not one fingerprint."""
    passage = " ".join(f"w{i}" for i in range(9))

    def text(times, n):
        return " ".join([passage] * times + [f"t{n}x{i}" for i in range(40)])

    rows = [(5, text(60, 1)), (3, text(60, 2)), (1, text(2, 1)), (7, text(0, 3))]
    assert brute_kept(rows) == [1, 3, 7]
    kept = corpus_pipeline.near_copies(spark, documents(spark, rows), "").collect()
    assert sorted(r.doc_id for r in kept) == [1, 7]


def test_every_stage_takes_an_empty_table(spark, sf):
    home, rows, _ = sf
    docs = documents(spark, rows[:3]).limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, home)
        assert out.columns == docs.columns and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, home).count() == 0


def test_every_operator_has_a_query():
    assert [name.split("_")[0] for name in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(queries.ORACLES) <= set(queries.QUERIES)
