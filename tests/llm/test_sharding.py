import hashlib
from collections import Counter

import pytest

from storelens.llm import queries, sharding
from storelens.operators.staging import staging_path
from tests.llm.common import EDGES, documents


def number(name):
    return int(hashlib.md5(name.encode()).hexdigest()[:15], 16)


def brute_table(shards, slots):
    orders = [
        [(number(f"offset|{s}") + j * (number(f"skip|{s}") % (slots - 1) + 1)) % slots for j in range(slots)] for s in shards
    ]
    assert all(len(set(o)) == slots for o in orders)
    table = {}
    while len(table) < slots:
        for i, order in enumerate(orders):
            if len(table) < slots:
                table[next(x for x in order if x not in table)] = i
    return [table[x] for x in range(slots)]


def test_table_matches_brute_force():
    for n, slots in ((1, 7), (3, 101), (7, 211), (16, 1009)):
        names = sharding.shard_names(n)
        table = sharding.fill_table(names, slots)
        assert table == brute_table(names, slots)
        sizes = Counter(table).values()
        assert max(sizes) - min(sizes) <= 1


def test_few_slots_move_when_a_shard_goes():
    names = sharding.shard_names(32)
    before = [names[i] for i in sharding.fill_table(names)]
    after = [n for n in names if n != names[7]]
    now = [after[i] for i in sharding.fill_table(after)]
    moved = sum(a != b for a, b in zip(before, now) if a != names[7])
    assert moved < 0.25 * len(before)


def test_bad_tables_are_refused():
    for shards, slots in (([], 7), (["a", "a"], 7), (["a"], 8), (sharding.shard_names(9), 7)):
        with pytest.raises(ValueError):
            sharding.fill_table(shards, slots)


def test_placement(spark):
    docs = documents(spark, EDGES + [(i, "t") for i in range(100, 2100)]).selectExpr("*", "1 as slot", "'x' as shard")
    names = sharding.shard_names(10)
    table = sharding.fill_table(names, 1009)
    got = sharding.assign_shards(docs, names, 1009).collect()
    assert len(got) == len(EDGES) + 2000
    for r in got:
        slot = number("" if r.doc_id is None else str(r.doc_id)) % 1009
        assert (r.slot, r.shard) == (slot, names[table[slot]])
    sizes = Counter(r.shard for r in got).values()
    mean = len(got) / 10
    assert all(0.7 * mean < n < 1.3 * mean for n in sizes)
    assert sharding.assign_shards(docs.limit(0)).count() == 0


def test_written_shards_hold_all_rows(spark):
    docs = documents(spark, EDGES + [(i, "t") for i in range(100, 400)])
    path = staging_path(spark, "shards")
    sharding.write_shards(docs, path, sharding.shard_names(5), 101, rows_per_file=50)
    back = spark.read.parquet(path)
    assert back.count() == docs.count()
    assert {r.shard for r in back.select("shard").distinct().collect()} == set(sharding.shard_names(5))


def test_the_query_writes_whole_documents_on_their_shards(spark, tmp_path, monkeypatch):
    docs = documents(spark, EDGES + [(i, "t") for i in range(100, 300)])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries, "staging_path", lambda *_: f"{tmp_path}/out")
    got = queries.op7_sharding(spark, str(tmp_path)).collect()
    want = sharding.assign_shards(docs).select("doc_id", "slot", "shard").collect()
    assert sorted(map(str, got)) == sorted(map(str, want))
    back = spark.read.parquet(f"{tmp_path}/out").select(*docs.columns, "shard")
    placed = sharding.assign_shards(docs).select(*docs.columns, "shard")
    assert sorted(map(str, back.collect())) == sorted(map(str, placed.collect()))
