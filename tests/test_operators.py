"""Building blocks against brute force on small random and skewed inputs."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta, timezone
from pathlib import Path
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pytest
from pyspark.sql import Window as W, functions as F

from storelens.functions.timewin import local_midnight, window_bounds
from storelens.operators import joins, staging
from storelens.operators.ids import dense_ids
from storelens.operators.joins import both_ways, overlap_pairs, salted_join
from storelens.operators.ranking import give_to_all, global_topn, ntiles, pivot_slots, topk_per_key
from storelens.operators.sessions import sessionize

UTC = timezone.utc
AS_OF = datetime(2024, 1, 31, tzinfo=UTC)


def test_window_bounds_are_local_days():
    midnight = datetime(2024, 1, 30, 15, tzinfo=UTC)
    assert local_midnight(AS_OF) == midnight
    assert window_bounds("-30d", AS_OF) == (midnight - timedelta(days=30), midnight)
    assert window_bounds("-3d/now", AS_OF) == (midnight - timedelta(days=3), AS_OF)
    assert window_bounds("0d/now", AS_OF) == (midnight, AS_OF)
    with pytest.raises(ValueError):
        window_bounds("3h", AS_OF)


def test_window_bounds_follow_daylight_saving():
    start, end = window_bounds("-1d", datetime(2024, 3, 11, 12, tzinfo=UTC), "America/New_York")
    assert end - start == timedelta(hours=23)


def pairs_by_hand(rows, low):
    groups = defaultdict(set)
    for e, v in rows:
        groups[v].add(e)
    count = defaultdict(int)
    for members in groups.values():
        for a in members:
            for b in members:
                if a < b:
                    count[a, b] += 1
    return {p: n for p, n in count.items() if n >= low}


@pytest.mark.parametrize("low", [1, 2, 3, 5])
@pytest.mark.parametrize("slice_size", [3, 2_000])
def test_overlap_pairs_equal_brute_force(spark, monkeypatch, low, slice_size):
    """With a small slice size nearly all groups take the way of heavy groups."""
    monkeypatch.setattr(joins, "GROUP_SLICE", slice_size)
    rng = random.Random(low)
    rows = [(f"p{rng.randrange(25)}", f"k{rng.randrange(30)}") for _ in range(350)]
    rows += [(f"p{i}", "hot1") for i in range(25)] + [(f"p{i}", "hot2") for i in range(0, 25, 2)]
    got = overlap_pairs(spark.createDataFrame(rows, "e string, v string"), "e", "v", low)
    result = {tuple(sorted((r.a, r.b))): r.overlap for r in got.collect()}
    assert got.count() == len(result)
    assert result == pairs_by_hand(set(rows), low)


def test_overlap_pairs_of_a_hot_group_stay_few(spark):
    """20,000 entities meet in one group; only the pair that shares a second one passes."""
    rows = spark.range(20_000).select(
        F.concat(F.lit("p"), "id").alias("e"), F.lit("hot").alias("v")
    )
    extra = spark.createDataFrame([("p1", "x"), ("p2", "x"), ("p3", "y")], "e string, v string")
    got = overlap_pairs(rows.unionByName(extra), "e", "v", 2).collect()
    assert [(*sorted((r.a, r.b)), r.overlap) for r in got] == [("p1", "p2", 2)]


def test_both_ways(spark):
    df = spark.createDataFrame([("a", "b", 3)], "a string, b string, n int")
    assert sorted(map(tuple, both_ways(df, "x", "y").collect())) == [("a", "b", 3), ("b", "a", 3)]


def test_salted_join_is_an_inner_join(spark):
    big = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    small = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c"), (7, "d")], "k long, s string")
    got = sorted(map(tuple, salted_join(big, small, "k", "id").collect()))
    assert got == sorted(map(tuple, big.join(small, "k").collect()))


def ntile_by_hand(n, tiles):
    q, r = divmod(n, tiles)
    return [t + 1 for t in range(tiles) for _ in range(q + (t < r))]


@pytest.mark.parametrize("n", [3, 23, 500])
def test_ntiles_with_heavy_ties(spark, n):
    import hashlib

    rng = random.Random(n)
    values = {f"m{i}": rng.choice([1.0, 1.0, 1.0, 2.0, rng.random()]) for i in range(n)}
    df = spark.createDataFrame(list(values.items()), "k string, x double")
    got = {r.k: (r.up, r.down) for r in ntiles(df, "k", {"up": F.col("x"), "down": -F.col("x")}).collect()}

    def expected(sign):
        order = sorted(values, key=lambda k: (sign * values[k], hashlib.md5(k.encode()).hexdigest()))
        return dict(zip(order, ntile_by_hand(n, 5)))

    up, down = expected(1), expected(-1)
    assert got == {k: (up[k], down[k]) for k in values}


def test_topk_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), "id")
    top = topk_per_key(df, ["k"], [F.desc("id")], 2)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.k, r.id, r.rank_in_logic) for r in top.collect()) == [
        (0, 96, 2), (0, 98, 1), (1, 97, 2), (1, 99, 1),
    ]


def test_global_topn_and_give_to_all(spark):
    top = global_topn(spark.range(50), [F.desc("id")], 2)
    keys = spark.createDataFrame([("x",), ("y",)], "key_value string")
    out = give_to_all(keys, top.select("rank_in_logic", "id"))
    assert sorted(map(tuple, out.collect())) == [
        ("x", 1, 49), ("x", 2, 48), ("y", 1, 49), ("y", 2, 48),
    ]
    assert give_to_all(keys, top.filter("id < 0")).count() == 0


def test_pivot_slots(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z")], "k string, n int, v string")
    assert pivot_slots(df, "k", "n", {"v": "v{n}"}).first().asDict() == {
        "k": "a", "v1": "x", "v2": None, "v3": "z", "v4": None,
    }


def test_dense_ids(spark):
    ids = dense_ids(spark.createDataFrame([("a",), ("b",), ("a",), ("c",)], "k string"), "k", "i")
    assert sorted(r.i for r in ids.collect()) == [0, 1, 2]


def sessions_by_hand(rows, gap):
    out = {}
    by_key = defaultdict(list)
    for key, t, no, user in rows:
        by_key[key].append((t, no, user))
    for key, events in by_key.items():
        events.sort()
        groups, last = [], None
        for e in events:
            if last is None or e[0] - last > gap:
                groups.append([])
            groups[-1].append(e)
            last = e[0]
        for g in groups:
            best = max((u for _, _, u in g if u is not None), default=None)
            for i, (t, no, user) in enumerate(g):
                nxt = g[i + 1][0] - t if i + 1 < len(g) else None
                out[no] = (g[0][0], g[-1][0], i + 1, nxt, best if user is None else user)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_sessionize_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    base = 1_700_000_000
    rows = [
        ("hot" if rng.random() < 0.5 else f"c{rng.randrange(4)}", base + rng.randrange(90_000), i,
         rng.choice([None, None, "u1", "u2"]))
        for i in range(300)
    ]
    # pauses of exactly the gap and one second more, and equal times
    rows += [("edge", base, 900, None), ("edge", base + 1800, 901, "e"), ("edge", base + 3601, 902, None)]
    rows += [("edge", base + 3601, 903, None)]
    df = spark.createDataFrame(rows, "cookie string, t long, no int, user_id string").withColumn(
        "ts", F.timestamp_seconds("t")
    )
    got = {
        r.no: (r.session_start, r.session_end, r.session_num, r.browsing_sec, r.user_id_comp)
        for r in sessionize(df, "cookie", 1800, ["no"], fill="user_id").collect()
    }
    assert got == sessions_by_hand(rows, 1800)


def test_staged_tables_lie_in_the_shared_folder_and_are_removed(spark):
    rows = staging.stage(spark.range(10))
    path = rows.inputFiles()[0]
    assert staging.checkpoint_home(spark).split(":")[-1].lstrip("/") in path
    assert rows.count() == 10
    folder = Path(unquote(urlparse(path).path)).parent
    assert folder.is_dir() and staging.drop_staged(spark) >= 1 and not folder.exists()
    assert staging.drop_staged(spark) == 0


def test_salts_follow_the_largest_key(spark, monkeypatch):
    monkeypatch.setattr(joins, "SALT_ROWS", 100)
    big = spark.range(900).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    assert joins.salts_for(big, "k") == 3 and joins.salts_for(big.limit(0), "k") == 1
    small = spark.createDataFrame([("hot", 1), ("1", 2)], "k string, v int")
    spread = joins.salted_join(big, small, "k", "id", salts=None)
    assert spread.count() == 301
    assert joins.salted_join(big, small, "k", "id", salts=None, how="left_anti").count() == 599
    left = joins.salted_join(big, small, "k", "id", salts=None, how="left")
    assert left.count() == 900 and left.filter("v is not null").count() == 301


def test_ntiles_number_missing_values_last(spark):
    rows = spark.createDataFrame([("a", 1.0), ("b", None), (None, 2.0), ("d", 3.0), ("e", None)], "k string, x double")
    got = {r.k: r.t for r in ntiles(rows, "k", {"t": F.col("x")}, 5).collect()}
    assert (got["a"], got[None], got["d"]) == (1, 2, 3) and {got["b"], got["e"]} == {4, 5}


@pytest.mark.parametrize("salts", [1, 16, None])
def test_the_repeated_side_of_a_salted_join_is_not_broadcast(spark, salts):
    big, small = spark.range(500).selectExpr("id % 7 as k", "id"), spark.range(7).selectExpr("id as k", "id * 2 as v")
    joined = salted_join(big, small, "k", "id", salts)
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert sorted((r.k, r.id, r.v) for r in joined.collect()) == sorted((i % 7, i, i % 7 * 2) for i in range(500))


@pytest.mark.parametrize("slice_size", [3, 2_000])
def test_pairs_of_members_with_many_partners_are_counted_in_parts(spark, monkeypatch, slice_size):
    """A member with many partners is divided by residues of them, and tasks follow the number of pairs."""
    monkeypatch.setattr(joins, "GROUP_SLICE", slice_size)
    monkeypatch.setattr(joins, "PART_PAIRS", 7)
    rng = random.Random(3)
    rows = [(rng.randrange(30), f"v{rng.randrange(12)}") for _ in range(150)]
    rows += [(0, f"v{i}") for i in range(12)]
    slices = F.ceil(F.count("*").over(W.partitionBy("v")) / F.lit(slice_size)).cast("int")
    kept = spark.createDataFrame(sorted(set(rows)), "e long, v string").withColumn("slices", slices)
    counted = joins._pairs_of(kept)
    assert {(r.a, r.b): r.n for r in counted.collect()} == pairs_by_hand(set(rows), 1)
    assert counted.select(F.spark_partition_id()).distinct().count() > 8


@pytest.mark.parametrize("shift", [0, 1 << 40, 1 << 62])
@pytest.mark.parametrize("least", [1, 3])
def test_pairs_are_tallied_by_sorted_numbers(shift, least):
    rng = random.Random(least)
    rows = [(rng.randrange(5) + shift, [rng.randrange(9) + shift for _ in range(rng.randrange(6))]) for _ in range(60)]
    batches = [
        pa.RecordBatch.from_pydict({"a": [a for a, _ in part], "rest": pa.array([b for _, b in part], pa.list_(pa.int64()))})
        for part in (rows[:25], rows[25:26], rows[26:])
    ]
    counts = Counter((a, b) for a, rest in rows for b in rest)
    (got,) = joins._tallies(least)(iter(batches))
    assert {(r["a"], r["b"]): r["n"] for r in got.to_pylist()} == {p: n for p, n in counts.items() if n >= least}
    assert list(joins._tallies(least)(iter([]))) == []


@pytest.mark.parametrize("step", [3, 1 << 20, 1 << 45])
def test_partners_travel_as_short_steps(step):
    rng = random.Random(step)
    rows = []
    for _ in range(50):
        a, *rest = sorted(rng.sample(range(step * 40), rng.randrange(1, 30)))
        rows.append((a, rest))
    full = {"a": [a for a, _ in rows], "rest": pa.array([b for _, b in rows], pa.list_(pa.int64()))}
    batch = pa.RecordBatch.from_pydict(full)
    packed = list(joins._packed(iter([batch.slice(0, 20), batch.slice(20, 0), batch.slice(20)])))
    back = pa.Table.from_batches(joins._unpacked(iter([packed[0].slice(0, 7), packed[0].slice(7), *packed[1:]])))
    assert back.to_pydict() == {"a": full["a"], "rest": [b for _, b in rows]}
    # the partners of two residues, then of three
    for residues in (2, 3):
        parts = [x.append_column("residues", pa.array([residues] * len(x))) for x in packed if len(x)]
        got = pa.Table.from_batches(joins._divided(iter(parts)))
        lists = pa.Table.from_batches(joins._unpacked(iter(got.select(["a", "rest"]).to_batches())))["rest"].to_pylist()
        assert sorted(zip(got["a"].to_pylist(), got["residue"].to_pylist(), lists)) == sorted(
            (a, r, own) for a, b in rows for r in range(residues) if (own := [x for x in b if x % residues == r])
        )


def test_partners_take_few_bytes_in_the_shuffle(spark, monkeypatch):
    """Lists are bytes before they are dealt to tasks, one for a partner that is less than 128 numbers on."""
    dealt, listed = [], joins._partners
    monkeypatch.setattr(joins, "_partners", lambda *a: dealt.append(listed(*a)) or dealt[0])
    kept = spark.range(40).selectExpr("id as e", "'v' as v", "1 as slices")
    assert joins._pairs_of(kept).count() == 780
    assert {r.a: len(r.rest) for r in dealt[0].collect()} == {a: 39 - a for a in range(39)}


def test_groups_are_dealt_to_tasks_by_their_pairs(spark, monkeypatch):
    """One small file of groups is not listed by one task, and pairs below the least count do not leave theirs."""
    monkeypatch.setattr(joins, "PART_PAIRS", 32)
    rows = [(e, f"v{v}") for v in range(64) for e in range(v % 8, v % 8 + 6)] + [(100, "v0")]
    kept = spark.createDataFrame(rows, "e long, v string").coalesce(1).withColumn("slices", F.lit(1))
    dealt = []
    listed = joins._partners
    monkeypatch.setattr(joins, "_partners", lambda *a: dealt.append(listed(*a)) or dealt[0])
    counted = joins._pairs_of(kept, 2)
    assert {(r.a, r.b): r.n for r in counted.collect()} == pairs_by_hand(set(rows), 2)
    assert dealt[0].rdd.getNumPartitions() >= 4
    assert "HashAggregate" not in counted._jdf.queryExecution().executedPlan().toString()
