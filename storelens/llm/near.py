"""Near copies by the Jaccard similarity of word shingles: MinHash bands propose pairs, the sets decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from storelens.llm.components import components
from storelens.llm.words import WHITE, hashes, mix, pieces, spans, windows
from storelens.llm.workers import map_batches
from storelens.operators.shipping import ship
from storelens.operators.staging import stage

#: words in a shingle, similarity that still links, as a fraction
SHINGLE, SIMILARITY = 5, (4, 5)
#: a pair of similarity s shares none of the bands with probability (1 - s**WIDTH)**BANDS, 3e-6 at 0.8
BANDS, WIDTH = 32, 5
#: pairs whose sketches of one bit a minimum differ in more bits are not compared: at 0.8 they differ in 16 +- 3.8
DIFFER = 40
#: members of a bucket that all others are compared with in the second round, and how this number grows from round to round
PIVOTS, GROWTH = 8, 4
#: parts of a key that many rows share, and members of a bucket in one part
SPREAD, PART = 8, 256
#: shingles of a part or block of a bucket, unless one set has more; columns of a matrix that counts common shingles
SHINGLES, COLUMNS = 1 << 20, 1 << 13
#: rows of two hashes that are broadcast at most; more of them are joined by shuffling
BROADCAST_ROWS = 1 << 19
#: links whose components one task finds; more of them take rounds of joins
ONE_TASK_LINKS = 1 << 20

FACTORS = np.random.default_rng(42).integers(0, 2**63, BANDS * WIDTH, np.uint64) * np.uint64(2) + np.uint64(1)
BAND_SEEDS = mix(np.arange(1, BANDS + 1, dtype=np.uint64) << np.uint64(32))
SKETCH = -(-BANDS * WIDTH // 64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of many texts, sorted within each text, and where each text's begin (one more at the end).

    A text with fewer than ``k`` words has one shingle of all of them, one without words none.
    """
    starts, ends, begin = spans(data, offsets, WHITE)
    h = hashes(data, starts, ends)
    sizes = np.diff(begin)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    values = windows(h, k)
    whole = owner[: len(values)] == owner[k - 1 :] if len(values) else np.empty(0, bool)
    values, owner = values[whole], owner[: len(values)][whole]
    few = np.flatnonzero((sizes > 0) & (sizes < k))
    values = np.concatenate([values, *(windows(h[begin[i] : begin[i + 1]], sizes[i]) for i in few)])
    owner = np.concatenate([owner, few])
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    if len(values):
        new = np.concatenate([[True], (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])])
        values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(len(sizes) + 1))


def sketch(values: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digest, band keys and bits of each set; sets without members have digest zero and equal keys."""
    sizes = np.diff(begin)
    full = np.flatnonzero(sizes)
    digest = np.zeros(len(sizes), np.uint64)
    keys = np.zeros((len(sizes), BANDS), np.uint64)
    bits = np.zeros((len(sizes), SKETCH * 64), np.uint8)
    if len(full):
        at = begin[:-1][full]
        digest[full] = mix(np.add.reduceat(mix(values), at) + sizes[full].astype(np.uint64))
        for j, factor in enumerate(FACTORS):
            least = mix(np.minimum.reduceat(values * factor, at))
            bits[full, j] = (least & np.uint64(1)).astype(np.uint8)
            band = j // WIDTH
            keys[full, band] = mix((keys[full, band] if j % WIDTH else BAND_SEEDS[band]) + least)
    return digest, keys, np.packbits(bits, axis=1, bitorder="little").view("<i8")


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, data, offsets in pieces(batch.column("text")):
            values, begin = shingle_sets(data, offsets)
            digest, keys, bits = sketch(values, begin)
            rows = batch.slice(first, len(digest))
            ends = np.arange(len(digest) + 1, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("id_hash"),
                    rows.column("text_hash"),
                    rows.column("doc_id"),
                    pa.array(digest.view(np.int64)),
                    pa.array(np.diff(begin).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends * SKETCH), pa.array(bits.ravel())),
                    pa.ListArray.from_arrays(pa.array(ends * BANDS), pa.array(keys.view(np.int64).ravel())),
                ],
                ["id_hash", "text_hash", "doc_id", "fp", "n", "bits", "keys"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, data, offsets in pieces(batch.column("text")):
            values, begin = shingle_sets(data, offsets)
            found = [values[a:b].astype("<u8").tobytes() for a, b in zip(begin[:-1], begin[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("fp").slice(first, len(found)), pa.array(found, pa.binary())], ["fp", "members"]
            )


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    over, under = SIMILARITY
    for batch in batches:
        keep = []
        for a, b in zip(batch.column("a"), batch.column("b")):
            a, b = (np.frombuffer(x.as_buffer(), "<u8") for x in (a, b))
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(under * both >= over * (len(a) + len(b) - both))
        yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))


def _salted(many: DataFrame, few: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """``many`` joined with the one row that ``few`` has for each ``on``; rows that share a key are spread by their ``fp``."""
    parts = F.sequence(F.lit(0), F.lit(SPREAD - 1))
    spread = many.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SPREAD)).cast("int"))
    return spread.join(few.withColumn("salt", F.explode(parts)), [on, "salt"], how).drop("salt")


def _if_few(rows: DataFrame) -> DataFrame:
    """Staged rows of a few hashes, marked for broadcasting if their number allows it."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(node, root)`` of all links, which are in one task and at most ``ONE_TASK_LINKS``."""
    links = pa.Table.from_batches(list(batches), schema=pa.schema([("u", pa.int64()), ("v", pa.int64())]))
    nodes, places = np.unique(np.concatenate([links["u"].to_numpy(), links["v"].to_numpy()]), return_inverse=True)
    a, b = places[: len(links)], places[len(links) :]
    least = np.arange(len(nodes))
    while True:
        before = least.copy()
        low = np.minimum(least[a], least[b])
        np.minimum.at(least, least[a], low)
        np.minimum.at(least, least[b], low)
        while (least[least] != least).any():
            least = least[least]
        if (least == before).all():
            break
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[least])], ["node", "root"])


def _components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of staged ``links(u, v)``."""
    if links.count() > ONE_TASK_LINKS:
        return components(links)
    return map_batches(links.coalesce(1), _groups, "node bigint, root bigint")


def _met(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Those of the ``pairs(u, v)`` whose sizes and sketches let them be alike. A ``v`` stands in many pairs, a ``u`` in few."""
    over, under = SIMILARITY
    differing = sum(
        (F.bit_count(F.get("u_bits", F.lit(i)).bitwiseXOR(F.get("v_bits", F.lit(i)))) for i in range(SKETCH)), F.lit(0)
    )
    left, right = (sketches.select(*[F.col(c).alias(f"{x}_{c}" if c != "fp" else x) for c in ("fp", "n", "bits")]) for x in "uv")
    spread = pairs.select("v", F.col("u").alias("fp"))
    met = _salted(spread, right, "v").withColumnRenamed("fp", "u").join(left, "u")
    met = met.filter((F.least("u_n", "v_n") * under >= F.greatest("u_n", "v_n") * over) & (differing <= DIFFER))
    return met.select("u", "v")


def _values(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All members of several sets, and the number of the set of each."""
    sets = [np.frombuffer(x.as_buffer(), "<u8") for x in column]
    return np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])


def _shared(ours: pa.ChunkedArray, theirs: pa.ChunkedArray) -> np.ndarray:
    """How many members each of our sets has in common with each of theirs: products of 0-1 matrices."""
    (a, of_a), (b, of_b) = _values(ours), _values(theirs)
    both = np.intersect1d(a, b)
    counts = np.zeros((len(ours), len(theirs)))
    if not len(both):
        return counts
    at_a, at_b = np.searchsorted(both, a), np.searchsorted(both, b)
    in_a, in_b = (both[np.minimum(at, len(both) - 1)] == x for at, x in ((at_a, a), (at_b, b)))
    at_a, of_a, at_b, of_b = at_a[in_a], of_a[in_a], at_b[in_b], of_b[in_b]
    order_a, order_b = np.argsort(at_a, kind="stable"), np.argsort(at_b, kind="stable")
    at_a, of_a, at_b, of_b = at_a[order_a], of_a[order_a], at_b[order_b], of_b[order_b]
    for low in range(0, len(both), COLUMNS):
        width = min(COLUMNS, len(both) - low)
        parts = []
        for at, of, n in ((at_a, of_a, len(ours)), (at_b, of_b, len(theirs))):
            i, j = np.searchsorted(at, (low, low + width))
            part = np.zeros((n, width), np.float32)
            part[of[i:j], at[i:j] - low] = 1
            parts.append(part)
        counts += parts[0] @ parts[1].T
    return counts


def _block_links(members: pa.Table, pivots: pa.Table) -> pa.Table:
    """Members of a part of a bucket and pivots that are alike, one link for each component that a member meets."""
    members, pivots = (t.rename_columns([c[2:] for c in t.column_names]) for t in (members, pivots))
    u, v = np.empty(0, np.int64), np.empty(0, np.int64)
    if len(members) and len(pivots):
        over, under = SIMILARITY
        n, m = (t["n"].to_numpy().astype(np.int64) for t in (members, pivots))
        fp, p_fp, root, p_root = (t[c].to_numpy() for c in ("fp", "root") for t in (members, pivots))
        wanted = (p_root[None, :] != root[:, None]) & (p_fp[None, :] < fp[:, None])
        wanted &= np.minimum.outer(n, m) * under >= np.maximum.outer(n, m) * over
        rows, columns = wanted.any(axis=1), wanted.any(axis=0)
        if rows.any():
            i, j = np.flatnonzero(rows), np.flatnonzero(columns)
            both = _shared(members["members"].take(pa.array(i)), pivots["members"].take(pa.array(j)))
            alike = wanted[np.ix_(i, j)] & (under * both >= over * (n[i][:, None] + m[j][None, :] - both))
            x, y = np.nonzero(alike)
            # a member's first pivot of each component
            _, once = np.unique(np.stack([x, p_root[j[y]]]), axis=1, return_index=True)
            u, v = fp[i[x[once]]], p_fp[j[y[once]]]
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _pivot_links(members: DataFrame, pivots: DataFrame, sets: DataFrame) -> DataFrame:
    """``(u, v)``: members and pivots ``v`` of their buckets that lie in another component and are alike.

    A group is a part of a bucket's members and a block of its pivots, both of at most ``PART`` sets and about ``SHINGLES`` shingles. All its
    pairs are compared at once, by the sets themselves; only links become rows. A bucket's members and pivots are sent once for each
    block or part of the others.
    """
    before = Window.partitionBy("key").orderBy("fp").rowsBetween(Window.unboundedPreceding, -1)
    size = F.coalesce(F.sum("n").over(before), F.lit(0)) / SHINGLES
    placed = stage(pivots.withColumn("block", F.floor(F.floor((F.col("place") - 1) / PART) + F.floor(size)).cast("int")))
    blocks = stage(placed.groupBy("key").agg(F.max("block").alias("last")))
    parted = members.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    ours = _salted(parted, blocks, "key").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("last"))))
    theirs = placed.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    columns = ["key", "part", "block", "fp", "root", "n", "members"]
    ours, theirs = (
        t.join(sets.select(F.col("fp"), F.col("members").alias(f"{side}_members")), "fp")
        .select(*[F.col(f"{side}_members" if c == "members" else c).alias(f"{side}_{c}") for c in columns])
        .groupBy(*[f"{side}_{c}" for c in columns[:3]])
        for side, t in (("u", ours), ("v", theirs))
    )
    ship(members.sparkSession)
    return stage(ours.cogroup(theirs).applyInArrow(_block_links, "u bigint, v bigint").distinct())


def _linked(met: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the staged pairs ``met(u, v)`` whose sets are alike."""
    theirs = sets.join(met.select(F.col("v").alias("fp")).distinct(), "fp", "left_semi")
    own = met.join(sets.select(F.col("fp").alias("u"), F.col("members").alias("a")), "u")
    both = _salted(own.withColumnRenamed("u", "fp"), theirs.select(F.col("fp").alias("v"), F.col("members").alias("b")), "v")
    return stage(map_batches(both.select(F.col("fp").alias("u"), "v", "a", "b"), _alike, "u bigint, v bigint"))


def _open(members: DataFrame) -> DataFrame:
    """Members of the buckets that do not lie in one component, with the number of parts of their bucket."""
    split = members.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("met"), F.sum("n").alias("size"))
    parts = F.ceil(F.col("met") / PART) + F.floor(F.col("size") / SHINGLES)
    split = split.filter("low < high").select("key", parts.cast("int").alias("parts"))
    return stage(_salted(members.drop("parts"), stage(split), "key"))


def _roots(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """``(fp, root)`` of the nodes that share a bucket with another one.

    Nodes meet in buckets of equal band keys. In a round each bucket's smallest members (its pivots) are compared
    with all its others that lie in another component, and leave it; a bucket is done when the rest of it lies in one component. So a
    group of near copies costs a few rows per member and band, not one per pair, and no pair that
    could join two components is left out. The rounds end when all buckets are done; a bucket of unlike members
    takes as many as the logarithm of its size. Components are found over the roots that a round links.
    """
    rows = nodes.select(F.explode("keys").alias("key"), "fp")
    shared = rows.groupBy("key").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low < high")
    members = stage(_salted(rows, stage(shared.select("key", "low")), "key"))
    chosen = nodes.join(members.select("fp").distinct(), "fp", "left_semi")
    chosen = stage(chosen.select("fp", "n", "bits", F.col("first.id_hash").alias("id_hash"), F.col("first.text_hash").alias("text_hash")))
    texts = _keyed(docs).join(_if_few(chosen.select("id_hash", "text_hash", "fp")), ["id_hash", "text_hash"])
    sets = stage(map_batches(texts.select("fp", "text"), _sets, "fp bigint, members binary").dropDuplicates(["fp"]))
    roots = chosen.select("fp", F.col("fp").alias("root"), "n")
    pairs = stage(members.filter("fp > low").select(F.col("fp").alias("u"), F.col("low").alias("v")).distinct())
    links = _linked(stage(_met(pairs, chosen)), sets)
    members = members.filter("fp > low").drop("low")
    many = PIVOTS
    while True:
        at_root = links.join(roots.select(F.col("fp").alias("u"), F.col("root").alias("a")), "u")
        at_root = at_root.join(roots.select(F.col("fp").alias("v"), F.col("root").alias("b")), "v")
        new = stage(at_root.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u <> v").distinct())
        joined = stage(_components(new).toDF("root", "least"))
        roots = stage(roots.join(joined, "root", "left").select("fp", F.coalesce("least", "root").alias("root"), "n"))
        members = _open(members.drop("root", "n").join(roots, "fp"))
        if not members.limit(1).count():
            return roots.drop("n")
        place = F.row_number().over(Window.partitionBy("key").orderBy("fp"))
        pivots = stage(members.withColumn("place", place).filter(F.col("place") <= many))
        links = _pivot_links(members, pivots, sets)
        done = pivots.groupBy("key").agg(F.max("fp").alias("last"))
        members = _salted(members, done, "key").filter("fp > last").drop("last")
        many *= GROWTH


def _keyed(docs: DataFrame) -> DataFrame:
    """The texts with hashes of id and text, which stand for a row in all tables but ``docs``."""
    id_hash = F.xxhash64(F.col("doc_id").isNull(), F.col("doc_id"))
    return docs.select(id_hash.alias("id_hash"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "doc_id", "text")


def _merged(rooted: DataFrame, prints: DataFrame, groups: DataFrame) -> DataFrame:
    """``rooted(fp, first, root)`` with one root for all components that a group of texts ``groups(text_hash, group)`` meets."""
    texts = prints.select("text_hash", "fp").distinct().join(groups, "text_hash")
    met = stage(texts.join(rooted.select("fp", "root"), "fp").select("group", F.col("root").alias("fp")).distinct())
    least = met.groupBy("group").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low < high")
    links = _salted(met, stage(least.select("group", "low")), "group").filter("fp > low")
    joined = _components(stage(links.select(F.col("fp").alias("u"), F.col("low").alias("v")).distinct())).toDF("root", "least")
    return _salted(rooted, stage(joined), "root", "left").select("fp", "first", F.coalesce("least", "root").alias("root"))


def drop_near_copies(docs: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Documents are linked where the sets of their runs of five lower-cased words have a Jaccard similarity of 0.8 or
    more; texts without words are alike. Texts (by their hash) that have one group in ``groups(text_hash, group)`` are linked too.
    All columns of ``docs`` stay. A null id
    comes after all others; ties of the id are broken by the text, and of rows with the same id and text one stays.
    Texts are read to make the sketches, to make the sets of those that share a bucket, and to drop the copies; they
    are shuffled only where the rows they are looked up in are more than ``BROADCAST_ROWS``.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"id_hash bigint, text_hash bigint, doc_id {id_type}, fp bigint, n bigint, bits array<bigint>, keys array<bigint>"
    prints = stage(map_batches(_keyed(docs), _sketched, schema), compression="zstd")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "id_hash")
    # equal sets have equal sketches
    nodes = prints.groupBy("fp").agg(F.min(row).alias("first"), *[F.first(c).alias(c) for c in ("n", "bits", "keys")])
    nodes = stage(nodes, compression="zstd")
    roots = _roots(nodes, docs)
    rooted = nodes.select("fp", "first").join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    if groups is not None:
        rooted = stage(_merged(stage(rooted), prints, groups))
    least = stage(rooted.groupBy("root").agg(F.min("first").alias("best")))
    best = _salted(rooted, least, "root").select("fp", "best")
    told = _salted(prints.select("fp", "id_hash", "text_hash"), stage(best), "fp")
    is_best = (F.col("id_hash") == F.col("best.id_hash")) & (F.col("text_hash") == F.col("best.text_hash"))
    gone = stage(told.filter(~is_best).select("id_hash", "text_hash").distinct())
    twice = prints.groupBy("id_hash", "text_hash").count().filter("count > 1").select("id_hash", "text_hash")
    # names that are not in use
    one, two = (next(n for n in (f"{name}{k}" for k in range(len(docs.columns) + 1)) if n not in docs.columns) for name in ("_id", "_text"))
    marked = docs.withColumns({one: F.xxhash64(F.col("doc_id").isNull(), F.col("doc_id")), two: F.xxhash64(F.coalesce("text", F.lit("")))})

    def meets(rows: DataFrame):
        return (F.col(one) == rows["id_hash"]) & (F.col(two) == rows["text_hash"])

    out = _if_few(gone)
    kept = marked.join(out, meets(out), "left_anti")
    again = stage(twice)
    if again.limit(1).count():  # rows with the same id and text
        again = _if_few(again)
        repeated = kept.join(again, meets(again), "left_semi").dropDuplicates([one, two])
        kept = kept.join(again, meets(again), "left_anti").union(repeated)
    return kept.drop(one, two)
