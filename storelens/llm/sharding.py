"""Placement of documents on shards by a permutation-filled lookup table. DataFrame functions only."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

#: default shards, and slots of the table: a prime of at least a hundred slots a shard
SHARDS, SLOTS = 64, 8191
#: hex digits of the digest that are read as a number; 15 fit in a signed 64-bit value
DIGITS = 15


def _number(name: str) -> int:
    return int(hashlib.md5(name.encode()).hexdigest()[:DIGITS], 16)


def fill_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard number of each slot.

    Each shard prefers the slots in the order ``offset, offset + skip, ...``
    modulo the prime ``slots``, which visits all of them. Shards take turns; in
    its turn a shard claims the first slot of its order that is still free. Shards get
    ``slots / len(shards)`` slots each, give or take one, and a change of the list
    of shards moves few slots of the others. The work depends on ``slots`` alone.
    """
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards need different names")
    if slots < len(shards) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots is a prime, and not below the number of shards")
    at = [_number(f"offset|{s}") % slots for s in shards]
    skip = [_number(f"skip|{s}") % (slots - 1) + 1 for s in shards]
    table = [-1] * slots
    left = slots
    while left:
        for i in range(min(len(shards), left)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % slots
            table[at[i]] = i
            left -= 1
    return table


def lookup(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """``(slot, shard)``: the table as a DataFrame of ``slots`` rows, with the shards' names."""
    numbers = F.split(F.lit(",".join(map(str, fill_table(shards, slots)))), ",")
    names = F.array(*[F.lit(s) for s in shards])
    return (
        spark.range(1)
        .select(F.posexplode(numbers).alias("slot", "number"))
        .select("slot", F.get(names, F.col("number").cast("int")).alias("shard"))
    )


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key; a null key stands in the slot of the empty string."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    digest = F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("long")
    return F.pmod(digest, F.lit(slots)).cast("int")


def assign_shards(
    docs: DataFrame, shards: list[str] | None = None, slots: int = SLOTS, key: str = "doc_id"
) -> DataFrame:
    """``docs`` with ``slot`` and ``shard`` added (columns of these names are replaced).

    One lookup in a broadcast table of exactly ``slots`` rows; no shuffle, so neither
    a hot source nor repeated rows matter. Equal keys go to one shard.
    """
    table = F.broadcast(lookup(docs.sparkSession, shards or shard_names(), slots))
    return docs.drop("slot", "shard").withColumn("slot", slot_of(F.col(key), slots)).join(table, "slot")


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:04d}" for i in range(n)]


def write_shards(
    docs: DataFrame, path: str, shards: list[str] | None = None, slots: int = SLOTS, rows_per_file: int = 1_000_000
) -> None:
    """Writes one folder per shard, ``path/shard=<name>``.

    Rows are dealt out by slot, of which there are many per shard: a shard's
    rows come from several tasks, and equal keys stay in one.
    """
    placed = assign_shards(docs, shards, slots)
    (
        placed.repartition("slot")
        .drop("slot")
        .write.option("maxRecordsPerFile", rows_per_file)
        .partitionBy("shard")
        .parquet(path)
    )


def read_shards(spark: SparkSession, path: str, schema: StructType, slots: int = SLOTS, key: str = "doc_id") -> DataFrame:
    """All rows that ``write_shards`` wrote of a table with ``schema``, with ``slot`` and ``shard``."""
    fields = [f for f in schema.fields if f.name not in ("slot", "shard")]
    back = spark.read.schema(StructType(fields).add("shard", StringType())).parquet(path)
    return back.withColumn("slot", slot_of(F.col(key), slots))
