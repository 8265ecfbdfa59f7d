"""Lines that many documents share, dropped everywhere but in one document. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from storelens.llm.columns import set_aside
from storelens.operators.staging import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: stripped at both ends of a line
BLANKS = " \t\n\x0b\x0c\r"
#: shortest key that counts, and number of documents from which a line is dropped
MIN_CHARS, MIN_DOCS = 20, 3


def ascii_lower(c: Column) -> Column:
    """Only A-Z change. Text of single-byte characters takes the quick built-in way to the same result."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(doc_id, text_hash, pos, k1, k2)`` of each line whose key has ``min_chars`` code points or more.

    Two 64-bit hashes with different seeds stand for the key.
    """
    lines = docs.select(
        "doc_id",
        F.xxhash64(_text()).alias("text_hash"),
        F.posexplode(F.split(_text(), "\n", -1)).alias("pos", "line"),
    )
    key = lines.withColumn("key", ascii_lower(F.btrim("line", F.lit(BLANKS))))
    return key.filter(F.char_length("key") >= min_chars).select(
        "doc_id", "text_hash", "pos", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), F.col("key")).alias("k2")
    )


def shared_lines(keys: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(k1, k2, keeper)`` of the keys in ``min_docs`` or more documents, with the largest id that holds each.

    Documents are counted in two steps, each summed before its shuffle, so
    the commonest line sends a row per task.
    """
    held = keys.groupBy("k1", "k2", "doc_id").agg(F.lit(1).alias("one")).drop("one")
    return (
        held.groupBy("k1", "k2")
        .agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
        .filter(F.col("n") >= min_docs)
        .select("k1", "k2", "keeper")
    )


@set_aside("_id", "_hash", "_drop", "_text_hash", "_lines")
def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the columns ``n_lines``, ``n_dropped`` and ``kept_text`` added.

    Rows with one ``doc_id`` count as one document, rows with a null id together as
    one, too, which keeps a line only if no other document holds it. A null text is an empty line. Columns of
    ``docs`` that have the new names are replaced. Rows, even repeated ones,
    all stay; documents without lines left get an empty text.
    """
    # written out, as the counted keys then join with an exchange of their own and hot keys can be split
    shared = stage(shared_lines(line_keys(docs, min_chars), min_docs))
    dropped = (
        line_keys(docs, min_chars)
        .join(shared, ["k1", "k2"])
        .filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("pos").alias("_drop"))
        .toDF("_id", "_hash", "_drop")
    )
    own = docs.drop("n_lines", "n_dropped", "kept_text").withColumn("_text_hash", F.xxhash64(_text()))
    same = own["doc_id"].eqNullSafe(dropped["_id"]) & (own["_text_hash"] == dropped["_hash"])
    lines = F.split(_text(), "\n", -1)
    places = F.array_except(F.sequence(F.lit(0), F.col("n_lines").cast("int") - 1), F.col("_drop"))
    return (
        own.join(dropped, same, "left")
        .withColumn("_lines", lines)
        .withColumn("n_lines", F.size("_lines").cast("long"))
        .withColumn("n_dropped", F.coalesce(F.size("_drop"), F.lit(0)).cast("long"))
        .withColumn(
            "kept_text",
            F.when(F.col("_drop").isNull(), _text()).otherwise(
                F.array_join(F.transform(places, lambda i: F.get("_lines", i)), "\n")
            ),
        )
        .drop("_id", "_hash", "_drop", "_text_hash", "_lines")
    )
