"""A training corpus from ``documents``: judged, stripped of shared lines and near copies, decontaminated, encoded."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from storelens.llm import decontamination, line_dedup, near, pieces, quality, simhash
from storelens.operators.staging import staging_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.judge(docs, labels).filter("kept").select(*docs.columns)


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that others share; those that lose all their text go."""
    kept = line_dedup.dedup_lines(docs)
    changed = kept.filter((F.col("n_dropped") == 0) | F.col("kept_text").rlike(r"[^\x20\x09-\x0D]"))
    text = F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return changed.withColumns({"text": text, "n_chars": F.char_length(text).cast("long")}).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, linked by SimHash fingerprints or by shingle sets."""
    return near.drop_near_copies(docs, simhash.groups(docs))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document that is left, and digests of ids and decoded text."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode_digests(docs.select("doc_id", "text"), model)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", shared_lines),
    ("near-dedup by SimHash and word shingles", near_copies),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", sentencepiece_encoding),
]

#: SQL has neither the hash of the quality features nor the encoder
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage; each stage but the last is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        if number == len(STAGES) - 1:
            return made
        path = staging_path(spark, "corpus")
        made.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
