"""Small tables for the corpus operators."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
MODEL_DIR = "public_tokenizers"
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
EDGES = [
    (1, None),
    (2, ""),
    (3, "   \t\n \x0b "),
    (4, "one"),
    (5, "Élan VITAL élan vital"),
    (5, "Élan VITAL élan vital"),
    (5, "another text under the same id"),
    (None, "a text without an id stands here for once"),
    (None, None),
    (8, LONG),
    (9, "x" * 5000),
    (10, "\n\n\n"),
    (11, "tail \r\n\r\n mixed\tblanks 😀 \x00 end"),
]


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed: int, n: int, words: int = 60, vocabulary: int = 300) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(1, 8))) for _ in range(vocabulary)]
    return [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(1, words)))) for i in range(n)]
