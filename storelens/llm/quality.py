"""Quality rules: counts of a text, and a hashed n-gram likelihood ratio. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from storelens.llm.columns import set_aside
from storelens.operators.staging import stage

#: a text fails with fewer words, or with a larger share of words in repeated windows
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
#: hashed features; pseudo-count of each in the corpus multinomial
BUCKETS, SMOOTHING = 10_000, 1
#: pseudo-counts of the target per bucket on average, spread as the corpus is: what the target has not shown is taken as usual
PRIOR = 20
#: log ratios are whole numbers of 1 / UNIT, so sums do not depend on their order
UNIT = 1 << 20
#: mean log ratio per feature from which a text is kept
THRESHOLD = -0.05
#: labelled rows that train the target at most; those with the smallest hashes
MAX_TRUSTED = 20_000

WHITE = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Words of a whole text; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WHITE), lambda w: w != "")


def _place_mask(n: Column) -> Column:
    """As many low bits set as a place among ``n`` words needs."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(n))) - 1


def _packed(grams: Column, mask: Column) -> Column:
    """Windows' hashes in sorted order, each one long with the window's place in the low bits."""
    bits = F.bit_count(mask)
    return F.sort_array(
        F.transform(grams, lambda g, i: F.call_function("shiftleft", g, bits).bitwiseOR(i.cast("long")))
    )


def _repeated(packed: Column, grams: Column, mask: Column) -> Column:
    """Places, in order, of the windows that stand at least twice in the text.

    Windows found twice are neighbours in ``packed``; neighbours that agree there are compared by their whole hashes.
    """

    def place(x: Column) -> Column:
        return x.bitwiseAND(mask).cast("int")

    def same(x: Column, y: Column) -> Column:
        near = x.bitwiseXOR(y).between(F.lit(0), mask)
        return F.coalesce(near & (F.get(grams, place(x)) == F.get(grams, place(y))), F.lit(False))

    twins = F.filter(
        packed, lambda x, j: same(x, F.get(packed, j - 1)) | same(x, F.get(packed, j + 1))
    )
    return F.sort_array(F.transform(twins, place))


def _covered(places: Column) -> Column:
    """Words in windows at ``places``: each covers what lies before the next one, ``WINDOW`` words at most."""
    steps = F.transform(
        places,
        lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(places, j + 1) - p, F.lit(WINDOW))).cast("long"),
    )
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)


def _pairs(hashes: Column) -> Column:
    """Hash of each word's hash and the next one's; the last word has none and gets a number that is not used."""
    return F.transform(hashes, lambda x, i: F.xxhash64(x, F.get(hashes, i + 1)))


def _windows(hashes: Column, pairs: Column, n: Column) -> Column:
    """Hash of each run of ``WINDOW`` (five) words, from two pairs and a word."""
    firsts = F.slice(pairs, 1, F.greatest(n - WINDOW + 1, F.lit(0)))
    return F.transform(firsts, lambda y, i: F.xxhash64(y, F.get(pairs, i + 2), F.get(hashes, i + 4)))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed`` and ``_h, _p``.

    All of it is computed within the row, without a shuffle; ``_h`` holds the words' hashes, ``_p`` the pairs'.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.withColumn("_w", words_of(F.col("text")))
    hashed = split.withColumns(
        {
            "_n": F.size("_w"),
            "_h": F.transform("_w", lambda w: F.xxhash64(w)),
            "word_chars": F.char_length(F.array_join("_w", "")).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
            "_lines": F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        }
    ).drop("_w")
    n = F.col("_n")
    paired = hashed.withColumn("_p", _pairs(F.col("_h")))
    windows = paired.withColumns(
        {
            "_g": _windows(F.col("_h"), F.col("_p"), n),
            "_mask": _place_mask(n),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_words": n.cast("long"),
        }
    ).drop("_lines")
    counted = (
        windows.withColumn("_s", _packed(F.col("_g"), F.col("_mask")))
        .withColumn("_t", _repeated(F.col("_s"), F.col("_g"), F.col("_mask")))
        .drop("_s", "_g", "_mask")
        .withColumn("n_repeat_words", _covered(F.col("_t")))
        .drop("_t", "_n")
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def features(hashes: Column, pairs: Column, buckets: int = BUCKETS) -> Column:
    """Bucket numbers of all words and all pairs of neighbouring words."""
    both = F.concat(hashes, F.slice(pairs, 1, F.greatest(F.size(hashes) - 1, F.lit(0))))
    return F.transform(both, lambda x: F.pmod(x, F.lit(buckets)).cast("int"))


def summed(hashes: Column, pairs: Column, ratios: Column, buckets: int = BUCKETS) -> Column:
    """Sum of the log ratios of a text's features, word by word with the pair that starts there."""

    def ratio(x: Column) -> Column:
        return F.get(ratios, F.pmod(x, F.lit(buckets)).cast("int"))

    last = F.size(hashes) - 1
    steps = F.transform(
        pairs, lambda y, i: ratio(F.get(hashes, i)) + F.when(i < last, ratio(y)).otherwise(F.lit(0).cast("long"))
    )
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)


def trusted_ids(labels: DataFrame, most: int = MAX_TRUSTED) -> DataFrame:
    """Ids of rows labelled as good, ``most`` of them, chosen by hash."""
    good = labels.filter("quality = 1 and doc_id is not null").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def log_ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """``(bucket, ratio)`` for all buckets: log target share minus log corpus share, in whole ``UNIT`` parts.

    The corpus counts cover every document. The target's come from at most
    ``max_trusted`` labelled ones, whose ids are broadcast. Each task sends one row per
    bucket, so nothing here depends on how words are spread.
    """
    trusted = F.broadcast(trusted_ids(labels, max_trusted).withColumn("_trusted", F.lit(1)))
    seen = docs.select("doc_id", F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)).alias("h"))
    counts = (
        seen.select("doc_id", "h", _pairs(F.col("h")).alias("p"))
        .select("doc_id", features(F.col("h"), F.col("p"), buckets).alias("f"))
        .join(trusted, "doc_id", "left")
        # outer, as Spark else copies the whole expression into a filter on its size
        .select(F.explode_outer("f").alias("bucket"), "_trusted")
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.count("_trusted").alias("target"))
    )
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    full = stage(
        every.join(counts, "bucket", "left").select(
            "bucket",
            (F.coalesce("raw", F.lit(0)) + SMOOTHING).alias("raw"),
            F.coalesce("target", F.lit(0)).alias("target"),
        )
    )
    total = full.agg(F.sum("raw").alias("r"), F.sum("target").alias("t")).first()
    share, prior = F.col("raw") / F.lit(float(total.r)), float(PRIOR * buckets)
    ratio = F.log((F.col("target") + prior * share) / F.lit(total.t + prior)) - F.log(share)
    return full.select("bucket", F.round(ratio * UNIT).cast("long").alias("ratio"))


@set_aside("_w", "_h", "_p", "_n", "_g", "_s", "_t", "_mask", "_lines", "_ratios", "_sum")
def judge(
    docs: DataFrame,
    labels: DataFrame,
    buckets: int = BUCKETS,
    threshold: float = THRESHOLD,
    max_trusted: int = MAX_TRUSTED,
) -> DataFrame:
    """``docs`` with the counts of ``measured``, ``log_ratio`` (mean per feature) and ``kept``.

    ``kept`` is false where ``base_failed``, else whether the whole-number sum of log ratios
    reaches ``threshold`` times the number of features. A text without words has
    mean 0 and fails the base. Rows are judged one by one: repeated rows and null ids get equal
    verdicts for equal texts. Columns of ``docs`` with the new names are replaced. Without
    trusted rows all ratios are 0 and the base alone decides.
    """
    table = log_ratios(docs, labels, buckets, max_trusted)
    # a row of `buckets` whole numbers, put in order; a bounded constant for all tasks
    ratios = table.agg(
        F.transform(F.sort_array(F.collect_list(F.struct("bucket", "ratio"))), lambda x: x["ratio"]).alias("all")
    )
    kept_columns = [c for c in docs.columns if c not in NEW_COLUMNS]
    rows = measured(docs.select(*kept_columns)).withColumn("_ratios", ratios.scalar())
    scored = rows.withColumn("_sum", summed(F.col("_h"), F.col("_p"), F.col("_ratios"), buckets))
    n = F.greatest(2 * F.col("n_words") - 1, F.lit(0))
    # true for each row; keeps a filter on the verdict from being pushed down, which would copy all of it many times
    here = F.spark_partition_id() >= 0
    return scored.withColumns(
        {
            "log_ratio": F.when(n > 0, F.col("_sum") / (F.lit(float(UNIT)) * n)).otherwise(F.lit(0.0)),
            "kept": here & ~F.col("base_failed") & (F.col("_sum") >= F.lit(int(threshold * UNIT)) * n),
        }
    ).drop("_h", "_p", "_sum", "_ratios")


#: columns that ``judge`` adds
NEW_COLUMNS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "base_failed",
    "log_ratio",
    "kept",
)
