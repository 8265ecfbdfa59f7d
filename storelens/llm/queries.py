"""The operators of this subpackage over the whole given tables, and SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from storelens.llm import (
    alignment,
    decontamination,
    line_dedup,
    lm,
    pieces,
    quality,
    runs,
    sharding,
    simhash,
    substring,
    token_counts,
    token_files,
    word_bpe,
)
from storelens.operators.staging import staging_path


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text")


def op1_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf), public_tokenizers.path("piece_bpe_32k.model"))


def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge(documents(spark, sf), table(spark, sf, "labels")).drop("text")


def op3_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontamination.find_leaks(documents(spark, sf), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    return pieces.encode_digests(documents(spark, sf), public_tokenizers.path("piece_bpe_32k.model"))


def op5_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = line_dedup.dedup_lines(documents(spark, sf))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = staging_path(spark, "tokens")
    token_files.write_tokens(documents(spark, sf), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.checksums(token_files.read_tokens(spark, path))


def op7_sharding(spark: SparkSession, sf: str) -> DataFrame:
    docs, path = table(spark, sf, "documents"), staging_path(spark, "shards")
    sharding.write_shards(docs, path)
    return sharding.read_shards(spark, path, docs.schema).select("doc_id", "slot", "shard")


def op8_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_copies(documents(spark, sf))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = substring.find_repeats(documents(spark, sf)).drop("text_hash")
    return found.withColumn("repeated", F.col("n_shared_words") > 0)


def op10_lm_scores(spark: SparkSession, sf: str) -> DataFrame:
    return lm.score_documents(documents(spark, sf))


def op11_word_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return word_bpe.encode_digests(documents(spark, sf), public_tokenizers.path("word_bpe_49k.json"))


def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = runs.find_runs(runs.repeating(documents(spark, sf)))
    line = F.transform("runs", lambda r: F.concat(r.start, F.lit(","), r.length, F.lit(","), r.period, F.lit("\n")))
    return found.select(
        "doc_id",
        "n_runs",
        "start",
        "length",
        "period",
        "exponent_milli",
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_alignment(spark: SparkSession, sf: str) -> DataFrame:
    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align_digests(documents(spark, sf), a, b)


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_quality_rules": op2_quality_rules,
    "op3_decontamination": op3_decontamination,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_line_dedup": op5_line_dedup,
    "op6_token_files": op6_token_files,
    "op7_sharding": op7_sharding,
    "op8_simhash": op8_simhash,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_lm_scores": op10_lm_scores,
    "op11_word_bpe": op11_word_bpe,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_alignment": op13_alignment,
}

UPPER, LOWER = line_dedup.UPPER, line_dedup.LOWER
WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

LEAKS = f"""
    with docs as (select doc_id, {WORDS} as w from documents),
    items as (select coalesce(cast(item_id as varchar), '') as item_id, {WORDS} as w from benchmark),
    item_windows as (
        select distinct item_id, size, array_to_string(w[a + 1 : a + size], ' ') as win
        from (select item_id, w, least(10, len(w)) as size, unnest(range(len(w) - least(10, len(w)) + 1)) as a
              from items where len(w) > 0) i),
    doc_windows as (
        select doc_id, a, size, array_to_string(w[a + 1 : a + size], ' ') as win
        from (select doc_id, w, size, unnest(range(greatest(len(w) - size + 1, 0))) as a
              from docs cross join (select distinct size from item_windows) s) d),
    hits as (select doc_id, a, size, item_id from doc_windows join item_windows using (size, win)),
    words as (
        select doc_id, count(distinct p) as n
        from (select doc_id, unnest(range(a, a + size)) as p from (select distinct doc_id, a, size from hits) h) x
        group by doc_id),
    named as (
        select doc_id, count(*) as n, string_agg(item_id, ',' order by item_id) as ids
        from (select distinct doc_id, item_id from hits) h group by doc_id)
    select doc_id, len(w) as n_words, coalesce(words.n, 0) as n_hit, coalesce(named.n, 0) as n_items,
           sha256(coalesce(ids, '')) as items_sha256, coalesce(words.n, 0) > 0 as contaminated
    from docs left join words using (doc_id) left join named using (doc_id)"""


def _digits(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, {sharding.DIGITS}))::bigint"


#: the table is filled turn by turn in a recursion that keeps its last state alone
SHARDS = f"""
    with recursive names as (
        select i, 'shard-' || lpad(cast(i as varchar), 4, '0') as name from range({sharding.SHARDS}) r(i)),
    orders as (
        select i, list_transform(range({sharding.SLOTS}),
                                 lambda j: cast((first + j * skip) % {sharding.SLOTS} as smallint)) as slots
        from (select i, {_digits("'offset|' || name")} % {sharding.SLOTS} as first,
                     {_digits("'skip|' || name")} % {sharding.SLOTS - 1} + 1 as skip from names) n),
    turns(one, k, owner) using key (one) as (
        select 1, 0, list_transform(range({sharding.SLOTS}), lambda x: cast(-1 as smallint))
        union
        select 1, k + 1, list_transform(owner, lambda o, p: if(p = free + 1, cast(k % {sharding.SHARDS} as smallint), o))
        from (select t.k, t.owner, list_filter(o.slots, lambda s: t.owner[s + 1] < 0)[1] as free
              from turns t join orders o on o.i = t.k % {sharding.SHARDS} where t.k < {sharding.SLOTS}) q)
    select doc_id, cast(slot as integer) as slot, name as shard
    from (select doc_id, {_digits("coalesce(cast(doc_id as varchar), '')")} % {sharding.SLOTS} as slot from documents) d
         cross join turns join names on names.i = owner[slot + 1]"""

ORACLES = {
    "op3_decontamination": LEAKS,
    "op7_sharding": SHARDS,
    "op5_line_dedup": """
        with lines as (
            select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
                   unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as pos
            from documents),
        keyed as (
            select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
            from lines),
        shared as (
            select key, max(doc_id) as keeper from keyed where length(key) >= 20
            group by key having count(distinct doc_id) >= 3),
        marked as (
            select k.*, s.key is not null and k.doc_id <> s.keeper as gone
            from keyed k left join shared s using (key))
        select doc_id, count(*) as n_lines, cast(sum(gone::int) as bigint) as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
        from marked group by doc_id""",
}
