"""The registered queries of this subpackage, and their SQL for DuckDB where SQL can express them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outpour.llm import (
    bpe,
    exact,
    html,
    language,
    neighbours,
    packing,
    periodic,
    rules,
    sharding,
    simhash,
    spelling,
    suffix,
    toxicity,
)

SHARDS = 40


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = simhash.fingerprints(_documents(spark, sf_dir), "doc_id", "text")
    found = simhash.near_components(prints)
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op2_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    docs = docs.withColumn("text_sha256", F.sha2(exact.normalised(F.col("text")), 256))
    return exact.exact_groups(docs, carry=["doc_id", "text_sha256"])


def _vocabulary(name: str) -> bytes:
    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def _round_trip(ids: list[int], decoder: bpe.StreamDecoder) -> tuple[int, str, str]:
    listed = ",".join(map(str, ids)).encode()
    return len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(decoder.bytes_of(ids)).hexdigest()


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.map_encoded(
        _documents(spark, sf_dir),
        "doc_id",
        "text",
        _vocabulary("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
        _round_trip,
        "n_tokens long, ids_sha256 string, decoded_sha256 string",
    ).withColumnRenamed("id", "doc_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    docs = _documents(spark, sf_dir).select("doc_id", "text", held_out.alias("held_out"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out)
    model = toxicity.fit(docs, labels, "doc_id", "text", "toxic")
    return toxicity.score_texts(docs, model, "text", ["doc_id", "held_out"])


def op5_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.remove_repeats(_documents(spark, sf_dir), "doc_id", "text", ["doc_id"])
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select(
        "doc_id", "text", "lang", (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("held_out")
    )
    model = language.fit(docs.where(~F.col("held_out")), "text", "lang")
    return language.identify(docs, model, "text", ["doc_id", "held_out"])


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = rules.judge(_documents(spark, sf_dir), labels, "doc_id", "text", "quality")
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select("doc_id", *base)


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"), "html", ["page_id", "url"])


def packed(docs: DataFrame) -> DataFrame:
    """The pieces of all documents, packed; ids are those of the public 50k tokenizer, its added tokens included."""
    ranks, pattern = _vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    added = packing.added_tokens(_vocabulary("byte_bpe_50k.json"))
    found = packing.pieces(docs, "doc_id", "text", lambda: packing.tiktoken_encoder(ranks, pattern, added))
    return packing.pack(found)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_documents(spark, sf_dir))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    placed = sharding.shard_rows(
        _documents(spark, sf_dir),
        "doc_id",
        [1.0] * SHARDS,
        [
            (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.lit("key").alias("law"),
            sharding.rendezvous(F.col("doc_id"), [1.0] * (SHARDS + 1)).alias("grown_shard"),
        ],
    )
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return neighbours.nearest(rows, F.col("vec_id") % 50 == 0, "vec_id", "embedding", k=5)


def planted_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and words; every tenth document's words, by a hash of its id, repeat with a period from some place on."""
    words = F.array_remove(F.split(F.coalesce(F.col("text"), F.lit("")), r"[\x20\x09-\x0D]+"), "")
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select("doc_id", words.alias("words"), h.alias("h"), F.expr("crc32(cast(doc_id as string)) div 10").alias("g"))
    rows = rows.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))

    def planted(word: Column, place: Column) -> Column:
        source = F.col("a") + (place - F.col("a")) % F.col("p")
        return F.when(place < F.col("a"), word).otherwise(F.get("words", source.cast("int")))

    chosen = (F.col("h") % 10 == 0) & (F.col("n") > 0)
    return rows.select("doc_id", F.when(chosen, F.transform("words", planted)).otherwise(F.col("words")).alias("words"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse(planted_repeats(_documents(spark, sf_dir)), F.col("words"), ["doc_id"])
    lines = F.transform("runs", lambda run: F.concat_ws(",", run["start"], run["length"], run["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    # The greatest of length / period, held against each other without division; runs come by start, then period.
    none = "cast(null as struct<start:bigint,length:bigint,period:bigint>)"
    greater = "best is null or run.length * best.period > best.length * run.period"
    best = F.expr(f"aggregate(runs, {none}, (best, run) -> if({greater}, run, best))")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.alias("best"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


def spelled_words() -> Column:
    """Runs of letters of a text, A to Z in lower case; one in 31, by a hash, lacks a letter."""
    lower = exact.normalised(F.col("text"))
    # Shorter runs cannot become long enough.
    runs = F.regexp_extract_all(lower, F.lit("([A-Za-z\u00C0-\u00FF]{7,})"), 1)

    def written_as(run: Column) -> Column:
        h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), run))
        gone = (h % F.char_length(run)).cast("int")
        short = F.concat(F.substring(run, F.lit(1), gone), F.substring(run, gone + 2, F.char_length(run)))
        return F.when(h % 31 == 0, short).otherwise(run)

    return F.transform(runs, written_as)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(_documents(spark, sf_dir), spelled_words()))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_exact": op2_exact,
    "op3_bpe": op3_bpe,
    "op4_toxicity": op4_toxicity,
    "op5_suffix": op5_suffix,
    "op6_language": op6_language,
    "op7_quality": op7_quality,
    "op8_html": op8_html,
    "op9_packing": op9_packing,
    "op10_sharding": op10_sharding,
    "op11_neighbours": op11_neighbours,
    "op12_periodic": op12_periodic,
    "op13_spelling": op13_spelling,
}

CHECKS: dict[str, str] = {
    "op2_exact": """
        WITH texts AS (
          SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
          FROM documents
        ), groups AS (
          SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY text_sha256
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM texts JOIN groups USING (text_sha256)
    """,
}
