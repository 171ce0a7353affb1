"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which ``run`` writes as Parquet and reads again as the
docs of the next stage. All stages but the last return the columns of documents. Empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outpour.llm import exact, language, simhash, suffix
from outpour.llm.queries import packed
from outpour.llm.store import written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language (null, or no letter); fills in a language that is not given."""
    model = language.fit(docs, "text", "lang")
    found = language.identify(docs, model, "text", docs.columns)
    found = found.where(F.col("lang_pred") != language.UNDETERMINED)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each text, but for the case of A to Z."""
    return exact.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group whose fingerprints (3-word shingles) are linked by 3 bits or fewer."""
    return simhash.drop_near_copies(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages of 100 bytes and more that occur earlier; characters that a cut splits go as a whole."""
    others = [name for name in docs.columns if name not in ("text", "n_chars")]
    cut = suffix.remove_repeats(docs, "doc_id", "text", [*others], as_text=True)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences."""
    return packed(docs)


STAGES = [
    ("language", identify_language),
    ("exact", drop_exact_copies),
    ("near", drop_near_copies),
    ("repeats", cut_repeats),
    ("packing", pack),
]

#: Fingerprints, suffix order and tokens are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
