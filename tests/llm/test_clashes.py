"""Columns named like results are replaced, and empty tables give empty results, in every operator that carries columns."""

import pytest
from pyspark.sql import functions as F

from outpour.llm import bpe, exact, language, periodic, queries, rules, sharding, simhash, suffix, toxicity
from tests.llm.test_operators import read

CLASHES = (
    "doc_id long, text string, lang string, score string, predicted string, lang_pred string, kept string, n_words string, spans string, "
    "n_bytes string, __text string, runs string, shard2 string"
)


@pytest.fixture(scope="module")
def docs(spark):
    words = ["der", "die", "und", "the", "of", "and", "house", "haus"]
    rows = [(k, " ".join(words[(k + j) % 8] for j in range(60)), ["de", "en"][k % 2], *["own"] * 10) for k in range(12)]
    return spark.createDataFrame([*rows, (12, None, None, *["own"] * 10), rows[0]], CLASHES)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, k % 2, k % 2) for k in range(12)], "doc_id long, toxic int, quality int")


def carried(name, docs, labels, columns):
    if name == "language":
        return language.identify(docs, language.fit(docs, "text", "lang"), "text", columns)
    if name == "toxicity":
        return toxicity.score_texts(docs, toxicity.fit(docs, labels, "doc_id", "text", "toxic"), "text", columns)
    if name == "suffix":
        return suffix.remove_repeats(docs, "doc_id", "text", columns)
    if name == "rules":
        return rules.statistics(docs, "text", columns)
    if name == "exact":
        return exact.exact_groups(docs, carry=columns)
    return periodic.collapse(docs, F.split("text", " "), columns)


@pytest.mark.parametrize(
    "name, results",
    [
        ("language", ["lang_pred", "score"]),
        ("toxicity", ["score", "predicted"]),
        ("suffix", ["n_bytes", "spans", "kept"]),
        ("rules", ["n_words"]),
        ("exact", ["kept"]),
        ("periodic", ["runs"]),
    ],
)
def test_results_replace_columns_of_their_name(docs, labels, name, results):
    own = ["doc_id", "text", "lang", "shard2", *results]
    rows = carried(name, docs, labels, own)
    assert len(rows.columns) == len(set(rows.columns))
    assert all(kind != "string" for column, kind in rows.dtypes if column in results and column != "lang_pred")
    found = rows.collect()
    assert len(found) == 14 and all(row["shard2"] == "own" for row in found)
    assert all(row[column] != "own" for row in found for column in results)
    assert carried(name, docs.limit(0), labels, own).collect() == []


def test_empty_tables(docs):
    nothing = docs.limit(0)
    assert simhash.near_components(simhash.fingerprints(nothing, "doc_id", "text")).collect() == []
    assert simhash.drop_near_copies(nothing).columns == docs.columns
    assert bpe.encode_texts(nothing, "doc_id", "text", read("byte_bpe_50k.tiktoken"), r"\S+|\s+").collect() == []
    assert queries.packed(nothing).collect() == []
    assert sharding.shard_rows(nothing, "doc_id", [1.0, 2.0]).collect() == []


def test_repeated_rows_and_nulls_stay_in_near_copies(docs):
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert kept.where("doc_id = 0").count() == 2  # a row that repeats the smallest id stays like it
