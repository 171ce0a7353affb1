"""The pipeline, stage by stage, against brute force on what each stage was given."""

import os
import re
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from outpour.llm import packing
from tests.llm.test_operators import brute_components, brute_print, lowered, read

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def brute_cut(texts, length=100):
    """Texts without the bytes of repeated strings; characters that a cut splits go as a whole."""
    seen, result = set(), {}
    for key, text in sorted(texts.items()):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for start in range(len(data) - length + 1):
            part = data[start : start + length]
            if part in seen:
                gone[start : start + length] = b"\1" * length
            seen.add(part)
        result[key] = bytes(c for c, g in zip(data, gone) if not g).decode("utf-8", "ignore")
    return result


@pytest.fixture(scope="module")
def stages(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables here")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF_DIR), f"test-pipeline-{name}")
        found[name] = docs.collect()
    return found


def texts_of(rows):
    return {row["doc_id"]: row["text"] for row in rows}


def test_language_keeps_documents_with_letters(stages):
    given = texts_of(stages["documents"])
    assert texts_of(stages["language"]) == {k: t for k, t in given.items() if t and re.search(r"[^\W\d_]", t)}


def test_one_of_equal_texts_stays(stages):
    groups = defaultdict(list)
    for key, text in texts_of(stages["language"]).items():
        groups[lowered(text)].append(key)
    assert set(texts_of(stages["exact"])) == {max(keys) for keys in groups.values()}


def test_one_of_linked_texts_stays(stages):
    given = texts_of(stages["exact"])
    component = brute_components({key: brute_print(text) for key, text in given.items()})
    assert texts_of(stages["near"]) == {key: given[key] for key in set(component.values())}


def test_repeats_are_cut(stages):
    assert texts_of(stages["repeats"]) == brute_cut(texts_of(stages["near"]))
    assert all(row["n_chars"] == len(row["text"]) for row in stages["repeats"])


def test_all_tokens_are_packed(stages):
    encode = packing.tiktoken_encoder(read("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    pieces, sequences = defaultdict(list), defaultdict(int)
    for row in stages["packing"]:
        pieces[row["doc_id"]].append((row["start"], row["length"]))
        sequences[row["sequence_id"]] += row["length"]
    assert max(sequences.values()) <= 1024
    assert set(pieces) == set(texts_of(stages["repeats"]))
    for key, text in texts_of(stages["repeats"]).items():
        starts, lengths = np.array(sorted(pieces[key])).T
        assert lengths.sum() == len(encode(text or "")) + 1
        assert (starts == np.cumsum(lengths) - lengths).all()


def test_columns_stay_those_of_documents(spark, stages):
    columns = list(stages["documents"][0].asDict())
    assert all(list(stages[name][0].asDict()) == columns for name in ("language", "exact", "near", "repeats"))


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF_DIR), f"test-empty-{name}")
        assert docs.count() == 0
