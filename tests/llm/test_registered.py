"""The registered queries on whole small tables, against reruns in plain Python: values, columns and types."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import tokenizers

from outpour.llm import bpe, queries
from tests.llm.test_operators import brute_components, brute_print, brute_repeats, brute_statistics

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return {row["doc_id"]: row["text"] for row in rows}


def result(spark, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    rows = df.collect()
    return dict(df.dtypes), rows


def by_id(rows, key="doc_id"):
    found = {row[key]: row for row in rows}
    assert len(found) == len(rows)
    return found


def test_op1(spark, texts):
    types, rows = result(spark, "op1_simhash")
    assert types == {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"}
    prints = {key: brute_print(text) for key, text in texts.items()}
    component = brute_components(prints)
    assert {key: (row["fingerprint"], row["component_id"]) for key, row in by_id(rows).items()} == {
        key: (f"{prints[key]:016x}", component[key]) for key in texts
    }


def test_op3(spark, texts):
    types, rows = result(spark, "op3_bpe")
    assert types == {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = bpe.read_ranks(file.read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for key, row in by_id(rows).items():
        ids = library.encode_ordinary(texts[key] or "")
        digests = [hashlib.sha256(data).hexdigest() for data in (",".join(map(str, ids)).encode(), (texts[key] or "").encode())]
        assert tuple(row)[1:] == (len(ids), *digests)
    assert len(rows) == len(texts)


def test_op4(spark, texts):
    types, rows = result(spark, "op4_toxicity")
    assert types == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    for key, row in by_id(rows).items():
        assert row["held_out"] == (zlib.crc32(str(key).encode()) % 5 == 0)
        assert 0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.5)
    assert len(rows) == len(texts)


def test_op5(spark, texts):
    types, rows = result(spark, "op5_suffix")
    assert types == {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"}
    assert {key: tuple(row)[1:] for key, row in by_id(rows).items()} == brute_repeats(texts.items())


def test_op6(spark, texts):
    types, rows = result(spark, "op6_language")
    assert types == {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}
    truth = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang").collect()
    truth = {row["doc_id"]: row["lang"] for row in truth}
    right = known = 0
    for key, row in by_id(rows).items():
        assert row["held_out"] == (zlib.crc32(str(key).encode()) % 4 == 2) and 0 <= row["score"] <= 1
        letters = any(letter.isalpha() for letter in texts[key] or "")
        assert (row["lang_pred"] == "und") == (not letters)
        if letters and row["held_out"] and truth[key] is not None:
            known, right = known + 1, right + (row["lang_pred"] == truth[key])
    assert len(rows) == len(texts) and right >= 0.95 * known > 0


def test_op7(spark, texts):
    types, rows = result(spark, "op7_quality")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert types == {"doc_id": "bigint", **dict.fromkeys(counts, "bigint"), "base_failed": "boolean", "kept": "boolean"}
    for key, row in by_id(rows).items():
        expected = brute_statistics(texts[key])
        assert tuple(row[name] for name in counts) == expected
        assert row["base_failed"] == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert not (row["base_failed"] and row["kept"])
    assert len(rows) == len(texts) and any(row["kept"] for row in rows)


def test_op8(spark):
    types, rows = result(spark, "op8_html")
    assert types == {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"}
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url").collect()
    assert Counter(row[:2] for row in rows) == Counter(map(tuple, pages))
    for row in rows:
        assert row["n_chars"] == len(row["text"]) and row["text"] == row["text"].strip()
        assert "<p>" not in row["text"] and all("\n" not in block for block in row["text"].split("\n\n"))


def test_op9(spark, texts):
    types, rows = result(spark, "op9_packing")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert {name: types[name] for name in names} == dict.fromkeys(names, "bigint")
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for row in rows:
        pieces[row["doc_id"]].append(row)
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    for key, text in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        end = 0
        for row in sorted(pieces.pop(key), key=lambda row: row["start"]):
            assert row["start"] == end and row["length"] > 0 and row["doc_tokens"] == len(ids)
            end += row["length"]
            assert row["ids_crc32"] == zlib.crc32(ids[row["start"] : end].tobytes())
        assert end == len(ids)
    assert not pieces
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    assert sum(row["length"] for row in rows) >= 0.95 * 1024 * len(sequences)


def test_op10(spark, texts):
    types, rows = result(spark, "op10_sharding")
    assert {name: types[name] for name in ("doc_id", "size", "text_crc32", "slot")} == dict.fromkeys(
        ("doc_id", "size", "text_crc32", "slot"), "bigint"
    )
    assert types["law"] == "string" and types["shard"] == types["grown_shard"] == "int"
    slots = defaultdict(list)
    for key, row in by_id(rows).items():
        data = (texts[key] or "").encode()
        assert (row["size"], row["text_crc32"], row["law"]) == (len(data) + 16, zlib.crc32(data), "key")
        assert 0 <= row["shard"] < 40 and row["grown_shard"] in (row["shard"], 40)
        slots[row["shard"]].append(row["slot"])
    assert all(sorted(own) == list(range(len(own))) for own in slots.values()) and len(rows) == len(texts)


def test_every_dealt_operator_is_registered():
    numbers = sorted(int(name.split("_")[0].removeprefix("op")) for name in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.CHECKS) <= set(queries.QUERIES)
