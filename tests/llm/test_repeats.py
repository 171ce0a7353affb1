"""Phrases, entries and order of the repeats operator, step by step, without a session."""

import random

import numpy as np
import pyarrow as pa
import pytest

from outpour.llm import suffix

LENGTH = suffix.LENGTH


def parsed(texts):
    """The dictionary: (trigger, bytes) to document, start and number of strings of the earliest occurrence."""
    bounds = np.cumsum([0, *map(len, texts)])
    found, entries = suffix.parse(np.frombuffer(b"".join(texts), np.uint8), bounds), {}
    for start, strings, trigger in zip(*(column.tolist() for column in found)):
        doc = int(np.searchsorted(bounds, start, "right")) - 1
        start -= int(bounds[doc])
        entries.setdefault((trigger, texts[doc][start : start + strings + LENGTH - 1]), (doc, start, strings))
    return entries


def shared(entries):
    """Entries that share a trigger, in order of trigger, as ``_by_suffix`` gets them; and the others."""
    triggers = [trigger for trigger, _ in entries]
    rows = sorted((t, *entries[t, data][:2], data) for t, data in entries if triggers.count(t) > 1)
    kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int32(), pa.binary()]
    columns = zip(*((t, 0, False, doc, start, data) for t, doc, start, data in rows))
    alone = [place for (t, _), place in entries.items() if triggers.count(t) == 1]
    columns = list(columns) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], list("abcdef")), alone


def new_places(texts):
    rows, alone = shared(parsed(texts))
    places = [(doc, start + k) for doc, start, strings in alone for k in range(strings)]
    for part in suffix._by_suffix(iter(rows.num_rows and [rows] or []), LENGTH):
        for doc, start, stop, *_ in zip(*(column.to_pylist() for column in part.columns)):
            places += [(doc, k) for k in range(start, stop)]
    return places


def brute_places(texts):
    seen = {}
    for doc, data in enumerate(texts):
        for start in range(len(data) - LENGTH + 1):
            seen.setdefault(data[start : start + LENGTH], (doc, start))
    return sorted(seen.values())


def some_bytes(seed, size):
    return bytes(random.Random(seed).choices(range(256), k=size))


@pytest.mark.parametrize("chunk", [1, 60, 1 << 15])
@pytest.mark.parametrize("letters", [b"a", b"\0", b"\0a", b"abcdefgh "])
def test_new_strings_of_documents_parsed_together(monkeypatch, chunk, letters):
    monkeypatch.setattr(suffix, "_CHUNK", chunk)
    rng = random.Random(chunk)
    passages = [bytes(rng.choices(letters, k=size)) for size in (1, 60, 99, 100, 101, 230)]
    texts = [b"", b"x" * 99, b""]
    for _ in range(25):
        parts = [bytearray(rng.choice(passages)) for _ in range(rng.randint(0, 5))]
        for part in parts:
            part[rng.randrange(len(part))] = rng.choice(letters)
        texts.append(b"".join(parts))
    places = new_places(texts)
    assert sorted(places) == brute_places(texts)


def test_phrases_do_not_depend_on_chunks_or_neighbours(monkeypatch):
    texts = [some_bytes(k, size) for k, size in enumerate([500, 0, 99, 100, 3000, 150])]
    expected = parsed(texts)
    alone = [key for text in texts for key in parsed([text])]
    monkeypatch.setattr(suffix, "_CHUNK", 13)
    assert parsed(texts) == expected and list(expected) == alone


def test_only_strings_that_may_be_equal_are_put_in_order(monkeypatch):
    sizes, ranks = [], suffix.suffix_ranks

    def counted(data, length):
        sizes.append(len(data))
        return ranks(data, length)

    monkeypatch.setattr(suffix, "suffix_ranks", counted)
    kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int32(), pa.binary()]
    for size, places in [(90, 40 * 77), (100, 39 * 76 + 77)]:
        # Entries of 77 strings, the trigger 76 bytes after the first and amid what they have in common.
        common = some_bytes(f"common {size}", size)
        trigger = int(suffix._rolling(np.frombuffer(common, np.uint8))[30:31].view(np.int64)[0])
        around = [(some_bytes(f"before {k}", 45) + bytes([k]), bytes([k]) + some_bytes(f"after {k}", 129 - size)) for k in range(40)]
        texts = [before + common + after for before, after in around]
        columns = zip(*((trigger, 0, False, k, 0, text) for k, text in enumerate(texts)))
        rows = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], list("abcdef"))
        sizes.clear()
        found = list(suffix._by_suffix(iter([rows]), LENGTH))
        assert sum(sum(part.column(2).to_pylist()) - sum(part.column(1).to_pylist()) for part in found) == places
        assert sum(sizes) == (40 * size if size >= LENGTH else 0)  # a passage shorter than a string repeats nothing


def test_entries_of_many_documents_come_in_few_batches():
    texts = [some_bytes(k, 100).hex() for k in range(300)]
    spans = [[{"trigger": k, "entries": 1 + 4096 * (k % 2), "start": k % 50, "strings": 3}] for k in range(300)]
    kind = pa.list_(pa.struct([("trigger", pa.int64()), ("entries", pa.int64()), ("start", pa.int32()), ("strings", pa.int32())]))
    columns = [pa.array(range(300), pa.int64()), pa.array(texts), pa.array(spans, kind)]
    part = pa.RecordBatch.from_arrays(columns, ["doc", "text", "spans"])
    found = list(suffix._entries(iter([part.slice(100)]), LENGTH, 4096))
    assert len(found) == 1
    assert found[0].column(5).to_pylist() == [texts[k][k % 50 : k % 50 + 102].encode() for k in range(100, 300)]
    assert found[0].column(2).to_pylist() == [k % 2 == 1 for k in range(100, 300)]
