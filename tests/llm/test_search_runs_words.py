"""Neighbours, periodic runs and spelling variants: the registered queries on whole small tables, and odd rows, against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from outpour.llm import neighbours, periodic, queries, spelling

SF_DIR = "/root/testdata/sf0.001"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
PAIRS = "vec_id long, embedding array<double>, rank string, extra string"


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


# --- neighbours --------------------------------------------------------------------------------


def brute_neighbours(rows, asked, k):
    """query -> [(score, id)], best first."""
    found = {}
    for query, vector in rows:
        if asked(query):
            scored = [(float(vector @ other / (np.linalg.norm(vector) * np.linalg.norm(other))), one) for one, other in rows if one != query]
            found[query] = sorted(scored, key=lambda pair: (-pair[0], pair[1]))[:k]
    return found


def by_query(df):
    found = defaultdict(list)
    for row in df.collect():
        found[row["query_id"]].append((row["rank"], row["vec_id"], row["score"]))
    return {query: sorted(rows) for query, rows in found.items()}


def recall(found, expected):
    hits = sum(len({row[1] for row in found[q]} & {one for _, one in rows}) for q, rows in expected.items())
    return hits / sum(map(len, expected.values()))


def test_neighbours_of_the_whole_table(spark):
    df = queries.op11_neighbours(spark, SF_DIR)
    assert dict(df.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}
    rows = [(row[0], np.array(row[1], float)) for row in table(spark, "embeddings").select("vec_id", "embedding").collect()]
    expected, found = brute_neighbours(rows, lambda one: one % 50 == 0, 5), by_query(df)
    assert found.keys() == expected.keys()
    assert recall(found, expected) >= 0.95
    vectors = dict(rows)
    for query, best in found.items():
        assert [row[0] for row in best] == [1, 2, 3, 4, 5]
        assert best == sorted(best, key=lambda row: (-row[2], row[1]))
        for _, one, score in best:
            x, y = vectors[query], vectors[one]
            assert score == pytest.approx(float(x @ y / np.linalg.norm(x) / np.linalg.norm(y)), abs=1e-12)


def test_neighbours_in_clusters_copies_and_lots(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 24))
    vectors = [centres[k % 12] + rng.normal(size=24) * 0.2 for k in range(1500)]
    vectors += [vectors[7].copy() for _ in range(400)]  # one vector has a fifth of all rows
    rows = list(enumerate(vectors))
    df = spark.createDataFrame([(one, vector.tolist(), "r", None) for one, vector in rows], PAIRS).repartition(7)
    small = by_query(neighbours.nearest(df, F.col("vec_id") % 40 == 0, k=5, lot=200))
    large = by_query(neighbours.nearest(df, F.col("vec_id") % 40 == 0, k=5))
    expected = brute_neighbours(rows, lambda one: one % 40 == 0, 5)
    assert small == large and recall(small, expected) >= 0.9
    copies = [one for one in small if one >= 1500]
    assert copies and all([row[1] for row in small[one]] == [7, 1500, 1501, 1502, 1503] for one in copies if one > 1503)


def test_neighbours_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0, 0.0]), (1, [1.0, 1.0, 0.0]), (2, [-2.0, 0.0, 0.0]), (3, None), (4, [0.0, 0.0, 0.0]),
        (5, [1.0, None, 0.0]), (6, [nan, 1.0, 0.0]), (7, [inf, 1.0, 0.0]), (8, [1.0, 0.0]), (None, [1.0, 0.0, 0.0]),
        (9, [2.0, 2.0, -0.0]), (1, [1.0, 1.0, 0.0]), (10, [1e-200, 0.0, 0.0]), (0, [1.0, 0.0, 0.0]), (11, []),
    ]
    df = spark.createDataFrame([(one, vector, "r", "x") for one, vector in rows], PAIRS)
    found = by_query(neighbours.nearest(df, F.col("vec_id").isin(0, 3, 8), k=5))
    assert list(found) == [0]
    assert [(row[0], row[1]) for row in found[0]] == [(1, 1), (2, 9), (3, 2)] or [row[1] for row in found[0]] == [10, 1, 9, 2]
    assert neighbours.nearest(df.limit(0), F.lit(True)).collect() == []
    assert neighbours.nearest(df, F.lit(False)).collect() == []
    assert neighbours.nearest(df.where("vec_id = 0"), F.lit(True)).collect() == []


def test_every_code_within_the_radius_is_found():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 1 << 16, (600, 4)).astype(np.uint16)
    codes[300:] = codes[:300]
    for k in range(300, 600):
        for bit in rng.choice(64, rng.integers(0, 20), replace=False):
            codes[k, bit // 16] ^= np.uint16(1 << (bit % 16))
    index = neighbours._Index(codes)
    for radius in (0, 1, 3, 4, 7, 10, 17, 40, 64):
        for code in codes[::97]:
            apart = [bin(int(x)).count("1") for x in (codes ^ code).astype(np.uint64) @ np.array([1 << 48, 1 << 32, 1 << 16, 1], np.uint64)]
            assert index.within(code, radius).tolist() == [k for k, bits in enumerate(apart) if bits <= radius]


# --- periodic runs -----------------------------------------------------------------------------


def brute_runs(words):
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            stretch = words[start : i + q]
            if len(stretch) >= max(6, 4 * q) and not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                found.append((start, len(stretch), q))
    return sorted(found, key=lambda run: (run[0], run[2]))


def brute_collapsed(words, runs):
    gone = {place for start, length, q in runs for place in range(start + q, start + length)}
    return " ".join(word for place, word in enumerate(words) if place not in gone)


def planted_words(doc_id, text):
    words = SPACE.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [word if i < a else words[a + (i - a) % p] for i, word in enumerate(words)]
    return words


def test_runs_of_the_whole_table(spark):
    df = queries.op12_periodic(spark, SF_DIR)
    assert [kind for _, kind in df.dtypes] == ["bigint"] * 6 + ["string"] * 2
    found = {row["doc_id"]: tuple(row[1:]) for row in df.collect()}
    docs, planted = table(spark, "documents").select("doc_id", "text").collect(), 0
    for doc_id, text in docs:
        words = planted_words(doc_id, text)
        if len(words) > 3000:
            continue  # too long for the brute force; test_runs_of_arrays has long arrays
        runs = brute_runs(words)
        planted += bool(runs)
        best = max(runs, key=lambda run: (run[1] / run[2], -run[0], -run[2])) if runs else (None,) * 3
        listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        digests = [hashlib.sha256(text.encode()).hexdigest() for text in (listed, brute_collapsed(words, runs))]
        milli = 1000 * best[1] // best[2] if runs else None
        assert found[doc_id] == (len(runs), *best, milli, *digests), doc_id
    assert planted > 5 and len(found) == len(docs)


def test_runs_of_arrays():
    rng = random.Random(1)
    for _ in range(1500):
        n, letters = rng.randint(0, 70), rng.choice([1, 2, 2, 3, 5])
        words = [rng.randrange(letters) for _ in range(n)]
        if n and rng.random() < 0.6:
            period, begin = rng.randint(1, 12), rng.randrange(n)
            for i in range(begin, n):
                words[i] = words[begin + (i - begin) % period]
            if rng.random() < 0.3:
                words[rng.randrange(n)] = 7
        assert periodic.runs_of(np.array(words, np.int32)) == brute_runs(words)
    assert periodic.runs_of(np.arange(300_000) % 70_000) == [(0, 300_000, 70_000)]
    assert periodic.runs_of(np.zeros(200_000, int)) == [(0, 200_000, 1)]
    with pytest.raises(ValueError):
        periodic.runs_of(np.zeros(9, int), times=3)


def test_runs_of_odd_rows(spark):
    rows = [
        (1, None, "x"), (2, [], None), (3, ["a"] * 5, "x"), (4, ["a"] * 6, "x"), (4, ["a"] * 6, "x"),
        (None, ["a", "b"] * 4 + ["c"], "x"), (6, [None] * 8, "x"), (7, ["a", "b"] * 40_000, "x"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text array<string>, collapsed string")
    found = periodic.collapse(df, F.col("text"), df.columns).collect()
    got = sorted((str(row["doc_id"]), [tuple(run) for run in row["runs"]], row["collapsed"]) for row in found)
    assert got == [
        ("1", [], ""), ("2", [], ""), ("3", [], "a a a a a"), ("4", [(0, 6, 1)], "a"), ("4", [(0, 6, 1)], "a"),
        ("6", [(0, 8, 1)], ""), ("7", [(0, 80_000, 2)], "a b"), ("None", [(0, 8, 2)], "a b c"),
    ]
    assert periodic.collapse(df.limit(0), F.col("text"), ["doc_id"]).collect() == []


# --- spelling ----------------------------------------------------------------------------------


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_variants(counts):
    by_part, near = defaultdict(set), defaultdict(set)
    for word in counts:
        for k in range(len(word)):
            by_part[word[:k] + word[k + 1 :]].add(word)
            by_part[(k, word[:k], word[k + 1 :])].add(word)
        by_part[word].add(word)
    for words in by_part.values():
        for word in words:
            near[word] |= {other for other in words if one_edit(word, other)}
    form = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda other: (-counts[other], other), default=None)
        form[word] = best if best is not None and counts[best] >= 10 * n else None

    def root(word):
        return word if form[word] is None else root(form[word])

    return {w: (form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()}


def test_variants_of_the_whole_table(spark):
    df = queries.op13_spelling(spark, SF_DIR)
    assert df.dtypes == [(c, "string") for c in ("word", "form", "root")] + [(c, "bigint") for c in ("n", "n_near", "form_n")]
    counts = Counter()
    for doc_id, text in table(spark, "documents").select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda letter: letter.group().lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    counts = {word: n for word, n in counts.items() if len(word) >= 7 and n >= 2}
    rows = df.collect()
    assert len(rows) == len(counts)
    assert {row["word"]: tuple(row[1:]) for row in rows} == brute_variants(counts)


@pytest.mark.parametrize("tile", [3, 1024])
def test_variants_in_tiles(spark, tile):
    rng = random.Random(4)
    words = set()
    while len(words) < 260:
        base = "prefix" + "".join(rng.choice("ab") for _ in range(rng.randint(1, 7)))
        words.add(base if rng.random() < 0.6 else base[::-1])
    words |= {"\U0001f600abcdef", "\U0001f601abcdef", "abcdef￿￿", "abcdef￿", "aaaaaaa", "aaaaaaaa", "x" * 5000, "x" * 4999}
    counts = {word: rng.choice([2, 3, 20, 30, 250, 2600]) for word in sorted(words)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    rows = spelling.variants(df, tile=tile).collect()
    assert len(rows) == len(counts)
    assert {row["word"]: tuple(row[1:]) for row in rows} == brute_variants(counts)


def test_variants_of_odd_rows(spark):
    rows = [(1, None), (2, []), (3, ["", None, "short", "sevenss", "sevenss"]), (None, ["sevenxs"] * 30), (3, ["sevenss"])]
    df = spark.createDataFrame(rows, "doc_id long, text array<string>")
    found = spelling.variants(spelling.vocabulary(df, F.col("text"))).collect()
    assert sorted(map(tuple, found)) == [("sevenss", "sevenxs", "sevenxs", 3, 1, 30), ("sevenxs", None, "sevenxs", 30, 1, None)]
    assert spelling.variants(spelling.vocabulary(df.limit(0), F.col("text"))).collect() == []
