"""Nearest neighbours by cosine: multi-index hashing of learned binary codes.

Codes. On a bounded sample (``SAMPLE_ROWS`` vectors, fewer if vectors are long) ``ROTATIONS`` rotations are learned: the principal
axes of the sample, turned until the signs of the turned vectors fit them best (iterative quantisation), each from another start. The
signs of a vector under all rotations are its code, in substrings of ``BITS`` bits. The sample also tells how far codes of
a given angle differ in bits (mean and deviation).

Radius. A query's k-th best cosine within the sample is a lower bound of its k-th best of all, so the angle of what is sought is
bounded, and so, by the learned mean and ``DEVIATIONS`` deviations, is the Hamming distance. That is the query's radius.

Index. Different vectors are entries (equal ones are one entry with the k + 1 smallest ids, which is all that a rank up to k can
need), dealt out in lots of at most about ``LOT`` by a hash. In a lot every substring has an index: its values in order, with the
entries that have them. Pigeonhole: of m substrings, a code within radius r differs from the query's by r // m bits or fewer in
one of the first r % m + 1, or by fewer than r // m in one of the others. All values within that distance are probed: one by
one, or by a pass over the values that occur if there are fewer of those. What is found is held against the radius by the
whole code, and the rest is ranked by the cosine of the vectors themselves in double precision.

Every entry is indexed and no list is cut. Each lot hands on its k best of each query and the best of all lots are the result. Queries
meet all lots, entries meet queries only within theirs: the shuffle is one row for each entry and one for each query and lot.

Vectors that are null, zero or hold null or non-finite components take no part, nor do rows with a null id or with another number of
components than most have (ties: the fewer). A row is known by its id: rows that repeat an id are one neighbour, at the best of
their scores, and no neighbour of their own; as a query the smallest of their vectors counts. Vectors are held to be equal by 128
bits of hash. Tables without vectors or queries have no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outpour.llm.store import ship, written

SAMPLE_ROWS = 8192
SAMPLE_BYTES = 8 << 20
ROTATIONS = 4
ROUNDS = 25
BITS = 16
DEVIATIONS = 2.0
LOT = 16384
_ONES = np.array([bin(value).count("1") for value in range(1 << BITS)], np.uint8)


@dataclass(frozen=True)
class Model:
    """Rotations, beside each other as columns, and what the sample says of angles and bits."""

    centre: np.ndarray
    turn: np.ndarray
    offset: float
    deviation: float
    sample: np.ndarray
    units: np.ndarray
    ids: list[list[int]]

    @property
    def bits(self) -> int:
        return self.turn.shape[1]

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Substrings of the code of each vector."""
        bits = _units(vectors) @ self.turn > self.centre @ self.turn
        return np.ascontiguousarray(np.packbits(bits, axis=1)).view(np.uint16)

    def radius(self, cosine: float) -> int:
        """Most differing bits that the codes of vectors of this cosine or more are taken to have."""
        share = math.acos(min(1.0, max(-1.0, cosine))) / math.pi
        most = self.bits * share + self.offset + DEVIATIONS * self.deviation * _scale(share)
        return min(self.bits, math.ceil(most))


def _units(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)  # squares of very large or small numbers are out of range
    scaled = vectors / largest
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _scale(share):
    """How the deviation of differing bits goes with the share of them that differ."""
    return np.sqrt(np.maximum(share * (1 - share), 0.01))


def learn(sample: np.ndarray, ids: list[list[int]], seed: int = 7) -> Model:
    """Rotations and calibration from a sample of different vectors and their ids."""
    rng = np.random.default_rng(seed)
    units = _units(sample)
    centre, size = units.mean(axis=0), units.shape[1]
    moved = units - centre
    axes = np.linalg.eigh(moved.T @ moved)[1][:, ::-1]
    projected, turns = moved @ axes, []
    while sum(turn.shape[1] for turn in turns) < max(ROTATIONS * size, BITS):
        rotation = np.linalg.qr(rng.normal(size=(size, size)))[0]
        for _ in range(ROUNDS):
            left, _, right = np.linalg.svd(np.sign(projected @ rotation).T @ projected)
            rotation = (left @ right).T
        turns.append(axes @ rotation)
    turn = np.concatenate(turns, axis=1)
    turn = turn[:, : turn.shape[1] // BITS * BITS]
    model = Model(centre, turn, 0.0, 0.0, sample, units, ids)
    # How far the codes of near vectors differ from what their angle says: of some, the 20 nearest in the sample.
    some = rng.permutation(len(units))[:512]
    cosine = units[some] @ units.T
    cosine[np.arange(len(some)), some] = -2
    near = np.argsort(-cosine, axis=1)[:, : min(20, len(units) - 1)]
    codes = model.codes(sample)
    differing = _ONES[codes[some][:, None, :] ^ codes[near]].sum(axis=2, dtype=np.int64)
    share = np.arccos(np.clip(np.take_along_axis(cosine, near, axis=1), -1, 1)) / math.pi
    rest = differing - model.bits * share
    offset = max(0.0, float(rest.mean())) if rest.size else 0.0
    deviation = float(np.sqrt(np.mean(((rest - offset) / _scale(share)) ** 2))) if rest.size else 0.0
    # A sample too small to tell has the deviation of independent bits at least.
    deviation = max(deviation, math.sqrt(model.bits) if len(units) < 100 else 0.0)
    return Model(centre, turn, offset, deviation, sample, units, ids)


def _entries(rows: DataFrame, keep: int) -> DataFrame:
    """h1, h2, vector and ids (the ``keep`` smallest) of each different vector."""
    key = [F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), "vector").alias("h2")]
    rows = rows.select("id", F.transform("vector", lambda x: x + F.lit(0.0)).alias("vector"))  # -0 becomes 0
    vectors = rows.groupBy(*key).agg(F.first("vector").alias("vector"))
    # Spark limits each task's rows of a key before it shuffles them.
    place = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id"))
    ids = rows.select("id", *key).distinct().withColumn("place", place).where(F.col("place") <= keep)
    ids = ids.groupBy("h1", "h2").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return vectors.join(ids, ["h1", "h2"])


def nearest(
    rows: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = 5,
    lot: int = LOT,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row with ``is_query`` the ``k`` nearest other rows found."""
    spark = rows.sparkSession
    ship(spark)
    marked = rows.select(
        F.col(id_column).alias("id"), F.col(vector_column).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asked")
    )
    taken = usable(marked)
    entries = written(_entries(taken, k + 1), "vector-entries")
    count = entries.count()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = len(entries.select("vector").first()["vector"])
    # The order of hashes is that of a draw; at most this many rows come to the driver.
    most = max(2, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * size)))
    drawn = entries.orderBy("h1", "h2").limit(most).collect()
    model = learn(np.array([row["vector"] for row in drawn]), [row["ids"] for row in drawn])
    shared = spark.sparkContext.broadcast(model)

    asked = taken.where("asked").groupBy("id").agg(F.min("vector").alias("vector"))
    asked = asked.mapInArrow(
        lambda parts: _bounded(parts, shared.value, k),
        "id long, vector array<double>, radius int, seeds array<struct<id:long,score:double>>",
    )
    asked = written(asked, "vector-queries")
    lots = max(-(-count // lot), min(spark.sparkContext.defaultParallelism, -(-count // 1024)))
    nothing = F.lit(None).cast("long")
    placed = entries.select(F.pmod("h1", F.lit(lots)).alias("lot"), nothing.alias("query"), F.lit(0).alias("radius"), "ids", "vector")
    each_lot = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lots - 1).cast("long"))).alias("lot")
    met = asked.select(each_lot, F.col("id").alias("query"), "radius", F.array().cast("array<bigint>").alias("ids"), "vector")
    ordered = placed.unionByName(met).repartition(lots, "lot").sortWithinPartitions("lot", F.asc_nulls_first("query"))
    found = ordered.mapInArrow(lambda parts: _search(parts, shared.value, size, k), "query_id long, vec_id long, score double")
    seeds = asked.select(F.col("id").alias("query_id"), F.inline("seeds")).withColumnRenamed("id", "vec_id")
    pairs = found.unionByName(seeds).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def usable(rows: DataFrame) -> DataFrame:
    """The rows (id, vector, asked) that take part, ids as longs and vectors as doubles."""
    rows = rows.select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"), "asked")
    finite = "forall(vector, x -> coalesce(not isnan(x) and abs(x) < double('infinity'), false))"
    rows = rows.where(f"id is not null and size(vector) > 0 and {finite} and exists(vector, x -> x <> 0)")
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    usual = sizes.orderBy(F.desc("n"), "size").first()
    return rows.where(F.size("vector") == (usual["size"] if usual else 0))


def cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine of a vector with each row in double precision, by the same sums wherever two vectors meet."""
    lengths = np.sqrt(np.einsum("ij,ij->i", rows, rows)) * np.sqrt(np.einsum("ij,ij->i", query[None], query[None]))
    return np.einsum("ij,j->i", rows, query) / lengths


def _best(query: int, ids: list[list[int]], scores: np.ndarray, k: int) -> list[tuple[float, int]]:
    """The k best (score, id) of entries' ids, without the query's own; an id counts once."""
    best: dict[int, float] = {}
    # Entries below the k-th of those that have another id cannot matter, but for ids that are in several.
    for place in np.argsort(-scores, kind="stable").tolist():
        score = float(scores[place])
        if len(best) >= k and score < sorted(best.values())[-k]:
            break
        for one in ids[place]:
            if one != query:
                best.setdefault(one, score)
    return sorted(((score, one) for one, score in best.items()), key=lambda pair: (-pair[0], pair[1]))[:k]


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _bounded(parts: Iterator[pa.RecordBatch], model: Model, k: int) -> Iterator[pa.RecordBatch]:
    """Queries with their radius, and their best in the sample."""
    size = model.sample.shape[1]
    pair = pa.list_(pa.struct([("id", pa.int64()), ("score", pa.float64())]))
    for part in parts:
        vectors, radii, seeds = _matrix(part.column(1), size), [], []
        for query, vector in zip(part.column(0).to_pylist(), vectors):
            rough = model.units @ vector
            near = np.argsort(-rough, kind="stable")[: 2 * k + 2]
            best = _best(query, [model.ids[place] for place in near.tolist()], cosines(vector, model.sample[near]), k)
            radii.append(model.radius(best[-1][0]) if len(best) == k else model.bits)
            seeds.append([{"id": one, "score": score} for score, one in best])
        columns = [part.column(0), part.column(1), pa.array(radii, pa.int32()), pa.array(seeds, pair)]
        yield pa.RecordBatch.from_arrays(columns, ["id", "vector", "radius", "seeds"])


class _Index:
    """The entries of a lot under each substring of their codes."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.words = codes.view(np.uint64) if codes.shape[1] % 4 == 0 else None
        self.values, self.members, self.edges, self.of = [], [], [], []
        for substring in codes.T:
            values, of = np.unique(substring, return_inverse=True)
            self.values.append(values)
            self.of.append(of)
            self.members.append(np.argsort(of, kind="stable"))
            self.edges.append(np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(values)))]))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Entries whose codes differ in ``radius`` bits or fewer."""
        share, more = divmod(radius, len(code))
        marked = np.zeros(len(self.codes), bool)
        for j, value in enumerate(code):
            reach = share if j <= more else share - 1
            if reach < 0:
                continue
            masks = _masks(min(reach, BITS))
            if len(masks) < len(self.values[j]):
                probes = masks ^ value
                places = np.searchsorted(self.values[j], probes)
                places = places[self.values[j][np.minimum(places, len(self.values[j]) - 1)] == probes]
                for place in places.tolist():
                    marked[self.members[j][self.edges[j][place] : self.edges[j][place + 1]]] = True
            else:
                marked |= (_ONES[self.values[j] ^ value] <= reach)[self.of[j]]
        candidates = np.flatnonzero(marked)
        if self.words is not None:
            differing = np.bitwise_count(self.words[candidates] ^ code.view(np.uint64)).sum(axis=1, dtype=np.int64)
        else:
            differing = _ONES[self.codes[candidates] ^ code].sum(axis=1, dtype=np.int64)
        return candidates[differing <= radius]


@lru_cache(maxsize=None)
def _masks(reach: int) -> np.ndarray:
    """All patterns of a substring's bits with ``reach`` ones or fewer."""
    return np.flatnonzero(_ONES <= reach).astype(np.uint16)


def _search(parts: Iterator[pa.RecordBatch], model: Model, size: int, k: int) -> Iterator[pa.RecordBatch]:
    """The best of each query in its lot; a lot's entries come before its queries."""
    lot, held, index, ids, vectors = None, [], None, [], None
    for part in parts:
        lots = part.column(0).to_numpy()
        is_query = part.column(1).is_valid().to_numpy(zero_copy_only=False)
        changes = np.flatnonzero((lots[1:] != lots[:-1]) | (is_query[1:] != is_query[:-1])) + 1
        edges = [0, *changes.tolist(), part.num_rows]
        rows: list[tuple[int, int, float]] = []
        for start, stop in zip(edges, edges[1:]):
            if start == stop:
                continue
            if lots[start] != lot:
                lot, held, index = lots[start], [], None
            some = part.slice(start, stop - start)
            if not is_query[start]:
                held.append(some)
                continue
            if index is None and held:
                ids = [one for piece in held for one in piece.column(3).to_pylist()]
                vectors = np.concatenate([_matrix(piece.column(4), size) for piece in held])
                index, held = _Index(model.codes(vectors)), []
            if index is None:
                continue
            asked = _matrix(some.column(4), size)
            radii, codes = some.column(2).to_pylist(), model.codes(asked)
            for n, query in enumerate(some.column(1).to_pylist()):
                near = index.within(codes[n], radii[n])
                best = _best(query, [ids[place] for place in near.tolist()], cosines(asked[n], vectors[near]), k)
                rows += [(query, one, score) for score, one in best]
        if rows:
            kinds = [pa.int64(), pa.int64(), pa.float64()]
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])
