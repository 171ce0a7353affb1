"""Toxicity by class-conditional Kneser-Ney models of bytes.

Two models, of toxic and of ordinary labelled texts, say how likely an n-gram of bytes of lower-cased text is. A model
discounts the number of texts of its class that have the n-gram and gives what it takes to a backoff whose counts are
shared: continuation counts, in how many contexts the rest of the n-gram occurs in both classes together. So an
expression that is rare in one class is smoothed by all of the corpus, and one that is in no labelled text says nothing.
An expression is a stretch of WINDOW n-grams; its evidence is the toxic less the ordinary log-likelihood, divided by its
length. A text is as toxic as its most toxic expression (a mean over the whole text would drown a few words in a long
one), and a logistic curve makes this a score.

Counts cover all labelled texts, whole. They and what is derived from them are tables of n-grams, reduced by aggregates
and joins, and grow with the labelled texts; every n-gram keeps its own log-ratio, exactly. The ratios of the ``frequent``
n-grams that occur in most texts (at most that many, 12 to 16 bytes each) go to the executors as a quotient table. Where
there are more, the rest stays a written table: pieces of texts look up the n-grams that the quotient table lacks by a join, so each n-gram with
very many occurrences is found without a shuffle, and scores do not depend on the bound. The curve alone is fitted on a
bounded sample: at most ``max_rows`` texts of each class of one half of the labelled texts, drawn by a hash and scored by
a model of the other half.

Null and empty texts have no evidence; their score is the curve's at zero. Null labels and labels without a text are not
learned from; a repeated id counts with its largest label. Without texts of both classes every score is 0.
An empty table gives no rows; columns of ``carry`` named score or predicted are replaced. Ties (0.5) are predicted 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from outpour.llm.store import discard, gate, gated, ship, written

ORDER = 6
WINDOW = 6
DISCOUNT = 0.75
#: Texts that the backoff stands for: at least, and for each context of the rest of the n-gram.
BACKOFF = 2.0
CONTINUATION = 0.1
#: Most n-grams that are broadcast.
FREQUENT = 1 << 23
MAX_ROWS = 4000
_LOT = 1 << 23
_CHUNK = 1 << 12
_PIECE = 1 << 16
_SPREAD = 0x9E3779B97F4A7C15
_BITS = 8 * ORDER
_MASK = (1 << _BITS) - 1


def _padded(text: str) -> bytes:
    return ("\n" * (ORDER - 1) + text.lower()).encode("utf-8", "surrogatepass")


def _codes(padded: bytes) -> np.ndarray:
    """The last ORDER bytes at each byte, as one number."""
    data = np.frombuffer(padded, np.uint8).astype(np.uint64)
    size = len(data) - ORDER + 1
    code = data[:size].copy()
    for k in range(1, ORDER):
        code <<= np.uint64(8)
        code |= data[k : k + size]
    return code


def _pieces(text: str, size: int) -> Iterator[bytes]:
    """A text in stretches that hold ``size`` first n-grams of expressions each; every expression is in one of them."""
    data = _padded(text)
    for start in range(0, max(1, len(data) - ORDER - WINDOW + 2), size):
        yield data[start : start + size + ORDER + WINDOW - 2]


def _strongest(ratio: np.ndarray) -> float:
    """The largest mean of an expression, the mean of all if they are fewer n-grams than one."""
    count = max(1, len(ratio) - WINDOW + 1)
    sums = ratio[:count].astype(np.float64)
    for k in range(1, min(WINDOW, len(ratio))):
        sums += ratio[k : k + count]
    return float(sums.max()) / min(WINDOW, len(ratio))


def _mixed(code: np.ndarray) -> np.ndarray:
    """Another number below 2^48 for each code, spread over all of them (the factor is odd, so none is met twice)."""
    return (code * np.uint64(_SPREAD)) & np.uint64(_MASK)


@dataclass(frozen=True)
class Ratios:
    """An exact map from n-grams to log-ratios: the high bits of a mixed code are a bucket, the low ones are stored.

    ``starts`` has the first place of each bucket and one more; a bucket holds one n-gram or less on average.
    """

    starts: np.ndarray
    low: np.ndarray
    ratio: np.ndarray

    @staticmethod
    def of(mixed: np.ndarray, ratio: np.ndarray) -> Ratios:
        """``mixed``: ascending."""
        bits = min(_BITS, max(_BITS - 32, len(mixed).bit_length()))
        bucket = (mixed >> np.uint64(_BITS - bits)).astype(np.int64)
        starts = np.zeros((1 << bits) + 1, np.uint32)
        starts[1:] = np.cumsum(np.bincount(bucket, minlength=1 << bits))
        return Ratios(starts, (mixed & np.uint64((1 << (_BITS - bits)) - 1)).astype(np.uint32), ratio)

    def find(self, code: np.ndarray) -> np.ndarray:
        """The ratio of each code; NaN where it is not in the table."""
        bits = (len(self.starts) - 1).bit_length() - 1
        mixed = _mixed(code)
        bucket = (mixed >> np.uint64(_BITS - bits)).astype(np.int64)
        at, end = self.starts[bucket], self.starts[bucket + 1]
        found = np.full(len(code), np.nan, np.float32)
        open_ = np.flatnonzero(at < end)
        at, end = at[open_], end[open_]
        low = (mixed[open_] & np.uint64((1 << (_BITS - bits)) - 1)).astype(np.uint32)
        while len(open_):
            hit = self.low[at] == low
            found[open_[hit]] = self.ratio[at[hit]]
            at = at + np.uint32(1)
            left = ~hit & (at < end)
            open_, at, end, low = open_[left], at[left], end[left], low[left]
        return found


def grams(labelled: DataFrame) -> DataFrame:
    """half, toxic, code and count (texts that have it) of the n-grams of all rows. ``labelled``: half (0 or 1), toxic (0 or 1), text."""

    def counted(codes: list[np.ndarray]) -> pa.RecordBatch:
        code, count = np.unique(np.concatenate(codes), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array(count)], ["key", "count"])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: list[np.ndarray] = []
        size = 0
        for part in parts:
            for half, toxic, text in zip(*(column.to_pylist() for column in part.columns)):
                codes.append(np.unique(_codes(_padded(text))) | np.uint64((2 * half + toxic) << (8 * ORDER)))
                size += len(codes[-1])
                if size > _LOT:
                    yield counted(codes)
                    codes, size = [], 0
        if codes:
            yield counted(codes)

    found = labelled.select("half", "toxic", "text").mapInArrow(batches, "key long, count long")
    found = found.groupBy("key").agg(F.sum("count").alias("count"))
    code = F.col("key").bitwiseAND(F.lit((1 << 8 * ORDER) - 1))
    kind = F.shiftright("key", 8 * ORDER)
    return found.select(
        F.shiftright(kind, 1).alias("half"), kind.bitwiseAND(F.lit(1)).alias("toxic"), code.alias("code"), "count"
    )


def _ratios(counts: DataFrame, texts: dict[int, int]) -> DataFrame:
    """A written table of code, ratio and weight. ``counts``: code, toxic (0 or 1), count; ``texts``: texts of each class."""
    number = lambda k: F.sum(F.when(F.col("toxic") == k, F.col("count")).otherwise(0)).cast("double")
    both = counts.groupBy("code").agg(number(1).alias("c1"), number(0).alias("c0"))
    both = both.withColumn("rest", F.col("code").bitwiseAND(F.lit((1 << 8 * (ORDER - 1)) - 1)))
    both = written(both, "class-counts")
    shared = written(both.groupBy("rest").agg(F.count(F.lit(1)).cast("double").alias("contexts")), "continuations")
    backoff = F.lit(BACKOFF) + F.lit(CONTINUATION) * F.col("contexts")
    whole = sum(texts.values())
    part = [F.greatest(F.col(f"c{k}") - DISCOUNT, F.lit(0.0)) / texts[k] + backoff / whole for k in (0, 1)]
    found = both.join(shared, "rest").select(
        "code", F.ln(part[1] / part[0]).alias("ratio"), (F.col("c1") + F.col("c0")).alias("weight")
    )
    found = written(found, "ratios")
    discard(both, shared)
    return found


def _table(ratios: DataFrame) -> Ratios:
    """The ratios as one table. ``ratios``: code and ratio, as many rows as may be broadcast."""
    count = ratios.count()
    shift = max(0, _BITS - max(0, (count // _CHUNK).bit_length()))

    def mixed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            code = _mixed(part.column(0).to_numpy().view(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(code), part.column(1)], ["mixed", "ratio"])

    def packed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = []
            for cells in part.column(1):
                code = cells.values.field("mixed").to_numpy()
                order = np.argsort(code)
                ratio = cells.values.field("ratio").to_numpy().astype(np.float32)
                rows.append((code[order].tobytes(), ratio[order].tobytes()))
            columns = [pa.array(list(column), pa.binary()) for column in zip(*rows)] or [pa.array([], pa.binary())] * 2
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["chunk", "mixed", "ratio"])

    cells = ratios.select("code", "ratio").mapInArrow(mixed, "mixed long, ratio double")
    cells = cells.groupBy(F.shiftright("mixed", shift).alias("chunk")).agg(F.collect_list(F.struct("mixed", "ratio")).alias("cells"))
    rows = sorted(cells.mapInArrow(packed, "chunk long, mixed binary, ratio binary").collect(), key=lambda row: row["chunk"])
    codes, values = (b"".join(bytes(row[name]) for row in rows) for name in ("mixed", "ratio"))
    return Ratios.of(np.frombuffer(codes, np.uint64), np.frombuffer(values, np.float32))


def _split(ratios: DataFrame, frequent: int) -> tuple[Ratios, DataFrame | None]:
    """The table of the n-grams of largest weight, at most ``frequent``, and the rows of the others, if any. ``ratios``: written."""
    level = F.floor(F.log2("weight") * 64)  # a few thousand levels, whatever the weights
    bar, total = 0, 0
    for row in ratios.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("level")).collect():
        total += row["n"]
        if total > frequent:
            bar = row["level"]
            break
    if total <= frequent:
        table = _table(ratios)
        discard(ratios)
        return table, None
    return _table(ratios.where(level > bar)), ratios.where(level <= bar).select("code", "ratio")


@dataclass(frozen=True)
class Model:
    """``ratios`` of n-grams that are broadcast, ``others`` (code, ratio) that are joined, and a logistic curve."""

    ratios: Ratios
    others: DataFrame | None = None
    slope: float = 1.0
    bias: float = 0.0
    known: bool = True


def _with_evidence(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with __evidence in place of __text: toxic less ordinary log-likelihood in the most toxic expression."""
    shared = rows.sparkSession.sparkContext.broadcast(model.ratios)
    kept = rows.drop("__text").schema
    names = kept.names
    if model.others is None:
        place = rows.columns.index("__text")

        def evidence(text: str | None) -> float:
            if not text:
                return 0.0
            return max(_strongest(np.nan_to_num(shared.value.find(_codes(piece)))) for piece in _pieces(text, _PIECE))

        def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                found = pa.array([evidence(text) for text in part.column(place).to_pylist()], pa.float64())
                columns = [part.column(k) for k in range(part.num_columns) if k != place]
                yield pa.RecordBatch.from_arrays([*columns, found], [*names, "__evidence"])

        return rows.mapInArrow(batches, StructType([*kept, *StructType.fromDDL("__evidence double")]))

    rows = written(rows.withColumn("__row", F.monotonically_increasing_id()), "texts-to-score")

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                for number, piece in enumerate(_pieces(text, _CHUNK) if text else ()):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row]), pa.array([number]), pa.array([piece], pa.binary())], ["row", "piece", "data"]
                    )

    def unknown(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row, number, data in zip(*(column.to_pylist() for column in part.columns)):
                code = np.unique(_codes(data))
                code = code[np.isnan(shared.value.find(code))].view(np.int64)
                same = [pa.array(np.full(len(code), value, np.int64)) for value in (row, number)]
                yield pa.RecordBatch.from_arrays([*same, pa.array(code)], ["row", "piece", "code"])

    def strongest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = []
            for data, cells in zip(part.column(1).to_pylist(), part.column(2)):
                code = _codes(data)
                ratio = shared.value.find(code)
                if cells.is_valid:
                    listed = cells.values.field("code").to_numpy().view(np.uint64)
                    order = np.argsort(listed)
                    place = np.minimum(np.searchsorted(listed[order], code), len(listed) - 1)
                    same = listed[order][place] == code
                    ratio[same] = cells.values.field("ratio").to_numpy()[order][place[same]]
                found.append(_strongest(np.nan_to_num(ratio)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.float64())], ["row", "x"])

    pieces = rows.select("__row", F.col("__text").cast("string")).mapInArrow(cut, "row long, piece long, data binary")
    pieces = written(pieces, "pieces-to-score")
    looked = pieces.mapInArrow(unknown, "row long, piece long, code long").join(model.others, "code")
    listed = looked.groupBy("row", "piece").agg(F.collect_list(F.struct("code", "ratio")).alias("cells"))
    scored = pieces.join(listed, ["row", "piece"], "left").select("row", "data", "cells").mapInArrow(strongest, "row long, x double")
    best = scored.groupBy(F.col("row").alias("__row")).agg(F.max("x").alias("__best"))
    joined = rows.join(best, "__row", "left")
    return joined.select(*[F.col(f"`{name}`") for name in names], F.coalesce("__best", F.lit(0.0)).alias("__evidence"))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str,
    text_column: str,
    label_column: str,
    max_rows: int = MAX_ROWS,
    frequent: int = FREQUENT,
) -> Model:
    """A model of the texts that have labels.

    ``max_rows`` bounds the sample for the curve, ``frequent`` the n-grams that are broadcast (not those that count).
    """
    spark = docs.sparkSession
    ship(spark)
    known = labels.where(F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull())
    known = known.groupBy(F.col(id_column).alias("__id")).agg(F.max(label_column).cast("int").alias("toxic"))
    known = written(known, "toxic-labels")
    texts = docs.select(F.col(id_column).alias("__id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    texts = gated(texts, gate(known.select("__id")), [F.col("__id")], "__maybe").where("__maybe")
    half = F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("half")  # equal texts fall into one half
    labelled = written(texts.join(known, "__id").select("text", "toxic", half), "labelled-texts")

    counts = written(grams(labelled), "grams")
    sizes = {row["toxic"]: row["n"] for row in labelled.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return Model(Ratios.of(np.zeros(0, np.uint64), np.zeros(0, np.float32)), known=False)
    halves = labelled.where("half = 0").groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    first = {0: 1, 1: 1} | {row["toxic"]: row["n"] for row in halves}
    trial = Model(*_split(_ratios(counts.where("half = 0"), first), frequent))
    # As many of each class as there are, within the bound, and the weights of the classes put right again.
    draw = F.pmod(F.xxhash64("text", F.lit(1)), F.lit(1 << 30)) / F.lit(1 << 30)
    shares = {k: min(1.0, max_rows / sizes[k]) for k in sizes}
    share = F.when(F.col("toxic") == 1, shares[1]).otherwise(shares[0])
    sample = labelled.where((F.col("half") == 1) & (draw < share)).limit(2 * max_rows)
    rows = _with_evidence(sample.select("toxic", F.col("text").alias("__text")), trial).collect()
    x, y = np.array([row["__evidence"] for row in rows]), np.array([row["toxic"] for row in rows], np.float64)
    slope, bias = _curve(x, y, np.where(y == 1, 1 / shares[1], 1 / shares[0])) if len(set(y)) == 2 else (1.0, 0.0)
    total = counts.groupBy("toxic", "code").agg(F.sum("count").alias("count"))
    model = Model(*_split(_ratios(total, sizes), frequent), slope, bias)
    discard(known, labelled, counts)
    return model


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and bias of a logistic curve (Newton's method), on standardised values."""
    mean, scale = x.mean(), x.std() or 1.0
    z, a, b = (x - mean) / scale, 0.0, 0.0
    weight = weight / weight.sum()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
        g, h = weight * (p - y), weight * p * (1 - p)
        ga, gb = (g * z).sum() + ridge * a, g.sum()
        haa, hab, hbb = (h * z * z).sum() + ridge, (h * z).sum(), h.sum() + 1e-9
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = min(1.0, 2.0 / max(abs(da), abs(db), 1e-12))
        a, b = a - step * da, b - step * db
        if abs(da) + abs(db) < 1e-9:
            break
    return float(a / scale), float(b - a * mean / scale)


def score_texts(docs: DataFrame, model: Model, text_column: str, carry: list[str]) -> DataFrame:
    """The columns of ``carry`` with score (0 to 1) and predicted (1 if score is at least 0.5)."""
    ship(docs.sparkSession)
    names = [name for name in carry if name not in ("score", "predicted")]
    rows = docs.select(*[F.col(f"`{name}`") for name in names], F.col(text_column).cast("string").alias("__text"))
    if model.known:
        rows = _with_evidence(rows, model)
        at = F.lit(model.slope) * F.col("__evidence") + F.lit(model.bias)
        score = 1 / (1 + F.exp(-F.greatest(F.least(at, F.lit(40.0)), F.lit(-40.0))))
    else:
        score = F.lit(0.0)
    scored = rows.select(*[F.col(f"`{name}`") for name in names], score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
