"""Packing of token ids into sequences by cutting-stock column generation.

A document is cut into full pieces of ``capacity`` ids, which are sequences of their own, and a remainder. What is left
is a cutting-stock problem whose whole input is the histogram of remainders by length class (``grain`` ids a class, so
at most ``capacity / grain`` numbers, whatever the corpus). Its linear program is solved on the driver by column
generation: a revised simplex over patterns (how many pieces of each class share a sequence), where dynamic programming
over the knapsack of one sequence prices new columns by the duals. Patterns are used as often as their rounded-down
solution says; the few pieces that rounding leaves are put into sequences one by one, largest first.

Pieces are numbered within their class without gathering a class: each task numbers its own and the counts of earlier
tasks are added from a small table. A piece's number then says which copy of which pattern it belongs to.

Every id of every document, the closing id included, lies in exactly one piece. Null texts count as empty and are the
closing id alone. Repeated rows are packed like any others; ids of documents may be null.
An empty table gives no pieces. Columns other than id and text are not looked at.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from outpour.llm.bpe import Encoder, read_ranks
from outpour.llm.store import ship, written

CLOSING_ID = 0
LONG_SPACE = 100_000
_SPACES = regex.compile(r"\s{64,}")


def added_tokens(tokenizer: bytes) -> dict[str, int]:
    """The tokens that a tokenizer's JSON adds to its vocabulary. The library matches them inside texts, special or not."""
    found = json.loads(tokenizer)["added_tokens"]
    for token in found:
        if token["single_word"] or token["lstrip"] or token["rstrip"]:
            raise ValueError(f"added token {token['content']!r} takes more than its own characters or needs borders")
    return {token["content"]: token["id"] for token in found}


def tiktoken_encoder(ranks: bytes, pattern: str, added: dict[str, int] | None = None) -> Callable[[str], np.ndarray]:
    """Encoder of whole texts to uint32 ids; texts are split at the tokens of ``added``, which have their own ids.

    The library's pattern fails on very long runs of white space; texts with such a run go through our own transducer.
    """
    import tiktoken

    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=read_ranks(ranks), special_tokens=added or {})
    own: list[Encoder] = []
    tokens = regex.compile("|".join(f"({regex.escape(token)})" for token in sorted(added or {}, key=len, reverse=True)) or "(?!)")

    def encode_spaces(text: str) -> list[int]:
        if not own:
            own.append(Encoder(read_ranks(ranks), pattern))
        ids: list[int] = []
        for part in tokens.splititer(text):
            if part:
                ids += [added[part]] if added and part in added else own[0].encode(part)
        return ids

    def encode(text: str) -> np.ndarray:
        if len(text) >= LONG_SPACE and max(map(len, _SPACES.findall(text)), default=0) >= LONG_SPACE:
            return np.array(encode_spaces(text), np.uint32)
        ids = encoding.encode(text, allowed_special="all") if added else encoding.encode_ordinary(text)
        return np.array(ids, np.uint32)

    return encode


def pieces(
    docs: DataFrame,
    id_column: str,
    text_column: str,
    make_encoder: Callable[[], Callable[[str], np.ndarray]],
    capacity: int = 1024,
    grain: int = 2,
) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, and class, part and place in both."""
    ship(docs.sparkSession)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part_number = make_encoder(), TaskContext.get().partitionId()
        seen = np.zeros(capacity // grain + 2, np.int64)
        for part in parts:
            rows: list[tuple] = []
            of: list[int] = []
            for k, text in enumerate(part.column(1).to_pylist()):
                ids = np.append(encode(text or ""), np.uint32(CLOSING_ID))
                data, size = ids.tobytes(), len(ids)
                for start in range(0, size, capacity):
                    length = min(capacity, size - start)
                    kind = -(-length // grain)
                    crc = zlib.crc32(data[4 * start : 4 * (start + length)])
                    rows.append((start, length, crc, size, kind, part_number, int(seen[kind])))
                    of.append(k)
                    seen[kind] += 1
            if rows:
                columns = [pa.array(column, pa.int64()) for column in zip(*rows)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(of)), *columns], out.names)

    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    numbers = "start long, length long, ids_crc32 long, doc_tokens long, kind long, part long, place long"
    out = StructType([rows.schema["doc_id"], *StructType.fromDDL(numbers)])
    return rows.mapInArrow(batches, out)


@dataclass(frozen=True)
class Layout:
    """For each run of pieces of one class that fill copies of one pattern: where they go."""

    kind: np.ndarray  # class; rising
    first: np.ndarray  # number of the first piece in its class; rising within a class
    sequence: np.ndarray  # sequence of the first copy
    each: np.ndarray  # pieces of the class in one copy
    slot: np.ndarray  # place of the class's first piece in the copy

    def place(self, kind: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and place in it of pieces."""
        base = np.int64(1) << 44
        run = np.searchsorted(self.kind * base + self.first, kind * base + number, side="right") - 1
        within = number - self.first[run]
        return self.sequence[run] + within // self.each[run], self.slot[run] + within % self.each[run]


def pack(found: DataFrame, capacity: int = 1024, grain: int = 2) -> DataFrame:
    """The pieces with sequence_id (from 0, gapless) and offset (gapless from 0 in each sequence)."""
    spark = found.sparkSession
    found = written(found, "pieces")
    counts = written(found.groupBy("part", "kind").agg(F.count(F.lit(1)).alias("rows")), "piece-counts")
    before = F.sum("rows").over(Window.partitionBy("kind").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = written(counts.select("part", "kind", F.coalesce(before, F.lit(0)).alias("shift")), "piece-shifts")
    # One number for each length class.
    demand = np.zeros(capacity // grain + 1, np.int64)
    for row in counts.groupBy("kind").agg(F.sum("rows").alias("rows")).collect():
        demand[row["kind"]] = row["rows"]
    shared = spark.sparkContext.broadcast(layout(demand))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for part in parts:
            kind, number = part.column(5).to_numpy(), part.column(6).to_numpy() + part.column(7).to_numpy()
            sequence, slot = own.place(kind, number)
            yield pa.RecordBatch.from_arrays([*part.columns[:5], pa.array(sequence), pa.array(slot)], out.names)

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    numbered = found.join(shifts, ["part", "kind"]).select(*columns, "kind", "place", "shift")
    numbers = StructType.fromDDL("sequence_id long, slot long")
    out = StructType([*[numbered.schema[name] for name in columns], *numbers])
    placed = numbered.mapInArrow(batches, out)
    # A sequence holds at most ``capacity`` pieces.
    earlier = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(earlier), F.lit(0)).cast("long")
    return placed.withColumn("offset", offset).drop("slot")


def layout(demand: np.ndarray) -> Layout:
    """Where pieces go, given how many there are of each class (1 to the capacity in grains)."""
    capacity = len(demand) - 1
    patterns = solve(demand[:-1], capacity)
    runs, sequence, used = [], int(demand[-1]), np.zeros(capacity + 1, np.int64)
    if demand[-1]:
        runs.append((capacity, 0, 0, 1, 0))
    for copies, pattern in patterns:
        slot = 0
        for kind, each in pattern:
            runs.append((kind, int(used[kind]), sequence, each, slot))
            used[kind] += copies * each
            slot += each
        sequence += copies
    runs.sort()
    return Layout(*(np.array(column, np.int64) for column in zip(*runs))) if runs else Layout(*[np.zeros(0, np.int64)] * 5)


def solve(demand: np.ndarray, capacity: int, gap: float = 2e-4) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (class, pieces of it) with their copies, covering the demand of classes 1 to capacity - 1 exactly."""
    kinds = np.flatnonzero(demand)
    kinds = kinds[kinds > 0]
    if not len(kinds):
        return []
    need = demand[kinds].astype(np.float64)
    columns, copies = _linear_program(kinds, need, capacity, gap)
    whole = np.floor(copies + 1e-9).astype(np.int64)
    left = demand[kinds] - columns.astype(np.int64) @ whole
    while (left < 0).any():  # rounding errors of the solution
        k = int(np.flatnonzero(left < 0)[0])
        j = int(np.flatnonzero((columns[k] > 0) & (whole > 0))[0])
        whole[j] -= 1
        left += columns[:, j].astype(np.int64)
    patterns = [
        (int(whole[j]), [(int(kinds[k]), int(columns[k, j])) for k in np.flatnonzero(columns[:, j])])
        for j in np.flatnonzero(whole)
    ]
    return patterns + _one_by_one(kinds, left, capacity)


def _linear_program(
    kinds: np.ndarray, need: np.ndarray, capacity: int, gap: float
) -> tuple[np.ndarray, np.ndarray]:
    """Basic patterns (one a column) and how often each is used."""
    columns, copies, inverse = _first_basis(kinds, need, capacity)
    best = float(kinds @ need) / capacity  # no packing is below the room that the pieces take
    for _ in range(2 * len(kinds) + 50):
        duals = inverse.sum(axis=0)
        entering, value = _price(kinds, duals, capacity)
        total = copies.sum()
        best = max(best, total / max(value, 1.0))  # and no solution of the program below total / value
        if value <= 1 + 1e-9 or total - best < max(gap * total, 0.25):
            break
        direction = (inverse * entering).sum(axis=1)
        positive = direction > 1e-9
        if not positive.any():
            break
        ratios = np.where(positive, copies / np.where(positive, direction, 1), np.inf)
        leaving = int(np.argmin(ratios))
        amount = ratios[leaving]
        columns[:, leaving] = entering
        copies = np.maximum(copies - amount * direction, 0)
        copies[leaving] = amount
        _exchange(inverse, direction, leaving)
    return columns, copies


def _exchange(inverse: np.ndarray, direction: np.ndarray, row: int) -> None:
    """Updates the inverse of a basis whose column ``row`` is replaced by one of this direction."""
    pivot = inverse[row] / direction[row]
    inverse -= direction[:, None] * pivot
    inverse[row] = pivot


def _first_basis(kinds: np.ndarray, need: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Patterns for a start: each holds the largest class left and what fills the room best, and uses up one class.

    No later pattern has that class, so the patterns are independent, and together they cover the need exactly. A
    pattern is the column of the class that it uses up; with it come the copies and the inverse of the columns.
    """
    columns, copies, left, order = np.zeros((len(kinds), len(kinds))), np.zeros(len(kinds)), need.copy(), []
    open_ = np.ones(len(kinds), bool)
    for _ in kinds:
        own = np.flatnonzero(open_)
        largest = own[-1]
        fill, _ = _price(kinds[own], kinds[own] * (1 + 1e-6 * kinds[own]), capacity - int(kinds[largest]))
        pattern = np.zeros(len(kinds))
        pattern[own] = fill
        pattern[largest] += 1
        inside = np.flatnonzero(pattern)
        amounts = left[inside] / pattern[inside]
        least = int(np.argmin(amounts))
        closed = int(inside[least])
        columns[:, closed], copies[closed] = pattern, amounts[least]
        order.append(closed)
        left = np.maximum(left - amounts[least] * pattern, 0)
        open_[closed] = False
        left[closed] = 0
    inverse = np.eye(len(kinds))
    for closed in reversed(order):
        _exchange(inverse, (inverse * columns[:, closed]).sum(axis=1), closed)
    return columns, copies, inverse


def _price(kinds: np.ndarray, duals: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """The pattern worth most by the duals, by dynamic programming over the room used."""
    worth, took = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    useful = np.flatnonzero(duals > 1e-12)
    sizes, values = kinds[useful], duals[useful]
    for room in range(1, capacity + 1):
        worth[room], took[room] = worth[room - 1], -1
        fits = np.searchsorted(sizes, room, side="right")
        if fits:
            options = worth[room - sizes[:fits]] + values[:fits]
            k = int(np.argmax(options))
            if options[k] > worth[room] + 1e-12:
                worth[room], took[room] = options[k], k
    pattern, room = np.zeros(len(kinds)), capacity
    while room > 0:
        if took[room] < 0:
            room -= 1
        else:
            pattern[useful[took[room]]] += 1
            room -= int(sizes[took[room]])
    return pattern, float(worth[capacity])


def _one_by_one(kinds: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Sequences for the pieces that rounding left: the largest first, then whatever fills the room best."""
    counts = {int(kind): int(count) for kind, count in zip(kinds, left) if count}
    patterns = []
    while counts:
        largest = max(counts)
        room, chosen = capacity - largest, {largest: 1}
        # Sums that the other pieces reach, with the last piece of each.
        reached, available = {0: (0, 0)}, dict(counts)
        available[largest] -= 1
        for kind in sorted(available, reverse=True):
            if room in reached:
                break
            for total in sorted(reached):
                for number in range(1, available[kind] + 1):
                    new = total + kind * number
                    if new > room or new in reached:
                        break
                    reached[new] = (kind, total)
        total = max(reached)
        while total:
            kind, before = reached[total]
            number = (total - before) // kind
            chosen[kind] = chosen.get(kind, 0) + number
            total = before
        for kind, number in chosen.items():
            counts[kind] -= number
            if not counts[kind]:
                del counts[kind]
        patterns.append((1, sorted(chosen.items(), reverse=True)))
    return patterns
