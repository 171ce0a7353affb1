"""Periodic runs of words: seeds on diagonals, extended.

A run is a stretch of consecutive words with smallest period q that no neighbour extends, of at least max(``least``,
``times`` * q) words (``times`` at least 4). On the diagonal of lag q, where a word is compared with the one q places on, it is a
row of at least (times - 1) * q equal places, and 3 * 2^j of them are guaranteed for every lag of the band 2^j <= q < 2^(j+1).

* Index. So for each band the k-grams of k = 3 * 2^j words are indexed, exactly, by ranks: those of 2k words come from pairs of
  ranks of k words. Only places whose gram occurs again go on to the next band, so that a text is indexed about as far as it repeats.
* Pairs. Of the occurrences of a gram in one document, neighbours in order of place are paired, and a pair whose lag lies in the
  band is a seed. As k is not less than q, a gram inside a run occurs again after q places and not before (a word that equals
  a rotation of itself would have a smaller period), so each run of the band has a seed and no gram emits all its pairs. For
  the same reason a seed never has a lag that is a multiple of the run's smallest period.
* Extension. Seeds are taken by lag and place; one that lies within what an earlier seed of its lag has covered is dropped
  (a table of the furthest place for each lag); others are extended word by word to both sides, in steps that double.

A word goes from the collapsed text if some run contains it after that run's first q words. Rows are independent: no shuffle.

Null arrays have no words; null words are words like any other, written as nothing. Repeated rows each get their result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from outpour.llm.store import ship

LEAST = 6
TIMES = 4
RUNS = "runs array<struct<start:long,length:long,period:long>>"


def _agreement(words: np.ndarray, place: int, lag: int, step: int) -> int:
    """How many places in a row, from ``place`` on to the right (step 1) or left (-1), equal the word ``lag`` places on."""
    found, size = 0, 8
    while True:
        start = place + found if step > 0 else place - found - size + 1
        stop = min(start + size, len(words) - lag)
        start = max(start, 0)
        if stop <= start:
            return found
        equal = words[start:stop] == words[start + lag : stop + lag]
        if step < 0:
            equal = equal[::-1]
        wrong = np.flatnonzero(~equal)
        if len(wrong):
            return found + int(wrong[0])
        found, size = found + len(equal), size * 2


def _ranks(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Numbers that are equal where both columns are."""
    top = int(second.max(initial=0)) + 1
    return np.unique(first * top + second, return_inverse=True)[1]


def runs_of(words: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of each run of an array of word numbers, by start, then period."""
    if times < 4:
        raise ValueError("times must be at least 4")
    n, width, found = len(words), 1, []
    # Places whose gram of ``width`` words occurs twice or more, and its rank; a longer gram occurs twice only there.
    places, ranks = np.arange(n), _ranks(words.astype(np.int64), np.zeros(n, np.int64))
    table = np.full(n, -1, np.int64)
    while len(places) and times * width <= n:
        table[:] = -1
        table[places] = ranks
        one, two, three = (_at(table, places + k * width) for k in range(3))
        double = places[two >= 0]
        doubled = _ranks(one[two >= 0], two[two >= 0])
        triple = (two >= 0) & (three >= 0)
        grams = _ranks(doubled[triple[two >= 0]], three[triple])
        found += _extended(words, places[triple], grams, width, least, times)
        again = np.bincount(doubled, minlength=1)[doubled] > 1
        places, ranks, width = double[again], doubled[again], width * 2
    return sorted(found, key=lambda run: (run[0], run[2]))


def _at(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    inside = places < len(table)
    return np.where(inside, table[np.where(inside, places, 0)], -1)


def _extended(
    words: np.ndarray, places: np.ndarray, grams: np.ndarray, width: int, least: int, times: int
) -> list[tuple[int, int, int]]:
    """Runs of the band of lags [width, 2 * width) from the occurrences of its grams."""
    order = np.lexsort((places, grams))
    gram, place = grams[order], places[order]
    lag = place[1:] - place[:-1]
    seed = (gram[1:] == gram[:-1]) & (lag >= width) & (lag < 2 * width)
    place, lag = place[:-1][seed], lag[seed]
    order = np.lexsort((place, lag))
    place, lag = place[order], lag[order]
    # Seeds side by side on a diagonal are one.
    fresh = np.ones(len(place), bool)
    fresh[1:] = (lag[1:] != lag[:-1]) | (place[1:] != place[:-1] + 1)
    furthest: dict[int, int] = {}
    found = []
    for start, q in zip(place[fresh].tolist(), lag[fresh].tolist()):
        if start < furthest.get(q, 0):
            continue
        stop = start + _agreement(words, start, q, 1)
        start -= _agreement(words, start - 1, q, -1) if start else 0
        furthest[q] = stop
        length = stop - start + q
        if length >= max(least, times * q):
            found.append((start, length, q))
    return found


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each word stays: not if a run contains it after the run's first period."""
    depth = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return np.cumsum(depth)[:n] == 0


def collapse(
    docs: DataFrame, words: Column, carry: list[str], least: int = LEAST, times: int = TIMES, space: str = " "
) -> DataFrame:
    """The columns of ``carry`` with runs (by start, then period) and collapsed (the words that stay, joined by ``space``).

    ``words``: an array of strings for each row. Columns of ``carry`` named like the results are replaced.
    """
    ship(docs.sparkSession)
    carry = [name for name in carry if name not in ("runs", "collapsed")]
    names = [f"__c{k}" for k in range(len(carry))]
    rows = docs.select(
        F.coalesce(words, F.array().cast("array<string>")).alias("words"),
        *[F.col(f"`{name}`").alias(hidden) for name, hidden in zip(carry, names)],
    )
    out = StructType([*[rows.schema[name] for name in names], *StructType.fromDDL(RUNS + ", collapsed string")])
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            lists = part.column(0)
            flat = lists.flatten()
            numbers = pc.dictionary_encode(flat, null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
            found, kept, start = [], [], 0
            for end in ends.tolist():
                runs = runs_of(numbers[start:end], least, times)
                own = flat.slice(start, end - start)
                if runs:
                    own = own.filter(pa.array(kept_words(end - start, runs)))
                kept.append(space.join(word or "" for word in own.to_pylist()))
                found.append([{"start": a, "length": b, "period": c} for a, b, c in runs])
                start = end
            columns = [*part.columns[1:], pa.array(found, kind), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, out.names)

    return rows.mapInArrow(batches, out).withColumnsRenamed(dict(zip(names, carry)))
