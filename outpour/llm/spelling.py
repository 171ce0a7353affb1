"""Spelling variants: words one edit apart, by dense prefix-suffix tiling.

Words are counted by a map-side aggregate. Two words differ by exactly one inserted, deleted or replaced code point if they
are different and the lengths of their common prefix and common suffix add up to the longer length less one, or more.
That is looked at for all pairs of a block at once: words become rows of a padded matrix of code points, once aligned to the
left and once to the right, and column after column of two matrices is compared, every row of one with every row of the other.

A block holds words that may be near. Let c be the shorter of two lengths and h its half: of two near words either the first h
or the last c - h code points agree. So a word joins four blocks, by its first and by its last half, as the shorter (c is its
length) and as the longer (c is its length less one). A block of any size is dealt out in tiles of at most about ``tile``
words, and each pair of tiles is one group of at most twice as many rows; only near pairs leave a task. A pair that shares both
halves is found in the block of first halves alone.

A word's form is its near word with the largest count (ties: the smallest word) if that is at least ``ratio`` times its own
count. Counts grow by that ratio from form to form, so a chain of forms is as long as the logarithm of the largest count; roots
are found by as many joins as that number has bits.

Null arrays and null words are no words; an empty table has no rows. Repeated rows count as often as they are there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outpour.llm.store import ship, written

TILE = 1024
RATIO = 10
_CELLS = 1 << 20


def vocabulary(docs: DataFrame, words: Column, least_chars: int = 7, least_rows: int = 2) -> DataFrame:
    """word, n: the words (an array of strings for each row) that are long enough and occur often enough."""
    rows = docs.select(F.explode(words).alias("word")).where(F.char_length("word") >= least_chars)
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_rows)


def _blocks(words: DataFrame, least_chars: int) -> DataFrame:
    """c, at_end, block, word, n: a word in each of its blocks."""
    size = F.char_length("word")
    places = []
    for c in (size, size - 1):
        half = F.floor(c / 2).cast("int")
        first, last = F.left("word", half), F.right("word", c - half)
        for at_end, part in ((False, first), (True, last)):
            key = F.xxhash64(c, F.lit(at_end), part)
            places.append(F.struct(c.alias("c"), F.lit(at_end).alias("at_end"), key.alias("block")))
    rows = words.select("word", "n", F.explode(F.array(*places)).alias("place")).select("place.*", "word", "n")
    return rows.where(F.col("c") >= least_chars)


def near_words(words: DataFrame, least_chars: int = 7, tile: int = TILE) -> DataFrame:
    """word, n, near, near_n: both directions of each pair of near words. ``words``: word (unique), n (long)."""
    ship(words.sparkSession)
    blocks = _blocks(words, least_chars)
    key = ["c", "at_end", "block"]
    sizes = blocks.groupBy(*key).agg(
        F.count(F.lit(1)).alias("size"), F.count_if(F.char_length("word") == F.col("c")).alias("short")
    )
    sizes = sizes.where("size > 1 and short > 0").select(*key, F.expr(f"(size - 1) div {tile} + 1").alias("tiles"))
    placed = blocks.join(sizes, key).withColumn("own", F.pmod(F.xxhash64("word", F.lit("tile")), F.col("tiles")))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    group = [*key, "x", "y"]
    dealt = placed.select(
        *key, F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "word", "n"
    )
    ordered = dealt.repartition(*group).sortWithinPartitions(*group, "own")
    return ordered.mapInArrow(_near_in_groups, "word string, n long, near string, near_n long")


def _near_in_groups(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of groups that lie together; whole groups at a time."""
    held = None
    for part in parts:
        if not part.num_rows:
            continue
        held = part if held is None else pa.concat_batches([held, part])
        if held.num_rows < 1 << 15:
            continue
        group = _group_numbers(held)
        cut = int(np.searchsorted(group, group[-1]))
        if cut:
            yield from _near(held.slice(0, cut), group[:cut])
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield from _near(held, _group_numbers(held))


def _group_numbers(rows: pa.RecordBatch) -> np.ndarray:
    new = np.zeros(rows.num_rows, bool)
    for name in ("c", "block", "x", "y"):
        column = rows.column(name).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    at_end = rows.column("at_end").to_numpy(zero_copy_only=False)
    new[1:] |= at_end[1:] != at_end[:-1]
    return np.cumsum(new)


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matrices of code points, aligned to the left and to the right (0 where a word has none), and the lengths."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(flat) or flat.max() < 1 << 16:
        flat = flat.astype(np.uint16)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    width = int(sizes.max(initial=0))
    row = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    left = np.zeros((len(words), width), flat.dtype)
    right = left.copy()
    left[row, place] = flat
    right[row, width - sizes[row] + place] = flat
    return left, right, sizes


def _agreeing(a: np.ndarray, b: np.ndarray, columns: range) -> np.ndarray:
    """Length of the common run of columns from the first on, of each row of a with each row of b, in each layer."""
    agree = np.ones((a.shape[0], a.shape[1], b.shape[1]), bool)
    count = np.zeros(agree.shape, np.int32)
    for column in columns:
        x = a[:, :, column, None]
        agree &= (x == b[:, None, :, column]) & (x != 0)
        if not agree.any():
            break
        count += agree
    return count


def _near(rows: pa.RecordBatch, group: np.ndarray) -> Iterator[pa.RecordBatch]:
    texts = rows.column("word").to_pylist()
    c = rows.column("c").to_numpy()
    at_end = rows.column("at_end").to_numpy(zero_copy_only=False)
    own, x, y = (rows.column(name).to_numpy() for name in ("own", "x", "y"))
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.append(first, len(group)))
    in_first = np.add.reduceat((own == x).astype(np.int64), first)
    alone = x[first] == y[first]
    # A group is its first tile against itself or against its second; groups of like sizes and widths are stacked.
    tall, wide = np.where(alone, size, in_first), np.where(alone, size, size - in_first)
    shape = np.stack([_padded(tall), _padded(wide), c[first]], axis=1)
    begins = np.where(alone, first, first + in_first)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    order = np.lexsort(shape.T)
    cuts = np.flatnonzero((np.diff(shape[order], axis=0) != 0).any(axis=1)) + 1
    for like in np.split(order, cuts):
        like = like[(tall[like] > 0) & (wide[like] > 0)]
        if not len(like):
            continue
        high, broad, length = (int(value) for value in shape[like[0]])
        lot = max(1, _CELLS // (high * broad))
        for begin in range(0, len(like), lot):
            some = like[begin : begin + lot]
            i = first[some][:, None] + np.minimum(np.arange(high), tall[some][:, None] - 1)
            j = begins[some][:, None] + np.minimum(np.arange(broad), wide[some][:, None] - 1)
            left, right, sizes = code_points([texts[k] for k in np.concatenate([i.ravel(), j.ravel()])])
            a, b = slice(0, i.size), slice(i.size, None)
            layers_a, layers_b = (*i.shape, left.shape[1]), (*j.shape, left.shape[1])
            width = left.shape[1]
            prefix = _agreeing(left[a].reshape(layers_a), left[b].reshape(layers_b), range(width))
            suffix = _agreeing(right[a].reshape(layers_a), right[b].reshape(layers_b), range(width - 1, -1, -1))
            one, two = sizes[a].reshape(i.shape)[:, :, None], sizes[b].reshape(j.shape)[:, None, :]
            longer, shorter = np.maximum(one, two), np.minimum(one, two)
            near = (prefix + suffix >= longer - 1) & (shorter == length) & (longer <= length + 1)
            near &= (prefix < shorter) | (shorter < longer)
            near &= ~at_end[first[some]][:, None, None] | (prefix < length // 2)
            near &= (np.arange(high) < tall[some][:, None])[:, :, None]
            near &= (np.arange(broad) < wide[some][:, None])[:, None, :]
            near &= ~alone[some][:, None, None] | (i[:, :, None] < j[:, None, :])
            layer, p, q = np.nonzero(near)
            if len(layer):
                found.append((i[layer, p], j[layer, q]))
    if found:
        one, two = (np.concatenate(side) for side in zip(*found))
        words, n = rows.column("word"), rows.column("n")
        here, there = pa.array(np.concatenate([one, two])), pa.array(np.concatenate([two, one]))
        columns = [words.take(here), n.take(here), words.take(there), n.take(there)]
        yield pa.RecordBatch.from_arrays(columns, ["word", "n", "near", "near_n"])


def _padded(sizes: np.ndarray) -> np.ndarray:
    """The next size of a coarse scale, so that groups of like sizes can be stacked."""
    powers = 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64)
    return np.where(sizes > 16, -(-sizes // 16) * 16, powers)


def variants(words: DataFrame, least_chars: int = 7, ratio: int = RATIO, tile: int = TILE) -> DataFrame:
    """word, form, root, n, n_near, form_n of each of ``words`` (word, n)."""
    words = written(words.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    near = near_words(words, least_chars, tile)
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"),
    )
    best = best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    is_form = F.col("near_n") >= ratio * F.col("n")
    forms = words.join(best, "word", "left").select(
        "word",
        F.when(is_form, F.col("near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("near_n")).alias("form_n"),
    )
    forms = written(forms, "spelling-forms")
    links = forms.where("form is not null").select("word", F.col("form").alias("root"))
    most = forms.agg(F.max("n"), F.min("n")).first()
    steps = 1 + math.ceil(math.log(max(most[0], 1) / max(most[1], 1), ratio)) if most[0] is not None else 0
    for _ in range(max(0, steps).bit_length()):
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        links = written(links, "spelling-roots")
    return forms.join(links, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
