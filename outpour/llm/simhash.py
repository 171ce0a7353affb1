"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints: words, shingles of words, one 64-bit hash each, majority of each bit.

Index: a node is a mask of bits and the pattern that its fingerprints share there. The root has no bits. A node with
more than ``capacity`` fingerprints passes them to ``distance + 1`` children, each of which adds one run of the free
bits to the mask: two fingerprints with at most ``distance`` differing bits agree in one of these runs, so no link is
lost, and since each step fixes more bits, groups of any size end in nodes within the capacity or with few free bits.
In a node fingerprints are sorted by Gray rank, neighbours are factored into lower nodes of eight with the bits they
share, and pairs of nodes are descended together: differences are accumulated over the bits that both share and no
upper node had, and a pair of groups with more than ``distance`` of them is dropped whole.

A node yields a star for each set of linked fingerprints, not its pairs. Stars of all nodes are joined by
``components``. Equal fingerprints are one entry with their smallest id, so copies cost nothing beyond the aggregate.

Null texts count as empty; texts without words have the fingerprint 0 and are linked like any other. A row with a null
id links nothing; it gets the component of its fingerprint, null if only such rows have it. Repeated rows share a component.
An empty table gives no rows; columns other than id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outpour.llm.components import components
from outpour.llm.store import gate, gated, ship, written

SEED = 42
BITS = 64
FANOUT = 8
_ALL = (1 << BITS) - 1


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """The unsigned fingerprint of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle_words + 1)
    starts = np.concatenate([[0], ends[: n - 1] + 1])
    last = ends[-1:] if len(words) < shingle_words else ends[shingle_words - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), last.tolist())]
    columns = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8) + _COLUMN_BASE
    seen = np.bincount(columns.ravel(), minlength=8 * 256).reshape(8, 256)
    ones = (seen @ _BYTE_BITS).ravel()
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


_COLUMN_BASE = (np.arange(8) * 256).astype(np.uint16)
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprints(docs: DataFrame, id_column: str, text_column: str, shingle_words: int = 3) -> DataFrame:
    """id and fingerprint (as a signed long) of each row."""
    ship(docs.sparkSession)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            prints = np.array([fingerprint(t, shingle_words) for t in part.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(prints.view(np.int64))], ["id", "fp"])

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(batches, "id long, fp long")


def near_components(prints: DataFrame, distance: int = 3, capacity: int = 512) -> DataFrame:
    """id, fp and component_id of each row of ``fingerprints``."""
    prints = written(prints, "simhash-prints")
    entries = written(
        prints.where("id is not null").groupBy("fp").agg(F.min("id").alias("doc")), "simhash-entries"
    )
    linked = written(components(links(entries, distance, capacity)), "simhash-components")
    labels = entries.join(linked, entries.doc == linked.node, "left").select(
        "fp", F.coalesce("component", "doc").alias("component_id")
    )
    return prints.join(written(labels, "simhash-labels"), "fp", "left").select("id", "fp", "component_id")


def links(entries: DataFrame, distance: int, capacity: int) -> DataFrame:
    """a, b: stars that link the docs of all entries (fp, doc) whose fingerprints differ in few bits."""
    spark = entries.sparkSession
    ship(spark)
    count = entries.count()
    found, masks, members = None, [0], entries.select("fp", "doc", F.lit(0).cast("long").alias("mask"))
    while True:
        children = {mask: _children(mask, distance) for mask in masks}
        below = F.array()
        for mask, found_below in children.items():  # (distance + 1) ** depth masks
            below = F.when(F.col("mask") == _signed(mask), F.array(*map(F.lit, map(_signed, found_below)))).otherwise(below)
        members = members.select("fp", "doc", F.explode(below.cast("array<bigint>")).alias("mask"))
        masks = sorted({child for below in children.values() for child in below})
        fixed = min(mask.bit_count() for mask in masks)
        if count / 2.0**fixed > capacity and fixed < BITS:
            continue  # no node of this depth can be small
        members = written(members.withColumn("pattern", F.col("fp").bitwiseAND(F.col("mask"))), "simhash-members")
        sizes = members.groupBy("mask", "pattern").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        sizes = written(sizes, "simhash-nodes")
        largest = sizes.agg(F.max("size")).first()[0] or 0
        # With this many free bits a node holds no more than 2 ** free entries.
        bounded = max(capacity, 2 ** (BITS - fixed)) if BITS - fixed <= 10 else capacity
        sized = members.join(sizes, ["mask", "pattern"])
        stars = _search(sized.where(F.col("size") <= bounded), distance)
        stars = written(stars, "simhash-stars")
        found = stars if found is None else found.unionByName(stars)
        if largest <= bounded:
            return found
        members = written(sized.where(F.col("size") > bounded).select("fp", "doc", "mask"), "simhash-large")


def _children(mask: int, distance: int) -> list[int]:
    free = [bit for bit in range(BITS - 1, -1, -1) if not mask >> bit & 1]
    runs = np.array_split(np.array(free, dtype=object), distance + 1)
    return sorted({mask | sum(1 << bit for bit in run) for run in runs})


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def gray_rank(fp: Column) -> Column:
    """Place of a fingerprint in Gray order, as a long whose signed order is that of the places."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(1 << 63)).cast("long"))


def _search(members: DataFrame, distance: int) -> DataFrame:
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for part in parts:
            held = part if held is None else pa.concat_batches([held, part])
            node = _runs(held.column(0).to_numpy(), held.column(1).to_numpy())
            cut = int(np.searchsorted(node, node[-1])) if len(node) else 0
            if cut:
                yield from _stars(held.slice(0, cut), distance)
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield from _stars(held, distance)

    ordered = members.select("mask", "pattern", "fp", "doc", gray_rank(F.col("fp")).alias("rank"))
    ordered = ordered.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern", "rank")
    return ordered.drop("rank").mapInArrow(batches, "a long, b long")


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Number of the run of equal keys that each row is in."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.cumsum(new)


def _stars(rows: pa.RecordBatch, distance: int) -> Iterator[pa.RecordBatch]:
    node = _runs(rows.column(0).to_numpy(), rows.column(1).to_numpy())
    fp = rows.column(2).to_numpy().view(np.uint64)
    doc = rows.column(3).to_numpy()
    # Nodes are taken in lots, so that the pairs of a lot stay few.
    work = np.cumsum(np.bincount(node).astype(np.float64) ** 2)
    lot = (work // 2e6).astype(np.int64)[node]
    edges = np.concatenate([[0], np.flatnonzero(np.diff(lot)) + 1, [len(node)]])
    for start, stop in zip(edges[:-1], edges[1:]):
        i, j = near_pairs(fp[start:stop], node[start:stop], distance)
        if not len(i):
            continue
        own, label = doc[start:stop], doc[start:stop].copy()
        # Labels must not cross nodes' copies of an entry, so they go by place and not by doc.
        while True:
            least = np.minimum(label[i], label[j])
            before = label.copy()
            np.minimum.at(label, i, least)
            np.minimum.at(label, j, least)
            if np.array_equal(label, before):
                break
        linked = label != own
        yield pa.RecordBatch.from_arrays([pa.array(own[linked]), pa.array(label[linked])], ["a", "b"])


def near_pairs(fp: np.ndarray, group: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Places i < j of fingerprints of one group with at most ``distance`` differing bits.

    ``fp``: uint64, in Gray order within each group; ``group``: numbers in rising order.
    """
    everything = np.uint64(_ALL)
    levels = [(np.full(len(fp), everything), fp, np.zeros(0, np.int64), np.zeros(0, np.int64))]
    common, united, owner = fp, fp, group
    while len(owner) and (np.diff(owner) == 0).any():
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        place = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
        starts = np.flatnonzero(place % FANOUT == 0)
        common = np.bitwise_and.reduceat(common, starts)
        united = np.bitwise_or.reduceat(united, starts)
        shared = ~(common ^ united)
        levels.append((shared, common & shared, starts, np.diff(np.append(starts, len(owner)))))
        owner = owner[starts]
    top = np.arange(len(owner))
    i, j, seen, differing = top, top, np.zeros(len(top), np.uint64), np.zeros(len(top), np.int64)
    for depth in range(len(levels) - 1, 0, -1):
        starts, sizes = levels[depth][2:]
        wide = sizes[i] * sizes[j]
        pair = np.repeat(np.arange(len(i)), wide)
        inner = np.arange(len(pair)) - np.repeat(np.cumsum(wide) - wide, wide)
        x, y = starts[i[pair]] + inner // sizes[j[pair]], starts[j[pair]] + inner % sizes[j[pair]]
        keep = (x < y) | ((x == y) & (depth > 1))
        pair, x, y = pair[keep], x[keep], y[keep]
        shared, pattern = levels[depth - 1][:2]
        fresh = shared[x] & shared[y] & ~seen[pair]
        differing = differing[pair] + np.bitwise_count((pattern[x] ^ pattern[y]) & fresh)
        keep = differing <= distance
        i, j, seen, differing = x[keep], y[keep], (seen[pair] | fresh)[keep], differing[keep]
    if len(levels) == 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return i, j


def drop_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows but those linked to a row with a smaller id. Rows with a null id stay, and so do rows that repeat an id."""
    return drop_linked(docs, near_components(fingerprints(docs, id_column, text_column)), id_column)


def drop_linked(docs: DataFrame, found: DataFrame, id_column: str) -> DataFrame:
    """The rows but those whose component (``found``: id, component_id) has a smaller id.

    A gate finds the few rows that may go; the texts of all others are not shuffled.
    """
    dropped = written(found.where("id <> component_id").select("id").distinct(), "simhash-dropped")
    own = F.col(id_column).cast("long")
    rows = gated(docs, gate(dropped), [own], "__hit")
    staying = rows.where(~F.col("__hit")).drop("__hit")
    checked = rows.where("__hit").drop("__hit").withColumn("__own", own)
    checked = checked.join(dropped, F.col("__own") == dropped.id, "left_anti").drop("__own")
    return staying.unionByName(checked)
