"""Repeated substrings by prefix-free parsing.

Removes every byte that a string of ``length`` bytes covers which also starts earlier in the corpus (smaller id, or earlier in
the same document); strings do not cross documents. The suffix order of the corpus is never built position by position:

* Parse. A rolling hash runs over each document, and the least hash within each string of ``length`` bytes is its trigger, so
  every string has one and equal strings have the same one at the same place. Strings with the same trigger occurrence
  are consecutive: a phrase is the stretch of bytes they cover, and no phrase is a prefix of another place's parse.
* Dictionary. Phrases of equal content are one entry, with its earliest occurrence; all later occurrences are repeated as
  a whole, without a look at their bytes. Highly repetitive text costs one small row for each phrase.
* Order. Strings of different entries can only be equal if the entries share a trigger. Only such entries have their
  bytes fetched. Sorted by the bytes from the trigger on, and by those before it read backwards, neighbours show how far each
  entry agrees with another; strings that reach further are new. A suffix array of the rest (prefix doubling, cut at ``length``
  bytes) puts equal strings side by side; the earliest of each is new, the others repeat it.

Entries are dealt out by trigger; a trigger with more than ``capacity`` entries is dealt out in lots, and the earliest string of
each lot then meets those of other lots in one more aggregate, so no task holds an unbounded group.

Null texts are empty. Null ids come before all others; rows that repeat an id count as documents of their own, in the order
of their texts. Documents shorter than ``length`` bytes lose nothing.
An empty table gives no rows; columns of ``carry`` named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from outpour.llm.simhash import _runs
from outpour.llm.store import discard, gate, gated, ship, written

LENGTH = 100
GRAM = 24
CAPACITY = 4096
_PLACE_BITS = 24
_PLACES = np.uint64((1 << _PLACE_BITS) - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = 1 << 15  # bytes whose hashes stay in the processor's cache
_ROWS = 1 << 14


def _rolling(data: np.ndarray) -> np.ndarray:
    """Hash of each GRAM bytes, built from hashes of 1, 2, 4 ... bytes."""
    # Powers are arrays of one number, whose overflow is silent.
    power, sums, size = {1: np.array([0x100000001B3], np.uint64)}, {1: data.astype(np.uint64) * _ODD + _ODD}, 1
    while size * 2 <= GRAM:
        own = sums[size]
        sums[size * 2] = own[:-size] * power[size] + own[size:]
        power[size * 2] = power[size] * power[size]
        size *= 2
    value, have = sums[size], size
    for part in sorted(sums, reverse=True):
        while have + part <= GRAM:
            rest = sums[part][have : have + len(value)]
            value = value[: len(rest)] * power[part] + rest
            have += part
    value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return value ^ (value >> np.uint64(32))


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and where each begins, with the end; null is empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def parse(whole: np.ndarray, bounds: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of strings and trigger hash of each phrase, in order. Phrase k covers its strings' bytes.

    ``whole``: documents one after the other, which begin and end at ``bounds``. A string lies in one document.
    """
    none = np.zeros(0, np.int64)
    found = [(none, none, none, none)]
    for begin in range(0, len(whole) - length + 1, _CHUNK):
        part = whole[begin : begin + _CHUNK + length - 1]
        hashes = _rolling(part)
        least = (hashes & ~_PLACES) | np.arange(len(hashes), dtype=np.uint64)
        wide, size = length - GRAM + 1, 1
        while size * 2 <= wide:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        strings = len(part) - length + 1
        least = np.minimum(least[:strings], least[wide - size :][:strings])
        docs = slice(np.searchsorted(bounds, begin, "right") - 1, np.searchsorted(bounds, begin + strings) + 1)
        last = np.repeat(bounds[docs][1:] - length, np.diff(np.clip(bounds[docs], begin, begin + strings)))
        inside = np.flatnonzero(np.arange(begin, begin + strings) <= last)
        place = (least[inside] & _PLACES).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        trigger = hashes[place[first]].view(np.int64)
        found.append((inside[first] + begin, np.diff(first, append=len(place)), trigger, place[first] + begin))
    start, strings, trigger, place = (np.concatenate(column) for column in zip(*found))
    # A phrase that a chunk cut is one phrase.
    first = np.flatnonzero(np.diff(place, prepend=-1))
    return start[first], np.add.reduceat(strings, first) if len(first) else none, trigger[first]


def phrases(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """trigger, content, doc, start and strings of each phrase. ``docs``: doc, text."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for part in parts:
            if not part.num_rows:
                continue
            whole, bounds = _bytes(part.column(1))
            data = whole.tobytes()
            found = parse(whole, bounds, length)
            for lot in range(0, len(found[0]), _ROWS):
                start, strings, trigger = (column[lot : lot + _ROWS] for column in found)
                ends = (start + strings + length - 1).tolist()
                content = np.array([digest(data[a:b]) for a, b in zip(start.tolist(), ends)], np.uint64)
                doc = np.searchsorted(bounds, start, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(trigger),
                        pa.array(content.view(np.int64)),
                        part.column(0).take(pa.array(doc)),
                        pa.array((start - bounds[doc]).astype(np.int32)),
                        pa.array(strings.astype(np.int32)),
                    ],
                    ["trigger", "content", "doc", "start", "strings"],
                )

    return docs.select("doc", "text").mapInArrow(
        batches, "trigger long, content long, doc long, start int, strings int"
    )


def new_strings(docs: DataFrame, length: int = LENGTH, capacity: int = CAPACITY) -> DataFrame:
    """doc, start, stop: runs of places where a string starts that starts nowhere earlier. ``docs``: doc (unique), text."""
    ship(docs.sparkSession)
    earliest = F.min(F.struct("doc", "start", "strings")).alias("first")
    dictionary = phrases(docs, length).groupBy("trigger", "content").agg(earliest).select("trigger", "first.*")
    dictionary = written(dictionary, "dictionary")
    # A trigger of one entry is settled; the minima of its columns are that entry.
    alone = [F.min(name).alias(name) for name in ("doc", "start", "strings")]
    triggers = written(dictionary.groupBy("trigger").agg(F.count(F.lit(1)).alias("entries"), *alone), "triggers")
    stop = (F.col("start") + F.col("strings")).alias("stop")
    settled = triggers.where("entries = 1").select("doc", "start", stop)

    shared = triggers.where("entries > 1").select("trigger", "entries")
    marked = gated(dictionary, gate(shared.select("trigger")), [F.col("trigger")], "__maybe")
    candidates = marked.where("__maybe").drop("__maybe").join(shared, "trigger")
    spans = F.collect_list(F.struct("trigger", "entries", "start", "strings")).alias("spans")
    wanted = written(candidates.groupBy("doc").agg(spans), "wanted")
    discard(dictionary)
    holders = gated(docs, gate(wanted.select("doc")), [F.col("doc")], "__maybe").where("__maybe")
    entries = holders.select("doc", "text").join(wanted, "doc").mapInArrow(
        lambda parts: _entries(parts, length, capacity), "trigger long, lot int, hot boolean, doc long, start int, data binary"
    )
    ordered = entries.repartition("trigger", "lot").sortWithinPartitions("trigger", "lot")
    found = ordered.mapInArrow(
        lambda parts: _by_suffix(parts, length), "doc long, start int, stop int, high long, low long"
    )
    found = written(found, "new-strings")
    discard(wanted)
    local = found.where("high is null").select("doc", "start", "stop")
    across = found.where("high is not null").groupBy("high", "low").agg(F.min(F.struct("doc", "start")).alias("first"))
    across = across.select("first.doc", "first.start", (F.col("first.start") + 1).alias("stop"))
    return settled.unionByName(local).unionByName(across)


def _entries(parts: Iterator[pa.RecordBatch], length: int, capacity: int) -> Iterator[pa.RecordBatch]:
    """Bytes of the phrases in each document's spans."""
    for part in parts:
        if not part.num_rows:
            continue
        whole, bounds = _bytes(part.column(1))
        data, docs = whole.tobytes(), part.column(0).to_numpy()
        spans, counts = part.column(2).flatten(), part.column(2).value_lengths().to_numpy()
        owners = np.repeat(np.arange(part.num_rows), counts)
        for begin in range(0, len(owners), _ROWS):
            owner = owners[begin : begin + _ROWS]
            trigger, entries, start, strings = (c.to_numpy() for c in spans.slice(begin, _ROWS).flatten())
            doc, lots = docs[owner], -(-entries // capacity)
            lot = np.zeros(len(owner), np.int32)
            for k in np.flatnonzero(lots > 1).tolist():
                lot[k] = xxhash.xxh64_intdigest(f"{doc[k]} {start[k]}") % int(lots[k])
            first = bounds[owner] + start
            ends = (first + strings + length - 1).tolist()
            pieces = [data[a:b] for a, b in zip(first.tolist(), ends)]
            columns = [trigger, lot, lots > 1, doc, start]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, columns), pa.array(pieces, pa.binary())], ["trigger", "lot", "hot", "doc", "start", "data"]
            )


def _by_suffix(parts: Iterator[pa.RecordBatch], length: int, most: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """New strings of entries that come in order of trigger and lot; whole groups at a time, about ``most`` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for part in parts:
        for begin in range(0, part.num_rows, 1024):
            held.append(part.slice(begin, 1024))
            size += held[-1].column(5).nbytes
            if size >= most:
                rows = pa.concat_batches(held)
                group = _runs(rows.column(0).to_numpy(), rows.column(1).to_numpy())
                cut = int(np.searchsorted(group, group[-1]))
                if cut:
                    yield _earliest(rows.slice(0, cut), length)
                held, size = [rows.slice(cut)], rows.slice(cut).column(5).nbytes
    if held:
        rows = pa.concat_batches(held)
        if rows.num_rows:
            yield _earliest(rows, length)


def suffix_ranks(data: np.ndarray, length: int) -> np.ndarray:
    """Rank of the ``length`` bytes from each place on among all of them, by prefix doubling; equal bytes, equal rank."""
    padded = np.concatenate([data, np.zeros(length + 8, np.uint8)]).astype(np.uint64)
    ranks, known = padded, 1
    while known < 8:  # up to eight bytes fit into one number
        ranks, known = (ranks[:-known] << np.uint64(8 * known)) | ranks[known:], known * 2
    while True:
        ranks = np.unique(ranks, return_inverse=True)[1].astype(np.uint64)
        if known == length:
            return ranks[: len(data)]
        step = min(known, length - known)
        later = np.concatenate([ranks[step:], np.zeros(step, np.uint64)])
        ranks, known = (ranks << np.uint64(32)) | later, known + step


def _most_in_common(group: np.ndarray, contexts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many leading bytes each row has in common with that row of its group that has the most in common with it.

    In sorted order that is a neighbour. Rows are filled up to one width, so bytes of zero may count where a row has ended.
    """
    contexts[np.arange(contexts.shape[1]) >= sizes[:, None]] = 0
    keys = np.hstack([group.astype(">u4").view(np.uint8).reshape(-1, 4), contexts])
    order = np.argsort(keys.view(f"S{keys.shape[1]}").ravel())
    keys = keys[order]
    differ = np.hstack([keys[1:] != keys[:-1], np.ones((len(keys) - 1, 1), bool)])
    common = np.concatenate([[0], differ.argmax(axis=1), [0]])
    most = np.empty(len(keys), np.int64)
    most[order] = np.maximum(common[1:], common[:-1]) - 4
    return np.clip(most, 0, sizes)


def _shared_strings(
    whole: np.ndarray, bounds: np.ndarray, trigger: np.ndarray, lot: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """The first of each entry's strings that may equal one of another entry of its trigger and lot, and the one after the last.

    Equal strings have the trigger at the same place, so entries that share one have bytes around their triggers in common.
    """
    sizes = np.diff(bounds)
    strings = sizes - length + 1
    hashes = _rolling(whole).view(np.int64)
    entry = np.repeat(np.arange(len(sizes)), sizes)[: len(hashes)]
    within = np.arange(len(hashes)) - bounds[entry]
    own = (hashes == trigger[entry]) & (within >= strings[entry] - 1) & (within <= length - GRAM)
    found = np.flatnonzero(own)
    at = found[np.searchsorted(found, bounds[:-1])]
    before, group = at - bounds[:-1], _runs(trigger, lot)
    after = np.concatenate([whole, np.zeros(length, np.uint8)])
    back = np.concatenate([whole[::-1], np.zeros(length, np.uint8)])
    after = np.lib.stride_tricks.sliding_window_view(after, length)[at]
    back = np.lib.stride_tricks.sliding_window_view(back, length - GRAM)[len(whole) - at]
    ahead = _most_in_common(group, after, sizes - before)
    behind = _most_in_common(group, back, before)
    return before - behind, np.minimum(before - length + ahead + 1, strings)


def _earliest(rows: pa.RecordBatch, length: int) -> pa.RecordBatch:
    trigger, lot, _, docs, starts = (rows.column(k).to_numpy(zero_copy_only=False) for k in range(5))
    whole, bounds = _bytes(rows.column(5))
    first, strings = bounds[:-1], np.diff(bounds) - length + 1
    entry = np.repeat(np.arange(len(strings)), strings)
    within = np.arange(len(entry)) - np.repeat(np.cumsum(strings) - strings, strings)
    doc, start = docs[entry], starts[entry] + within
    new = np.ones(len(entry), bool)
    low, high = _shared_strings(whole, bounds, trigger, lot, length)
    asked = np.flatnonzero((within >= low[entry]) & (within < high[entry]))
    if len(asked):
        # Only the bytes of strings that may be equal are put in order.
        some = np.flatnonzero(high > low)
        sizes = (high - low)[some] + length - 1
        begin = np.cumsum(sizes) - sizes
        taken = np.arange(sizes.sum()) - np.repeat(begin - (first + low)[some], sizes)
        number = np.cumsum(high > low)[entry[asked]] - 1
        rank = suffix_ranks(whole[taken], length)[begin[number] + within[asked] - low[entry[asked]]]
        order = np.lexsort((start[asked], doc[asked], rank))
        new[asked[order]] = np.concatenate([[True], rank[order][1:] != rank[order][:-1]])
    hot = rows.column(2).to_numpy(zero_copy_only=False)[entry]
    settled, open_ = np.flatnonzero(new & ~hot), np.flatnonzero(new & hot)
    begins = np.concatenate([[True], (np.diff(settled) != 1) | (np.diff(entry[settled]) != 0)]) if len(settled) else []
    begin = np.flatnonzero(begins)
    ends = np.append(begin[1:], len(settled)) - 1 if len(begin) else begin
    digests = [
        xxhash.xxh3_128_digest(whole[a : a + length]) for a in (first[entry[open_]] + within[open_]).tolist()
    ]
    keys = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    runs = settled[begin] if len(begin) else settled
    stops = np.concatenate([start[settled[ends]] + 1 if len(begin) else start[settled], start[open_] + 1])
    none = [None] * len(runs)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([doc[runs], doc[open_]])),
            pa.array(np.concatenate([start[runs], start[open_]]).astype(np.int32)),
            pa.array(stops.astype(np.int32)),
            pa.array([*none, *keys[:, 0].tolist()], pa.int64()),
            pa.array([*none, *keys[:, 1].tolist()], pa.int64()),
        ],
        ["doc", "start", "stop", "high", "low"],
    )


def removed_spans(size: int, starts: np.ndarray, stops: np.ndarray, length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal runs of bytes that repeated strings cover, given the runs of places where new strings start."""
    strings = size - length + 1
    if strings <= 0:
        return []
    order = np.argsort(starts)
    begin = np.concatenate([[0], stops[order]])
    end = np.concatenate([starts[order], [strings]])
    spans: list[tuple[int, int]] = []
    for a, b in zip(begin.tolist(), end.tolist()):
        if b > a:
            if spans and a <= spans[-1][1]:
                spans[-1] = (spans[-1][0], b + length - 1)
            else:
                spans.append((a, b + length - 1))
    return spans


def remove_repeats(
    docs: DataFrame,
    id_column: str,
    text_column: str,
    carry: list[str],
    length: int = LENGTH,
    capacity: int = CAPACITY,
    as_text: bool = False,
) -> DataFrame:
    """The columns of ``carry`` with n_bytes, n_removed, n_spans, spans (array of start, stop) and kept (bytes).

    ``as_text``: instead of kept, text; characters of which a cut leaves only some bytes are left out.
    """
    last = "text" if as_text else "kept"
    results = ("n_bytes", "n_removed", "n_spans", "spans", last)
    carry = [name for name in carry if name not in results]
    columns = [F.col(f"`{name}`").alias(f"__c{k}") for k, name in enumerate(carry)]
    keyed = docs.select(
        F.col(id_column).cast("long").alias("doc"), F.coalesce(F.col(text_column), F.lit("")).alias("text"), *columns
    )
    if not keyed.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc is null").isEmpty():
        # Ids cannot tell the rows apart: numbers in the order of id and text do.
        keyed = keyed.orderBy("doc", "text").withColumn("doc", F.monotonically_increasing_id())
        keyed = written(keyed, "keyed-documents")
    runs = new_strings(keyed.select("doc", "text"), length, capacity)
    runs = runs.groupBy(F.col("doc").alias("owner")).agg(F.collect_list(F.struct("start", "stop")).alias("runs"))
    runs = written(runs, "new-runs")
    joined = keyed.join(runs, keyed.doc == runs.owner, "left").drop("doc", "owner")
    names = [f"__c{k}" for k in range(len(carry))]
    joined = joined.select("text", "runs", *names)
    made = "n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,stop:long>>"
    made += ", text string" if as_text else ", kept binary"
    out = StructType([*[joined.schema[name] for name in names], *StructType.fromDDL(made)])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sizes, gone, counts, spans, kept = [], [], [], [], []
            for k in range(part.num_rows):
                data = part.column(0)[k].as_py().encode("utf-8", "surrogatepass")
                own = part.column(1)[k]
                flat = own.values if own.is_valid else pa.array([], pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
                cut = removed_spans(len(data), *(c.to_numpy().astype(np.int64) for c in flat.flatten()), length)
                edges = [0, *[edge for span in cut for edge in span], len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
                sizes.append(len(data))
                gone.append(len(data) - len(kept[-1]))
                counts.append(len(cut))
                spans.append([{"start": a, "stop": b} for a, b in cut])
            columns = [pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(counts, pa.int64())]
            if as_text:
                kept = [data.decode("utf-8", "ignore") for data in kept]
            columns += [pa.array(spans, kind), pa.array(kept, pa.string() if as_text else pa.binary())]
            yield pa.RecordBatch.from_arrays([*part.columns[2:], *columns], out.names)

    result = joined.mapInArrow(batches, out)
    return result.withColumnsRenamed(dict(zip(names, carry)))
