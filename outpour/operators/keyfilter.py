"""What one narrow pass over keys tells: a Bloom filter of them, where they are heavy, and their range.

Everything is a table of words, 64 bits each, by a part of the key's hash. A key sets four bits of its word. The
words are counted first at full resolution and then folded to as many as the keys need, so the filter is as
large as the keys are many, and never larger than ``MAX_WORDS`` (32 MB as a broadcast). Beyond some 30 million keys a filter of that
size says little; then there is none, and callers leave the work to their join.

The rows of each word are counted too. A word with many rows holds heavy keys, however many of those there are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outpour.operators.conform import quoted
from outpour.sources.session import written

MAX_WORDS = 1 << 22
KEYS_PER_WORD = 4
_PACKED = 64
_RANGED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)


def word_of(columns: list[Column]) -> Column:
    """The word of a key at full resolution."""
    return F.xxhash64(*columns).bitwiseAND(F.lit(MAX_WORDS - 1))


def _bits(columns: list[Column]) -> Column:
    """The four bits of a key, from the part of its hash that does not choose the word."""
    hash_, one = F.xxhash64(*columns), F.lit(1).cast("long")
    bits = F.lit(0).cast("long")
    for shift in (40, 46, 52, 58):
        place = F.shiftrightunsigned(hash_, shift).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", one, place))
    return bits


@dataclass(frozen=True)
class KeyFilter:
    """Made by ``look_at``. ``keys``: about how many different keys there are; ``metrics``: what else was asked for.

    ``most_rows``: the most rows of a word; ``most_copies``: no row has more copies than this, one with a null in the key neither.
    """

    words: DataFrame  # word, bits, rows, at full resolution
    packed: DataFrame | None  # group, of 64 words each
    size: int
    keys: int
    ranges: dict[str, tuple] = field(default_factory=dict)
    metrics: dict = field(default_factory=dict)
    most_rows: int = 0
    most_copies: int = 0

    def marked(self, df: DataFrame, columns: list[Column], flag: str) -> DataFrame:
        """Adds whether the key of a row may be among those of the filter; without a filter it always may."""
        if self.packed is None:
            return df.withColumn(flag, F.lit(True))
        word, bits = word_of(columns).bitwiseAND(F.lit(self.size - 1)), _bits(columns)
        rows = df.withColumn("__group", F.shiftright(word, 6)).withColumn("__at", word.bitwiseAND(F.lit(63)).cast("int"))
        rows = rows.withColumn("__asked", bits).join(F.broadcast(self.packed), "__group", "left")
        hit = F.get("__words", F.col("__at")).bitwiseAND(F.col("__asked")) == F.col("__asked")
        return rows.withColumn(flag, F.coalesce(hit, F.lit(False))).drop("__group", "__at", "__asked", "__words")

    def pruned(self, df: DataFrame, columns: list[Column]) -> DataFrame:
        """The rows whose key may be among those of the filter. Ranges of keys reach the scan."""
        for name, (least, most) in self.ranges.items():
            df = df.filter((F.col(quoted(name)) >= F.lit(least)) & (F.col(quoted(name)) <= F.lit(most)))
        if self.packed is None:
            return df
        return self.marked(df, columns, "__maybe").filter("__maybe").drop("__maybe")

    def heavy(self, rows: int) -> DataFrame:
        """__word and __parts (how many of at most ``rows`` rows it has) of the words with more rows than that."""
        parts = F.ceil(F.col("rows") / max(rows, 1)).cast("long")
        return self.words.filter(F.col("rows") > rows).select(F.col("word").alias("__word"), parts.alias("__parts"))


def look_at(
    df: DataFrame,
    columns: list[Column],
    also: dict[str, tuple[str, Column]] | None = None,
    ranged: list[str] | None = None,
) -> KeyFilter:
    """One pass over the keys of ``df``; a job runs when this is called.

    Rows with a null in the key are not part of the filter. ``also`` names further totals of all rows that the same
    pass makes, each ("max" or "sum", column). ``ranged`` names the columns, in which those of whole numbers and
    dates then also have a range.
    """
    also = also or {}
    names = [f"__key_{n}" for n in range(len(columns))]
    rows = df.select(
        *[column.alias(name) for column, name in zip(columns, names)],
        *[column.alias(f"__also_{name}") for name, (_, column) in also.items()],
    )
    keys = [F.col(name) for name in names]
    whole = F.lit(True)
    for key in keys:
        whole = whole & key.isNotNull()
    wide = [name for name in names if ranged and isinstance(rows.schema[name].dataType, _RANGED)]
    totals = {f"__also_{name}": getattr(F, kind) for name, (kind, _) in also.items()}
    words = rows.groupBy(F.when(whole, word_of(keys)).alias("word")).agg(
        F.bit_or(F.when(whole, _bits(keys))).alias("bits"),
        F.count(F.lit(1)).alias("rows"),
        *[total(name).alias(name) for name, total in totals.items()],
        *[F.min(F.when(whole, F.col(name))).alias(f"{name}_least") for name in wide],
        *[F.max(F.when(whole, F.col(name))).alias(f"{name}_most") for name in wide],
    )
    words = written(words, "key-words")
    seen = words.agg(
        F.count("word").alias("words"),
        F.max(F.when(F.col("word").isNotNull(), F.col("rows"))).alias("most_rows"),
        F.max("rows").alias("most_copies"),
        *[total(name).alias(name) for name, total in totals.items()],
        *[F.min(f"{name}_least").alias(f"{name}_least") for name in wide],
        *[F.max(f"{name}_most").alias(f"{name}_most") for name in wide],
    ).first()
    words = words.filter("word is not null").select("word", "bits", "rows")
    # Linear counting: how many keys leave so many words empty.
    empty = 1 - seen["words"] / MAX_WORDS
    count = MAX_WORDS * 16 if empty <= 0 else round(-MAX_WORDS * math.log(empty))
    size = max(_PACKED, 1 << max(0, math.ceil(count / KEYS_PER_WORD) - 1).bit_length())
    packed = None
    if count <= 2 * KEYS_PER_WORD * MAX_WORDS:
        size = min(size, MAX_WORDS)
        folded = words.groupBy(F.col("word").bitwiseAND(F.lit(size - 1)).alias("word")).agg(F.bit_or("bits").alias("bits"))
        entry = F.struct(F.col("word").bitwiseAND(F.lit(_PACKED - 1)).cast("int").alias("at"), "bits")
        packed = folded.groupBy(F.shiftright("word", 6).alias("__group")).agg(F.map_from_entries(F.collect_list(entry)).alias("of"))
        places = F.sequence(F.lit(0), F.lit(_PACKED - 1))
        filled = F.transform(places, lambda n: F.coalesce(F.try_element_at("of", n), F.lit(0).cast("long")))
        packed = written(packed.select("__group", filled.alias("__words")), "key-filter")
    found = {own: (seen[f"{name}_least"], seen[f"{name}_most"]) for own, name in zip(ranged or [], names) if name in wide}
    ranges = {own: bounds for own, bounds in found.items() if bounds[0] is not None}
    metrics = {name: seen[f"__also_{name}"] for name in also}
    return KeyFilter(words, packed, size, count, ranges, metrics, seen["most_rows"] or 0, seen["most_copies"] or 0)
