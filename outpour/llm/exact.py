"""Exact dedup by progressive refinement: length, then a hash of the prefix, then a hash of the whole text.

Each level looks only at rows that the level before left together with another row: prefixes are hashed only in
groups of equal length, whole texts only in groups of equal length and prefix. The groups of a level reach the next
scan as a gate (``store.gate``, sized by the groups), so texts are not shuffled to find out which of them have copies; a
false hit of the gate costs one hash and changes nothing. Beyond some 30 million groups a gate lets all rows pass. Only rows that survive all levels are written and joined.

Everything is DataFrame functions. Copies are counted map-side first, and the join of survivors with their groups is
between two written tables, so that Spark's adaptive execution can split a group of any size.

Null texts count as empty. Among rows of equal text the one with the largest id stays (nulls are smallest); of rows that
repeat this id too, exactly one. Columns named like the results (keep_id, group_size, kept) are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outpour.llm.store import gate, gated, written

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PREFIX_CHARS = 64


def normalised(text: Column) -> Column:
    """The text with A to Z in lower case and all else as it is; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())


def exact_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """Rows (the columns of ``carry``; default all) with keep_id, group_size and kept."""
    results = ("keep_id", "group_size", "kept")
    columns = [name for name in (docs.columns if carry is None else carry) if name not in results]
    text = F.coalesce(F.col(text_column), F.lit(""))
    length = F.octet_length(text).alias("__length")
    prefix = F.xxhash64(normalised(F.substring(text, 1, PREFIX_CHARS))).alias("__prefix")

    lengths = gate(_repeated(docs.select(length)))
    same_length = gated(docs.select(text_column), lengths, [length], "__shared").where("__shared")
    prefixes = gate(_repeated(same_length.select(length, prefix)))
    rows = gated(docs, prefixes, [length, prefix], "__shared")

    kept_columns = [F.col(f"`{name}`") for name in columns]
    alone = rows.where(~F.col("__shared")).select(
        *kept_columns,
        F.col(id_column).alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
    )
    survivors = written(
        rows.where("__shared").select(
            *kept_columns,
            F.col(id_column).alias("__id"),
            F.sha2(normalised(F.col(text_column)), 256).alias("__full"),
            F.monotonically_increasing_id().alias("__row"),
        ),
        "exact-survivors",
    )
    groups = written(
        survivors.groupBy("__full").agg(
            F.max(F.struct("__id", "__row")).alias("__keep"), F.count(F.lit(1)).alias("group_size")
        ),
        "exact-groups",
    )
    together = survivors.join(groups, "__full").select(
        *kept_columns,
        F.col("__keep.__id").alias("keep_id"),
        "group_size",
        (F.col("__row") == F.col("__keep.__row")).alias("kept"),
    )
    return alone.unionByName(together)


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that stay, with the columns they had."""
    results = {"keep_id": "__own_keep_id", "group_size": "__own_group_size", "kept": "__own_kept"}
    renamed = docs.withColumnsRenamed(results)
    staying = exact_groups(renamed, results.get(id_column, id_column), results.get(text_column, text_column))
    staying = staying.where("kept").drop("keep_id", "group_size", "kept")
    return staying.withColumnsRenamed({new: old for old, new in results.items()}).select(*docs.columns)


def _repeated(keys: DataFrame) -> DataFrame:
    """The keys that more than one row has."""
    names = keys.columns
    return keys.groupBy(*names).agg(F.count(F.lit(1)).alias("__rows")).where("__rows > 1").select(*names)
