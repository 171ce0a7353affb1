"""Look back at earlier results: what to send again, and what not to."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outpour.functions.canonical import canonical
from outpour.operators.conform import quoted
from outpour.operators.increment import instant
from outpour.operators.keyfilter import KeyFilter, look_at, word_of
from outpour.sources.session import written

# Rows of a key beyond this many are dealt out to several tasks.
HOT_ROWS = 1_000_000


def retry_set(results: DataFrame, key: list[str]) -> DataFrame:
    """One row for each key whose latest status is a failure: that latest result.

    At the same instant a success beats a failure. Of the successes only the key and the time
    are read, and both sides are reduced to one row per key before they are shuffled, so a key
    with a long history costs no more than any other. The key is compared as a struct, in which
    nulls are equal; both sides are already partitioned by it when they are joined.
    """
    columns = [F.col(quoted(name)) for name in results.columns]
    by_key = F.struct(*[F.col(name) for name in key]).alias("_key")
    at = F.col("processed_timestamp")
    forms = [canonical(F.col(quoted(field.name)), field.dataType) for field in results.schema]
    latest = F.max_by(F.struct(*columns), F.struct(at, F.xxhash64(*forms)))
    failed = results.filter(~F.col("success")).groupBy(by_key)
    failed = failed.agg(latest.alias("_latest"), F.max(at).alias("_failed_at"))
    succeeded = results.filter(F.col("success")).groupBy(by_key).agg(F.max(at).alias("_succeeded_at"))
    last = failed.join(succeeded, "_key", "left")
    still = F.col("_succeeded_at").isNull() | (F.col("_succeeded_at") < F.col("_failed_at"))
    return last.filter(still).select("_latest.*")


def _dealt(rows: DataFrame) -> Column:
    """A number by which copies of a key, and even of a row, are dealt out; the same whenever a task is run again."""
    plain = [F.col(quoted(field.name)) for field in rows.schema if isinstance(field.dataType, _PLAIN)]
    return F.xxhash64(*plain, F.spark_partition_id())


# Types whose values have one hash, whatever a table stores them as.
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_PLAIN = (*_WHOLE, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType, T.BinaryType, T.StringType)


def key_hash_columns(df: DataFrame, other: DataFrame, key: list[str]) -> list[str] | None:
    """SQL expressions over key columns whose hashes agree between two frames; None if there are none.

    Whole numbers of different widths are equal but have different hashes, so they are widened first.
    """
    found = []
    for name in key:
        kinds = [frame.select(quoted(name)).schema[0].dataType for frame in (df, other)]
        if all(isinstance(kind, _WHOLE) for kind in kinds):
            found.append(f"cast({quoted(name)} as bigint)")
        elif kinds[0] == kinds[1] and isinstance(kinds[0], _PLAIN) and not _collated(kinds[0]):
            found.append(quoted(name))
        else:
            return None
    return found


def _collated(kind: T.DataType) -> bool:
    return isinstance(kind, T.StringType) and kind != T.StringType()


def skip_delivered(
    rows: DataFrame,
    results: DataFrame,
    key: list[str],
    hot_rows: int = HOT_ROWS,
    version: str | None = None,
    since: datetime | None = None,
    seen: KeyFilter | None = None,
    keys_first: bool = False,
) -> DataFrame:
    """The rows whose key has no successful result yet: an anti join against distinct keys.

    ``version`` names a column of both that grows when a row changes: a row also stays if its version is
    above all that were delivered for its key. A null version says nothing, so then the key decides.
    ``since`` bounds the look back: results processed before it are not read.

    One pass over the key columns of ``rows`` runs as a job when this is called (or was made before, ``seen``). It makes a
    filter of the keys, which the results are held against where they are scanned, along with the range of the
    keys and the time; what is shuffled of a long history is what may be wanted. It also finds heavy keys, any number of them:
    their rows are dealt out by a hash of the row, and only their delivered keys are repeated as many times.
    Rows with a null in the key match nothing and are spread over all tasks.

    ``keys_first`` also writes the delivered keys that the filter leaves before the join is planned: then Spark knows how
    few they are, and takes them to the rows instead of shuffling all rows to them.
    """
    columns = [F.col(quoted(name)) for name in key]
    hashed = key_hash_columns(rows, results, key)
    delivered = results.filter(F.col("success"))
    if since is not None:
        delivered = delivered.filter(F.col("processed_timestamp") >= instant(since))
    heavy = None
    if hashed is not None:
        seen = seen or look_at(rows, [F.expr(one) for one in hashed], ranged=key)
        delivered = seen.pruned(delivered, [F.expr(one) for one in hashed])
        if seen.most_rows > hot_rows:
            heavy = F.broadcast(seen.heavy(hot_rows))  # at most one row for each ``hot_rows`` rows, and MAX_WORDS
    newest = _newest(delivered, key, version)
    if keys_first and seen is not None and seen.packed is not None:
        newest = written(newest, "delivered-keys")
    names = [F.col(name) for name in newest.columns[: len(key)]]
    parts = F.lit(1)
    if heavy is not None:
        parts = F.coalesce(F.col("__parts"), F.lit(1))
        rows = rows.withColumn("__word", word_of([F.expr(one) for one in hashed])).join(heavy, "__word", "left")
        own = _newest_hashed(hashed, key)
        newest = newest.withColumn("__word", word_of([F.expr(one) for one in own])).join(heavy, "__word", "left")
    no_key = reduce(lambda a, b: a | b, [column.isNull() for column in columns])
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.when(no_key, F.pmod(_dealt(rows), F.lit(tasks))).otherwise(F.pmod(_dealt(rows), parts))
    rows = rows.withColumn("__part", part.cast("long")).drop("__parts", "__word")
    every = F.sequence(F.lit(0).cast("long"), parts.cast("long") - 1)
    newest = newest.select("*", F.explode(every).alias("__of")).drop("__parts", "__word")
    same = reduce(lambda a, b: a & b, [own == other for own, other in zip(columns, names)])
    same = same & (F.col("__part") == F.col("__of"))
    if version is not None:
        older = F.col(quoted(version)) <= F.col("__latest")
        same = same & F.coalesce(older, F.lit(True))
    return rows.join(newest, same, "left_anti").drop("__part")


def _newest_hashed(hashed: list[str], key: list[str]) -> list[str]:
    """The same expressions over the hidden names of ``_newest``."""
    return [one.replace(quoted(name), f"__key_{place}") for place, (one, name) in enumerate(zip(hashed, key))]


def _newest(delivered: DataFrame, key: list[str], version: str | None) -> DataFrame:
    """One row per delivered key, under hidden names, with its latest version if there is one to compare."""
    names = [F.col(quoted(name)).alias(f"__key_{place}") for place, name in enumerate(key)]
    if version is None:
        return delivered.select(*names).distinct()
    return delivered.groupBy(*names).agg(F.max(quoted(version)).alias("__latest"))
