"""Put rows into batches by number, and gather batches into requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outpour.contracts import Context
from outpour.errors import ContractError
from outpour.functions.canonical import canonical, is_plain
from outpour.functions.identity import has_unknown_user_id, identity_field
from outpour.functions.payloads import item_json
from outpour.operators.checks import rejection_reasons
from outpour.operators.conform import conform, missing_columns, quoted
from outpour.sources.session import written

BATCH_COLUMNS = ("bucket", "batch_no", "item_number")

# Batches of one bucket that stay together when unfolded rows are spread over the tasks.
SPREAD_BATCHES = 64


def number_batches(
    df: DataFrame,
    batch_size: int,
    key: list[str],
    bucket: Column | int | str | None = None,
    slices: int = 1,
    unique_rows: bool = False,
    only: Column | None = None,
    parallelism: int | None = None,
    names: tuple[str, str, str] = BATCH_COLUMNS,
    in_order: bool = False,
    most_copies: int | None = None,
) -> DataFrame:
    """Add ``bucket``, ``batch_no`` (from 0) and ``item_number`` (from 1).

    The same rows in the same buckets always get the same numbers, whatever the partitioning: within a
    bucket rows are ordered by ``key`` and cut into batches of ``batch_size``, the last one short. Rows
    that fail ``only`` are kept with null numbers. The default number of buckets follows a setting of the
    session, so give one where numbers must outlive it, or ``"global"``: then all rows are one bucket in the
    order of ``key``, their numbers depend on nothing but the rows, and one batch in all is short. That
    costs a shuffle by ranges, which is written, and no task takes more than its range.

    A bucket is one window group and ends in one short batch, so it should be large against
    ``batch_size``, yet must not grow with the table. It is a hash into as many buckets as given
    (by default as there are shuffle partitions), or a caller's Column: one with bounded groups,
    such as blocks of ids, or one cut into ``slices`` by hash.

    Copies of a row cannot be told apart by any hash, so they are first folded into one row with
    a count, and unfolded after they have been numbered and spread again. Columns of any type will do: maps,
    variants, strings with a collation and signed zeros are told apart by their canonical form and come back as they are. ``unique_rows=True``
    promises that there are no copies and saves that: one shuffle instead of three. So does ``most_copies``, a bound of the
    copies of any row, where it is no more than a span, which unfolding would not cut either; the numbers are the same.

    ``in_order`` makes the rows of a batch lie together, by item number, for a sender that reads
    them as they come.
    """
    if batch_size < 1 or slices < 1:
        raise ValueError("batch_size and slices must be at least 1")
    clashing = [name for name in names if name not in missing_columns(df, list(names))]
    if clashing:
        raise ContractError(f"the frame to be numbered has the columns {clashing} already", clashing, "batches")
    columns = [F.col(quoted(name)) for name in df.columns]
    forms = _forms(df, df.columns)
    tasks = parallelism or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    everywhere = isinstance(bucket, str)
    if everywhere and bucket != "global":
        raise ValueError(f"bucket must be a Column, a number or 'global', not {bucket!r}")
    if bucket is None or isinstance(bucket, int):
        hashed = _forms(df, key) if unique_rows else forms
        bucket = F.pmod(F.xxhash64(*hashed), F.lit(bucket or tasks))
    elif everywhere:
        bucket = F.lit(0)
    if slices > 1 and not everywhere:
        bucket = bucket * slices + F.pmod(F.xxhash64(*forms), F.lit(slices))
    rows = df.withColumn("__numbered", F.lit(True) if only is None else F.coalesce(only, F.lit(False)))
    few_copies = most_copies is not None and most_copies <= SPREAD_BATCHES * batch_size and not everywhere
    unfolded = unique_rows or few_copies
    if unfolded:
        rows = rows.withColumn("__copies", F.lit(1).cast("long"))
    else:
        rows = _folded(rows, df, forms)
    rows = rows.withColumn("__bucket", bucket.cast("long"))

    # Rows that are said to be unique may still share a key. Copies share all of this and lie together.
    order = [*_forms(df, key, ordered=True), F.xxhash64(*forms)]
    if everywhere:
        placed = _placed_globally(rows, order, tasks)
        # Ranges cut batches, which must lie together where they are sent.
        if not unique_rows or in_order:
            placed = _unfold(placed, SPREAD_BATCHES * batch_size, tasks, in_order)
        else:
            placed = placed.withColumn("__place", F.col("__first"))
    else:
        if parallelism is not None or not unique_rows and few_copies:
            # As many tasks as there would be with unfolding.
            rows = rows.repartition(tasks, "__bucket")
        window = W.partitionBy("__bucket", "__numbered").orderBy(*order)
        if unfolded:
            placed = rows.withColumn("__place", F.row_number().over(window).cast("long") - 1)
        else:
            placed = _unfold(_placed(rows, window), SPREAD_BATCHES * batch_size, tasks, in_order)
    numbers = [
        F.col("__bucket"),
        F.expr(f"__place div {batch_size}"),
        (F.col("__place") % batch_size + 1).cast("int"),
    ]
    if only is not None:
        numbers = [F.when(F.col("__numbered"), number) for number in numbers]
    return placed.select(*columns, *[number.alias(name) for number, name in zip(numbers, names)])


def _forms(df: DataFrame, names: list[str], ordered: bool = False) -> list[Column]:
    """Columns in canonical form; ``ordered`` leaves those alone that have an order of their own."""
    forms = []
    for name in names:
        kind = df.select(quoted(name)).schema[0].dataType
        keep = ordered and isinstance(kind, (T.StringType, T.FloatType, T.DoubleType))
        forms.append(F.col(quoted(name)) if keep else canonical(F.col(quoted(name)), kind))
    return forms


def _folded(rows: DataFrame, df: DataFrame, forms: list[Column]) -> DataFrame:
    """One row for each set of copies, with their number. Values that grouping would change are carried beside it."""
    grouped, carried = [], []
    for place, (field, form) in enumerate(zip(df.schema, forms)):
        if is_plain(field.dataType):
            grouped.append(F.col(quoted(field.name)))
        else:
            grouped.append(form.alias(f"__form_{place}"))
            carried.append(F.first(quoted(field.name)).alias(field.name))
    return rows.groupBy(*grouped, "__numbered").agg(F.count(F.lit(1)).alias("__copies"), *carried)


def _placed(rows: DataFrame, window: W) -> DataFrame:
    """``__first``: the place of a row's first copy in its window."""
    before = F.sum("__copies").over(window.rowsBetween(W.unboundedPreceding, -1))
    return rows.withColumn("__first", F.coalesce(before, F.lit(0).cast("long")))


def _placed_globally(rows: DataFrame, order: list[Column], tasks: int) -> DataFrame:
    """``__first``: the place of a row's first copy among all rows, however they are partitioned.

    Spark cuts the order into ranges by a sample; which ranges does not matter, since rows are written with the range
    they are in, and the places of a range start at the number of copies before it. Of each range one number
    comes to the driver.
    """
    keyed = rows.select("*", *[column.alias(f"__order_{n}") for n, column in enumerate(order)])
    names = [f"__order_{n}" for n in range(len(order))]
    ranged = keyed.repartitionByRange(tasks, "__numbered", *names).withColumn("__range", F.spark_partition_id())
    ranged = written(ranged, "batch-ranges")
    counts = ranged.filter("__numbered").groupBy("__range").agg(F.sum("__copies").alias("copies")).collect()
    before, starts = 0, []
    for row in sorted(counts):
        starts.append((row["__range"], before))
        before += row["copies"]
    starts = rows.sparkSession.createDataFrame(starts, "__range int, __before long")
    placed = _placed(ranged, W.partitionBy("__range", "__numbered").orderBy(*names))
    placed = placed.join(F.broadcast(starts), "__range", "left")
    return placed.withColumn("__first", F.col("__first") + F.coalesce("__before", F.lit(0).cast("long"))).drop(*names)


def _unfold(placed: DataFrame, span: int, tasks: int, in_order: bool) -> DataFrame:
    """Give each of a row's ``__copies`` its place, from ``__first`` on.

    The places of a row are cut into spans, the spans are spread over all tasks, and only there
    unfolded, so a row with very many copies is nobody's burden. The number of tasks is given,
    since Spark would otherwise merge the small folded partitions.
    """
    placed = placed.withColumn("__last", F.col("__first") + F.col("__copies") - 1)
    spans = F.explode(F.expr(f"sequence(__first div {span}, __last div {span})"))
    placed = placed.withColumn("__span", spans)
    placed = placed.repartition(tasks, "__bucket", "__span")
    if in_order:
        # Folded rows are fewer than unfolded ones, and unfolding keeps their order.
        placed = placed.sortWithinPartitions("__bucket", "__span", "__numbered", "__first")
    start = F.col("__span") * span
    places = F.sequence(F.greatest("__first", start), F.least("__last", start + span - 1))
    return placed.withColumn("__place", F.explode(places))


def has_user_ids(context: Context) -> Column:
    """True for rows whose item carries user ids."""
    if context.contract.by_identity:
        return F.lit(False)
    return F.coalesce(F.size("user_ids") > 0, F.lit(False)) & ~has_unknown_user_id(F.col("user_ids"))


def shape(df: DataFrame, context: Context, documented: bool = False) -> DataFrame:
    """Add to a conformed frame ``_reasons``, ``_item`` (JSON, null if rejected) and ``_has_ids``."""
    contract = context.contract
    if contract.by_identity:
        df = df.select("*", identity_field(F.col("id_type")).alias("_field"))
        field = F.col("_field")
    else:
        field = F.lit(None).cast("string")
    judged = df.select("*", rejection_reasons(contract, documented, field).alias("_reasons"))
    item = F.when(F.size("_reasons") == 0, item_json(contract.item(field)))
    return judged.select("*", item.alias("_item"), has_user_ids(context).alias("_has_ids")).drop("_field")


def gather_requests(
    numbered: DataFrame,
    context: Context,
    trace_id: str | None = None,
    documented: bool = False,
    with_key: bool = False,
) -> DataFrame:
    """One row per batch of a numbered frame: its size, envelope and body; ``with_key``, the key of the request too.

    Groups are batches, so none is larger than the batch size. Only the items are shuffled. A body holds
    exactly the items that were numbered, else responses would be attributed to the wrong rows: a numbered
    row that cannot be shaped is an error (number with ``only``, by the same ``documented``).
    """
    items = shape(conform(numbered, context.contract), context, documented).filter(F.col("batch_no").isNotNull())
    unfit = F.concat(F.lit("a numbered row cannot be sent: "), F.array_join("_reasons", ", "))
    entry = F.struct("item_number", F.coalesce(F.col("_item"), F.raise_error(unfit)).alias("_item"))
    requests = (
        items.select("bucket", "batch_no", entry.alias("entry"), "_has_ids")
        .groupBy("bucket", "batch_no")
        .agg(
            F.array_sort(F.collect_list("entry")).alias("entries"),
            F.bool_or("_has_ids").alias("has_user_ids"),
        )
    )
    envelope = F.when(F.col("has_user_ids"), F.lit(context.envelope(trace_id, True))).otherwise(
        F.lit(context.envelope(trace_id))
    )
    texts = F.array_join(F.transform("entries", lambda entry: entry["_item"]), ",")
    scope = F.when(F.col("has_user_ids"), F.lit(context.envelope(None, True))).otherwise(F.lit(context.envelope()))
    digests = F.array_sort(F.transform("entries", lambda entry: F.sha2(entry["_item"], 256)))
    key = F.sha2(F.concat_ws("\n", F.lit(context.contract.path), scope, digests), 256).alias("request_key")
    return requests.select(
        "bucket",
        "batch_no",
        F.size("entries").alias("items"),
        "has_user_ids",
        envelope.alias("envelope"),
        F.concat(F.expr("left(envelope, length(envelope) - 1)"), F.lit(',"items":['), texts, F.lit("]}")).alias("body"),
        *([key] if with_key else []),
    )
