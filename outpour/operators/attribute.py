"""Attribute responses that lie in a table (a request log) to the rows of their batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outpour.functions.attribution import WHOLE_KINDS, batch_error, item_error, stray_failures
from outpour.operators.conform import quoted


def _no_response() -> Column:
    return F.struct(F.lit(None).cast("string").alias("error_code"), F.lit("No response").alias("error_message"))


def attribute(numbered: DataFrame, responses: DataFrame) -> DataFrame:
    """Numbered rows with ``success``, ``error_code`` and ``error_message``.

    ``responses`` has one row per batch: ``bucket``, ``batch_no`` and ``response``
    (``functions.attribution.RESPONSE_TYPE``). A batch without a response failed as a whole.

    Failures are taken apart into one line per item before they meet the rows, so that a batch of which
    all items failed costs no more than its size. Both joins are on batches or items of batches, which are
    bounded, so no key is hot. No filter asks for the response: Spark would move it below the step that made one row
    per batch out of many, and compute the response of a large batch for each of them.
    """
    batch, item = ["bucket", "batch_no"], ["bucket", "batch_no", "item_number"]
    response = F.col("response")
    answered = F.when(response.isNotNull(), F.lit(True)).alias("__answered")
    general = responses.select(*batch, answered, batch_error(response).alias("__general"))
    named = F.when(response["kind"].isNull() | ~response["kind"].isin(*WHOLE_KINDS), response["failed"])
    # The outer form, since Spark filters by the size of what the other one takes apart.
    lines = responses.select(*batch, F.posexplode_outer(named).alias("__pos", "__line"))
    lines = lines.select(*batch, "__pos", "__line", F.col("__line.item_number").alias("item_number"))
    own = F.max_by(item_error(F.col("__line")), "__pos").alias("__own")
    failures = lines.where(F.col("item_number").isNotNull()).groupBy(*item).agg(own)

    joined = numbered.join(general, batch, "left").join(failures, item, "left")
    error = F.when(F.col("__answered").isNull(), _no_response()).otherwise(F.coalesce("__own", "__general"))
    columns = [F.col(quoted(name)) for name in numbered.columns]
    return joined.select(*columns, error.alias("__error")).select(
        *columns,
        F.col("__error").isNull().alias("success"),
        F.col("__error.error_code").alias("error_code"),
        F.col("__error.error_message").alias("error_message"),
    )


def stray_items(numbered: DataFrame, responses: DataFrame) -> DataFrame:
    """Batches whose response names items they do not have: ``bucket``, ``batch_no``, ``strays``."""
    sizes = numbered.groupBy("bucket", "batch_no").agg(F.max("item_number").alias("items"))
    strays = stray_failures(F.col("response.failed"), F.col("items"))
    found = sizes.join(responses, ["bucket", "batch_no"]).select("bucket", "batch_no", strays.alias("strays"))
    return found.filter(F.col("strays") > 0)
