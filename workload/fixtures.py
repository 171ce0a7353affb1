"""Inputs in the shape of the contracts, selected from the test tables.

Each SELECT runs on Spark (with the tables as frames) and in the check SQL (with views of the
same names). Arrays are built per row: a conversion never gathers rows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import outpour
import workload
from outpour.sources.session import ship_packages

# One membership per event. CoreID is an identity without a payload field.
MEMBERSHIPS = """
SELECT event_id,
  CASE user_id % 6 WHEN 0 THEN 'TDID' WHEN 1 THEN 'daid' WHEN 2 THEN 'Uid2'
       WHEN 3 THEN 'UID2Token' WHEN 4 THEN 'RampID' ELSE 'CoreID' END AS id_type,
  concat('u', CAST(user_id AS STRING)) AS id_value, event_type AS segment_name,
  ts AS timestamp_utc, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 1440 END AS ttl_in_minutes,
  value AS base_bid_cpm, CAST(event_id AS STRING) AS base_bid_cpm_metadata,
  ts AS updated_at, props AS note
FROM {events}
"""

SUBJECT_REQUESTS = """
SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN 'TDID' WHEN 'BUILDING' THEN 'EUID'
       WHEN 'AUTOMOBILE' THEN 'ID5' WHEN 'HOUSEHOLD' THEN 'netID' ELSE 'FirstId' END AS id_type,
  concat('c', CAST(c_custkey AS STRING)) AS id_value
FROM {customer}
"""

CONVERSIONS = """
SELECT o_orderkey, o_custkey, concat('tag', CAST(o_orderkey % 5 AS STRING)) AS tracking_tag_id,
  o_orderdate AS timestamp_utc, CAST(o_orderkey AS STRING) AS order_id,
  CASE WHEN o_orderkey % 9 = 0 THEN concat('imp', CAST(o_orderkey AS STRING)) END AS impression_id,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL
       ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END AS value,
  'USD' AS value_currency, n_name AS country, o_orderpriority AS td1
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
"""

# One conversion per order line.
LINE_CONVERSIONS = """
SELECT l_orderkey, l_linenumber, l_returnflag, concat('tag', CAST(l_suppkey % 5 AS STRING)) AS tracking_tag_id,
  l_shipdate AS timestamp_utc, CAST(l_orderkey AS STRING) AS order_id,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) AS value,
  CAST(l_partkey AS STRING) AS item_code, p_name AS name,
  CAST(CAST(l_quantity AS INT) AS STRING) AS qty,
  CAST(CAST(l_tax AS DECIMAL(18,2)) AS STRING) AS tax,
  CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_brand END AS cat
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
"""


def prepare(spark: SparkSession) -> None:
    """Zone for the comparison with the check SQL, and our code on the workers."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_packages(spark, *[os.path.dirname(package.__file__) for package in (outpour, workload)])


def select(spark: SparkSession, sf_dir: str, query: str) -> DataFrame:
    """Run a SELECT above with the test tables it names; its times become zone-aware."""
    prepare(spark)
    names = ["events", "customer", "orders", "nation", "lineitem", "part"]
    tables = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names if f"{{{n}}}" in query}
    return times(spark.sql(query, **tables), "timestamp")


def times(df: DataFrame, to: str) -> DataFrame:
    """Cast the frame's time columns: ``timestamp`` going in, ``timestamp_ntz`` for comparing."""
    return df.select(*[F.col(n).cast(to).alias(n) if t.startswith("timestamp") else F.col(n) for n, t in df.dtypes])


def memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select(spark, sf_dir, MEMBERSHIPS)


def subject_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select(spark, sf_dir, SUBJECT_REQUESTS)


def conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders; three of four have a TDID, one of four also a RampID."""
    tdid = F.struct(F.lit("TDID").alias("type"), F.concat(F.lit("c"), F.col("o_custkey")).alias("id"))
    ramp = F.struct(F.lit("rampid").alias("type"), F.concat(F.lit("r"), F.col("o_custkey")).alias("id"))
    kind = F.col("o_orderkey") % 4
    user_ids = F.when(kind == 2, F.array(tdid, ramp)).when(kind != 0, F.array(tdid))
    return select(spark, sf_dir, CONVERSIONS).withColumn("user_ids", user_ids)


def line_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines; returned ones have a second line item, lines 6 and 7 have none."""
    rows = select(spark, sf_dir, LINE_CONVERSIONS)
    line = F.struct("item_code", "name", "qty", F.col("value").alias("price"), "cat")
    nothing = F.lit(None).cast("string")
    tax = F.struct(
        F.lit("TAX").alias("item_code"),
        nothing.alias("name"),
        F.lit("1").alias("qty"),
        F.col("tax").alias("price"),
        nothing.alias("cat"),
    )
    items = F.when(F.col("l_returnflag") == "R", F.array(line, tax)).otherwise(F.array(line))
    items = F.when(F.col("l_linenumber") == 6, F.lit(None)).when(F.col("l_linenumber") == 7, F.array()).otherwise(items)
    applies = F.col("l_orderkey") % 2 == 1
    privacy = F.struct(
        F.lit("GDPR").alias("privacy_type"),
        applies.cast("string").alias("is_applicable"),
        F.when(applies, F.concat(F.lit("consent"), F.col("l_orderkey"))).alias("consent_string"),
    )
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "tracking_tag_id",
        "timestamp_utc",
        "order_id",
        "value",
        items.alias("line_items"),
        F.array(privacy).alias("privacy_settings"),
    )
