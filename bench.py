"""Time the headline queries and print one JSON line.

BENCH_SF_DIR is the folder with the test tables, BENCH_CPUS the number of local cores. Each query
is computed in full into Spark's ``noop`` sink; the best of BENCH_RUNS (2) is kept. ``rates``
holds rows per second of the stages of a delivery, with a sender that accepts everything, so it
is Spark's own share of the work.
"""

from __future__ import annotations

import itertools
import json
import os
import sys
import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outpour import CONTRACTS, FirstParty, conform, deliver, result_schema
from outpour.functions.attribution import RESPONSE_TYPE
from outpour.functions.identity import ID_FIELDS
from outpour.operators.attribute import attribute
from outpour.operators.batches import number_batches, shape
from outpour.sources.session import shared_path
from workload.fixtures import memberships
from workload.queries import QUERIES
from workload.senders import accept_all

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINES = [
    "conform_first_party",
    "conform_conversion",
    "id_quarantine",
    "incremental_rows",
    "payload_first_party",
    "payload_conversion",
    "batch_numbers",
    "batch_numbers_of_copies",
    "request_bodies",
    "deliver_status",
    "deliver_in_arrival_order",
    "attribution_last_wins",
    "adhoc_push",
    "batch_run",
    "stream_increment",
    "status_summary",
    "retry_set",
    "replay_skip",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(make) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def best(make) -> float:
    return round(min(seconds(make) for _ in range(RUNS)), 3)


def row_at_a_time(rows: DataFrame, batch_size: int = 1600) -> DataFrame:
    """The same delivery with an RDD function over Python rows, for comparison."""
    fields = ["timestamp_utc", "ttl_in_minutes", "base_bid_cpm", "base_bid_cpm_metadata", "bid_factor"]
    conformed = conform(rows, CONTRACTS["first_party"])

    def deliver_partition(partition):
        while batch := [row.asDict() for row in itertools.islice(partition, batch_size)]:
            moment = datetime.now(timezone.utc)
            items = []
            for row in batch:
                data = {name: row[name] for name in fields if row[name] is not None}
                items.append({ID_FIELDS.get(row["id_type"].upper()): row["id_value"], "data": [data]})
            for row in batch:
                yield (*row.values(), True, None, None, moment)

    return conformed.rdd.mapPartitions(deliver_partition).toDF(result_schema(conformed.schema))


def rates(spark: SparkSession) -> dict[str, int]:
    """Rows per second of each stage, on the memberships of all events spread over all cores."""
    context = FirstParty("adv1")
    path = shared_path(spark, "bench")
    memberships(spark, SF_DIR).repartition(int(CPUS)).write.parquet(path)
    rows = spark.read.parquet(path)
    count = rows.count()
    numbered = number_batches(rows, 1600, ["event_id"], unique_rows=True)
    failed = F.expr("array(struct(3, 'BAD', 'x'))").alias("failed")
    nothing = [F.lit(None).alias(name) for name in ("status", "message")]
    response = F.struct(F.lit("partial").alias("kind"), *nothing, failed).cast(RESPONSE_TYPE)
    responses = numbered.select("bucket", "batch_no").distinct().withColumn("response", response)
    stages = {
        "conform_and_shape": lambda: shape(conform(rows, context.contract), context),
        "number": lambda: numbered,
        "deliver_in_arrival_order": lambda: deliver(rows, context, accept_all, parallelism="source"),
        "deliver_spread": lambda: deliver(rows, context, accept_all),
        "deliver_numbered": lambda: deliver(rows, context, accept_all, key=["event_id"], unique_rows=True),
        "attribute": lambda: attribute(numbered, responses),
        "row_at_a_time": lambda: row_at_a_time(rows),
    }
    return {name: int(count / best(make)) for name, make in stages.items()}


def main() -> None:
    spark = session()
    seconds(lambda: QUERIES["deliver_in_arrival_order"](spark, SF_DIR))
    timings = {name: best(lambda name=name: QUERIES[name](spark, SF_DIR)) for name in HEADLINES}
    result = {
        "metric": "headline queries, total time",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
        "rates": rates(spark),
    }
    print(json.dumps(result))
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()
