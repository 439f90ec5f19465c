"""Gold over skewed data: count the rows that actually cross the shuffle.

Runs in its own process with Spark's event log on (argv[2] is the log
folder). Two thirds of the orders are moved to one province; the partial
(map-side) aggregation must still send at most ``map tasks x provinces``
rows through the exchange. Prints one JSON line.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import zstandard  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from strata import bronze, gold, silver  # noqa: E402
from strata.session import get_session  # noqa: E402
from strata.sources.fixtures import orders_src  # noqa: E402


def _events(folder: str):
    for path in glob.glob(os.path.join(folder, "**", "events_*"), recursive=True) + glob.glob(
        os.path.join(folder, "local-*")
    ):
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def main() -> None:
    sf_dir, log_dir = sys.argv[1], sys.argv[2]
    spark = get_session(
        app_name="strata-skew",
        master="local[4]",
        shuffle_partitions=8,
        extra_conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir},
    )
    spark.sparkContext.setLogLevel("OFF")
    src = orders_src(spark, sf_dir)
    hot = F.when(F.col("customer_id") < F.lit("CUS034"), F.lit("Hanoi")).otherwise(F.col("province"))
    skewed = src.withColumn("province", hot).repartition(8, "order_id")
    result = {r.province: list(r)[1:] for r in gold(silver(bronze(skewed))).collect()}
    spark.stop()  # flushes the event log

    stage_records: dict[int, int] = {}
    stage_tasks: dict[int, int] = {}
    for e in _events(log_dir):
        if e.get("Event") == "SparkListenerTaskEnd":
            written = e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Records Written"]
            if written:
                stage_records[e["Stage ID"]] = stage_records.get(e["Stage ID"], 0) + written
                stage_tasks[e["Stage ID"]] = stage_tasks.get(e["Stage ID"], 0) + 1
    print(json.dumps({"gold": result, "stage_records": stage_records, "stage_tasks": stage_tasks}))


if __name__ == "__main__":
    main()
