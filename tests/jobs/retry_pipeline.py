"""Run the pipeline with every task's first attempt failing (task retries on).

Used by tests/test_fault_tolerance.py in its own process, because task
retries in local mode need a ``local[N,F]`` master. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import StringType  # noqa: E402

from strata.plans.pipeline import run_pipeline  # noqa: E402
from strata.session import get_session, scratch_path  # noqa: E402
from strata.sources.files import read_layer  # noqa: E402
from strata.sources.fixtures import orders_src  # noqa: E402


MARKERS = sys.argv[2] if len(sys.argv) > 2 else None


@F.udf(StringType())
def fail_first_attempt(value):
    # Test-only fault injection: the first attempt of every task dies.
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0:
        if MARKERS:
            open(os.path.join(MARKERS, f"stage{ctx.stageId()}-part{ctx.partitionId()}"), "w").close()
        raise RuntimeError("injected task failure")
    return value


def main() -> None:
    spark = get_session(app_name="strata-retry", master="local[4,4]", shuffle_partitions=4)
    spark.sparkContext.setLogLevel("OFF")
    src = orders_src(spark, sys.argv[1], with_source_file=True)
    # After the shuffle, so the failing tasks are the ones writing Bronze
    # (and carrying its observed row count).
    flaky = src.repartition(4).withColumn("customer_id", fail_first_attempt("customer_id"))
    res = run_pipeline(spark, flaky, scratch_path(spark, "lakehouse-retry"))
    gold = {r.province: list(r)[1:] for r in read_layer(spark, res.paths["gold"]).collect()}
    print(json.dumps({"counts": res.counts, "rejects": res.rejects, "gold": gold}))
    spark.stop()


if __name__ == "__main__":
    main()
