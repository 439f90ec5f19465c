"""Write PLANS.md: formatted physical plans of the key queries, with notes.

    python tools/explain_plans.py [sf_dir]

Plans are taken over a Bronze Parquet layer written from the driver's
orders (the production shape: Silver and Gold read layers, not raw text).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata import bronze, gold, silver  # noqa: E402
from strata.operators import summaries  # noqa: E402
from strata.operators.quality import reject_counts, stage_counts  # noqa: E402
from strata.plans.sql import sql_province_totals  # noqa: E402
from strata.session import get_session, scratch_path  # noqa: E402
from strata.sinks.layers import write_layer  # noqa: E402
from strata.sources.files import read_layer  # noqa: E402
from strata.sources.fixtures import orders_clean, orders_src  # noqa: E402
from strata.sources.generate import generate_dirty_orders  # noqa: E402
from strata.schemas import BUSINESS_COLUMNS  # noqa: E402


def _explain(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    bronze_path = scratch_path(spark, "plans-bronze")
    write_layer(bronze(orders_src(spark, sf_dir, with_source_file=True)), bronze_path)
    clean_path = scratch_path(spark, "plans-clean")
    orders_clean(spark, sf_dir).write.parquet(clean_path)
    b = read_layer(spark, bronze_path)
    clean = read_layer(spark, clean_path)

    sections = [
        (
            "Gold over the Bronze layer (Silver rules + per-province summary)",
            gold(silver(b)),
            "ReadSchema holds 4 of the 8 Bronze columns; IsNotNull filters reach the scan; "
            "the rules are one Filter + Project; HashAggregate runs partial before the "
            "hash exchange on province and amount bin (at most tasks x provinces x bins rows cross "
            "it) and final after; a second aggregate puts the few bins of a province together; "
            "the range exchange + sort only orders the 5 result rows.",
        ),
        (
            "Silver over the Bronze layer",
            silver(read_layer(spark, bronze_path, BUSINESS_COLUMNS)),
            "No exchange: one narrow stage from scan to output; lineage columns are not read.",
        ),
        (
            "Reject reasons",
            reject_counts(b),
            "Partial aggregation per task, then a tiny exchange keyed on the reason label.",
        ),
        (
            "Stage counts with the Gold group count",
            stage_counts(b, group_key="province"),
            "Two levels of partial/final aggregation instead of COUNT(DISTINCT): no Expand, "
            "no duplicated rows; the second level runs over one row per province.",
        ),
        (
            "SUCCESS totals, DataFrame form, over a Parquet order table",
            summaries.province_totals(clean, status="SUCCESS"),
            "PushedFilters: EqualTo(status,SUCCESS) at the scan.",
        ),
        (
            "SUCCESS totals, SQL form",
            sql_province_totals(spark, clean, status="SUCCESS"),
            "Same plan shape as the DataFrame form; COUNT(*) lets the scan skip order_id.",
        ),
        (
            "Preview (first 10 orders)",
            summaries.preview(clean, 10),
            "TakeOrderedAndProject: each task keeps its own top 10, no full sort.",
        ),
        (
            "Dirty order generator",
            generate_dirty_orders(spark, n=1_000_000),
            "Range -> projections only: one md5 per row, no exchange.",
        ),
    ]
    out = [
        "# Physical plans of the key queries",
        "",
        f"Generated by `tools/explain_plans.py` over `{sf_dir}` (Spark {spark.version}, local mode,",
        "AQE on; the plans below are the initial adaptive plans). Scan locations are scratch paths.",
        "",
    ]
    for title, df, note in sections:
        out += [f"## {title}", "", note, "", "```", _explain(df).strip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
