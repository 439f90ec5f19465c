"""Command line: ``python -m strata <command>`` (or ``spark-submit -m``-style).

    sample       the built-in 8-row sample table: rows, SUCCESS rows, per-province totals
    generate     write generated raw orders as CSV files (dirty or clean)
    pipeline     source -> Bronze -> Silver -> Gold Parquet layers under a base URI
    incremental  the same, processing only files not seen by earlier runs
    summaries    per-province summaries of a typed order CSV, DataFrame and SQL

Each command prints one JSON line with its paths and counts and exits
non-zero on failure; a failed layer stops the run.
"""

from __future__ import annotations

import argparse
import json
import sys

from strata.session import get_session


def _session(args):
    return get_session(app_name=f"strata-{args.command}", master=args.master)


def cmd_sample(args) -> dict:
    from strata.operators import summaries
    from strata.sinks.export import export_single_csv
    from strata.sources.literal import sample_orders

    spark = _session(args)
    orders = sample_orders(spark)
    out = args.out.rstrip("/")
    return {
        "orders": export_single_csv(orders.orderBy("order_id"), f"{out}/sample_orders.csv"),
        "success": export_single_csv(summaries.filter_status(orders).orderBy("order_id"), f"{out}/sample_success.csv"),
        "by_province": export_single_csv(summaries.province_totals(orders, "SUCCESS"), f"{out}/sample_by_province.csv"),
    }


def cmd_generate(args) -> dict:
    from strata.sources.generate import generate_clean_orders, generate_dirty_orders, land_dirty_orders

    spark = _session(args)
    if args.clean:
        df = generate_clean_orders(spark, n=args.rows, seed=args.seed)
        df.write.mode("errorifexists").option("header", "true").csv(args.out)
    else:
        land_dirty_orders(generate_dirty_orders(spark, n=args.rows, seed=args.seed, shuffle=args.shuffle), args.out)
    return {"out": args.out, "rows": args.rows}


def cmd_pipeline(args) -> dict:
    from strata.operators.gold import order_gold
    from strata.plans.pipeline import run_pipeline
    from strata.sinks.export import export_layers_csv, export_single_csv
    from strata.sources.files import read_layer

    spark = _session(args)
    res = run_pipeline(spark, args.source, args.base, resume=args.resume, start_at=args.start_at, stop_after=args.stop_after)
    out = {"paths": res.paths, "counts": res.counts, "rejects": res.rejects, "skipped": res.skipped}
    if args.export_gold and args.stop_after == "gold":
        out["gold_csv"] = export_single_csv(order_gold(read_layer(spark, res.paths["gold"])), args.export_gold)
    if args.export_csv:
        done = {k: v for k, v in res.paths.items() if k in res.skipped or res.counts.get(k) is not None}
        out["csv"] = export_layers_csv(spark, done, args.export_csv)
    return out


def cmd_incremental(args) -> dict:
    from strata.streaming.medallion import run_incremental

    spark = _session(args)
    paths = run_incremental(spark, args.landing, args.base, archive_dir=args.archive)
    return {
        "bronze": paths.bronze,
        "silver": paths.silver,
        "gold": paths.gold,
        "counts": paths.counts,
        "rejects": paths.rejects,
        "malformed": paths.malformed,
    }


def cmd_summaries(args) -> dict:
    from strata.operators import summaries
    from strata.plans.sql import sql_province_totals
    from strata.sinks.export import export_single_csv
    from strata.sources.files import read_orders_csv

    spark = _session(args)
    orders = read_orders_csv(spark, args.orders)
    out = args.out.rstrip("/")
    written = {
        "success_orders": f"{out}/success_orders",
        "by_province_success": export_single_csv(
            summaries.province_totals(orders, "SUCCESS"), f"{out}/by_province_success.csv"
        ),
        "by_province_all_sql": export_single_csv(sql_province_totals(spark, orders), f"{out}/by_province_all_sql.csv"),
        "by_province_success_sql": export_single_csv(
            sql_province_totals(spark, orders, "SUCCESS"), f"{out}/by_province_success_sql.csv"
        ),
    }
    # The order list itself can be large: a parallel CSV directory, not one file.
    summaries.filter_status(orders).write.mode("overwrite").option("header", "true").csv(written["success_orders"])
    return written


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="python -m strata", description=__doc__.split("\n\n")[0])
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit / defaults)")
    sub = p.add_subparsers(dest="command", required=True)

    m = sub.add_parser("sample", help="the built-in sample table and its summaries as CSV files")
    m.add_argument("--out", required=True)
    m.set_defaults(run=cmd_sample)

    g = sub.add_parser("generate", help="write generated raw orders as CSV")
    g.add_argument("--rows", type=int, required=True)
    g.add_argument("--out", required=True)
    g.add_argument("--seed", type=int, default=42)
    g.add_argument("--clean", action="store_true", help="typed clean orders instead of dirty raw ones")
    g.add_argument("--shuffle", action="store_true", help="scatter row order (dirty only)")
    g.set_defaults(run=cmd_generate)

    r = sub.add_parser("pipeline", help="Bronze, Silver and Gold layers from raw CSV")
    r.add_argument("--source", default=None, help="raw CSV file, folder or glob (not needed with a later --start-at)")
    r.add_argument("--base", required=True, help="base URI of the layers")
    r.add_argument("--resume", action="store_true", help="keep layers whose input has not changed")
    r.add_argument("--export-gold", default=None, help="also write Gold as one CSV file here")
    r.add_argument("--export-csv", default=None, help="also write CSV copies of the layers under this folder")
    r.add_argument(
        "--start-at", default="bronze", choices=["bronze", "silver", "gold"],
        help="rebuild from this layer on, from the layers before it as they are",
    )
    r.add_argument(
        "--stop-after", default="gold", choices=["bronze", "silver", "gold"],
        help="end after this layer (run the next one later with --start-at or --resume)",
    )
    r.set_defaults(run=cmd_pipeline)

    i = sub.add_parser("incremental", help="layers kept current from a landing folder")
    i.add_argument("--landing", required=True)
    i.add_argument("--base", required=True)
    i.add_argument("--archive", default=None, help="move processed landing files here")
    i.set_defaults(run=cmd_incremental)

    s = sub.add_parser("summaries", help="per-province summaries of a typed order CSV")
    s.add_argument("--orders", required=True)
    s.add_argument("--out", required=True)
    s.set_defaults(run=cmd_summaries)

    args = p.parse_args(argv)
    result = args.run(args)
    print(json.dumps(result, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
