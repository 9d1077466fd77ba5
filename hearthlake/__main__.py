"""Command line: full refresh, forecast job, stored check results, or one registered query.

    python -m hearthlake refresh  --tables-dir DIR --database NAME [--group NAME] [--literal-split]
    python -m hearthlake forecast --database NAME --model-path PATH [--small-grid]
    python -m hearthlake checks   --database NAME
    python -m hearthlake query KEY --tables-dir DIR [--show N]

``--tables-dir`` points at the driver tables (``<name>.parquet``); the five
sources are staged from them. On a cluster submit with spark-submit and
leave ``--master`` unset; ``spark.checkpoint.dir`` must name shared storage.
"""

from __future__ import annotations

import argparse
import json
import sys

from hearthlake import params
from hearthlake.session import build_session


def main(argv=None) -> int:
    parser = argparse.ArgumentParser(prog="hearthlake")
    parser.add_argument("--master", default=None)
    parser.add_argument("--shuffle-partitions", type=int, default=None)
    sub = parser.add_subparsers(dest="command", required=True)

    refresh = sub.add_parser("refresh", help="materialise every dataset as a table")
    refresh.add_argument("--tables-dir", required=True)
    refresh.add_argument("--database", required=True)
    refresh.add_argument("--literal-split", action="store_true")
    refresh.add_argument("--group", default=None,
                         help="refresh one group (foundation, daily_health, customer_360, supplier_risk, sentiment, "
                              "scorecard); other datasets are read from their tables")

    forecast = sub.add_parser("forecast", help="train, persist and forecast from the daily health table")
    forecast.add_argument("--database", required=True)
    forecast.add_argument("--model-path", required=True)
    forecast.add_argument("--small-grid", action="store_true")

    checks = sub.add_parser("checks", help="show every stored check result of a refreshed database")
    checks.add_argument("--database", required=True)

    query = sub.add_parser("query", help="run one registered query")
    query.add_argument("key")
    query.add_argument("--tables-dir", required=True)
    query.add_argument("--show", type=int, default=20)

    args = parser.parse_args(argv)
    spark = build_session(args.master, shuffle_partitions=args.shuffle_partitions)

    if args.command == "refresh":
        from hearthlake.plans.medallion import Medallion
        from hearthlake.sources.sinks import ensure_schema, use_schema
        from hearthlake.sources.staging import stage_sources
        from hearthlake.sources.tables import TableReader
        from hearthlake.plans.medallion import DATASETS
        from hearthlake.sources.sinks import attach_tables
        attach_tables(spark, args.database, DATASETS)
        ensure_schema(spark, args.database, comment="Curated retail datasets (bronze, silver, gold, checks)")
        use_schema(spark, args.database)
        graph = Medallion(stage_sources(TableReader(spark, args.tables_dir)), literal_split=args.literal_split)
        print(json.dumps({"written": graph.refresh(spark, database=args.database, group=args.group)}))
    elif args.command == "forecast":
        from hearthlake.plans.forecast_job import ForecastTables, run_forecast_job
        from hearthlake.sources.sinks import attach_tables
        t = ForecastTables()
        attach_tables(spark, args.database,
                      ["gold_daily_franchise_health", t.tuning, t.metrics, t.registry, t.predictions])
        daily = spark.table(f"{args.database}.gold_daily_franchise_health")
        run = run_forecast_job(spark, daily, args.model_path, database=args.database,
                               candidates=params.SMALL_CANDIDATES if args.small_grid else params.DEFAULT_CANDIDATES)
        print(json.dumps({"model_name": run.model_name, "model_path": run.model_path, "config": run.config,
                          "rmse": run.rmse, "mae": run.mae, "r2": run.r2, "train_rows": run.train_rows,
                          "test_rows": run.test_rows}))
    elif args.command == "checks":
        from hearthlake.plans.medallion import CHECK_DATASETS, stored_check_report
        from hearthlake.sources.sinks import attach_tables
        attach_tables(spark, args.database, CHECK_DATASETS)
        report = stored_check_report(spark, args.database)
        report.show(report.count(), truncate=False)
    else:
        from hearthlake.plans.queries import registry
        queries = registry()
        if args.key not in queries:
            parser.error(f"unknown query {args.key!r}; known: {', '.join(sorted(queries))}")
        queries[args.key](spark, args.tables_dir).show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
