"""Benchmark: headline datasets at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (every row is
produced, nothing is collected to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hearthlake.plans.queries import registry  # noqa: E402
from hearthlake.session import build_session  # noqa: E402

HEADLINE = [
    "silver_transactions",
    "gold_daily_store_health",
    "gold_customer_360",
    "gold_supplier_risk",
    "gold_weekly_sentiment",
    "gold_store_scorecard",
    "checks_foundation",
    "checks_daily",
    "checks_customer_360",
    "checks_scorecard",
    "forecast_panel_features",
    "forecast_recursion_mean7",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def forecast_summary(spark, tables_dir: str) -> dict:
    """Extra outside the total: tuning with the full candidate grid and the
    forecast on ``tables_dir``, with its shape and holdout metrics, comparable
    in kind to the published forecast figures (rows = stores x 14 days)."""
    if not os.path.isdir(tables_dir):
        return {}
    from hearthlake.operators.forecast.features import forecast_frames
    from hearthlake.operators.forecast.predict import roll_forward_forecast
    from hearthlake.operators.forecast.train import tune
    from hearthlake.plans.queries import graph
    start = time.perf_counter()
    frames = forecast_frames(graph(spark, tables_dir)["gold_daily_franchise_health"]).checkpointed()
    best = tune(frames.training_rows(), frames.test)
    forecast = roll_forward_forecast(best.model, frames, best.model_name)
    rows = forecast.count()
    stores = forecast.select("store_id").distinct().count()
    days = forecast.select("forecast_date").distinct().count()
    return {"sf": os.path.basename(os.path.normpath(tables_dir)).removeprefix("sf"), "grid": "full",
            "model": best.model_name, "train_rows": frames.pinned["train_rows"],
            "test_rows": frames.pinned["test_rows"], "rmse": round(best.rmse, 4), "mae": round(best.mae, 4),
            "r2": round(best.r2, 4), "forecast_rows": rows, "stores": stores, "horizon_days": days,
            "sec": round(time.perf_counter() - start, 3)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", 2 * cpus))
    spark = build_session(f"local[{cpus}]", app_name="hearthlake-bench", shuffle_partitions=partitions,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry()
    only = [q for q in sys.argv[1:] if q in queries] or HEADLINE
    # Untimed warm-up (JVM JIT, code generation, parquet readers): one pass of the same
    # queries over the smallest tables next to the benchmark folder, if present.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", os.path.join(os.path.dirname(os.path.normpath(sf_dir)), "sf0.001"))
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
        only_warm = ["mask_pii_user"]
    else:
        only_warm = only
    for name in only_warm:
        run(queries[name](spark, warm_dir))
    timings = {}
    for name in only:
        start = time.perf_counter()
        run(queries[name](spark, sf_dir))
        timings[name] = round(time.perf_counter() - start, 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    result = {"metric": "headline_total", "value": round(sum(timings.values()), 3), "unit": "sec",
              "queries": timings, "sf": sf}
    if os.environ.get("BENCH_FORECAST", "0") == "1":  # the full grid takes minutes
        result["forecast"] = forecast_summary(spark, os.environ.get(
            "BENCH_FORECAST_DIR", os.path.join(os.path.dirname(os.path.normpath(sf_dir)), "sf0.001")))
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
