"""Headline queries at one scale; prints one JSON line.

Each query is run once to warm up and then BENCH_RUNS times (default 2); the
median counts. ``gold_*`` queries read a materialized fact, as a dashboard
does; the others start from the supplied tables. Results go to the no-op sink,
so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cotalake.catalog import QUERIES  # noqa: E402
from cotalake.operators import periods  # noqa: E402
from cotalake.plans import bindings  # noqa: E402
from cotalake.session import build_session, scratch_path  # noqa: E402
from cotalake.sinks import writers  # noqa: E402

FROM_TABLES = [
    "fct_fundo_diario",
    "pct_change_pl",
    "agg_fundo_periodo",
    "rolling_daily_kpi",
    "dim_fundo",
    "dim_fundo_scd2",
    "basic_clean",
    "filter_fund_registry",
    "coerce_daily_report",
    "join_fact_dim_summary",
    "holding_valuation",
    "client_daily_position",
    "client_risk_score",
    "relationship_summary",
    "dq_status",
    "extract_listing_links",
    "scan_union_by_name",
]

FROM_GOLD = {
    "gold_kpi_trailing_period": periods.kpi_trailing_period,
    "gold_kpi_var_patrimonio": periods.kpi_var_patrimonio,
    "gold_kpi_var_cotistas": periods.kpi_var_cotistas,
    "gold_agg_fundo_periodo": periods.agg_fundo_periodo,
    "gold_rank_funds": lambda f: periods.rank_funds(periods.kpi_trailing_period(f), periods.agg_fundo_periodo(f)),
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session("bench", cpus, int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")

    def timed(make) -> float:
        spent = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            spent.append(time.perf_counter() - started)
        return round(statistics.median(spent[1:]), 3)

    times: dict[str, float] = {}
    for name in FROM_TABLES:
        times[name] = timed(lambda: QUERIES[name](spark, sf_dir))

    path = scratch_path(spark, "bench_fact")
    started = time.perf_counter()
    writers.sink_partitioned_month(bindings.fact(spark, sf_dir), path)
    times["gold_write_fact"] = round(time.perf_counter() - started, 3)
    fact = spark.read.parquet(path)
    for name, make in FROM_GOLD.items():
        times[name] = timed(lambda: make(fact))

    print(
        json.dumps(
            {
                "metric": "median seconds, summed over queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
