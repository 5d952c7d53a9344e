"""Seconds per mart over stored gold tables, and of one query over text, silver and gold.

Prints one JSON line. ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the warm
runs per query (median is reported; every row is consumed).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stratalake.operators import audit_totals, null_token_audit  # noqa: E402
from stratalake.plans import charts, dq, marts  # noqa: E402
from stratalake.plans import order_warehouse as ow  # noqa: E402
from stratalake.schemas import INSTITUTION_COLUMNS  # noqa: E402
from stratalake.session import build_session  # noqa: E402


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    start = time.perf_counter()
    layers = ow.stored_layers(spark, folder)
    stored_in = time.perf_counter() - start
    gold = layers.read_gold(spark)
    fact, dim = gold["fact_institution_year"], gold["dim_institution"]
    control, cube = gold["dim_control"], gold["agg_enrollment_cube"]
    totals = dq.layer_totals(layers.read_text(spark), layers.read_institutions(spark), fact)

    programs, fields, families = (gold[n] for n in ("fact_program", "dim_field", "dim_cip_family"))
    def enrollment():
        return marts.enrollment_by_control(cube, control)

    def availability():
        return marts.measure_availability(fact)

    queries = {
        "raw_text_totals": lambda: totals["raw"],
        "silver_totals": lambda: totals["silver"],
        "gold_totals": lambda: totals["gold"],
        "measure_availability": availability,
        "enrollment_by_category": enrollment,
        "outcomes_by_category": lambda: marts.outcomes_by_control(fact, control, ow.OUTCOME_YEAR),
        "median_trend": lambda: marts.tuition_trend(fact, control),
        "median_by_family": lambda: marts.bachelors_by_field(programs, fields, families, ow.COHORT),
        "closures": lambda: marts.closures(fact, dim, control, ow.CUTOFF_YEAR, ow.FINAL_YEAR),
        "category_attribution": lambda: marts.sector_attribution(fact, dim),
        "category_switches": lambda: marts.sector_switches(fact, control),
        "null_token_totals": lambda: audit_totals(
            null_token_audit(layers.read_text(spark), INSTITUTION_COLUMNS, "year")
        ),
        "availability_share": lambda: charts.availability_share(availability()),
        "enrollment_pivot": lambda: charts.enrollment_series(enrollment()),
        "peak_year": lambda: charts.peak_year(enrollment(), "Private for-profit"),
    }
    def timed(query) -> float:
        consume(query())
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            consume(query())
            times.append(time.perf_counter() - start)
        return round(statistics.median(times), 3)

    seconds = {name: timed(query) for name, query in queries.items()}
    print(
        json.dumps(
            {
                "metric": "sum of median warm seconds over all marts and layer totals",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "store_all_layers_sec": round(stored_in, 3),
                "cpus": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
