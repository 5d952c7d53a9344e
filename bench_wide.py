"""Raw text, silver and gold timings on files of the published shape: 30 years, 3,308 columns, about 2.4 GB.

    python bench_wide.py <scratch folder> [rows per file, default 6959]

The files are invented (27 used columns among fillers); the registered queries never use them.
"""

from __future__ import annotations

import json
import os
import random
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stratalake.plans import dq, gold, jobs  # noqa: E402
from stratalake.plans.silver import to_silver  # noqa: E402
from stratalake.schemas import INSTITUTION_COLUMNS  # noqa: E402
from stratalake.session import build_session  # noqa: E402
from stratalake.sources import layer_sizes, read_lake, write_partitioned  # noqa: E402

WIDTH = 3308


def write_files(folder: str, rows: int) -> None:
    rng = random.Random(1)
    places = sorted(rng.sample(range(1, WIDTH - 1), len(INSTITUTION_COLUMNS)))
    names = dict(zip(places, INSTITUTION_COLUMNS))
    header = ",".join(names.get(i, f"FILLER{i}") for i in range(WIDTH))
    filler = rng.choices(["NA", "NULL"], [7, 3], k=WIDTH)
    edges = [-1, *places, WIDTH]
    gaps = [",".join(filler[a + 1 : b]) for a, b in zip(edges, edges[1:])]
    os.makedirs(folder)
    for year in range(1996, 2026):
        with open(f"{folder}/MERGED{year}_{(year + 1) % 100:02d}_PP.csv", "w") as handle:
            handle.write(header + "\n")
            for unit in range(rows):
                cells = [value(name, unit, rng) for name in INSTITUTION_COLUMNS]
                line = gaps[0]
                for cell, gap in zip(cells, gaps[1:]):
                    line += f",{cell},{gap}" if gap else f",{cell}"
                handle.write(line + "\n")


def value(name: str, unit: int, rng: random.Random) -> str:
    if name == "UNITID":
        return str(100000 + unit)
    if name == "INSTNM":
        return f'"School {unit}, Inc"'
    if name in ("CONTROL", "PREDDEG"):
        return str(rng.randint(1, 3))
    if name in ("OPEID6", "CITY", "STABBR"):
        return f"T{unit % 500}"
    if name in ("REGION", "LOCALE", "HBCU", "MAIN", "CURROPER"):
        return str(unit % 2)
    return rng.choice(["NULL", "PrivacySuppressed", str(rng.randrange(50000)), str(rng.randrange(50000))])


def main() -> None:
    scratch = sys.argv[1]
    rows = int(sys.argv[2]) if len(sys.argv) > 2 else 6959
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    bronze, lake, gold_folder = (f"{scratch}/{name}" for name in ("bronze", "lake", "gold"))
    if not os.path.exists(bronze):
        write_files(bronze, rows)
    spark = build_session(
        "bench-wide",
        master=f"local[{cpus}]",
        **{
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(work, runs: int = 3) -> float:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            work()
            times.append(time.perf_counter() - start)
        return round(statistics.median(times), 3)

    def build_silver() -> None:
        typed = to_silver(jobs.institution_bronze(spark, bronze), INSTITUTION_COLUMNS, "year")
        write_partitioned(typed, lake, "year", compact=True)

    silver_build = seconds(build_silver, runs=1)
    silver = read_lake(spark, lake)
    gold.fact_institution_year(silver).write.mode("overwrite").parquet(gold_folder)
    fact = spark.read.parquet(gold_folder)

    def query(layer: str):
        def run() -> None:
            text = jobs.institution_bronze(spark, bronze, ["CONTROL", "UGDS"])
            totals = dq.layer_totals(text, silver, fact)[layer]
            totals.write.format("noop").mode("overwrite").save()

        return run

    text = jobs.institution_bronze(spark, bronze, ["CONTROL", "UGDS"])
    layers = dq.layer_totals(text, silver, fact)

    def stored(layer: str):
        return lambda: layers[layer].write.format("noop").mode("overwrite").save()

    sizes = layer_sizes(
        spark, {"bronze": (bronze, "*.csv"), "silver": (lake, "*.parquet"), "gold": (gold_folder, "*.parquet")}
    )
    print(
        json.dumps(
            {
                "raw_text_first_sec": seconds(query("raw"), runs=1),
                "raw_text_sec": seconds(query("raw")),
                "silver_sec": seconds(stored("silver")),
                "gold_sec": seconds(stored("gold")),
                "build_silver_sec": silver_build,
                "megabytes": {r["layer"]: round(r["bytes"] / 1e6, 1) for r in sizes.collect()},
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
