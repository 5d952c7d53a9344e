"""The runnable jobs: files to lake, lake to gold and marts, reconciliation, chart datasets.

    python -m stratalake.plans.jobs lake   --bronze <folder> --lake <folder> --results <folder>
    python -m stratalake.plans.jobs build  --bronze <folder> --lake <folder> --gold <folder> --results <folder>
    python -m stratalake.plans.jobs check  --bronze <folder> --lake <folder> --gold <folder> --results <folder>
    python -m stratalake.plans.jobs charts --results <folder>
"""

from __future__ import annotations

import argparse
import sys
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit_totals, family_codes, layers_agree, null_token_audit
from ..schemas import (
    AUDIT_SCHEMA,
    COHORT_IN_NAME,
    INSTITUTION_COLUMNS,
    PROGRAM_COLUMNS,
    YEAR_IN_NAME,
)
from ..session import build_session
from ..sources import (
    current_version,
    file_widths,
    layer_sizes,
    list_files,
    publish,
    read_bronze,
    read_code_list,
    read_csv_typed,
    read_lake,
    read_tables,
    remove_folder,
    row_counts,
    save_catalog_tables,
    shared_folder,
    write_csv,
    write_json,
    write_partitioned,
    write_tables,
)
from . import charts, dq, gold, marts
from .silver import to_silver

# Fixed values of the file format: file names inside the bronze folder.
INSTITUTION_FILES = "MERGED*_PP.csv"
PROGRAM_FILES = "FieldOfStudyData*_PP.csv"
CODE_LIST = "CIPCode2020.csv"


COUNT_NAMES = (
    "institutions",
    "institution_years",
    "program_rows",
    "fields",
    "institution_files",
    "program_files",
)


def yearly_files(
    spark: SparkSession, folder: str, glob: str, years: Sequence[int] | None = None
) -> list[str]:
    """File paths of one kind, a few per year; optionally only those of some years."""
    files = list_files(spark, folder, glob)
    if years is not None:
        files = files.where(F.regexp_extract("path", YEAR_IN_NAME, 1).isin(*map(str, years)))
    return sorted(row["path"] for row in files.select("path").collect())


def institution_bronze(
    spark: SparkSession,
    bronze: str,
    columns: Sequence[str] | None = None,
    years: Sequence[int] | None = None,
) -> DataFrame:
    files = yearly_files(spark, bronze, INSTITUTION_FILES, years)
    wanted = list(columns or INSTITUTION_COLUMNS)
    return read_bronze(spark, files, "year", YEAR_IN_NAME, columns=wanted)


def program_bronze(spark: SparkSession, bronze: str) -> DataFrame:
    files = yearly_files(spark, bronze, PROGRAM_FILES)
    return read_bronze(spark, files, "cohort", COHORT_IN_NAME, columns=list(PROGRAM_COLUMNS))


def lake(spark: SparkSession, bronze: str, lake_folder: str, results: str) -> None:
    """Bronze to silver, with the token audit and the size audit.

    The wide files are parsed once: their used columns, about a hundredth of the text, go to a staging table that
    the audit and silver both read.
    """
    staged = shared_folder(spark, "institution-text")
    write_partitioned(institution_bronze(spark, bronze), staged, "year", compact=True)
    institutions = read_lake(spark, staged)
    write_csv(
        null_token_audit(institutions, INSTITUTION_COLUMNS, "year").orderBy("year", "column"),
        f"{results}/suppression_by_year",
        single=True,
    )
    silver = to_silver(institutions, INSTITUTION_COLUMNS, "year")
    publish(spark, f"{lake_folder}/institution_year", lambda version: write_partitioned(silver, version, "year"))
    programs = to_silver(program_bronze(spark, bronze), PROGRAM_COLUMNS, "cohort")
    publish(spark, f"{lake_folder}/program", lambda version: write_partitioned(programs, version, "cohort", compact=True))
    codes = read_code_list(spark, f"{bronze}/{CODE_LIST}")
    family_codes(codes).write.mode("overwrite").parquet(f"{lake_folder}/cip_family")
    same_columns = shared_folder(spark, "same-columns-csv")
    write_csv(read_lake(spark, f"{lake_folder}/institution_year"), same_columns)
    sizes = layer_sizes(
        spark,
        {
            "bronze_institution_csv": (bronze, INSTITUTION_FILES),
            "same_columns_as_csv": (same_columns, "*.csv"),
            "silver_institution_parquet": (current_version(spark, f"{lake_folder}/institution_year"), "*.parquet"),
            "bronze_program_csv": (bronze, PROGRAM_FILES),
            "silver_program_parquet": (current_version(spark, f"{lake_folder}/program"), "*.parquet"),
        },
    )
    megabytes = sizes.select("layer", "files", F.round(F.col("bytes") / 1e6, 1).alias("mb"))
    write_json(megabytes.orderBy("layer"), f"{results}/lake_sizes")
    remove_folder(spark, same_columns)
    remove_folder(spark, staged)


def silver_tables(spark: SparkSession, lake_folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Silver institutions, programs and families, also registered as views. ``cohort`` stays text."""
    institutions = read_lake(spark, f"{lake_folder}/institution_year", "silver_inst")
    programs = read_lake(spark, f"{lake_folder}/program")
    programs = programs.withColumn("cohort", F.col("cohort").cast("string"))
    programs.createOrReplaceTempView("silver_prog")
    return institutions, programs, read_lake(spark, f"{lake_folder}/cip_family")


def timed_totals(layers: dict[str, DataFrame]) -> list[tuple[str, float]]:
    """Seconds to compute each layer's totals; a handful of result rows per layer."""
    timings = []
    for name, totals in layers.items():
        start = time.perf_counter()
        totals.write.format("noop").mode("overwrite").save()
        timings.append((name, time.perf_counter() - start))
    return timings


def build(
    spark: SparkSession,
    bronze: str,
    lake_folder: str,
    gold_folder: str,
    results: str,
    buckets: int = 0,
) -> None:
    """Silver to gold, the marts as CSV, layer timings and warehouse counts.

    With ``buckets`` the gold tables are also catalog tables in equal buckets by institution, and the marts that
    join or order by institution read them without an exchange. The folders are plain Parquet either way.
    """
    institutions, programs, families = silver_tables(spark, lake_folder)
    built = gold.build(spark, institutions, programs, families)
    if buckets:
        save_catalog_tables(built, gold_folder, buckets)
        tables = {name: spark.table(name) for name in gold.TABLES}
    else:
        write_tables(built, gold_folder)
        tables = read_tables(spark, gold.TABLES, gold_folder)
    for name, mart in marts.all_marts(tables).items():
        write_csv(mart, f"{results}/{name}", single=True)
    audit = read_csv_typed(spark, f"{results}/suppression_by_year", AUDIT_SCHEMA)
    write_csv(audit_totals(audit), f"{results}/suppression", single=True)

    raw = institution_bronze(spark, bronze, ["CONTROL", "UGDS"])
    layers = dq.layer_totals(raw, institutions, tables["fact_institution_year"])
    timings = spark.createDataFrame(timed_totals(layers), "layer string, seconds double")
    write_json(timings, f"{results}/benchmark")
    write_json(layers_agree(layers), f"{results}/layers_agree")

    counts = row_counts(
        {
            "institutions": tables["dim_institution"],
            "institution_years": tables["fact_institution_year"],
            "program_rows": tables["fact_program"],
            "fields": tables["dim_field"],
            "institution_files": list_files(spark, bronze, INSTITUTION_FILES),
            "program_files": list_files(spark, bronze, PROGRAM_FILES),
        }
    )
    widths = file_widths(spark, yearly_files(spark, bronze, INSTITUTION_FILES)).agg(
        F.sort_array(F.collect_set("columns")).alias("columns_per_institution_file")
    )
    cohorts = programs.agg(F.min("cohort").alias("first_cohort"), F.max("cohort").alias("last_cohort"))
    summary = counts.groupBy().pivot("name", list(COUNT_NAMES)).agg(F.max("value"))
    write_json(summary.crossJoin(widths).crossJoin(cohorts), f"{results}/warehouse_counts")


def check(
    spark: SparkSession,
    bronze: str,
    lake_folder: str,
    gold_folder: str,
    results: str,
    years: Sequence[int] | None = None,
) -> DataFrame:
    """The reconciliation report over stored layers and marts; ``years`` limits the text read again, default all."""
    institutions, programs, _ = silver_tables(spark, lake_folder)
    agreement = None
    if years is not None:  # totals of all layers are only comparable over all years
        agreement = spark.read.schema("pair string, differences long").json(f"{results}/layers_agree")
    return dq.dq_report(
        institution_bronze(spark, bronze, years=years),
        institutions,
        programs,
        read_tables(spark, gold.TABLES, gold_folder),
        read_csv_typed(spark, f"{results}/suppression_by_year", AUDIT_SCHEMA),
        _mart(spark, results, "outcomes_by_control_2020", _OUTCOMES),
        _mart(spark, results, "bachelors_by_field", _BY_FIELD),
        years=years,
        agreement=agreement,
    )


def chart_data(spark: SparkSession, results: str) -> dict[str, DataFrame]:
    """Chart datasets from the marts' CSV files."""
    availability = _mart(spark, results, "measure_availability", _AVAILABILITY)
    enrollment = _mart(spark, results, "enrollment_by_control", _ENROLLMENT)
    attribution = _mart(spark, results, "sector_attribution", _ATTRIBUTION)
    return {
        "availability_share": charts.availability_share(availability),
        "enrollment_series": charts.enrollment_series(enrollment),
        "enrollment_overlay": charts.enrollment_overlay(
            enrollment, attribution, "Private for-profit"
        ),
        "peak_year": charts.peak_year(enrollment, "Private for-profit"),
        "outcome_bars": charts.outcome_bars(
            _mart(spark, results, "outcomes_by_control_2020", _OUTCOMES)
        ),
        "top_bottom_fields": charts.top_bottom_fields(
            _mart(spark, results, "bachelors_by_field", _BY_FIELD)
        ),
    }


_AVAILABILITY = (
    "year int, institutions long, enrollment long, tuition long, net_price long, debt long, "
    "earnings_10yr long, completion long"
)
_ENROLLMENT = "year int, control string, institutions long, undergrads long"
_ATTRIBUTION = (
    "year int, for_profit_as_reported long, for_profit_by_latest_sector long, "
    "institutions_in_another_sector_now long"
)
_OUTCOMES = (
    "control string, institutions long, with_earnings long, median_net_price double, "
    "median_debt double, median_earnings_10yr double, median_completion double, "
    "median_debt_to_earnings double"
)
_BY_FIELD = (
    "family string, family_title string, programs long, with_earnings long, earnings_1yr double, "
    "earnings_4yr double, debt double, debt_to_earnings double"
)


def _mart(spark: SparkSession, results: str, name: str, schema: str) -> DataFrame:
    return read_csv_typed(spark, f"{results}/{name}", schema)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="stratalake")
    parser.add_argument("job", choices=("lake", "build", "check", "charts"))
    for folder in ("bronze", "lake", "gold", "results"):
        parser.add_argument(f"--{folder}")
    parser.add_argument("--buckets", type=int, default=0)
    parser.add_argument("--years", type=int, nargs="*", help="years of text the check reads again; all by default")
    options = parser.parse_args(argv)
    spark = build_session("stratalake")
    if options.job == "lake":
        lake(spark, options.bronze, options.lake, options.results)
    elif options.job == "build":
        build(
            spark, options.bronze, options.lake, options.gold, options.results, options.buckets
        )
    elif options.job == "check":
        report = check(
            spark, options.bronze, options.lake, options.gold, options.results, options.years or None
        )
        write_csv(report, f"{options.results}/dq_report", single=True)
        stored = read_csv_typed(spark, f"{options.results}/dq_report", "check string, failures long")
        stored.orderBy("check").show(50, truncate=False)
        return 1 if stored.where("failures <> 0").first() is not None else 0
    else:
        for name, data in chart_data(spark, options.results).items():
            write_csv(data, f"{options.results}/chart_{name}", single=True)
    return 0


if __name__ == "__main__":
    sys.exit(main())
