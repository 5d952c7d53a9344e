"""The registered queries: every operator and job of the warehouse over the whole trading tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    audit_totals,
    cube_level,
    family_codes,
    family_dim,
    field_dim,
    label_dim,
    layers_agree,
    null_token_audit as token_audit,
    year_dim,
)
from ..schemas import AUDIT_SCHEMA, INSTITUTION_COLUMNS
from ..sources import (
    current_version,
    file_widths,
    layer_contents,
    layer_sizes,
    remove_folder,
    read_bronze,
    read_code_list,
    read_csv_typed,
    read_lake,
    row_counts,
    save_catalog_tables,
    shared_folder,
    write_csv,
    write_json,
    write_partitioned,
)
from ..sources.order_files import institution_text
from ..streaming import datasets, refresh_changed, refresh_years, stream_refresh
from . import charts, dq, gold, marts
from . import order_warehouse as ow

FOR_PROFIT_LABEL = "Private for-profit"


# Sources and sinks


def bronze_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return ow.stored_layers(spark, folder).read_text(spark)


def union_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """Two layouts of the yearly files: columns reversed up to 1997, one column absent from 1998 on."""
    text = institution_text(spark, folder, ["UNITID", "CONTROL", "UGDS", "ADM_RATE"])
    root = shared_folder(spark, "layouts")
    early = text.where("year <= 1997").select("ADM_RATE", "UGDS", "CONTROL", "UNITID", "year")
    late = text.where("year > 1997").select("UNITID", "CONTROL", "UGDS", "year")
    for name, layout in (("early", early), ("late", late)):
        (
            layout.write.mode("overwrite")
            .option("header", True)
            .option("escape", '"')
            .partitionBy("year")
            .csv(f"{root}/{name}")
        )
    paths = [f"{root}/early", f"{root}/late"]
    rows = read_bronze(
        spark, paths, "year", ow.YEAR_IN_PATH, ["UNITID", "CONTROL", "UGDS", "ADM_RATE"]
    )
    return rows.withColumn("year", F.col("year").cast("int"))


def file_key(spark: SparkSession, folder: str) -> DataFrame:
    text = ow.stored_layers(spark, folder).read_text(spark)
    return text.groupBy("year").agg(F.count(F.lit(1)).alias("rows"))


def file_width_counts(spark: SparkSession, folder: str) -> DataFrame:
    layers = ow.stored_layers(spark, folder)
    # One folder per year.
    found = datasets(spark, layers.institution_files(), ow.YEAR_IN_PATH).collect()
    widths = file_widths(spark, [row["dataset"] for row in found])
    return widths.groupBy("columns").agg(F.count(F.lit(1)).alias("files"))


def layer_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """What the tables determine about the stored layers: rows and partition folders of each, whether it has a file per
    folder at least, and whether the files as delivered take more bytes than the same institutions as Parquet."""
    layers = ow.stored_layers(spark, folder)
    same_columns = shared_folder(spark, "same-columns")
    write_csv(layers.read_institutions(spark), same_columns)
    places = {
        "bronze_institution_csv": (layers.institution_files(), "*.csv"),
        "same_columns_as_csv": (same_columns, "*.csv"),
        "silver_institution_parquet": (current_version(spark, f"{layers.silver}/institution_year"), "*.parquet"),
        "silver_program_parquet": (current_version(spark, f"{layers.silver}/program"), "*.parquet"),
        "gold_fact_parquet": (f"{current_version(spark, layers.gold)}/fact_institution_year", "*.parquet"),
    }
    sizes = layer_sizes(spark, places).join(layer_contents(spark, places), "layer")
    rows = sizes.collect()  # one per layer, taken before the copy goes
    remove_folder(spark, same_columns)
    silver = next(row["bytes"] for row in rows if row["layer"] == "silver_institution_parquet")
    as_text = F.col("layer") == "bronze_institution_csv"
    partitioned = ~F.col("layer").isin("same_columns_as_csv", "gold_fact_parquet")
    return spark.createDataFrame(rows, sizes.schema).select(
        "layer",
        "rows",
        F.when(partitioned, F.col("partitions")).alias("partitions"),
        (F.col("files") >= F.col("partitions")).alias("a_file_per_partition"),
        F.when(as_text, F.col("bytes") > silver).alias("larger_than_parquet"),
    )


def silver_view(spark: SparkSession, folder: str) -> DataFrame:
    """Silver read in SQL through the view that the lake registers."""
    layers = ow.stored_layers(spark, folder)
    view = f"silver_{layers.root.rsplit('-', 1)[-1]}"
    read_lake(spark, current_version(spark, f"{layers.silver}/institution_year"), view)
    return spark.sql(
        f"SELECT year, control, count(*) AS institutions, sum(ugds) AS undergrads FROM {view} GROUP BY year, control"
    ).withColumn("year", F.col("year").cast("int"))


def audit_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The token audit written as CSV and read back with its declared types, then summed."""
    path = shared_folder(spark, "audit")
    write_csv(ow.audit(spark, folder), path, single=True)
    return audit_totals(read_csv_typed(spark, path, AUDIT_SCHEMA))


def manifest_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Yearly files of which one is changed, one removed and one added after silver was built: a second run finds the
    three years by itself. 1999 comes back without the rows of sector 1, 1998 is gone, 2001 is new."""
    layers = ow.stored_layers(spark, folder)
    root = shared_folder(spark, "watched")
    text = layers.read_text(spark)

    def deliver(rows: DataFrame) -> None:
        write = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        write.option("header", True).option("escape", '"').partitionBy("year").csv(f"{root}/files")

    def refresh() -> dict[str, list[str]]:
        return refresh_changed(
            spark, f"{root}/files", INSTITUTION_COLUMNS, "year", ow.YEAR_IN_PATH, f"{root}/silver", f"{root}/manifest", "*.csv"
        )

    deliver(text.where("year < 2001"))
    refresh()
    deliver(text.where("year = 1999 AND NOT CONTROL <=> '1' OR year = 2001"))
    remove_folder(spark, f"{root}/files/year=1998")
    done = refresh()
    said = F.when(F.col("year").cast("string").isin(*done["rebuilt"]), "rebuilt").otherwise("kept")
    return _by_year(spark.read.parquet(f"{root}/silver")).withColumn("state", said)


def partitioned_scan(spark: SparkSession, folder: str) -> DataFrame:
    silver = ow.stored_layers(spark, folder).read_institutions(spark)
    return silver.where(F.col("year") == 1998).select("year", "unitid", "control", "ugds")


def program_lake(spark: SparkSession, folder: str) -> DataFrame:
    stored = ow.stored_layers(spark, folder).read_programs(spark)
    return stored.groupBy("cohort").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("earn_mdn_1yr").alias("earnings_sum")
    )


def code_list(spark: SparkSession, folder: str) -> DataFrame:
    layers = ow.stored_layers(spark, folder)
    return family_codes(read_code_list(spark, f"{layers.bronze}/codes"))


def mart_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "mart")
    write_csv(measure_availability(spark, folder), path, single=True)
    schema = "year smallint, institutions long, enrollment long, tuition long, net_price long, debt long, "
    return read_csv_typed(spark, path, schema + "earnings_10yr long, completion long")


def metrics_json(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "metrics")
    write_json(warehouse_counts(spark, folder), path)
    return spark.read.schema("name string, value long").json(path)


def gold_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Facts and dimensions as catalog tables in equal buckets: the join needs no exchange."""
    layers = ow.stored_layers(spark, folder)
    stored = layers.read_gold(spark)
    prefix = f"gold_{layers.root.rsplit('-', 1)[-1]}"
    names = {"fact_institution_year": f"{prefix}_fact", "dim_institution": f"{prefix}_dim"}
    missing = {new: stored[old] for old, new in names.items() if not spark.catalog.tableExists(new)}
    save_catalog_tables(missing, f"{layers.root}/tables", buckets=8)
    fact = spark.table(names["fact_institution_year"])
    dim = spark.table(names["dim_institution"]).select("unitid", "region")
    return (
        fact.join(dim.hint("merge"), "unitid")
        .groupBy("region", "year")
        .agg(
            F.count(F.lit(1)).alias("institutions"),
            F.sum("undergrad_enrollment").alias("undergrads"),
        )
    )


def silver_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Silver lacks the last two years and holds an outdated 1999; a refresh of three years completes it."""
    layers = ow.stored_layers(spark, folder)
    target = shared_folder(spark, "refreshed")
    old = layers.read_institutions(spark).where(F.col("year") < 2000)
    outdated = old.withColumn("ugds", F.when(F.col("year") == 1999, F.lit(0)).otherwise(F.col("ugds")))
    write_partitioned(outdated, target, "year")
    refresh_years(
        spark,
        layers.institution_files(),
        INSTITUTION_COLUMNS,
        "year",
        ow.YEAR_IN_PATH,
        target,
        ["1999", "2000", "2001"],
    )
    return _by_year(spark.read.parquet(target))


def stream_refreshed(spark: SparkSession, folder: str) -> DataFrame:
    """The file stream run twice: the second run finds nothing new and changes nothing."""
    layers = ow.stored_layers(spark, folder)
    root = shared_folder(spark, "streamed")
    for _ in range(2):
        stream_refresh(
            spark,
            layers.institution_files(),
            INSTITUTION_COLUMNS,
            "year",
            ow.YEAR_IN_PATH,
            f"{root}/silver",
            f"{root}/progress",
        )
    return _by_year(spark.read.parquet(f"{root}/silver"))


def _by_year(silver: DataFrame) -> DataFrame:
    return silver.groupBy(F.col("year").cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("control").alias("with_control"),
        F.sum("ugds").alias("undergrads"),
    )


# Silver and audit


def silver_typed(spark: SparkSession, folder: str) -> DataFrame:
    return ow.silver_institutions(spark, folder)


def silver_item(spark: SparkSession, folder: str) -> DataFrame:
    return ow.silver_programs(spark, folder)


def null_token_audit(spark: SparkSession, folder: str) -> DataFrame:
    return ow.audit(spark, folder)


def null_token_totals(spark: SparkSession, folder: str) -> DataFrame:
    return audit_totals(ow.audit(spark, folder))


# Gold


def category_labels(spark: SparkSession, folder: str) -> DataFrame:
    """The label dimension with the rows each label covers; codes without a label show a null label."""
    counted = ow.fact(spark, folder).groupBy("control").agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(F.broadcast(label_dim(spark)), "control", "left").select(
        "control", "label", "rows"
    )


def dim_year(spark: SparkSession, folder: str) -> DataFrame:
    return year_dim(ow.silver_institutions(spark, folder, ["UNITID"]))


def dim_entity(spark: SparkSession, folder: str) -> DataFrame:
    return gold.dim_institution(ow.silver_institutions(spark, folder))


def dim_family(spark: SparkSession, folder: str) -> DataFrame:
    return family_dim(ow.families(spark, folder))


def dim_field(spark: SparkSession, folder: str) -> DataFrame:
    return field_dim(ow.silver_programs(spark, folder), "cipcode", "cipdesc")


def dim_credential(spark: SparkSession, folder: str) -> DataFrame:
    return gold.dim_credential(ow.silver_programs(spark, folder))


def fact_entity_year(spark: SparkSession, folder: str) -> DataFrame:
    return ow.fact(spark, folder)


def fact_item(spark: SparkSession, folder: str) -> DataFrame:
    return gold.fact_program(ow.silver_programs(spark, folder))


def enrollment_cube(spark: SparkSession, folder: str) -> DataFrame:
    return ow.enrollment_cube(spark, folder)


def cube_totals(spark: SparkSession, folder: str) -> DataFrame:
    """The (year) level and the grand total, read from the cube."""
    cube = ow.enrollment_cube(spark, folder)
    levels = [cube_level(cube, gold.CUBE_DIMS, keep) for keep in (("year",), ())]
    return levels[0].unionByName(levels[1])


# Marts


def measure_availability(spark: SparkSession, folder: str) -> DataFrame:
    return marts.measure_availability(ow.fact(spark, folder))


def enrollment_by_category(spark: SparkSession, folder: str) -> DataFrame:
    return marts.enrollment_by_control(ow.enrollment_cube(spark, folder), label_dim(spark))


def outcomes_by_category(spark: SparkSession, folder: str) -> DataFrame:
    return marts.outcomes_by_control(
        ow.fact(spark, folder),
        label_dim(spark),
        year=ow.OUTCOME_YEAR,
    )


def median_trend(spark: SparkSession, folder: str) -> DataFrame:
    return marts.tuition_trend(
        ow.fact(spark, folder),
        label_dim(spark),
    )


def median_by_family(spark: SparkSession, folder: str) -> DataFrame:
    programs = ow.silver_programs(spark, folder)
    return marts.bachelors_by_field(
        gold.fact_program(programs),
        field_dim(programs, "cipcode", "cipdesc"),
        family_dim(ow.families(spark, folder)),
        cohort=ow.COHORT,
    )


def closures(spark: SparkSession, folder: str) -> DataFrame:
    return marts.closures(
        ow.fact(spark, folder),
        ow.sector_dim(spark, folder),
        label_dim(spark),
        cutoff=ow.CUTOFF_YEAR,
        final=ow.FINAL_YEAR,
    )


def category_attribution(spark: SparkSession, folder: str) -> DataFrame:
    return marts.sector_attribution(ow.fact(spark, folder), ow.sector_dim(spark, folder))


def category_switches(spark: SparkSession, folder: str) -> DataFrame:
    return marts.sector_switches(ow.fact(spark, folder), label_dim(spark))


# Reconciliation over stored layers


def layer_totals(spark: SparkSession, folder: str) -> DataFrame:
    named = [
        totals.select(F.lit(name).alias("layer"), "control", "undergrads")
        for name, totals in _layer_totals(spark, folder).items()
    ]
    return named[0].unionByName(named[1]).unionByName(named[2])


def layer_agreement(spark: SparkSession, folder: str) -> DataFrame:
    return layers_agree(_layer_totals(spark, folder))


def _layer_totals(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    layers = ow.stored_layers(spark, folder)
    return dq.layer_totals(
        layers.read_text(spark),
        layers.read_institutions(spark),
        layers.read_gold(spark)["fact_institution_year"],
    )


def warehouse_counts(spark: SparkSession, folder: str) -> DataFrame:
    tables = ow.stored_layers(spark, folder).read_gold(spark)
    return row_counts(
        {
            "institutions": tables["dim_institution"],
            "institution_years": tables["fact_institution_year"],
            "program_rows": tables["fact_program"],
            "fields": tables["dim_field"],
        }
    )


def cube_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    tables = ow.stored_layers(spark, folder).read_gold(spark)
    return dq.cube_mismatches(tables["agg_enrollment_cube"], tables["fact_institution_year"])


def _report(spark: SparkSession, folder: str, silver: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    layers = ow.stored_layers(spark, folder)
    stored, text = layers.read_gold(spark), layers.read_text(spark)
    return dq.dq_report(
        text,
        silver,
        layers.read_programs(spark),
        tables,
        token_audit(text, INSTITUTION_COLUMNS, "year"),
        marts.outcomes_by_control(stored["fact_institution_year"], stored["dim_control"], ow.OUTCOME_YEAR),
        marts.bachelors_by_field(stored["fact_program"], stored["dim_field"], stored["dim_cip_family"], ow.COHORT),
        outcome_year=ow.OUTCOME_YEAR,
        cohort=ow.COHORT,
    )


def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    layers = ow.stored_layers(spark, folder)
    return _report(spark, folder, layers.read_institutions(spark), layers.read_gold(spark))


def dq_report_faults(spark: SparkSession, folder: str) -> DataFrame:
    """The checks of tokens, keys, references and names over layers in which faults are planted by rules over ids."""
    layers = ow.stored_layers(spark, folder)
    tables = layers.read_gold(spark)
    unit = F.col("unitid")
    silver = layers.read_institutions(spark)
    silver = silver.withColumn("city", F.when(unit % 40 == 0, "NA").otherwise(F.col("city")))
    fact, dim = tables["fact_institution_year"], tables["dim_institution"]
    dim = dim.where(unit % 60 != 0).withColumn("name", F.when(unit % 80 == 0, "Old name").otherwise(F.col("name")))
    faulty = dict(
        tables,
        fact_institution_year=fact.unionByName(fact.where(unit % 50 == 0)),
        dim_institution=dim.unionByName(dim.where(unit % 70 == 0)),
        dim_control=tables["dim_control"].where("control <> 3").withColumn("label", F.expr("nullif(label, 'Public')")),
    )
    return _report(spark, folder, silver, faulty).where(F.col("check").isin("C4", "C5", "C6", "C7", "C8", "C9"))


# Chart datasets


def availability_share(spark: SparkSession, folder: str) -> DataFrame:
    return charts.availability_share(measure_availability(spark, folder))


def enrollment_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return charts.enrollment_series(enrollment_by_category(spark, folder))


def enrollment_overlay(spark: SparkSession, folder: str) -> DataFrame:
    return charts.enrollment_overlay(
        enrollment_by_category(spark, folder), category_attribution(spark, folder), FOR_PROFIT_LABEL
    )


def peak_year(spark: SparkSession, folder: str) -> DataFrame:
    return charts.peak_year(enrollment_by_category(spark, folder), FOR_PROFIT_LABEL)


def outcome_bars(spark: SparkSession, folder: str) -> DataFrame:
    return charts.outcome_bars(outcomes_by_category(spark, folder))


def top_bottom_fields(spark: SparkSession, folder: str) -> DataFrame:
    return charts.top_bottom_fields(median_by_family(spark, folder))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_csv_roundtrip": bronze_csv_roundtrip,
    "union_by_name": union_by_name,
    "file_key": file_key,
    "file_widths": file_width_counts,
    "layer_sizes": layer_bytes,
    "silver_view": silver_view,
    "audit_csv": audit_csv,
    "manifest_refresh": manifest_refresh,
    "partitioned_scan": partitioned_scan,
    "program_lake": program_lake,
    "code_list": code_list,
    "mart_csv": mart_csv,
    "metrics_json": metrics_json,
    "gold_tables": gold_tables,
    "silver_refresh": silver_refresh,
    "stream_refresh": stream_refreshed,
    "silver_typed": silver_typed,
    "silver_item": silver_item,
    "null_token_audit": null_token_audit,
    "null_token_totals": null_token_totals,
    "category_labels": category_labels,
    "dim_year": dim_year,
    "dim_entity": dim_entity,
    "dim_family": dim_family,
    "dim_field": dim_field,
    "dim_credential": dim_credential,
    "fact_entity_year": fact_entity_year,
    "fact_item": fact_item,
    "enrollment_cube": enrollment_cube,
    "cube_totals": cube_totals,
    "measure_availability": measure_availability,
    "enrollment_by_category": enrollment_by_category,
    "outcomes_by_category": outcomes_by_category,
    "median_trend": median_trend,
    "median_by_family": median_by_family,
    "closures": closures,
    "category_attribution": category_attribution,
    "category_switches": category_switches,
    "layer_totals": layer_totals,
    "layers_agree": layer_agreement,
    "warehouse_counts": warehouse_counts,
    "cube_reconcile": cube_reconcile,
    "dq_report": dq_report,
    "dq_report_faults": dq_report_faults,
    "availability_share": availability_share,
    "enrollment_pivot": enrollment_pivot,
    "enrollment_overlay": enrollment_overlay,
    "peak_year": peak_year,
    "outcome_bars": outcome_bars,
    "top_bottom_fields": top_bottom_fields,
}
