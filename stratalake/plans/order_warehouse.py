"""The warehouse over the trading tables, either derived on the fly or stored layer by layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import family_codes, null_token_audit
from ..schemas import INSTITUTION_COLUMNS, PROGRAM_COLUMNS
from ..sources import (
    publish,
    read_bronze,
    read_lake,
    read_tables,
    shared_folder,
    write_csv,
    write_partitioned,
    write_tables,
)
from ..sources.order_files import (
    CUSTOMER_COLUMNS,
    code_list_text,
    institution_text,
    program_text,
)
from . import gold
from .silver import to_silver

YEAR_IN_PATH = r"year=(\d{4})"

# Settings of the marts on these tables (the published defaults name years the tables do not have).
OUTCOME_YEAR = 1999
CUTOFF_YEAR = 1997
FINAL_YEAR = 2001
COHORT = "9900_0001"


def silver_institutions(spark: SparkSession, folder: str, columns=None) -> DataFrame:
    kept = {name: INSTITUTION_COLUMNS[name] for name in columns or INSTITUTION_COLUMNS}
    return to_silver(institution_text(spark, folder, list(kept)), kept, "year")


def silver_programs(spark: SparkSession, folder: str) -> DataFrame:
    return to_silver(program_text(spark, folder), PROGRAM_COLUMNS, "cohort")


def families(spark: SparkSession, folder: str) -> DataFrame:
    return family_codes(code_list_text(spark, folder))


def fact(spark: SparkSession, folder: str) -> DataFrame:
    """The institution-year fact; it needs no customer attributes, so the customer join is left out."""
    columns = [name for name in INSTITUTION_COLUMNS if name not in CUSTOMER_COLUMNS]
    return gold.fact_institution_year(silver_institutions(spark, folder, columns))


def sector_dim(spark: SparkSession, folder: str) -> DataFrame:
    """Institutions with latest sector and years seen only."""
    narrow = silver_institutions(spark, folder, ["UNITID", "CONTROL"])
    return gold.dim_institution(narrow, {"control": "control"})


def region_dim(spark: SparkSession, folder: str) -> DataFrame:
    narrow = silver_institutions(spark, folder, ["UNITID", "REGION"])
    return gold.dim_institution(narrow, {"region": "region"})


def enrollment_cube(spark: SparkSession, folder: str) -> DataFrame:
    return gold.enrollment_cube(fact(spark, folder), region_dim(spark, folder))


def audit(spark: SparkSession, folder: str) -> DataFrame:
    return null_token_audit(institution_text(spark, folder), INSTITUTION_COLUMNS, "year")


@dataclass(frozen=True)
class StoredLayers:
    """Folders of one stored warehouse."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    def institution_files(self) -> str:
        return f"{self.bronze}/institutions"

    def read_text(self, spark: SparkSession) -> DataFrame:
        text = read_bronze(
            spark, [self.institution_files()], "year", YEAR_IN_PATH, list(INSTITUTION_COLUMNS)
        )
        return text.withColumn("year", F.col("year").cast("int"))

    def read_institutions(self, spark: SparkSession) -> DataFrame:
        return read_lake(spark, f"{self.silver}/institution_year")

    def read_programs(self, spark: SparkSession) -> DataFrame:
        programs = read_lake(spark, f"{self.silver}/program")
        return programs.withColumn("cohort", F.col("cohort").cast("string"))

    def read_gold(self, spark: SparkSession) -> dict[str, DataFrame]:
        return read_tables(spark, gold.TABLES, self.gold)


_STORED: dict[tuple[str, str], StoredLayers] = {}


def stored_layers(spark: SparkSession, folder: str) -> StoredLayers:
    """All layers written under the shared folder, once per application and source folder."""
    seen = (spark.sparkContext.applicationId, folder)
    if seen not in _STORED:
        layers = StoredLayers(shared_folder(spark, "layers"))
        store(spark, folder, layers)
        _STORED[seen] = layers
    return _STORED[seen]


def store(spark: SparkSession, folder: str, layers: StoredLayers) -> None:
    """Text files by year, then silver from those files, then gold from silver."""
    text = institution_text(spark, folder)
    (
        text.hint("rebalance", "year")
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .partitionBy("year")
        .csv(layers.institution_files())
    )
    write_csv(code_list_text(spark, folder), f"{layers.bronze}/codes")
    institutions = to_silver(layers.read_text(spark), INSTITUTION_COLUMNS, "year")
    publish(
        spark, f"{layers.silver}/institution_year", lambda version: write_partitioned(institutions, version, "year")
    )
    # As wide as the tables they come from, so tasks write what they read: an exchange would move every row for nothing.
    programs = silver_programs(spark, folder)
    publish(spark, f"{layers.silver}/program", lambda version: write_partitioned(programs, version, "cohort"))
    families(spark, folder).write.mode("overwrite").parquet(f"{layers.silver}/cip_family")
    tables = gold.build(
        spark,
        layers.read_institutions(spark),
        layers.read_programs(spark),
        read_lake(spark, f"{layers.silver}/cip_family"),
    )
    write_tables(tables, layers.gold)
