"""Silver to the star schema: two facts, six dimensions, one cube."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    cube_agg,
    distinct_dim,
    family_dim,
    field_dim,
    label_dim,
    latest_nonnull,
    year_dim,
)

CUBE_DIMS = ("year", "control", "region")

TABLES = (
    "dim_control",
    "dim_year",
    "dim_institution",
    "dim_cip_family",
    "dim_field",
    "dim_credential",
    "fact_institution_year",
    "fact_program",
    "agg_enrollment_cube",
)

# Dimension attribute -> silver column.
INSTITUTION_ATTRIBUTES = {
    "name": "instnm",
    "city": "city",
    "state": "stabbr",
    "control": "control",
    "predominant_degree": "preddeg",
    "region": "region",
    "locale": "locale",
    "hbcu": "hbcu",
    "main_campus": "main",
    "latitude": "latitude",
    "longitude": "longitude",
}


def dim_institution(
    silver: DataFrame, attributes: Mapping[str, str] = INSTITUTION_ATTRIBUTES
) -> DataFrame:
    """Latest known attributes per institution (the "as-is" view) and the years it was seen."""
    return latest_nonnull(
        silver, "unitid", "year", attributes, first="first_year", last="last_year"
    )


def fact_institution_year(silver: DataFrame) -> DataFrame:
    """One row per institution and year; sector and degree as reported that year ("as-was")."""
    return silver.select(
        "unitid",
        F.col("year").cast("smallint").alias("year"),
        "control",
        F.col("preddeg").alias("predominant_degree"),
        F.col("ugds").alias("undergrad_enrollment"),
        F.col("adm_rate").alias("admission_rate"),
        F.col("costt4_a").alias("cost_of_attendance"),
        F.coalesce("npt4_pub", "npt4_priv").alias("avg_net_price"),
        F.col("tuitionfee_in").alias("tuition_in_state"),
        F.col("tuitionfee_out").alias("tuition_out_of_state"),
        F.col("pctpell").alias("pell_share"),
        F.coalesce("c150_4", "c150_l4").alias("completion_rate"),
        F.col("grad_debt_mdn").alias("median_debt_completers"),
        F.col("md_earn_wne_p10").alias("median_earnings_10yr"),
        F.col("cdr3").alias("default_rate_3yr"),
        F.col("curroper").alias("operating_flag"),
    )


def fact_program(silver: DataFrame) -> DataFrame:
    """One row per cohort, institution, field and credential."""
    return silver.select(
        "cohort",
        "unitid",
        F.col("cipcode").alias("cip"),
        F.col("credlev").alias("credential_level"),
        F.col("ipedscount1").alias("completers_year1"),
        F.col("ipedscount2").alias("completers_year2"),
        F.col("debt_all_stgp_eval_mdn").alias("median_debt"),
        F.col("earn_mdn_1yr").alias("median_earnings_1yr"),
        F.col("earn_mdn_4yr").alias("median_earnings_4yr"),
    )


def dim_credential(silver_programs: DataFrame) -> DataFrame:
    return distinct_dim(
        silver_programs, {"credential_level": "credlev", "credential": "creddesc"}, "credlev"
    )


def enrollment_cube(fact: DataFrame, institutions: DataFrame) -> DataFrame:
    """Institutions and undergraduates by year, sector as reported and latest region, with all subtotals."""
    placed = fact.select("unitid", "year", "control", "undergrad_enrollment").join(
        institutions.select("unitid", "region"), "unitid"
    )
    return cube_agg(placed, CUBE_DIMS, {"undergrads": "undergrad_enrollment"}, "institutions")


def build(
    spark: SparkSession, institutions: DataFrame, programs: DataFrame, families: DataFrame
) -> dict[str, DataFrame]:
    """All gold tables from the silver tables, by name."""
    fact = fact_institution_year(institutions)
    dim = dim_institution(institutions)
    return {
        "dim_control": label_dim(spark),
        "dim_year": year_dim(institutions),
        "dim_institution": dim,
        "dim_cip_family": family_dim(families),
        "dim_field": field_dim(programs, "cipcode", "cipdesc"),
        "dim_credential": dim_credential(programs),
        "fact_institution_year": fact,
        "fact_program": fact_program(programs),
        "agg_enrollment_cube": enrollment_cube(fact, dim),
    }
