"""Analytical marts over the gold tables. Limits and years are parameters; defaults are the published ones."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ratio, round_places
from ..operators import cube_level, grouped_medians, latest_integer, switches
from ..schemas import AVAILABILITY_MEASURES
from .gold import CUBE_DIMS

FOR_PROFIT = 3
BACHELORS = 3


def measure_availability(
    fact: DataFrame, measures: Mapping[str, str] = AVAILABILITY_MEASURES
) -> DataFrame:
    """How many institutions carry each measure in each year's file."""
    return (
        fact.groupBy("year")
        .agg(
            F.count(F.lit(1)).alias("institutions"),
            *[F.count(source).alias(name) for name, source in measures.items()],
        )
        .orderBy("year")
    )


def enrollment_by_control(cube: DataFrame, control: DataFrame) -> DataFrame:
    """Year and sector totals read from the cube; rows without a known sector drop out with the label join."""
    return (
        cube_level(cube, CUBE_DIMS, ("year", "control"))
        .join(F.broadcast(control), "control")
        .select("year", F.col("label").alias("control"), "institutions", "undergrads")
        .orderBy(F.asc_nulls_last("year"), "control")
    )


def _labelled(fact: DataFrame, control: DataFrame) -> DataFrame:
    return fact.join(F.broadcast(control), "control").drop("control")


def outcomes_by_control(
    fact: DataFrame,
    control: DataFrame,
    year: int = 2020,
    degree: int = BACHELORS,
) -> DataFrame:
    """Median cost, debt and earnings per sector in one year, among institutions of one degree level."""
    debt, earnings = F.col("median_debt_completers"), F.col("median_earnings_10yr")
    chosen = fact.where((F.col("year") == year) & (F.col("predominant_degree") == degree))
    result = grouped_medians(
        _labelled(chosen, control),
        ["label"],
        {
            "median_net_price": F.col("avg_net_price"),
            "median_debt": debt,
            "median_earnings_10yr": earnings,
            "completion": F.col("completion_rate"),
            "burden": ratio(debt, earnings),
        },
        {"institutions": F.lit(1), "with_earnings": earnings},
        few_groups=True,
    )
    return result.select(
        F.col("label").alias("control"),
        "institutions",
        "with_earnings",
        "median_net_price",
        "median_debt",
        "median_earnings_10yr",
        round_places(F.col("completion"), 3).alias("median_completion"),
        round_places(F.col("burden"), 3).alias("median_debt_to_earnings"),
    ).orderBy(F.desc_nulls_last("median_earnings_10yr"), "control")


def tuition_trend(
    fact: DataFrame, control: DataFrame, degree: int = BACHELORS
) -> DataFrame:
    """Median in-state tuition per year and sector."""
    tuition = F.col("tuition_in_state")
    chosen = fact.where((F.col("predominant_degree") == degree) & tuition.isNotNull())
    result = grouped_medians(
        _labelled(chosen, control),
        ["year", "label"],
        {"median_in_state_tuition": tuition},
        {"institutions": tuition},
        few_groups=True,
    )
    return result.select(
        "year", F.col("label").alias("control"), "institutions", "median_in_state_tuition"
    ).orderBy(F.asc_nulls_last("year"), "control")


def bachelors_by_field(
    fact: DataFrame,
    fields: DataFrame,
    families: DataFrame,
    cohort: str = "1819_1920",
    credential: int = BACHELORS,
    min_with_earnings: int = 100,
) -> DataFrame:
    """Median earnings and debt per field family for one cohort and credential level.

    Families have two-character codes, which bounds the groups and lets their statistics be broadcast.
    """
    debt, earnings = F.col("median_debt"), F.col("median_earnings_4yr")
    chosen = fact.where((F.col("cohort") == cohort) & (F.col("credential_level") == credential))
    placed = chosen.join(fields.select("cip", "family"), "cip").join(families, "family")
    result = grouped_medians(
        placed,
        ["family", "family_title"],
        {
            "earnings_1yr": F.col("median_earnings_1yr"),
            "earnings_4yr": earnings,
            "debt": debt,
            "burden": ratio(debt, earnings),
        },
        {"programs": F.lit(1), "with_earnings": earnings},
        few_groups=True,
    )
    return (
        result.where(F.col("with_earnings") >= min_with_earnings)
        .withColumn("debt_to_earnings", round_places(F.col("burden"), 2))
        .drop("burden")
        .orderBy(F.desc_nulls_last("earnings_4yr"), "family")
    )


def closures(
    fact: DataFrame, institutions: DataFrame, control: DataFrame, cutoff: int = 2010, final: int = 2025
) -> DataFrame:
    """Institutions seen up to ``cutoff`` by the sector last reported by then, and how many are gone by ``final``."""
    early = (
        fact.where((F.col("year") <= cutoff) & F.col("control").isNotNull())
        .groupBy("unitid")
        .agg(latest_integer(F.col("control"), F.col("year")).cast("tinyint").alias("control"))
    )
    gone = F.count_if(F.col("last_year") < final)
    return (
        early.join(institutions.select("unitid", "last_year"), "unitid")
        .join(F.broadcast(control), "control")
        .groupBy(F.col("label").alias("control"))
        .agg(
            F.count(F.lit(1)).alias("present_by_cutoff"),
            gone.alias("not_in_final"),
            round_places(F.lit(100.0) * gone / F.count(F.lit(1)), 1).alias("pct_not_in_final"),
        )
        .orderBy("control")
        .withColumnsRenamed(
            {
                "present_by_cutoff": f"present_by_{cutoff}",
                "not_in_final": f"not_in_{final}_file",
                "pct_not_in_final": f"pct_not_in_{final}",
            }
        )
    )


def sector_attribution(
    fact: DataFrame, institutions: DataFrame, sector: int = FOR_PROFIT
) -> DataFrame:
    """One sector's enrollment filed as reported that year and by each institution's latest sector."""
    latest = institutions.select("unitid", F.col("control").alias("latest"))
    enrolled = F.col("undergrad_enrollment")
    return (
        fact.select("unitid", "year", "control", "undergrad_enrollment")
        .join(latest, "unitid")
        .groupBy("year")
        .agg(
            F.sum(F.when(F.col("control") == sector, enrolled)).alias("for_profit_as_reported"),
            F.sum(F.when(F.col("latest") == sector, enrolled)).alias("for_profit_by_latest_sector"),
            F.count_if(F.col("control") != F.col("latest")).alias(
                "institutions_in_another_sector_now"
            ),
        )
        .orderBy("year")
    )


def sector_switches(fact: DataFrame, control: DataFrame) -> DataFrame:
    return switches(fact, "unitid", "year", "control", control)


def all_marts(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every mart of the warehouse under its result name (the token totals come from the audit)."""
    fact, control = gold["fact_institution_year"], gold["dim_control"]
    institutions, programs = gold["dim_institution"], gold["fact_program"]
    return {
        "measure_availability": measure_availability(fact),
        "enrollment_by_control": enrollment_by_control(gold["agg_enrollment_cube"], control),
        "outcomes_by_control_2020": outcomes_by_control(fact, control),
        "tuition_trend": tuition_trend(fact, control),
        "bachelors_by_field": bachelors_by_field(
            programs, gold["dim_field"], gold["dim_cip_family"]
        ),
        "closures": closures(fact, institutions, control),
        "sector_attribution": sector_attribution(fact, institutions),
        "sector_switches": sector_switches(fact, control),
    }
