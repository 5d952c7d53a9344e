"""Datasets behind the published charts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import display_title
from ..operators import peak, pivot_sum, share_matrix, top_bottom
from ..schemas import AVAILABILITY_MEASURES, CONTROL_LABELS

# Fixed values of the report: display titles of families whose own title is too long.
SHORT_TITLES = {
    "11": "Computer and information sciences",
    "15": "Engineering technologies",
    "19": "Family and consumer sciences",
    "23": "English language and literature",
    "24": "Liberal arts and general studies",
}


def availability_share(availability: DataFrame, measures: Sequence[str] = tuple(AVAILABILITY_MEASURES)):
    return share_matrix(availability, "year", measures, "institutions")


def enrollment_series(
    enrollment: DataFrame, sectors: Sequence[str] = tuple(label for _, label in CONTROL_LABELS)
) -> DataFrame:
    """Undergraduates in millions per year, one column per sector."""
    wide = pivot_sum(enrollment, "year", "control", sectors, "undergrads")
    return wide.select("year", *[(F.col(f"`{name}`") / 1e6).alias(name) for name in sectors])


def enrollment_overlay(enrollment: DataFrame, attribution: DataFrame, sector: str) -> DataFrame:
    """One sector's series as reported beside the same enrollment under today's sector, in millions."""
    reported = enrollment.where(F.col("control") == sector).select(
        "year", (F.col("undergrads") / 1e6).alias("as_reported_millions")
    )
    latest = attribution.select(
        "year", (F.col("for_profit_by_latest_sector") / 1e6).alias("latest_sector_millions")
    )
    return latest.join(reported, "year", "left").select(
        "year", "as_reported_millions", "latest_sector_millions"
    )


def peak_year(enrollment: DataFrame, sector: str) -> DataFrame:
    return peak(enrollment.where(F.col("control") == sector), "year", "undergrads")


def outcome_bars(outcomes: DataFrame) -> DataFrame:
    """Long ``(control, metric, thousands)`` of the three dollar medians."""
    metrics = ["median_net_price", "median_debt", "median_earnings_10yr"]
    long = outcomes.select("control", *metrics).unpivot("control", metrics, "metric", "dollars")
    return long.select("control", "metric", (F.col("dollars") / 1000).alias("thousands"))


def top_bottom_fields(
    by_field: DataFrame, n: int = 6, short_titles: Mapping[str, str] = SHORT_TITLES
) -> DataFrame:
    """Best and worst paid families with display titles, dollars in thousands."""
    picked = top_bottom(by_field, "earnings_4yr", n, "family")
    return picked.select(
        "place",
        "family",
        display_title(F.col("family"), F.col("family_title"), short_titles).alias("title"),
        (F.col("earnings_4yr") / 1000).alias("earnings_thousands"),
        (F.col("debt") / 1000).alias("debt_thousands"),
        "debt_to_earnings",
    )
