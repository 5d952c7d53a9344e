"""Reconciliation of every layer with the one below it: one row per check, zero failures expected."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from ..functions import clean_cast, is_token
from ..operators import cube_level, duplicate_keys, grouping_of, layers_agree
from ..schemas import NULL_TOKENS, SUPPRESSED_TOKENS
from .gold import CUBE_DIMS


def _line(check: str, failures: DataFrame) -> DataFrame:
    return failures.select(
        F.lit(check).alias("check"), F.col(failures.columns[0]).cast("long").alias("failures")
    )


def _rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("failures"))


def _total(df: DataFrame) -> DataFrame:
    return df.agg(F.coalesce(F.sum("failures"), F.lit(0)).alias("failures"))


def _orphans(fact: DataFrame, ids: DataFrame) -> DataFrame:
    """One row ``(failures)``: fact rows without a dimension row. Rows shrink to one per id before the join."""
    counted = fact.groupBy("unitid").agg(F.count(F.lit(1)).alias("failures"))
    return _total(counted.join(ids, "unitid", "left_anti"))


def _differ(*pairs: tuple[str, str]) -> Column:
    return reduce(lambda a, b: a | b, [~F.col(a).eqNullSafe(F.col(b)) for a, b in pairs])


# Key of each dimension, and columns that must have a value.
DIMENSION_KEYS = {
    "dim_institution": ["unitid"],
    "dim_control": ["control"],
    "dim_year": ["year"],
    "dim_cip_family": ["family"],
    "dim_field": ["cip"],
    "dim_credential": ["credential_level", "credential"],
}
NEVER_NULL = {"dim_institution": ["unitid"], "dim_control": ["control", "label"], "dim_year": ["year"]}


def key_faults(gold: dict[str, DataFrame]) -> DataFrame:
    """One row ``(failures)``: dimension rows beyond the first of a key, and rows without a required value."""
    found = [duplicate_keys(gold[name], keys) for name, keys in DIMENSION_KEYS.items()]
    for name, columns in NEVER_NULL.items():
        missing = reduce(lambda a, b: a | b, [F.col(column).isNull() for column in columns])
        found.append(_rows(gold[name].where(missing)))
    return _total(reduce(DataFrame.unionByName, found))


def bronze_totals(bronze: DataFrame, suppressed_column: str, sector: str = "3") -> DataFrame:
    """Per year straight from the text: rows, enrollment, one sector's enrollment, suppressed values."""
    enrolled = clean_cast(F.col("UGDS"), LongType())
    return bronze.groupBy(F.col("year").cast("smallint").alias("year")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(enrolled).alias("enrolled"),
        F.sum(F.when(F.col("CONTROL") == sector, enrolled)).alias("sector_enrolled"),
        F.count_if(is_token(F.col(suppressed_column), SUPPRESSED_TOKENS)).alias("suppressed"),
    )


def layer_totals(bronze: DataFrame, silver: DataFrame, fact: DataFrame) -> dict[str, DataFrame]:
    """Enrollment per valid sector from text, silver and gold, in one shape."""
    raw = bronze.where(F.col("CONTROL").isin("1", "2", "3")).select(
        F.col("CONTROL").alias("control"),
        clean_cast(F.col("UGDS"), LongType()).alias("enrolled"),
    )
    typed = silver.where(F.col("control").isNotNull()).select("control", F.col("ugds").alias("enrolled"))
    gold = fact.where(F.col("control").isNotNull()).select(
        "control", F.col("undergrad_enrollment").alias("enrolled")
    )
    return {
        name: layer.groupBy(F.col("control").cast("int").alias("control")).agg(
            F.sum("enrolled").alias("undergrads")
        )
        for name, layer in (("raw", raw), ("silver", typed), ("gold", gold))
    }


def cube_mismatches(cube: DataFrame, fact: DataFrame) -> DataFrame:
    """One row ``(cells, matched, mismatched)``: the (year, control) level against a direct group-by.

    Null sectors are cells like any other, so keys match null-safely.
    """
    level = cube_level(cube, CUBE_DIMS, ("year", "control")).select(
        F.col("year").alias("cube_year"),
        F.col("control").alias("cube_control"),
        F.col("undergrads").alias("cube_undergrads"),
        F.lit(True).alias("in_cube"),
    )
    direct = fact.groupBy("year", "control").agg(
        F.sum("undergrad_enrollment").alias("undergrads"), F.lit(True).alias("in_fact")
    )
    on = F.col("year").eqNullSafe(F.col("cube_year")) & F.col("control").eqNullSafe(
        F.col("cube_control")
    )
    both = direct.join(level, on, "full")
    same = (
        F.col("in_cube").isNotNull()
        & F.col("in_fact").isNotNull()
        & F.col("undergrads").eqNullSafe(F.col("cube_undergrads"))
    )
    return both.agg(
        F.count("in_fact").alias("cells"),
        F.count_if(same).alias("matched"),
        F.count_if(~same).alias("mismatched"),
    )


def wrong_medians(
    rows: DataFrame, stated: DataFrame, group: str, columns: dict[str, Column], size: str
) -> DataFrame:
    """One row ``(failures)``: stated group sizes and medians that the rows themselves contradict.

    A median is proved by counting, with no sort and no second implementation of it: no more values than the lower
    middle rank may lie below it and no more than the upper one above it; a median between two values must be
    their mean. ``stated`` is a mart with one row per ``group``, a set bounded by the model.
    """
    names = list(columns)
    values = rows.select(F.col(group), *[columns[name].cast("double").alias(f"__{name}") for name in names])
    claims = F.broadcast(
        stated.select(F.col(group).alias("__group"), F.col(size).alias("__size"), *names)
    )
    on_group = F.col(group).eqNullSafe(F.col("__group"))
    # The rows meet the broadcast claims where they are read; only per-group counts are shuffled.
    joined = values.join(claims, on_group, "left")

    aggregates = [F.count(F.lit(1)).alias("__rows")]
    for name in names:
        value, claim = F.col(f"__{name}"), F.col(name)
        aggregates += [
            F.count(value).alias(f"n_{name}"),
            F.count_if(value < claim).alias(f"below_{name}"),
            F.count_if(value > claim).alias(f"above_{name}"),
            F.max(F.when(value < claim, value)).alias(f"under_{name}"),
            F.min(F.when(value > claim, value)).alias(f"over_{name}"),
        ]
    facts = joined.groupBy(group).agg(*aggregates).join(claims, on_group, "full")

    wrong = [F.when(F.col("__rows").eqNullSafe(F.col("__size")), 0).otherwise(1)]
    for name in names:
        n, below, above = F.col(f"n_{name}"), F.col(f"below_{name}"), F.col(f"above_{name}")
        claim = F.col(name)
        between = (below + above == n) & (below == above)
        mean = F.col(f"under_{name}") * 0.5 + F.col(f"over_{name}") * 0.5
        reached = (below <= F.floor((n - 1) / 2)) & (above <= F.floor((n - 1) / 2))
        right = (
            F.when(n == 0, claim.isNull())
            .when(claim.isNull(), False)
            .when(between, claim == mean)
            .otherwise(reached)
        )
        wrong.append(F.when(right, 0).otherwise(1))
    return facts.agg(F.coalesce(F.sum(reduce(lambda a, b: a + b, wrong)), F.lit(0)).alias("failures"))


def dq_report(
    bronze: DataFrame,
    silver: DataFrame,
    silver_programs: DataFrame,
    gold: dict[str, DataFrame],
    audit: DataFrame,
    outcomes: DataFrame,
    by_field: DataFrame,
    outcome_year: int = 2020,
    degree: int = 3,
    cohort: str = "1819_1920",
    credential: int = 3,
    years: Sequence[int] | None = None,
    agreement: DataFrame | None = None,
) -> DataFrame:
    """``(check, failures)`` over stored layers.

    ``years`` limits the text recomputation (default: all years). ``agreement`` is a stored ``layers_agree``
    result; without it the totals of all layers are compared again.
    """
    fact, programs = gold["fact_institution_year"], gold["fact_program"]
    dim, control, cube = gold["dim_institution"], gold["dim_control"], gold["agg_enrollment_cube"]
    measure = "GRAD_DEBT_MDN"

    raw = bronze_totals(bronze, measure)
    stored = fact.groupBy("year").agg(
        F.count(F.lit(1)).alias("fact_rows"), F.sum("undergrad_enrollment").alias("fact_enrolled")
    )
    cells = (
        cube_level(cube, CUBE_DIMS, ("year", "control"))
        .where(F.col("control") == 3)
        .select("year", F.col("undergrads").alias("cube_enrolled"))
    )
    counted = audit.where(F.col("column") == measure).select(
        F.col("year").cast("smallint").alias("year"),
        F.col("privacy_suppressed").alias("audit_suppressed"),
    )
    if years is not None:
        chosen = F.col("year").isin(*years)
        raw, stored, cells, counted = (part.where(chosen) for part in (raw, stored, cells, counted))
    # Result tables with one row per year.
    yearly = (
        raw.join(stored, "year", "full").join(cells, "year", "full").join(counted, "year", "full")
    )
    year_checks = yearly.agg(
        F.count_if(_differ(("rows", "fact_rows"), ("enrolled", "fact_enrolled"))).alias("C1"),
        F.count_if(_differ(("sector_enrolled", "cube_enrolled"))).alias("C2"),
        F.count_if(_differ(("suppressed", "audit_suppressed"))).alias("C3"),
    ).unpivot([], ["C1", "C2", "C3"], "check", "failures")

    texts = [field.name for field in silver.schema.fields if isinstance(field.dataType, StringType)]
    token_left = reduce(lambda a, b: a | b, [is_token(F.col(name), NULL_TOKENS) for name in texts])
    ids = dim.select("unitid")
    known = fact.where(F.col("control").isNotNull())
    last_rows = silver.select(
        "unitid", F.col("year").cast("smallint").alias("last_year"), "instnm", "stabbr"
    ).join(
        dim.select("unitid", F.col("last_year").cast("smallint").alias("last_year"), "name", "state"),
        ["unitid", "last_year"],
    )

    grand = cube.where(F.col("grouping_id") == grouping_of(CUBE_DIMS, ())).agg(
        F.sum("undergrads").alias("stated"), F.lit(None).cast("long").alias("direct")
    )
    direct = fact.agg(F.lit(None).cast("long").alias("stated"), F.sum("undergrad_enrollment").alias("direct"))
    totals = grand.unionByName(direct).agg(
        F.max("stated").alias("stated"), F.max("direct").alias("direct")
    )

    labelled = (
        silver.where((F.col("year") == outcome_year) & (F.col("preddeg") == degree))
        .withColumnRenamed("control", "code")
        .join(
            F.broadcast(control.select(F.col("control").alias("code"), F.col("label").alias("control"))),
            "code",
        )
    )
    outcome_columns = {
        "median_net_price": F.coalesce("npt4_pub", "npt4_priv"),
        "median_debt": F.col("grad_debt_mdn"),
        "median_earnings_10yr": F.col("md_earn_wne_p10"),
    }
    graded = silver_programs.where(
        (F.col("cohort") == cohort) & (F.col("credlev") == credential) & F.col("cipcode").isNotNull()
    ).withColumn("family", F.substring("cipcode", 1, 2))
    # The mart lists families with enough earnings; the others have no claim to check.
    graded = graded.join(F.broadcast(by_field.select("family")), "family", "left_semi")
    field_columns = {"earnings_4yr": F.col("earn_mdn_4yr"), "debt": F.col("debt_all_stgp_eval_mdn")}

    if agreement is None:
        agreement = layers_agree(layer_totals(bronze, silver, fact))
    lines = [
        year_checks.select("check", F.col("failures").cast("long").alias("failures")),
        _line("C4", _rows(silver.where(token_left))),
        _line("C5", duplicate_keys(fact, ["unitid", "year"])),
        _line(
            "C6",
            _total(_orphans(fact, ids).unionByName(_orphans(programs, ids))),
        ),
            _line("C7", _rows(known.join(F.broadcast(control), "control", "left_anti"))),
        _line("C8", key_faults(gold)),
        _line(
            "C9",
            _rows(
                last_rows.where(
                    (F.col("instnm") != F.col("name")) | (F.col("stabbr") != F.col("state"))
                )
            ),
        ),
        _line("C10", cube_mismatches(cube, fact).select("mismatched")),
        _line(
            "C11",
            totals.select(F.when(F.col("stated").eqNullSafe(F.col("direct")), 0).otherwise(1).alias("f")),
        ),
        _line("C12", wrong_medians(labelled, outcomes, "control", outcome_columns, "institutions")),
        _line("C13", wrong_medians(graded, by_field, "family", field_columns, "programs")),
        _line("C14", _total(agreement.select(F.col("differences").alias("failures")))),
    ]
    return reduce(DataFrame.unionByName, lines)
