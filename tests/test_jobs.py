import statistics

import pytest
import sample_files as sample
from pyspark.sql import functions as F

from stratalake.operators import label_dim
from stratalake.plans import dq, gold, jobs, marts
from stratalake.schemas import AUDIT_SCHEMA
from stratalake.sources import read_csv_typed, read_tables, save_catalog_tables


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("warehouse")
    folders = {name: f"{root}/{name}" for name in ("bronze", "lake", "gold", "results")}
    sample.write_files(folders["bronze"])
    jobs.lake(spark, folders["bronze"], folders["lake"], folders["results"])
    jobs.build(spark, folders["bronze"], folders["lake"], folders["gold"], folders["results"])
    return folders


@pytest.fixture(scope="module")
def tables(spark, warehouse):
    return read_tables(spark, gold.TABLES, warehouse["gold"])


def units(year):
    return [u for u in range(sample.UNITS) if sample.present(year, u)]


def test_facts_hold_every_row(tables):
    expected = sum(len(units(year)) for year in sample.YEARS)
    assert tables["fact_institution_year"].count() == expected
    assert tables["fact_program"].count() == 2 * sample.UNITS * 30


def test_dimension_takes_latest_known_values(tables):
    row = tables["dim_institution"].where("unitid = 105").first()
    latest = sample.institution_row(2020, 5)
    assert row["name"] == "School 5, New" and str(row["control"]) == latest["CONTROL"]
    assert (row["first_year"], row["last_year"], row["locale"]) == (2000, 2020, 12)


def test_warehouse_counts(spark, warehouse):
    row = spark.read.json(f"{warehouse['results']}/warehouse_counts").first()
    assert (row["institution_files"], row["program_files"]) == (len(sample.YEARS), 2)
    assert list(row["columns_per_institution_file"]) == [27, 28]
    assert (row["first_cohort"], row["last_cohort"]) == ("1718_1819", "1819_1920")


def test_closures(tables):
    got = {r["control"]: tuple(r)[1:] for r in marts.closures(
        tables["fact_institution_year"], tables["dim_institution"], tables["dim_control"]).collect()}
    expected = {}
    for unit in range(sample.UNITS):
        sector = int(sample.institution_row(2010, unit)["CONTROL"])
        seen, gone = expected.get(sector, (0, 0))
        expected[sector] = (seen + 1, gone + (unit not in units(2025)))
    names = {1: "Public", 2: "Private nonprofit", 3: "Private for-profit"}
    assert got == {names[s]: (n, g, round(100 * g / n, 1)) for s, (n, g) in expected.items()}


def test_outcomes_match_plain_python(spark, warehouse):
    got = {r["control"]: r for r in read_csv_typed(
        spark, f"{warehouse['results']}/outcomes_by_control_2020", jobs._OUTCOMES).collect()}
    names = {"1": "Public", "2": "Private nonprofit", "3": "Private for-profit"}
    rows = [sample.institution_row(2020, u) for u in units(2020)]
    for code, name in names.items():
        group = [r for r in rows if r["CONTROL"] == code and r["PREDDEG"] == "3"]
        debts = [float(r["GRAD_DEBT_MDN"]) for r in group if r["GRAD_DEBT_MDN"][0].isdigit()]
        shares = [
            float(r["GRAD_DEBT_MDN"]) / float(r["MD_EARN_WNE_P10"])
            for r in group
            if r["GRAD_DEBT_MDN"][0].isdigit()
        ]
        assert got[name]["institutions"] == len(group)
        assert got[name]["median_debt"] == statistics.median(debts)
        assert got[name]["median_debt_to_earnings"] == round(statistics.median(shares), 3)


def test_unmeasured_years_stay_in_the_attribution(tables):
    rows = marts.sector_attribution(tables["fact_institution_year"], tables["dim_institution"]).collect()
    by_year = {r["year"]: r for r in rows}
    assert by_year[2000]["for_profit_as_reported"] is None
    assert by_year[2010]["for_profit_as_reported"] != by_year[2010]["for_profit_by_latest_sector"]


def test_audit_explains_every_silver_null(spark, warehouse):
    audit = read_csv_typed(spark, f"{warehouse['results']}/suppression_by_year", AUDIT_SCHEMA)
    silver, _, _ = jobs.silver_tables(spark, warehouse["lake"])
    names = [name for name in silver.columns if name != "year"]
    nulls = silver.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in names]).first()
    explained = audit.groupBy("column").agg(
        F.sum(F.col("privacy_suppressed") + F.col("null") + F.col("cast_failed")).alias("n")
    )
    assert {r["column"].lower(): r["n"] for r in explained.collect()} == nulls.asDict()


def test_chart_datasets(spark, warehouse):
    assert jobs.main(["charts", "--results", warehouse["results"]]) == 0
    bars = spark.read.option("header", True).csv(f"{warehouse['results']}/chart_outcome_bars")
    assert bars.count() == 9
    data = jobs.chart_data(spark, warehouse["results"])
    # Unit 5 leaves the sector in 2012 and unit 23 the files after 2010.
    members = sum(1000 * u + 10 for u in range(sample.UNITS) if u % 3 == 2)
    assert tuple(data["peak_year"].first()) == (2010, members)
    titles = [r["title"] for r in data["top_bottom_fields"].orderBy("place", "family").collect()]
    assert titles == ["Engineering", "Business"] * 2
    absent = data["availability_share"].where("share IS NULL").select("year", "measure")
    assert (2000, "enrollment") in [tuple(r) for r in absent.collect()]


def test_clean_warehouse_has_no_failures(spark, warehouse):
    folders = [part for name, path in warehouse.items() for part in (f"--{name}", path)]
    assert jobs.main(["check", *folders]) == 0
    report = read_csv_typed(spark, f"{warehouse['results']}/dq_report", "check string, failures long")
    got = {r["check"]: r["failures"] for r in report.collect()}
    assert got == {f"C{i}": 0 for i in range(1, 15)}


def test_bucketed_gold_gives_the_same_marts(spark, warehouse, tables, tmp_path):
    saved = gold.build(spark, *jobs.silver_tables(spark, warehouse["lake"]))
    names = ("fact_institution_year", "dim_institution", "dim_control")
    save_catalog_tables({name: saved[name] for name in names}, f"{tmp_path}/gold", buckets=4)
    fact, dim, control = (spark.table(name) for name in names)
    bucketed = marts.sector_attribution(fact, dim.hint("merge"))
    plain = marts.sector_attribution(tables["fact_institution_year"], tables["dim_institution"])
    assert bucketed.collect() == plain.collect()
    switched = marts.sector_switches(fact, control)
    assert switched.collect() == marts.sector_switches(
        tables["fact_institution_year"], tables["dim_control"]
    ).collect()
    for result in (bucketed, switched):
        assert "hashpartitioning(unitid" not in result._jdf.queryExecution().executedPlan().toString()
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def test_rerun_leaves_the_same_lake(spark, warehouse):
    def content():
        silver, programs, _ = jobs.silver_tables(spark, warehouse["lake"])
        return sorted(map(repr, silver.collect())), programs.count()

    before = content()
    jobs.lake(spark, warehouse["bronze"], warehouse["lake"], warehouse["results"])
    spark.catalog.clearCache()
    assert content() == before


def test_every_check_finds_its_fault(spark, warehouse, tables):
    institutions, programs, _ = jobs.silver_tables(spark, warehouse["lake"])
    bronze = jobs.institution_bronze(spark, warehouse["bronze"])
    audit = read_csv_typed(spark, f"{warehouse['results']}/suppression_by_year", AUDIT_SCHEMA)
    stored = marts.all_marts(tables)
    outcomes, by_field = stored["outcomes_by_control_2020"], stored["bachelors_by_field"]

    def report(bronze, institutions, tables, outcomes, by_field):
        rows = dq.dq_report(bronze, institutions, programs, tables, audit, outcomes, by_field).collect()
        return {r["check"]: r["failures"] for r in rows}

    # A text file that changed after the build: one more for-profit with a suppressed value.
    hit = (F.col("year") == "2012") & (F.col("UNITID") == "102")
    changed = bronze.withColumn("UGDS", F.when(hit, "77").otherwise(F.col("UGDS"))).withColumn(
        "GRAD_DEBT_MDN", F.when(hit, "PS").otherwise(F.col("GRAD_DEBT_MDN"))
    )
    # A token left in a text column.
    left = institutions.withColumn("city", F.when(F.col("unitid") == 103, "NA").otherwise(F.col("city")))
    got = report(
        changed,
        left,
        tables,
        outcomes.withColumn("median_debt", F.col("median_debt") + 0.5),
        by_field.withColumn("programs", F.col("programs") + F.when(F.col("family") == "14", 1).otherwise(0)),
    )
    assert {check for check, n in got.items() if n} == {"C1", "C2", "C3", "C4", "C12", "C13", "C14"}

    fact, dim, cube = (tables[n] for n in ("fact_institution_year", "dim_institution", "agg_enrollment_cube"))
    one = fact.where("unitid = 101 AND year = 2025")
    stranger = one.withColumn("unitid", F.lit(1)).withColumn("control", F.lit(9).cast("tinyint"))
    broken = dict(
        tables,
        fact_institution_year=fact.unionByName(one).unionByName(stranger),
        dim_institution=dim.withColumn(
            "name", F.when(F.col("unitid") == 104, "Old name").otherwise(F.col("name"))
        ).unionByName(dim.where("unitid = 110")),
        agg_enrollment_cube=cube.withColumn("undergrads", F.col("undergrads") + 1),
    )
    got = report(bronze, institutions, broken, outcomes, by_field)
    assert got["C5"] == 1 and got["C6"] == 1 and got["C7"] == 1 and got["C8"] == 1 and got["C9"] == 1
    assert got["C10"] > 0 and got["C11"] == 1 and got["C2"] > 0


def test_median_claims_are_proved_by_counting(spark):
    rows = spark.createDataFrame([("a", v) for v in (1.0, 2.0, 3.0, 4.0)] + [("b", 5.0), ("b", None)], "g string, v double")

    def failures(claims):
        stated = spark.createDataFrame(claims, "g string, m double, n long")
        return dq.wrong_medians(rows, stated, "g", {"m": F.col("v")}, "n").first()["failures"]

    assert failures([("a", 2.5, 4), ("b", 5.0, 2)]) == 0
    assert failures([("a", 2.0, 4), ("b", 5.0, 2)]) == 1
    assert failures([("a", 2.4, 4), ("b", 5.0, 2)]) == 1
    assert failures([("a", None, 4), ("b", 5.0, 2)]) == 1
    assert failures([("a", 2.5, 5), ("b", 5.0, 2)]) == 1
    # A stated group without rows and a group nobody states.
    assert failures([("a", 2.5, 4), ("b", 5.0, 2), ("c", 1.0, 1)]) > 0
    assert failures([("a", 2.5, 4)]) > 0


def test_bad_codes_do_not_count_unknown_ones(spark):
    data = [(1, 1), (1, 2), (1, None), (1, 9)]
    df = spark.createDataFrame(data, "unitid int, control tinyint")
    known = df.where("control IS NOT NULL")
    assert known.join(label_dim(spark), "control", "left_anti").count() == 1
