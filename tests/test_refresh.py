import os
import shutil

import pytest
import sample_files as sample

from stratalake.schemas import INSTITUTION_COLUMNS, YEAR_IN_NAME
from stratalake.sources import publish, read_lake, read_tables, write_partitioned, write_tables
from stratalake.streaming import datasets, manifest_changes, manifest_of, refresh_changed, refresh_years, stream_refresh

GLOB = "MERGED*_PP.csv"


def per_year(spark, path):
    silver = spark.read.parquet(path)
    rows = silver.groupBy("year").count().collect()
    return {row["year"]: row["count"] for row in rows}


def expected(years):
    return {y: sum(sample.present(y, u) for u in range(sample.UNITS)) for y in years}


def test_datasets_end_at_the_part_with_the_key(spark, tmp_path):
    sample.write_files(f"{tmp_path}/b", years=(2009,))
    shutil.copytree(f"{tmp_path}/b", f"{tmp_path}/c/year=2009", dirs_exist_ok=True)
    flat = datasets(spark, f"{tmp_path}/b", YEAR_IN_NAME, GLOB).collect()
    assert [(r["key"], r["dataset"].rsplit("/", 1)[1]) for r in flat] == [("2009", "MERGED2009_10_PP.csv")]
    nested = datasets(spark, f"{tmp_path}/c", r"year=(\d{4})", GLOB).collect()
    assert [(r["key"], r["dataset"].rsplit("/", 1)[1]) for r in nested] == [("2009", "year=2009")]


def test_stream_adds_new_years_and_repeats_safely(spark, tmp_path):
    bronze, silver, progress = (f"{tmp_path}/{n}" for n in ("bronze", "silver", "progress"))

    def run(checkpoint=progress):
        stream_refresh(
            spark, bronze, INSTITUTION_COLUMNS, "year", YEAR_IN_NAME, silver, checkpoint, GLOB
        )

    sample.write_files(bronze, years=(2000, 2009))
    run()
    assert per_year(spark, silver) == expected((2000, 2009))
    # A file of a later layout arrives; years already there are not read again.
    sample.write_files(bronze, years=(2012,))
    run()
    assert per_year(spark, silver) == expected((2000, 2009, 2012))
    run()
    # Lost progress: everything is processed again and nothing doubles.
    run(checkpoint=f"{tmp_path}/progress2")
    assert per_year(spark, silver) == expected((2000, 2009, 2012))


def test_second_file_of_a_year_keeps_the_first(spark, tmp_path):
    bronze, silver = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    sample.write_files(bronze, years=(2009,))
    shutil.copy(f"{bronze}/MERGED2009_10_PP.csv", f"{bronze}/MERGED2009_late_PP.csv")
    refresh_years(spark, bronze, INSTITUTION_COLUMNS, "year", YEAR_IN_NAME, silver, ["2009"], GLOB)
    assert per_year(spark, silver) == {2009: 2 * expected((2009,))[2009]}


def test_refresh_replaces_only_changed_years(spark, tmp_path):
    bronze, silver = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    sample.write_files(bronze, years=(2009, 2010))
    refresh_years(spark, bronze, INSTITUTION_COLUMNS, "year", YEAR_IN_NAME, silver, ["2009", "2010"], GLOB)
    with open(f"{bronze}/MERGED2010_11_PP.csv") as handle:
        lines = handle.readlines()
    with open(f"{bronze}/MERGED2010_11_PP.csv", "w") as handle:
        handle.writelines(lines[:4])
    refresh_years(spark, bronze, INSTITUTION_COLUMNS, "year", YEAR_IN_NAME, silver, ["2010", "1999"], GLOB)
    assert per_year(spark, silver) == {2009: expected((2009,))[2009], 2010: 3}


def test_changes_are_found_without_being_told(spark, tmp_path):
    bronze, silver, manifest = (f"{tmp_path}/{n}" for n in ("bronze", "silver", "manifest"))

    def run():
        return refresh_changed(spark, bronze, INSTITUTION_COLUMNS, "year", YEAR_IN_NAME, silver, manifest, GLOB)

    sample.write_files(bronze, years=(2000, 2009, 2010))
    first = manifest_of(spark, bronze, YEAR_IN_NAME, GLOB).collect()
    assert run() == {"rebuilt": ["2000", "2009", "2010"], "removed": []}
    assert run() == {"rebuilt": [], "removed": []}
    sample.write_files(bronze, years=(2012,))
    with open(f"{bronze}/MERGED2010_11_PP.csv") as handle:
        lines = handle.readlines()
    with open(f"{bronze}/MERGED2010_11_PP.csv", "w") as handle:
        handle.writelines(lines[:4])
    os.remove(f"{bronze}/MERGED2000_01_PP.csv")
    before = spark.createDataFrame(first, manifest_of(spark, bronze, YEAR_IN_NAME, GLOB).schema)
    changes = manifest_changes(manifest_of(spark, bronze, YEAR_IN_NAME, GLOB), before).collect()
    assert sorted((r["key"], r["change"]) for r in changes) == [("2000", "deleted"), ("2010", "changed"), ("2012", "new")]
    assert run() == {"rebuilt": ["2010", "2012"], "removed": ["2000"]}
    assert per_year(spark, silver) == expected((2009, 2012)) | {2010: 3}


def test_a_failed_build_leaves_the_old_tables(spark, tmp_path):
    folder = f"{tmp_path}/gold"
    write_tables({"a": spark.range(3), "b": spark.range(5)}, folder)
    old = read_tables(spark, ["a", "b"], folder)
    broken = spark.range(7).selectExpr("CASE WHEN id > 5 THEN raise_error('half way') ELSE id END AS id")
    with pytest.raises(Exception, match="half way"):
        write_tables({"a": spark.range(4), "b": broken}, folder)
    now = read_tables(spark, ["a", "b"], folder)
    assert [now["a"].count(), now["b"].count()] == [3, 5]
    write_tables({"a": spark.range(9), "b": spark.range(2)}, folder)
    assert [df.count() for df in old.values()] == [3, 5]  # a reader of the version before goes on
    assert [df.count() for df in read_tables(spark, ["a", "b"], folder).values()] == [9, 2]
    write_tables({"a": spark.range(1), "b": spark.range(1)}, folder)
    assert len([name for name in os.listdir(folder) if name.startswith("version-")]) == 2


def test_published_partitions_replace_all_others(spark, tmp_path):
    folder = f"{tmp_path}/lake"
    df = spark.createDataFrame([(1, 2000), (2, 2001)], "v int, year int")
    publish(spark, folder, lambda version: write_partitioned(df, version, "year"))
    publish(spark, folder, lambda version: write_partitioned(df.where("year = 2001"), version, "year"))
    assert [tuple(row) for row in read_lake(spark, folder).collect()] == [(2, 2001)]
