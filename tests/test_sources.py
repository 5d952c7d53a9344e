import os

import pytest
from pyspark.sql import functions as F

from stratalake.operators import family_codes
from stratalake.schemas import COHORT_IN_NAME, YEAR_IN_NAME
from stratalake.sources.bronze import layouts_of
from stratalake.sources import (
    file_widths,
    first_lines,
    layer_contents,
    layer_sizes,
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


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as handle:
        handle.write(text)
    return path


def test_quoting_follows_doubled_quotes(spark, tmp_path):
    path = put(
        f"{tmp_path}/q.csv",
        'a,b,c\r\n"A, ""B""",x\\,1\r\n"",PS,"NULL"\r\nshort\r\n',
    )
    got = read_bronze(spark, [path]).collect()
    assert [tuple(row) for row in got] == [('A, "B"', "x\\", "1"), (None, "PS", "NULL"), ("short", None, None)]


def test_line_breaks_inside_quotes_need_multi_line(spark, tmp_path):
    path = put(f"{tmp_path}/m.csv", 'a,b\n"x\ny",1\n')
    assert [tuple(r) for r in read_bronze(spark, [path], multi_line=True).collect()] == [("x\ny", "1")]


def test_every_value_stays_text(spark, tmp_path):
    path = put(f"{tmp_path}/t.csv", "id,n\n01002,1.50\n")
    df = read_bronze(spark, [path])
    assert {f.dataType.simpleString() for f in df.schema.fields} == {"string"}
    assert tuple(df.first()) == ("01002", "1.50")


def test_files_of_different_layouts_join_by_name(spark, tmp_path):
    first = put(f"{tmp_path}/MERGED1996_97_PP.csv", "UNITID,UGDS,EXTRA\n1,10,e\n")
    second = put(f"{tmp_path}/MERGED1997_98_PP.csv", "UGDS,UNITID\n20,2\n")
    third = put(f"{tmp_path}/MERGED1998_99_PP.csv", "UNITID,UGDS,EXTRA\n3,30,f\n")
    df = read_bronze(spark, [first, second, third], "year", YEAR_IN_NAME)
    assert sorted(map(tuple, df.select("year", "UNITID", "UGDS", "EXTRA").collect())) == [
        ("1996", "1", "10", "e"),
        ("1997", "2", "20", None),
        ("1998", "3", "30", "f"),
    ]
    # Two headers, so two scans whatever the number of files.
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2
    widths = file_widths(spark, [first, second, third])
    assert sorted(row["columns"] for row in widths.collect()) == [2, 3, 3]


def test_headers_take_the_same_jobs_for_any_number_of_files(spark, tmp_path):
    layouts = ["UNITID,UGDS,EXTRA", "UGDS,UNITID"]

    def jobs(count):
        folder = f"{tmp_path}/of {count}+x"
        paths = [put(f"{folder}/MERGED{1000 + i}_PP.csv", f"{layouts[i % 2]}\n{i},{i + 1}\n") for i in range(count)]
        context = spark.sparkContext
        context.setJobGroup(folder, "headers")
        found = layouts_of(spark, paths)
        number = len(context.statusTracker().getJobIdsForGroup(folder))
        context.setLocalProperty("spark.jobGroup.id", None)
        assert {header: len(members) for header, members in found.items()} == {
            ("UNITID", "UGDS", "EXTRA"): (count + 1) // 2,
            ("UGDS", "UNITID"): count // 2,
        }
        assert sorted(path for members in found.values() for path in members) == sorted(paths)
        return number

    # From 33 paths on Spark lists files in a job of its own.
    assert jobs(40) == jobs(200) == jobs(5) + 1 == 4


def test_first_lines_of_folders_long_files_and_empty_files(spark, tmp_path):
    put(f"{tmp_path}/year=1999/part-1.csv", "b,a\n")
    put(f"{tmp_path}/year=1999/part-0.csv", "a,b\n" + "x" * 200 + "\n")
    long = put(f"{tmp_path}/long.csv", "h\n" + "1\n" * 400_000)
    empty = put(f"{tmp_path}/empty.csv", "")
    found = first_lines(spark, [f"file:{tmp_path}/year=1999/", long, empty])
    assert found == {f"file:{tmp_path}/year=1999/": "a,b", long: "h", empty: None}


def test_contents_count_rows_and_folders(spark, tmp_path):
    put(f"{tmp_path}/t/year=1/x.csv", "a,b\n1,2\n3\n")
    put(f"{tmp_path}/t/year=2/y.csv", "b\n7\n")
    spark.range(40).repartition(3).write.parquet(f"{tmp_path}/p")
    got = layer_contents(spark, {"text": (f"{tmp_path}/t", "*.csv"), "parquet": (f"{tmp_path}/p", "*.parquet")})
    assert {tuple(row) for row in got.collect()} == {("text", 3, 2), ("parquet", 40, 1)}


def test_only_wanted_columns_are_read(spark, tmp_path):
    header = ",".join(f"C{i}" for i in range(300))
    line = ",".join(str(i) for i in range(300))
    path = put(f"{tmp_path}/w.csv", f"{header}\n{line}\n{line}\n")
    df = read_bronze(spark, [path], columns=["C7", "C250", "ABSENT"])
    assert [tuple(row) for row in df.collect()] == [("7", "250", None)] * 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<C7:string,C250:string>" in plan


def test_part_file_with_another_header_fails(spark, tmp_path):
    put(f"{tmp_path}/year=1999/part-0.csv", "a,b\n1,2\n")
    put(f"{tmp_path}/year=1999/part-1.csv", "b,a\n2,1\n")
    with pytest.raises(Exception, match="CSV header"):
        read_bronze(spark, [f"{tmp_path}/year=1999"]).collect()


def test_cohort_from_the_file_name(spark, tmp_path):
    path = put(f"{tmp_path}/FieldOfStudyData1819_1920_PP.csv", "UNITID\n1\n")
    assert read_bronze(spark, [path], "cohort", COHORT_IN_NAME).first()["cohort"] == "1819_1920"


def test_code_list_with_spreadsheet_quotes(spark, tmp_path):
    path = put(
        f"{tmp_path}/codes.csv",
        'CIPFamily,CIPCode,CIPTitle\n"=""01""","=""01""","FARMS, FIELDS."\n="01",="01.00",General.\n',
    )
    assert [tuple(r) for r in family_codes(read_code_list(spark, path)).collect()] == [("01", "FARMS, FIELDS.")]


def test_sizes_count_files_and_bytes(spark, tmp_path):
    put(f"{tmp_path}/a/x.csv", "12345")
    put(f"{tmp_path}/a/deep/y.csv", "123")
    put(f"{tmp_path}/a/z.txt", "1")
    got = layer_sizes(spark, {"text": (f"{tmp_path}/a", "*.csv")}).first()
    assert tuple(got) == ("text", 2, 8)


def test_partition_value_prunes_and_refreshes_alone(spark, tmp_path):
    path = f"{tmp_path}/lake"
    df = spark.createDataFrame([(1, 2000), (2, 2000), (3, 2001)], "v int, year int")
    write_partitioned(df, path, "year")
    write_partitioned(spark.createDataFrame([(9, 2001)], "v int, year int"), path, "year", incremental=True)
    stored = read_lake(spark, path, "lake_view")
    assert sorted(map(tuple, stored.select("v", "year").collect())) == [(1, 2000), (2, 2000), (9, 2001)]
    assert spark.table("lake_view").count() == 3
    plan = stored.where("year = 2001")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    write_partitioned(df.where("year = 2000"), path, "year", compact=True)
    assert read_lake(spark, path).count() == 2


def test_results_survive_csv_and_json(spark, tmp_path):
    df = spark.createDataFrame([('a "q", b', 1.5, None)], "t string, x double, n long")
    write_csv(df, f"{tmp_path}/mart", single=True)
    back = read_csv_typed(spark, f"{tmp_path}/mart", df.schema)
    assert [tuple(r) for r in back.collect()] == [('a "q", b', 1.5, None)]
    write_json(row_counts({"one": df, "two": df.unionByName(df)}), f"{tmp_path}/counts")
    counts = spark.read.schema("name string, value long").json(f"{tmp_path}/counts")
    assert sorted(map(tuple, counts.collect())) == [("one", 1), ("two", 2)]


def test_equal_buckets_join_without_exchange(spark):
    folder = shared_folder(spark, "tables")
    df = spark.range(100).selectExpr("cast(id % 10 AS int) AS unitid", "id AS v")
    dim = spark.range(10).selectExpr("cast(id AS int) AS unitid", "id * 2 AS r")
    save_catalog_tables({"t_fact": df, "t_dim": dim, "t_label": dim.select("r")}, folder, buckets=4)
    joined = spark.table("t_fact").join(spark.table("t_dim").hint("merge"), "unitid")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.agg(F.sum("r")).first()[0] == 900
    for name in ("t_fact", "t_dim", "t_label"):
        spark.sql(f"DROP TABLE {name}")


def test_shared_folder_lies_under_the_session_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    one, two = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one != two and one.startswith(f"{base.rstrip('/')}/x-")
