import random
import statistics

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from stratalake.operators import (
    cube_agg,
    cube_level,
    differences,
    distinct_dim,
    duplicate_keys,
    family_codes,
    family_dim,
    field_dim,
    grouped_medians,
    middle_values,
    grouping_of,
    label_dim,
    latest_nonnull,
    latest_row,
    layers_agree,
    null_token_audit,
    peak,
    pivot_sum,
    share_matrix,
    switches,
    top_bottom,
    year_dim,
)

HISTORY = [(1, 2000, 1), (1, 2001, None), (2, 2000, 3), (2, 2001, 2), (2, 2002, 3), (3, 2000, None)]
HISTORY_SCHEMA = "unitid int, year int, control tinyint"


def median_or_none(values):
    return statistics.median(values) if values else None


def check_medians(spark, data, few_groups):
    df = spark.createDataFrame(data, "g string, x double, y int")
    got = grouped_medians(
        df,
        ["g"],
        {"mx": F.col("x"), "my": F.col("y")},
        {"rows": F.lit(1), "with_x": F.col("x")},
        few_groups=few_groups,
    )
    expected = {}
    for group in {row[0] for row in data}:
        xs = [row[1] for row in data if row[0] == group and row[1] is not None]
        ys = [row[2] for row in data if row[0] == group and row[2] is not None]
        size = sum(row[0] == group for row in data)
        expected[group] = (size, len(xs), median_or_none(xs), median_or_none(ys))
    assert {row["g"]: tuple(row)[1:] for row in got.collect()} == expected


def test_medians_match_brute_force(spark):
    rng = random.Random(7)
    data = [("all null", None, 3), ("one", 5.0, None), ("pair", 1.0, 1), ("pair", 2.0, 4)]
    # Dominant group, far outliers, negative values, a narrow band and a null group.
    data += [("hot", rng.uniform(-1e5, 1e5), rng.randrange(50)) for _ in range(3001)]
    data += [("hot", value, None) for value in (1e12, -1e12, 0.0, -0.0)]
    data += [("band", 40.0 + rng.random() / 1000, rng.randrange(3)) for _ in range(500)] + [("band", 0.0, 1)]
    data += [(None, float(rng.randrange(10)), None) for _ in range(100)]
    data += [("infinite", value, 1) for value in (1.0, 2.0, 4.0, float("inf"))]
    data += [("both infinite", value, 1) for value in (-float("inf"), 2.0, 4.0, float("inf"))]
    for few_groups in (True, False):
        check_medians(spark, data, few_groups)


def test_group_names_do_not_clash_with_working_columns(spark):
    df = spark.createDataFrame([(1, 2, 5.0), (1, 2, 7.0)], "value int, slot int, x double")
    got = grouped_medians(df, ["value", "slot"], {"n": F.col("x")}, {"part": F.lit(1)})
    assert [tuple(row) for row in got.collect()] == [(1, 2, 2, 6.0)]


def test_no_input_is_gathered_by_group(spark):
    df = spark.range(10).selectExpr("id % 2 AS g", "cast(id AS double) AS x")
    plan = grouped_medians(df, ["g"], {"m": F.col("x")})._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "collect" not in plan


def test_a_tight_band_among_outliers_is_cut_apart(spark):
    band = spark.range(40_000).selectExpr("'g' AS g", "1000000 + id / 400 AS x")
    outliers = spark.createDataFrame([("g", 0.0), ("g", 1e12)], "g string, x double")
    left = middle_values(band.union(outliers), ["g"], {"m": F.col("x")})
    assert left.count() <= 0.01 * 40_002
    got = grouped_medians(band.union(outliers), ["g"], {"m": F.col("x")}).first()
    assert got["m"] == statistics.median([1_000_000 + i / 400 for i in range(40_000)] + [0.0, 1e12])


def test_a_bracket_that_misses_the_middle_fails_loudly(spark):
    df = spark.range(40_000).selectExpr("'g' AS g", "cast(id AS double) AS x")
    with pytest.raises(Exception, match="outside its bracket"):
        grouped_medians(df, ["g"], {"m": F.col("x")}, spread=-0.1).collect()


def test_medians_read_the_input_twice_and_sort_little(spark):
    df = spark.range(10).selectExpr("id % 2 AS g", "cast(id AS double) AS x")
    found = grouped_medians(df, ["g"], {"m": F.col("x"), "n": -F.col("x")}, {"rows": F.lit(1)}, few_groups=True)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 2 and plan.count("Window ") == 1


def test_medians_with_nan_and_without_keys(spark):
    nan = float("nan")
    df = spark.createDataFrame([(v,) for v in (nan, 1.0, nan, 4.0, nan, None)], "x double")
    assert str(grouped_medians(df, [], {"m": F.col("x")}).first()["m"]) == "nan"
    few = df.union(spark.createDataFrame([(v,) for v in (2.0, 3.0, 5.0)], "x double"))
    assert grouped_medians(few, [], {"m": F.col("x")}, {"n": F.col("x")}).first()[:] == (8, 4.5)


def test_top_and_bottom_plan_their_input_once(spark):
    df = spark.range(500).selectExpr("id AS k", "nullif(id * 37 % 101, 5) AS v").repartition(5)
    rows = [(r["k"], r["v"]) for r in df.collect()]
    order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    found = top_bottom(df, "v", 7, "k")
    assert found.columns == ["k", "v", "place"]
    got = {(r["place"], r["k"], r["v"]) for r in found.collect()}
    assert got == {("top", *r) for r in order[:7]} | {("bottom", *r) for r in order[-7:]}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1


def test_audit_counts_signatures_before_columns(spark):
    columns = {"a": IntegerType(), "b": StringType(), "c": IntegerType()}
    rows = [("1", "PS", "x"), ("1", "PS", "x"), (None, "NA", "2.5"), ("PrivacySuppressed", "v", "NULL")] * 50
    df = spark.createDataFrame(rows, "a string, b string, c string").withColumn("year", F.lit(7))
    found = null_token_audit(df, columns, "year")
    assert {tuple(row) for row in found.collect()} == {
        (7, "a", 200, 50, 50, 0),
        (7, "b", 200, 100, 50, 0),
        (7, "c", 200, 0, 50, 100),
    }
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate posexplode") < plan.rindex("Aggregate")  # plans read from the last step to the first


def test_median_of_ratio_skips_zero_denominators(spark):
    from stratalake.functions import ratio

    df = spark.createDataFrame([(100, 0), (100, 50), (100, None)], "a int, b int").withColumn("g", F.lit(1))
    got = grouped_medians(df, ["g"], {"m": ratio(F.col("a"), F.col("b"))}, {"rows": F.lit(1)})
    assert [tuple(row) for row in got.collect()] == [(1, 3, 2.0)]


def test_latest_nonnull_skips_unknown_values(spark):
    df = spark.createDataFrame(HISTORY, HISTORY_SCHEMA)
    got = latest_nonnull(df, "unitid", "year", {"control": "control"}, "first_year", "last_year")
    assert sorted(map(tuple, got.collect())) == [
        (1, 1, 2000, 2001),
        (2, 3, 2000, 2002),
        (3, None, 2000, 2000),
    ]


def test_latest_integers_need_no_sort(spark):
    df = spark.createDataFrame(HISTORY, HISTORY_SCHEMA)
    latest = latest_nonnull(df, "unitid", "year", {"control": "control"}, "first_year", "last_year")
    assert "SortAggregate" not in latest._jdf.queryExecution().executedPlan().toString()
    extremes = [(1, -5, -(2**31)), (1, 3, -1), (2, 7, 2**31 - 1), (2, 6, 0), (3, 1, None)]
    wide = spark.createDataFrame(extremes, "unitid int, year int, x int")
    got = latest_nonnull(wide, "unitid", "year", {"x": "x"}, "a", "b").select("unitid", "x").collect()
    assert {row["unitid"]: row["x"] for row in got} == {1: -1, 2: 2**31 - 1, 3: None}


def test_latest_row_takes_the_whole_row(spark):
    df = spark.createDataFrame(
        [(1, 10, 5, "a"), (1, 10, 7, None), (1, 9, 99, "c"), (2, 1, 1, "d")], "k int, d int, o int, v string"
    )
    got = latest_row(df, ["k"], ["d", "o"], ["v"])
    assert sorted(map(tuple, got.collect())) == [(1, 10, 7, None), (2, 1, 1, "d")]


def test_latest_row_combines_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS o", "'x' AS v")
    plan = latest_row(df, ["k"], ["o"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_every_cube_level_equals_a_direct_group_by(spark):
    rng = random.Random(3)
    data = [
        (rng.choice([2000, 2001]), rng.choice([1, 2, None]), rng.choice([7, 8, None]), rng.choice([None, 5, 9]))
        for _ in range(300)
    ]
    dims = ("year", "control", "region")
    df = spark.createDataFrame(data, "year int, control int, region int, u int")
    cube = cube_agg(df, dims, {"undergrads": "u"}, "institutions").cache()
    for mask in range(8):
        keep = [d for place, d in enumerate(dims) if not mask >> (2 - place) & 1]
        assert grouping_of(dims, keep) == mask
        expected = {}
        for row in data:
            key = tuple(row[dims.index(d)] for d in keep)
            count, total = expected.get(key, (0, None))
            if row[3] is not None:
                total = (total or 0) + row[3]
            expected[key] = (count + 1, total)
        got = cube_level(cube, dims, keep).collect()
        assert {tuple(r[d] for d in keep): (r["institutions"], r["undergrads"]) for r in got} == expected
        assert len(got) == len(expected)
    cube.unpersist()


def test_cube_of_unmeasured_year_keeps_the_year(spark):
    df = spark.createDataFrame([(2000, 1, None), (2001, 1, 4)], "year int, control int, u int")
    level = cube_level(cube_agg(df, ("year", "control"), {"u": "u"}, "n"), ("year", "control"), ("year",))
    assert sorted((r["year"], r["n"], r["u"]) for r in level.collect()) == [(2000, 1, None), (2001, 1, 4)]


def test_switches_with_gap_and_undo(spark):
    df = spark.createDataFrame(HISTORY + [(4, 2000, 1), (4, 2005, 9), (4, 2006, 2)], HISTORY_SCHEMA)
    got = [tuple(row) for row in switches(df, "unitid", "year", "control", label_dim(spark)).collect()]
    # Unit 4 passes through a code without a label: neither change counts.
    assert got == [
        ("Private for-profit", "Private nonprofit", 1, 1, 0),
        ("Private nonprofit", "Private for-profit", 1, 1, 1),
        ("All", "All", 2, 1, 1),
    ]


def test_switch_total_counts_entities_once(spark):
    rng = random.Random(11)
    data = [(u, y, rng.choice([1, 2, 3, None])) for u in range(80) for y in range(2000, 2012)]
    df = spark.createDataFrame(data, HISTORY_SCHEMA)
    got = {tuple(row)[:2]: tuple(row)[2:] for row in switches(df, "unitid", "year", "control", label_dim(spark)).collect()}
    total = got.pop(("All", "All"))
    names = {1: "Public", 2: "Private nonprofit", 3: "Private for-profit"}
    expected, movers, undone = {}, set(), 0
    for unit in range(80):
        known = [c for u, _, c in data if u == unit and c is not None]
        for i in range(1, len(known)):
            if known[i] != known[i - 1]:
                back = i > 1 and known[i - 2] == known[i]
                pair = expected.setdefault((names[known[i - 1]], names[known[i]]), [0, set(), 0])
                pair[0] += 1
                pair[1].add(unit)
                pair[2] += back
                movers.add(unit)
                undone += back
    assert got == {pair: (n, len(units), back) for pair, (n, units, back) in expected.items()}
    assert total == (sum(n for n, _, _ in expected.values()), len(movers), undone)


def test_switches_need_one_exchange_by_entity(spark):
    df = spark.createDataFrame(HISTORY, HISTORY_SCHEMA)
    result = switches(df, "unitid", "year", "control", label_dim(spark))
    text = result._jdf.queryExecution().executedPlan().toString()
    assert text.count("hashpartitioning(unitid") == 1


def test_no_switch_still_gives_a_total(spark):
    df = spark.createDataFrame([(1, 2000, 1)], HISTORY_SCHEMA)
    got = [tuple(row) for row in switches(df, "unitid", "year", "control", label_dim(spark)).collect()]
    assert got == [("All", "All", 0, 0, 0)]


def test_audit_separates_suppressed_missing_and_malformed(spark):
    texts = ["PS", "PrivacySuppressed", "NULL", "NA", None, "abc", "12"]
    df = spark.createDataFrame([(2000, t, t) for t in texts], "year int, A string, B string")
    got = null_token_audit(df, {"A": IntegerType(), "B": StringType()}, "year")
    assert sorted(map(tuple, got.collect())) == [(2000, "A", 7, 2, 3, 1), (2000, "B", 7, 2, 3, 0)]


def test_audit_of_a_column_without_findings(spark):
    df = spark.createDataFrame([(2000, "1"), (2001, "2")], "year int, A string")
    got = null_token_audit(df, {"A": IntegerType()}, "year")
    assert sorted(map(tuple, got.collect())) == [(2000, "A", 1, 0, 0, 0), (2001, "A", 1, 0, 0, 0)]


def test_dimensions(spark):
    years = spark.createDataFrame([(1999,), (1999,), (2000,)], "year int")
    assert [tuple(r) for r in year_dim(years).collect()] == [(1999, "1999-00"), (2000, "2000-01")]
    programs = spark.createDataFrame(
        [("0101", None, 1, "x"), ("0101", "b", 1, "y"), ("0101", "a", None, "z"), (None, "q", 1, "x")],
        "cipcode string, cipdesc string, credlev int, creddesc string",
    )
    assert [tuple(r) for r in field_dim(programs, "cipcode", "cipdesc").collect()] == [("0101", "a", "01")]
    levels = distinct_dim(programs, {"level": "credlev", "text": "creddesc"}, "credlev")
    assert sorted(map(tuple, levels.collect())) == [(1, "x"), (1, "y")]
    codes = spark.createDataFrame(
        [('="01"', "FARMING."), ('="0101"', "Farm things."), ('="52"', "TRADE")], "CIPCode string, CIPTitle string"
    )
    assert sorted(map(tuple, family_dim(family_codes(codes)).collect())) == [("01", "FARMING"), ("52", "TRADE")]


def test_duplicate_keys_count_null_parts(spark):
    df = spark.createDataFrame([(1, 2000), (1, 2000), (None, 2001), (None, 2001)], "a int, b int")
    assert duplicate_keys(df, ["a", "b"]).first()["failures"] == 2


def test_shares_treat_zero_as_absent(spark):
    df = spark.createDataFrame([(2000, 4, 1, 0)], "year int, n int, a int, b int")
    got = share_matrix(df, "year", ["a", "b"], "n")
    assert sorted(map(tuple, got.collect())) == [(2000, "a", 0.25), (2000, "b", None)]


def test_pivot_peak_and_ends(spark):
    df = spark.createDataFrame(
        [(2000, "x", 5), (2000, "y", 1), (2001, "x", 9), (2002, "x", 9), (2003, "x", None)],
        "year int, c string, v int",
    )
    wide = {r["year"]: (r["x"], r["y"], r["z"]) for r in pivot_sum(df, "year", "c", ["x", "y", "z"], "v").collect()}
    assert wide == {2000: (5, 1, None), 2001: (9, None, None), 2002: (9, None, None), 2003: (None, None, None)}
    assert tuple(peak(df.where("c = 'x'"), "year", "v").first()) == (2001, 9)
    ranked = top_bottom(df.where("c = 'x'"), "v", 2, "year").collect()
    assert [(r["place"], r["year"]) for r in ranked] == [
        ("top", 2001),
        ("top", 2002),
        ("bottom", 2003),
        ("bottom", 2000),
    ]


def test_set_differences(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    assert differences(a, b).first()[0] == 2
    got = layers_agree({"p": a, "q": a, "r": b}).collect()
    assert sorted(map(tuple, got)) == [("p=q", 0), ("q=r", 2)]
