import math

from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DoubleType, IntegerType, LongType, ShortType, StringType

from stratalake.functions import (
    academic_year,
    clean_cast,
    code_prefix,
    display_title,
    ratio,
    round_places,
    spreadsheet_code,
)


def cast_all(spark, texts, dtype):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = df.select("i", clean_cast(F.col("t"), dtype).alias("v")).orderBy("i").collect()
    return [row["v"] for row in out]


def test_integers_written_as_text(spark):
    texts = ["12", "12.0", "12.5", "13.5", "-12.5", "-3", " 7 ", "1e3", "", "abc", "200", "NaN"]
    texts += ["inf", "99999999999", "5f", "12.5d", "0x1p3", "0X1P3", "+5", "5.", ".5", "-0.5", "2147483647", None]
    expected = [12, 12, 13, 14, -13, -3, 7, 1000, None, None, 200, None]
    expected += [None, None, None, None, None, None, 5, 5, 1, -1, 2147483647, None]
    assert cast_all(spark, texts, IntegerType()) == expected


def test_narrow_integers_out_of_range_are_null(spark):
    assert cast_all(spark, ["200", "127", "-129"], ByteType()) == [None, 127, None]
    assert cast_all(spark, ["200", "32768"], ShortType()) == [200, None]


def test_long_identifiers_stay_exact(spark):
    texts = ["9007199254740993", "9007199254740992.5", "-12.5", "1e3", "x"]
    assert cast_all(spark, texts, LongType()) == [
        9007199254740993,
        9007199254740993,
        -13,
        1000,
        None,
    ]


def test_doubles(spark):
    texts = ["0.5", "1e3", "5f", "1.5D", "Infinity", "-inf", "NULL", "abc", "-.25"]
    assert cast_all(spark, texts, DoubleType()) == [
        0.5,
        1000.0,
        None,
        None,
        math.inf,
        -math.inf,
        None,
        None,
        -0.25,
    ]
    assert math.isnan(cast_all(spark, ["NaN"], DoubleType())[0])


def test_tokens_become_null_only_when_whole(spark):
    texts = ["NULL", "PrivacySuppressed", "NA", "PS", "NAPA", "01002", None]
    assert cast_all(spark, texts, StringType()) == [None, None, None, None, "NAPA", "01002", None]


def test_rounding_follows_the_binary_value(spark):
    df = spark.createDataFrame([(0.285,), (1.005,), (2.675,), (-0.125,)], "x double")
    got = [row[0] for row in df.select(round_places(F.col("x"), 2)).collect()]
    assert got == [0.28, 1.0, 2.68, -0.13]


def test_zero_denominator_gives_no_ratio(spark):
    df = spark.createDataFrame([(100, 0), (100, 50), (100, None)], "a int, b int")
    assert [row[0] for row in df.select(ratio(F.col("a"), F.col("b"))).collect()] == [None, 2.0, None]


def test_year_labels(spark):
    df = spark.createDataFrame([(1999,), (2008,), (2025,)], "y smallint")
    labels = [row[0] for row in df.select(academic_year(F.col("y"))).collect()]
    assert labels == ["1999-00", "2008-09", "2025-26"]


def test_codes_and_titles(spark):
    df = spark.createDataFrame(
        [('="01"', "ENGINEERING"), ('="51"', "HEALTH PROFESSIONS AND RELATED PROGRAMS"), ('="24"', "X")],
        "code string, title string",
    )
    clean = df.select(spreadsheet_code(F.col("code")).alias("code"), "title")
    titles = clean.select(
        code_prefix(F.col("code")), display_title(F.col("code"), F.col("title"), {"24": "Liberal arts"})
    )
    assert [tuple(row) for row in titles.collect()] == [
        ("01", "Engineering"),
        ("51", "Health professions"),
        ("24", "Liberal arts"),
    ]
