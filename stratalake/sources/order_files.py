"""The trading tables presented as yearly text files.

The institution files the warehouse was designed for are not at hand, so a customer's year plays the institution-year
row: its amounts sum all orders of that year, its categories and codes come from the latest one. A line item plays
the program row. An order without a customer, or a line without a part, keeps its row with the text it has. Every value is text, as in a
file; null tokens, suppressed values and a few malformed numbers are planted by rules over the order number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import latest_row
from ..schemas import INSTITUTION_COLUMNS, PROGRAM_COLUMNS

# Columns that need the customer and nation tables.
CUSTOMER_COLUMNS = {"INSTNM", "CITY", "REGION"}


def _text(col: Column) -> Column:
    return col.cast("string")


def _fraction(number: Column, digits: int) -> Column:
    return F.concat(F.lit("0."), F.lpad(_text(number % 10**digits), digits, "0"))


def institution_text(
    spark: SparkSession, folder: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """``year`` and the 27 institution columns as text (or only ``columns``), one row per customer and year."""
    wanted = list(columns or INSTITUTION_COLUMNS)
    orders = spark.read.parquet(f"{folder}/orders.parquet").withColumn("year", F.year("o_orderdate"))
    rows = latest_row(
        orders,
        ["o_custkey", "year"],
        ["o_orderdate", "o_orderkey"],
        ["o_orderstatus", "o_orderpriority"],
        {"paid": F.sum(F.floor("o_totalprice"))},
    )
    if CUSTOMER_COLUMNS & set(wanted):
        customers = spark.read.parquet(f"{folder}/customer.parquet").join(
            spark.read.parquet(f"{folder}/nation.parquet"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
        )
        rows = rows.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")

    k, year = F.col("o_orderkey"), F.col("year")
    price = F.col("paid")
    status = F.col("o_orderstatus")
    control = (
        F.when(k % 97 == 0, "NULL").when(status == "F", "1").when(status == "O", "2").otherwise("3")
    )
    text = {
        "UNITID": _text(F.col("o_custkey")),
        "OPEID6": F.lpad(_text(F.col("o_custkey")), 6, "0"),
        "INSTNM": F.when(k % 23 == 0, "NULL").otherwise(F.col("c_name")),
        "CITY": F.when(k % 29 == 0, "NA").otherwise(F.col("n_name")),
        "STABBR": F.col("o_orderpriority"),
        "CONTROL": control,
        "PREDDEG": F.when(k % 31 == 0, "PS").otherwise(_text(k % 5)),
        "REGION": _text(F.col("n_regionkey")),
        "LOCALE": F.when(year < 1998, "NULL").otherwise(F.concat(_text(k % 43), F.lit(".0"))),
        "HBCU": F.when(k % 10 == 0, "1").otherwise("0"),
        "MAIN": _text(k % 2),
        "CURROPER": F.when(year < 2000, "NULL").when(k % 15 == 0, "0").otherwise("1"),
        "LATITUDE": F.when(year < 2000, "NA").otherwise(
            F.concat(_text(price % 90), F.lit("."), F.lpad(_text(k % 1000), 3, "0"))
        ),
        "LONGITUDE": F.when(year < 2000, "NA").otherwise(
            F.concat(F.lit("-"), _text(k % 180), F.lit("."), F.lpad(_text(price % 1000), 3, "0"))
        ),
        "UGDS": F.when(k % 11 == 0, "PrivacySuppressed")
        .when(k % 13 == 0, "PS")
        .when(k % 17 == 0, "NULL")
        .when(k % 19 == 0, "NA")
        .otherwise(_text(price)),
        "ADM_RATE": F.when(k % 7 == 0, "PrivacySuppressed").otherwise(_fraction(k, 3)),
        "COSTT4_A": _text(price % 50000),
        "NPT4_PUB": F.when(control == "1", _text(price % 30000)).otherwise("NULL"),
        "NPT4_PRIV": F.when(control.isin("2", "3"), _text(price % 40000)).otherwise("NULL"),
        "TUITIONFEE_IN": F.when((year == 1996) | (k % 9 == 0), "NULL").otherwise(_text(price % 20000)),
        "TUITIONFEE_OUT": F.when(k % 53 == 0, "n/a").otherwise(_text(price % 25000)),
        "PCTPELL": _fraction(price, 4),
        "C150_4": F.when(k % 5 >= 3, _fraction(price, 3)).otherwise("NULL"),
        "C150_L4": F.when((k % 5 == 1) | (k % 5 == 2), _fraction(k, 3)).otherwise("NA"),
        "GRAD_DEBT_MDN": F.when(year >= 2001, "NULL")
        .when(k % 4 == 0, "PrivacySuppressed")
        .otherwise(F.concat(_text(price % 30000), F.lit(".5"))),
        "MD_EARN_WNE_P10": F.when(~year.isin(1997, 1999), "NULL")
        .when(k % 6 == 0, "PS")
        .when(k % 101 == 0, "0")
        .otherwise(_text(price % 60000 + 20000)),
        "CDR3": _fraction(k, 2),
    }
    return rows.select("year", *[text[name].alias(name) for name in wanted])


def program_text(spark: SparkSession, folder: str) -> DataFrame:
    """``cohort`` and the 10 program columns as text, one row per line item."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    # Numbers of brands are found once per part, not once per line.
    parts = spark.read.parquet(f"{folder}/part.parquet").withColumn("brand_number", _brand_number())
    rows = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")

    def two_digits(years_on: int) -> Column:
        return F.right(_text(F.year("l_shipdate") + years_on), F.lit(2))

    k = F.col("l_orderkey")
    price = F.floor("l_extendedprice")
    flag = F.col("l_returnflag")
    text = {
        "UNITID": _text(F.col("l_suppkey")),
        "CIPCODE": F.when(k % 89 == 0, "NULL").otherwise(
            F.concat(F.col("brand_number"), F.lpad(_text(F.col("p_size")), 2, "0"))
        ),
        "CIPDESC": F.when(k % 37 == 0, "NULL").otherwise(
            F.concat(F.col("p_type"), F.lit(" "), _text(F.col("p_size")))
        ),
        "CREDLEV": F.when(k % 83 == 0, "NA").when(flag == "A", "1").when(flag == "N", "2").otherwise("3"),
        "CREDDESC": F.concat(flag, F.lit("/"), F.col("l_linestatus")),
        "IPEDSCOUNT1": F.when(k % 5 == 0, "PS").otherwise(_text(F.floor("l_quantity"))),
        "IPEDSCOUNT2": _text(F.col("l_linenumber")),
        "DEBT_ALL_STGP_EVAL_MDN": F.when(k % 7 == 0, "PrivacySuppressed").otherwise(
            F.concat(_text(price % 40000), F.lit(".25"))
        ),
        "EARN_MDN_1YR": F.when(F.col("l_partkey") % 6 == 0, "PS").otherwise(_text(F.floor(price / 2))),
        "EARN_MDN_4YR": F.when(k % 11 == 0, "PrivacySuppressed")
        .when(k % 103 == 0, "0")
        .otherwise(_text(price + 20000)),
    }
    cohort = F.concat(two_digits(0), two_digits(1), F.lit("_"), two_digits(1), two_digits(2))
    return rows.select(cohort.alias("cohort"), *[text[name].alias(name) for name in PROGRAM_COLUMNS])


def _brand_number() -> Column:
    return F.lpad(F.regexp_extract("p_brand", r"(\d+)", 1), 2, "0")


def code_list_text(spark: SparkSession, folder: str) -> DataFrame:
    """``(CIPCode, CIPTitle)`` of all brands (two digits) and brand sizes (four), written ``="07"``."""
    parts = spark.read.parquet(f"{folder}/part.parquet")
    brand = _brand_number()
    families = parts.select(
        brand.alias("code"), F.concat(F.lit("BRAND "), brand, F.lit(" AND RELATED ITEMS.")).alias("CIPTitle")
    )
    fields = parts.select(
        F.concat(brand, F.lpad(_text(F.col("p_size")), 2, "0")).alias("code"),
        F.concat(F.lit("SIZE "), _text(F.col("p_size")), F.lit(".")).alias("CIPTitle"),
    )
    written = F.concat(F.lit('="'), F.col("code"), F.lit('"'))
    return families.unionByName(fields).distinct().select(written.alias("CIPCode"), "CIPTitle")
