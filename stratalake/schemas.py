"""Declared column sets of the layers. Nothing in the library infers a type from data."""

from __future__ import annotations

from pyspark.sql.types import (
    ByteType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

# Fixed values of the file format: tokens that stand for "no value".
SUPPRESSED_TOKENS = ("PS", "PrivacySuppressed")
MISSING_TOKENS = ("NULL", "NA")
NULL_TOKENS = SUPPRESSED_TOKENS + MISSING_TOKENS

# Fixed values of the file format: columns kept from the yearly institution files, with their silver types.
INSTITUTION_COLUMNS: dict[str, DataType] = {
    "UNITID": IntegerType(),
    "OPEID6": StringType(),
    "INSTNM": StringType(),
    "CITY": StringType(),
    "STABBR": StringType(),
    "CONTROL": ByteType(),
    "PREDDEG": ByteType(),
    "REGION": ByteType(),
    "LOCALE": ShortType(),
    "HBCU": ByteType(),
    "MAIN": ByteType(),
    "CURROPER": ByteType(),
    "LATITUDE": DoubleType(),
    "LONGITUDE": DoubleType(),
    "UGDS": IntegerType(),
    "ADM_RATE": DoubleType(),
    "COSTT4_A": IntegerType(),
    "NPT4_PUB": IntegerType(),
    "NPT4_PRIV": IntegerType(),
    "TUITIONFEE_IN": IntegerType(),
    "TUITIONFEE_OUT": IntegerType(),
    "PCTPELL": DoubleType(),
    "C150_4": DoubleType(),
    "C150_L4": DoubleType(),
    "GRAD_DEBT_MDN": DoubleType(),
    "MD_EARN_WNE_P10": IntegerType(),
    "CDR3": DoubleType(),
}

# Fixed values of the file format: columns kept from the program files, with their silver types.
PROGRAM_COLUMNS: dict[str, DataType] = {
    "UNITID": IntegerType(),
    "CIPCODE": StringType(),
    "CIPDESC": StringType(),
    "CREDLEV": ByteType(),
    "CREDDESC": StringType(),
    "IPEDSCOUNT1": IntegerType(),
    "IPEDSCOUNT2": IntegerType(),
    "DEBT_ALL_STGP_EVAL_MDN": DoubleType(),
    "EARN_MDN_1YR": IntegerType(),
    "EARN_MDN_4YR": IntegerType(),
}

# Fixed values of the file format: the year or cohort inside a file name.
YEAR_IN_NAME = r"MERGED(\d{4})"
COHORT_IN_NAME = r"FieldOfStudyData(\d{4}_\d{4})"

# Fixed values of the model: sector codes and labels.
CONTROL_LABELS = [(1, "Public"), (2, "Private nonprofit"), (3, "Private for-profit")]
CONTROL_SCHEMA = StructType(
    [StructField("control", ByteType(), False), StructField("label", StringType(), False)]
)

# Measures reported by the availability mart: output name -> fact column.
AVAILABILITY_MEASURES = {
    "enrollment": "undergrad_enrollment",
    "tuition": "tuition_in_state",
    "net_price": "avg_net_price",
    "debt": "median_debt_completers",
    "earnings_10yr": "median_earnings_10yr",
    "completion": "completion_rate",
}

AUDIT_SCHEMA = StructType(
    [
        StructField("year", ShortType()),
        StructField("column", StringType()),
        StructField("rows", LongType()),
        StructField("privacy_suppressed", LongType()),
        StructField("null", LongType()),
        StructField("cast_failed", LongType()),
    ]
)


def text_schema(names: list[str]) -> StructType:
    """Every column as text, which is how bronze files are always read."""
    return StructType([StructField(name, StringType()) for name in names])
