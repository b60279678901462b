"""Client configuration tables: SQL predicates per client, holiday ranges per client.

These are small operator-maintained tables. The operators take them as
DataFrames; the literal rows below are the test configuration of FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FILTER_SCHEMA = T.StructType([
    T.StructField("client", T.StringType(), False),
    T.StructField("filters", T.StringType(), False),
])
HOLIDAY_RANGE_SCHEMA = T.StructType([
    T.StructField("client", T.StringType(), False),
    T.StructField("holiday", T.StringType(), False),
    T.StructField("start", T.StringType(), False),
    T.StructField("end", T.StringType(), False),
])

TEST_CLIENT_FILTERS = (
    ("alpha", "vertical = 'Vertical_1'"),
    ("beta", "sub_vertical = 'Sub_3'"),
    ("gamma store", "vertical = 'Vertical_1'"),
    ("gamma store", "company <> 'Brand#1'"),
)

TEST_HOLIDAY_RANGES = (
    ("alpha", "Thanksgiving", "1 week before Thanksgiving", "1 week after Thanksgiving"),
    ("alpha", "Christmas", "1 week before Christmas", "1 week after Christmas"),
    ("beta", "Thanksgiving", "3 days before Thanksgiving", "Thanksgiving"),
)


def client_filters(spark: SparkSession, rows=TEST_CLIENT_FILTERS) -> DataFrame:
    return spark.createDataFrame(list(rows), FILTER_SCHEMA)


def holiday_ranges(spark: SparkSession, rows=TEST_HOLIDAY_RANGES) -> DataFrame:
    return spark.createDataFrame(list(rows), HOLIDAY_RANGE_SCHEMA)
