"""Small literal dimensions (A3, A4).

These are fixed-size lookup tables (52 and 8 rows), so broadcasting them is
always safe: their size does not grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.metrics import INCOME_BANDS

# State code -> state name, in their natural order (52 rows, DC and PR included).
STATE_NAMES: tuple[tuple[str, str], ...] = (
    ("AL", "Alabama"),
    ("AK", "Alaska"),
    ("AZ", "Arizona"),
    ("AR", "Arkansas"),
    ("CA", "California"),
    ("CO", "Colorado"),
    ("CT", "Connecticut"),
    ("DE", "Delaware"),
    ("DC", "District of Columbia"),
    ("FL", "Florida"),
    ("GA", "Georgia"),
    ("HI", "Hawaii"),
    ("ID", "Idaho"),
    ("IL", "Illinois"),
    ("IN", "Indiana"),
    ("IA", "Iowa"),
    ("KS", "Kansas"),
    ("KY", "Kentucky"),
    ("LA", "Louisiana"),
    ("ME", "Maine"),
    ("MD", "Maryland"),
    ("MA", "Massachusetts"),
    ("MI", "Michigan"),
    ("MN", "Minnesota"),
    ("MS", "Mississippi"),
    ("MO", "Missouri"),
    ("MT", "Montana"),
    ("NE", "Nebraska"),
    ("NV", "Nevada"),
    ("NH", "New Hampshire"),
    ("NJ", "New Jersey"),
    ("NM", "New Mexico"),
    ("NY", "New York"),
    ("NC", "North Carolina"),
    ("ND", "North Dakota"),
    ("OH", "Ohio"),
    ("OK", "Oklahoma"),
    ("OR", "Oregon"),
    ("PA", "Pennsylvania"),
    ("PR", "Puerto Rico"),
    ("RI", "Rhode Island"),
    ("SC", "South Carolina"),
    ("SD", "South Dakota"),
    ("TN", "Tennessee"),
    ("TX", "Texas"),
    ("UT", "Utah"),
    ("VT", "Vermont"),
    ("VA", "Virginia"),
    ("WA", "Washington"),
    ("WV", "West Virginia"),
    ("WI", "Wisconsin"),
    ("WY", "Wyoming"),
)

# State code -> census region, in their natural order (52 rows).
STATE_REGIONS: tuple[tuple[str, str], ...] = (
    ("AL", "South"),
    ("AK", "West"),
    ("AZ", "West"),
    ("AR", "South"),
    ("CA", "West"),
    ("CO", "West"),
    ("CT", "Northeast"),
    ("DE", "South"),
    ("DC", "South"),
    ("FL", "South"),
    ("GA", "South"),
    ("HI", "West"),
    ("ID", "West"),
    ("IL", "Midwest"),
    ("IN", "Midwest"),
    ("IA", "Midwest"),
    ("KS", "Midwest"),
    ("KY", "South"),
    ("LA", "South"),
    ("ME", "Northeast"),
    ("MD", "South"),
    ("MA", "Northeast"),
    ("MI", "Midwest"),
    ("MN", "Midwest"),
    ("MS", "South"),
    ("MO", "Midwest"),
    ("MT", "West"),
    ("NE", "Midwest"),
    ("NV", "West"),
    ("NH", "Northeast"),
    ("NJ", "Northeast"),
    ("NM", "West"),
    ("NY", "Northeast"),
    ("NC", "South"),
    ("ND", "Midwest"),
    ("OH", "Midwest"),
    ("OK", "South"),
    ("OR", "West"),
    ("PA", "Northeast"),
    ("PR", "South"),
    ("RI", "Northeast"),
    ("SC", "South"),
    ("SD", "Midwest"),
    ("TN", "South"),
    ("TX", "South"),
    ("UT", "West"),
    ("VT", "Northeast"),
    ("VA", "South"),
    ("WA", "West"),
    ("WV", "South"),
    ("WI", "Midwest"),
    ("WY", "West"),
)

STATE_CODES: tuple[str, ...] = tuple(code for code, _ in STATE_NAMES)

STATE_NAME_SCHEMA = T.StructType([
    T.StructField("state_abr", T.StringType(), False),
    T.StructField("state", T.StringType(), False),
])
STATE_REGION_SCHEMA = T.StructType([
    T.StructField("region", T.StringType(), False),
    T.StructField("state", T.StringType(), False),
])
INCOME_ORDER_SCHEMA = T.StructType([
    T.StructField("income_order", T.IntegerType(), False),
    T.StructField("census_cat", T.StringType(), False),
])


#: bound on the rows of the state dimensions
STATE_ROWS = len(STATE_NAMES)


def state_names(spark: SparkSession) -> DataFrame:
    """``state_abr``, ``state`` (52 rows)."""
    return spark.createDataFrame(list(STATE_NAMES), STATE_NAME_SCHEMA)


def state_regions(spark: SparkSession) -> DataFrame:
    """``region``, ``state`` keyed by full state name (52 rows)."""
    name = dict(STATE_NAMES)
    return spark.createDataFrame([(region, name[code]) for code, region in STATE_REGIONS], STATE_REGION_SCHEMA)


def income_order(spark: SparkSession) -> DataFrame:
    """``income_order`` (band lower bound), ``census_cat`` (8 rows)."""
    return spark.createDataFrame(list(INCOME_BANDS), INCOME_ORDER_SCHEMA)
