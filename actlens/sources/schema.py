"""Declared schemas of the activity data.

Declaring the schema avoids the extra inference pass over the input and
keeps the column types stable.  ``time`` is read as text and parsed by
:func:`actlens.operators.prepare.parse_time`, so a malformed value becomes a
null (dropped by cleaning) instead of failing the read.
"""

from pyspark.sql import types as T

ACTIVITY_COLUMNS = (
    "user_id", "session_id", "action", "category", "product_id",
    "time", "hour", "day_of_week", "device",
)

#: Name of the column that keeps a line that is no valid CSV of the schema.
CORRUPT = "_corrupt_record"

RAW_ACTIVITY = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("time", T.StringType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("day_of_week", T.StringType()),
    T.StructField("device", T.StringType()),
])
