"""CSV source and sink of the activity table (IO1, IO3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actlens.functions.exprs import time_text

from actlens.sources.schema import CORRUPT, RAW_ACTIVITY


def read_activity(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = RAW_ACTIVITY,
    infer: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Read header CSV files (a file, folder or glob).

    With the declared schema (default) there is no inference pass; the CSV
    reader splits large files so the scan is parallel.  Each file's header
    is checked against the schema, so a file with other or reordered columns
    fails instead of being read into the wrong columns.  ``infer=True``
    reproduces schema inference for exploratory use.

    ``keep_corrupt=True`` adds the column ``_corrupt_record``: the whole line where it is not
    valid CSV of the schema (too few or too many fields, text in a number), else null; see
    :func:`actlens.operators.prepare.with_reject_reason`.  Every field is then parsed, whichever are used.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if infer:
        return reader.option("inferSchema", True).csv(path)
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
    return reader.option("enforceSchema", False).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Write rows as header CSV part files under ``path`` (no index column).

    Each task writes its own part, so the export is as parallel as the input;
    nothing is gathered on the driver.  Timestamps are written in the
    activity file layout (with microseconds only when present), so
    :func:`read_activity` reads the export back unchanged.
    """
    cols = [
        time_text(f.name).alias(f.name) if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
        else F.col(f.name)
        for f in df.schema.fields
    ]
    df.select(*cols).write.mode(mode).option("header", True).csv(path)
    return path
