"""Intermediate tables in the cluster's shared folder.

Everything goes under the folder that the session names in
``spark.checkpoint.dir``.  Where that setting is absent, a folder inside the
warehouse (shared as well) is used; the session itself is never changed.
Folders are removed when the application ends, or before that by
:func:`release_scratch`, once no frame that reads them is needed any more.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate data."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named.rstrip("/") if named else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


#: Folders made by this process and not yet removed.
_MADE: list[str] = []


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under :func:`scratch_root`, deleted when the application ends."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    where, fs = _file_system(spark, path)
    fs.mkdirs(where)
    fs.deleteOnExit(where)
    _MADE.append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Remove all intermediate tables made so far; returns their number.  For callers that run
    many analyses in one application: frames that read such a table are of no use afterwards."""
    done = 0
    while _MADE:
        where, fs = _file_system(spark, _MADE.pop())
        done += fs.delete(where, True)
    return done


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as parquet to a scratch folder and read it from there.

    For a derived table that several plans reuse: they read the written rows
    instead of computing them again, and the lineage is cut, so that a lost
    executor costs only the tasks it was running."""
    spark = df.sparkSession
    path = f"{scratch_path(spark, name)}/data"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_bucketed(df: DataFrame, buckets: int, column: str, name: str = "table") -> DataFrame:
    """:func:`materialize`, but as a bucketed table: what groups, joins or numbers by
    ``column`` (and more) reads its distribution from the files and needs no shuffle.

    Spark knows buckets only of catalog tables, so the folder is a table of the session's
    catalog while the frame is made; the frame reads the files and outlives the entry."""
    spark = df.sparkSession
    path, table = f"{scratch_path(spark, name)}/data", f"scratch_{uuid.uuid4().hex}"
    df.write.format("parquet").option("path", path).bucketBy(buckets, column).saveAsTable(table)
    try:
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")
