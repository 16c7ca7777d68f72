"""Writers. Results are written by the executors; nothing passes through the driver."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY = "snapshot_date"  # folder column of dated snapshots
POINTERS = "_days"  # folder with an empty file for each day of an appended history; readers of the table pass it over


def full_refresh(rows: DataFrame, path: str) -> None:
    """Replace a table by new contents."""
    rows.write.mode("overwrite").parquet(path)


def full_refresh_table(rows: DataFrame, name: str, buckets: int | None = None, path: str | None = None) -> None:
    """Replace a catalog table by new contents.

    With ``buckets`` the table is stored by contact: scans and contact joins on it
    then start without moving its rows.
    """
    if buckets is not None:
        # one task per bucket, or every task would write a file into every bucket
        rows = rows.repartition(buckets, "contact_id")
    writer = rows.write.mode("overwrite")
    if path is not None:
        writer = writer.option("path", path)
    if buckets is not None:
        writer = writer.bucketBy(buckets, "contact_id").sortBy("contact_id")
    writer.saveAsTable(name)


def dated_snapshot(rows: DataFrame, path: str, day: dt.date, kind: str = "csv") -> None:
    """Write one day's snapshot next to those of other days; a re-run replaces its own day only."""
    writer = rows.withColumn(DAY, F.lit(day)).write.mode("overwrite").partitionBy(DAY)
    writer = writer.option("partitionOverwriteMode", "dynamic")
    if kind == "csv":
        writer = writer.option("header", True)
    writer.format(kind).save(path)


def latest_csv(rows: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Export the latest result as CSV files with a header, sorted if asked."""
    ordered = rows.orderBy(*order) if order else rows
    ordered.write.mode("overwrite").option("header", True).csv(path)


def write_history(rows: DataFrame, path: str, day: dt.date) -> None:
    """Write a table that is computed from its own past as the snapshot of ``day``.

    Earlier snapshots are never touched: what the result was read from stays in
    place while it is written, and a failed run can simply be repeated.
    """
    dated_snapshot(rows, path, day, kind="parquet")


def read_snapshot(spark: SparkSession, path: str, day: dt.date, schema: T.StructType) -> DataFrame:
    """The snapshot of one day; only its folder is read."""
    return spark.read.schema(_with_day(schema)).parquet(path).where(F.col(DAY) == F.lit(day)).drop(DAY)


def read_history(spark: SparkSession, path: str, before: dt.date, schema: T.StructType) -> DataFrame:
    """Latest snapshot older than ``before``; empty if there is none or nothing was ever written.

    The newest day is found by the names of the folders; no snapshot is opened for it.
    """
    days = [day for day in _days(spark, path) if day < before]
    if not days:
        return spark.createDataFrame([], schema)
    return read_snapshot(spark, path, max(days), schema)


def append_history(rows: DataFrame, path: str, day: dt.date) -> None:
    """Add the new rows of ``day`` to a table that only grows, then point to the day.

    Rows of other days are neither read nor written. A day counts from the moment its pointer, an empty file, exists;
    a run that failed before can be repeated, and a repeated run replaces the rows of its own day.
    """
    spark = rows.sparkSession
    rows.write.mode("overwrite").parquet(f"{path}/{DAY}={day}")
    files, pointer = _file_system(spark, f"{path}/{POINTERS}/{DAY}={day}")
    files.create(pointer, True).close()


def read_appended(spark: SparkSession, path: str, before: dt.date, schema: T.StructType) -> DataFrame:
    """All rows added on days before ``before`` whose run came to its end; empty without any."""
    days = [day for day in _days(spark, f"{path}/{POINTERS}") if day < before]
    if not days:
        return spark.createDataFrame([], schema)
    return spark.read.schema(_with_day(schema)).parquet(path).where(F.col(DAY).isin(days)).drop(DAY)


def newest_day(spark: SparkSession, path: str) -> dt.date | None:
    """The last day added to an appended history."""
    return max(_days(spark, f"{path}/{POINTERS}"), default=None)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _days(spark: SparkSession, path: str) -> list[dt.date]:
    """The days that have an entry in a folder; one listing, nothing is opened."""
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return [dt.date.fromisoformat(name.removeprefix(f"{DAY}=")) for name in names if name.startswith(f"{DAY}=")]


def _with_day(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
