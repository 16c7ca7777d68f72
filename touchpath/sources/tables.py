"""Readers. All apply a fixed schema; filters and column choices reach the source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line; text stays text: an empty one in quotes is empty, nothing at all is missing."""
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    return reader.option("nullValue", "\x00").csv(path)  # the default takes both for missing


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table."""
    return spark.table(name)


def read_jdbc(
    spark: SparkSession, url: str, table: str, properties: dict[str, str], predicates: Sequence[str] | None = None
) -> DataFrame:
    """A relational table or query; one read task per predicate (they must not overlap)."""
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)
    return spark.read.jdbc(url, table, properties=properties)


def project(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Copy of some columns of a wide table."""
    return table.select(*columns)


# columns copied from the web-tracking table
WEB_TRACKING_COLUMNS = (
    "contact_id_15",
    "visitor_key",
    "session_key",
    "session_start_ts",
    "event_name",
    "event_url",
    "site_name",
    "site_url",
)
