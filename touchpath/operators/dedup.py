"""Ordered duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TOTAL_ORDER = ("activity_date", "branch", "seq")


def keep_one(
    rows: DataFrame, keys: Sequence[str], keep_last: bool = False, order: Sequence[str] = TOTAL_ORDER
) -> DataFrame:
    """First (or last) row of each key group in the given order; null keys count as equal.

    Spark turns ``row_number() == 1`` into a group limit that already runs before
    the shuffle, so a group of many copies reaches its task as one row per input task.
    """
    by = [F.col(c).desc() if keep_last else F.col(c).asc() for c in order if c not in keys]
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    return rows.withColumn("_number", number).where(F.col("_number") == 1).drop("_number")
