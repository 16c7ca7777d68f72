"""Keep heavy contacts out of single tasks.

``measure`` finds the contacts whose log is too long for one task. Their list is
a table, broadcast only after its size has been checked. ``by_size`` then builds a result twice: for the ordinary contacts, hash
partitioned by contact, and for the heavy ones, spread over tasks by
``arrange``. With no heavy contact the second build does not exist.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpath.functions.scans import CHUNK, KEY, POSITION
from touchpath.operators.dedup import keep_one

# a join side with no more rows is broadcast
SMALL_ROWS = 100_000
# tasks over which the rows of one key are dealt in a join with a side that is not small
SPREAD = 16
# rows of ordinary contacts in one task, on average
DEALT_ROWS = 250_000


@dataclass(frozen=True)
class Heavy:
    """Contacts to spread, the rows they hold, and the rows one task should get."""

    contacts: DataFrame
    rows: int
    rows_per_task: int

    @property
    def tasks(self) -> int:
        return max(2, math.ceil(self.rows / self.rows_per_task))


def measure(activity: DataFrame, rows_per_task: int) -> Heavy | None:
    """Heavy contacts of a log, or None. One count per contact, combined before the shuffle."""
    counts = activity.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.count("*").alias("n"))
    use_checkpoints(activity.sparkSession)
    found = counts.where(F.col("n") > rows_per_task).checkpoint()
    rows = found.agg(F.sum("n")).first()[0]
    return Heavy(found.select(KEY), rows, rows_per_task) if rows else None


def by_size(tables: Sequence[DataFrame], heavy: Heavy | None, build: Callable[..., DataFrame]) -> DataFrame:
    """``build(*tables, heavy=None)`` over ordinary contacts, plus ``build(*tables, heavy=heavy)`` over the rest."""
    if heavy is None:
        return build(*tables, heavy=None)
    listed = if_small(heavy.contacts)
    ordinary = [table.join(listed, KEY, "left_anti") for table in tables]
    spread = [table.join(listed, KEY, "left_semi") for table in tables]
    return build(*ordinary, heavy=None).unionByName(build(*spread, heavy=heavy).drop(CHUNK))


def arrange(
    rows: DataFrame,
    heavy: Heavy | None,
    distinct_by: Sequence[str] = (),
    keep_last: bool = False,
    log_rows: int | None = None,
) -> DataFrame:
    """Place rows for scanning, after dropping duplicates by ``distinct_by``.

    Ordinary contacts: one exchange on the contact, which serves the duplicate
    check and every scan after it. Given the rows of the log, the exchange makes
    as many parts as they need; else Spark joins parts up to a number of bytes
    that says little of the memory they take. Heavy contacts: duplicates are dropped
    before and after the shuffle, then the total order is cut into ranges of
    about equal size, and the range number is written down as ``chunk``.
    """
    if heavy is None:
        rows = rows.repartition(_parts(rows.sparkSession, log_rows), KEY) if log_rows else rows.repartition(KEY)
        return keep_one(rows, distinct_by, keep_last) if distinct_by else rows
    if distinct_by:
        rows = keep_one(rows, distinct_by, keep_last)
    use_checkpoints(rows.sparkSession)
    ranges = rows.repartitionByRange(heavy.tasks, KEY, "activity_date", *POSITION)
    # the range borders come from a sample: fix the numbering before it is read twice
    return ranges.withColumn(CHUNK, F.spark_partition_id()).checkpoint()


def _parts(spark: SparkSession, log_rows: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(log_rows / DEALT_ROWS))


def add_contact(rows: DataFrame, contact: DataFrame, heavy: Heavy | None, how: str = "left") -> DataFrame:
    """Join contact attributes to rows that ``by_size`` has split."""
    return rows.join(if_small(contact) if heavy else contact, KEY, how)


def join_contact(rows: DataFrame, contact: DataFrame, heavy: Heavy | None, how: str = "left") -> DataFrame:
    """Join contact attributes to rows of all contacts, splitting them here."""
    return by_size([rows, contact], heavy, partial(add_contact, how=how))


def is_small(table: DataFrame) -> bool:
    """Whether a table has few enough rows to be broadcast; counts no further than that."""
    return table.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS


def if_small(side: DataFrame) -> DataFrame:
    """Broadcast a join side after counting that it is small; otherwise leave the join to the planner."""
    return F.broadcast(side) if is_small(side) else side


def join_spread(rows: DataFrame, side: DataFrame, left: str, right: str, parts: int = SPREAD) -> DataFrame:
    """Join on a key of few values, each of which many rows share: ``rows.left = side.right``.

    A small side is broadcast. Otherwise the rows of a key are dealt over ``parts`` tasks by their other columns, and
    the side is repeated for each part.
    """
    if is_small(side):
        return rows.join(F.broadcast(side), F.col(left) == F.col(right))
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(*rows.columns), F.lit(parts)))
    repeated = side.withColumn("_side_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))))
    same = (F.col(left) == F.col(right)) & (F.col("_part") == F.col("_side_part"))
    return dealt.join(repeated, same).drop("_part", "_side_part")


def use_checkpoints(spark: SparkSession) -> None:
    """Make sure checkpoints go to the cluster's shared folder. Only a session on one machine may do without the
    setting; it gets a temporary folder."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="touchpath-")
    context.setCheckpointDir(folder)
