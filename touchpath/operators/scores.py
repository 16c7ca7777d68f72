"""Propensity scores over time, and the reports built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchpath.functions import columns as c
from touchpath.functions.scans import CHUNK, KEY, last_upto, with_scans
from touchpath.operators.cleaning import accepted, wanted_type, with_defaults, with_normal_fund
from touchpath.operators.dedup import keep_one
from touchpath.operators.skew import Heavy, arrange
from touchpath.settings import Settings

SCORE_BRANCH = -1  # scores of a day come before its activities


def score_days(history: DataFrame) -> DataFrame:
    """Each contact's scores by day, with the first day each is nearer than the one before.

    A tie goes to the earlier score. A contact has at most one row per calendar day.
    """
    daily = history.groupBy("contact_id", "process_date").agg(F.max("score").alias("score"))
    before = F.lag("process_date").over(Window.partitionBy("contact_id").orderBy("process_date"))
    halfway = F.floor(F.date_diff(F.col("process_date"), before) / 2).cast("int")
    return daily.withColumn(
        "nearest_from", F.coalesce(F.date_add(before, halfway + 1), F.lit("0001-01-01").cast("date"))
    )


def with_nearest_score(
    activity: DataFrame, history: DataFrame, *, heavy: Heavy | None = None
) -> DataFrame:
    """Activities with the score nearest in time of their contact, null without any score.

    Each score owns the days from ``nearest_from`` on, so the nearest score is the
    last one whose days have begun: one union, one order, no join of the two logs.
    """
    value = F.struct(F.col("process_date"), F.col("score"))
    scores = score_days(history).select(
        "contact_id",
        F.col("nearest_from").alias("activity_date"),
        F.lit(SCORE_BRANCH).alias("branch"),
        F.lit("").alias("seq"),
        value.alias("_score"),
    )
    if "branch" not in activity.columns:
        activity = activity.withColumn("branch", F.lit(1))
    rows = arrange(activity.unionByName(scores, allowMissingColumns=True), heavy)
    rows = with_scans(rows, {"_nearest": last_upto(F.col("_score"))})
    return (
        rows.where(F.col("branch") != SCORE_BRANCH)
        .withColumns({"process_date": F.col("_nearest.process_date"), "score": F.col("_nearest.score")})
        .drop("_score", "_nearest")
    )


def score_timeline(
    activity: DataFrame,
    history: DataFrame,
    fund_map: DataFrame,
    settings: Settings,
    *,
    heavy: Heavy | None = None,
) -> DataFrame:
    """Recent activities, one per contact, type, day and fund, with their nearest score."""
    floor = F.lit(settings.score_floor)
    rows = accepted(activity).where(wanted_type(settings) & (F.col("activity_date") >= floor))
    rows = with_defaults(with_normal_fund(rows, fund_map), settings).withColumn("branch", F.lit(1))
    rows = rows.select(
        "contact_id", "contact_name", "activity_type", "activity_date", "branch", "seq", "fund_code", "event_id"
    )
    if heavy is None:
        rows = rows.repartition("contact_id")
    rows = keep_one(rows, ["contact_id", "activity_date", "activity_type", "fund_code"])
    scored = with_nearest_score(rows, history.where(F.col("process_date") >= floor), heavy=heavy)
    return scored.select(
        "contact_id", "contact_name", "activity_type", "activity_date", "score", "event_id", "seq"
    )


def latest_events(timeline: DataFrame, settings: Settings) -> DataFrame:
    """The last events of each contact; those without a score are left out after counting."""
    order = Window.partitionBy("contact_id").orderBy(F.desc("activity_date"), F.desc("seq"))
    return (
        timeline.withColumn("_row", F.row_number().over(order))
        .where(F.col("_row") <= settings.timeline_rows)
        .where(F.col("score").isNotNull())
        .drop("_row", "seq")
    )


def master_contacts(contact: DataFrame) -> DataFrame:
    """Approved single contacts that are not rated out; unrated ones stay."""
    rated_out = F.col("rating").isin("O", "X")
    return contact.where(
        (~rated_out | F.col("rating").isNull()) & (F.col("approved") == "y") & (F.col("registration") == "Single")
    ).select("contact_id", "contact_name", "score_7_days_ago")


def latest_scores(history: DataFrame) -> DataFrame:
    """Latest score of each contact."""
    return history.groupBy("contact_id").agg(F.max_by("score", "process_date").alias("prediction"))


def activity_description(rows: DataFrame, settings: Settings) -> DataFrame:
    """Recent activities of selected types as text, one line each, per contact."""
    recent = rows.where(
        (F.col("activity_date") > F.date_sub(F.lit(settings.as_of), settings.recent_days))
        & F.col("activity_type").isin(*settings.described_types)
    )
    lines = keep_one(recent, ["contact_id", "activity_date", "activity_type", "additional_detail"]).withColumn(
        "_line", c.described(F.col("activity_type"), F.col("activity_date"), F.col("additional_detail"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("activity_date", "branch", "seq", "_line")))
    text = F.array_join(F.transform(ordered, lambda item: item["_line"]), "\n").alias("prop_desc")
    if CHUNK not in rows.columns:
        return lines.groupBy(KEY).agg(text)
    # a heavy contact's lines are put in order within the ranges of its log, then one text per range in the ranges' order
    cells = F.array_sort(F.collect_list(F.struct(CHUNK, "prop_desc")))
    whole = F.array_join(F.transform(cells, lambda cell: cell["prop_desc"]), "\n").alias("prop_desc")
    return lines.groupBy(KEY, CHUNK).agg(text).groupBy(KEY).agg(whole)


def score_delta(master: DataFrame, scores: DataFrame, description: DataFrame) -> DataFrame:
    """Change of each master contact's score over a week, with the activity description."""
    return (
        master.drop("contact_name")
        .join(scores, "contact_id", "left")
        .join(description, "contact_id", "left")
        .select(
            "contact_id",
            "contact_name",
            "prediction",
            c.percent_change(F.col("prediction"), F.col("score_7_days_ago")).alias("propensity_delta_percent"),
            "prop_desc",
        )
    )
