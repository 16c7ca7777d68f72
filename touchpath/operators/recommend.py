"""Next steps and next content for each contact, and the recommendation history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchpath.functions import columns as c
from touchpath.functions.scans import sum_within, with_scans
from touchpath.operators.dedup import keep_one
from touchpath.operators.skew import Heavy, if_small, is_small
from touchpath.operators.timeline import timeline_rows
from touchpath.settings import STEP_WINDOWS, Settings

STEPS = tuple(STEP_WINDOWS)
STEP_COLUMNS = tuple(step.lower() for step in STEPS)


def step_counts(
    activity: DataFrame, contact: DataFrame, settings: Settings, *, heavy: Heavy | None = None
) -> DataFrame:
    """Activities per step in the days before each contact's last row.

    At the last row every other row is an earlier one, so day totals are enough:
    a contact has at most one of them per calendar day.
    """
    rows = timeline_rows(activity, contact, settings, heavy)
    counts = [
        F.count_if(F.col("activity_type").isin(*types)).alias(step) for step, (types, _) in STEP_WINDOWS.items()
    ]
    daily = rows.groupBy("contact_id", "activity_date").agg(
        *counts, F.max_by("contact_name", F.struct("branch", "seq")).alias("contact_name")
    )
    daily = daily.withColumn("_last", F.max("activity_date").over(Window.partitionBy("contact_id")))
    age = F.date_diff(F.col("_last"), F.col("activity_date"))
    totals = [
        F.sum(F.when(age <= days, F.col(step)).otherwise(0)).alias(step.lower())
        for step, (_, days) in STEP_WINDOWS.items()
    ]
    return daily.groupBy("contact_id").agg(F.max_by("contact_name", "activity_date").alias("contact_name"), *totals)


def with_step_counts(rows: DataFrame) -> DataFrame:
    """Timeline rows with the activities per step in the days up to each; those of a contact's last row are its
    ``step_counts``. For who reads the timeline anyway: the log is then not read and placed a second time."""
    return with_scans(
        rows,
        {
            column: sum_within(F.col("activity_type").isin(*types).cast("int"), days)
            for column, (types, days) in zip(STEP_COLUMNS, STEP_WINDOWS.values())
        },
    )


def step_counts_long(counts: DataFrame) -> DataFrame:
    """One row per contact and step."""
    return counts.unpivot(["contact_id", "contact_name"], [step.lower() for step in STEPS], "step", "n")


def reachable(status: DataFrame) -> DataFrame:
    """Contacts with a level to act on."""
    return status.where(F.col("engagement_level") != "PresentDay")


def next_step(status: DataFrame, counts: DataFrame, settings: Settings) -> DataFrame:
    """Steps not taken lately, in the preferred order of the contact's level.

    Levels without a list give no row; a contact without counts gets an empty list.
    """
    orders = F.create_map(
        *[
            item
            for level, steps in settings.next_steps.items()
            for item in (F.lit(level), F.array(*[F.lit(step) for step in steps]))
        ]
    )
    taken = F.create_map(*[item for step in STEPS for item in (F.lit(step), F.col(step.lower()))])
    return (
        reachable(status)
        .select("contact_id", "contact_name", F.col("engagement_level").alias("level"))
        .join(counts.drop("contact_name"), "contact_id", "left")
        .withColumns({"_order": F.element_at(orders, F.col("level")), "_taken": taken})
        .where(F.col("_order").isNotNull())
        .select(
            "contact_id",
            "contact_name",
            "level",
            F.array_join(F.filter("_order", lambda step: F.element_at("_taken", step) == 0), ", ").alias("next_step"),
        )
    )


def content_consumption(
    web_tracking: DataFrame, contact: DataFrame, wanted: DataFrame, settings: Settings
) -> DataFrame:
    """First time each contact met each listed content.

    Visits are reduced to one per record id and content before any contact is
    looked up, so a contact with endless visits joins as few rows. Visits without a record id go by the short id; the
    null-safe join then asks for no test of the long one, which would compute it once more for each visit.
    """
    known = F.col("event_url").contains(settings.content_host) & F.col("contact_id_15").isNotNull()
    visits = web_tracking.where(known).select(
        c.record_id_18(F.col("contact_id_15")).alias("record_id"),
        "event_name",
        F.struct(F.col("event_ts").cast("date").alias("day"), "session_key", "event_url").alias("visit"),
    )
    first = visits.groupBy("record_id", "event_name").agg(F.min("visit").alias("visit"))
    listed = first.join(if_small(wanted.select("event_name").distinct()), "event_name", "left_semi")
    people = contact.where(F.col("account_name") != settings.excluded_account).select(
        F.col("record_id").alias("_record_id"), "contact_id", "contact_name"
    )
    return listed.join(people, F.col("record_id").eqNullSafe(F.col("_record_id"))).select(
        "contact_id",
        "contact_name",
        F.lit("WebHit").alias("activity_type"),
        F.col("visit.day").alias("activity_date"),
        "event_name",
        F.col("visit.event_url").alias("event_url"),
    )


def numbered_catalog(catalog: DataFrame) -> DataFrame:
    """Catalog items with their pool (0 for Level0 contacts, 1 for all others) and place in it.

    A catalog is a short curated list, kept by hand in one file.
    """
    place = F.row_number().over(Window.partitionBy("level").orderBy("event_name")) - 1
    return catalog.where(F.col("level").isin(0, 1)).select(
        F.col("level").alias("pool"), place.alias("place"), "event_name", "event_url"
    )


def _with_pool(status: DataFrame, catalog: DataFrame, consumption: DataFrame) -> DataFrame:
    """Reachable contacts with the size of their pool and the places they have consumed, ascending."""
    pool = F.when(F.col("engagement_level") == "Level0", 0).otherwise(1)
    people = reachable(status).withColumn("pool", pool)
    consumed = (
        consumption.select("contact_id", "event_name")
        .join(if_small(catalog), "event_name")
        .groupBy("contact_id", "pool")
        .agg(F.array_sort(F.collect_set("place")).alias("consumed"))
    )
    sizes = F.broadcast(catalog.groupBy("pool").agg(F.count("*").alias("size")))  # two pools, two rows
    return (
        people.join(consumed, ["contact_id", "pool"], "left")
        .join(sizes, "pool", "left")
        .withColumn("consumed", F.coalesce("consumed", F.array().cast("array<int>")))
        .withColumn("unseen", F.coalesce("size", F.lit(0)) - F.size("consumed"))
    )


def unseen_content(
    status: DataFrame, catalog: DataFrame, consumption: DataFrame
) -> DataFrame:
    """Content of each contact's pool that the contact has not consumed, as one sorted list."""
    numbered = numbered_catalog(catalog)
    pools = (
        numbered.groupBy("pool")
        .agg(F.array_sort(F.collect_list(F.struct("place", "event_name"))).alias("items"))
        .select("pool", F.col("items.place").alias("places"), F.col("items.event_name").alias("names"))
    )
    left = F.array_except("places", "consumed")  # keeps the order of the first
    return (
        _with_pool(status, numbered, consumption)
        .join(F.broadcast(pools) if is_small(numbered) else pools, "pool", "left")
        .select(
            "contact_id",
            "contact_name",
            F.array_join(F.transform(left, lambda place: F.col("names")[place]), ", ").alias("unseen_content"),
            F.col("unseen").cast("bigint").alias("n_unseen"),
        )
    )


def recommendation(
    status: DataFrame, catalog: DataFrame, consumption: DataFrame, settings: Settings
) -> DataFrame:
    """One random unseen item per contact, reproducible by seed; null when nothing is left.

    The draw picks the r-th unseen place directly: r is moved past each consumed
    place at or below it. No list of (contact, item) pairs is ever built.
    """
    numbered = numbered_catalog(catalog)
    r = (c.draw(settings.draw_seed, F.col("contact_id")) % F.col("unseen")).cast("int")
    place = F.when(
        F.col("unseen") > 0, F.aggregate("consumed", r, lambda at, used: F.when(used <= at, at + 1).otherwise(at))
    )
    return (
        _with_pool(status, numbered, consumption)
        .withColumn("unseen", F.nullif("unseen", F.lit(0)))
        .withColumn("place", place)
        .join(if_small(numbered), ["pool", "place"], "left")
        .select(
            "contact_id",
            "contact_name",
            "engagement_level",
            F.col("event_name").alias("sku_next_content"),
            F.col("event_url").alias("url_next_content"),
            F.lit(settings.as_of).alias("recommendation_date"),
        )
    )


def next_step_final(steps: DataFrame, recommended: DataFrame) -> DataFrame:
    """Next content of every contact with its next steps, null where its level has none."""
    return recommended.select("contact_id", F.col("url_next_content").alias("next_content")).join(
        steps, "contact_id", "left"
    ).select("contact_id", "contact_name", "level", "next_content", "next_step")


def recommendation_history(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new recommendations, each content once per contact; the old one stays."""
    both = old.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)))
    order = ("_age", "recommendation_date", "engagement_level", "url_next_content")
    return keep_one(both, ["contact_id", "sku_next_content"], order=order).drop("_age")


def new_recommendations(old: DataFrame, new: DataFrame) -> DataFrame:
    """What ``new`` adds to the history ``old``: with ``old`` it makes ``recommendation_history(old, new)``.

    Only keys of the history are read. Contacts to whom nothing is left have a null content once.
    """
    keys = ["contact_id", "sku_next_content"]
    once = keep_one(new, keys, order=("recommendation_date", "engagement_level", "url_next_content"))
    known = old.select(*[F.col(key).alias(f"_{key}") for key in keys])
    same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    return once.join(known, same[0] & same[1], "left_anti")


def recommendation_execution(history: DataFrame, consumption: DataFrame) -> DataFrame:
    """Recommendations numbered per contact by date, with the day the content was consumed.

    History holds each content once per contact, which bounds the numbered groups.
    """
    order = Window.partitionBy("contact_id").orderBy("recommendation_date", "sku_next_content")
    consumed = consumption.select(
        "contact_id", F.col("event_name").alias("sku_next_content"), F.col("activity_date").alias("execution_date")
    )
    return (
        history.withColumn("recommendation_id", F.row_number().over(order))
        .join(consumed, ["contact_id", "sku_next_content"], "left")
        .select(
            "recommendation_id", "contact_id", "contact_name", "engagement_level", "sku_next_content",
            "url_next_content", "recommendation_date", "execution_date",
        )
    )

