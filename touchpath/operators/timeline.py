"""A contact's timeline: where the journey begins, what happened, the present day.

``branch`` orders rows of one day: 0 journey start, 1 activities, 2 present day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchpath.functions import columns as c
from touchpath.functions.scans import is_first, is_last, with_scans
from touchpath.operators.cleaning import accepted, wanted_type, with_defaults
from touchpath.operators.skew import Heavy, add_contact, arrange
from touchpath.settings import Settings

START, REAL, PRESENT = 0, 1, 2


def journey_start(activity: DataFrame, contact: DataFrame) -> DataFrame:
    """Start of the journey of each contact with activity, of any type."""
    first = accepted(activity).groupBy("contact_id", "contact_name").agg(F.min("activity_date").alias("first_activity"))
    return first.join(contact.select("contact_id", "created_date"), "contact_id", "left").select(
        "contact_id",
        "contact_name",
        c.journey_begin(F.col("first_activity"), F.col("created_date")).alias("activity_date"),
    )


def contacts_without_activity(activity: DataFrame, contact: DataFrame) -> DataFrame:
    active = accepted(activity).select("contact_id").distinct()
    return contact.join(active, "contact_id", "left_anti").select("contact_id", "contact_name", "created_date").distinct()


def present_day_rows(
    activity: DataFrame, contact: DataFrame, settings: Settings, *, heavy: Heavy | None = None
) -> DataFrame:
    """One present-day row per distinct (contact, detail, link) among the wanted activities."""
    groups = (
        accepted(activity)
        .where(wanted_type(settings))
        .select("contact_id", "contact_name", "additional_detail", "link")
        .distinct()
    )
    attributes = contact.select("contact_id", "contact_type", F.col("first_sale_date_new").alias("first_sale_date"))
    return add_contact(groups, attributes, heavy).select(
        "contact_id",
        "contact_name",
        F.lit(settings.as_of).alias("activity_date"),
        "contact_type",
        "first_sale_date",
    )


def activity_timeline(
    activity: DataFrame, contact: DataFrame, settings: Settings, *, heavy: Heavy | None = None
) -> DataFrame:
    """All rows of all contacts before any duplicate is dropped.

    The log is read and placed by contact once. On one sort, the first row of each contact name knows the start of the
    journey and the first row of each group of wanted activities stands for its present day; one join brings the
    contact's attributes and the idle contacts, and every row then gives the one to three rows it stands for.
    """
    if heavy is not None:
        return _spread_timeline(activity, contact, settings, heavy)
    person = Window.partitionBy("contact_id", "contact_name")
    within = ("additional_detail", "link", F.col("_wanted").desc())
    log = (
        accepted(activity)
        .select(
            "contact_id", "contact_name", "activity_date", "activity_type", "sales_amount", "additional_detail", "link",
            F.coalesce(wanted_type(settings), F.lit(False)).alias("_wanted"),
        )
        .repartition("contact_id")
        .withColumn("_row", F.row_number().over(person.orderBy(*within)))
        .withColumn(
            "_group_row",
            F.row_number().over(
                Window.partitionBy("contact_id", "contact_name", *within[:2]).orderBy(within[2])
            ),
        )
        .withColumn("_begin", F.min("activity_date").over(person))
    )
    known = contact.select(
        "contact_id", F.col("contact_name").alias("_known_name"), "created_date", "contact_type",
        F.col("first_sale_date_new").alias("first_sale_date"),
    )
    idle, as_of = F.col("activity_date").isNull(), F.lit(settings.as_of)

    def row(branch: int, day: Column, condition: Column) -> Column:
        return F.when(condition, F.struct(F.lit(branch).alias("branch"), day.alias("activity_date")))

    rows = F.array(
        row(REAL, F.col("activity_date"), F.col("_wanted")),
        row(START, c.journey_begin(F.col("_begin"), F.col("created_date")), F.col("_row") == 1),
        row(PRESENT, as_of, F.col("_wanted") & (F.col("_group_row") == 1)),
        row(START, F.col("created_date"), idle),
        row(START, as_of, idle),
    )
    real = F.col("_mark.branch") == REAL
    return (
        log.join(known, "contact_id", "full_outer")
        .withColumn("_mark", F.explode(F.filter(rows, lambda mark: mark.isNotNull())))
        .select(
            "contact_id",
            F.when(idle, F.col("_known_name")).otherwise(F.col("contact_name")).alias("contact_name"),
            F.col("_mark.activity_date").alias("activity_date"),
            "contact_type",
            "first_sale_date",
            *[F.when(real, F.col(name)).alias(name) for name in ("activity_type", "sales_amount", "additional_detail", "link")],
            F.col("_mark.branch").alias("branch"),
        )
    )


def _spread_timeline(
    activity: DataFrame, contact: DataFrame, settings: Settings, heavy: Heavy
) -> DataFrame:
    """The same rows without a window over a contact: starts and groups are reduced before the shuffle."""
    attributes = contact.select("contact_id", "contact_type", F.col("first_sale_date_new").alias("first_sale_date"))
    idle = contacts_without_activity(activity, contact)
    starts = journey_start(activity, contact).unionByName(
        idle.select("contact_id", "contact_name", F.col("created_date").alias("activity_date"))
    ).unionByName(idle.select("contact_id", "contact_name", F.lit(settings.as_of).alias("activity_date")))
    empty = {
        "activity_type": F.lit(None).cast("string"),
        "sales_amount": F.lit(None).cast("decimal(18,2)"),
        "additional_detail": F.lit(None).cast("string"),
        "link": F.lit(None).cast("string"),
    }
    real = accepted(activity).where(wanted_type(settings)).select("contact_id", "contact_name", "activity_date", *empty)
    present = present_day_rows(activity, contact, settings, heavy=heavy)
    return (
        add_contact(starts, attributes, heavy)
        .withColumns(empty | {"branch": F.lit(START)})
        .unionByName(add_contact(real, attributes, heavy).withColumn("branch", F.lit(REAL)))
        .unionByName(present.withColumns(empty | {"branch": F.lit(PRESENT)}))
    )


def markers(activity: DataFrame, contact: DataFrame, settings: Settings) -> DataFrame:
    """Journey-start and present-day rows, the latter once per contact name.

    One pass over the log and one join give the same rows as the separate
    branches of ``activity_timeline`` once duplicates are dropped.
    """
    seen = (
        accepted(activity)
        .groupBy("contact_id", "contact_name")
        .agg(
            F.min("activity_date").alias("first_activity"),
            F.max(F.coalesce(wanted_type(settings), F.lit(False))).alias("wanted"),
        )
    )
    known = contact.select("contact_id", F.col("contact_name").alias("known_name"), "created_date")
    idle = F.col("first_activity").isNull()
    as_of = F.lit(settings.as_of)
    # an idle contact starts on its creation date; c.journey_begin gives that too
    begin = c.journey_begin(F.col("first_activity"), F.col("created_date"))
    marks = F.array(
        F.struct(F.lit(START).alias("branch"), begin.alias("activity_date")),
        F.when(idle | F.col("wanted"), F.struct(F.lit(PRESENT).alias("branch"), as_of.alias("activity_date"))),
    )
    return (
        seen.join(known, "contact_id", "full_outer")
        .select(
            "contact_id",
            F.when(idle, F.col("known_name")).otherwise(F.col("contact_name")).alias("contact_name"),
            F.explode(F.filter(marks, lambda mark: mark.isNotNull())).alias("mark"),
        )
        .select(
            "contact_id",
            "contact_name",
            "mark.branch",
            "mark.activity_date",
            F.coalesce("contact_name", F.lit("")).alias("seq"),
        )
    )


def timeline_rows(
    activity: DataFrame,
    contact: DataFrame,
    settings: Settings,
    heavy: Heavy | None,
    distinct_by: tuple[str, ...] = ("contact_id", "activity_date", "activity_type", "additional_detail"),
    keep_last: bool = False,
) -> DataFrame:
    """Cleaned rows of real activities and markers, without repeats, placed for scanning."""
    real = (
        with_defaults(accepted(activity).where(wanted_type(settings)), settings)
        .withColumn("branch", F.lit(REAL))
        .withColumn("additional_detail", F.coalesce("additional_detail", F.lit("Nothing")))
        .select(
            "contact_id", "contact_name", "activity_type", "activity_date", "branch", "seq",
            "sales_amount", "additional_detail", "link",
        )
    )
    marks = markers(activity, contact, settings).withColumns(
        {
            "activity_type": F.lit("Nothing"),
            "sales_amount": F.lit(0).cast("decimal(18,2)"),
            "additional_detail": F.lit("Nothing"),
            "link": F.lit(None).cast("string"),
        }
    )
    # a contact unknown to both sides has no date at all
    marks = accepted(marks)
    return arrange(real.unionByName(marks), heavy, distinct_by, keep_last)


def first_last_flags(rows: DataFrame) -> DataFrame:
    """Flag the first and the last row of each contact."""
    return with_scans(rows, {"is_first": is_first(), "is_last": is_last()})


def last_activity_date(rows: DataFrame, heavy: Heavy | None = None) -> DataFrame:
    """Latest date of each contact, on each of its rows."""
    latest = rows.groupBy("contact_id").agg(F.max("activity_date").alias("max_activity_date"))
    return add_contact(rows, latest, heavy)
