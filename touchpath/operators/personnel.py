"""What sales personnel did, and whether the next funnel stage followed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpath.functions import columns as c
from touchpath.functions.scans import previous, sum_ahead, with_scans
from touchpath.operators.skew import Heavy, join_contact, join_spread
from touchpath.settings import PERSONNEL_TYPES, Settings

def user_territories(user: DataFrame, territory: DataFrame) -> DataFrame:
    """Active users with the territories they serve in either role.

    "user is the wholesaler or the associate" becomes an equality by listing the
    roles of each territory; a user in both roles of one territory counts once.
    """
    roles = territory.where(F.col("territory_name").isNotNull()).select(
        "territory_name",
        F.explode(F.array_distinct(F.array("internal_wholesaler", "sales_associate"))).alias("user_id"),
    )
    active = user.where(F.col("is_active") == "True").select("user_id", F.col("user_name").alias("personnel_name"))
    return active.join(roles, "user_id")


def task_territories(task: DataFrame, user: DataFrame, territory: DataFrame, settings: Settings) -> DataFrame:
    """Completed tasks of wanted kinds, once per territory of their owner."""
    done = task.where(
        (F.col("activity_date") > F.lit(settings.personnel_floor))
        & F.col("activity_type").isin(*PERSONNEL_TYPES)
        & F.col("profile").isin(*settings.profiles)
        & F.col("completed_at").isNotNull()
    )
    # few owners may hold all tasks
    return join_spread(done, user_territories(user, territory), "owner_id", "user_id").select(
        "personnel_name", "territory_name", "activity_type", "activity_date", F.col("who_id").alias("contact_id")
    )


def personnel_activity(
    task: DataFrame,
    event: DataFrame,
    event_relation: DataFrame,
    user: DataFrame,
    territory: DataFrame,
    contact: DataFrame,
    settings: Settings,
    *,
    heavy: Heavy | None = None,
) -> DataFrame:
    """Distinct task and meeting actions. Tasks of unknown contacts stay, without a contact."""
    names = contact.select("contact_id", "contact_name", "territory")
    known = names.select("contact_id", "contact_name", F.lit(True).alias("_known"))
    # repeats collapse before the contact lookup, so a busy contact joins fewer rows
    tasks = task_territories(task, user, territory, settings).distinct()
    tasks = (
        join_contact(tasks, known, heavy)
        .withColumn("contact_id", F.when(F.col("_known"), F.col("contact_id")))
        .drop("_known")
        .distinct()
    )
    meetings = event.where(
        (F.col("event_type") == "Meeting") & (F.col("activity_date") > F.lit(settings.personnel_floor))
    ).join(event_relation, "event_id")
    # an owner's meetings collapse by day and contact before the owner is looked up, and few owners may hold them all
    meetings = meetings.select("owner_id", "event_type", "activity_date", "contact_id").distinct()
    active = user.where(F.col("is_active") == "True").select("user_id", F.col("user_name").alias("personnel_name"))
    met = (
        join_spread(meetings, active, "owner_id", "user_id")
        .select("personnel_name", F.col("event_type").alias("activity_type"), "activity_date", "contact_id")
        .distinct()
    )
    met = (
        join_contact(met, names.where(F.col("territory").isNotNull()), heavy, "inner")
        .withColumnRenamed("territory", "territory_name")
        .distinct()
    )
    return tasks.unionByName(met).withColumn("activity_type", c.clean_type(F.col("activity_type"), PERSONNEL_TYPES))


def with_outlook(rows: DataFrame) -> DataFrame:
    """Lifecycle rows with the prior level and what follows in the next weeks."""
    kind, level = F.col("activity_type"), F.col("engagement_level")
    rows = with_scans(
        rows,
        {
            "_prior": previous(level),
            "sales_presentation_f": sum_ahead((kind == "Sales.Presentation").cast("int"), 60),
            "tickets_f": sum_ahead((kind == "Sale").cast("int"), 35),
            "meeting_f": sum_ahead((kind == "Meeting").cast("int"), 35),
        },
    )
    return rows.withColumn("prior_level", F.coalesce("_prior", "engagement_level")).drop("_prior")


def personnel_outcome(actions: DataFrame, outlook: DataFrame) -> DataFrame:
    """Actions with what followed for the contact; every matching lifecycle row counts.

    Success is 1 when the next funnel stage followed, 0 when not, and unknown
    when the action has no lifecycle row and its type could have succeeded.
    """
    keys = ["contact_id", "contact_name", "activity_date", "activity_type"]
    kind = F.col("activity_type")
    shown, sold, met = (F.col(name) > 0 for name in ("sales_presentation_f", "tickets_f", "meeting_f"))
    stages = (
        (kind.isin("VoiceMail", "Outbound"), shown | sold | met),
        (kind == "Sales.Presentation", met | sold),
        (kind == "Meeting", sold),
    )
    success = F.lit(0)
    for applies, followed in reversed(stages):
        success = F.when(applies, followed.cast("int")).otherwise(success)
    followed = outlook.select(*keys, "prior_level", "sales_presentation_f", "tickets_f", "meeting_f")
    return (
        actions.join(followed, keys, "left")
        .withColumn("success", success)
        .select(
            "personnel_name", "territory_name", "contact_id", "contact_name", "activity_type", "activity_date",
            "prior_level", "sales_presentation_f", "tickets_f", "meeting_f", "success",
        )
    )
