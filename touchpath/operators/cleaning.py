"""Filters, defaults and enrichment of the raw activity log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpath.functions import columns as c
from touchpath.operators.skew import Heavy, add_contact, arrange, if_small
from touchpath.settings import Settings


def wanted_type(settings: Settings) -> Column:
    """Activity types that count. A missing type does not."""
    return ~F.col("activity_type").isin(*settings.excluded_types)


def filtered(activity: DataFrame, settings: Settings) -> DataFrame:
    """Wanted types since the year floor."""
    return activity.where(wanted_type(settings) & (F.col("activity_date") >= F.lit(settings.year_floor)))


def accepted(activity: DataFrame) -> DataFrame:
    """Activities that can be placed on a contact's timeline."""
    return activity.where(F.col("contact_id").isNotNull() & F.col("activity_date").isNotNull())


def rejected(activity: DataFrame) -> DataFrame:
    """Activities without a contact or a date: they have no place in any order."""
    return activity.where(F.col("contact_id").isNull() | F.col("activity_date").isNull())


def unmapped_types(activity: DataFrame, settings: Settings) -> DataFrame:
    """How often each type occurs that the vocabulary does not know."""
    unknown = ~F.col("activity_type").isin(*settings.type_names, *settings.excluded_types)
    return activity.where(unknown).groupBy("activity_type").agg(F.count("*").alias("n"))


def with_normal_fund(activity: DataFrame, fund_map: DataFrame) -> DataFrame:
    """Fund codes replaced by the code they are grouped under, if any."""
    return activity.join(if_small(fund_map), "fund_code", "left").withColumn(
        "fund_code", F.coalesce("single_fund_code", "fund_code")
    ).drop("single_fund_code")


def with_advisor_flag(activity: DataFrame) -> DataFrame:
    """``advisor_type`` as 1 for broker dealers, 0 for everything else."""
    return activity.withColumn("advisor_type", F.when(F.col("advisor_type") == "Broker Dealer", 1).otherwise(0))


def with_defaults(activity: DataFrame, settings: Settings) -> DataFrame:
    """Clean type names, "Nothing" for a missing type, 0 for a missing amount."""
    return activity.withColumns(
        {
            "activity_type": F.coalesce(c.clean_type(F.col("activity_type"), settings.type_names), F.lit("Nothing")),
            "sales_amount": F.coalesce("sales_amount", F.lit(0).cast("decimal(18,2)")),
        }
    )


def clean_activity(
    activity: DataFrame, fund_map: DataFrame, settings: Settings, *, heavy: Heavy | None = None
) -> DataFrame:
    """The cleaned activity table: filtered, normalised, defaulted, without repeats."""
    rows = with_normal_fund(filtered(accepted(activity), settings), fund_map)
    rows = with_defaults(with_advisor_flag(rows), settings).withColumn("branch", F.lit(1))
    return arrange(
        rows, heavy, ("contact_id", "activity_date", "activity_type", "fund_code", "additional_detail")
    )


def enriched(activity: DataFrame, contact: DataFrame, settings: Settings, *, heavy: Heavy | None = None) -> DataFrame:
    """Wanted activities with the contact's type and first sale date."""
    attributes = contact.select("contact_id", "contact_type", F.col("first_sale_date_new").alias("first_sale_date"))
    return add_contact(activity.where(wanted_type(settings)), attributes, heavy)
