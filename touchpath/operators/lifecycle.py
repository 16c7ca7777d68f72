"""Engagement levels over a contact's timeline, their changes, paths and spells."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpath.functions import columns as c
from touchpath.functions.scans import (
    bits_before,
    is_first,
    is_last,
    last_before,
    last_upto,
    list_upto,
    previous,
    running_sum,
    with_scans,
)
from touchpath.operators.skew import Heavy, add_contact
from touchpath.operators.timeline import timeline_rows
from touchpath.settings import LEVELS, LIGHT_TOUCHES, STRONG_TOUCHES, Settings

LONG = 3000  # days: practically for ever


@dataclass(frozen=True)
class Rules:
    """What distinguishes the two rule sets."""

    first_sale: str
    distinct_by: tuple[str, ...]
    keep_last: bool
    kit_days: int
    forum_days: int
    meeting_days: int
    roadshow_days: int
    presentation_days: int
    detail_days: int
    outbound_days: int
    use_links: bool
    level_1: tuple[str, ...]


# fixed values: days an activity keeps a contact at a level
LASTING = Rules(
    first_sale="first_sale_date_all",
    distinct_by=("contact_id", "activity_date", "activity_type"),
    keep_last=True,
    kit_days=LONG,
    forum_days=LONG,
    meeting_days=LONG,
    roadshow_days=LONG,
    presentation_days=LONG,
    detail_days=LONG,
    outbound_days=LONG,
    use_links=False,
    level_1=LIGHT_TOUCHES,
)
DECAYING = Rules(
    first_sale="first_sale_date_new",
    distinct_by=("contact_id", "activity_date", "activity_type", "additional_detail"),
    keep_last=False,
    kit_days=60,
    forum_days=180,
    meeting_days=90,
    roadshow_days=180,
    presentation_days=60,
    detail_days=35,
    outbound_days=90,
    use_links=True,
    level_1=LIGHT_TOUCHES + STRONG_TOUCHES,
)

# fixed values: producer thresholds (a month is 30 days)
NEW_DAYS, ADVOCATE_DAYS = 6 * 30, 20 * 30
RISING_SALES, CORE_SALES, ADVOCATE_SALES = 150_000, 350_000, 1_000_000


def with_levels(rows: DataFrame, rules: Rules, settings: Settings) -> DataFrame:
    """Running sales, first/last flags and the engagement level of each row.

    A level asks "did this happen within t days?". The answer is the date of the
    latest such row so far compared with the row's own date, so one running
    maximum per condition replaces a trailing count per type and window.
    """
    kind, detail, link = F.col("activity_type"), F.col("additional_detail"), F.col("link")
    sources = {
        "order": (kind == "LitOrder", rules.kit_days),
        "kit": (detail.isin("KIT", "PRO", "PR"), rules.kit_days),
        "forum": (kind == "EdForum", rules.forum_days),
        "meeting": (kind == "Meeting", rules.meeting_days),
        "roadshow": (
            kind.isin("Assisted.Roadshow", "Unassisted.Roadshow", "Investor.University"),
            rules.roadshow_days,
        ),
        "presentation": (kind.isin("Sales.Presentation", "Marketing.Webinar"), rules.presentation_days),
        "detail": (detail.isin("education-center", "webinars", "our-funds"), rules.detail_days),
        "outbound": (kind == "Outbound", rules.outbound_days),
        "touch": (kind.isin(*rules.level_1), LONG),
    }
    if rules.use_links:
        looked = c.matches(link, settings.learn_pattern) | c.matches(link, settings.investments_pattern)
        sources["detail"] = (sources["detail"][0] | looked, rules.detail_days)

    scans = {f"_{name}": last_upto(F.when(happened, F.col("activity_date"))) for name, (happened, _) in sources.items()}
    scans |= {"sales": running_sum(F.col("sales_amount")), "is_first": is_first(), "is_last": is_last()}
    rows = with_scans(rows, scans)

    recent = {
        name: F.coalesce(F.date_diff(F.col("activity_date"), F.col(f"_{name}")) <= days, F.lit(False))
        for name, (_, days) in sources.items()
    }
    days = F.date_diff(F.col("activity_date"), F.col("first_sale_date"))
    sales = F.col("sales")
    sold = F.col("first_sale_date").isNotNull() & (sales > 0)
    conditions = (
        F.col("is_last"),
        sold & (days <= NEW_DAYS) & (sales <= RISING_SALES),
        sold & (days <= NEW_DAYS) & (sales > RISING_SALES),
        sold & (days > NEW_DAYS) & (sales <= CORE_SALES),
        sold & (days > ADVOCATE_DAYS) & (sales > ADVOCATE_SALES),
        sold & (days > NEW_DAYS) & (sales > CORE_SALES),
        (recent["order"] & recent["kit"]) | recent["forum"] | recent["meeting"],
        recent["roadshow"],
        recent["presentation"],
        recent["detail"] | recent["outbound"],
        recent["touch"],
        F.lit(True),
    )
    code = F.coalesce(*[F.when(condition, F.lit(number)) for number, condition in enumerate(conditions)])
    return (
        rows.withColumn("_code", code)
        .withColumn("level", F.element_at(F.array(*[F.lit(label) for label in LEVELS]), F.col("_code") + 1))
        .withColumn("level_bit", F.element_at(F.array(*[F.lit(1 << n) for n in range(len(LEVELS))]), F.col("_code") + 1))
        .drop("_code", *[f"_{name}" for name in sources])
    )


def with_changes(rows: DataFrame) -> DataFrame:
    """Level change, path of distinct levels so far, and length of the spell that just ended."""
    rows = with_scans(rows, {"_prior": previous(F.col("level")), "_met": bits_before(F.col("level_bit"))})
    changed = F.col("is_first") | (F.col("_prior") != F.col("level"))
    unmet = F.col("_met").bitwiseAND(F.col("level_bit")) == 0
    rows = with_scans(
        rows,
        {
            "_spell": last_before(F.when(changed, F.col("activity_date"))),
            "_path": list_upto(F.when(unmet, F.col("level"))),  # at most one entry per label
        },
    )
    moved = ~F.col("is_first") & (F.col("_prior") != F.col("level"))
    return rows.withColumns(
        {
            "recent_level_change": F.when(moved, c.change_label(F.col("_prior"), F.col("level"))),
            "full_level_cycle": F.array_join("_path", "-->"),
            "duration_last_level": F.when(moved, F.date_diff(F.col("activity_date"), F.col("_spell"))),
            "prior_row_level": F.col("_prior"),
        }
    ).drop("_prior", "_met", "_spell", "_path")


def with_labels(rows: DataFrame) -> DataFrame:
    """Journey labels on the outer rows; the present day takes the level before it."""
    label = (
        F.when(F.col("is_first"), "JourneyBegins").when(F.col("is_last"), "Present").otherwise(F.col("activity_type"))
    )
    level = F.when(
        F.col("level") == "PresentDay", F.coalesce("prior_row_level", F.lit("PresentDay"))
    ).otherwise(F.col("level"))
    return rows.withColumns({"activity_type": label, "engagement_level": level})


def leveled_rows(
    activity: DataFrame,
    contact: DataFrame,
    rules: Rules,
    settings: Settings,
    *,
    heavy: Heavy | None = None,
    extend: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Timeline rows with their level, and with what ``extend`` adds to them."""
    rows = extend(timeline_rows(activity, contact, settings, heavy, rules.distinct_by, rules.keep_last))
    attributes = contact.select("contact_id", "contact_type", F.col(rules.first_sale).alias("first_sale_date"))
    return with_levels(add_contact(rows, attributes, heavy), rules, settings)


def lifecycle_rows(
    activity: DataFrame,
    contact: DataFrame,
    rules: Rules,
    settings: Settings,
    *,
    heavy: Heavy | None = None,
    extend: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Every timeline row with level, change, path, spell and labels, and with what ``extend`` adds to it."""
    return with_labels(with_changes(leveled_rows(activity, contact, rules, settings, heavy=heavy, extend=extend)))


FULL_COLUMNS = (
    "contact_id",
    "contact_name",
    "activity_type",
    "activity_date",
    "engagement_level",
    "duration_last_level",
    "recent_level_change",
    "full_level_cycle",
    "contact_type",
)


def full(rows: DataFrame) -> DataFrame:
    return rows.select(*FULL_COLUMNS)


def transitions(rows: DataFrame) -> DataFrame:
    """Rows on which the level changed."""
    return full(rows).where(F.col("recent_level_change").isNotNull())


def current_status(rows: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Last row of each contact, with ``more`` of its columns."""
    return rows.where("is_last").select(
        "contact_id", "contact_name", "engagement_level", "duration_last_level", "full_level_cycle", *more
    )


def sample(status: DataFrame, rows: int = 1000, order: Sequence[str] = ()) -> DataFrame:
    """Some rows of a table, for a look at it: the first ones in an order, or any."""
    return status.orderBy(*order).limit(rows) if order else status.limit(rows)


def transition_report(transitions: DataFrame, after: Column) -> DataFrame:
    """Changes after a date between levels of which at least one is numbered, present day left out."""
    change = F.col("recent_level_change")
    return transitions.where(
        (F.col("activity_date") > after) & ~change.contains("PresentDay") & change.contains("Level")
    )
