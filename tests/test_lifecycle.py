"""Hand-worked timelines."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from touchpath.operators import lifecycle, timeline
from touchpath.settings import LEVELS, Settings

D = dt.date
SETTINGS = Settings(as_of=D(2020, 12, 31))
ACTIVITY = (
    "contact_id int, contact_name string, activity_type string, activity_date date, seq string, "
    "sales_amount decimal(18,2), additional_detail string, link string"
)
CONTACT = (
    "contact_id int, contact_name string, created_date date, contact_type string, first_sale_date_all date, "
    "first_sale_date_new date"
)


def lifecycle_of(spark, activities, first_sale=None, created=D(2019, 12, 1), rules=lifecycle.DECAYING):
    """Rows (date, label, level, change, spell) of one contact; activities are (type, date, amount, detail, link)."""
    log = [
        (1, "Ann", kind, day, f"{n:03d}", amount, detail, link)
        for n, (kind, day, amount, detail, link) in enumerate(
            (tuple(a) + (None,) * (5 - len(a)) for a in activities)
        )
    ]
    contact = [(1, "Ann", created, "T", first_sale, first_sale)]
    return [
        (r.activity_date, r.activity_type, r.level, r.recent_level_change, r.duration_last_level, r.full_level_cycle)
        for r in lifecycle.lifecycle_rows(
            spark.createDataFrame(log, ACTIVITY), spark.createDataFrame(contact, CONTACT), rules, SETTINGS
        )
        .orderBy("activity_date", "branch", "seq")
        .collect()
    ]


def levels(*args, **kwargs):
    return [row[2] for row in lifecycle_of(*args, **kwargs)]


def test_levels_rise_decay_and_end_at_the_present(spark):
    rows = lifecycle_of(
        spark,
        [("Call", D(2020, 1, 1)), ("Outbound", D(2020, 2, 1)), ("Meeting", D(2020, 3, 1)), ("Email", D(2020, 5, 31))],
    )
    assert rows == [
        (D(2019, 12, 1), "JourneyBegins", "Level0", None, None, "Level0"),
        (D(2020, 1, 1), "Call", "Level1", "Level0-->Level1", 31, "Level0-->Level1"),
        (D(2020, 2, 1), "Outbound", "Level2", "Level1-->Level2", 31, "Level0-->Level1-->Level2"),
        (D(2020, 3, 1), "Meeting", "Level5", "Level2-->Level5", 29, "Level0-->Level1-->Level2-->Level5"),
        # 91 days after the meeting and 120 after the call out
        (D(2020, 5, 31), "Email", "Level1", "Level5-->Level1", 91, "Level0-->Level1-->Level2-->Level5"),
        (
            D(2020, 12, 31), "Present", "PresentDay", "Level1-->PresentDay", 214,
            "Level0-->Level1-->Level2-->Level5-->PresentDay",
        ),
    ]


def test_window_ends_are_closed(spark):
    def at(kind, days, detail=None):
        return levels(spark, [(kind, D(2020, 1, 1), None, detail), ("Email", D(2020, 1, 1) + dt.timedelta(days))])[2]

    assert (at("Meeting", 90), at("Meeting", 91)) == ("Level5", "Level1")
    assert (at("EdForum", 180), at("EdForum", 181)) == ("Level5", "Level1")
    assert (at("Investor University", 180), at("Investor University", 181)) == ("Level4", "Level1")
    assert (at("Marketing Webinar", 60), at("Marketing Webinar", 61)) == ("Level3", "Level1")
    assert (at("Outbound", 90), at("Outbound", 91)) == ("Level2", "Level1")
    assert (at("Email", 35, "webinars"), at("Email", 36, "webinars")) == ("Level2", "Level0")
    assert (at("LitOrder", 60, "KIT"), at("LitOrder", 61, "KIT")) == ("Level5", "Level1")


def test_lasting_levels_do_not_decay(spark):
    meeting = [("Meeting", D(2013, 1, 1)), ("Email", D(2020, 1, 1))]
    assert levels(spark, meeting, rules=lifecycle.LASTING, created=D(2012, 1, 1))[2] == "Level5"
    assert levels(spark, meeting, created=D(2012, 1, 1))[2] == "Level1"


def test_links_count_only_under_decaying_rules(spark):
    visit = [("Email", D(2020, 1, 1), None, None, "https://www.example.com/learn/x"), ("Email", D(2020, 1, 5))]
    assert levels(spark, visit)[1] == "Level2"
    assert levels(spark, visit, rules=lifecycle.LASTING)[1] == "Level0"


@pytest.mark.parametrize(
    "days, amount, level",
    [
        (180, 150_000, "New Producer"),
        (180, 150_000.01, "Rising Star"),
        (181, 350_000, "Developing Producer"),
        (181, 350_000.01, "Core Producer"),
        (600, 1_000_001, "Core Producer"),
        (601, 1_000_000, "Core Producer"),
        (601, 1_000_000.01, "Advocate"),
    ],
)
def test_producer_thresholds(spark, days, amount, level):
    first_sale = D(2020, 6, 1) - dt.timedelta(days)
    rows = levels(
        spark, [("Sale", D(2020, 6, 1), Decimal(str(amount)))], first_sale=first_sale, created=D(2015, 1, 1)
    )
    assert rows[1] == level
    assert levels(spark, [("Sale", D(2020, 6, 1), Decimal(str(amount)))], created=D(2015, 1, 1))[1] == "Level0"


def test_idle_contact(spark):
    rows = lifecycle_of(spark, [])
    assert [row[:3] for row in rows] == [
        (D(2019, 12, 1), "JourneyBegins", "Level0"),
        (D(2020, 12, 31), "Present", "PresentDay"),
    ]


def test_contact_created_today_has_one_row(spark):
    rows = lifecycle_of(spark, [], created=SETTINGS.as_of)
    assert rows == [(D(2020, 12, 31), "JourneyBegins", "PresentDay", None, None, "PresentDay")]


def test_only_excluded_activities_leave_a_journey_start(spark):
    rows = lifecycle_of(spark, [("To-Do", D(2019, 1, 1))])
    assert rows == [(D(2019, 1, 1), "JourneyBegins", "PresentDay", None, None, "PresentDay")]


def test_activities_after_today_take_the_present_label(spark):
    rows = lifecycle_of(spark, [("Call", D(2020, 1, 1)), ("Call", D(2021, 2, 1))])
    assert [row[1:3] for row in rows[-2:]] == [("Nothing", "Level1"), ("Present", "PresentDay")]


def test_same_day_repeats_drop_before_sales_add_up(spark):
    log = [(1, "Ann", "Sale", D(2020, 1, 1), f"{n}", Decimal(100), None, None) for n in range(2)]
    contact = spark.createDataFrame([(1, "Ann", D(2019, 1, 1), "T", None, None)], CONTACT)
    rows = lifecycle.leveled_rows(
        spark.createDataFrame(log, ACTIVITY), contact, lifecycle.DECAYING, SETTINGS
    )
    assert rows.agg(F.max("sales")).first()[0] == 100


def test_properties_of_the_whole_log(spark, folder):
    from touchpath.plans.registry import Inputs

    rows = Inputs(spark, folder).lifecycle(lambda rows: rows).cache()
    contacts = rows.select("contact_id").distinct().count()
    assert rows.where("level = 'PresentDay'").count() == contacts
    parts = F.split("full_level_cycle", "-->")
    assert rows.where(F.size(parts) != F.size(F.array_distinct(parts))).count() == 0
    spells = rows.groupBy("contact_id").agg(
        F.coalesce(F.sum("duration_last_level"), F.lit(0)).alias("total"),
        F.date_diff(
            F.coalesce(F.max(F.when(F.col("recent_level_change").isNotNull(), F.col("activity_date"))), F.min("activity_date")),
            F.min("activity_date"),
        ).alias("span"),
    )
    assert spells.where("total <> span").count() == 0
    assert {row.level for row in rows.select("level").distinct().collect()} == set(LEVELS)
    rows.unpersist()


def test_rejected_rows_are_kept_aside(spark):
    from touchpath.operators import cleaning

    log = spark.createDataFrame(
        [(1, "A", "Call", None, "1", None, None, None), (None, None, "Fax", D(2020, 1, 1), "2", None, None, None)],
        ACTIVITY,
    )
    assert cleaning.accepted(log).count() == 0 and cleaning.rejected(log).count() == 2
    assert [tuple(r) for r in cleaning.unmapped_types(log, SETTINGS).collect()] == [("Fax", 1)]
    assert timeline.journey_start(log, spark.createDataFrame([], CONTACT)).count() == 0
