"""Scores, recommendations, personnel, features: hand-worked cases."""

import datetime as dt
import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from touchpath.operators import personnel, propensity, recommend, scores, timeline
from touchpath.settings import ModelSettings, Settings

D = dt.date
SETTINGS = Settings(as_of=D(2020, 12, 31))


# --- nearest score ------------------------------------------------------------


@pytest.mark.parametrize(
    "day, score",
    [(1, 0.1), (10, 0.1), (14, 0.1), (15, 0.1), (16, 0.2), (20, 0.2), (21, 0.3), (30, 0.3)],
)
def test_nearest_score(spark, day, score):
    history = spark.createDataFrame(
        [(1, D(2020, 1, 10), 0.1), (1, D(2020, 1, 20), 0.2), (1, D(2020, 1, 21), 0.3)],
        "contact_id int, process_date date, score double",
    )
    log = spark.createDataFrame(
        [(1, D(2020, 1, day), "a"), (2, D(2020, 1, day), "a")], "contact_id int, activity_date date, seq string"
    )
    found = {r.contact_id: r.score for r in scores.with_nearest_score(log, history).collect()}
    assert found == {1: score, 2: None}  # halfway goes to the earlier score


def test_nearest_missing_score_stays_missing(spark):
    history = spark.createDataFrame(
        [(1, D(2020, 1, 10), 0.1), (1, D(2020, 1, 20), None)], "contact_id int, process_date date, score double"
    )
    log = spark.createDataFrame([(1, D(2020, 1, 19), "a")], "contact_id int, activity_date date, seq string")
    assert scores.with_nearest_score(log, history).first().score is None


def test_latest_events_drop_unscored_after_counting(spark):
    rows = [(1, "A", "Call", D(2020, 1, 1) + dt.timedelta(n), 0.5 if n < 18 else None, f"{n}", f"{n:02d}") for n in range(20)]
    timeline = spark.createDataFrame(
        rows, "contact_id int, contact_name string, activity_type string, activity_date date, score double, event_id string, seq string"
    )
    assert scores.latest_events(timeline, SETTINGS).count() == 13


# --- recommendations ----------------------------------------------------------

CATALOG = [("a", "u/a", 0), ("b", "u/b", 1), ("c", "u/c", 1), ("d", "u/d", 1)]


def recommended(spark, seen, level="Level3", contacts=1, seed="123"):
    status = spark.createDataFrame(
        [(n, f"N{n}", level) for n in range(contacts)],
        "contact_id int, contact_name string, engagement_level string",
    )
    catalog = spark.createDataFrame(CATALOG, "event_name string, event_url string, level int")
    consumption = spark.createDataFrame(
        [(n, item) for n in range(contacts) for item in seen], "contact_id int, event_name string"
    )
    return recommend.recommendation(status, catalog, consumption, Settings(as_of=SETTINGS.as_of, draw_seed=seed))


@pytest.mark.parametrize(
    "seen, level, left",
    [
        ([], "Level3", {"b", "c", "d"}),
        (["b"], "Level3", {"c", "d"}),
        (["c"], "Advocate", {"b", "d"}),
        (["d", "b"], "Level1", {"c"}),
        (["a"], "Level1", {"b", "c", "d"}),
        ([], "Level0", {"a"}),
        (["b", "c", "d"], "Level0", {"a"}),
        (["a"], "Level0", {None}),
        (["b", "c", "d"], "Level2", {None}),
    ],
)
def test_draw_covers_exactly_what_is_left(spark, seen, level, left):
    drawn = recommended(spark, seen, level, contacts=60).collect()
    assert {row.sku_next_content for row in drawn} == left
    assert all(row.url_next_content == (row.sku_next_content and "u/" + row.sku_next_content) for row in drawn)


def test_present_day_contacts_get_nothing(spark):
    assert recommended(spark, [], "PresentDay").count() == 0


def test_consumption_takes_each_record_id_once_and_no_missing_ones(spark):
    short = "001A0000006Vm9r"
    visits = spark.createDataFrame(
        [(short, "a", D(2020, 1, 2)), (short, "a", D(2020, 1, 1)), (short + "IAC", "a", D(2019, 1, 1)), (None, "a", D(2020, 1, 1))]
        + [("001a0000006Vm9r", "a", D(2020, 1, 1)), (short, None, D(2020, 1, 1)), (short, "b", D(2020, 1, 1))],
        "contact_id_15 string, event_name string, event_ts date",
    ).selectExpr("*", "'1' AS session_key", f"'https://{SETTINGS.content_host}/x' AS event_url")
    people = spark.createDataFrame(
        [(1, "one", short + "IAC", "A"), (2, "two", None, "A"), (3, "three", short + "IAC", "A")],
        "contact_id int, contact_name string, record_id string, account_name string",
    )
    wanted = spark.createDataFrame([("a",), (None,)], "event_name string")
    found = recommend.content_consumption(visits, people, wanted, SETTINGS).collect()
    assert {(r.contact_id, r.event_name, r.activity_date) for r in found} == {(i, "a", D(2019, 1, 1)) for i in (1, 3)}
    assert len(found) == 2


HISTORY = (
    "contact_id int, contact_name string, engagement_level string, sku_next_content string, "
    "url_next_content string, recommendation_date date"
)


def test_history_keeps_the_old_row_and_a_second_run_changes_nothing(spark):
    old = spark.createDataFrame([(1, "A", "Level1", "x", "u/x", D(2020, 1, 1))], HISTORY)
    new = spark.createDataFrame(
        [(1, "A", "Level2", "x", "u/x", D(2020, 2, 1)), (1, "A", "Level2", "y", "u/y", D(2020, 2, 1))], HISTORY
    )
    once = recommend.recommendation_history(old, new)
    assert {(r.sku_next_content, r.recommendation_date) for r in once.collect()} == {
        ("x", D(2020, 1, 1)),
        ("y", D(2020, 2, 1)),
    }
    again = recommend.recommendation_history(once, new)
    assert sorted(again.collect()) == sorted(once.collect())


def test_next_steps_follow_the_level_order(spark):
    status = spark.createDataFrame(
        [(1, "A", "Level4"), (2, "B", "Advocate"), (3, "C", "Level1"), (4, "D", "Unknown"), (5, "E", "Level5")],
        "contact_id int, contact_name string, engagement_level string",
    )
    counts = spark.createDataFrame(
        [(1, 0, 1, 0, 0, 0), (2, 0, 0, 0, 0, 0), (3, 0, 0, 0, 0, 0), (4, 0, 0, 0, 0, 0)],
        "contact_id int, website int, webinar int, roadshow int, meeting int, edforum int",
    ).withColumn("contact_name", F.lit("n"))
    steps = {r.contact_id: r.next_step for r in recommend.next_step(status, counts, SETTINGS).collect()}
    # "Edforum" and "RoadShow" match no counter; contact 4's level has no list, contact 5 has no counts
    assert steps == {1: "Roadshow, Meeting, EdForum", 2: "Webinar, Meeting, Roadshow", 3: "Website, Webinar", 5: ""}


# --- personnel ----------------------------------------------------------------


def test_user_in_both_roles_counts_once(spark):
    user = spark.createDataFrame([(1, "U", "True"), (2, "V", "False")], "user_id int, user_name string, is_active string")
    territory = spark.createDataFrame(
        [("T", 1, 1), ("S", 2, 1), (None, 1, 1)], "territory_name string, internal_wholesaler int, sales_associate int"
    )
    served = personnel.user_territories(user, territory)
    assert sorted((r.personnel_name, r.territory_name) for r in served.collect()) == [("U", "S"), ("U", "T")]


@pytest.mark.parametrize(
    "kind, presentations, tickets, meetings, success",
    [
        ("VoiceMail", 1, 0, 0, 1), ("Outbound", 0, 1, 0, 1), ("Outbound", 0, 0, 1, 1), ("Outbound", 0, 0, 0, 0),
        ("Sales.Presentation", 1, 0, 0, 0), ("Sales.Presentation", 1, 0, 1, 1), ("Meeting", 1, 0, 1, 0),
        ("Meeting", 0, 1, 0, 1), ("Meeting", None, None, None, None), ("Call", None, None, None, 0),
    ],
)
def test_success(spark, kind, presentations, tickets, meetings, success):
    actions = spark.createDataFrame(
        [("U", "T", 1, "A", D(2020, 1, 1), kind)],
        "personnel_name string, territory_name string, contact_id int, contact_name string, activity_date date, activity_type string",
    )
    rows = [] if presentations is None else [(1, "A", D(2020, 1, 1), kind, "Level1", presentations, tickets, meetings)]
    outlook = spark.createDataFrame(
        rows,
        "contact_id int, contact_name string, activity_date date, activity_type string, prior_level string, "
        "sales_presentation_f int, tickets_f int, meeting_f int",
    )
    assert personnel.personnel_outcome(actions, outlook).first().success == success


# --- propensity ---------------------------------------------------------------


@pytest.mark.parametrize("seed", range(4))
def test_medians_are_exact(spark, seed):
    chance = random.Random(seed)
    size = (1, 2, 501, 4000)[seed]
    rows = [
        (
            chance.gauss(0, 1e6),
            float(chance.randrange(7)) if chance.random() < 0.7 else None,
            1e12 if chance.random() < 0.34 else chance.random(),
        )
        for _ in range(size)
    ]
    rows.append((None, 3.0, 0.5))
    medians = propensity.exact_medians(spark.createDataFrame(rows, "a double, b double, c double"), "abc").first()
    for place, name in enumerate("abc"):
        assert medians[name] == statistics.median(row[place] for row in rows if row[place] is not None)


def test_imputation_replaces_missing_and_non_positive(spark):
    rows = spark.createDataFrame(
        [(1, -4.0), (2, None), (3, 0.0), (4, 6.0), (5, 8.0), (6, float("nan"))], "k int, a double"
    )
    filled = propensity.impute_medians(rows, rows, ["a"])
    assert {r.k: r.a for r in filled.collect()} == {1: 3.0, 2: 3.0, 3: 3.0, 4: 6.0, 5: 8.0, 6: 3.0}


LOG = (
    "contact_id int, contact_name string, activity_type string, activity_date date, seq string, "
    "sales_amount decimal(18,2), fund_code string, additional_detail string, gdc double, aum double, "
    "x_to_advisory double, x_to_alternatives double, age double, advisor_type string"
)


def features_of(spark, activities):
    log = [
        (1, "A", kind, day, f"{n:03d}", amount and Decimal(amount), fund, None, 1.0, 1.0, 0.1, 0.1, 40.0, "Broker Dealer")
        for n, (kind, day, amount, fund) in enumerate(activities)
    ]
    fund_map = spark.createDataFrame([("F1", "FX"), ("F3", "FX")], "fund_code string, single_fund_code string")
    rows = propensity.feature_rows(
        spark.createDataFrame(log, LOG), fund_map, propensity.SECOND_FEATURES, SETTINGS
    )
    return rows.orderBy("activity_date", "branch", "seq").collect()


def test_label_looks_35_days_ahead_and_never_at_the_row_itself(spark):
    day = D(2020, 3, 1)
    rows = features_of(
        spark,
        [
            ("Call", day - dt.timedelta(36), None, ""),
            ("Call", day - dt.timedelta(35), None, ""),
            ("Sale", day, 10, "F1"),
        ],
    )
    assert [row.sale_in_35 for row in rows] == [0, 1, 0, 0]
    assert [row.days_till_last_sale for row in rows] == [-999, -999, -999, 305]
    assert [row.advisor_type for row in rows] == [1] * 4


def test_funds_are_counted_before_the_floor_and_trailing_sums_after_it(spark):
    rows = features_of(
        spark,
        [
            ("Sale", D(2013, 12, 30), 5, "F1"),
            ("Call", D(2014, 1, 1), None, "F2"),
            ("Sale", D(2014, 1, 2), 7, "F3"),
            ("Sale", D(2014, 1, 3), 9, ""),
        ],
    )
    assert [row.unique_funds_sale for row in rows] == [1, 1, 2, 2]  # F1 and F3 are one fund; '' counts when sold
    assert [row.unique_funds for row in rows] == [2, 2, 2, 2]
    assert [row.rt365 for row in rows] == [0, 7, 16, 0]
    assert [row.tickets90 for row in rows] == [0, 1, 2, 0]


def test_model_finds_a_planted_signal(spark):
    chance = random.Random(1)
    names = propensity.SECOND_FEATURES.columns
    rows = []
    for number in range(400):
        values = [chance.random() for _ in names]
        rows.append((number, f"N{number}", *values, int(values[0] + 0.2 * chance.random() > 0.6)))
    schema = "contact_id int, contact_name string, " + ", ".join(f"{n} double" for n in names) + ", sale_in_35 int"
    training = spark.createDataFrame(rows, schema)
    model = propensity.fit(training, propensity.SECOND_FEATURES, ModelSettings(rounds=3, step_size=0.3, max_depth=3))
    assert propensity.area_under_curve(model, training, propensity.SECOND_FEATURES) > 0.9
    assert training.count() == propensity.score(model, training, propensity.SECOND_FEATURES).count()


def test_steps_counted_along_the_timeline_are_those_of_its_last_row(spark):
    chance = random.Random(5)
    kinds = ("WebHit", "Marketing.Webinar", "Assisted.Roadshow", "Meeting", "EdForum", "Call", None)
    log = [
        (n % 7, f"N{n % 7}", chance.choice(kinds), D(2019, 1, 1) + dt.timedelta(chance.randrange(730)), f"{n:04}", None, None, None)
        for n in range(400)
    ]
    activity = spark.createDataFrame(
        log,
        "contact_id int, contact_name string, activity_type string, activity_date date, seq string, "
        "sales_amount decimal(18,2), additional_detail string, link string",
    )
    contact = spark.createDataFrame(
        [(n, f"N{n}", D(2018, 1, 1)) for n in range(9)], "contact_id int, contact_name string, created_date date"
    )
    rows = recommend.with_step_counts(timeline.timeline_rows(activity, contact, SETTINGS, None))
    last = timeline.first_last_flags(rows).where("is_last").select("contact_id", "contact_name", *recommend.STEP_COLUMNS)
    counts = recommend.step_counts(activity, contact, SETTINGS)
    assert last.schema.simpleString() == counts.select(*last.columns).schema.simpleString()
    assert sorted(last.collect()) == sorted(counts.select(*last.columns).collect())
