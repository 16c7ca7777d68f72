"""The daily refreshes write what the queries compute."""

import dataclasses
import glob

import compare
import pytest

import __spark_entry__ as entry
from touchpath.plans import daily
from touchpath.plans.registry import Inputs
from touchpath.settings import ModelSettings
from touchpath.sources import fixtures as fx

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module", params=[fx.SETTINGS.rows_per_task, 60], ids=["together", "spread"])
def store(spark, folder, request, tmp_path_factory):
    settings = dataclasses.replace(fx.SETTINGS, rows_per_task=request.param)
    store = daily.Store(spark, str(tmp_path_factory.mktemp("store")), settings)
    i = Inputs(spark, folder, settings)
    daily.refresh_lifecycle(store, i.activity, i.contact)
    for _ in range(2):  # a second run of the same day changes nothing
        daily.refresh_recommendations(store, i.activity, i.contact, i.content_catalog, i.web_tracking)
    daily.refresh_personnel(store, i.task, i.event, i.event_relation, i.user, i.territory, i.contact)
    daily.refresh_score_timeline(store, i.activity, i.score_history, i.fund_map)
    daily.refresh_web_tracking(store, i.web_tracking)
    return store


@pytest.mark.parametrize(
    "table, query",
    [
        ("lifecycle_transitions", "lifecycle_transitions"),
        ("current_status", "current_status"),
        ("content_consumption", "content_consumption"),
        ("recommendation", "recommendation"),
        ("next_steps", "next_step_final"),
        ("personnel_outcome", "personnel_outcome"),
        ("web_tracking", "web_tracking_projection"),
    ],
)
def test_tables(store, db, table, query):
    assert compare.difference(store.read(table), ORACLE[query], db) is None


def test_history_and_execution(store):
    history = store.read("recommendation_history")
    assert history.count() == history.select("contact_id", "sku_next_content").distinct().count()
    assert store.read("recommendation_execution").count() == history.count()
    assert glob.glob(store.path("lifecycle_snapshots") + "/snapshot_date=2001-11-04/*.csv")
    assert glob.glob(store.path("latest_events_csv") + "/*.csv")


def test_next_day_starts_from_history(store, spark, folder):
    import datetime as dt

    i = Inputs(spark, folder)
    tomorrow = dataclasses.replace(store.settings, as_of=store.settings.as_of + dt.timedelta(1), draw_seed="other")
    next_store = dataclasses.replace(store, settings=tomorrow)
    before = store.read("recommendation_history").where("snapshot_date = date '2001-11-04'").drop("snapshot_date")
    kept = set(map(tuple, before.collect()))
    daily.refresh_recommendations(next_store, i.activity, i.contact, i.content_catalog, i.web_tracking)
    # the day adds its own rows and leaves those of the day before where they are
    rows = store.read("recommendation_history")
    assert set(map(tuple, rows.where("snapshot_date = date '2001-11-04'").drop("snapshot_date").collect())) == kept
    added = set(map(tuple, rows.where("snapshot_date = date '2001-11-05'").drop("snapshot_date").collect()))
    assert added and not {row[::3] for row in added} & {row[::3] for row in kept}
    assert rows.count() == rows.select("contact_id", "sku_next_content").distinct().count()


def test_scores_and_report(spark, folder, tmp_path):
    store = daily.Store(spark, str(tmp_path), fx.SETTINGS)
    i = Inputs(spark, folder)
    daily.refresh_activity(store, i.full_activity, i.fund_map)
    daily.refresh_scores(
        store, i.full_activity, i.contact, i.fund_map, ModelSettings(rounds=2, step_size=0.1, max_depth=3)
    )
    assert store.read("clean_activity").count() == 4691
    assert store.read("propensity_score").count() == 135
    report = spark.read.option("header", True).option("multiLine", True).csv(store.path("score_delta_snapshots"))
    assert report.count() == 60


def test_lifecycle_stored_by_contact(spark, folder, db, tmp_path):
    i = Inputs(spark, folder)
    plain = daily.Store(spark, str(tmp_path), fx.SETTINGS)
    by_contact = dataclasses.replace(plain, database="default", buckets=4)
    spread = dataclasses.replace(by_contact, settings=dataclasses.replace(fx.SETTINGS, rows_per_task=60))
    # each run replaces what the one before has left, in either form
    for store, exchange in ((plain, True), (by_contact, False), (by_contact, False), (spread, True), (by_contact, False)):
        daily.refresh_lifecycle(store, i.activity, i.contact)
        plan = daily.outlook(store, None)._jdf.queryExecution().executedPlan().toString()
        assert ("Exchange" in plan) == exchange
        assert spark.catalog.tableExists("default.lifecycle_full") != exchange
        if store is not plain:
            daily.refresh_personnel(store, i.task, i.event, i.event_relation, i.user, i.territory, i.contact)
            assert compare.difference(store.read("personnel_outcome"), ORACLE["personnel_outcome"], db) is None
    spark.sql("DROP TABLE default.lifecycle_full")
