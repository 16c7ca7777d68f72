"""Every registered query against its SQL twin."""

import dataclasses

import compare
import duckdb
import pytest

import __spark_entry__ as entry
from touchpath.plans import oracle, registry
from touchpath.sources import fixtures as fx

ORACLE = oracle.oracle_sql()


def test_only_the_model_lacks_a_twin():
    trained = {"propensity_score", "propensity_score_10_rounds", "propensity_score_v1_10_rounds"}
    assert set(registry.queries()) - set(ORACLE) == trained
    assert set(ORACLE) <= set(registry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, folder, db, name):
    frame = entry.queries()[name](spark, folder)
    assert compare.type_differences(frame, db.sql(ORACLE[name])) == []
    assert compare.difference(frame, ORACLE[name], db) is None


# with this limit the busiest contacts are spread over tasks
SPREAD = (
    "activity_clean",
    "activity_timeline",
    "last_activity_date",
    "trailing_counts",
    "trailing_sums",
    "forward_counts",
    "unique_funds_running",
    "engagement_level_v1",
    "lifecycle_full",
    "propensity_features",
    "propensity_features_v1",
    "activity_description",
    "propensity_scoring_input",
    "median_impute",
    "score_nearest",
    "latest_events_topk",
    "step_counts",
    "personnel_outcome",
)


@pytest.fixture(scope="module")
def skewed(folder, tmp_path_factory):
    """The given tables with a third of all orders and events moved to contact 7."""
    copy = tmp_path_factory.mktemp("skewed")
    moved = {
        "orders": "* REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey)",
        "events": "* REPLACE (CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id)",
    }
    for table in compare.TABLES:
        duckdb.sql(
            f"COPY (SELECT {moved.get(table, '*')} FROM '{folder}/{table}.parquet') TO '{copy}/{table}.parquet'"
        )
    return str(copy)


@pytest.mark.parametrize("name", SPREAD)
def test_spread_contacts_match_sql(spark, skewed, name):
    inputs = registry.Inputs(spark, skewed, dataclasses.replace(fx.SETTINGS, rows_per_task=100))
    assert 7 in {row.contact_id for row in inputs.heavy.contacts.collect()} and inputs.heavy.tasks > 15
    frame = getattr(registry, name)(inputs)
    plain = getattr(registry, name)(registry.Inputs(spark, skewed, fx.SETTINGS))
    assert dict(frame.dtypes) == dict(plain.dtypes)
    assert compare.difference(frame, ORACLE[name], compare.connect(skewed)) is None


@pytest.mark.parametrize(
    "name", ["personnel_task_territory", "personnel_activity", "fund_normalised", "content_consumption", "recommendation"]
)
def test_results_without_small_sides(spark, folder, db, monkeypatch, name):
    """As if users, funds and the catalog were large: ten owners hold all meetings."""
    from touchpath.operators import skew

    monkeypatch.setattr(skew, "SMALL_ROWS", 0)
    frame = getattr(registry, name)(registry.Inputs(spark, folder))
    assert compare.difference(frame, ORACLE[name], db) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 150


def test_scores_are_probabilities(spark, folder):
    scores = [row.prediction for row in entry.queries()["propensity_score"](spark, folder).collect()]
    assert len(scores) == 135 and all(0 <= score <= 1 for score in scores)
