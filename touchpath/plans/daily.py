"""The daily refreshes: each reads input tables, writes result tables, and runs on its own.

Results go to ``Store.folder`` by table name. A refresh that needs another one's
result reads the written table, as in: lifecycle -> recommendations, personnel.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from touchpath.operators import cleaning, lifecycle, personnel, propensity, recommend, scores
from touchpath.operators.skew import Heavy, arrange, by_size, measure
from touchpath.settings import ModelSettings, Settings
from touchpath.sources import sinks
from touchpath.sources.tables import WEB_TRACKING_COLUMNS, project, read_table


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    folder: str
    settings: Settings
    database: str | None = None  # where tables stored by contact are listed; their files are in the folder as well
    buckets: int = 2_000  # of such a table

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def by_contact(self, name: str) -> bool:
        """Whether a table is stored in buckets by contact."""
        return self.database is not None and self.spark.catalog.tableExists(f"{self.database}.{name}")

    def read(self, name: str) -> DataFrame:
        if self.by_contact(name):
            return read_table(self.spark, f"{self.database}.{name}")
        return self.spark.read.parquet(self.path(name))

    def refresh(self, name: str, rows: DataFrame) -> DataFrame:
        """Replace a table and return it as written."""
        sinks.full_refresh(rows, self.path(name))
        return self.read(name)

    def refresh_by_contact(self, name: str, rows: DataFrame, heavy: Heavy | None) -> DataFrame:
        """Replace a table that others scan by contact, and return it as written.

        With a database it is stored in buckets by contact, so that later jobs start without an exchange. A heavy
        contact would make one bucket too large: such a table is stored as it comes, and spread when it is read.
        """
        if self.database is None:
            return self.refresh(name, rows)
        if heavy is not None:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.database}.{name}")  # the list entry; the files are replaced
            return self.refresh(name, rows)
        sinks.full_refresh_table(rows, f"{self.database}.{name}", self.buckets, self.path(name))
        return self.read(name)

    def heavy(self, log: DataFrame) -> Heavy | None:
        return measure(log, self.settings.rows_per_task)


def refresh_activity(store: Store, activity: DataFrame, fund_map: DataFrame) -> None:
    """The cleaned activity table."""
    build = partial(cleaning.clean_activity, fund_map=fund_map, settings=store.settings)
    rows = by_size([activity], store.heavy(activity), build)
    store.refresh("clean_activity", rows.drop("branch"))


def refresh_lifecycle(
    store: Store, activity: DataFrame, contact: DataFrame, rules: lifecycle.Rules = lifecycle.DECAYING
) -> None:
    """Every lifecycle row, the transitions, and today's status with its snapshot.

    The rows are computed once; the smaller tables are read off the written one,
    which therefore also keeps each row's place in the order.
    """

    def build(activity: DataFrame, contact: DataFrame, heavy: Heavy | None) -> DataFrame:
        rows = lifecycle.lifecycle_rows(activity, contact, rules, store.settings, heavy=heavy)
        return rows.select(*lifecycle.FULL_COLUMNS, "branch", "seq", "is_last")

    heavy = store.heavy(activity)
    rows = store.refresh_by_contact("lifecycle_full", by_size([activity, contact], heavy, build), heavy)
    store.refresh("lifecycle_transitions", lifecycle.transitions(rows))
    status = store.refresh("current_status", lifecycle.current_status(rows))
    sinks.dated_snapshot(status, store.path("lifecycle_snapshots"), store.settings.as_of)


def refresh_scores(
    store: Store,
    activity: DataFrame,
    contact: DataFrame,
    fund_map: DataFrame,
    model: ModelSettings,
    features: propensity.FeatureSet = propensity.SECOND_FEATURES,
) -> None:
    """Scores of all contacts and the weekly change report, each as latest file and snapshot."""
    settings, heavy = store.settings, store.heavy(activity)
    build = partial(propensity.feature_rows, fund_map=fund_map, features=features, settings=settings)
    # training, scoring and the report read one written table
    rows = store.refresh("propensity_features", by_size([activity], heavy, build))
    training = propensity.training_rows(rows, settings)
    fitted = propensity.fit(propensity.impute_medians(training, training), features, model)
    last = propensity.impute_medians(propensity.scoring_rows(rows), rows)
    scored = store.refresh("propensity_score", propensity.score(fitted, last, features))
    sinks.latest_csv(scored, store.path("propensity_score_csv"))
    sinks.dated_snapshot(scored, store.path("propensity_score_snapshots"), settings.as_of)
    report = scores.score_delta(
        scores.master_contacts(contact), scored, scores.activity_description(rows, settings)
    )
    sinks.dated_snapshot(report, store.path("score_delta_snapshots"), settings.as_of)


def refresh_score_timeline(store: Store, activity: DataFrame, history: DataFrame, fund_map: DataFrame) -> None:
    """Activities with their nearest score, and the latest events as CSV."""
    build = partial(scores.score_timeline, fund_map=fund_map, settings=store.settings)
    rows = by_size([activity, history], store.heavy(activity), build)
    timeline = store.refresh("score_timeline", rows)
    sinks.latest_csv(
        scores.latest_events(timeline, store.settings), store.path("latest_events_csv"), ["contact_id", "activity_date"]
    )


def refresh_recommendations(
    store: Store, activity: DataFrame, contact: DataFrame, catalog: DataFrame, web_tracking: DataFrame
) -> None:
    """Next steps with next content, the recommendation history, and what came of it."""
    settings = store.settings
    status = store.read("current_status")
    consumption = recommend.content_consumption(web_tracking, contact, catalog, settings)
    consumption = store.refresh("content_consumption", consumption)
    new = store.refresh("recommendation", recommend.recommendation(status, catalog, consumption, settings))

    build = partial(recommend.step_counts, settings=settings)
    counts = by_size([activity, contact], store.heavy(activity), build)
    steps = recommend.next_step(status, counts, settings)
    store.refresh("next_steps", recommend.next_step_final(steps, new))

    path = store.path("recommendation_history")
    old = sinks.read_appended(store.spark, path, settings.as_of, new.schema)
    sinks.append_history(recommend.new_recommendations(old, new), path, settings.as_of)
    history = sinks.read_appended(store.spark, path, settings.as_of + dt.timedelta(1), new.schema)
    store.refresh("recommendation_execution", recommend.recommendation_execution(history, consumption))


def outlook(store: Store, heavy: Heavy | None) -> DataFrame:
    """What follows each stored lifecycle row. Stored by contact, the rows are scanned where they are."""
    placed = store.by_contact("lifecycle_full")

    def build(rows: DataFrame, heavy: Heavy | None) -> DataFrame:
        return personnel.with_outlook(rows if placed and heavy is None else arrange(rows, heavy))

    return by_size([store.read("lifecycle_full")], heavy, build)


def refresh_personnel(
    store: Store,
    task: DataFrame,
    event: DataFrame,
    event_relation: DataFrame,
    user: DataFrame,
    territory: DataFrame,
    contact: DataFrame,
) -> None:
    """Personnel actions and whether they led to the next stage."""
    heavy = store.heavy(store.read("lifecycle_full"))
    actions = personnel.personnel_activity(
        task, event, event_relation, user, territory, contact, store.settings, heavy=heavy
    )
    store.refresh("personnel_outcome", personnel.personnel_outcome(actions, outlook(store, heavy)))


def refresh_web_tracking(store: Store, web_tracking: DataFrame) -> None:
    """Copy of the web-tracking columns in use."""
    store.refresh("web_tracking", project(web_tracking, WEB_TRACKING_COLUMNS))

