import datetime as dt
import glob

from pyspark.sql import functions as F

from touchpath import schemas
from touchpath.sources import sinks, tables

D = dt.date


def test_csv_keeps_text(spark, tmp_path):
    (tmp_path / "content.csv").write_text("event_name,event_url,level\n007,https://e/1,0\nbrexit,https://e/2,1\n")
    rows = tables.read_csv(spark, str(tmp_path / "content.csv"), schemas.CONTENT_CATALOG).collect()
    assert [tuple(r) for r in rows] == [("007", "https://e/1", 0), ("brexit", "https://e/2", 1)]


def test_full_refresh_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.full_refresh(spark.range(5), path)
    sinks.full_refresh(spark.range(2), path)
    assert tables.read_parquet(spark, path).count() == 2


def test_snapshots_replace_their_own_day_only(spark, tmp_path):
    path = str(tmp_path / "s")
    sinks.dated_snapshot(spark.range(3), path, D(2020, 1, 1))
    sinks.dated_snapshot(spark.range(4), path, D(2020, 1, 2))
    sinks.dated_snapshot(spark.range(1), path, D(2020, 1, 2))
    counts = spark.read.option("header", True).csv(path).groupBy("snapshot_date").count().collect()
    assert sorted((str(r.snapshot_date), r["count"]) for r in counts) == [("2020-01-01", 3), ("2020-01-02", 1)]


def test_latest_csv_has_a_header_and_order(spark, tmp_path):
    path = str(tmp_path / "c")
    sinks.latest_csv(spark.range(3).selectExpr("3 - id AS id"), path, order=["id"])
    text = "".join(open(name).read() for name in sorted(glob.glob(path + "/*.csv")))
    assert text.replace("id\n", "") == "1\n2\n3\n" and text.startswith("id\n")


def test_history_is_read_from_the_past_and_a_run_can_be_repeated(spark, tmp_path):
    path, schema = str(tmp_path / "h"), spark.range(1).schema
    assert sinks.read_history(spark, path, D(2020, 1, 1), schema).count() == 0
    sinks.write_history(spark.range(1), path, D(2020, 1, 1))
    for _ in range(2):
        old = sinks.read_history(spark, path, D(2020, 1, 2), schema)
        sinks.write_history(old.union(spark.range(10, 12)), path, D(2020, 1, 2))
    assert sinks.read_history(spark, path, D(2020, 1, 3), schema).count() == 3
    assert sinks.read_history(spark, path, D(2020, 1, 2), schema).count() == 1
    assert sinks.read_history(spark, path, D(2020, 1, 1), schema).count() == 0
    assert sinks.read_snapshot(spark, path, D(2020, 1, 2), schema).count() == 3


def test_projection_reads_only_its_columns(spark, folder):
    from touchpath.sources import fixtures

    frame = tables.project(fixtures.web_tracking(spark, folder), tables.WEB_TRACKING_COLUMNS)
    assert len(frame.columns) == 8
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "event_type" not in plan and "value" not in plan


def test_a_table_stored_by_contact_is_scanned_without_a_shuffle(spark, folder, tmp_path):
    from touchpath.functions import scans
    from touchpath.operators.skew import arrange
    from touchpath.sources import fixtures

    log = fixtures.dense_events(spark, folder)
    sinks.full_refresh_table(log, "stored_log", buckets=8, path=str(tmp_path / "stored_log"))
    stored = tables.read_table(spark, "stored_log")
    rows = scans.with_scans(arrange(stored, None), {"n": scans.sum_within(F.lit(1), 7)})
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.count() == log.count()
    spark.sql("DROP TABLE stored_log")


def test_an_appended_history_grows_by_its_own_rows(spark, tmp_path):
    path, schema = str(tmp_path / "a"), spark.range(1).schema
    assert sinks.newest_day(spark, path) is None
    assert sinks.read_appended(spark, path, D(2020, 1, 9), schema).count() == 0
    sinks.append_history(spark.range(3), path, D(2020, 1, 1))
    first = {name: open(name, "rb").read() for name in glob.glob(f"{path}/snapshot_date=2020-01-01/*.parquet")}
    for end in (12, 14):  # the second day is run again and has more rows
        sinks.append_history(spark.range(10, end), path, D(2020, 1, 2))
    assert sinks.newest_day(spark, path) == D(2020, 1, 2)
    ids = [row.id for row in sinks.read_appended(spark, path, D(2020, 1, 3), schema).collect()]
    assert sorted(ids) == [0, 1, 2, 10, 11, 12, 13]
    assert sinks.read_appended(spark, path, D(2020, 1, 2), schema).count() == 3
    # rows of a run that did not reach its pointer do not count
    spark.range(100, 101).write.parquet(f"{path}/snapshot_date=2020-01-03")
    assert sinks.read_appended(spark, path, D(2020, 1, 9), schema).count() == 7
    assert all(open(name, "rb").read() == contents for name, contents in first.items())


def test_a_day_without_new_rows_is_a_day(spark, tmp_path):
    path, schema = str(tmp_path / "e"), spark.range(1).schema
    sinks.append_history(spark.range(2), path, D(2020, 1, 1))
    sinks.append_history(spark.range(0), path, D(2020, 1, 1))
    assert sinks.newest_day(spark, path) == D(2020, 1, 1)
    assert sinks.read_appended(spark, path, D(2020, 1, 2), schema).count() == 0


def test_empty_and_missing_text_survive_a_csv_export(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "", None), (2, None, 0.5), (3, 'a "b", c', None)], "k int, a string, b double")
    sinks.latest_csv(rows, path)
    assert sorted(map(tuple, tables.read_csv(spark, path, rows.schema).collect())) == sorted(map(tuple, rows.collect()))
