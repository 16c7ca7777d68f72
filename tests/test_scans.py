"""Scans against brute force, in one task and spread over cells."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from touchpath.functions import scans as s
from touchpath.operators import skew
from touchpath.operators.skew import Heavy, arrange, by_size, measure

DAY0 = dt.date(2020, 1, 1)
SCHEMA = "contact_id int, activity_date date, branch int, seq string, x int, k int, v string"


def make_log(seed, contacts=4, rows=60, days=25):
    """Random logs with many rows per day."""
    chance = random.Random(seed)
    log = []
    for contact in range(contacts):
        for number in range(rows):
            log.append(
                (
                    contact,
                    DAY0 + dt.timedelta(days=chance.randrange(days)),
                    chance.choice((0, 1, 1, 1, 2)),
                    f"{number:04d}",
                    chance.randrange(5),
                    1 << chance.randrange(6),
                    chance.choice((None, None, "a", "b", "c")),
                )
            )
    return log




def scans():
    return {
        "total": s.running_sum(F.col("x")),
        "in_3": s.sum_within(F.col("x"), 3),
        "in_0": s.sum_within(F.lit(1), 0),
        "next_4": s.sum_ahead(F.col("x"), 4),
        "prior": s.previous(F.col("v")),
        "known": s.last_before(F.col("v")),
        "latest": s.last_upto(F.col("v")),
        "met": s.bits_before(F.col("k")),
        "listed": s.list_upto(F.col("v")),
        "is_first": s.is_first(),
        "is_last": s.is_last(),
    }


def brute_force(log):
    results = {}
    for contact in {row[0] for row in log}:
        rows = sorted((row for row in log if row[0] == contact), key=lambda row: row[1:4])
        for j, row in enumerate(rows):
            past, ahead = rows[: j + 1], rows[j:]
            before = [r[6] for r in rows[:j] if r[6] is not None]
            upto = [r[6] for r in past if r[6] is not None]
            met = 0
            for r in rows[:j]:
                met |= r[5]
            results[(contact, row[3])] = (
                sum(r[4] for r in past),
                sum(r[4] for r in past if (row[1] - r[1]).days <= 3),
                sum(1 for r in past if r[1] == row[1]),
                sum(r[4] for r in ahead if (r[1] - row[1]).days <= 4),
                rows[j - 1][6] if j else None,
                before[-1] if before else None,
                upto[-1] if upto else None,
                met,
                tuple(upto),
                j == 0,
                j == len(rows) - 1,
            )
    return results


def collected(frame):
    names = list(scans())
    return {
        (row.contact_id, row.seq): tuple(tuple(row[n]) if n == "listed" else row[n] for n in names)
        for row in frame.collect()
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_in_one_task(spark, seed):
    log = make_log(seed)
    frame = s.with_scans(arrange(spark.createDataFrame(log, SCHEMA), None), scans())
    assert collected(frame) == brute_force(log)


@pytest.mark.parametrize("tasks", [2, 7, 40])
def test_spread(spark, tasks):
    log = make_log(tasks)
    frame = spark.createDataFrame(log, SCHEMA)
    heavy = Heavy(frame.select("contact_id").distinct(), len(log), max(1, len(log) // tasks))
    spread = arrange(frame, heavy)
    assert spread.select("chunk").distinct().count() > 1
    assert collected(s.with_scans(spread, scans())) == brute_force(log)


def test_one_contact_with_a_third_of_all_rows(spark):
    """The heavy contact goes to many tasks, also when all its rows fall on one day."""
    log = make_log(3, contacts=20, rows=20)
    log += [(99, DAY0, 1, f"{n:04d}", 1, 1, None) for n in range(200)]
    frame = spark.createDataFrame(log, SCHEMA)
    heavy = measure(frame, rows_per_task=50)
    assert [row.contact_id for row in heavy.contacts.collect()] == [99] and heavy.tasks == 4
    largest = arrange(frame.where("contact_id = 99"), heavy).groupBy("chunk").count().agg(F.max("count")).first()[0]
    assert largest < 120
    result = by_size([frame], heavy, lambda rows, heavy: s.with_scans(arrange(rows, heavy), scans()))
    assert collected(result) == brute_force(log)


def test_no_heavy_contact_is_measured_as_none(spark):
    assert measure(spark.createDataFrame(make_log(4), SCHEMA), rows_per_task=1000) is None
    assert measure(spark.createDataFrame([], SCHEMA), rows_per_task=1000) is None


def test_boundary_is_closed(spark):
    log = [(1, DAY0, 1, "a", 5, 1, None), (1, DAY0 + dt.timedelta(days=3), 1, "b", 7, 1, None)]
    frame = arrange(spark.createDataFrame(log, SCHEMA), None)
    wanted = {"in_3": s.sum_within(F.col("x"), 3), "in_2": s.sum_within(F.col("x"), 2)}
    rows = {row.seq: (row.in_3, row.in_2) for row in s.with_scans(frame, wanted).collect()}
    assert rows == {"a": (5, 5), "b": (12, 7)}


def test_result_ignores_input_order_and_partitions(spark):
    log = make_log(5)
    expected = brute_force(log)
    random.Random(0).shuffle(log)
    frame = spark.createDataFrame(log, SCHEMA).repartition(13)
    assert collected(s.with_scans(arrange(frame, None), scans())) == expected


def test_ahead_is_trailing_with_time_reversed(spark):
    log = make_log(6)
    mirrored = [(c, DAY0 - (d - DAY0), -b, f"{9999 - int(q):04d}", x, k, v) for c, d, b, q, x, k, v in log]
    ahead = s.with_scans(arrange(spark.createDataFrame(log, SCHEMA), None), {"n": s.sum_ahead(F.col("x"), 5)})
    back = s.with_scans(arrange(spark.createDataFrame(mirrored, SCHEMA), None), {"n": s.sum_within(F.col("x"), 5)})
    assert {(r.contact_id, int(r.seq)): r.n for r in ahead.collect()} == {
        (r.contact_id, 9999 - int(r.seq)): r.n for r in back.collect()
    }


def test_a_log_of_known_size_is_dealt_over_as_many_tasks_as_its_rows_need(spark, monkeypatch):
    monkeypatch.setattr(skew, "DEALT_ROWS", 10)
    log = make_log(5)
    frame = spark.createDataFrame(log, SCHEMA)
    dealt = arrange(frame, None, log_rows=20 * 10)
    assert dealt.rdd.getNumPartitions() == 20
    assert collected(s.with_scans(dealt, scans())) == collected(s.with_scans(arrange(frame, None), scans()))


@pytest.mark.parametrize("tasks", [None, 2, 40])
def test_last_rows_of_days(spark, tasks):
    log = make_log(3)
    rows = spark.createDataFrame(log, SCHEMA)
    heavy = Heavy(rows.select("contact_id").distinct(), len(log), len(log) // tasks) if tasks else None
    found = s.with_scans(arrange(rows, heavy), {"ends": s.is_last_of_day()}).where("ends").collect()
    last = {}
    for row in sorted(log, key=lambda row: row[:4]):
        last[row[:2]] = row
    assert {tuple(row)[: len(log[0])] for row in found} == set(last.values()) and len(found) == len(last)


def test_a_value_summed_over_several_spans_is_summed_so_far_once(spark):
    rows, x = spark.createDataFrame(make_log(4), SCHEMA), F.col("x")
    frame = s.with_scans(rows, {"a": s.sum_within(x, 1), "b": s.sum_within(x, 5), "c": s.sum_ahead(x, 2)})
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    # so far, 1 and 5 days back, 2 days ahead, and before the row
    assert plan.count("sum(_x_a#") == 5
    apart = s.with_scans(rows, {"a": s.sum_within(F.col("x"), 1), "b": s.sum_within(F.col("x"), 5), "c": s.sum_ahead(F.col("x"), 2)})
    assert frame.dtypes == apart.dtypes and sorted(frame.collect(), key=str) == sorted(apart.collect(), key=str)
