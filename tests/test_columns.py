import datetime as dt

import pytest
from pyspark.sql import functions as F

from touchpath.functions import columns as c

D = dt.date


def one(spark, column, schema="x int", row=(0,)):
    return spark.createDataFrame([row], schema).select(column.alias("y")).first().y


@pytest.mark.parametrize(
    "short, long",
    [
        ("001A0000006Vm9r", "001A0000006Vm9rIAC"),
        ("aaaaaaaaaaaaaaa", "aaaaaaaaaaaaaaaAAA"),
        ("AAAAAAAAAAAAAAA", "AAAAAAAAAAAAAAA555"),
        ("001A0000006Vm9rIAC", "001A0000006Vm9rIAC"),
        ("ÀBCé5ZZZZZ😀a-_Ä", "ÀBCé5ZZZZZ😀a-_ÄG5A"),
        (None, None),
    ],
)
def test_record_id(spark, short, long):
    assert one(spark, c.record_id_18(F.col("x")), "x string", (short,)) == long


@pytest.mark.parametrize(
    "activity, created, begin",
    [
        (D(2020, 1, 1), D(2020, 2, 1), D(2020, 1, 1)),
        (D(2020, 3, 1), D(2020, 2, 1), D(2020, 2, 1)),
        (D(2020, 2, 1), D(2020, 2, 1), D(2020, 2, 1)),
        (None, D(2020, 2, 1), D(2020, 2, 1)),
        (D(2020, 3, 1), None, None),
    ],
)
def test_journey_begin(spark, activity, created, begin):
    assert one(spark, c.journey_begin(F.col("a"), F.col("b")), "a date, b date", (activity, created)) == begin


def test_percent_change(spark):
    def change(score, old):
        return one(spark, c.percent_change(F.col("s"), F.col("o")), "s double, o double", (score, old))

    assert change(0.6, 50.0) == pytest.approx(0.2)
    assert change(0.6, 0.0) is None and change(0.6, None) is None and change(None, 50.0) is None


def test_description_line(spark):
    line = c.described(F.lit("Seminar"), F.lit(D(2020, 1, 2)), F.col("x"))
    assert one(spark, line, "x string", (None,)) == "{ Seminar               2020-01-02      NA }"
    long = c.described(F.lit("A" * 25), F.lit(D(2020, 1, 2)), F.lit("d"))
    assert one(spark, long) == "{ " + "A" * 25 + " 2020-01-02      d }"


def test_pattern_dots_match_any_character_and_null_does_not(spark):
    match = c.matches(F.col("x"), "www.example.com/learn")
    assert one(spark, match, "x string", ("https://wwwXexample.com/learn/a",)) is True
    assert one(spark, match, "x string", (None,)) is False


def test_unknown_type_stays(spark):
    clean = c.clean_type(F.col("x"), {"Admin Call": "Admin.Call"})
    assert one(spark, clean, "x string", ("Admin Call",)) == "Admin.Call"
    assert one(spark, clean, "x string", ("Fax",)) == "Fax"
    assert one(spark, clean, "x string", (None,)) is None


def test_draw_is_reproducible(spark):
    draws = [one(spark, c.draw("1", F.lit(key))) for key in range(50)]
    assert draws == [one(spark, c.draw("1", F.lit(key))) for key in range(50)]
    assert min(draws) >= 0 and len({draw % 5 for draw in draws}) == 5
