"""Untrusted text: every form by hand."""

import datetime as dt

import pytest

from touchpath.operators import triage
from touchpath.settings import Settings

SETTINGS = Settings(as_of=dt.date(2020, 12, 31))
RAW = "contact_text string, type_text string, date_text string, note string"


def one(spark, contact="7", kind="Call", day="2020-02-29", **options):
    rows = spark.createDataFrame([(contact, kind, day, "n")], RAW)
    return triage.triaged(rows, SETTINGS, **options).first()


@pytest.mark.parametrize(
    "text, day",
    [
        ("2020-02-29", dt.date(2020, 2, 29)), (" 2020-02-29 ", dt.date(2020, 2, 29)), ("2020-02-29 23:59:59", dt.date(2020, 2, 29)),
        ("2020-02-29T01:02:03Z", dt.date(2020, 2, 29)), ("02/29/2020", dt.date(2020, 2, 29)), ("20200229", dt.date(2020, 2, 29)),
        ("2019-02-29", None), ("29/02/2020", None), ("2020-2-9", None), ("soon", None), ("2020-02-29x", None),
    ],
)
def test_dates(spark, text, day):
    found = one(spark, day=text)
    assert found.activity_date == day and found.reason == (None if day else triage.BAD_DATE)


@pytest.mark.parametrize(
    "text, kind, reason",
    [
        ("Assisted Roadshow", "Assisted Roadshow", None), ("ASSISTED roadshow", "Assisted Roadshow", None),
        (" Assisted.Roadshow", "Assisted Roadshow", None), ("assisted_road-show", None, triage.UNKNOWN_TYPE),
        ("Voicemail", "Voicemail", None), ("VoiceMail", "VoiceMail", None), ("VOICEMAIL", None, triage.AMBIGUOUS_TYPE),
        ("to-do", "To-Do", None), (None, None, None), ("", None, triage.UNKNOWN_TYPE), ("Dance", None, triage.UNKNOWN_TYPE),
    ],
)
def test_types(spark, text, kind, reason):
    found = one(spark, kind=text)
    assert (found.activity_type, found.reason) == (kind, reason)


@pytest.mark.parametrize(
    "text, contact, reason",
    [
        ("7", 7, None), (" 7 ", 7, None), ("", None, triage.NO_CONTACT), (None, None, triage.NO_CONTACT),
        ("-7", None, triage.BAD_CONTACT), ("7.5", None, triage.BAD_CONTACT), ("9" * 30, None, triage.BAD_CONTACT),
    ],
)
def test_contacts(spark, text, contact, reason):
    found = one(spark, contact=text)
    assert (found.contact_id, found.reason) == (contact, reason)


def test_the_first_reason_is_given_and_the_future_is_an_option(spark):
    assert one(spark, "", "Dance", "soon").reason == triage.NO_CONTACT
    assert one(spark, day="").reason == triage.NO_DATE
    assert one(spark, day="2021-01-01").reason is None
    assert one(spark, day="2021-01-01", future=False).reason == triage.FUTURE


def test_both_channels_hold_every_row_once(spark):
    rows = spark.createDataFrame([("7", "Call", "2020-01-01", "a"), ("7", "Dance", "2020-01-01", "b"), (None,) * 4], RAW)
    found = triage.triaged(rows, SETTINGS)
    assert [tuple(row) for row in triage.trusted(found).collect()] == [("a", 7, "Call", dt.date(2020, 1, 1))]
    assert sorted(map(str, (row.note for row in triage.rejects(found).collect()))) == ["None", "b"]
    assert {row.reason: row.n for row in triage.reasons(found).collect()} == {triage.UNKNOWN_TYPE: 1, triage.NO_CONTACT: 1}


def test_a_date_is_parsed_once_per_row(spark, tmp_path):
    spark.createDataFrame([("7", "Call", "soon", "n")], RAW).write.parquet(str(tmp_path / "raw"))
    rows = triage.rejects(triage.triaged(spark.read.parquet(str(tmp_path / "raw")), SETTINGS))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("gettimestamp") == len(triage.DATE_FORMS)
    assert [row.reason for row in rows.collect()] == [triage.BAD_DATE]


@pytest.mark.parametrize(
    "text, day",
    [
        ("20200230", None), ("2020-04-31", None), ("04/31/2020", None), ("2020-13-01", None),
        ("12/31/2019", dt.date(2019, 12, 31)), ("20191231", dt.date(2019, 12, 31)), ("2019-11-30", dt.date(2019, 11, 30)),
        ("2020-02-29\n", None), ("02/29/2019", None),
    ],
)
def test_shapes_of_dates(spark, text, day):
    assert one(spark, day=text).activity_date == day


def test_columns_named_like_internal_ones_are_kept(spark):
    rows = spark.createDataFrame([("7", "Call", "2020-02-29", "x", "y")], RAW.replace("note", "_c") + ", _contact string")
    found = triage.triaged(rows, SETTINGS).first()
    assert (found["_c"], found["_contact"], found.contact_id) == ("x", "y", 7)
