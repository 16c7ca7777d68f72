"""A log of untrusted text turned into typed activities, and a channel of rejects with the reason of each."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpath.settings import Settings

# days that some year has
_MONTH_DAY = (
    r"(?:(?:0[13578]|1[02]){0}(?:0[1-9]|[12]\d|3[01])|(?:0[469]|11){0}(?:0[1-9]|[12]\d|30)|02{0}(?:0[1-9]|[12]\d))"
)
# forms of dates, each with what a text must look like to be one, so that no text fits two; a time after an ISO date is
# cut off. A text that looks like none is not given to the parser: its failure costs more than all the rest of a row.
DATE_FORMS = {
    "yyyy-MM-dd": r"^\+?\d+-" + _MONTH_DAY.format("-") + "$",
    "MM/dd/yyyy": "^" + _MONTH_DAY.format("/") + r"/\+?\d+$",
    "yyyyMMdd": r"^\+?\d+" + _MONTH_DAY.format("") + "$",
}

NO_CONTACT, BAD_CONTACT = "no contact", "contact is no number"
NO_DATE, BAD_DATE, FUTURE = "no date", "date cannot be read", "date is after the present day"
UNKNOWN_TYPE, AMBIGUOUS_TYPE = "type is unknown", "type stands for several"


def parsed_date(text: Column) -> Column:
    """The date of the form that fits, null if none does or there is no such day."""
    return _date_of(_bare_date(text))


def _bare_date(text: Column) -> Column:
    return F.regexp_replace(F.trim(text), r"^(\d{4}-\d{2}-\d{2})[ T].*$", "$1")


def _date_of(bare: Column) -> Column:
    return F.coalesce(*[F.when(bare.rlike(shape), F.try_to_date(bare, form)) for form, shape in DATE_FORMS.items()])


def _folded(name: str) -> str:
    return " ".join(name.replace(".", " ").replace("_", " ").replace("-", " ").lower().split())


def vocabulary(settings: Settings) -> tuple[dict[str, str], set[str]]:
    """Raw types by their folded spelling, and the spellings that several types share."""
    known = defaultdict(set)
    for name in settings.excluded_types:
        known[_folded(name)].add(name)
    for raw, clean in settings.type_names.items():
        known[_folded(raw)].add(raw)
        known[_folded(clean)].add(raw)
    single = {folded: next(iter(names)) for folded, names in known.items() if len(names) == 1}
    return single, {folded for folded, names in known.items() if len(names) > 1}


def normal_type(text: Column, settings: Settings) -> tuple[Column, Column]:
    """The raw type that a text stands for, and why there is none.

    A type that is spelled as in the vocabulary is itself. Otherwise case, white space at the ends, and dots, dashes and
    underscores between words do not matter, unless several types differ in nothing else. A missing type stays missing:
    it gets its default later on.
    """
    folded = _folded_text(text)
    found = _type_of(text, folded, settings)
    return found, _type_problem(text, folded, found, settings)


def _folded_text(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[\s._-]+", " "))


def _is_exact(text: Column, settings: Settings) -> Column:
    return text.isin(*settings.excluded_types, *settings.type_names)


def _type_of(text: Column, folded: Column, settings: Settings) -> Column:
    single, _ = vocabulary(settings)
    lookup = F.create_map(*[F.lit(x) for pair in single.items() for x in pair])
    return F.when(_is_exact(text, settings), text).otherwise(F.try_element_at(lookup, folded))


def _type_problem(text: Column, folded: Column, found: Column, settings: Settings) -> Column:
    _, several = vocabulary(settings)
    problem = F.when(text.isNull() | _is_exact(text, settings) | found.isNotNull(), None)
    problem = problem.when(folded.isin(*several), AMBIGUOUS_TYPE) if several else problem
    return problem.otherwise(UNKNOWN_TYPE)


def _once(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
    """``rows`` with more columns, computed once per row: a plain column would be computed again wherever it is used,
    in a filter as well as in what the filter passes on."""
    return rows.select("*", F.inline(F.array(F.struct(*[value.alias(name) for name, value in values.items()]))))


def triaged(raw: DataFrame, settings: Settings, future: bool = True) -> DataFrame:
    """``raw`` with typed ``contact_id``, ``activity_type`` and ``activity_date`` in place of ``contact_text``,
    ``type_text`` and ``date_text``, and ``reason``: null, or the first thing that keeps the row out.

    The texts stay in the columns they had, so that a reject can be looked at. Without ``future``, activities after the
    present day are rejects, too.
    """
    contact, text = F.trim("contact_text"), F.col("type_text")
    whole = F.when(contact.rlike(r"^\d{1,18}$"), contact.try_cast("bigint"))
    # longer than any column's name
    whole_, folded_, bare_, type_, day_ = (f"{'_' * max(map(len, raw.columns))}{name}" for name in ("c", "f", "b", "t", "d"))
    folded, found = F.col(folded_), F.col(type_)
    rows = _once(raw, {whole_: whole, folded_: _folded_text(text), bare_: _bare_date(F.col("date_text"))})
    rows = _once(rows, {type_: _type_of(text, folded, settings), day_: _date_of(F.col(bare_))})
    type_problem = _type_problem(text, folded, found, settings)
    typed = rows.withColumns({"contact_id": F.col(whole_), "activity_type": found, "activity_date": F.col(day_)})
    blank = {name: F.col(name).isNull() | (F.trim(name) == "") for name in ("contact_text", "date_text")}
    reason = (
        F.when(blank["contact_text"], NO_CONTACT)
        .when(F.col("contact_id").isNull(), BAD_CONTACT)
        .when(blank["date_text"], NO_DATE)
        .when(F.col("activity_date").isNull(), BAD_DATE)
    )
    if not future:
        reason = reason.when(F.col("activity_date") > F.lit(settings.as_of), FUTURE)
    return typed.withColumn("reason", reason.otherwise(type_problem)).drop(whole_, folded_, bare_, type_, day_)


def trusted(rows: DataFrame) -> DataFrame:
    """Triaged rows without a reason, in the columns of an activity log."""
    return rows.where(F.col("reason").isNull()).drop("contact_text", "type_text", "date_text", "reason")


def rejects(rows: DataFrame) -> DataFrame:
    """Triaged rows that cannot be used, as they came, with the reason."""
    return rows.where(F.col("reason").isNotNull()).drop("contact_id", "activity_type", "activity_date")


def reasons(rows: DataFrame) -> DataFrame:
    """How often each reason occurs."""
    return rejects(rows).groupBy("reason").agg(F.count("*").alias("n"))
