"""Column expressions without state: recodes, keys, dates, text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: the 32 check characters of a record id, by 5-bit number
CHECK_CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ012345"


def clean_type(raw: Column, names: dict[str, str]) -> Column:
    """Raw activity type to its clean name; an unknown type stays as it is."""
    lookup = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.element_at(lookup, raw), raw)


def padded(text: Column, width: int) -> Column:
    """Text filled with zeros on the left to ``width`` characters; longer text stays whole."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def record_id_18(record_id: Column) -> Column:
    """Case-safe 18-character form of a 15-character record id.

    Each block of five characters yields one check character, numbered by which
    of the five are upper-case (the first one counts least). Any other length
    passes through.
    """
    capitals = CHECK_CHARACTERS[:26]

    def check(block: int) -> Column:
        letters = [F.substring(record_id, block * 5 + place + 1, 1) for place in range(5)]
        bits = [F.when(letter.isin(*capitals), 1 << place).otherwise(0) for place, letter in enumerate(letters)]
        return F.substr(F.lit(CHECK_CHARACTERS), sum(bits[1:], bits[0]) + 1, F.lit(1))

    return F.when(F.length(record_id) == 15, F.concat(record_id, *[check(block) for block in range(3)])).otherwise(
        record_id
    )


def journey_begin(first_activity: Column, created: Column) -> Column:
    """Earlier of two dates; the creation date when they are equal or one is missing."""
    return F.when(first_activity < created, first_activity).otherwise(created)


def matches(text: Column, pattern: str) -> Column:
    """Regular-expression match; missing text does not match."""
    return F.coalesce(text.rlike(pattern), F.lit(False))


def change_label(before: Column, after: Column) -> Column:
    return F.concat_ws("-->", before, after)  # fixed value: the form of a label


def described(activity_type: Column, day: Column, detail: Column) -> Column:
    """One fixed-width description line; a missing detail prints as NA."""
    return F.format_string(
        "%s %-21s %-15s %s %s",
        F.lit("{"),
        activity_type,
        day.cast("string"),
        F.coalesce(detail, F.lit("NA")),
        F.lit("}"),
    )


def percent_change(score: Column, old_percent: Column) -> Column:
    """Relative change of a score against an old one in percent; null when the old one is 0."""
    old = old_percent / 100
    return F.try_divide(score - old, old)


def days_or(days: Column, missing: int = -999) -> Column:
    return F.coalesce(days, F.lit(missing))


def draw(seed: str, *keys: Column) -> Column:
    """Uniform non-negative number fixed by seed and keys (a reproducible random draw)."""
    text = F.concat_ws("|", F.lit(seed), *[key.cast("string") for key in keys])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint")
