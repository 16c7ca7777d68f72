"""Periodic runs of words: where a stretch of a text repeats with a fixed distance, and the text without the repeats.

A run with period q and two or more periods holds, for the first multiple i of q at or after its start, the words i and
i + q, and the two agree over q words around them. So each period has a grid of places to look at, n/q of them and
n log n in all; where the words agree, the grammar of the texts (``recompression``) tells exactly how far the agreement
reaches to either side. No suffix array is built. Multiples of the smallest period find the same stretch again and are
dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from touchpath.llm.common import SPACE, extended, portions, utf8, words_of
from touchpath.llm.recompression import Grammar

LEAST = 12  # words of a run
WORDS_AT_ONCE = 300_000  # a grammar is built over so many words of several texts; a longer text has its own
GRID_AT_ONCE = 1 << 20

RUN = StructType([StructField(name, LongType(), False) for name in ("start", "length", "period")])


def _grid(words: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods on the harmonic grid of one text at which words agree over three places in a row or more.

    The stretch in which words agree with those a period on has max(period, least - period) places, so it has at
    least half of ``least``; with fewer than three only the place itself is compared.
    """
    n = len(words)
    most = n // 2
    counts = (n - 1) // np.arange(1, most + 1)
    ends = np.cumsum(counts)
    low = 0
    while low < most:
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + GRID_AT_ONCE)))
        part = counts[low:high]
        period = np.repeat(np.arange(low + 1, low + 1 + len(part)), part)
        place = np.arange(len(period)) - np.repeat(np.cumsum(part) - part, part)
        place *= period
        found = np.flatnonzero(words[place] == words[place + period])
        place, period = place[found], period[found]
        if least >= 6 and len(place):
            near = [_same(words, place + shift, period) for shift in (-2, -1, 1, 2)]
            kept = (near[0] & near[1]) | (near[1] & near[2]) | (near[2] & near[3])
            place, period = place[kept], period[kept]
        yield place, period
        low = high


def _same(words: np.ndarray, place: np.ndarray, period: np.ndarray) -> np.ndarray:
    inside = (place >= 0) & (place + period < len(words))
    place = np.where(inside, place, 0)
    return inside & (words[place] == words[np.where(inside, place + period, 0)])


def find_runs(texts: list[np.ndarray], least: int = LEAST) -> list[np.ndarray]:
    """For each sequence of numbers its runs: rows of start, length, period, by start, then period."""
    long = [number for number, words in enumerate(texts) if len(words) >= max(2, least)]
    grammar = Grammar([texts[number] for number in long])
    owner, place, period = [], [], []
    for position, number in enumerate(long):
        for places, periods in _grid(texts[number], least):
            if len(places):
                owner.append(np.full(len(places), position))
                place.append(places)
                period.append(periods)
    found = [np.empty((0, 3), np.int64) for _ in texts]
    if not owner:
        return found
    owner, place, period = (np.concatenate(parts) for parts in (owner, place, period))
    at = place + grammar.offsets[owner]
    ahead, behind = grammar.ahead(at, at + period), grammar.behind(at, at + period)
    length = ahead + behind + period
    whole = (length >= 2 * period) & (length >= least)
    rows = np.stack([owner, place - behind, length, period])[:, whole]
    rows = rows[:, np.lexsort(rows[::-1])]  # by owner, start, length, period
    first = np.ones(rows.shape[1], bool)
    first[1:] = np.any(rows[:3, 1:] != rows[:3, :-1], axis=0)  # the smallest period of a stretch
    rows = rows[:, first]
    rows = rows[:, np.lexsort((rows[3], rows[1], rows[0]))]
    borders = np.searchsorted(rows[0], np.arange(len(long) + 1))
    for position, number in enumerate(long):
        found[number] = rows[1:, borders[position] : borders[position + 1]].T
    return found


def _portions_of_words(texts: list[bytes]) -> Iterator[list[list[bytes]]]:
    held, size = [], 0
    for text in texts:
        words = text.split()
        if held and size + len(words) > WORDS_AT_ONCE:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield held


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)])


def periodic_runs(documents: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of each row: its runs as (start, length, period) in words, and its words
    without those that a run holds after its first period, joined by one space.

    Words are ``[^\\x20\\x09-\\x0D]+``. A run is a stretch with smallest period q of at least ``least`` and 2 * q words
    that no neighbouring word extends; runs may overlap. Null and empty texts have no words, no runs and an empty
    ``collapsed``. Rows are judged one by one, so repeated rows give repeated results and a null doc_id is only carried
    along; other columns are not looked at. One text is handled whole, in one task, in memory that grows with its words.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 200):
            at = 0
            for texts in _portions_of_words(utf8(batch.column(1))):
                number: dict[bytes, int] = {}
                ids = [np.array([number.setdefault(word, len(number)) for word in words], np.int64) for words in texts]
                found = find_runs(ids, least)
                flat = np.concatenate(found)
                values = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=_RUN_FIELDS)
                borders = np.cumsum([0, *map(len, found)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)),
                        pa.array([len(words) for words in texts], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(borders), values),
                        pa.array(map(_collapsed, texts, found), pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )
                at += len(texts)

    narrow = documents.select("doc_id", "text")
    schema = extended(
        narrow.select("doc_id").schema, n_words=LongType(), runs=ArrayType(RUN, False), collapsed=StringType()
    )
    return narrow.mapInArrow(work, schema)


_RUN_FIELDS = [pa.field(name, pa.int64(), nullable=False) for name in ("start", "length", "period")]


def with_planted_periods(documents: DataFrame) -> DataFrame:
    """``doc_id, text`` with a period written into every tenth text: with h the checksum of the decimal doc_id and g its
    tenth, each word from a = g mod n on becomes word a + (i - a) mod p, p = 1 + floor((n - a) / (3 + g mod 8)).
    Texts without words and rows without doc_id stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    narrow = documents.select("doc_id", "text", (h % 10 == 0).alias("chosen"), F.floor(h / 10).cast("bigint").alias("g"))
    words = F.when(F.col("chosen") & (F.length(F.btrim("text", F.lit(SPACE))) > 0), words_of(F.col("text")))
    shaped = (
        narrow.withColumn("words", words)
        .withColumn("n", F.size("words").cast("bigint"))
        .withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
        .withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)).cast("bigint"))
    )
    head = F.slice("words", F.lit(1), F.col("a").cast("int"))
    period = F.slice("words", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    whole = F.slice(F.concat(head, F.flatten(F.array_repeat(period, times))), F.lit(1), F.col("n").cast("int"))
    rewritten = F.when(F.col("words").isNotNull(), F.array_join(whole, " ")).otherwise(F.col("text"))
    return shaped.select("doc_id", rewritten.alias("text"))
