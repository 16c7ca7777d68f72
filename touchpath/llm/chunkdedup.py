"""Passages that repeat across documents, by content-defined chunks.

A gear hash rolls over a text's bytes. Of the runs of half a passage's words, each passage's worth of words chooses the
one whose last bytes hash lowest: a chunk. The choice depends on nothing else, so that two documents that share a
passage have a chunk of it in common, at the same place in it, whatever stands around. Chunks are compared by digest:
of each digest that several documents hold, the first place (smallest doc_id, then offset) keeps it. Each shared chunk
is then extended in both texts as far as they agree, and runs of enough words are passages.

The first place of a chunk may agree for less than a passage where a later place has all of it. So where a chunk of
more than two places chose text that no passage found so far contains, the runs of a whole passage's words that chose
it are compared by digest in all documents: the first place of such a run has all of it.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpath.llm.common import portions, release, unused, utf8, written

_GEAR = np.array([random.Random(byte).getrandbits(32) for byte in range(256)], np.uint32)
_BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\f\r"))


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text."""
    edges = np.diff(np.concatenate([[True], _BLANK[data], [True]]).astype(np.int8))
    return np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)


def cuts(data: bytes, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the chunks of a text, and of the text that chose each: all runs of ``words`` words in it did."""
    text = np.frombuffer(data, np.uint8)
    starts, ends = _words(text)
    size = (words + 1) // 2
    if len(starts) < words:
        return (starts[:0],) * 4
    gear, span = _GEAR[text], 1
    while span <= 16 and span < size:  # the hash over 32 bytes, from those over 1, 2, 4, 8 and 16; none leaves its chunk
        longer = gear.copy()
        longer[span:] += gear[:-span] << np.uint32(span)
        gear, span = longer, 2 * span
    runs = len(starts) - size + 1
    # of equal hashes the last place is lowest
    key = (gear[ends[size - 1 :] - 1].astype(np.uint64) << np.uint64(32)) | np.arange(runs, 0, -1, dtype=np.uint64)
    choices, span = words - size + 1, 1
    lowest = key
    while 2 * span <= choices:
        lowest, span = np.minimum(lowest[:-span], lowest[span:]), 2 * span
    if span < choices:
        lowest = np.minimum(lowest[: span - choices], lowest[choices - span :])
    new = np.flatnonzero(np.concatenate([[True], lowest[1:] != lowest[:-1]]))
    last = np.append(new[1:], len(lowest)) - 1
    at = runs - (lowest[new] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return starts[at], ends[at + size - 1], starts[new], ends[last + words - 1]


def chunks(documents: DataFrame, words: int = 50) -> DataFrame:
    """``doc_id, start, low, high, digest`` of the chunks of each text with an id; low to high is the text that chose
    the chunk. A null text and one of fewer words have none."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in portions(batches):
            ids, places, digests = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                starts, ends, low, high = cuts(text, words)
                ids.append(np.full(len(starts), doc_id, np.int64))
                places.append(np.array([starts, low, high], np.int32))
                digests += [digest(text[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
            at = np.concatenate([np.empty((3, 0), np.int32), *places], axis=1)
            columns = [
                pa.array(np.concatenate([np.empty(0, np.int64), *ids])), *map(pa.array, at),
                pa.array(np.array(digests, np.uint64).view(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "low", "high", "digest"])

    chosen = documents.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return chosen.mapInArrow(work, "doc_id bigint, start int, low int, high int, digest bigint")


def _agreeing(one: np.ndarray, other: np.ndarray) -> int:
    """Length of the common beginning."""
    size, step = min(len(one), len(other)), 256
    for start in range(0, size, step):
        different = np.flatnonzero(one[start : min(size, start + step)] != other[start : min(size, start + step)])
        if len(different):
            return start + int(different[0])
    return size


def _whole_words(data: np.ndarray, start: int, end: int) -> tuple[int, int]:
    """A range cut back to whole words."""
    blank = _BLANK[data]
    if start and not blank[start - 1] and start < end:
        inner = np.flatnonzero(blank[start:end])
        start = start + int(inner[0]) if len(inner) else end
    if end < len(data) and not blank[end] and start < end:
        inner = np.flatnonzero(blank[start:end])
        end = start + int(inner[-1]) if len(inner) else start
    return start, end


def matches(text: bytes, first: bytes, places: list[tuple[int, int, int, int]], words: int) -> list[tuple[int, int, int, int]]:
    """Passages that two texts share around places ``(start, start in first, low, high)``: start, length, words, start in
    first. A place whose low to high lies in a passage found before adds nothing."""
    one, other = np.frombuffer(text, np.uint8), np.frombuffer(first, np.uint8)
    found, reached, within = [], {}, (0, 0)
    for a, b, low, high in sorted(places):
        if a < reached.get(a - b, 0) or (within[0] <= low and high <= within[1]) or text[a : a + 1] != first[b : b + 1]:
            continue
        ahead = _agreeing(one[a:], other[b:])
        back = _agreeing(one[:a][::-1], other[:b][::-1])
        reached[a - b] = a + ahead
        start, end = _whole_words(one, a - back, a + ahead)
        count = len(text[start:end].split())
        if count >= words:
            found.append((start, end - start, count, start - a + b))
            within = max(within, (start, end), key=lambda span: span[1])
    return found


_PASSAGE = "doc_id bigint, start int, length int, n_words int, first_doc_id bigint, first_start int"
_NAMES = [part.split()[0] for part in _PASSAGE.split(", ")]


def _compared(documents: DataFrame, again: DataFrame, words: int) -> DataFrame:
    """The passages around ``doc_id, first_doc_id, start, first_start, low, high``."""
    pairs = again.groupBy("doc_id", "first_doc_id").agg(
        F.collect_list(F.struct("start", "first_start", "low", "high")).alias("places")
    )  # at most a text's chunks (or runs of words) per pair
    pairs = written(pairs, "pairs")
    needed = pairs.select("doc_id").unionAll(pairs.select("first_doc_id")).distinct()
    texts = written(_named(documents).join(needed, "doc_id", "left_semi"), "texts")
    both = pairs.join(texts, "doc_id").join(
        texts.select(F.col("doc_id").alias("first_doc_id"), F.col("text").alias("first_text")), "first_doc_id"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            rows = []
            ids, firsts, places = (batch.column(i).to_pylist() for i in (0, 1, 2))
            for doc_id, first_id, at, text, first in zip(ids, firsts, places, utf8(batch.column(3)), utf8(batch.column(4))):
                spots = [(p["start"], p["first_start"], p["low"], p["high"]) for p in at]
                for start, length, count, b in matches(text, first, spots, words):
                    rows.append((doc_id, start, length, count, first_id, b))
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
            columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, _NAMES)

    found = both.select("doc_id", "first_doc_id", "places", "text", "first_text").mapInArrow(work, _PASSAGE)
    found = written(found.distinct(), "passages")
    release(pairs, texts)
    return found


def _named(documents: DataFrame) -> DataFrame:
    return documents.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


def _outside(places: DataFrame, found: DataFrame) -> DataFrame:
    """``places`` whose low to high lies in no passage of ``found``."""
    spans = found.select(F.col("doc_id").alias("_id"), F.col("start").alias("_from"), (F.col("start") + F.col("length")).alias("_to"))
    inside = (F.col("doc_id") == F.col("_id")) & (F.col("_from") <= F.col("low")) & (F.col("high") <= F.col("_to"))
    return places.join(spans, inside, "left_anti")


def _runs(documents: DataFrame, places: DataFrame, found: DataFrame, words: int) -> DataFrame:
    """``doc_id, start, low, high, digest`` of the runs of ``words`` words inside low to high of ``places``, but for those
    in a passage of ``found``: what these hold, an earlier document holds."""
    ranges = places.groupBy("doc_id").agg(F.collect_set(F.struct("low", "high")).alias("ranges"))
    spans = found.groupBy("doc_id").agg(F.collect_set(F.struct("start", "length")).alias("spans"))
    rows = _named(documents).join(ranges, "doc_id").join(spans, "doc_id", "left").select("doc_id", "text", "ranges", "spans")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in portions(batches, 100):
            ids, at, digests = [], [], []
            for doc_id, text, inside, known in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), *(batch.column(i).to_pylist() for i in (2, 3))):
                starts, ends = _words(np.frombuffer(text, np.uint8))
                if len(starts) < words:
                    continue
                low, high = starts[: len(starts) - words + 1], ends[words - 1 :]
                wanted = np.zeros(len(low), bool)
                for span in inside:
                    wanted[np.searchsorted(low, span["low"]) : np.searchsorted(high, span["high"], "right")] = True
                for span in known or []:
                    wanted[np.searchsorted(low, span["start"]) : np.searchsorted(high, span["start"] + span["length"], "right")] = False
                chosen = np.array([low[wanted], high[wanted]], np.int32)
                ids.append(np.full(chosen.shape[1], doc_id, np.int64))
                at.append(chosen)
                digests += [digest(text[a:b]) for a, b in chosen.T.tolist()]
            places = np.concatenate([np.empty((2, 0), np.int32), *at], axis=1)
            columns = [
                pa.array(np.concatenate([np.empty(0, np.int64), *ids])), *(pa.array(places[i]) for i in (0, 0, 1)),
                pa.array(np.array(digests, np.uint64).view(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "low", "high", "digest"])

    return rows.mapInArrow(work, "doc_id bigint, start int, low int, high int, digest bigint")


def _held_before(places: DataFrame) -> DataFrame:
    """``places`` whose digest an earlier document holds, with its first place and the number ``n`` of its places."""
    place = F.struct("doc_id", "start")
    held = places.groupBy("digest").agg(F.min(place).alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
    shared = held.where(F.col("first.doc_id") < F.col("last")).select("digest", "first", "n")
    again = places.join(shared, "digest").where(F.col("doc_id") != F.col("first.doc_id"))
    return again.select(
        "doc_id", "start", "low", "high", "digest", "n",
        F.col("first.doc_id").alias("first_doc_id"), F.col("first.start").alias("first_start"),
    )


def passages(documents: DataFrame, words: int = 50) -> DataFrame:
    """``doc_id, start, length, n_words, first_doc_id, first_start``: passages of ``words`` whole words or more that a
    document (bytes start to start + length of its text) shares with the first document that has them. Each run of
    ``words`` words that an earlier document holds lies in one of them.

    Repeats inside one document are not reported. Rows without doc_id are left out; rows with the same doc_id are one
    document, any of whose texts may be reported. A null or short text has no passages; an empty table gives an empty
    table; other columns are not looked at.

    Chunks are written once; the digests that several documents hold are found by an aggregate that is combined
    before the shuffle, and joined back to the chunks. Only texts with a shared chunk are shuffled.
    """
    all_ = written(chunks(documents, words), "chunks")
    again = written(_held_before(all_), "again")
    found = _compared(documents, again, words)
    # two places have been compared with each other; of more, each with the first alone
    open_ = written(_outside(again.where("n > 2"), found).select("digest").distinct(), "open")
    release(again)
    if open_.isEmpty():
        release(all_, open_)
        return found
    runs = written(_runs(documents, _outside(all_.join(open_, "digest"), found), found, words), "runs")
    release(all_, open_)
    more = _compared(documents, _held_before(runs), words)
    release(runs)
    return found.unionAll(more).distinct()


def without_passages(documents: DataFrame, found: DataFrame) -> DataFrame:
    """``documents`` with the passages of ``found`` cut out of their texts; the first document keeps each passage."""
    doc_id, cuts_ = unused(documents, "_id"), unused(documents, "_spans")
    spans = found.groupBy(F.col("doc_id").alias(doc_id)).agg(F.collect_set(F.struct("start", "length")).alias(cuts_))
    joined = documents.join(spans, documents["doc_id"].cast("bigint") == spans[doc_id], "left").drop(doc_id)
    names = documents.columns
    at = names.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            texts = []
            for text, cut in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()):
                if cut:
                    data, kept, reached = text.encode(), [], 0
                    for span in sorted(cut, key=lambda span: span["start"]):
                        kept.append(data[reached : max(reached, span["start"])])
                        reached = max(reached, span["start"] + span["length"])
                    text = b"".join([*kept, data[reached:]]).decode("utf-8", "replace")
                texts.append(text)
            columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(work, documents.schema)
