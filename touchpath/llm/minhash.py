"""Near duplicates by one-permutation MinHash.

A text's shingle hashes are dealt over bins by their upper bits, and the smallest of each bin is kept: one hash
function serves all bins. Empty bins borrow from full ones by a probing sequence of their own (optimal
densification), so that small sets have independent bins, too. Bands of bins name the buckets.

Texts with equal sets are one class from the start. In each bucket only a star is checked: the smallest class
against the others, on their full sets. A bucket of true copies ends there. Where members of several components are
left, all are compared with the text that their buckets have in common most, the core. Then those go whose shingles that
others have, too, or whose differences from the core that others have, too, are too few for any link, and the rest is
looked at again with 64 further centres per bucket, then 4,096, and so on; members of a bucket's largest component are
no centres. What two of them changed of the core alike is bounded by a bitmap of each one's differences, so that copies
that went different ways meet without becoming a pair. So no link between members of a bucket is lost, and rounds grow
with the logarithm of a bucket's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpath.llm.common import mix64, portions, release, utf8, written
from touchpath.llm.graph import components
from touchpath.llm.shingles import joined, shingle_set

# a pair at the limit of 0.8 shares no bucket with a probability of (1 - 0.8^8)^100, about 1e-8, while of pairs at
# 0.3, which a common passage makes, fewer than one in a hundred shares one
BANDS, ROWS = 100, 8

# excess of a class that is not compared with a core: it bounds nothing
UNBOUNDED = -(10**15)

# 64-bit words of the bitmap of a class's differences from its core
CELL_WORDS = 8

_EMPTY = np.uint64(2**64 - 1)


def signatures(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """One row of ``bins`` minima per set (sets are sorted and not empty)."""
    found = np.full((len(sets), bins), _EMPTY, np.uint64)
    width = 2**64 // bins + 1
    starts = np.array([i * width for i in range(bins)], np.uint64)
    for row, hashes in zip(found, sets):
        places = np.searchsorted(hashes, starts)
        ends = np.append(places[1:], len(hashes))
        full = places < ends
        row[full] = hashes[places[full]]
    empty = found == _EMPTY
    rows, columns = np.nonzero(empty)
    attempt = 0
    while len(rows):
        attempt += 1
        probes = (mix64(columns.astype(np.uint64) * np.uint64(1_000_003) + np.uint64(attempt)) % np.uint64(bins)).astype(int)
        hit = ~empty[rows, probes]
        found[rows[hit], columns[hit]] = found[rows[hit], probes[hit]]
        rows, columns = rows[~hit], columns[~hit]
    return found


def _buckets(rows: np.ndarray, bands: int) -> np.ndarray:
    size = rows.shape[1] // bands
    numbers = np.arange(bands, dtype=np.uint64)
    parts = [np.broadcast_to(numbers, (len(rows), bands))] + [rows[:, i::size][:, :bands] for i in range(size)]
    return joined([np.ascontiguousarray(part) for part in parts])


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(row) for row in rows])]).astype(np.int32)
    flat = np.concatenate([*rows, np.empty(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(offsets, pa.array(flat))


def sketch(documents: DataFrame, shingle: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, class, buckets``: class names the shingle set, null if empty."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 250):
            sets = [shingle_set(text, shingle) for text in utf8(batch.column(1))]
            full = [i for i, hashes in enumerate(sets) if len(hashes)]
            marks = signatures([sets[i] for i in full], bands * rows)
            buckets: list[np.ndarray] = [np.empty(0, np.uint64)] * len(sets)
            classes: list[int | None] = [None] * len(sets)
            for i, found in zip(full, _buckets(marks, bands)):
                buckets[i] = found
                classes[i] = xxhash.xxh3_64_intdigest(sets[i].tobytes()) - 2**63
            counts = pa.array([len(hashes) for hashes in sets], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), counts, pa.array(classes, pa.int64()), _lists(buckets)],
                ["doc_id", "n_shingles", "class", "buckets"],
            )

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        work, "doc_id bigint, n_shingles bigint, class bigint, buckets array<bigint>"
    )


def _full_sets(documents: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """``class, shingles`` of the classes in ``wanted``, made again from one text of each."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            sets = [shingle_set(text, shingle) for text in utf8(batch.column(1))]
            classes = [xxhash.xxh3_64_intdigest(hashes.tobytes()) - 2**63 for hashes in sets]
            yield pa.RecordBatch.from_arrays([pa.array(classes, pa.int64()), _lists(sets)], ["class", "shingles"])

    chosen = documents.select(F.col("doc_id").cast("bigint").alias("first_id"), "text").join(
        wanted.select("first_id").distinct(), "first_id", "left_semi"
    )
    made = chosen.select("first_id", "text").mapInArrow(work, "class bigint, shingles array<bigint>")
    return made.join(wanted.select("class"), "class", "left_semi").dropDuplicates(["class"])


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b``, and whether their full sets are alike enough."""
    one = sets.select(F.col("class").alias("a"), F.col("shingles").alias("left"))
    two = sets.select(F.col("class").alias("b"), F.col("shingles").alias("right"))
    shared = F.size(F.array_intersect("left", "right")).alias("shared")
    union = (F.size("left") + F.size("right") - F.size(F.array_intersect("left", "right"))).alias("union")
    sized = pairs.join(one, "a").join(two, "b").select("a", "b", shared, union)
    linked = 100 * F.col("shared") >= percent * F.col("union")
    return sized.select("a", "b", linked.alias("linked"))


def _near(members: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``class, region`` of all members, and the classes near their region's core with the shingles they differ in.

    Buckets that share a class form a region; its core is the class that meets most others there. A text that lacks more
    than half of the core is not near it.
    """
    lowest = members.groupBy("bucket").agg(F.min("class").alias("low"), F.count("*").alias("k"))
    met = written(members.join(lowest, "bucket").groupBy("class", "low").agg(F.sum("k").alias("k")), "met")
    found = components(met.select(F.col("class").alias("a"), F.col("low").alias("b")))
    regions = written(found.select(F.col("node").alias("class"), F.col("component").alias("region")), "regions")
    weights = met.groupBy("class").agg(F.sum("k").alias("k"))
    cores = regions.join(weights, "class").groupBy("region").agg(F.max(F.struct("k", "class"))["class"].alias("class"))
    cores = cores.join(sets, "class").select("region", F.col("class").alias("core"), F.col("shingles").alias("core_shingles"))
    left_out = F.array_except("core_shingles", "shingles")
    near = regions.join(sets, "class").join(cores, "region").where(2 * F.size(left_out) <= F.size("core_shingles"))
    differing = F.concat(F.array_except("shingles", "core_shingles"), left_out).alias("differing")
    sizes = F.size("shingles").cast("bigint").alias("n"), F.size("core_shingles").cast("bigint").alias("core_n")
    near = written(near.select("class", "region", "core", *sizes, differing), "near")
    release(met)
    return regions, near


def _core_links(near: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` of a class and its core that have a link."""
    alike = (100 + percent) * F.size("differing") <= (100 - percent) * (F.col("n") + F.col("core_n"))
    return near.where(alike & (F.col("class") != F.col("core"))).select(F.least("class", "core").alias("a"), F.greatest("class", "core").alias("b"))


def _cells(hashes: str) -> Column:
    """A bitmap of the 64-bit values in an array: its words, and then the number of values that found their bit taken."""
    word = "aggregate({0}, 0L, (bits, x) -> if(pmod(shiftright(x, 6), {1}) = {2}, bits | shiftleft(1L, cast(x & 63 as int)), bits))"
    words = F.array(*[F.expr(word.format(hashes, CELL_WORDS, i)) for i in range(CELL_WORDS)])
    taken = F.size(hashes).cast("bigint") - F.aggregate(words, F.lit(0).cast("bigint"), lambda n, bits: n + F.bit_count(bits))
    return F.concat(words, F.array(taken))


def _shared_cells(one: str, other: str) -> Column:
    """A bound of the values that two arrays have in common, by their ``_cells``; null where one has none.

    Common values share a bit; of those that share one, all but one found it taken in both arrays.
    """
    both = sum((F.bit_count(F.col(one)[i].bitwiseAND(F.col(other)[i])) for i in range(CELL_WORDS)), F.lit(0).cast("bigint"))
    return both + F.least(F.col(one)[CELL_WORDS], F.col(other)[CELL_WORDS])


def _apart(owners: DataFrame, near: DataFrame, percent: int) -> DataFrame:
    """``class, common, excess, cells`` of the classes near a core.

    With X and Y the shingles in which two texts differ from the core (added or left out), the texts differ in
    |X| + |Y| - 2 |X and Y|. They have a link where ``100 + percent`` times that is ``100 - percent`` times the sum of
    their sizes at most: where their excesses, ``(100 + percent) * |X| - (100 - percent) * n`` each, are not more in sum
    than ``2 * (100 + percent) * |X and Y|``. ``common`` bounds what X shares with a text of another component. Copies
    that changed the core in different places have little of it, however much of the core they share. ``cells`` bounds
    |X and Y| for two given texts, see ``_shared_cells``.
    """
    each = near.join(owners.select("class", "component"), "class")
    each = each.select("class", "component", "region", F.explode("differing").alias("shingle"))
    ends = F.min("component").alias("low"), F.max("component").alias("high")
    own = each.groupBy("region", "shingle").agg(*ends).where("low = high").select("region", "shingle")
    own = each.join(own, ["region", "shingle"], "left_semi").groupBy("class").agg(F.count("*").alias("own"))
    size = F.size("differing").cast("bigint")
    return near.join(own, "class", "left").select(
        "class", (size - F.coalesce("own", F.lit(0))).alias("common"),
        ((100 + percent) * size - (100 - percent) * F.col("n")).alias("excess"),
        _cells("differing").alias("cells"),
    )


def _possible(members: DataFrame, regions: DataFrame, near: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows that may still have a link to another component of their bucket.

    What a class can have in common with members of other components is bounded by ``most``, the number of its shingles
    that some other component of its region has, too: a text whose own words exceed the limit is told apart from a whole
    group at once, without a comparison. A row stays if ``most`` suffices for the smallest member of another component
    in its bucket, and ``common`` (see ``_apart``) for the one of least excess. A class whose ``most`` is too little for
    texts of its own size or less goes with all its rows before they are looked at.
    """
    owners = written(members.select("class", "component", "n").distinct().join(regions, "class"), "owners")
    held = owners.join(sets, "class").select("class", "component", "region", F.explode("shingles").alias("shingle"))
    held = written(held, "held")
    ends = F.min("component").alias("low"), F.max("component").alias("high")
    own = held.groupBy("region", "shingle").agg(*ends).where("low = high").select("region", "shingle")
    own = held.join(own, ["region", "shingle"], "left_semi").groupBy("class").agg(F.count("*").alias("own"))
    apart = _apart(owners, near, percent)
    most = F.col("n") - F.coalesce("own", F.lit(0))
    bounds = owners.join(own, "class", "left").join(apart, "class", "left").where(100 * most >= percent * F.col("n")).select(
        "class", most.alias("most"),
        F.coalesce("common", F.lit(0)).alias("common"), F.coalesce("excess", F.lit(UNBOUNDED)).alias("excess"),
        "cells",
    )
    bounded = written(members.drop("most", "common", "excess", "cells").join(bounds, "class"), "bounded")

    lows = bounded.groupBy("bucket").agg(
        F.min(F.struct("n", "component")).alias("first"), F.min(F.struct("excess", "component")).alias("least")
    )
    second = F.min(F.when(F.col("component") != F.col("first.component"), F.col("n"))).alias("second")
    next_ = F.min(F.when(F.col("component") != F.col("least.component"), F.col("excess"))).alias("next")
    lows = bounded.join(lows, "bucket").groupBy("bucket", "first", "least").agg(second, next_).where("second is not null")
    other = F.when(F.col("component") == F.col("first.component"), F.col("second")).otherwise(F.col("first.n"))
    enough = 100 * (100 + percent) * F.col("most") >= percent * F.greatest(100 * (F.col("n") + other), (100 + percent) * F.col("n"))
    least = F.when(F.col("component") == F.col("least.component"), F.col("next")).otherwise(F.col("least.excess"))
    enough &= F.col("excess") + least <= 2 * (100 + percent) * F.col("common")
    kept = written(bounded.join(lows, "bucket").where(enough).select(*members.columns), "possible")
    release(owners, held, bounded)
    return kept


def _open(members: DataFrame) -> DataFrame:
    """The rows of buckets with members of more than one component."""
    ends = members.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return written(members.join(ends.where("low <> high").select("bucket"), "bucket", "left_semi"), "members")


def _centres(members: DataFrame, slots: int) -> DataFrame:
    """The smallest member of each slot of a bucket, among those outside the bucket's largest component.

    Of two members of different components at least one is outside it, so its own members need not be centres, and a
    bucket of many copies with a few others is done when the few are.
    """
    chosen = members
    if slots > 1:
        shares = members.groupBy("bucket", "component").agg(F.count("*").alias("k"))
        largest = shares.groupBy("bucket").agg(F.max(F.struct("k", "component"))["component"].alias("largest"))
        chosen = members.join(largest, "bucket").where("component <> largest")
    slot = F.pmod(F.xxhash64("class", F.lit(slots)), F.lit(slots))
    names = ["n", "component", "most", "common", "excess", "cells"]
    least = F.min(F.struct("class", *names)).alias("c")
    return chosen.groupBy("bucket", slot.alias("slot")).agg(least).select(
        "bucket", F.col("c.class").alias("centre"), *[F.col(f"c.{name}").alias(f"centre_{name}") for name in names]
    )


def _pairs(members: DataFrame, centres: DataFrame, percent: int) -> DataFrame:
    """Members against centres of their bucket: those of other components whose sizes, common shingles and common
    differences from the core, by number and by bitmap, allow a link."""
    joined_ = members.join(centres, "bucket").where("class <> centre and component <> centre_component")
    alike = joined_.where(100 * F.least("n", "centre_n") >= percent * F.greatest("n", "centre_n"))
    alike = alike.where((100 + percent) * F.least("most", "centre_most") >= percent * (F.col("n") + F.col("centre_n")))
    together_ = F.least("common", "centre_common", _shared_cells("cells", "centre_cells"))  # which leaves nulls out
    alike = alike.where(F.col("excess") + F.col("centre_excess") <= 2 * (100 + percent) * together_)
    return alike.select(F.least("class", "centre").alias("a"), F.greatest("class", "centre").alias("b")).distinct()


def together(dealt: DataFrame) -> DataFrame:
    """The members of buckets with several classes, from ``class, n, bucket``: each class its own component."""
    shared = dealt.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high")
    members = dealt.join(shared.select("bucket"), "bucket").withColumn("component", F.col("class"))
    unknown = {"most": F.col("n"), "common": F.lit(0).cast("bigint"), "excess": F.lit(UNBOUNDED), "cells": F.lit(None).cast("array<bigint>")}
    return written(members.withColumns(unknown), "members")


def _placed(members: DataFrame, found: DataFrame) -> DataFrame:
    """The rows with the components found so far; a class without links is its own."""
    placed = members.drop("component").join(found.withColumnRenamed("node", "class"), "class", "left")
    return placed.withColumn("component", F.coalesce("component", "class"))


def linked(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """``node, component`` of the classes that have links, None where nothing met.

    ``members`` is what ``together`` gives; ``sets`` holds their ``class, shingles``. All pairs of a bucket whose sets
    share ``percent`` % of their union end in one component.
    """
    links, tested, found = None, None, None
    slots = 1
    while not members.isEmpty():
        centres = written(_centres(members, slots), "centres")
        pairs = _pairs(members, centres, percent)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        compared = written(_compared(pairs, sets, percent), "compared")
        tested = pairs if tested is None else tested.unionAll(pairs)
        new = compared.where("linked").select("a", "b")
        if found is None or not new.isEmpty():
            links = new if links is None else links.unionAll(new)
            found = written(components(links), "components")
        # pairs among the members that have not been centres are open where their components differ
        used = centres.select("bucket", F.col("centre").alias("class"))
        left = written(_placed(members.join(used, ["bucket", "class"], "left_anti"), found), "left")
        last, members = members, _open(left)
        release(last, left, centres)
        if slots == 1:
            rows, before = members.count(), None
            while rows and (before is None or 4 * rows <= before):  # what is left has smaller regions and other cores
                before = rows
                regions, near = _near(members, sets)
                new = written(_core_links(near, percent), "core_links")
                if not new.isEmpty():
                    links = links.unionAll(new)
                    found = written(components(links), "components")
                last, left = members, written(_placed(members, found), "left")
                members = _possible(left, regions, near, sets, percent)
                release(last, left, regions, near)
                rows = members.count()
        slots *= 64
    return found


def classes_and_links(documents: DataFrame, shingle: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sketch, ``class, first_id, n`` of the distinct sets, and ``node, component`` of the classes that have links."""
    rows = written(sketch(documents, shingle), "sketch")
    grouped = rows.where("class is not null").groupBy("class", "n_shingles", "buckets").agg(F.min("doc_id").alias("first_id"))
    classes = written(grouped.withColumnRenamed("n_shingles", "n"), "classes")
    members = together(classes.select("class", "n", F.explode("buckets").alias("bucket")))
    wanted = classes.join(members.select("class").distinct(), "class", "left_semi").select("class", "first_id")
    sets = written(_full_sets(documents, wanted, shingle), "sets")
    return rows, classes.select("class", "first_id"), linked(members, sets, percent)


def by_component(rows: DataFrame, classes: DataFrame, found: DataFrame | None) -> DataFrame:
    """``rows``, which have ``doc_id`` and ``class``, with ``component_id``, the smallest doc_id of the row's component,
    and ``kept``, whether it is the row's own. Rows without a class or without a doc_id stay alone."""
    if found is None:
        found = classes.limit(0).select(F.col("class").alias("node"), F.col("class").alias("component"))
    placed = classes.join(found.withColumnRenamed("node", "class"), "class", "left")
    placed = placed.withColumn("component", F.coalesce("component", "class"))
    lowest = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_class = placed.join(lowest, "component").select("class", F.col("component_id").alias("lowest"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("lowest", "doc_id"))
    joined_ = rows.join(by_class, "class", "left").withColumn("component_id", component).drop("class", "lowest")
    return joined_.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def near_duplicates(documents: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row.

    ``component_id`` is the smallest doc_id reachable through links; links join texts whose sets of ``shingle``-word
    runs share at least ``percent`` % of their union. One row of each component is kept: that whose doc_id is the
    component's. Texts without words have no set and stay alone. Repeated rows stay (and rows that repeat a kept
    doc_id with a text of its component are kept like it); a null doc_id stays alone and is kept. An empty table
    gives an empty table. Other columns are not looked at.
    """
    rows, classes, found = classes_and_links(documents, shingle, percent)
    return by_component(rows.drop("buckets"), classes, found)


def deduplicated(documents: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``documents`` with one row of each component: that of its smallest doc_id, and one of rows that repeat it.

    Rows without doc_id all stay. What is joined to the documents are the ids that go, and those that are repeated.
    """
    found = written(near_duplicates(documents, shingle, percent).where("doc_id is not null"), "found")
    kept = found.groupBy("doc_id").agg(F.count(F.when(F.col("kept"), 1)).alias("n")).where("n <> 1")
    name = "_id" + "_" * max(map(len, documents.columns))  # longer than any column's name
    kept = written(kept, "other").withColumnRenamed("doc_id", name)
    same = documents["doc_id"].cast("bigint") == F.col(name)
    rest = documents.join(kept, same, "left_anti")
    repeated = documents.join(kept.where("n > 1"), same, "left_semi")
    return rest.unionAll(repeated.dropDuplicates(["doc_id"]))
