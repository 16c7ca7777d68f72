"""Mixing sources to target weights by pivotal dependent rounding.

A source's target is a share of all words; each of its documents should be taken target / size times. The whole part
is certain, the rest is a probability. Two documents at a time, one gives the other as many expected words as make
one of the two probabilities 0 or 1, in either direction with the odds that leave each document's expectation as it
was; the expected words of the source never change. Documents meet in groups of bounded size; what is left undecided
of each group, one document, meets the rest of other groups on the next level of the reduction tree, up to one
document per source, whose probability is rounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchpath.llm.common import unused, words_of, written

# documents that meet in one group
GROUP = 64

WEIGHTS = (3, 1, 2)  # of the sources in order of name, repeating
SHARE = 1.5  # words of the mix, as a part of all words
MOST = 2.0  # times a source can be taken


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, documents, target`` from rows ``source, size``.

    Sources in code point order, null last, weigh ``WEIGHTS`` in turn. A source whose share is above ``MOST`` times
    its size stops there; the others share the excess. The windows run over one row per source.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS)))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (turn + 1).cast("int")).cast("double")
    weighed = sources.withColumn("weight", weight).withColumn("cap", MOST * F.col("source_size"))
    all_ = Window.partitionBy()
    room = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = room.rowsBetween(Window.unboundedPreceding, -1)
    left = SHARE * F.sum("source_size").over(all_) - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))
    open_weight = F.sum("weight").over(all_) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    # words per unit of weight if the sources before, in order of room, are full; the first source with room decides
    shared = weighed.withColumn("unit", left / open_weight).withColumn("place", F.row_number().over(room))
    roomy = F.when(F.col("cap") > F.col("unit") * F.col("weight"), F.struct("place", "unit"))
    unit = F.min(roomy).over(all_)["unit"]
    target = F.coalesce(F.least(F.col("cap"), unit * F.col("weight")), F.col("cap"))
    return shared.select("source", "source_size", "documents", target.alias("target"))


def _draw(seed: int, level: int, one: Column, two: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(level), one, two), F.lit(2**31)) / F.lit(float(2**31))


def _meet(carried: Column, met: Column, seed: int, level: int) -> tuple[Column, Column]:
    """The two documents after a transfer: the one decided, with its p 0 or 1, and the one that goes on."""
    p, q = carried["p"], met["p"]
    ratio = met["size"] / carried["size"]
    raise_, lower = F.least(1 - p, q * ratio), F.least(p, (1 - q) * ratio)
    up = F.coalesce(_draw(seed, level, carried["key"], met["key"]) < lower / F.nullif(raise_ + lower, F.lit(0.0)), F.lit(False))
    first_ends = F.when(up, 1 - p <= q * ratio).otherwise(p <= (1 - q) * ratio)

    def with_p(item: Column, value: Column) -> Column:
        inside = F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))
        return F.struct(item["size"].alias("size"), item["key"].alias("key"), item["doc_id"].alias("doc_id"), inside.alias("p"))

    moved_p = F.when(up, p + raise_).otherwise(p - lower)
    moved_q = F.when(up, q - raise_ / ratio).otherwise(q + lower / ratio)
    one, zero = F.lit(1.0), F.lit(0.0)
    decided = F.when(first_ends, with_p(carried, F.when(up, one).otherwise(zero))).otherwise(
        with_p(met, F.when(up, zero).otherwise(one))
    )
    going_on = F.when(first_ends, with_p(met, moved_q)).otherwise(with_p(carried, moved_p))
    return decided, going_on


_ITEM = "struct<size:bigint,key:bigint,doc_id:bigint,p:double>"


def _reduce(items: Column, seed: int, level: int) -> Column:
    """All documents of a group, largest first: ``done`` and the one left, ``rest``."""

    def merge(state: Column, item: Column) -> Column:
        decided, going_on = _meet(state["rest"], item, seed, level)
        return F.struct(F.concat(state["done"], F.array(decided)).alias("done"), going_on.alias("rest"))

    ordered = F.sort_array(items, asc=False)
    start = F.struct(F.array().cast(f"array<{_ITEM}>").alias("done"), F.element_at(ordered, 1).cast(_ITEM).alias("rest"))
    return F.aggregate(F.slice(ordered, 2, F.greatest(F.size(ordered) - 1, F.lit(0))), start, merge)


def copies(sizes: DataFrame, seed: int = 0) -> DataFrame:
    """``doc_id, source, copies`` for each pair in ``doc_id, source, size``, with the source's figures.

    Rows with the same doc_id and source are one document of their common size and get the same copies. Documents
    without words and those of sources without words get the whole part of their copies, which nothing depends on.
    The same rows give the same copies in any order and partitioning.
    """
    units = sizes.groupBy("doc_id", "source").agg(F.sum("size").alias("size"))
    by_source = targets(sizes)
    known = units.alias("u").join(by_source.alias("s"), F.col("u.source").eqNullSafe(F.col("s.source")))
    expected = F.coalesce(F.col("target") / F.nullif("source_size", F.lit(0)), F.lit(0.0))
    whole = F.floor(expected + 1e-12)
    part = expected - whole
    split = known.select(
        "u.doc_id", "u.source", "size", "source_size", "target", whole.cast("int").alias("whole"),
        F.when((part > 1e-9) & (F.col("size") > 0), part).alias("p"),
        F.xxhash64(F.lit(seed), "u.doc_id", "u.source").alias("key"),
        F.ceil(F.col("documents") / GROUP).cast("bigint").alias("groups"),
    )
    split = written(split, "units")
    most = split.where("p is not null").agg(F.max("groups")).first()[0] or 0
    level, group = 0, F.pmod("key", F.col("groups"))
    item = F.struct("size", "key", "doc_id", "p")
    facts = ["source", "source_size", "target", "whole"]
    open_ = split.where("p is not null").select(*facts, group.alias("group"), item.alias("item"))
    fixed = split.where("p is null").select("doc_id", *facts, F.col("whole").alias("copies"))
    parts = [fixed]
    while most:
        grouped = open_.groupBy(*facts, "group").agg(F.collect_list("item").alias("items"))
        level_done = written(grouped.select(*facts, "group", _reduce(F.col("items"), seed, level).alias("r")), "level")
        done = level_done.select(*facts, F.explode("r.done").alias("item"))
        if most == 1:  # a group per source: the last document is rounded
            last = level_done.select(*facts, F.struct("r.rest.size", "r.rest.key", "r.rest.doc_id", F.round("r.rest.p").alias("p")).alias("item"))
            done = done.unionAll(last)
        parts.append(done.select("item.doc_id", *facts, (F.col("whole") + F.col("item.p").cast("int")).alias("copies")))
        if most == 1:
            break
        open_ = level_done.select(*facts, F.floor(F.col("group") / GROUP).alias("group"), F.col("r.rest").alias("item"))
        most, level = -(-most // GROUP), level + 1
    out = parts[0]
    for part_ in parts[1:]:
        out = out.unionByName(part_)
    return out.drop("whole")


def sizes_of(documents: DataFrame) -> DataFrame:
    size = F.size(words_of(F.col("text"))).cast("bigint")
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"))


def mix_report(documents: DataFrame, seed: int = 0) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of each row: its words, its source's, the source's target, and the
    words that the mix takes of it, repeats counted (0, 1 or 2 times its size).

    A null text has no words; a null source is a source of its own, the last. Repeated rows stay and are taken
    alike. If no document has words, all targets and takings are 0; an empty table gives an empty table.
    """
    sizes = written(sizes_of(documents), "sizes")
    chosen = copies(sizes, seed)
    same = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & F.col("d.source").eqNullSafe(F.col("c.source"))
    return sizes.alias("d").join(chosen.alias("c"), same).select(
        "d.doc_id", "d.size", "source_size", "target", (F.col("d.size") * F.col("copies")).alias("taken")
    )


def mix(documents: DataFrame, seed: int = 0) -> DataFrame:
    """The mix itself: each row as often as it is taken, with all its columns, whatever their names."""
    chosen = copies(written(sizes_of(documents), "sizes"), seed).where("copies > 0")
    doc_id, source, times, turn = (unused(documents, name) for name in ("_id", "_source", "_copies", "_turn"))
    chosen = chosen.select(F.col("doc_id").alias(doc_id), F.col("source").alias(source), F.col("copies").alias(times))
    same = F.col("doc_id").eqNullSafe(F.col(doc_id)) & F.col("source").eqNullSafe(F.col(source))
    taken = documents.join(chosen, same).withColumn(turn, F.explode(F.sequence(F.lit(1), times)))
    return taken.select(*[F.col(f"`{name}`") for name in documents.columns])
