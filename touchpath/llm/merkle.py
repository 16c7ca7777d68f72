"""A hash tree over a dataset, stored in blocks laid out after van Emde Boas.

The leaves of a tree are cut into aligned blocks of 2 ** BLOCK leaves; a block holds the whole subtree above them, and
the roots of the blocks are the leaves of the next level of blocks, until one block is left. Within a block the subtree
is split at half its height, again and again: first the upper half, then the lower subtrees from left to right, each in
the same way. Where a node lies follows by arithmetic alone; building a block and reading the siblings of a leaf both go
through it, and both touch few cache lines whatever their size.

Trees exist per language; the roots of these are the leaves of one more tree, built by the same functions.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from touchpath.llm.common import extended, written

BLOCK = 10  # levels of nodes below a block's root

BLOCK_SCHEMA = "tree string, block bigint, n bigint, members bigint, height int, nodes binary, digest string"


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of nodes, given by depth and number from the left, in a subtree of ``levels`` levels."""
    if levels == 1:
        return np.zeros_like(index)
    upper = levels // 2
    if depth < upper:
        return address(upper, depth, index)
    lower = levels - upper
    below = depth - upper
    within = address(lower, below, index & ((1 << below) - 1))
    return (1 << upper) - 1 + (index >> below) * ((1 << lower) - 1) + within


@lru_cache(maxsize=64)
def _addresses(levels: int) -> list[list[int]]:
    """Places of all nodes, by depth. At most 2 ** (BLOCK + 1) numbers for each height of block."""
    return [address(levels, depth, np.arange(1 << depth)).tolist() for depth in range(levels)]


def _counts(members: int, height: int) -> list[int]:
    """Nodes at each depth over so many leaves."""
    return [-(-members // (1 << (height - depth))) for depth in range(height + 1)]


def build_block(leaves: list[str], height: int) -> list[str]:
    """The subtree over ``leaves`` in its layout; places without a node are empty. A node over a single child is the
    hash of that child."""
    places, counts = _addresses(height + 1), _counts(len(leaves), height)
    nodes = [""] * ((2 << height) - 1)
    for place, leaf in zip(places[height], leaves):
        nodes[place] = leaf
    for depth in range(height - 1, -1, -1):
        below = places[depth + 1]
        for i in range(counts[depth]):
            pair = nodes[below[2 * i]] + nodes[below[2 * i + 1]]
            nodes[places[depth][i]] = sha256(pair.encode()).hexdigest()
    return nodes


def siblings(nodes: bytes, members: int, height: int, leaf: int) -> list[str]:
    """Siblings of a leaf and of the nodes above it up to the block's root: ``L`` or ``R`` and the digest, ``-`` where
    a node stands alone."""
    places, counts, found = _addresses(height + 1), _counts(members, height), []
    for depth in range(height, 0, -1):
        other = leaf ^ 1
        if other < counts[depth]:
            at = 32 * places[depth][other]
            found.append(("L" if other < leaf else "R") + nodes[at : at + 32].hex())
        else:
            found.append("-")
        leaf >>= 1
    return found


def fold(leaf: str, proof: str) -> str:
    """The root that a leaf and its siblings give."""
    for step in proof.split(",") if proof else ():
        if step[0] == "-":
            leaf = sha256(leaf.encode()).hexdigest()
        else:
            pair = step[1:] + leaf if step[0] == "L" else leaf + step[1:]
            leaf = sha256(pair.encode()).hexdigest()
    return leaf


def _blocks_of(nodes: DataFrame, block: int) -> DataFrame:
    """One row per aligned block over ``tree, place, n, digest``; n is the number of the tree's nodes at this level."""

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        n, members = table.column("n")[0].as_py(), table.num_rows
        height = block if n > 1 << block else (n - 1).bit_length()
        found = build_block(table.column("digest").to_pylist(), height)
        raw = b"".join(bytes.fromhex(node) if node else bytes(32) for node in found)
        row = [table.column("tree")[0].as_py(), table.column("block")[0].as_py(), n, members, height, raw, found[0]]
        names = [name.split()[0] for name in BLOCK_SCHEMA.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.string()]
        return pa.table({name: pa.array([value], kind) for name, value, kind in zip(names, row, kinds)})

    numbered = nodes.withColumn("block", F.shiftright("place", block))
    return numbered.groupBy("tree", "block").applyInArrow(build, BLOCK_SCHEMA)


def build_trees(nodes: DataFrame, block: int = BLOCK) -> list[DataFrame]:
    """Written tables of blocks, lowest level first, over leaves ``tree, place, n, digest``."""
    levels, most = [], nodes.agg(F.max("n")).first()[0] or 0
    while most:
        levels.append(written(_blocks_of(nodes, block), "merkle-blocks"))
        size = F.lit(1 << block)
        nodes = levels[-1].where(F.col("n") > size).select(
            "tree", F.col("block").alias("place"), F.ceil(F.col("n") / size).cast("bigint").alias("n"), "digest"
        )
        most = -(-most // (1 << block)) if most > 1 << block else 0
    return levels


def roots(levels: list[DataFrame], block: int = BLOCK) -> DataFrame:
    """``tree, subroot``: the digest of each tree's topmost block."""
    found = [level.where(F.col("n") <= F.lit(1 << block)).select("tree", F.col("digest").alias("subroot")) for level in levels]
    rows = found[0]
    for each in found[1:]:
        rows = rows.unionByName(each)
    return rows


def numbered(rows: DataFrame, order: list[str | Column]) -> DataFrame:
    """``rows`` with their ``place`` in their tree, from 0, and the tree's number of rows ``n``.

    Rows are sorted by tree and order over all tasks and written, so that the numbers are fixed; a table of one row
    per task and tree gives each task's first place. A tree may span all tasks, and many trees may share one.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # equal rows are interchangeable, but must not meet in one task only because they are equal
    apart = rows.withColumn("_apart", F.monotonically_increasing_id())
    ranges = apart.repartitionByRange(tasks, "tree", *order, "_apart").sortWithinPartitions("tree", *order, "_apart")
    table = written(ranges.drop("_apart").withColumn("_at", F.monotonically_increasing_id()), "merkle-leaves")
    task = F.shiftright("_at", 33).alias("_task")
    parts = table.groupBy("tree", task).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    tree = Window.partitionBy("tree")  # as many rows as tasks
    before = F.sum("_n").over(tree.orderBy("_task").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    offsets = written(parts.select("tree", "_task", "_first", before.alias("_before"), F.sum("_n").over(tree).alias("n")), "merkle-offsets")
    return (
        table.withColumn("_task", F.shiftright("_at", 33))
        .join(offsets, ["tree", "_task"])
        .withColumn("place", F.col("_at") - F.col("_first") + F.col("_before"))
        .drop("_at", "_task", "_first", "_before")
    )


def _paths_below(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The lowest blocks with the path from their root upwards. ``tops``: ``tree, path`` and what to carry along."""
    carried = [name for name in tops.columns if name not in ("tree", "path")]
    above = None
    for number in range(len(levels) - 1, -1, -1):
        level = levels[number]
        # the topmost block of a tree hangs on the tree's own path
        ends = level.where((F.col("block") == 0) & (F.col("n") <= F.col("members"))).select("tree", "block")
        here = ends.join(tops, "tree")
        if above is not None:
            here = here.unionByName(above)
        blocks = level.join(here, ["tree", "block"])
        if number == 0:
            return blocks
        above = written(_children(blocks, carried), "merkle-paths")
    raise ValueError("no levels")


def _children(blocks: DataFrame, carried: list[str]) -> DataFrame:
    """``tree, block, path`` of the blocks below: members of a block, each with its siblings and the block's path."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                members = row["members"]
                paths = [
                    _joined(siblings(row["nodes"], members, row["height"], leaf), row["path"]) for leaf in range(members)
                ]
                first = row["block"] << row["height"]
                columns = [pa.array([row["tree"]] * members, pa.string())]
                columns += [pa.array(range(first, first + members), pa.int64()), pa.array(paths, pa.string())]
                columns += [pa.array([row[name]] * members, pa.string()) for name in carried]
                yield pa.RecordBatch.from_arrays(columns, ["tree", "block", "path", *carried])

    return blocks.mapInArrow(work, ", ".join(["tree string", "block bigint", "path string", *[f"{c} string" for c in carried]]))


def _joined(steps: list[str], path: str) -> str:
    return ",".join([*steps, path] if path else steps)


def _proofs(leaves: DataFrame, blocks: DataFrame, kept: list[str], carried: list[str], block: int) -> DataFrame:
    """``leaves`` with the ``proof`` of each, read from its block."""
    schema = extended(leaves.select(*kept).schema, proof=StringType(), **{name: StringType() for name in carried})

    def read(left: pa.Table, right: pa.Table) -> pa.Table:
        row = right.to_pylist()[0]
        proofs = [
            _joined(siblings(row["nodes"], row["members"], row["height"], place & ((1 << block) - 1)), row["path"])
            for place in left.column("place").to_pylist()
        ]
        out = left.select(kept).append_column("proof", pa.array(proofs, pa.string()))
        for name in carried:
            out = out.append_column(name, pa.array([row[name]] * left.num_rows, pa.string()))
        return out

    keyed = leaves.withColumn("block", F.shiftright("place", block))
    return keyed.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(read, schema)


def manifest(leaves: DataFrame, order: list[str], block: int = BLOCK) -> DataFrame:
    """Proofs of all rows of ``leaves``: its columns, then ``subroot, root, proof``.

    ``leaves`` has ``tree`` (a text; trees are ordered by its bytes), ``digest`` and columns by whose values, nulls
    first, then by digest, the leaves of a tree are ordered. Rows that agree in all of these are different leaves in
    any order. The proof lists the siblings from the leaf up to the root, ``L`` or ``R`` and the digest, ``-`` where a
    node has none. An empty table has no root and gives no rows.
    """
    kept = leaves.columns
    placed = numbered(leaves, [*order, "digest"])
    levels = build_trees(placed, block)
    if not levels:
        schema = extended(leaves.schema, subroot=StringType(), root=StringType(), proof=StringType())
        return leaves.sparkSession.createDataFrame([], schema)
    subroots = roots(levels, block).select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("subroot").alias("digest"))
    crown = numbered(subroots, ["of"])
    upper = build_trees(crown, block)
    whole = roots(upper, block).select("tree", F.col("subroot").alias("root"), F.lit("").alias("path"))
    tops = _proofs(crown, _paths_below(upper, whole), ["of", "digest"], ["root"], block)
    tops = written(
        tops.select(F.col("of").alias("tree"), F.col("proof").alias("path"), F.col("digest").alias("subroot"), "root"), "merkle-roots"
    )
    lowest = written(_paths_below(levels, tops), "merkle-lowest")
    return _proofs(placed, lowest, kept, ["subroot", "root"], block).select(*kept, "subroot", "root", "proof")


def with_folded(rows: DataFrame, leaf: str) -> DataFrame:
    """``rows`` with ``folded_root``: what the column ``leaf`` and the ``proof`` give."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = map(fold, batch.column(leaf).to_pylist(), batch.column("proof").to_pylist())
            columns = [*batch.columns, pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "folded_root"])

    return rows.mapInArrow(work, extended(rows.schema, folded_root=StringType()))


def record_digest(*values: Column) -> Column:
    """SHA-256 of a record: ``-`` for null, else the value's length in bytes, a colon and the value."""
    parts = []
    for value in values:
        text = value.cast("string")
        length = F.octet_length(text).cast("string")
        parts.append(F.coalesce(F.concat(length, F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def document_manifest(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof, folded_root, verified`` of each row of ``documents``.

    A leaf is the digest of doc_id, source, lang, n_chars and text. Trees exist per lang, null first, then by UTF-8
    bytes, with leaves by doc_id (nulls first), then by digest; repeated rows are leaves of their own. The root is
    checked again from each leaf and its siblings; where 7 divides the checksum of the decimal doc_id the leaf is that
    of a record with 1 more in n_chars, so the check fails unless n_chars is null. Rows without doc_id are never
    changed. Extra columns are not looked at.
    """
    column = {name: F.col(name) for name in ("doc_id", "source", "lang", "n_chars", "text")}
    chosen = F.crc32(column["doc_id"].cast("string").cast("binary")) % 7 == 0
    changed = column | {"n_chars": column["n_chars"].cast("bigint") + 1}
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    digest = record_digest(*column.values())
    leaves = documents.select(
        tree.alias("tree"),
        "doc_id",
        digest.alias("digest"),
        F.when(chosen, record_digest(*changed.values())).alias("_changed"),
    )
    # the digests are taken once, from one read of the texts
    leaves = written(leaves.withColumn("_changed", F.coalesce("_changed", "digest")), "merkle-digests")
    found = with_folded(manifest(leaves, ["doc_id"], block), "_changed")
    return found.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", "proof", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
