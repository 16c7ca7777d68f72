"""Shards of near equal bytes by a k-d tree over document metadata.

Each node of the tree is split at a weighted median along its widest dimension until the leaves hold the target
bytes. The medians of all nodes of a level are found together: tasks count the bytes of equal ranges of the values,
the range that holds the median is cut again, until one value is left; documents with that value are parted by their
id in the same way. What reaches the driver is a bounded histogram of the open nodes, never rows; rows are not
shuffled while the tree grows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType
from pyspark.sql.window import Window

from touchpath.llm.common import extended, written
from touchpath.operators.skew import if_small

# ranges counted per open node and pass
RANGES = 2_048

# documents that get their slots in one task, about
SLOTS_PER_TASK = 20_000


DIMENSIONS = ["source", "lang", "size", "doc_id"]


def numbered(names: DataFrame) -> DataFrame:
    """``name, number``: the distinct values of the only column, numbered from 0 in code point order, null first.

    Names are sorted by range, and a name's number is its place in its task plus the names of the tasks before. The
    window runs over one row per task.
    """
    sorted_ = names.toDF("name").distinct().repartitionByRange("name").sortWithinPartitions("name")
    placed = written(sorted_.withColumn("at", F.monotonically_increasing_id()), "names")  # task in the upper bits
    placed = placed.select("name", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND(F.lit(2**33 - 1)).alias("place"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("part").agg(F.count("*").alias("n"))
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return placed.join(offsets, "part").select("name", (F.col("offset") + F.col("place")).alias("number"))


def metadata(documents: DataFrame) -> DataFrame:
    """``d0`` to ``d3``, the dimensions of each row as numbers, ``weight, text_crc32, doc_id``, written."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    crc = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32")
    doc_id = F.col("doc_id").cast("bigint")
    names = [F.col(name).cast("string").alias(name) for name in DIMENSIONS[:2]]
    key = F.coalesce(doc_id, F.lit(-1).cast("bigint")).alias("d3")
    table = documents.select(*names, size.alias("d2"), key, (size + 1).alias("weight"), crc, doc_id.alias("doc_id"))
    for i, name in enumerate(DIMENSIONS[:2]):
        numbers = numbered(documents.select(F.col(name).cast("string"))).withColumnRenamed("number", f"d{i}")
        table = table.join(if_small(numbers), table[name].eqNullSafe(numbers["name"])).drop(name, "name")
    return written(table.select(*[f"d{i}" for i in range(len(DIMENSIONS))], "weight", "text_crc32", "doc_id"), "metadata")


@dataclass
class Node:
    """A leaf, or a split: rows whose (value, id) is below ``at``, or equal to it if ``inclusive``, go left."""

    first: int  # shards of the node: first to first + shards - 1
    shards: int
    dimension: int = -1
    at: tuple[int, int] = (0, 0)
    inclusive: bool = True
    children: list[int] = field(default_factory=list)  # places of the left and right node


@dataclass
class Search:
    """A median being looked for: of ``key`` 0 the value, 1 the id, between ``low`` and ``high``."""

    node: int
    dimension: int
    want: int  # bytes that shall go left
    low: int
    high: int
    ids: tuple[int, int]
    key: int = 0
    below: int = 0  # bytes below ``low``
    value: int = 0

    @property
    def width(self) -> int:
        return max(1, -(-(self.high - self.low + 1) // RANGES))


def _leaves(tree: list[Node], values: np.ndarray) -> np.ndarray:
    """Place of the leaf of each row; ``values`` has a column per dimension, the id last."""
    at = np.zeros(len(values), np.int64)
    for place, node in enumerate(tree):  # parents come before their children
        if node.children:
            rows = np.flatnonzero(at == place)
            value, ids = values[rows, node.dimension], values[rows, -1]
            low, mark = node.at
            left = (value < low) | ((value == low) & ((ids <= mark) if node.inclusive else (ids < mark)))
            at[rows] = np.where(left, node.children[0], node.children[1])
    return at


def _matrix(batch: pa.RecordBatch, columns: int) -> np.ndarray:
    return np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(columns)])


def _extents(table: DataFrame, tree: list[Node], names: list[str]) -> dict[int, tuple]:
    """Of each leaf: bytes, rows, least and greatest value of each dimension."""
    n = len(names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, weights = _matrix(batch, n), batch.column(n).to_numpy()
            leaves = _leaves(tree, values)
            for leaf in np.unique(leaves):
                own = values[leaves == leaf]
                row = [leaf, weights[leaves == leaf].sum(), len(own), *own.min(0), *own.max(0)]
                yield pa.RecordBatch.from_pylist([{name: int(x) for name, x in zip(fields, row)}])

    fields = ["leaf", "bytes", "rows", *[f"low{i}" for i in range(n)], *[f"high{i}" for i in range(n)]]
    found = table.mapInArrow(work, ", ".join(f"{name} bigint" for name in fields)).groupBy("leaf")
    sums = [F.sum("bytes"), F.sum("rows")]
    sums += [F.min(f"low{i}") for i in range(n)] + [F.max(f"high{i}") for i in range(n)]
    return {row[0]: (row[1], row[2], row[3 : 3 + n], row[3 + n :]) for row in found.agg(*sums).collect()}


def _histogram(table: DataFrame, tree: list[Node], names: list[str], open_: list[Search]) -> dict[int, dict[int, int]]:
    """Bytes per range of each open search."""
    n = len(names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {search.node: np.zeros(RANGES, np.int64) for search in open_}
        for batch in batches:
            values, weights = _matrix(batch, n), batch.column(n).to_numpy()
            leaves = _leaves(tree, values)
            for search in open_:
                rows = leaves == search.node
                if search.key:
                    rows &= values[:, search.dimension] == search.value
                key = values[rows, -1 if search.key else search.dimension]
                inside = (key >= search.low) & (key <= search.high)
                offset = key[inside].view(np.uint64) - np.array(search.low).view(np.uint64)
                ranges = (offset // np.uint64(search.width)).astype(np.int64)
                np.add.at(sums[search.node], ranges, weights[rows][inside])
        for node, found in sums.items():
            full = np.flatnonzero(found)
            columns = [pa.array(np.full(len(full), node)), pa.array(full), pa.array(found[full])]
            yield pa.RecordBatch.from_arrays(columns, ["node", "place", "bytes"])

    rows = table.mapInArrow(work, "node bigint, place bigint, bytes bigint").groupBy("node", "place")
    out: dict[int, dict[int, int]] = {search.node: {} for search in open_}
    for row in rows.agg(F.sum("bytes").alias("bytes")).collect():  # at most RANGES rows per open node
        out[row.node][row.place] = row.bytes
    return out


def _narrow(search: Search, counts: dict[int, int]) -> Node | None:
    """Go on in the range that holds the median; the split if a single key is left."""
    place = found = max(counts)
    for place in sorted(counts):
        found = counts[place]
        if search.below + found >= search.want:
            break
        if place != max(counts):
            search.below += found
    width, low = search.width, search.low
    search.low = low + place * width
    search.high = min(search.low + width - 1, search.high)
    if search.low < search.high:
        return None
    if not search.key:
        search.key, search.value, (search.low, search.high) = 1, search.low, search.ids
        return None
    inclusive = search.below + found - search.want <= search.want - search.below
    return Node(0, 0, search.dimension, (search.value, search.low), inclusive)


def grow(table: DataFrame, names: list[str], shards: int) -> tuple[list[Node], int]:
    """The tree over ``table``: a column per dimension (the last is the id), then the weight. Also the rows."""
    tree = [Node(0, shards)]
    extents = _extents(table, tree, names)
    rows = extents[0][1] if extents else 0
    root = extents.get(0)
    while root:
        searches = []
        for place, node in enumerate(tree):
            if node.children or node.shards < 2 or place not in extents:
                continue
            total, _, lows, highs = extents[place]
            wide = [(highs[i] - lows[i]) / max(1, root[3][i] - root[2][i]) for i in range(len(names))]
            dimension = int(np.argmax(wide))
            want = total * (node.shards // 2) // node.shards
            searches.append(Search(place, dimension, want, lows[dimension], highs[dimension], (lows[-1], highs[-1])))
        if not searches:
            break
        splits: dict[int, Node] = {}
        while searches:
            counts = _histogram(table, tree, names, searches)
            for search in searches:
                split = _narrow(search, counts[search.node])
                if split:
                    splits[search.node] = split
            searches = [search for search in searches if search.node not in splits]
        for place, split in splits.items():
            node, left = tree[place], tree[place].shards // 2
            node.dimension, node.at, node.inclusive = split.dimension, split.at, split.inclusive
            node.children = [len(tree), len(tree) + 1]
            tree += [Node(node.first, left), Node(node.first + left, node.shards - left)]
        extents = _extents(table, tree, names)
    return tree, rows


def _with_shard(table: DataFrame, tree: list[Node], names: list[str]) -> DataFrame:
    n, columns = len(names), table.columns
    first = np.array([node.first for node in tree], np.int32)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = first[_leaves(tree, _matrix(batch, n))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard)], [*columns, "shard"])

    return table.mapInArrow(work, extended(table.schema, shard=IntegerType()))


def _with_slots(table: DataFrame, rows: int, shards: int) -> DataFrame:
    """A number in each shard, from 0 without gaps. Shards are numbered in cells, whose offsets are summed."""
    cells = max(1, -(-rows // (shards * SLOTS_PER_TASK)))
    dealt = table.withColumn("cell", F.pmod(F.xxhash64("key", "text_crc32", "size"), F.lit(cells)))
    counts = dealt.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("key", "text_crc32", "size"))
    numbered = dealt.withColumn("place", place.cast("bigint") - 1)
    return numbered.join(offsets, ["shard", "cell"]).withColumn("slot", F.col("offset") + F.col("place"))


def shard_documents(documents: DataFrame, shards: int = 16) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of each row; the bytes of the shards are near equal.

    ``size`` is the text's UTF-8 bytes plus 1 (null: 1). Dimensions are source and language, as the numbers of their
    names in order, bytes and id, each as wide as its part of the range over all documents. Equal texts are documents
    of their own: shards take them by their metadata, and no group of them is kept together. A split takes the document on its border to the nearer side, so
    that a shard is off by less than a document per level. Documents that agree in the split's value and in their
    id stay together: repeated rows land in one shard, and a table of one row repeated lands in few. Null ids,
    sources and languages sort first. An empty table gives an empty table; other columns are not looked at.
    """
    table = metadata(documents)
    tree, rows = grow(table.drop("text_crc32", "doc_id"), DIMENSIONS, shards)
    placed = _with_shard(table, tree, DIMENSIONS).select(
        "doc_id", F.col("d3").alias("key"), F.col("weight").alias("size"), "text_crc32", "shard"
    )
    return _with_slots(placed, rows, shards).select("doc_id", "size", "text_crc32", "shard", "slot")
