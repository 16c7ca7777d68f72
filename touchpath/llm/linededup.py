"""Lines that many documents hold, found with levelled sorted runs of line hashes.

The index is a list of levels. A run is a table of line hashes, stored in buckets by hash and sorted within them, with
the document that owns the line and the number of documents seen with it. A batch of documents is reduced to one row
per line; those rows are merge-anti-joined with every run, and what no run holds is fresh: the batch owns it. Fresh
rows, and the counts of the lines that an older run owns, are the batch's own run. When a level holds ``FAN`` runs they
are merged into one run of the next level, so that b batches are compared with FAN * log(b) runs, not b.

All runs have the same buckets, so the joins do not move a stored row. Merging runs deals their rows by hash once more:
Spark 4.1 takes a union of bucketed tables for placed by hash when it is not, so a merge reads the files without them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from touchpath.llm.common import SPACE, extended, new_path, portions, release, utf8, written

LEAST_CHARS = 40
LEAST_DOCUMENTS = 5
BATCHES = 8
FAN = 3

HASH = ["h1", "h2"]


def line_key(line: bytes) -> bytes:
    """A line without white space at its ends, A-Z in lower case."""
    return line.strip(SPACE.encode()).lower()


def key_hash(key: bytes) -> bytes:
    """128 bits: lines are told apart by them alone."""
    return xxhash.xxh3_128_digest(key)


class Runs:
    """The levelled index. Its state is the list of its runs: tables ``h1, h2, owner, n`` in the shared folder."""

    def __init__(self, spark: SparkSession, fan: int = FAN):
        self.spark, self.fan = spark, fan
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []

    @property
    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _stored(self, rows: DataFrame) -> DataFrame:
        """Written in buckets by hash, one sorted file per bucket; ``rows`` are dealt by hash."""
        name, path = f"line_run_{uuid.uuid4().hex}", new_path(self.spark, "line-run")
        rows.select(*HASH, "owner", "n").write.bucketBy(self.buckets, *HASH).sortBy(*HASH).option("path", path).saveAsTable(name)
        table = self.spark.table(name)
        table._written_at, table._name = path, name
        return table

    def _forget(self, *runs: DataFrame) -> None:
        for run in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {run._name}")
        release(*runs)

    def add(self, keys: DataFrame) -> None:
        """Add a batch: ``doc_id, h1, h2``, one row per document and line, whose documents no other batch holds."""
        counted = self._stored(keys.groupBy(*HASH).agg(F.max("doc_id").alias("owner"), F.count("*").alias("n")))
        fresh, known = counted, []
        for run in self.runs:
            owned = run.where(F.col("owner").isNotNull()).select(*HASH)
            fresh = fresh.join(owned, HASH, "left_anti")
            # a line has one owner, so it is in one of these at most
            known.append(counted.join(owned, HASH, "left_semi").withColumn("owner", F.lit(None).cast("bigint")))
        own = fresh
        for each in known:
            own = own.unionByName(each)
        if known:
            own = self._stored(own.repartition(self.buckets, *HASH))
            self._forget(counted)
        self._push(0, own)

    def _push(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fan:
            merging, self.levels[level] = self.levels[level], []
            self._push(level + 1, self._stored(self._merged(merging)))
            self._forget(*merging)

    def merged(self) -> DataFrame | None:
        """One row per line over all batches; None before the first."""
        return self._merged(self.runs) if self.runs else None

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        # a line has one row in each run, so no task gets more than a few of it
        rows = self.spark.read.schema(runs[0].schema).parquet(*[run._written_at for run in runs])
        return rows.groupBy(*HASH).agg(F.max("owner").alias("owner"), F.sum("n").alias("n"))

    def close(self) -> None:
        """Delete the runs."""
        self._forget(*self.runs)
        self.levels = []


def document_lines(documents: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``doc_id, h1, h2``: one row per document and line of at least ``least_chars`` code points."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 500):
            ids, hashes = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                keys = {key for key in map(line_key, text.split(b"\n")) if _is_long(key, least_chars)}
                ids += [doc_id] * len(keys)
                hashes += map(key_hash, keys)
            halves = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            columns = [pa.array(ids, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *HASH])

    held = documents.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return held.mapInArrow(work, "doc_id bigint, h1 bigint, h2 bigint").distinct()


def _is_long(key: bytes, least_chars: int) -> bool:
    # a code point has one byte or more, and one only that is no continuation
    return len(key) >= least_chars and (len(key) >= 4 * least_chars or len(key.decode()) >= least_chars)


def common_lines(lines: DataFrame, least_documents: int = LEAST_DOCUMENTS, batches: int = BATCHES) -> DataFrame:
    """``h1, h2, owner`` of the lines that at least ``least_documents`` documents hold; the owner is the largest
    doc_id that holds one. ``lines`` is a written table.

    Batches are ranges of doc_id of about equal length, from the largest down, so that the first batch that holds a
    line holds its owner. Equal doc_ids fall in one batch, so a document is counted once.
    """
    spark = lines.sparkSession
    # at most ``batches`` numbers; they need not be exact, only the same for all rows
    cuts = [i / batches for i in range(1, batches)]
    edges = lines.agg(F.percentile_approx("doc_id", cuts, 1_000)).first()[0] if cuts else None
    edges = sorted(set(edges or ()))
    number = F.lit(0)
    for edge in edges:
        number = number + (F.col("doc_id") > F.lit(edge)).cast("int")
    index = Runs(spark)
    for batch in range(len(edges), -1, -1):
        index.add(lines.where(number == batch))
    found = index.merged().where(F.col("n") >= least_documents).select(*HASH, "owner")
    common = written(found, "common-lines")
    index.close()
    return common


def without_common_lines(
    documents: DataFrame,
    least_chars: int = LEAST_CHARS,
    least_documents: int = LEAST_DOCUMENTS,
    batches: int = BATCHES,
) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept``: each row's text without the lines that ``least_documents`` documents hold,
    but for the document with the largest doc_id among them, which keeps all of its own.

    A line's key is the line without ``[\\x20\\x09-\\x0D]`` at its ends, A-Z in lower case; keys shorter than
    ``least_chars`` code points always stay. Null and empty texts are one empty line. Rows with the same doc_id are one
    document when documents are counted and each lose their lines. Rows without doc_id hold no line of anyone's and
    keep all of theirs. An empty table gives an empty one; other columns are not looked at.

    A line that a third of all documents hold is reduced before the shuffle when it is counted; where it is joined
    back, its rows stand on the large side of a plain sort-merge join, which Spark splits.
    """
    lines = written(document_lines(documents, least_chars), "document-lines")
    common = common_lines(lines, least_documents, batches)
    losing = lines.join(common, HASH).where(F.col("doc_id") != F.col("owner"))
    # no more entries than the document has lines
    lists = losing.groupBy("doc_id").agg(F.collect_set(F.struct(*HASH)).alias("_losing"))
    lists = written(lists.withColumnRenamed("doc_id", "_of"), "losing-lines")
    # always by sorting: whether the lists happen to be small must not change how the texts travel
    rows = documents.select("doc_id", "text").join(
        lists.hint("merge"), F.col("doc_id").cast("bigint") == F.col("_of"), "left"
    )
    whole = F.coalesce("text", F.lit(""))
    n_lines = (F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1).cast("bigint")
    judged = rows.select("doc_id", whole.alias("kept"), n_lines.alias("n_lines"), "_losing")
    kind = judged.select("doc_id").schema
    return judged.mapInArrow(_drop, extended(kind, n_lines=LongType(), n_dropped=LongType(), kept=StringType()))


def _drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in portions(batches, 500):
        texts, dropped = utf8(batch.column(1)), []
        for i, losing in enumerate(batch.column(3).to_pylist()):
            if losing is None:
                dropped.append(0)
                continue
            gone = {np.array([each["h1"], each["h2"]]).tobytes() for each in losing}
            lines = texts[i].split(b"\n")
            kept = [line for line in lines if key_hash(line_key(line)) not in gone]
            texts[i] = b"\n".join(kept)
            dropped.append(len(lines) - len(kept))
        kept = pa.array(texts, pa.binary()).cast(pa.string())
        columns = [batch.column(0), batch.column(2), pa.array(dropped, pa.int64()), kept]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_lines", "n_dropped", "kept"])
