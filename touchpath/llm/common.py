"""What several operators of this package share: written intermediate tables, words, Arrow helpers."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

# characters that part words; everything else belongs to a word
SPACE = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]+"

_folders: dict[str, str] = {}
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="touchpath-code-")) / "touchpath.zip"  # read by the driver alone
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only a session on one machine may lack the setting; it gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _folders.setdefault(context.applicationId, tempfile.mkdtemp(prefix="touchpath-"))
    return f"{folder.rstrip('/')}/{context.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses. The folder carries the application's id, so
    that everything an application left can be deleted together after its end."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` as a Parquet table in the shared folder: cuts the lineage and survives lost executors."""
    spark = frame.sparkSession
    path = new_path(spark, name)
    frame.write.parquet(path)
    table = spark.read.schema(frame.schema).parquet(path)
    table._written_at = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._written_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def extended(schema: StructType, **kinds: DataType) -> StructType:
    """A schema with more columns after its own."""
    return StructType([*schema.fields, *[StructField(name, kind) for name, kind in kinds.items()]])


def unused(documents: DataFrame, name: str) -> str:
    """A column name that ``documents`` does not have."""
    taken = {column.lower() for column in documents.columns}
    while name.lower() in taken:
        name += "_"
    return name


def portions(batches: Iterator[pa.RecordBatch], rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what Python holds of them at once stays small.

    After the last one, freed memory goes back to the system: the worker may wait long, or do other work.
    """
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    batch = None
    pa.default_memory_pool().release_unused()


def utf8(column: pa.Array) -> list[bytes]:
    """The values of a string column as UTF-8 bytes; null is empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finalising steps of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Words of a text, in order; an empty array for null and for texts without words."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS))
