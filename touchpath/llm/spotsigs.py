"""Document fingerprints by spot signatures.

Wherever a common word stands (an anchor), the content words that follow it, common words left out, make a chain; the
anchor and its chain are one signature. Signatures stand where running text is, not where lists and menus are. A
fingerprint is the set of a text's signatures; two are compared by Jaccard similarity. Sets of very different sizes
cannot be alike: sets are numbered by ranges of size such that only equal or neighbouring numbers need comparing, and
a comparison stops as soon as the similarity asked for is out of reach. Alike texts are found in a whole corpus by
their rarest signatures: two sets that share enough share one of them.

Texts of languages whose common words are not listed have chains as well: where listed words are rare, one word in
eight, chosen by its hash, is taken for common.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchpath.llm import minhash
from touchpath.llm.common import portions, utf8, written
from touchpath.llm.shingles import joined, word_hashes

# fixed values: common words of the languages met
ANCHORS = (
    "the a an of and to in is that for it as was with be by on are this from at or "
    "der die das und den von zu mit ist ein eine im nicht "
    "de la le et les des un une que en dans pour est "
    "el los las y una por con se"
).split()

CHAIN = 3  # content words of a chain

# a text with fewer than one listed word in this many gets further anchors: the words whose hash divides by OTHER
RARE, OTHER = 16, np.uint64(8)

_PUNCTUATION = bytes(c for c in range(128) if not chr(c).isalnum())
_PLAIN = bytes.maketrans(
    _PUNCTUATION + bytes(range(65, 91)), b" " * len(_PUNCTUATION) + bytes(range(97, 123))
)  # A-Z to a-z, other ASCII characters than letters and digits to spaces
_ANCHOR_HASHES = np.sort(word_hashes([word.encode() for word in ANCHORS]))


def signatures(text: bytes) -> np.ndarray:
    """Sorted distinct signatures (64-bit hashes). A text with words but without a whole chain has one signature, of
    all its words; a text without words has none."""
    words = text.translate(_PLAIN).split()
    if not words:
        words = text.split()
        if not words:
            return np.empty(0, np.uint64)
    hashes = word_hashes(words)
    place = np.minimum(np.searchsorted(_ANCHOR_HASHES, hashes), len(_ANCHOR_HASHES) - 1)
    common = _ANCHOR_HASHES[place] == hashes
    if RARE * common.sum() < len(words):
        common |= hashes % OTHER == 0
    content = hashes[~common]
    anchors = np.flatnonzero(common)
    first = anchors - np.arange(len(anchors))  # content words before each anchor: where its chain begins
    whole = first + CHAIN <= len(content)
    if not whole.any():
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)], np.uint64)
    anchors, first = anchors[whole], first[whole]
    return np.unique(joined([hashes[anchors], *[content[first + i] for i in range(CHAIN)]]))


def partition_of(size: int, floor: float) -> int:
    """Number of the range of sizes: sets whose numbers differ by two or more have a similarity below ``floor``."""
    return int(math.log(size) / -math.log(floor)) if size and floor > 0 else 0


def similarity(one: np.ndarray, other: np.ndarray, floor: float = 0.0) -> float:
    """Jaccard similarity of two sorted sets; 0 where it cannot reach ``floor``. Two empty sets are alike."""
    small, large = (one, other) if len(one) <= len(other) else (other, one)
    if not len(small):
        return float(not len(large))
    if abs(partition_of(len(small), floor) - partition_of(len(large), floor)) > 1 or len(small) < floor * len(large):
        return 0.0
    shared = 0
    for start in range(0, len(small), 1024):  # what is left cannot make up for what has failed
        if floor and shared + len(small) - start < floor * (len(large) - shared):
            return 0.0
        piece = small[start : start + 1024]
        place = np.minimum(np.searchsorted(large, piece), len(large) - 1)
        shared += int((large[place] == piece).sum())
    found = shared / (len(small) + len(large) - shared)
    return found if found >= floor else 0.0


def digest(signs: np.ndarray) -> str:
    """A fingerprint as text: the number of its signatures and a hash of them."""
    return f"{len(signs)}:{xxhash.xxh3_128_hexdigest(signs.tobytes())}"


def _next_texts(documents: DataFrame) -> DataFrame:
    """Rows sorted by (doc_id, text) within partitions that follow each other, with the partition's number."""
    plain = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    return plain.repartitionByRange(*order).sortWithinPartitions(*order).select("*", F.spark_partition_id().alias("part"))


_RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_FIELDS = [part.split()[0] for part in _RESULT.split(", ")]


def _row(doc_id: int | None, text: str, signs: np.ndarray, following: str, next_signs: np.ndarray) -> tuple:
    taken = len(text) // 4
    edited = (text[: len(text) - taken] + following[:taken]).encode()
    edited_signs = signatures(edited)
    return (
        doc_id, len(text), hashlib.sha256(edited).hexdigest(), digest(signs), digest(edited_signs),
        similarity(signs, edited_signs), similarity(signs, next_signs),
    )


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"doc_id": pa.int64(), "n_chars": pa.int64(), "part": pa.int32(), "near_edited": pa.float64(), "near_next": pa.float64()}
    columns = [pa.array(list(values), kinds.get(name, pa.string())) for name, values in zip(names, zip(*rows))]
    return pa.RecordBatch.from_arrays(columns, names)


def neighbours(documents: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_chars``, SHA-256 of the edited text, both fingerprints, and the similarity of its
    fingerprint to the edited text's and to the next document's.

    Documents follow each other by ascending doc_id (null first, equal ids by a hash of their texts), after the last
    the first; a single document is its own next. The edited text has its last n_chars // 4 characters replaced by
    the first as many of the next document. A null text is empty. Repeated rows stay; an empty table gives an empty
    table; other columns are not looked at.

    The texts are shuffled once, by range of doc_id, and each task reads its sorted rows as a stream. Only the first
    and last rows of the partitions meet in a join.
    """
    sorted_ = _next_texts(documents)
    names = [*_FIELDS, "part", "first_text", "last_text"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row whose next is not known yet
        part, first_id, first_text = None, None, None
        for batch in portions(batches):
            rows = []
            for doc_id, text, part in zip(*[column.to_pylist() for column in batch.columns]):
                signs = signatures(text.encode())
                if held is None:
                    first_id, first_text = doc_id, text
                else:
                    rows.append((*_row(*held, text, signs), None, None, None))
                held = (doc_id, text, signs)
            if rows:
                yield _batch(rows, names)
        if held is not None:  # the partition's edges
            nothing = [None] * (len(_FIELDS) - 1)
            yield _batch([(held[0], *nothing, part, first_text, held[1])], names)

    found = written(sorted_.mapInArrow(work, f"{_RESULT}, part int, first_text string, last_text string"), "spots")
    edges = found.where("part is not null").select("doc_id", "part", "first_text", "last_text")
    # one row per partition: the one after, and the first after the last
    order = Window.orderBy("part")
    following = F.coalesce(F.lead("part").over(order), F.min("part").over(Window.partitionBy()))
    heads = edges.select(F.col("part").alias("next_part"), F.col("first_text").alias("next_text"))
    closed = edges.withColumn("next_part", following).join(heads, "next_part").select("doc_id", "last_text", "next_text")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            rows = []
            for doc_id, text, following in zip(*[column.to_pylist() for column in batch.columns]):
                rows.append(_row(doc_id, text, signatures(text.encode()), following, signatures(following.encode())))
            if rows:
                yield _batch(rows, _FIELDS)

    return found.where("part is null").select(*_FIELDS).unionAll(closed.mapInArrow(close, _RESULT))


def fingerprints(documents: DataFrame, percent: int = 80) -> DataFrame:
    """``doc_id, n, class, signatures, partition`` of each row: the set itself, its size, a hash that names it, and the
    number of its range of sizes for a similarity of ``percent`` %.

    A null text is empty and has no signatures (class null, partition 0); rows are treated one by one.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            sets = [signatures(text) for text in utf8(batch.column(1))]
            names = [xxhash.xxh3_64_intdigest(signs.tobytes()) - 2**63 if len(signs) else None for signs in sets]
            columns = [
                batch.column(0), pa.array([len(signs) for signs in sets], pa.int64()), pa.array(names, pa.int64()),
                pa.array([signs.view(np.int64) for signs in sets], pa.list_(pa.int64())),
                pa.array([partition_of(len(signs), percent / 100) for signs in sets], pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "class", "signatures", "partition"])

    chosen = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return chosen.mapInArrow(work, "doc_id bigint, n bigint, class bigint, signatures array<bigint>, partition int")


def _meetings(classes: DataFrame, percent: int) -> DataFrame:
    """``class, n, bucket``: where classes that may share ``percent`` % of their union meet.

    Two such sets share ``percent`` % of the larger, so each has a common signature among all but that many of its own
    in one order, less one. The order is by rarity, so that common phrases name no bucket; signatures of a single class
    fill places, but nobody meets there. A bucket is a signature and a partition: sets come to their own partition's
    and to the next, and one without a set of its own partition has no pair that another lacks.
    """
    each = classes.select("class", "n", "partition", F.explode("signatures").alias("signature"))
    held = each.groupBy("signature").agg(F.count("*").alias("classes"))
    shared = each.join(held.where("classes > 1"), "signature")
    in_class = Window.partitionBy("class")
    place = F.row_number().over(in_class.orderBy("classes", "signature"))
    alone = F.col("n") - F.count("*").over(in_class)
    ranked = shared.select("*", (place + alone).alias("place"))
    rare = ranked.where(100 * (F.col("place") - 1) <= (100 - percent) * F.col("n"))
    cells = F.explode(F.array("partition", F.col("partition") + 1)).alias("cell")
    dealt = rare.select("class", "n", "partition", "signature", cells)
    dealt = dealt.select("class", "n", F.xxhash64("signature", "cell").alias("bucket"), (F.col("cell") == F.col("partition")).alias("own"))
    dealt = written(dealt, "spot_buckets")
    own = dealt.groupBy("bucket").agg(F.max("own").alias("own"), F.count("*").alias("k")).where("own and k > 1")
    return dealt.drop("own").join(own.select("bucket"), "bucket", "left_semi")


def near_duplicates(documents: DataFrame, percent: int = 80) -> DataFrame:
    """``doc_id, n, component_id, kept`` for each row: its signatures, and the smallest doc_id reachable through links.

    Links join texts whose signatures share at least ``percent`` % of their union; none is lost. One row of each
    component is kept: that whose doc_id is the component's. Texts without words have no signatures and stay alone.
    Repeated rows stay; a null doc_id stays alone and is kept. An empty table gives an empty table. Other columns are
    not looked at.

    Texts with equal sets are one class from the start. Classes meet by their rarest signatures within equal and
    neighbouring partitions; in each bucket stars are compared as in ``minhash.linked``, never all pairs.
    """
    rows = written(fingerprints(documents, percent), "spots")
    named = rows.where("class is not null")
    grouped = named.groupBy("class", "n", "partition", "signatures").agg(F.min("doc_id").alias("first_id"))
    classes = written(grouped, "spot_classes")
    members = minhash.together(_meetings(classes, percent))
    sets = classes.select("class", F.col("signatures").alias("shingles"))
    found = minhash.linked(members, sets, percent)
    return minhash.by_component(rows.select("doc_id", "n", "class"), classes.select("class", "first_id"), found)
