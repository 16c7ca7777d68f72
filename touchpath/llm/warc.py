"""WARC archives: writing pages as segmented, chunked records, and putting them together again.

A page is a response record whose block is an HTTP answer with chunked transfer framing, or, if an earlier page has
the same payload, a revisit record that names that page. Blocks beyond ``SEGMENT`` bytes go on in continuation
records. Reading takes the records apart by their lengths, groups the segments by the identifier of their origin,
orders them by number, checks the total length and takes off the framing.

The archives are gzip files with a bounded number of records each, in the shared folder.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpath.llm.common import new_path, utf8, written

SEGMENT = 8_192  # bytes of a record's block
CHUNK = 2_048  # bytes of a chunk of the transfer framing
RECORDS_PER_FILE = 10_000
LEAST_REVISIT = 100  # bytes of a payload that is not written again

_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_DATE = "2000-01-01T00:00:00Z"  # of all records: nothing here reads the clock


def _bytes(text: str | Column) -> Column:
    return F.encode(F.lit(text) if isinstance(text, str) else text, "UTF-8")


def _chunked(payload: Column) -> Column:
    """Transfer framing: each chunk with its length, and the empty chunk at the end."""
    count = F.ceil(F.octet_length(payload) / CHUNK).cast("int")

    def chunk(i: Column) -> Column:
        piece = F.substring(payload, i * CHUNK + 1, F.lit(CHUNK))
        return F.concat(_bytes(F.concat(F.hex(F.octet_length(piece)), F.lit("\r\n"))), piece, _bytes("\r\n")).cast("string")

    starts = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    # joined as strings, which Spark keeps byte by byte
    return F.concat(F.array_join(F.transform(starts, chunk), "").cast("binary"), _bytes("0\r\n\r\n"))


def _first_pages(pages: DataFrame) -> DataFrame:
    """``digest, first`` of the payloads that several records share. Combined before the shuffle."""
    long_ = pages.where(F.octet_length("payload") >= LEAST_REVISIT)
    return long_.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")


def write_archives(pages: DataFrame) -> str:
    """Write ``page_id, url, html`` as records and return the folder.

    A null html is an empty payload. Of the pages with equal payloads of ``LEAST_REVISIT`` bytes or more those with
    the smallest page_id are responses and the others revisits; shorter ones are all responses. Line breaks in a url
    become spaces. Repeated rows are written each; a null page_id is written as an empty one.
    """
    payload = _bytes(F.coalesce("html", F.lit("")))
    plain = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"))
    plain = plain.withColumn("digest", F.sha2("payload", 256))
    known = plain.join(_first_pages(plain.select("page_id", "payload", "digest")), "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    identity = F.concat(name, F.lit(":"), F.monotonically_increasing_id().cast("string"))
    body = F.when(revisit, _bytes("")).otherwise(_chunked(F.col("payload")))
    block = F.concat(_bytes(_HTTP), body)
    records = known.select(
        identity.alias("id"), F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " ").alias("url"),
        "digest", F.when(revisit, F.col("first")).alias("refers"), block.alias("block"),
    ).withColumn("segments", F.ceil(F.octet_length("block") / SEGMENT).cast("int"))
    cut = records.withColumn("number", F.explode(F.sequence(F.lit(1), "segments")))
    piece = F.substring("block", (F.col("number") - 1) * SEGMENT + 1, F.lit(SEGMENT))
    path = new_path(pages.sparkSession, "archives")
    # a record ends with two line breaks: one written here, one by the writer
    text = _header(F.octet_length(piece)).cast("binary")
    lines = cut.select(F.concat(text, piece, _bytes("\r\n")).cast("string").alias("value"))
    lines.write.option("lineSep", "\r\n").option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)
    return path


def _header(length: Column) -> Column:
    def line(name: str, value: str | Column, when: Column | None = None) -> Column:
        text = F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value.cast("string"), F.lit("\r\n"))
        return text if when is None else F.when(when, text).otherwise(F.lit(""))

    first, several = F.col("number") == 1, F.col("segments") > 1
    number = F.col("number").cast("string")
    own = F.when(first, F.col("id")).otherwise(F.concat("id", F.lit("/"), number))
    angled = lambda text: F.concat(F.lit("<"), text, F.lit(">"))
    kind = F.when(~first, "continuation").when(F.col("refers").isNotNull(), "revisit").otherwise("response")
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", angled(own)),
        line("WARC-Date", _DATE),
        line("WARC-Target-URI", F.col("url")),
        line("Content-Type", "application/http; msgtype=response", first),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest"), first),
        line("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", F.col("refers").isNotNull() & first),
        line("WARC-Refers-To", angled(F.concat(F.lit("urn:page:"), F.col("refers").cast("string"))), F.col("refers").isNotNull() & first),
        line("WARC-Segment-Number", number, several),
        line("WARC-Segment-Origin-ID", angled(F.col("id")), ~first),
        line("WARC-Segment-Total-Length", F.octet_length("block"), several & (F.col("number") == F.col("segments"))),
        line("Content-Length", length),
        F.lit("\r\n"),
    )


def parse(packed: bytes, portion: int = 1 << 20) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of a gzip file, read as a stream."""
    unpack = zlib.decompressobj(wbits=31)
    data, at = bytearray(), 0

    def more() -> bool:
        nonlocal at, unpack, packed
        while packed:
            del data[:at]
            at = 0
            new = unpack.decompress(packed, portion)
            packed = unpack.unconsumed_tail
            if unpack.eof:  # a file may be made of several members
                packed, unpack = unpack.unused_data, zlib.decompressobj(wbits=31)
            data.extend(new)
            if new:
                return True
        return False

    while True:
        while (end := data.find(b"\r\n\r\n", at)) < 0:
            if not more():
                if data[at:].strip():
                    raise ValueError("an archive ends within a record's header")
                return
        first, *lines = data[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"not a record: {first[:40]!r}")
        fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        length = int(fields["content-length"])
        at = end + 4
        while len(data) - at < length + 4:
            if not more():
                raise ValueError("an archive ends within a record's block")
        yield fields, bytes(data[at : at + length])
        at += length + 4


def unchunk(block: bytes) -> bytes:
    """The payload of an HTTP answer: without header and transfer framing."""
    header, _, body = block.partition(b"\r\n\r\n")
    if b"transfer-encoding: chunked" not in header.lower():
        return body
    pieces, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(pieces)
        pieces.append(body[end + 2 : end + 2 + size])
        if body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("a chunk is longer or shorter than it says")
        at = end + 4 + size


_RECORD = "record_type string, origin string, number int, total bigint, digest string, refers_to bigint, block binary"
_RECORD_NAMES = [part.split()[0] for part in _RECORD.split(", ")]
_RECORD_KINDS = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.binary()]


def _inside(angled: str | None) -> str | None:
    return angled.strip("<>") if angled else None


def records(spark: SparkSession, path: str, segmented: bool) -> DataFrame:
    """The records of all archives in a folder: the segments, or those that are whole."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(list(values), kind) for kind, values in zip(_RECORD_KINDS, zip(*rows))]
        return pa.RecordBatch.from_arrays(columns, _RECORD_NAMES)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for files in batches:
            for file in files.column(0):
                for fields, block in parse(file.as_py()):
                    number = fields.get("warc-segment-number")
                    if (number is not None) != segmented:
                        continue
                    origin = _inside(fields.get("warc-segment-origin-id") or fields["warc-record-id"])
                    total, refers = fields.get("warc-segment-total-length"), _inside(fields.get("warc-refers-to"))
                    rows.append((
                        fields["warc-type"], origin, number and int(number), total and int(total),
                        fields.get("warc-payload-digest", "").removeprefix("sha256:") or None,
                        int(refers.split(":")[2]) if refers else None, block,
                    ))
                    size += len(block)
                    if size > 1 << 22:
                        yield batch(rows)
                        rows, size = [], 0
        if rows:
            yield batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(work, _RECORD)


def reassemble(segments: DataFrame) -> DataFrame:
    """Segments of each origin, as one record; ``problem`` says what is wrong with an incomplete one.

    A group is one record's segments, never more than a page.
    """
    part = F.struct("number", "block", "total", "record_type", "digest", "refers_to")
    grouped = segments.groupBy("origin").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    numbers = F.transform("parts", lambda p: p["number"])
    joined = F.array_join(F.transform("parts", lambda p: p["block"].cast("string")), "").cast("binary")
    first, last = F.element_at("parts", 1), F.element_at("parts", -1)
    gaps = numbers != F.sequence(F.lit(1), F.size("parts"))
    lengths = ~last["total"].eqNullSafe(F.octet_length(joined).cast("bigint"))
    problem = F.when(gaps, "segments are missing or repeated").when(lengths, "the total length is another")
    return grouped.select(
        first["record_type"].alias("record_type"), "origin", first["digest"].alias("digest"),
        first["refers_to"].alias("refers_to"), joined.alias("block"), problem.alias("problem"),
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, record_type, refers_to, digest, payload, problem`` of the records in a folder of archives.

    ``payload`` is empty for a revisit and null where ``problem`` says why a record cannot be put together. Segments
    without a first one are a row of type continuation. Records of other types are not pages and give no row. Only the
    segmented records are shuffled. An empty folder gives an empty table.
    """
    whole = records(spark, path, False).select(
        "record_type", "origin", "digest", "refers_to", "block", F.lit(None).cast("string").alias("problem")
    )
    all_ = whole.unionByName(reassemble(records(spark, path, True)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, problems = [], []
            for block, problem in zip(utf8(batch.column(4)), batch.column(5).to_pylist()):
                try:
                    found.append(None if problem else unchunk(block) if b"\r\n\r\n" in block else b"")
                except ValueError as error:
                    found.append(None)
                    problem = str(error)
                problems.append(problem)
            columns = [*batch.columns[:4], pa.array(found, pa.binary()), pa.array(problems, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["record_type", "origin", "digest", "refers_to", "payload", "problem"])

    # revisits carry the header of an answer only
    answers = all_.where("record_type = 'response'").mapInArrow(
        work, "record_type string, origin string, digest string, refers_to bigint, payload binary, problem string"
    )
    revisits = all_.where("record_type = 'revisit'").drop("block").withColumn("payload", _bytes(""))
    # segments whose record never began are reported, not passed over
    orphans = all_.where("record_type = 'continuation'").drop("block").withColumns(
        {
            "payload": F.lit(None).cast("binary"),
            "problem": F.coalesce("problem", F.lit("the first segment is missing")),
        }
    )
    page = F.nullif(F.split("origin", ":")[2], F.lit("")).cast("bigint")
    all_ = answers.unionByName(revisits.select(*answers.columns)).unionByName(orphans.select(*answers.columns))
    return all_.select(
        page.alias("page_id"), "record_type", "refers_to", "digest", "payload", "problem"
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives, read them, and return ``page_id, payload_bytes, payload_digest, record_type,
    refers_to`` of each record. Length and digest are those of the payload read; a revisit's length is that of the
    page it names and its digest the one it carries. Rows as in ``write_archives``."""
    spark = pages.sparkSession
    read = read_archives(spark, write_archives(pages))
    failed = F.raise_error(F.concat(F.lit("a record is not whole: "), "problem"))
    length = F.when(F.col("problem").isNull(), F.octet_length("payload").cast("bigint")).otherwise(failed.cast("bigint"))
    own = F.when(F.col("record_type") == "response", F.sha2("payload", 256)).otherwise(F.col("digest"))
    found = written(read.select("page_id", length.alias("own_bytes"), own.alias("payload_digest"), "record_type", "refers_to"), "records")
    answers = found.where("record_type = 'response' and page_id is not null").groupBy(F.col("page_id").alias("refers_to"))
    lengths = answers.agg(F.first("own_bytes").alias("first_bytes"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    # responses refer to nothing: joined with the revisits they would all meet in one task
    responses = found.where("record_type = 'response'").withColumnRenamed("own_bytes", "payload_bytes")
    revisits = found.where("record_type <> 'response'").join(lengths, "refers_to", "left")
    return responses.select(*columns).unionByName(revisits.withColumnRenamed("first_bytes", "payload_bytes").select(*columns))
