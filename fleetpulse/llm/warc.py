"""Convert legacy ARC archives to WARC, and read and write both as files of bounded size."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.llm.frames import small_batches, small_or_merge, table
from fleetpulse.session import stage, work_dir

# Payloads from this size on are stored once; equal ones become revisit records.
REVISIT_BYTES = 1000
# What a task hands on at once.
BATCH_BYTES = 4 << 20

# Field names of the two ARC header lines and the media types of WARC blocks.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
HTTP_TYPE = "application/http; msgtype=response"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ID_FIELD = "X-Page-Id"
REFERS_FIELD = "X-Refers-To-Page-Id"


# ---- files of raw bytes ----


def write_files(records: DataFrame, name: str, line_sep: str) -> str:
    """Write the binary column ``record`` as gzipped files, one for each task, each record followed by ``line_sep``."""
    path = f"{work_dir(records.sparkSession)}/fleetpulse/{uuid.uuid4().hex}/{name}"
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", line_sep).option("compression", "gzip").text(path)
    return path


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of the archive files, still compressed."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("path", "content")


class Bytes:
    """Reads lines and blocks from a gzipped file, unpacking no more than is asked for."""

    def __init__(self, content: bytes) -> None:
        self.packed, self.at, self.ready = memoryview(content), 0, bytearray()
        self.unzip = zlib.decompressobj(31)
        self.offset = 0

    def _more(self) -> bool:
        if self.unzip.eof:  # the next member of the file
            self.at -= len(self.unzip.unused_data)
            self.unzip = zlib.decompressobj(31)
        if self.at >= len(self.packed):
            return False
        piece = self.packed[self.at:self.at + (1 << 18)]
        self.at += len(piece)
        self.ready += self.unzip.decompress(piece)
        return True

    def line(self) -> bytes | None:
        """The next line with its end, or None at the end of the file."""
        start = 0
        while (end := self.ready.find(b"\n", start)) < 0:
            start = len(self.ready)
            if not self._more():
                break
        return self.take(end + 1 if end >= 0 else len(self.ready)) or None

    def take(self, count: int) -> bytes:
        while len(self.ready) < count and self._more():
            pass
        if len(self.ready) < count:
            raise ValueError(f"archive ends inside a record: {count} bytes declared, {len(self.ready)} left")
        taken = bytes(self.ready[:count])
        del self.ready[:count]
        self.offset += count
        return taken


def _batches(rows: Iterator[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    batch, size = [], 0
    for row in rows:
        batch.append(row)
        size += sum(len(v) for v in row if isinstance(v, (bytes, str)))
        if size >= BATCH_BYTES:
            yield pd.DataFrame(batch, columns=columns, dtype=object)
            batch, size = [], 0
    if batch:
        yield pd.DataFrame(batch, columns=columns, dtype=object)


def _http(payload: bytes, page_id: int | None) -> bytes:
    fields = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=UTF-8", f"Content-Length: {len(payload)}"]
    if page_id is not None:
        fields.append(f"{ID_FIELD}: {page_id}")
    return ("\r\n".join(fields) + "\r\n\r\n").encode()


def _fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; the first line is left out."""
    pairs = (line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


# ---- ARC ----


def _address(url: str | None) -> str:
    """A URL as an ARC header can hold it: no white space or control characters, never empty."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "") or "-"


def arc_records(pages: DataFrame, version: int | None = None) -> DataFrame:
    """One ARC record per row of (page_id, url, html), after a version block for each task's file.

    ``version`` is 1 or 2; by default tasks take turns, as an archive of many years would.
    """

    def write(index: int, batches: Iterator[pd.DataFrame]) -> Iterator[tuple[bytes]]:
        kind, offset = version or 1 + index % 2, 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                if not offset:
                    about = f"{kind} 0 crawler\n{ARC_FIELDS[kind]}\n\n".encode()
                    head = f"filedesc://part-{index}.arc 0.0.0.0 20200101000000 text/plain "
                    head += "" if kind == 1 else f"200 - - 0 part-{index}.arc "
                    block = f"{head}{len(about)}\n".encode() + about
                    offset += len(block) + 1
                    yield (block,)
                payload = (row.html or "").encode("utf-8", "surrogatepass")
                page_id = None if pd.isna(row.page_id) else int(row.page_id)
                body = _http(payload, page_id) + payload
                head = f"{_address(row.url)} 0.0.0.0 {20200101000000 + (page_id or 0) % 28 * 1000000} text/html "
                head += "" if kind == 1 else f"200 {zlib.crc32(body):08x} - {offset} part-{index}.arc "
                block = f"{head}{len(body)}\n".encode() + body
                offset += len(block) + 1
                yield (block,)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        yield from _batches(write(TaskContext.get().partitionId(), batches), ["record"])

    return small_batches(pages).select(F.col("page_id").cast("string").alias("page_id"), "url", "html").mapInPandas(run, "record binary")


def parse_arc(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, block) of every record but the version block.

    The version block names the fields of the header lines below it; the last field is the
    declared length of the block, which a newline ends.
    """
    file, names = Bytes(content), None
    while True:
        offset = file.offset
        line = file.line()
        if line is None:
            return
        if not line.strip():
            continue
        values = line.decode("utf-8", "replace").rstrip("\r\n").split(" ")
        block = file.take(int(values[-1]))
        if line.startswith(b"filedesc://"):
            names = block.decode("utf-8", "replace").split("\n")[1].split(" ")
        elif names is None or len(values) < len(names):
            raise ValueError(f"ARC header line at {offset} does not fit the file's version block")
        else:
            # A URL may hold spaces in old files, so fields are counted from the end.
            spare = len(values) - len(names)
            fields = [" ".join(values[:spare + 1]), *values[spare + 1:]]
            yield offset, dict(zip(names, fields)), block


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """Records of ARC files as (file, offset, page_id, url, date, digest, payload).

    ``digest`` is the SHA-1 of the payload as bare hex. Files are unpacked record by record.
    """
    columns = ["file", "offset", "page_id", "url", "date", "digest", "payload"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def records() -> Iterator[tuple]:
            for batch in batches:
                for path, content in zip(batch["path"], batch["content"]):
                    for offset, head, block in parse_arc(content):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        page_id = _fields(http).get(ID_FIELD.lower())
                        yield (
                            path.rsplit("/", 1)[-1], offset, None if page_id is None else int(page_id),
                            None if head["URL"] == "-" else head["URL"], head["Archive-date"],
                            hashlib.sha1(payload).hexdigest(), payload,
                        )

        yield from _batches(records(), columns)

    return read_files(spark, path).mapInPandas(
        read, "file string, offset long, page_id long, url string, date string, digest string, payload binary"
    )


# ---- WARC ----


def warc_records(arc: DataFrame, responses: DataFrame) -> DataFrame:
    """WARC records for ARC records, given (digest, winner) of payloads that are stored once.

    Identifiers are name-based UUIDs of the ARC file and offset, so a repeated conversion
    gives the same ones; times, types and digests come from the ARC header and the payload.
    """
    joined = arc.join(responses, "digest", "left")
    columns = ["file", "offset", "page_id", "url", "date", "digest", "payload", "w_file", "w_offset", "w_page_id", "w_url", "w_date"]

    def record_id(file: str, offset: int) -> str:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file}#{offset}')}>"

    def iso(date: str) -> str:
        d = date.ljust(14, "0")
        return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def records() -> Iterator[tuple]:
            for batch in batches:
                for r in batch.itertuples(index=False):
                    page_id = None if pd.isna(r.page_id) else int(r.page_id)
                    again = r.w_file is not None and (r.w_file, int(r.w_offset)) != (r.file, int(r.offset))
                    block = _http(r.payload, page_id) + (b"" if again else r.payload)
                    sha1 = base64.b32encode(bytes.fromhex(r.digest)).decode()
                    head = [
                        "WARC/1.1", f"WARC-Type: {'revisit' if again else 'response'}", f"WARC-Record-ID: {record_id(r.file, int(r.offset))}",
                        f"WARC-Date: {iso(r.date)}", f"WARC-Payload-Digest: sha1:{sha1}",
                        f"Content-Type: {HTTP_TYPE}", f"Content-Length: {len(block)}",
                    ]
                    if r.url is not None:
                        head.append(f"WARC-Target-URI: {r.url}")
                    if again:
                        head += [
                            f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(r.w_file, int(r.w_offset))}",
                            f"WARC-Refers-To-Date: {iso(r.w_date)}",
                        ]
                        if r.w_url is not None:
                            head.append(f"WARC-Refers-To-Target-URI: {r.w_url}")
                        if not pd.isna(r.w_page_id):
                            head.append(f"{REFERS_FIELD}: {int(r.w_page_id)}")
                    yield ("\r\n".join(head).encode() + b"\r\n\r\n" + block,)

        yield from _batches(records(), ["record"])

    flat = joined.select(
        "file", "offset", F.col("page_id").cast("string").alias("page_id"), "url", "date", "digest", "payload",
        F.col("winner.file").alias("w_file"), F.col("winner.offset").cast("string").alias("w_offset"),
        F.col("winner.page_id").cast("string").alias("w_page_id"), F.col("winner.url").alias("w_url"), F.col("winner.date").alias("w_date"),
    )
    assert flat.columns == columns
    return flat.mapInPandas(convert, "record binary")


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record; two line ends follow each block."""
    file = Bytes(content)
    while (line := file.line()) is not None:
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {file.offset - len(line)}")
        head = bytearray(line)
        while (line := file.line()) is not None and line.strip():
            head += line
        fields = _fields(bytes(head))
        yield fields, file.take(int(fields["content-length"]))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files: id, type, the full payload's bytes and bare hex SHA-1, and what a revisit refers to.

    The digest of a stored payload is computed anew and must be the declared one.
    """
    schema = T.StructType([
        T.StructField("record_id", T.StringType()), T.StructField("page_id", T.LongType()),
        T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
        T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType()),
    ])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def records() -> Iterator[tuple]:
            for batch in batches:
                for content in batch["content"]:
                    for head, block in parse_warc(content):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        inner = _fields(http)
                        declared = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
                        if head["warc-type"] == "response" and hashlib.sha1(payload).hexdigest() != declared:
                            raise ValueError(f"payload of {head['warc-record-id']} does not have its declared digest")
                        page_id, refers_to = inner.get(ID_FIELD.lower()), head.get(REFERS_FIELD.lower())
                        yield (
                            head["warc-record-id"], None if page_id is None else int(page_id), int(inner["content-length"]),
                            declared, head["warc-type"], None if refers_to is None else int(refers_to),
                        )

        yield from _batches(records(), schema.names)

    return read_files(spark, path).mapInPandas(read, schema)


def arc_to_warc(spark: SparkSession, arc_path: str, *, revisit_bytes: int = REVISIT_BYTES) -> str:
    """Convert a folder of ARC files to a folder of WARC files and return its path.

    Of records with equal payloads of at least ``revisit_bytes``, the one with the largest
    page id (of equal ids the last by file and offset, null ids before all others) is the
    response and the others revisit it. Only digests are shuffled to find them; payloads
    that occur once, the bulk, never meet the join's small side.
    """
    arc = read_arc(spark, arc_path)
    heads = stage(arc.filter(F.octet_length("payload") >= revisit_bytes).drop("payload"), "arc_heads")
    responses = stage(
        heads.groupBy("digest").agg(
            F.max(F.struct("page_id", "file", "offset", "url", "date")).alias("winner"), F.count("*").alias("copies")
        ).filter("copies > 1").select("digest", "winner"),
        "warc_responses",
    )
    return write_files(warc_records(arc, small_or_merge(responses, 400)), "warc", "\r\n\r\n")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as an ARC archive, converted to WARC and read back.

    A null html is an empty payload, a null url leaves out the target, a null page id the
    page field; repeated rows stay records of their own.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    arc = write_files(arc_records(pages), "arc", "\n")
    return read_warc(spark, arc_to_warc(spark, arc)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = f"""
with p as (select page_id, coalesce(html, '') as body from pages),
d as (select page_id, octet_length(encode(body))::bigint as n, sha1(body) as digest from p),
m as (select *, max(page_id) over (partition by digest) as top from d)
select page_id, n as payload_bytes, digest as payload_digest,
  case when n >= {REVISIT_BYTES} and page_id <> top then 'revisit' else 'response' end as record_type,
  case when n >= {REVISIT_BYTES} and page_id <> top then top end as refers_to
from m
"""
