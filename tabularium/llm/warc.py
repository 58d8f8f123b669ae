"""WARC archives compressed with Zstandard: a writer and a validating reader.

An archive starts with a skippable frame that holds the dictionary, itself a
Zstandard frame; after it each record is one frame, so a record can be read by
its offset alone. The reader loads the dictionary from the leading frame, finds
each frame's end from its block headers, decodes one frame at a time, in pieces
and no further than a record can be long (``RECORD_BYTES``), holds the result
against the size that the frame states, and validates it: magic numbers, the content
checksum, the WARC version line, mandatory fields, ``Content-Length`` against
the block and the closing blank lines, the payload digest, and, in HTTP
responses, their own length. A frame that can't be decoded or a record that
isn't valid is a row with ``error`` set, and reading goes on behind it; a
damaged block structure ends the archive with one such row.

Writing: records with equal payloads of at least ``least`` bytes are kept once.
Which record that is gets aggregated over digests and joined back, so a payload
with a third of all rows is one row per task before the shuffle, and adaptive
execution can split it in the join. Each task writes archives of about
``archive_bytes`` to the shared folder under names of its attempt; the names that
Spark commits with the manifest are the archives, and files of attempts that
were lost are removed.

Results defined for odd input: a null payload is empty; a null URL has no
target field; of equal payloads the row with the largest id is the response
(all rows that share this id), a null id counts as smaller than any other;
rows without any id in their group are all responses; repeated rows are
records of their own; other columns are ignored. No row in gives no archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.llm.common import Scratch

#: Fixed values of the format: little-endian frame magics.
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
END = b"\r\n\r\n"
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")

ARCHIVE_BYTES = 8 << 20
#: A dictionary is trained on an archive's first records, of so many bytes at most.
DICTIONARY_BYTES, TRAINING_BYTES = 32 << 10, 1 << 20
#: The largest record that is decoded, and how much larger than its frame it may be.
RECORD_BYTES, LARGEST_RATIO = 1 << 30, 50_000
LEVEL = 3
DATE = "2020-01-01T00:00:00Z"
RECORD_SCHEMA = (
    "archive string, offset long, frame_bytes long, warc_type string, record_id string, target_uri string, warc_date string, "
    "refers_to string, payload_bytes long, payload_digest string, payload binary, error string"
)


# --- bytes ---


def dictionary_frame(raw: bytes) -> bytes:
    body = zstandard.ZstdCompressor(level=19).compress(raw)
    return DICTIONARY_MAGIC + len(body).to_bytes(4, "little") + body


def leading_dictionary(data: bytes) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    """The dictionary of an archive, and where its records start."""
    if data[:4] != DICTIONARY_MAGIC:
        return None, 0
    end = 8 + int.from_bytes(data[4:8], "little")
    if end > len(data):
        raise ValueError("the dictionary frame is cut off")
    body = data[8:end]
    if body[:4] == FRAME_MAGIC:
        body = zstandard.ZstdDecompressor().decompress(body)
    return zstandard.ZstdCompressionDict(body), end


def frame_end(data: memoryview, at: int) -> tuple[int, int, bool]:
    """Of the frame at ``at``: its end, the content size that it states (-1: none), and whether it is a skippable frame."""
    magic = bytes(data[at : at + 4])
    if len(magic) == 4 and magic[1:] == DICTIONARY_MAGIC[1:] and magic[0] & 0xF0 == 0x50:
        end = at + 8 + int.from_bytes(data[at + 4 : at + 8], "little")
        if end > len(data):
            raise ValueError("a skippable frame is cut off")
        return end, 0, True
    if magic != FRAME_MAGIC:
        raise ValueError("no frame where one should start")
    head = bytes(data[at : at + 18])
    try:
        told, end = zstandard.get_frame_parameters(head), at + zstandard.frame_header_size(head)
    except zstandard.ZstdError as e:
        raise ValueError(f"a frame header is damaged: {e}") from None
    last = False
    while not last:
        if end + 3 > len(data):
            raise ValueError("a frame is cut off")
        block = int.from_bytes(data[end : end + 3], "little")
        last, kind, size = bool(block & 1), block >> 1 & 3, block >> 3
        if kind == 3:
            raise ValueError("a block has a reserved type")
        end += 3 + (1 if kind == 1 else size)
    end += 4 * told.has_checksum
    if end > len(data):
        raise ValueError("a frame is cut off")
    size = told.content_size
    return end, -1 if size >= 1 << 62 else size, False


def decoded(codec: zstandard.ZstdDecompressor, frame: memoryview, size: int) -> bytes:
    """A frame's content, decoded piece by piece so that a wrong stated size (-1: none) takes no memory."""
    most = min(RECORD_BYTES, LARGEST_RATIO * len(frame) + (1 << 20))
    if size > most:
        raise ValueError("the frame states a size that no record has")
    parts, total = [], 0
    with codec.stream_reader(frame, read_size=1 << 17) as reader:
        while piece := reader.read(1 << 20):
            parts.append(piece)
            total += len(piece)
            if total > most:
                raise ValueError("the frame holds more than any record")
    if 0 <= size != total:
        raise ValueError("the frame holds another size than it states")
    return b"".join(parts)


def http_response(payload: bytes, length: int) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length + payload


def record(kind: str, number: str, url: str | None, payload: bytes, length: int, digest: str, refers_to: str | None, date: str = DATE) -> bytes:
    """The bytes of one record; a revisit keeps the HTTP header only."""
    block = http_response(b"" if kind == "revisit" else payload, length)
    fields = [f"WARC-Type: {kind}", f"WARC-Record-ID: {number}", f"WARC-Date: {date}"]
    if url is not None:
        fields.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url))
    if refers_to is not None:
        fields += [f"WARC-Refers-To: {refers_to}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    fields += [
        "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return ("WARC/1.1\r\n" + "\r\n".join(fields) + "\r\n\r\n").encode("utf-8", "surrogatepass") + block + END


def parse_record(data: bytes) -> dict:
    """Fields and payload of one record; raises ``ValueError`` where it isn't valid."""
    head, found, rest = data.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("the record header has no end")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        raise ValueError("no WARC version line")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError("a header line is no field")
        fields[name.lower()] = value.strip()
    if lacking := [n for n in MANDATORY if n not in fields]:
        raise ValueError(f"mandatory field {lacking[0]} is missing")
    if not fields["content-length"].isdecimal():
        raise ValueError("Content-Length is no number")
    length = int(fields["content-length"])
    if len(rest) != length + len(END):
        raise ValueError("Content-Length differs from the block's length")
    if not rest.endswith(END):
        raise ValueError("the record does not end in two line breaks")
    block = rest[:length]
    payload, stated = block, None
    if fields.get("content-type", "").startswith("application/http"):
        http, found, payload = block.partition(b"\r\n\r\n")
        if not found or not http.startswith(b"HTTP/"):
            raise ValueError("the block has no HTTP header")
        m = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
        stated = int(m[1]) if m else None
    revisit = fields["warc-type"] == "revisit"
    if not revisit and stated is not None and stated != len(payload):
        raise ValueError("the HTTP length differs from the payload's length")
    digest = fields.get("warc-payload-digest")
    told = None
    if digest is not None:
        kind, _, value = digest.partition(":")
        if kind.lower() != "sha1":
            raise ValueError("the payload digest is no SHA-1")
        try:
            told = base64.b32decode(value).hex()
        except ValueError:
            raise ValueError("the payload digest can't be read") from None
    if not revisit:
        own = hashlib.sha1(payload).hexdigest()
        if told is not None and told != own:
            raise ValueError("the payload differs from its digest")
        told = own
    return {
        "warc_type": fields["warc-type"],
        "record_id": fields["warc-record-id"],
        "target_uri": fields.get("warc-target-uri"),
        "warc_date": fields["warc-date"],
        "refers_to": fields.get("warc-refers-to"),
        "payload_bytes": stated if revisit else len(payload),
        "payload_digest": told,
        "payload": None if revisit else payload,
    }


def read_records(data: bytes) -> Iterator[dict]:
    """One row per record frame of an archive, valid or not."""
    try:
        dictionary, at = leading_dictionary(data)
    except (ValueError, zstandard.ZstdError) as e:
        yield {"offset": 0, "frame_bytes": len(data), "error": str(e)}
        return
    codec = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    view = memoryview(data)
    while at < len(data):
        try:
            end, size, skip = frame_end(view, at)
        except ValueError as e:
            yield {"offset": at, "frame_bytes": len(data) - at, "error": str(e)}
            return
        if not skip:
            row = {"offset": at, "frame_bytes": end - at}
            try:
                row |= parse_record(decoded(codec, view[at:end], size))
            except (ValueError, zstandard.ZstdError) as e:
                row["error"] = str(e)
            yield row
        at = end


class _Archives:
    """Writes records to one archive after another."""

    def __init__(self, folder: str, limit: int):
        self.fs, self.root = pafs.FileSystem.from_uri(folder)
        self.limit, self.first, self.size, self.out = limit, [], 0, None
        self.done: list[tuple[str, int, int]] = []

    def add(self, raw: bytes) -> None:
        if self.out is None:
            self.first.append(raw)
            self.size += len(raw)
            if self.size >= TRAINING_BYTES:
                self._start()
        else:
            self._write(raw)

    def _start(self) -> None:
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.out, self.written, self.records = self.fs.open_output_stream(f"{self.root}/_{self.name}", compression=None), 0, 0
        try:
            raw = zstandard.train_dictionary(DICTIONARY_BYTES, [r[: TRAINING_BYTES // 4] for r in self.first], k=200, d=8)
        except zstandard.ZstdError:  # too few records for one
            raw = None
        self.codec = zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_checksum=True, write_content_size=True)
        if raw is not None:
            self._put(dictionary_frame(raw.as_bytes()))
        waiting, self.first, self.size = self.first, [], 0
        for r in waiting:
            self.add(r)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.written += len(data)

    def _write(self, raw: bytes) -> None:
        self._put(self.codec.compress(raw))
        self.records += 1
        if self.written >= self.limit:
            self.close()

    def close(self) -> None:
        if self.out is None and self.first:
            self._start()
        if self.out is not None:
            self.out.close()
            self.fs.move(f"{self.root}/_{self.name}", f"{self.root}/{self.name}")
            self.done.append((self.name, self.records, self.written))
            self.out = None


# --- tables ---


def plan_records(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least: int) -> DataFrame:
    """``(id, url, payload, n, digest, type, refers_to)``: what is written for each row."""
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("n"), F.sha1("payload").alias("digest"))
    copies = (
        pages.select(F.col(id_col).alias("id"), payload.alias("payload"))
        .where(F.octet_length("payload") >= least)
        .groupBy(F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("n"))
        .agg(F.max("id").alias("largest"), F.count("*").alias("copies"))
        .where((F.col("copies") > 1) & F.col("largest").isNotNull())
        .drop("copies")
    )
    joined = rows.join(copies, ["digest", "n"], "left")
    again = F.col("largest").isNotNull() & ~F.col("id").eqNullSafe(F.col("largest"))
    return joined.select(
        "id", "url", "payload", "n", "digest", F.when(again, "revisit").otherwise("response").alias("type"), F.when(again, F.col("largest")).alias("refers_to")
    )


def write_archives(spark: SparkSession, planned: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the records of ``plan_records`` below ``folder``; the manifest: ``(name, records, bytes)`` of each archive."""
    at = folder if "://" in folder else "file://" + folder.removeprefix("file:")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Archives(at, archive_bytes)
        out.fs.create_dir(out.root, recursive=True)
        for batch in batches:
            for r in batch.to_pylist():
                refers = None if r["refers_to"] is None else f"<urn:page:{r['refers_to']}>"
                out.add(record(r["type"], f"<urn:page:{r['id']}>", r["url"], r["payload"], r["n"], r["digest"], refers))
        out.close()
        names, records, sizes = zip(*out.done, strict=True) if out.done else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(records, pa.int64()), pa.array(sizes, pa.int64())], names=["name", "records", "bytes"])

    scratch = Scratch(spark, "manifest")
    manifest = scratch.write(planned.mapInArrow(run, "name string, records long, bytes long"), "archives")
    if not manifest.isEmpty():
        _remove_strays(spark, folder, at, manifest)
    return manifest


def _remove_strays(spark: SparkSession, folder: str, at: str, manifest: DataFrame) -> None:
    """Remove archives of attempts that were not committed, such as those of lost executors."""
    there = spark.read.format("binaryFile").load(folder).select(F.substring_index("path", "/", -1).alias("name"))
    strays = there.join(manifest.select("name"), "name", "left_anti")

    def drop(rows) -> None:
        fs, root = pafs.FileSystem.from_uri(at)
        for row in rows:
            fs.delete_file(f"{root}/{row['name']}")

    strays.foreachPartition(drop)


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per record of all archives below ``folder``, with the columns of ``RECORD_SCHEMA``."""
    schema = RECORD_SCHEMA if with_payload else RECORD_SCHEMA.replace("payload binary, ", "")
    names = [f.split()[0] for f in schema.split(", ")]
    types = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    arrow = pa.schema([(f.split()[0], types[f.split()[1]]) for f in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                held, size = [], 0
                for row in read_records(content.as_py()):
                    row["archive"] = path.as_py().rsplit("/", 1)[-1]
                    size += len(row.get("payload") or b"") if with_payload else 100
                    held.append({n: row.get(n) for n in names})
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=arrow)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema=arrow)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return files.select("path", "content").mapInArrow(run, schema)


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 1000) -> DataFrame:
    """Write all rows to archives (in the shared folder by default) and read the archives back."""
    folder = folder or Scratch(spark, "warc").path("archives")
    manifest = write_archives(spark, plan_records(pages, id_col, url_col, payload_col, least), folder)
    if manifest.isEmpty():
        return spark.createDataFrame([], RECORD_SCHEMA.replace("payload binary, ", ""))
    return read_archives(spark, folder, with_payload=False)


def page_number(record_id: Column) -> Column:
    """The page id in a record id of ``write_archives``, null for rows that had none."""
    return F.regexp_extract(record_id, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
