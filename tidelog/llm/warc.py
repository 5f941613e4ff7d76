"""WARC archives compressed with Zstandard: one frame per record, a dictionary in a leading skippable frame."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import batch, hot_join, shared_dir, shuffle_width, stage_table

#: Fixed values of the formats.
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")

_ID = re.compile(r"<urn:page:(-?\d+|null)>")
_MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
_RECORD_SQL = "path string, page_id long, uri string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, error string"
_RECORD = pa.schema([("path", pa.string()), ("page_id", pa.int64()), ("uri", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("error", pa.string())])


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def make_record(page_id: int | None, url: str | None, payload: bytes, first: int | None, date: str) -> bytes:
    """A response record, or a revisit of the response of page ``first``, without the payload but with its length and digest."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if first is None else http
    headers = [("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", _record_id(page_id)), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f-\x9f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)))
    if first is not None:
        headers += [("WARC-Refers-To", _record_id(first)), ("WARC-Profile", REVISIT_PROFILE)]
    headers += [("WARC-Payload-Digest", _sha1(payload)), ("WARC-Block-Digest", _sha1(block)), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of one record; raises ValueError where a header, a length or a digest is wrong."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] != VERSION:
        raise ValueError("no WARC/1.1 header")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon or name.strip().lower() in headers:
            raise ValueError(f"malformed or repeated header: {name[:80]}")
        headers[name.strip().lower()] = value.strip()
    if missing := [h for h in REQUIRED if h not in headers]:
        raise ValueError(f"missing header {missing[0]}")
    if not headers["content-length"].isdigit() or len(rest) != int(headers["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError(f"content of {len(rest) - 4} bytes, Content-Length {headers['content-length']}")
    block = rest[:-4]
    if headers.get("warc-block-digest", _sha1(block)) != _sha1(block):
        raise ValueError("wrong block digest")
    kind = headers["warc-type"]
    if kind not in ("response", "revisit"):
        raise ValueError(f"unexpected WARC-Type {kind}")
    http, gap, payload = block.partition(b"\r\n\r\n")
    stated = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
    if not gap or not http.startswith(b"HTTP/") or not stated:
        raise ValueError("no HTTP header with Content-Length")
    size, digest = int(stated[1]), headers.get("warc-payload-digest", "")
    if kind == "response" and (len(payload) != size or digest != _sha1(payload)):
        raise ValueError("payload differs from its length or digest")
    if kind == "revisit" and (payload or not digest.startswith("sha1:") or "warc-refers-to" not in headers):
        raise ValueError("incomplete revisit")
    ids = [_ID.fullmatch(headers.get(h, "<urn:page:null>")) for h in ("warc-record-id", "warc-refers-to")]
    if None in ids:
        raise ValueError("unknown form of record id")
    page_id, refers_to = (None if m[1] == "null" else int(m[1]) for m in ids)
    return {"page_id": page_id, "uri": headers.get("warc-target-uri"), "record_type": kind, "refers_to": refers_to, "payload_bytes": size, "payload_digest": base64.b32decode(digest[5:]).hex(), "payload": payload if kind == "response" else None, "error": None}


def train_dictionary(pages: DataFrame, samples: int = 400, sample_chars: int = 8192, size: int = 32768) -> bytes:
    """A dictionary of ``size`` bytes from ``samples`` pages that a hash picks; empty where there is too little to learn from."""
    rows = pages.where("html IS NOT NULL").select(F.xxhash64("page_id", "url").alias("key"), F.substring("html", 1, sample_chars).alias("html"))
    keys = rows.select("key").orderBy("key").limit(samples).collect()  # first the keys alone, then the few pages they stand for
    chosen = rows.where(F.col("key") <= max((r["key"] for r in keys), default=0)).groupBy("key").agg(F.min("html").alias("html")).limit(samples).collect()
    texts = [r["html"].encode("utf-8", "replace") for r in sorted(chosen, key=lambda r: r["key"])]
    try:
        return zstandard.train_dictionary(size, texts).as_bytes()
    except zstandard.ZstdError:
        return b""


def plan_records(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """``page_id, url, payload, first``: ``first`` is the page whose response a revisit stands for, null for responses.

    Payloads move once. Small ones have no key and are dealt evenly, and so are those
    of a payload that holds a large share of all pages; no archive grows with a hot one.
    """
    payload = F.encode(F.coalesce(pages["html"], F.lit("")), "UTF-8")
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("key", F.when(F.octet_length("payload") >= min_bytes, F.sha2("payload", 256)))
    firsts = rows.where("key IS NOT NULL").groupBy("key").agg(F.max("page_id").alias("first"), F.count("*").alias("n_left")).where("n_left > 1")
    first = F.when(F.coalesce(F.col("page_id") == F.col("first"), F.col("first").isNull()), F.lit(None)).otherwise(F.col("first"))
    return hot_join(rows, firsts, "key", pages.count()).select("page_id", "url", "payload", first.alias("first"))


def write_archives(records: DataFrame, path: str, dictionary: bytes, archive_bytes: int = 64 << 20, date: str = "2024-01-01T00:00:00Z", level: int = 3) -> DataFrame:
    """Write the planned ``records`` as archives below ``path`` (a folder all executors share) and return the manifest.

    Each task writes its own archives, a new one after ``archive_bytes``. A name
    holds the attempt, and only archives of tasks that succeeded are in the
    manifest (``path, records, bytes``), so a lost or repeated task does no harm.
    """

    def run(batches):
        fs, root = pyarrow.fs.FileSystem.from_uri(path)
        fs.create_dir(root, recursive=True)
        compressor = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_checksum=True)
        context, out, done = TaskContext.get(), None, []
        for b in batches:
            for page_id, url, payload, first in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "payload", "first")), strict=True):
                if out is None:
                    name, records, size = f"part-{context.partitionId():06d}-{len(done):04d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}.warc.zst", 0, 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    if dictionary:
                        size += out.write(DICTIONARY_MAGIC + len(dictionary).to_bytes(4, "little") + dictionary) or 0
                size += out.write(frame := compressor.compress(make_record(page_id, url, payload, first, date))) or len(frame)
                records += 1
                if size >= archive_bytes:
                    out.close()
                    done.append((name, records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name, records, size))
        yield batch(_MANIFEST, path=[f"{path}/{d[0]}" for d in done], records=[d[1] for d in done], bytes=[d[2] for d in done])

    return stage_table(records.mapInArrow(run, "path string, records long, bytes long"), "warc-manifest")


def read_frames(stream, chunk: int = 1 << 20):
    """The content of each frame of an archive; the dictionary, raw or itself compressed, comes from a leading skippable frame."""
    data = stream.read(chunk)
    dictionary = None
    if data[:4] == DICTIONARY_MAGIC:
        size = int.from_bytes(data[4:8], "little")
        while len(data) < 8 + size and (more := stream.read(chunk)):
            data += more
        content, data = data[8 : 8 + size], data[8 + size :]
        if len(content) != size:
            raise ValueError("the dictionary is cut off")
        if content[:4] == ZSTD_MAGIC:
            content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
        dictionary = zstandard.ZstdCompressionDict(content) if content else None
    reader = zstandard.ZstdDecompressor(dict_data=dictionary)
    while data or (data := stream.read(chunk)):
        frame, parts = reader.decompressobj(), []
        while True:
            parts.append(frame.decompress(data))
            if frame.eof:
                data = frame.unused_data
                break
            if not (data := stream.read(chunk)):
                raise ValueError("the last frame is cut off")
        yield b"".join(parts)


def read_archives(manifest: DataFrame, strict: bool = True, payload: bool = True) -> DataFrame:
    """The records of the archives listed in column ``path`` of ``manifest``, each archive streamed frame by frame.

    With ``strict`` an invalid record ends the job; else it becomes a row whose
    ``error`` says what is wrong, and a frame that can't be read ends its archive.
    ``payload=False`` leaves the payload bytes out of the rows. An empty manifest
    gives no rows.
    """

    def rows(path):
        fs, name = pyarrow.fs.FileSystem.from_uri(path)
        with fs.open_input_stream(name, compression=None) as stream:
            frames = read_frames(stream)
            while True:
                try:
                    raw = next(frames)
                except StopIteration:
                    return
                except (ValueError, zstandard.ZstdError) as e:
                    if strict:
                        raise
                    yield {"path": path, "error": str(e)}
                    return
                try:
                    record = {"path": path} | parse_record(raw)
                except ValueError as e:
                    if strict:
                        raise ValueError(f"{path}: {e}") from e
                    record = {"path": path, "error": str(e)}
                yield record if payload else record | {"payload": None}

    def run(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                held, size = [], 0
                for r in rows(path):
                    held.append(r)
                    size += len(r.get("payload") or b"") + 200
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=_RECORD)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema=_RECORD)

    return manifest.select("path").mapInArrow(run, _RECORD_SQL)


def read_warc(spark: SparkSession, path: str, **options) -> DataFrame:
    """The records of all archives below ``path``; only names are listed here, tasks stream the content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.warc.zst").load(path).select("path")
    return read_archives(files.repartition(shuffle_width(spark), "path"), **options)


def round_trip(pages: DataFrame, path: str | None = None, min_bytes: int = 1000) -> DataFrame:
    """Write a record per row of ``pages`` (``page_id, url, html``; other columns are ignored) and read them back.

    Returns ``page_id, payload_bytes, payload_digest, record_type, refers_to``. Of
    equal payloads of at least ``min_bytes`` bytes the page with the largest id is
    the response, and each row that repeats that id too; a group without any id is
    all responses. Null html is an empty payload, a null url has no target header,
    a null id is read back as null. An empty table gives no archive and no rows. A
    payload is held in memory one at a time.
    """
    spark = pages.sparkSession
    manifest = write_archives(plan_records(pages, min_bytes), path or shared_dir(spark, "warc"), train_dictionary(pages))
    spread = manifest.repartition(shuffle_width(spark), "path")
    return read_archives(spread, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``round_trip`` of all pages."""
    return round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


OP2_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
f AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY h) ELSE page_id END AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""
