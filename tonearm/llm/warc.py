"""WARC archives compressed record by record with a shared Zstandard dictionary.

The dictionary is trained on a bounded sample of the records themselves and stands in
a leading skippable frame of every file, so a file needs nothing else to be read.
Records with equal payloads become one response and revisits of it.  The writer
returns an index (one row per record: file, offset, length); files of task attempts
that did not commit are in no index and are never read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.llm.common import lookup
from tonearm.session import materialize, scratch_path

#: The dictionary's bounds: sampled records, bytes taken of each, size of the dictionary.
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 1000, 8192, 1 << 16
#: A new file is begun after this many uncompressed bytes.
FILE_BYTES = 32 << 20
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
FORMATTED = b"\x37\xa4\x30\xec"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}/{digest}')}>"


def build_record(page_id: int | None, url: str | None, payload: bytes | None, size: int, sha1_hex: str,
                 refers_to: int | None) -> bytes:
    """One WARC record: a response with its payload, or (refers_to given) a revisit without."""
    digest = base64.b32encode(bytes.fromhex(sha1_hex)).decode()
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    if refers_to is None:
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {_record_id(page_id, digest)}", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
            f"Content-Length: {len(block)}", f"X-Payload-Length: {size}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if url is not None:  # control characters cannot stand in a header
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}",
                 f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def train_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; the raw samples where they are too few to train on; b"" without any."""
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, threads=1).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    if not data:
        return None
    kind = zstandard.DICT_TYPE_FULLDICT if data[:4] == FORMATTED else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressionDict(data, dict_type=kind)


def _open(folder: str):
    from pyarrow import fs

    folder = re.sub(r"^file:/(?!/)", "file:///", folder)
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def _write(folder: str, dictionary: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        task = TaskContext.get()
        zdict = _dictionary(dictionary)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=zdict)
        lead = struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary if dictionary else b""
        out, name, at, raw, nth = None, "", 0, 0, 0
        for batch in batches:
            index = []
            for row in batch.to_pylist():
                if out is None:
                    name = f"{task.partitionId():05d}-{nth:05d}-{uuid.uuid4().hex}.warc.zst"
                    out, at, raw, nth = store.open_output_stream(f"{root}/{name}", compression=None), len(lead), 0, nth + 1
                    out.write(lead)
                record = build_record(row["page_id"], row["url"], row["payload"], row["size"], row["sha1"],
                                      row["refers_to"])
                frame = compressor.compress(record)
                out.write(frame)
                index.append((row["page_id"], name, at, len(frame)))
                at, raw = at + len(frame), raw + len(record)
                if raw >= FILE_BYTES:
                    out.close()
                    out = None
            if index:
                cols = list(zip(*index))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1]), pa.array(cols[2], pa.int64()),
                     pa.array(cols[3], pa.int64())], names=["page_id", "file", "offset", "length"])
        if out is not None:
            out.close()
    return run


def write_archives(pages: DataFrame, min_payload: int = 0) -> tuple[str, DataFrame]:
    """Archive (page_id, url, html); returns the folder and the index (page_id, file, offset, length).

    Null html counts as empty; null urls have no target header.  Of records whose equal
    payloads have at least ``min_payload`` bytes, those with the smallest page_id are
    responses and the others revisit it (a null page_id is never the smallest; a group
    of null ids only, and shorter payloads, are responses all).  Repeated rows are
    archived as records of their own; an empty table gives no file; extra columns are
    not read.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload").cast("long")).withColumn("sha1", F.sha1("payload"))
    light = materialize(rows.select("page_id", "size", "sha1"), "warc-digests")
    firsts = (light.filter(F.col("size") >= min_payload).groupBy("sha1")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    # Written, so that the planner knows its size: payloads are shuffled only if it is large.
    firsts = materialize(firsts, "warc-firsts")
    joined = lookup(rows, firsts, "sha1", ["first"], seen=light)
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")
    records = joined.select("page_id", "url", "size", "sha1", refers, "payload")
    records = records.withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload")))

    share = min(1.0, SAMPLE_RECORDS / max(light.count(), 1))
    unit = F.shiftrightunsigned(F.xxhash64(F.lit(5), "page_id", "url"), 11).cast("double") * 2.0 ** -53
    sample = (rows.filter(unit < share).withColumn("payload", F.substring("payload", 1, SAMPLE_BYTES))
              .limit(2 * SAMPLE_RECORDS).collect())
    dictionary = train_dictionary([build_record(r["page_id"], r["url"], bytes(r["payload"]), r["size"], r["sha1"], None)
                                   for r in sample])
    folder = scratch_path(spark, "warc")
    store, root = _open(folder)
    store.create_dir(root, recursive=True)
    index = records.mapInArrow(_write(folder, dictionary),
                               "page_id long, file string, offset long, length long")
    return folder, materialize(index, "warc-index")


def parse_archive(data: bytes) -> Iterator[dict]:
    """The records of one file's bytes: headers and, for responses, the payload."""
    zdict, at = None, 0
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == SKIPPABLE:
        at = 8 + struct.unpack_from("<I", data, 4)[0]
        zdict = _dictionary(data[8:at])
    reader = zstandard.ZstdDecompressor(dict_data=zdict).stream_reader(
        io.BytesIO(memoryview(data)[at:]), read_across_frames=True)
    stream = io.BufferedReader(reader, 1 << 16)
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError("not a WARC record")
        head = {}
        while (line := stream.readline()) != b"\r\n":
            key, _, value = line.rstrip(b"\r\n").partition(b": ")
            head[key.decode().lower()] = value.decode("utf-8", "surrogatepass")
        block = stream.read(int(head["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a WARC record does not end where its length says")
        head["payload"] = block.partition(b"\r\n\r\n")[2]
        yield head


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column("content"):
            rows = []
            for r in parse_archive(data.as_buffer().to_pybytes()):
                digest, kind = r["warc-payload-digest"].removeprefix("sha1:"), r["warc-type"]
                size = int(r["x-payload-length"])
                if kind == "response":
                    found = base64.b32encode(hashlib.sha1(r["payload"]).digest()).decode()
                    if found != digest or len(r["payload"]) != size:
                        raise ValueError(f"payload of {r['warc-record-id']} is damaged")
                page, first = r.get("x-page-id"), r.get("x-refers-to-page")
                rows.append((page and int(page), size, digest, kind, first and int(first), r.get("warc-target-uri"),
                             r["payload"] if kind == "response" else None))
            cols = list(zip(*rows)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[
                "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"])


def read_archives(folder: str, index: DataFrame) -> DataFrame:
    """Every record of the indexed files; each response's payload is checked against its digest."""
    files = index.select(F.col("file").alias("name")).distinct()
    found = (index.sparkSession.read.format("binaryFile").load(folder)
             .select(F.element_at(F.split("path", "/"), -1).alias("name"), "content"))
    return found.join(files, "name", "left_semi").select("content").mapInArrow(
        _read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "url string, payload binary")


def archived(pages: DataFrame) -> DataFrame:
    """Write ``pages`` and read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    folder, index = write_archives(pages)
    return read_archives(folder, index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
