"""WARC records in ZIP packages, and a reader that takes them out by ranges.

A package holds two stored (not compressed) members: archive/data.warc.gz, in which
each record is a gzip member of its own, and indexes/index.bin, 16 bytes a record:
where it begins in the former and its size. The reader finds the end record of the
ZIP file, or its ZIP64 end record, walks the central directory with its ZIP64
extras, computes where stored members lie, and reads records by range.

Of records of equal payloads the one with the largest page_id is the response and
the others revisit it, payloads of fewer than min_bytes excepted. A null payload is
empty. Rows that share a page_id are records of their own; of those with the response's
page_id and payload one, the first by file order, would do as response, so all stay
responses. A null page_id is a response and never referred to. An empty table gives
no files and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zipfile
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column_bytes, scratch, table
from .record_files import _open

DATA, INDEX = "archive/data.warc.gz", "indexes/index.bin"
END, END64, LOCATOR, ENTRY = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02"
WIDE = 0xFFFFFFFF
DATE = "2024-01-01T00:00:00Z"
ROWS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def uri_of(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def record(page_id, url: str, payload: bytes, sha: str, refers_to) -> bytes:
    """One record. A revisit has no block; its payload's size stands in a field of its own."""
    kind, block = ("response", payload) if refers_to is None else ("revisit", b"")
    head = {
        "WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{sha}')}>", "WARC-Date": DATE,
        "WARC-Target-URI": " ".join(url.split()), "WARC-Page-ID": uri_of(page_id), "WARC-Payload-Digest": f"sha1:{sha}", "WARC-Payload-Bytes": str(len(payload)),
    }
    if refers_to is not None:
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To-Page": uri_of(refers_to)}
    head |= {"Content-Type": "text/html", "Content-Length": str(len(block))}
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record; ValueError where the record is cut or none."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines)
    n = int(fields.get("Content-Length", -1))
    if not first.startswith("WARC/") or not sep or n < 0 or rest[n:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    return fields, rest[:n]


# ---------------------------------------------------------------- ZIP


def _end_of(read, size: int) -> tuple[int, int, int]:
    """Members, size and place of the central directory."""
    tail_at = max(0, size - 65557)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(END)
    while at >= 0 and at + 22 + int.from_bytes(tail[at + 20 : at + 22], "little") != len(tail):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no ZIP end record")
    members, length, place = struct.unpack_from("<HII", tail, at + 10)
    here = tail_at + at
    if (0xFFFF in (members,) or WIDE in (length, place)) and here >= 20:
        sign, _, there, _ = struct.unpack("<4sIQI", read(here - 20, 20))
        if sign == LOCATOR:
            wide = read(there, 56)
            if wide[:4] != END64:
                raise ValueError("no ZIP64 end record where its locator points")
            members, length, place = struct.unpack_from("<QQQ", wide, 32)
    return members, length, place


def members(read, size: int) -> dict[str, tuple[int, int, int]]:
    """Name of each member: compression method, where its bytes begin, how many it has.

    read(place, size) gives bytes. Sizes and places of 0xFFFFFFFF come from the ZIP64 extra.
    """
    many, length, place = _end_of(read, size)
    data, at, out = read(place, length), 0, {}
    for _ in range(many):
        if data[at : at + 4] != ENTRY:
            raise ValueError("broken central directory")
        method, packed, whole, n, m, k, where = *struct.unpack_from("<H", data, at + 10), *struct.unpack_from("<IIHHH", data, at + 20), *struct.unpack_from("<I", data, at + 42)
        name, extra = data[at + 46 : at + 46 + n], data[at + 46 + n : at + 46 + n + m]
        while len(extra) >= 4:
            kind, width = struct.unpack_from("<HH", extra)
            if kind == 1:
                wide = list(struct.unpack_from(f"<{width // 8}Q", extra, 4))
                whole = wide.pop(0) if whole == WIDE else whole
                packed = wide.pop(0) if packed == WIDE else packed
                where = wide.pop(0) if where == WIDE else where
            extra = extra[4 + width :]
        local = read(where, 30)
        if local[:4] != b"PK\x03\x04":
            raise ValueError("no member where the central directory points")
        out[name.decode()] = method, where + 30 + sum(struct.unpack_from("<HH", local, 26)), packed
        at += 46 + n + m + k
    return out


class Package:
    """An open package: number of records, and records by range."""

    def __init__(self, fs, path: str):
        self.file = fs.open_input_file(path)
        found = members(self._read, self.file.size())
        for name in (DATA, INDEX):
            if found[name][0]:
                raise ValueError(f"{name} is compressed")
        self.data, self.index = found[DATA][1], found[INDEX][1]
        self.records = found[INDEX][2] // 16

    def _read(self, place: int, size: int) -> bytes:
        return self.file.read_at(size, place)

    def fetch(self, first: int, many: int) -> list[bytes]:
        """Records first .. first + many, by two range reads."""
        spans = list(struct.iter_unpack("<QQ", self._read(self.index + 16 * first, 16 * many)))
        begin, end = spans[0][0], sum(spans[-1])
        data = self._read(self.data + begin, end - begin)
        return [zlib.decompress(data[a - begin : a - begin + n], 31) for a, n in spans]

    def close(self) -> None:
        self.file.close()


# ---------------------------------------------------------------- operators


def write_packages(pages: DataFrame, path: str, min_bytes: int = 0) -> DataFrame:
    """Writes page_id, url and html below path (a shared folder's URI); gives file and records.

    Evaluate the result once, as each evaluation writes. Only names that come back
    count, so a task that runs twice leaves at most a file nobody reads.
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    sums = p.select("page_id", F.sha1(F.col("html").cast("binary")).alias("sha"), F.octet_length("html").alias("n"))
    last = sums.where(F.col("n") >= min_bytes).groupBy("sha").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("many")).where("many > 1 AND last IS NOT NULL")
    refer = sums.where(F.col("n") >= min_bytes).join(last, "sha").where("page_id < last").select(F.col("page_id").alias("id"), F.col("sha").alias("of"), "last").distinct()
    p = p.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    rows = p.join(refer, (p["page_id"] == refer["id"]) & (p["sha"] == refer["of"]), "left").select("page_id", "url", "html", F.unhex("sha").alias("sha"), "last")

    def run(batches):
        fs, root = _open(path)
        fs.create_dir(root, recursive=True)
        name, out, member, index, at = f"part-{uuid.uuid4().hex[:16]}.wacz", None, None, [], 0
        for batch in batches:
            ids, last = batch.column("page_id").to_pylist(), batch.column("last").to_pylist()
            urls, shas = batch.column("url").to_pylist(), batch.column("sha").to_pylist()
            for page, url, html, sha, to in zip(ids, urls, column_bytes(batch.column("html")), shas, last, strict=True):
                if out is None:
                    stream = fs.open_output_stream(f"{root}/{name}")
                    out = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED, allowZip64=True)
                    member = out.open(DATA, "w", force_zip64=True)
                pack = zlib.compressobj(1, zlib.DEFLATED, 31)
                data = pack.compress(record(page, url, html, base64.b32encode(sha).decode(), to)) + pack.flush()
                member.write(data)
                index.append(struct.pack("<QQ", at, len(data)))
                at += len(data)
        if out is not None:
            member.close()
            out.writestr(INDEX, b"".join(index))
            out.close()
            stream.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [len(index)]}, schema=pa.schema([("file", pa.string()), ("records", pa.int64())]))

    return rows.mapInArrow(run, "file string, records bigint")


def read_packages(spark: SparkSession, path: str, files: list[tuple[str, int]], per_task: int = 5_000) -> DataFrame:
    """page_id, url, payload (null for a revisit), payload_bytes, payload_digest, record_type and refers_to of all records."""
    work = [(f, a, min(per_task, n - a)) for f, n in files for a in range(0, n, per_task)]
    plan = spark.createDataFrame(work or [("", 0, 0)], "file string, first long, many long")

    def run(batches):
        fs, root = _open(path)
        for batch in batches:
            for file, first, many in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not many:
                    continue
                package = Package(fs, f"{root}/{file}")
                for a in range(first, first + many, 200):
                    out = []
                    for data in package.fetch(a, min(200, first + many - a)):
                        h, block = parse_record(data)
                        page, to = (x.rpartition(":")[2] for x in (h["WARC-Page-ID"], h.get("WARC-Refers-To-Page", "")))
                        full = h["WARC-Type"] == "response"
                        sha = h["WARC-Payload-Digest"].removeprefix("sha1:")
                        if full and digest(block) != sha:
                            raise ValueError(f"{file}: the payload of {h['WARC-Record-ID']} does not have its digest")
                        out.append((int(page) if page else None, h["WARC-Target-URI"], block if full else None, len(block) if full else int(h["WARC-Payload-Bytes"]), sha, h["WARC-Type"], int(to) if to else None))
                    kinds = (pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"])
                package.close()

    return plan.repartition(max(1, min(len(work), 4 * spark.sparkContext.defaultParallelism))).mapInArrow(run, "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def op4_zip_warc(spark, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    files = [(r["file"], r["records"]) for r in write_packages(table(spark, sf_dir, "pages"), path).collect()]  # a row per file
    return read_packages(spark, path, files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: DuckDB has no SHA-1, so payload_digest can't come from SQL; the test compares whole rows with brute force.
