"""Token ids in length-delimited binary record files with an offset index.

A record: payload length (8 bytes, little-endian), masked CRC-32 of those bytes
(4), payload, masked CRC-32 of the payload (4). The mask rotates the CRC by 15 bits
and adds 0xA282EAD8, so that a CRC of data that holds CRCs stays useful. A payload:
doc_id (8 bytes, signed; NULL_ID for null), bytes an id takes (1: 2 or 4), ids.
Beside a file F stands F.idx: for each record its offset and its number of ids, 8
bytes each, so readers can fetch records in any order without a scan.

Files hold ascending doc_ids, and file k's ids come before file k + 1's; equal ids
keep no order among their rows but the ids of ties are the same bytes in any order of
equal texts (rows are sorted by doc_id, then text). A null text is empty: its
record holds the end id alone. An empty table writes no files and gives no rows.

Ids come from the tokenizers library. It is asked once per distinct piece between
the pattern's boundaries and worker, as its merges never cross those.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import PieceCache, chunks, column_bytes, scratch, slices, table

NAME = "byte_bpe_50k.json"
END_ID = 0
MASK = 0xA282EAD8
NULL_ID = -(2**63)
#: White space beyond ASCII: texts that hold some go to the library whole.
UNUSUAL = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
#: A word of letters (the first of ASCII, others of ASCII or U+00C0 to U+017F but two signs) that another character of ASCII ends; any other word; white space but the last before a word; white space.
PIECE = re.compile(rb" ?[A-Za-z]++(?:(?!\xc3[\x97\xb7])[\xc3-\xc5][\x80-\xbf][A-Za-z]*+)*+(?=[\x00-@\[-`{-\x7f])| ?[^\t-\r ]++|[\t-\r ]+(?=[\t-\r ][^\t-\r ])|[\t-\r ]+")


def masked_crc(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked_crc(size)), payload, struct.pack("<I", masked_crc(payload))))


def unframe(data: bytes) -> bytes:
    """The payload of one framed record; ValueError where a checksum or the length is wrong."""
    if len(data) < 16 or struct.unpack_from("<I", data, 8)[0] != masked_crc(data[:8]):
        raise ValueError("bad record length")
    n = struct.unpack_from("<Q", data)[0]
    payload = data[12 : 12 + n]
    if len(data) != n + 16 or struct.unpack_from("<I", data, 12 + n)[0] != masked_crc(payload):
        raise ValueError("bad record payload")
    return payload


#: Texts of more bytes are taken in stretches.
CHUNKED = 4_000_000
#: New words that go to the library as one text; its time a word grows with the length of a text.
TOGETHER = 250


class PieceEncoder:
    """Ids of texts as bytes, by way of a bounded cache of pieces.

    The library's pattern never joins a word to what follows it, and takes from the
    white space before a word only one blank. So a text falls into words with the
    blank before them, and what other white space there is. New words go to the library many to a text,
    a line feed between each two, at whose id the result parts. A text with white space beyond
    ASCII or with a special token's string goes to it whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["normalizer"] or spec["post_processor"] or spec["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
            raise ValueError(f"{path} is not a byte-level BPE file of the expected form")
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]).encode())
        self.dtype = np.dtype("<u2" if self.lib.get_vocab_size() <= 65536 else "<u4")
        self.line_feed = self.lib.encode("\n").ids[0]
        self.cache = PieceCache(300_000_000)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, pieces: list[bytes]) -> list[bytes]:
        words = [i for i, p in enumerate(pieces) if not p.isspace()]
        out = [b""] * len(pieces)
        size = self.dtype.itemsize
        parts = [words[k : k + TOGETHER] for k in range(0, len(words), TOGETHER)]
        for part, flat in zip(parts, self.ids([b"\n".join([pieces[i] for i in part]).decode() for part in parts]), strict=True):
            data, a = flat.tobytes(), 0
            for i, b in zip(part, [*(np.flatnonzero(flat == self.line_feed) * size).tolist(), len(data)], strict=True):
                out[i], a = data[a:b], b + size
        space = [i for i, p in enumerate(pieces) if p.isspace()]
        for i, x in zip(space, self.ids([pieces[i].decode() for i in space]), strict=True):
            out[i] = x.tobytes()
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        odd = [i for i, t in enumerate(texts) if (not t.isascii() and UNUSUAL.search(t)) or (b"<|" in t and self.special.search(t))]
        whole = dict(zip(odd, self.ids([texts[i].decode() for i in odd]), strict=True)) if odd else {}
        plain = [None if i in whole else PIECE.findall(t) if len(t) <= CHUNKED else t for i, t in enumerate(texts)]
        known = iter(self.cache.records([p for p in plain if isinstance(p, list)], self.learn))
        out = [b"".join(next(known)) if isinstance(p, list) else p for p in plain]
        for i, p in enumerate(out):
            if i in whole:
                out[i] = whole[i].tobytes()
            elif isinstance(plain[i], bytes):
                out[i] = b"".join(map(self._stretch, chunks(p)))
        self.cache.trim()
        return out

    def _stretch(self, text: bytes) -> bytes:
        """Ids of a stretch of a long text that ends where a word ends."""
        found = PIECE.findall(text)
        self.cache.trim()
        return b"".join(self.cache.records([found], self.learn)[0])


def shared(path: str) -> PieceEncoder:
    """The worker's encoder, kept between tasks."""
    if path not in _SHARED:
        _SHARED[path] = PieceEncoder(path)
    return _SHARED[path]


_SHARED: dict[str, PieceEncoder] = {}


def _open(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


def write_records(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Writes doc_id and text as record files below path (a shared folder's URI).

    Returns file, part, records and ids of each file, in order by part. A file is
    written under a name of its own task attempt; only names returned by the attempt
    that Spark takes count, so a lost executor leaves at most files nobody reads.
    Evaluate the result once, as each evaluation writes.
    """

    def run(batches):
        from pyspark import TaskContext

        fs, root = _open(path)
        fs.create_dir(root, recursive=True)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex[:12]}.rec"
        enc = shared(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        out = index = None
        at = n = ids = 0
        for batch in batches:
            texts = column_bytes(batch.column("text"))
            keys = batch.column("doc_id").to_pylist()
            for a, b in slices([len(t) for t in texts]):
                if out is None:
                    out, index = fs.open_output_stream(f"{root}/{name}"), fs.open_output_stream(f"{root}/{name}.idx")
                records, rows = [], []
                for key, body in zip(keys[a:b], enc.encode(texts[a:b]), strict=True):
                    count = len(body) // enc.dtype.itemsize + 1
                    records.append(frame(struct.pack("<qB", NULL_ID if key is None else key, enc.dtype.itemsize) + body + end))
                    rows.append(struct.pack("<QQ", at, count))
                    at, n, ids = at + len(records[-1]), n + 1, ids + count
                out.write(b"".join(records))
                index.write(b"".join(rows))
        if out is not None:
            out.close()
            index.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "part": [part], "records": [n], "ids": [ids]}, schema=pa.schema([("file", pa.string()), ("part", pa.int64()), ("records", pa.int64()), ("ids", pa.int64())]))

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return d.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text").mapInArrow(run, "file string, part bigint, records bigint, ids bigint")


def read_records(spark: SparkSession, path: str, files: list[tuple[str, int, int]], per_task: int = 20_000) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian, 4 bytes each) of all records.

    files: name, records and ids before it, of each file. Tasks take stretches of a
    file's index and fetch only the bytes these name.
    """
    work = [(f, a, min(per_task, n - a), before) for f, n, before in files for a in range(0, n, per_task)]
    plan = spark.createDataFrame(work or [("", 0, 0, 0)], "file string, first long, many long, before long")

    def run(batches):
        fs, root = _open(path)
        for batch in batches:
            for file, first, many, before in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not many:
                    continue
                with fs.open_input_file(f"{root}/{file}.idx") as f:
                    index = np.frombuffer(f.read(), "<u8").reshape(-1, 2).astype(np.int64)
                starts = before + np.cumsum(index[:, 1]) - index[:, 1]
                with fs.open_input_file(f"{root}/{file}") as f:
                    ends = np.append(index[1:, 0], f.size())
                    for a in range(first, first + many, 500):
                        b = min(a + 500, first + many)
                        data = f.read_at(int(ends[b - 1] - index[a, 0]), int(index[a, 0]))
                        keys, ids = [], []
                        for i in range(a, b):
                            payload = unframe(data[index[i, 0] - index[a, 0] : ends[i] - index[a, 0]])
                            key, width = struct.unpack_from("<qB", payload)
                            x = np.frombuffer(payload, f"<u{width}", offset=9)
                            if len(x) != index[i, 1]:
                                raise ValueError(f"{file}: record {i} has {len(x)} ids, its index says {index[i, 1]}")
                            keys.append(None if key == NULL_ID else key)
                            ids.append(x.astype("<u4").tobytes())
                        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(starts[a:b]), pa.array(index[a:b, 1]), pa.array(ids, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return plan.repartition(max(1, min(len(work), 4 * spark.sparkContext.defaultParallelism))).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def manifest(written: DataFrame) -> list[tuple[str, int, int]]:
    """A list of files for read_records; one row per file, so bounded by the number of tasks."""
    out, before = [], 0
    for r in sorted(written.collect(), key=lambda r: r["part"]):
        out.append((r["file"], r["records"], before))
        before += r["ids"]
    return out


def op3_record_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch(spark, "records")
    files = manifest(write_records(table(spark, sf_dir, "documents"), path, public_tokenizers.path(NAME)))
    return read_records(spark, path, files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
