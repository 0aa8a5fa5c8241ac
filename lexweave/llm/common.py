"""Shared pieces: the scratch folder, words and hashes of their sequences, map helpers.

Words are split in UTF-8: every byte of 0x80 and above belongs to a word, so ASCII
classes hold for whole code points too. Words are hashed by mixing eight bytes at a time,
sequences of words by mixing halves; caches compare the bytes themselves.
"""

from __future__ import annotations

import atexit
import hashlib
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from itertools import filterfalse
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java and RE2 class of word characters for these words.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder in spark.checkpoint.dir. Where it is unset: a folder of the driver's in local mode, else an error."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        where = sc.getConf().get("spark.checkpoint.dir")
        if not where and not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(where or f"/tmp/lexweave-{uuid.uuid4().hex[:12]}")
    return sc._jsc.sc().getCheckpointDir().get()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; what it holds goes when the driver's Python ends."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    atexit.register(_remove, spark, path)
    if _WATCHED:
        _WATCHED[-1].append(path)
    return path


@contextmanager
def made_here() -> Iterator[list[str]]:
    """A list that gets the path of every table written within; release_paths() deletes them when nothing reads them any more."""
    _WATCHED.append([])
    try:
        yield _WATCHED[-1]
    finally:
        _WATCHED.pop()


_WATCHED: list[list[str]] = []


def release_paths(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        _remove(spark, path)


def cut(df: DataFrame, name: str = "cut", **options: str) -> DataFrame:
    """Write a table into the shared folder and read it back: the lineage ends there. options: the writer's.

    The shuffle files of the query that wrote it go then: nothing reads them again.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete a table that cut has written and nothing reads any more."""
    _remove(df.sparkSession, df._cut_path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def match_rows(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Joins on doc_id and _rk; a null doc_id equals a null doc_id. right has each pair once."""
    r = right.withColumnsRenamed({"doc_id": "_d", "_rk": "_r"})
    return left.join(r, left["doc_id"].eqNullSafe(r["_d"]) & (left["_rk"] == r["_r"]), how).drop("_d", "_r")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """mapInArrow with a function of one batch; empty batches give nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


# ---------------------------------------------------------------- words and their hashes


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


#: Seeds of two independent hashes of words.
NUMBERS, NUMBERS2 = 0x5851F42D4C957F2D, 0x14057B7EF767814F
CHUNK = 4_000_000


def chunks(text: bytes, most: int = CHUNK) -> Iterator[bytes]:
    """A text in stretches of about so many bytes that end where a word ends, so that few words are objects at once."""
    at = 0
    while len(text) - at > most and (gap := _GAP.search(text, at + most)):
        yield text[at : gap.start()]
        at = gap.start()
    yield text[at:] if at else text


_GAP = re.compile(rb"(?<=[^\x20\x09-\x0d])[\x20\x09-\x0d]")


#: Bytes of a word that are hashed in lanes of eight; longer words go to BLAKE2b.
_LANED = 256
_IN_WORD = np.array([b not in b"\x20\x09\x0a\x0b\x0c\x0d" for b in range(256)])
_LANES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def word_numbers(texts: list[bytes], *seeds: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The words between ASCII white space of texts: the place of each text's first word (and the end), and a hash of each word by each seed."""
    counts, found = np.zeros(len(texts), np.int64), [[] for _ in seeds]
    pieces, owners, size = [], [], 0

    def flush() -> None:
        n, numbers = _numbers(pieces, seeds)
        np.add.at(counts, owners, n)
        for part, new in zip(found, numbers, strict=True):
            part.append(new)

    for i, text in enumerate(texts):
        for piece in chunks(text):
            if pieces and size + len(piece) > CHUNK:
                flush()
                pieces, owners, size = [], [], 0
            pieces.append(piece)
            owners.append(i)
            size += len(piece)
    if pieces:
        flush()
    return np.append(0, np.cumsum(counts)), [np.concatenate(part) if part else np.zeros(0, np.uint64) for part in found]


def _numbers(pieces: list[bytes], seeds: tuple[int, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The number of words of each piece, and by seed their hashes: eight bytes at a time are mixed into 64 bits."""
    buf = b" ".join([*pieces, bytes(8)])
    edges = np.diff(_IN_WORD[np.frombuffer(buf, np.uint8)[:-8]].view(np.int8), prepend=np.int8(0))
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    lanes = np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))
    length = end - start
    out = []
    for seed in seeds:
        h = mix((lanes[start] & _LANES[np.minimum(length, 8)]) ^ mix(length.astype(np.uint64) + np.uint64(seed)))
        at, more = 8, np.flatnonzero(length > 8)
        while len(more) and at < _LANED:
            h[more] = mix(h[more] * np.uint64(0x9E3779B97F4A7C15) + (lanes[start[more] + at] & _LANES[np.minimum(length[more] - at, 8)]))
            at += 8
            more = more[length[more] > at]
        for i in more.tolist():
            h[i] = int.from_bytes(hashlib.blake2b(buf[start[i] : end[i]], digest_size=8, key=seed.to_bytes(8, "little")).digest(), "little")
        out.append(h)
    offsets = np.append(0, np.cumsum([len(p) + 1 for p in pieces]))
    return np.diff(np.searchsorted(start, offsets)), out


def windows(values: np.ndarray, size: int) -> np.ndarray:
    """A hash of every `size` consecutive values. Halves are mixed as in a tree, so no algebra of the sequence carries over."""
    if len(values) < size:
        return np.zeros(0, np.uint64)
    pair = lambda x, y: mix(x * np.uint64(0x9E3779B97F4A7C15) + y)
    out, done, width, part = None, 0, 1, mix(values)
    while True:
        if size & width:
            out = part if out is None else pair(out[: len(part) - done], part[done:])
            done += width
        if done == size:
            return out
        part = pair(part[:-width], part[width:])
        width *= 2


def column_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return [b"" if x is None else x for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def slices(sizes: list[int], most: int = 3_000_000) -> Iterator[tuple[int, int]]:
    """Stretches of a batch of about so many bytes, so numpy buffers stay small."""
    at = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(sizes):
        yield at, len(sizes)


# ---------------------------------------------------------------- row identity


def with_row_key(df: DataFrame, *content: str) -> DataFrame:
    """Adds _rk, a hash of the content columns: with doc_id it tells rows of one id apart.

    Rows that are equal in all of them count as one document where documents are counted.
    """
    return df.withColumn("_rk", F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in content]))


def packed(df: DataFrame, *columns: str) -> DataFrame:
    """_row, a struct of all columns, and the named ones beside it: no name in df clashes with an operator's own."""
    quoted = ["`" + c.replace("`", "``") + "`" for c in df.columns]
    return df.select(F.struct(*quoted).alias("_row"), *columns)


def unpacked(df: DataFrame, **changed: Column) -> DataFrame:
    """The columns of _row, some with new values."""
    names = df.schema["_row"].dataType.names
    return df.select(*[changed[c].alias(c) if c in changed else F.col("_row").getField(c).alias(c) for c in names])


class PieceCache(dict):
    """piece -> its record, by the bytes of the piece themselves; a worker's. Of two generations of at most half of `most` bytes the older goes."""

    #: What an entry takes besides its bytes.
    ENTRY = 180

    def __init__(self, most: int = 80_000_000):
        super().__init__()
        self.most, self.held, self.older = most, 0, {}
        self.wanted, self.missed = set(), 0

    def __missing__(self, piece: bytes) -> bytes | None:
        """The record in the older generation, which becomes a younger one; else None, and the piece is wanted."""
        known = self.older.get(piece)
        if known is None:
            self.wanted.add(piece)
            self.missed += 1
        else:
            self[piece] = known
            self.held += self.ENTRY + len(piece) + len(known)
        return known

    def fill(self, pieces: Iterable[bytes], learn: Callable[[list[bytes]], list[bytes]]) -> None:
        """Records of the pieces that are missing."""
        for p in set(filterfalse(self.__contains__, pieces)):
            self[p]
        self._learn_wanted(learn)

    def records(self, lists: list[list[bytes]], learn: Callable[[list[bytes]], list[bytes]]) -> list[list[bytes]]:
        """The records of lists of pieces. Each piece is looked up once; only missing ones a second time, when they are learned."""
        found, gaps, seen = [], [], self.missed
        for i, pieces in enumerate(lists):
            found.append(itemgetter(*pieces)(self) if len(pieces) > 1 else [self[p] for p in pieces])
            if self.missed > seen:
                gaps.append(i)
                seen = self.missed
        self._learn_wanted(learn)
        for i in gaps:
            found[i] = [self[p] if r is None else r for p, r in zip(lists[i], found[i], strict=True)]
        return found

    def _learn_wanted(self, learn: Callable[[list[bytes]], list[bytes]]) -> None:
        new, self.wanted = list(self.wanted), set()
        for i in range(0, len(new), 50_000):
            part = new[i : i + 50_000]
            got = learn(part)
            self.update(zip(part, got, strict=True))
            self.held += sum(map(len, part)) + sum(map(len, got)) + self.ENTRY * len(part)

    def trim(self) -> None:
        if self.held > self.most // 2:
            self.older, self.held = dict(self), 0
            self.clear()
