"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

The test strings are the windows of the benchmark items: m consecutive words, or
the whole item where it has fewer. Strings of one length make a searcher: a shift
table over blocks of two words lets a cursor skip positions that cannot end an
occurrence, a hash of the last block selects the strings to try, and the words
themselves are compared before an occurrence counts. Cursors run over many stretches
of a batch in lock step, which is how numpy does the loop.

The benchmark is written to the shared folder; executors read it in blocks of at most
BLOCK_BYTES of text, however large it is, and search every block in each stretch of
whole documents. So documents are read once and no item passes the driver.

Null or wordless texts have no words and are never hit; an item without words gives
no string; items with equal windows all count; repeated rows give a row each; a
null item_id is left out of the list. Empty tables give no rows, or no hits.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, column_bytes, cut, match_rows, packed, slices, table, unpacked, with_row_key

SIZE = 8
LEAST_ITEMS = 2
BLOCK_BYTES = 16_000_000
STRETCH = 512
#: A-Z to a-z; what is no digit, letter or byte above 0x7F ends a word and becomes a blank.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b > 0x7F or chr(b).isalnum() else 32 for b in range(256))


class Searcher:
    """Strings of m words; find() gives ends of occurrences and which strings they are."""

    def __init__(self, strings: list[tuple[int, ...]]):
        self.m = m = len(strings[0])
        self.block = min(2, m)
        self.strings = np.array(strings, np.int64)
        self.bits = max(12, int(np.log2(len(strings) * m + 1)) + 3)
        self.shift = np.full(1 << self.bits, m - self.block + 1, np.int64)
        for at in range(self.block - 1, m):  # a block that ends at `at` lets the cursor move to the string's end
            slot = self.slot(self.strings[:, at - 1] if self.block == 2 else 0 * self.strings[:, at], self.strings[:, at])
            np.minimum.at(self.shift, slot, m - 1 - at)
        last = self.slot(self.strings[:, m - 2] if self.block == 2 else 0 * self.strings[:, -1], self.strings[:, -1])
        self.order = np.argsort(last, kind="stable")
        self.first = np.searchsorted(last[self.order], np.arange((1 << self.bits) + 1))

    def slot(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)
        return ((x * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids: words as numbers, 0 for one that no string has; texts are apart by zeros."""
        n, m = len(ids), self.m
        if n < m:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        cursor = np.arange(m - 1, n, STRETCH)
        stop = np.minimum(cursor + STRETCH, n)
        found = []
        while len(cursor):
            slot = self.slot(ids[cursor - 1] if self.block == 2 else 0 * ids[cursor], ids[cursor])
            step = self.shift[slot]
            if (hit := step == 0).any():
                found.append((cursor[hit], slot[hit]))
            cursor = cursor + np.maximum(step, 1)
            on = cursor < stop
            cursor, stop = cursor[on], stop[on]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        end, slot = (np.concatenate(x) for x in zip(*found, strict=True))
        many = self.first[slot + 1] - self.first[slot]
        end = np.repeat(end, many)
        which = self.order[np.repeat(self.first[slot] - (np.cumsum(many) - many), many) + np.arange(len(end))]
        same = (ids[end[:, None] + np.arange(1 - m, 1)] == self.strings[which]).all(1)
        return end[same], which[same]


class Strings:
    """Searchers over the windows of some items (id and text)."""

    def __init__(self, items: list[tuple[str, bytes]], size: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in text.translate(PLAIN).split()]
            for i in range(max(1, len(words) - size + 1) if words else 0):
                owners[tuple(words[i : i + size])].add(item)
        by_length = defaultdict(list)
        for s in owners:
            by_length[len(s)].append(s)
        self.searchers = [(Searcher(s), [sorted(owners[x]) for x in s]) for s in by_length.values()]

    def numbers(self, text: bytes) -> np.ndarray:
        """The words of a text by their number in the vocabulary; 0 for one that no item has."""
        parts = []
        for piece in chunks(text.translate(PLAIN)):
            words = piece.split()
            parts.append(np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words)))
        return np.concatenate(parts)

    def search(self, texts: list[bytes]) -> tuple[list[int], list[tuple[int, np.ndarray, np.ndarray, np.ndarray, list[list[str]]]]]:
        """The number of words of each text; per length of string: the length, the text and first word of each occurrence, the string, each string's items."""
        found = [self.numbers(t) for t in texts]
        sizes = np.array([len(x) for x in found], np.int64)
        begin = np.append(0, np.cumsum(sizes + 1))  # a zero after each text
        ids = np.concatenate([y for x in found for y in (x, np.zeros(1, np.int64))]) if found else np.zeros(0, np.int64)
        out = []
        for s, items in self.searchers:
            end, which = s.find(ids)
            start = end - (s.m - 1)
            text = np.searchsorted(begin, start, "right") - 1
            out.append((s.m, text, start - begin[text], which, items))
        return sizes.tolist(), out


SCHEMA = "doc_id bigint, _rk bigint, n_words bigint, runs array<struct<a:bigint,b:bigint>>, items array<string>"


def read_blocks(uri: str, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """Lists of items of at most so many bytes of text (or one longer item) from a table of item_id and text."""
    import pyarrow.parquet as pq
    from pyarrow.fs import FileSelector, FileSystem

    fs, root = FileSystem.from_uri(uri)
    held, size = [], 0
    for f in sorted(x.path for x in fs.get_file_info(FileSelector(root)) if x.path.endswith(".parquet")):
        with fs.open_input_file(f) as opened:
            for batch in pq.ParquetFile(opened).iter_batches(1000, columns=["item_id", "text"]):
                for item, text in zip(batch.column("item_id").to_pylist(), column_bytes(batch.column("text")), strict=True):
                    if held and size + len(text) > block_bytes:
                        yield held
                        held, size = [], 0
                    held.append((item, text))
                    size += len(text)
    yield held


#: The worker's searchers of the last benchmark that is one block.
_ONLY: dict[str, Strings] = {}


def _strings(uri: str, size: int, block_bytes: int) -> Iterator[Strings]:
    if (key := f"{uri} {size} {block_bytes}") in _ONLY:
        yield _ONLY[key]
        return
    made, last = 0, None
    for items in read_blocks(uri, block_bytes):
        last = None  # one block is held at a time
        last = Strings(items, size)
        made += 1
        yield last
    if made == 1:
        _ONLY.clear()
        _ONLY[key] = last


def _search_batches(uri: str, size: int, block_bytes: int):
    def run(batches):
        for batch in batches:
            texts = column_bytes(batch.column("text"))
            runs, names, sizes = [[] for _ in texts], [set() for _ in texts], []
            for block in _strings(uri, size, block_bytes):
                sizes = []
                for a, b in slices([len(t) for t in texts]):
                    n, found = block.search(texts[a:b])
                    sizes += n
                    for length, text, start, which, owners in found:
                        for s, k, d in zip(start.tolist(), which.tolist(), (text + a).tolist(), strict=True):
                            names[d].update(owners[k])
                            runs[d].append((s, s + length))
            if texts:
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), batch.column("_rk"), pa.array(sizes, pa.int64()),
                    pa.array([[{"a": x, "b": y} for x, y in _joined(r)] for r in runs], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                    pa.array([sorted(x) for x in names], pa.list_(pa.string())),
                ], ["doc_id", "_rk", "n_words", "runs", "items"])

    return run


def _joined(runs) -> list[tuple[int, int]]:
    """The union of half-open runs."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def search(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, _rk, n_words, runs (hit stretches of words, from and to) and items, a row per document."""
    d = with_row_key(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "text")
    items = cut(benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), "text"), "benchmark")
    return d.mapInArrow(_search_batches(items._cut_path, size, block_bytes), SCHEMA)


def clean(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, least_items: int = LEAST_ITEMS) -> DataFrame:
    """The documents that contain windows of fewer than so many items, with all their columns."""
    hit = search(docs, benchmark, size).where(F.size("items") >= least_items).select("doc_id", "_rk").distinct()
    d = packed(docs, F.col("doc_id").cast("long").alias("doc_id"), "text")
    return unpacked(match_rows(with_row_key(d, "text"), hit, "left_anti"))


def op6_decontaminate(spark, sf_dir: str) -> DataFrame:
    d = search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate(F.transform("runs", lambda r: r["b"] - r["a"]), F.lit(0).cast("bigint"), lambda a, b: a + b)
    return d.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"), (F.size("items") >= LEAST_ITEMS).alias("contaminated"),
    )


def result_sql(source: str = "documents", size: int = SIZE, least: int = LEAST_ITEMS) -> str:
    """CTEs that end in `leaks`."""
    words = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
b_words AS (SELECT item_id, {words} AS w FROM benchmark WHERE item_id IS NOT NULL),
b_win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS x
  FROM (SELECT item_id, w, least(len(w), {size}) AS n, unnest(range(1, greatest(len(w) - {size - 1}, 1) + 1)) AS i FROM b_words WHERE len(w) > 0)),
d_words AS (SELECT doc_id, coalesce({words}, []) AS w FROM {source}),
d_win AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS x
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d_words, (SELECT DISTINCT n FROM b_win) WHERE len(w) >= n)),
d_hit AS (SELECT DISTINCT doc_id, d_win.n, i, item_id FROM d_win JOIN b_win ON d_win.x = b_win.x AND d_win.n = b_win.n),
d_pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM d_hit)) GROUP BY doc_id),
d_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM d_hit) GROUP BY doc_id),
leaks AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_items, 0) >= {least} AS contaminated
  FROM d_words LEFT JOIN d_pos USING (doc_id) LEFT JOIN d_items USING (doc_id))"""


SQL = f"WITH {result_sql()} SELECT * FROM leaks"
