"""Substring dedup with a log-structured index of window fingerprints.

A window is SIZE consecutive words. Its fingerprint is the least hash of the GRAM-word
stretches in it, so equal windows have equal fingerprints and neighbours mostly share
one: the index takes few rows a document. It consists of immutable runs, tables sorted
by fingerprint. A new batch becomes a run; it is merge-joined with all runs, which gives
the fingerprints that a document of the batch shares with one of a smaller doc_id. Only
windows with those are then compared, all of their words by 96 bits of two independent
hashes, and the smallest doc_id of each is found. Runs beyond FAN_IN are merged into one.

Batches come in ascending doc_id. Exact copies are recognised by a hash of the whole text
and neither indexed nor compared: all their windows start in the smallest id of the copies.

Rows that share a doc_id are documents of their own, none of them smaller. A row without
doc_id is smaller and larger than none: it is kept whole and never a source. A null text
has no words. An empty table gives no rows. Texts are never cut.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import NUMBERS, NUMBERS2, column_bytes, cut, map_batches, match_rows, mix, scratch, slices, table, windows, with_row_key, word_numbers

SIZE, GRAM, FAN_IN, BATCHES = 50, 16, 2, 2


def fingerprints(first: np.ndarray, numbers: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, text and fingerprint of every window of texts; first, numbers: as word_numbers() gives them."""
    n = len(numbers)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(np.arange(n) + size <= first[1:][text]) if n else np.zeros(0, np.int64)
    if not len(at):
        return at, at, np.zeros(0, np.uint64)
    least = windows(numbers, gram)
    width, want = 1, size - gram + 1
    while width < want:  # least[i] spans width stretches
        step = min(width, want - width)
        least = np.minimum(least[: len(least) - step], least[step:])
        width += step
    return at, text[at], least[at]


def _ids(batch, a: int, b: int) -> list[pa.Array]:
    return [batch.column(c).slice(a, b - a) for c in ("doc_id", "_rk")]


def anchors(docs: DataFrame, size: int, gram: int) -> DataFrame:
    """fp, doc_id, _rk: the fingerprints of each document."""

    def run(batches):
        for batch in batches:
            texts = column_bytes(batch.column("text"))
            for a, b in slices([len(t) for t in texts]):
                first, (numbers,) = word_numbers(texts[a:b], NUMBERS)
                _, text, fp = fingerprints(first, numbers, size, gram)
                if len(fp):
                    new = np.append(True, (fp[1:] != fp[:-1]) | (text[1:] != text[:-1]))
                    which = pa.array(text[new])
                    yield pa.RecordBatch.from_arrays([pa.array(fp[new].view(np.int64)), *(c.take(which) for c in _ids(batch, a, b))], ["fp", "doc_id", "_rk"])

    return docs.select("doc_id", "_rk", "text").mapInArrow(run, "fp bigint, doc_id bigint, _rk bigint")


def shared_windows(docs: DataFrame, size: int, gram: int) -> DataFrame:
    """Windows of doc_id, _rk, text whose fingerprint is in fps: wh and w2 (hashes), pos, found.

    found: a smaller doc_id of the same stretch of the table has the window. Such a row
    needs no comparison any more and gets a hash of its own, so a window of very many
    documents meets in one task only once a stretch.
    """

    def run(batches):
        for batch in batches:
            texts = column_bytes(batch.column("text"))
            for a, b in slices([len(t) for t in texts]):
                first, (numbers, numbers2) = word_numbers(texts[a:b], NUMBERS, NUMBERS2)
                at, text, fp = fingerprints(first, numbers, size, gram)
                lists = batch.column("fps").slice(a, b - a)
                owner = np.repeat(np.arange(b - a), pa.compute.list_value_length(lists).to_numpy())
                wanted = lists.flatten().to_numpy().view(np.uint64)
                tie = lambda x, t: mix(x + t.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                keep = np.isin(tie(fp, text), tie(wanted, owner))
                at, text = at[keep], text[keep]
                if not len(at):
                    continue
                wh, w2 = windows(numbers, size)[at], (windows(numbers2, size)[at] >> np.uint64(33)).astype(np.int64)
                ids = batch.column("doc_id").slice(a, b - a).to_numpy()[text]
                order = np.lexsort((ids, w2, wh))
                head = np.append(True, (wh[order][1:] != wh[order][:-1]) | (w2[order][1:] != w2[order][:-1]))
                least = ids[order][head][np.cumsum(head) - 1]
                found = np.zeros(len(at), bool)
                found[order] = ids[order] > least
                wh = np.where(found, mix(wh + ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + at.astype(np.uint64)), wh)
                pos = at - first[text]
                which = pa.array(text)
                yield pa.RecordBatch.from_arrays([pa.array(wh.view(np.int64)), pa.array(w2.astype(np.int32)), *(c.take(which) for c in _ids(batch, a, b)), pa.array(pos.astype(np.int32)), pa.array(found)], ["wh", "w2", "doc_id", "_rk", "pos", "found"])

    return docs.select("doc_id", "_rk", "text", "fps").mapInArrow(run, "wh bigint, w2 int, doc_id bigint, _rk bigint, pos int, found boolean")


class FingerprintIndex:
    """Runs below a path in a shared folder, and the documents they index.

    runs: names of a present index's runs, as add() left them.
    """

    def __init__(self, spark: SparkSession, path: str, size: int = SIZE, gram: int = GRAM, fan_in: int = FAN_IN, runs: list[str] | None = None):
        self.spark, self.path, self.size, self.gram, self.fan_in = spark, path, size, gram, fan_in
        self.runs, self.made = runs or [], len(runs or [])

    def read(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [self.spark.read.parquet(r) for r in self.runs])

    def _write(self, rows: DataFrame) -> str:
        self.made += 1
        name = f"{self.path}/run-{self.made}"
        rows.repartitionByRange("fp").sortWithinPartitions("fp", "doc_id", "_rk").write.parquet(name)
        return name

    def add(self, batch: DataFrame, documents: DataFrame, copies: DataFrame | None = None) -> DataFrame:
        """doc_id, _rk and at (first words of windows that a smaller doc_id has) of the batch's documents.

        batch: doc_id, _rk, text, none of it in the index; documents: at least all that is
        in the index and the batch; copies: doc_id, _rk of rows that are left out.
        """
        rows = anchors(batch, self.size, self.gram)
        if copies is not None:
            rows = match_rows(rows, copies, "left_anti")
        self.runs.append(self._write(rows))
        new, every = self.spark.read.parquet(self.runs[-1]), self.read()
        first = every.groupBy("fp").agg(F.min("doc_id").alias("least"))
        hit = new.hint("merge").join(first, "fp").where("least < doc_id").select("fp").distinct()
        wanted = every.join(hit, "fp", "left_semi").groupBy("doc_id", "_rk").agg(F.collect_set("fp").alias("fps"))
        rows = shared_windows(match_rows(documents.where("doc_id IS NOT NULL"), wanted), self.size, self.gram)
        rows = rows.withColumn("least", F.min("doc_id").over(W.partitionBy("wh", "w2"))).where("found OR least < doc_id")
        hits = rows.groupBy("doc_id", "_rk").agg(F.collect_list("pos").alias("at"))
        hits = cut(match_rows(hits, new.select("doc_id", "_rk").distinct(), "left_semi"), "hits")
        if len(self.runs) > self.fan_in or (len(self.runs) == self.fan_in and self.fan_in > 1):
            self.runs = [self._write(self.read().distinct())]
        return hits


def repeated(docs: DataFrame, size: int = SIZE, gram: int = GRAM, batches: int = BATCHES, fan_in: int = FAN_IN) -> DataFrame:
    """doc_id, _rk, at, copy of the rows that repeat something: at as in add(), copy for exact copies."""
    spark = docs.sparkSession
    d = with_row_key(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "text")
    sums = d.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "_rk", F.xxhash64(F.lit(1), "text").alias("h"))
    same = sums.groupBy("_rk", "h").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    copies = cut(sums.join(same, ["_rk", "h"]).where("doc_id > first").select("doc_id", "_rk").distinct(), "copies")
    index = FingerprintIndex(spark, scratch(spark, "index"), size, gram, fan_in)
    ends = d.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000).alias("q")).first()["q"] or []
    cuts = sorted(set(ends))
    out = [copies.withColumn("at", F.array().cast("array<int>")).withColumn("copy", F.lit(True))]
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        part = d.where("doc_id IS NOT NULL")
        part = part if low is None else part.where(F.col("doc_id") > low)
        part = part if high is None else part.where(F.col("doc_id") <= high)
        upto = d if high is None else d.where(F.col("doc_id") <= high)
        out.append(index.add(part, upto, copies).withColumn("copy", F.lit(False)))
    return reduce(DataFrame.unionByName, out)


SCHEMA = "doc_id bigint, n_words bigint, n_removed bigint, kept string"


def remove(docs: DataFrame, size: int = SIZE, digests: bool = False, **how) -> DataFrame:
    """doc_id, n_words, n_removed and kept: the words left, joined by a blank (or their SHA-256)."""
    d = with_row_key(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "text")
    d = match_rows(d, repeated(docs, size, **how), "left").select("doc_id", "text", "at", F.coalesce("copy", F.lit(False)).alias("copy"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, at, copy in zip(column_bytes(batch.column("text")), batch.column("at"), batch.column("copy").to_pylist(), strict=True):
            words = text.split()
            n, kept = len(words), words
            if copy and n >= size:
                kept = []
            elif at.is_valid and len(at):
                gone = np.zeros(n + 1, np.int64)
                begin = at.values.to_numpy()
                np.add.at(gone, begin, 1)
                np.add.at(gone, begin + size, -1)
                kept = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
            text = b" ".join(kept)
            out.append((n, n - len(kept), hashlib.sha256(text).hexdigest() if digests else text.decode()))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, k) for x, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string()), strict=True))], ["doc_id", "n_words", "n_removed", "kept"])

    return map_batches(d, run, SCHEMA)


def op10_substring_index(spark, sf_dir: str) -> DataFrame:
    return remove(table(spark, sf_dir, "documents"), digests=True).withColumnRenamed("kept", "kept_sha256")


SQL = rf"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + {SIZE - 1}], ' ')) AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - {SIZE - 2})) AS i FROM w)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY x) AS first FROM win) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {SIZE})) AS p FROM hit),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""
