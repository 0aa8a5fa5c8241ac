"""Quality rules, native: per-document counts and cross-document line frequency.

A line is what stands between line feeds and holds a word. For the frequency it is
lower-cased, its white space collapsed and its digits made 0. Lines that occur in
more than max(min_docs, share x documents of the host) documents of one host are
removed; a document that keeps fewer than min_words words, or less than half of its
words, is depleted and rejected.

The host is column source; a null source is one host. Every row is one document,
also a repeated one. A null text has no words and fails the base rules. An empty
table gives no rows. Other columns are passed on by clean() and never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import GAP, cut, match_rows, packed, table, unpacked, with_row_key

MIN_WORDS = 20
MIN_DOCS = 5
SHARE = 0.02
LEFT = 0.5
WINDOW = 8


def _normal(line):
    return F.lower(F.regexp_replace(F.btrim(F.regexp_replace(line, GAP, " ")), "[0-9]+", "0"))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, _rk, host, the base counts and lines: array of struct<h, w>, hash and words of each."""
    d = with_row_key(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("source", F.lit("")).alias("host")), "text", "host")
    d = d.withColumn("words", F.filter(F.split("text", GAP), lambda w: w != ""))
    d = d.withColumn("raw", F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    d = d.select(
        "doc_id", "_rk", "host",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.regexp_replace("text", GAP, "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("raw") - F.size(F.array_distinct("raw"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("wh"),
        F.transform(F.transform("raw", _normal), lambda x: F.struct(F.xxhash64(x).alias("h"), F.size(F.split(x, " ")).alias("w"))).alias("lines"),
    )
    # windows of WINDOW words by hash; only texts with equal windows go further
    at = F.sequence(F.lit(0), F.col("n_words").cast("int") - WINDOW)
    d = d.withColumn("win", F.when(F.col("n_words") >= WINDOW, F.transform(at, lambda i: F.xxhash64(*[F.get("wh", i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))).drop("wh")
    d = d.withColumn("ordered", F.when(F.size(F.array_distinct("win")) < F.size("win"), F.sort_array(F.transform("win", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))).drop("win")
    twice = F.filter(F.transform("ordered", lambda s, k: F.when((F.get("ordered", k - 1)["x"] == s["x"]) | (F.get("ordered", k + 1)["x"] == s["x"]), s["i"])), lambda i: i.isNotNull())
    d = d.withColumn("at", F.sort_array(twice)).drop("ordered")
    covered = F.aggregate(F.transform("at", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("at", k + 1) - p, F.lit(WINDOW)))), F.lit(0), lambda a, b: a + b)
    return d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("at")


def judge(measured: DataFrame, min_words: int = MIN_WORDS, min_docs: int = MIN_DOCS, share: float = SHARE, left: float = LEFT) -> DataFrame:
    """Adds common (hashes of the document's lines above the limits), n_removed, base_failed and kept."""
    hosts = measured.groupBy("host").agg(F.count(F.lit(1)).alias("docs"))
    rows = measured.select("doc_id", "_rk", "host", F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))
    seen = rows.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > min_docs)
    above = seen.join(hosts, "host").where(F.col("n") > F.col("docs") * share).select("host", "h")
    common = rows.join(above, ["host", "h"]).groupBy("doc_id", "_rk").agg(F.sort_array(F.collect_set("h")).alias("common"))
    d = match_rows(measured, common, "left").withColumn("common", F.coalesce("common", F.array().cast("array<bigint>")))
    gone = F.aggregate(F.filter("lines", lambda x: F.array_contains("common", x["h"])), F.lit(0), lambda a, x: a + x["w"])
    d = d.withColumn("n_removed", gone.cast("long"))
    d = d.withColumn("base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    rest = F.col("n_words") - F.col("n_removed")
    return d.withColumn("kept", ~F.col("base_failed") & (rest >= min_words) & (rest >= left * F.col("n_words")))


def clean(docs: DataFrame, **limits) -> DataFrame:
    """The documents that are kept, with all their columns, without their lines above the limits."""
    judged = judge(cut(measure(docs), "measured"), **limits)
    kept = judged.where("kept").select("doc_id", "_rk", "common").dropDuplicates(["doc_id", "_rk"])
    d = packed(docs, "doc_id", F.coalesce("text", F.lit("")).alias("_t"), F.coalesce("source", F.lit("")).alias("_s"))
    d = match_rows(with_row_key(d, "_t", "_s"), kept)
    lines = F.filter(F.split("_t", "\n", -1), lambda x: ~F.array_contains("common", F.xxhash64(_normal(x))))
    text = F.when(F.size("common") == 0, F.col("_t")).otherwise(F.array_join(lines, "\n"))
    return unpacked(d, text=text)


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    d = judge(cut(measure(table(spark, sf_dir, "documents")), "measured"))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed")


def verdict_sql(source: str = "documents", min_words: int = MIN_WORDS, min_docs: int = MIN_DOCS, share: float = SHARE, left: float = LEFT) -> str:
    """CTEs that end in `verdict` (op2's rows) and `common_lines` (host, line)."""
    return rf"""
q_docs AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host FROM {source}),
q_words AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM q_docs),
q_base AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(list_sum(list_transform(w, lambda x: length(x))) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols
  FROM q_docs d JOIN q_words USING (doc_id)),
q_win AS (SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM q_words)),
q_twice AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS c FROM q_win) WHERE c > 1),
q_rep AS (SELECT doc_id, CAST(sum(least({WINDOW}, coalesce(after - i, {WINDOW}))) AS BIGINT) AS n_repeat_words FROM q_twice GROUP BY doc_id),
q_lines AS (
  SELECT doc_id, host, line, lower(regexp_replace(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')), '[0-9]+', '0', 'g')) AS norm
  FROM (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS line FROM q_docs) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
q_dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM q_lines GROUP BY doc_id),
common_lines AS (
  SELECT host, norm FROM (SELECT host, norm, count(DISTINCT doc_id) AS n FROM q_lines GROUP BY host, norm)
  JOIN (SELECT host, count(*) AS docs FROM q_docs GROUP BY host) USING (host) WHERE n > {min_docs} AND n > docs * {share}),
q_gone AS (SELECT doc_id, CAST(sum(len(string_split(norm, ' '))) AS BIGINT) AS n_removed FROM q_lines JOIN common_lines USING (host, norm) GROUP BY doc_id),
q_all AS (
  SELECT doc_id, n_words, coalesce(word_chars, 0) AS word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_removed, 0) AS n_removed
  FROM q_base LEFT JOIN q_rep USING (doc_id) LEFT JOIN q_dup USING (doc_id) LEFT JOIN q_gone USING (doc_id)),
verdict AS (
  SELECT *, n_words < {min_words} OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < {min_words} OR 100 * n_repeat_words > 30 * n_words) AND n_words - n_removed >= {min_words} AND n_words - n_removed >= {left} * n_words AS kept
  FROM q_all)"""


SQL = f"WITH {verdict_sql()} SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_removed FROM verdict"
