"""Secret scans, native: pattern spans, and multipart linking by an interval join.

Base kinds are found in every text and always reported: assign, access, hex. Weak
candidates are identifiers (ident), long runs of base64 letters (key) and hosts
(endpoint). An identifier (ident or access) and a secret (assign, hex or key) that
do not overlap and lie at most SCOPE code points apart in one text are linked; a weak
ident or key is reported when linked, an endpoint when a linked secret is as near.
A key that overlaps a base span is no candidate.

Null texts count as empty; an empty table gives no rows; repeated rows give a row
each; text lengths are unlimited (positions are summed in blocks).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, match_rows, table, with_row_key

SCOPE = 200
KINDS = ("assign", "access", "hex", "ident", "key", "endpoint")
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the first AKIA of a run gives its longest match, so the length can be in the pattern
HEX = r"[0-9a-f]{24,}"
IDENT = r"""([Cc]lient_?[Ii]d|[Aa]ccount|[Uu]ser(?:_?name)?|[Ll]ogin)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KEY = r"[A-Za-z0-9+/]{32,}"
ENDPOINT = r"https?://[A-Za-z0-9.-]+"
BLOCK = 256
SPAN = "array<struct<start:int,end:int,kind:int>>"


def spans(text: Column, pattern: str, kind: int, least: int = 0) -> Column:
    """Spans of the leftmost non-overlapping matches; least: length that group 2 needs.

    Gaps between matches come from split(), lengths from the matches themselves;
    running sums go in blocks, so that many matches in one text stay cheap.
    """
    hits, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    keep = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if least else hits
    steps = F.transform(
        F.arrays_zip(hits.alias("h"), F.slice(gaps, 1, F.greatest(F.size(gaps) - 1, F.lit(0))).alias("g"), keep.alias("k")),
        lambda x: F.struct(F.char_length(x["g"]).alias("gap"), F.char_length(x["h"]).alias("size"), (F.char_length(x["k"]) >= least).alias("ok")),
    )

    def step(s: Column, x: Column) -> Column:
        start = s["at"] + x["gap"]
        one = F.when(x["ok"], F.array(F.struct(start.alias("start"), (start + x["size"]).alias("end"), F.lit(kind).alias("kind")))).otherwise(F.array().cast(SPAN))
        return F.struct((start + x["size"]).alias("at"), F.concat(s["out"], one.cast(SPAN)).cast(SPAN).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int")), lambda b: F.aggregate(F.slice(steps, b * BLOCK + 1, BLOCK), zero, step))

    def later(s: Column, b: Column) -> Column:
        moved = F.transform(b["out"], lambda x: F.struct((x["start"] + s["at"]).alias("start"), (x["end"] + s["at"]).alias("end"), x["kind"].alias("kind")))
        return F.struct((s["at"] + b["at"]).alias("at"), F.concat(s["out"], moved).cast(SPAN).alias("out"))

    return F.when(text.rlike(pattern), F.aggregate(blocks, zero, later)["out"]).otherwise(F.array().cast(SPAN))


def find_parts(docs: DataFrame) -> DataFrame:
    """doc_id, _rk, base and weak: arrays of struct<start, end, kind> (kind: index in KINDS)."""
    d = with_row_key(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text")
    join = lambda *a: F.flatten(F.array(*a))
    base = join(spans(F.col("text"), ASSIGN, 0, 6), spans(F.col("text"), ACCESS, 1), spans(F.col("text"), HEX, 2))
    weak = join(spans(F.col("text"), IDENT, 3, 3), spans(F.col("text"), KEY, 4), spans(F.col("text"), ENDPOINT, 5))
    d = d.withColumn("base", base).withColumn("weak", weak)
    clear = lambda w: (w["kind"] != 4) | ~F.exists("base", lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"]))
    return d.select("doc_id", "_rk", "base", F.filter("weak", clear).alias("weak"))


def link(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, _rk and linked: the weak spans that complementary parts confirm."""
    all_ = F.concat("base", "weak")
    has = lambda *kinds: F.exists(all_, lambda x: x["kind"].isin(*kinds))
    rows = parts.where((F.size("weak") > 0) & has(1, 3) & has(0, 2, 4)).select("doc_id", "_rk", F.explode(all_).alias("x")).select("doc_id", "_rk", "x.*").distinct()
    cells = lambda d, more: d.withColumn("cell", F.explode(F.sequence(F.floor((F.col("start") - more) / scope), F.floor((F.col("end") + more) / scope))))

    def near(a: DataFrame, b: DataFrame, apart: bool) -> DataFrame:
        """Rows of a beside rows of b in one text, at most scope apart."""
        y = cells(b, 0).withColumnsRenamed({"start": "s2", "end": "e2", "kind": "k2", "doc_id": "d2", "_rk": "r2", "cell": "c2"})
        x = cells(a, scope)
        on = (x["_rk"] == y["r2"]) & x["doc_id"].eqNullSafe(y["d2"]) & (x["cell"] == y["c2"]) & (F.col("s2") - F.col("end") <= scope) & (F.col("start") - F.col("e2") <= scope)
        if apart:
            on &= (F.col("s2") >= F.col("end")) | (F.col("start") >= F.col("e2"))
        return x.join(y, on)

    side = ["doc_id", "_rk", "start", "end", "kind"]
    pairs = near(rows.where(F.col("kind").isin(1, 3)), rows.where(F.col("kind").isin(0, 2, 4)), True)
    idents = pairs.where("kind = 3").select(*side)
    secrets = pairs.select("doc_id", "_rk", F.col("s2").alias("start"), F.col("e2").alias("end"), F.col("k2").alias("kind")).distinct()
    ends = near(rows.where("kind = 5"), secrets, False).select(*side)
    found = reduce(DataFrame.unionByName, [idents, secrets.where("kind = 4"), ends]).distinct()
    return found.groupBy("doc_id", "_rk").agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("linked"))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, base and linked of every document; texts are read once."""
    parts = cut(find_parts(docs), "parts")
    out = match_rows(parts, link(parts, scope), "left")
    return out.select("doc_id", "base", F.coalesce("linked", F.array().cast(SPAN)).alias("linked"))


def _listed(c: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.sort_array(F.transform(c, lambda x: F.struct(x["start"].alias("a"), x["kind"].alias("k"), x["end"].alias("b"))))
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["a"], x["b"])), ",")


def op8_secret_scan(spark, sf_dir: str) -> DataFrame:
    out = scan(table(spark, sf_dir, "documents"))
    n = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return out.select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.concat("base", "linked")).alias("spans"),
    )


def _sql() -> str:
    q = lambda p: p.replace("'", "''")
    one = lambda k, p, least: f"""SELECT doc_id, {k} AS kind, unnest(regexp_extract_all(text, '{q(p)}')) AS h, unnest(regexp_extract_all(text, '{q(p)}', {2 if least else 0})) AS g,
      unnest(list_slice(regexp_split_to_array(text, '{q(p)}'), 1, -2)) AS gap, {least} AS least, generate_subscripts(regexp_extract_all(text, '{q(p)}'), 1) AS i FROM documents WHERE regexp_matches(text, '{q(p)}')"""  # noqa: E731
    parts = " UNION ALL ".join(one(k, p, n) for k, p, n in ((0, ASSIGN, 6), (1, ACCESS, 0), (2, HEX, 0), (3, IDENT, 3), (4, KEY, 0), (5, ENDPOINT, 0)))
    return f"""
WITH m AS ({parts}), p AS (
  SELECT doc_id, kind, CAST(sum(length(gap) + length(h)) OVER w AS BIGINT) AS e, CAST(sum(length(gap) + length(h)) OVER w AS BIGINT) - length(h) AS s, length(g) >= least AS ok
  FROM m WINDOW w AS (PARTITION BY doc_id, kind ORDER BY i)
), a AS (
  SELECT doc_id, kind, s, e FROM p x WHERE ok AND (kind <> 4 OR NOT EXISTS (SELECT 1 FROM p b WHERE b.doc_id = x.doc_id AND b.kind < 3 AND b.ok AND b.s < x.e AND x.s < b.e))
), l AS (
  SELECT i.doc_id, i.kind AS ik, i.s AS i_s, i.e AS i_e, k.kind AS kk, k.s, k.e FROM a i JOIN a k ON i.doc_id = k.doc_id
  WHERE i.kind IN (1, 3) AND k.kind IN (0, 2, 4) AND k.s - i.e <= {SCOPE} AND i.s - k.e <= {SCOPE} AND (k.s >= i.e OR i.s >= k.e)
), r AS (
  SELECT doc_id, kind, s, e FROM a WHERE kind < 3
  UNION SELECT doc_id, 3, i_s, i_e FROM l WHERE ik = 3
  UNION SELECT doc_id, 4, s, e FROM l WHERE kk = 4
  UNION SELECT a.doc_id, 5, a.s, a.e FROM a JOIN l ON a.doc_id = l.doc_id WHERE a.kind = 5 AND l.s - a.e <= {SCOPE} AND a.s - l.e <= {SCOPE}
), n AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(({list(KINDS)!r})[kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind) AS spans,
    string_agg(({list(KINDS)!r})[kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind) FILTER (kind < 3) AS base
  FROM r GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id
"""


SQL = _sql()
