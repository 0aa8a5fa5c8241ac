"""Queries over the driver's tables, and what SQL makes of the same tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import chars
from ..operators import checks, ids, lines, meta, pages, tokens, views
from . import statutes
from .corpus import Corpus


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _docs(spark, d) -> DataFrame:
    """Dealt out by doc_id: a file may hold its rows in one row group, which one task reads. Later steps over doc_id need no other shuffle."""
    return _t(spark, d, "documents").select("doc_id", "text").repartition("doc_id")


def _doc_lines(spark, d) -> DataFrame:
    return lines.raw_lines(_docs(spark, d))


def _corpus(spark, d, records: str, columns: str, once: bool = True) -> Corpus:
    """The Acts of the tables, of whose tree one query reads these records and columns once."""
    acts = statutes.acts(_t(spark, d, "orders"), _t(spark, d, "lineitem"), _t(spark, d, "part"), once)
    return Corpus(acts, keep=False, records=tuple(records.split()), columns=tuple(columns.split()))


def f01_sanitise(spark, d):
    return _docs(spark, d).select("doc_id", F.sha2(chars.sanitise("text"), 256).alias("clean"))


def f02_letter_counts(spark, d):
    return _docs(spark, d).select("doc_id", chars.letter_counts("text").alias("c")).select("doc_id", "c.eng", "c.kan")


def f03_span_class(spark, d):
    font = F.when(F.col("doc_id") % 5 == 0, "Nudi01e").when(F.col("doc_id") % 5 == 1, "Times").otherwise("")
    c = _docs(spark, d).withColumn("font", font).withColumn("c", chars.span_class("text", "font"))
    return c.select("doc_id", "c.lang", "c.encoding", chars.bcp47(F.col("c.lang"), F.col("c.encoding"), chars.font_encoding("font")).alias("tag"))


def f08_misencoded(spark, d):
    return _docs(spark, d).select("doc_id", F.round(chars.misencoded_share("text", "A-Za-z"), 9).alias("share"))


def f14_numbers(spark, d):
    p = _t(spark, d, "part")
    return p.select("p_partkey", chars.normal_num(F.concat(F.lit("Section "), "p_name", F.lit(" ("), F.col("p_size").cast("string"), F.lit(").bis."))).alias("num"))


def f17_words(spark, d):
    key = F.col("p_partkey")
    p = _t(spark, d, "part").withColumn("size", F.col("p_size").cast("string"))
    word = F.concat("p_name", F.element_at(F.array(*map(F.lit, (" categories", "Sub-sections", " class", ""))), (key % 4 + 1).cast("int")))
    kind = F.element_at(F.array(*map(F.lit, ("section", "chapter", "clause", "rule", "subsection"))), (key % 5 + 1).cast("int"))
    tag = F.element_at(F.array(*map(F.lit, ("kn-Latn-x-nudi", "kn", "kn-x-Misencoded"))), (key % 3 + 1).cast("int"))
    return p.select(
        "p_partkey", chars.keyword(word).alias("keyword"), chars.num_key(F.concat(F.lit(" (IV-"), "size", F.lit(")\t"))).alias("num"), chars.display_num(kind, F.col("size")).alias("shown"),
        chars.href(F.concat(F.lit("#sec_"), "size"), F.lit("/akn/in-ka/act/2020/1/eng@"), key % 2 == 0).alias("href"), chars.is_legacy_tag(tag).alias("legacy"),
        chars.escape_xml(F.concat("p_name", F.lit(' <a href="x">&amp;'))).alias("escaped"), chars.local_name(F.concat(F.lit("{urn:x}"), "p_name")).alias("name"),
    )


def f19_units(spark, d):
    li, key = _t(spark, d, "lineitem"), F.col("l_orderkey")
    sec, chp = F.concat(F.lit("sec_"), F.col("l_linenumber").cast("string")), F.concat(F.lit("chp_"), (key % 9 + 1).cast("string"))
    eid = F.when(key % 4 == 0, F.concat_ws("__", chp, sec, F.lit("subsec_2"))).when(key % 4 == 1, F.concat_ws("__", F.lit("part_I"), chp, sec)).when(key % 4 == 2, F.concat_ws("__", sec, F.lit("cl_a")))
    e = li.select("l_orderkey", "l_linenumber", F.coalesce(eid, F.concat_ws("__", F.lit("part_I"), chp)).alias("eid"))
    odd = F.when(key % 5 == 0, F.concat("eid", F.lit(" x"))).otherwise(F.col("eid"))
    return e.select("l_orderkey", "l_linenumber", "eid", chars.enclosing_unit("eid").alias("unit"), F.array_join(chars.ancestors("eid"), "|").alias("ancestors"), chars.is_conformant(odd).alias("conformant"))


def f30_order(spark, d):
    at = (F.col("o_orderkey") % 20).cast("int")
    letter, roman = (F.get(F.array(*map(F.lit, x)), at) for x in (chars.LETTERS, chars.ROMANS))
    alpha = F.col("o_orderkey") % 2 == 0
    num = F.when(alpha, letter).otherwise(roman)
    after = F.when(alpha, chars.successor("alpha", letter)).otherwise(chars.successor("roman", roman))
    return _t(spark, d, "orders").select("o_orderkey", num.alias("num"), chars.predecessor(F.when(alpha, "alpha").otherwise("roman"), num).alias("before"), after.alias("after"))


def f22_slug(spark, d):
    return _t(spark, d, "part").select("p_partkey", chars.slug("p_name").alias("slug"), chars.short_name("p_name").alias("short"))


def f25_uris(spark, d):
    o = _t(spark, d, "orders")
    day = F.date_format("o_orderdate", "d"), F.date_format("o_orderdate", "MMMM"), F.date_format("o_orderdate", "yyyy")
    work = chars.work_uri(F.lit("in-ka"), F.lit("act"), chars.iso_date(*day), F.lit(""), F.col("o_orderkey").cast("string"))
    return o.select("o_orderkey", work.alias("work"), chars.manifestation_uri(chars.expression_uri(work, F.lit("eng"), F.lit(""))).alias("manifestation"))


def _page_stats(spark, d):
    c = _t(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page"), chars.letter_counts("text").alias("c"), F.char_length("text").alias("n"))
    return pages.page_stats(c.select("doc_id", "page", F.col("c.eng").alias("target"), (F.col("n") - F.col("c.eng")).alias("foreign")))


def p01_pages(spark, d):
    return _page_stats(spark, d).select("doc_id", "page", "kept", "reason")


def p02_readmit(spark, d):
    return pages.readmit(_page_stats(spark, d)).select("doc_id", "page", "kept", "reason")


def p05_furniture(spark, d):
    return _doc_lines(spark, d).groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines"), F.count_if(lines.is_content()).alias("kept"))


def l06_orphans(spark, d):
    return lines.stitch_orphans(_doc_lines(spark, d)).select("doc_id", "line_no", "text")


def l07_reflow(spark, d):
    return lines.reflow(_doc_lines(spark, d)).select("doc_id", "line_no", F.sha2("text", 256).alias("text"))


def l02_runs(spark, d):
    c = _t(spark, d, "conversations")
    box = F.lit(1).alias("block"), F.lit(1).alias("line")
    s = c.select(F.col("conv_id").alias("doc_id"), F.lit(1).alias("page"), *box, F.col("turn").alias("span"), "text", F.when(F.col("role") == "user", "Nudi01e").otherwise("Times").alias("font"))
    r = pages.span_runs(s)
    return r.select("doc_id", F.posexplode("pieces").alias("run", "p")).select("doc_id", "run", "p.kind", F.sha2("p.text", 256).alias("text"))


def k04_ranges(spark, d):
    e = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page"))
    return checks.ranges(e)


def w02_attrs(spark, d):
    p = _t(spark, d, "pages")
    return p.select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.regexp_extract("html", r'\blang="([^"]*)"', 1).alias("lang"), F.size(F.regexp_extract_all("html", F.lit(r"<a\s[^>]*href=([^ >]*)"))).cast("long").alias("links"))


def t03_markers(spark, d):
    return tokens.resolve_markers(statutes.word_list(_t(spark, d, "orders"))).select("doc_id", "tok_no", "kind", "num")


def t04_headings(spark, d):
    p = _t(spark, d, "part").select("p_partkey", F.concat("p_name", F.lit(".-(1) Size "), F.col("p_size").cast("string")).alias("t"))
    return p.select("p_partkey", tokens.split_heading(F.col("t")).alias("h")).select("p_partkey", "h.heading", "h.rest")


def i02_eids(spark, d):
    return _corpus(spark, d, "node", "eid kind depth num").nodes.select(F.col("doc_id").cast("long").alias("doc_id"), "eid", "kind", "depth")


def i05_collisions(spark, d):
    c = _corpus(spark, d, "node table", "node_id kind eid copies", once=False)
    return ids.collisions(c.tree).select(F.col("doc_id").cast("long").alias("doc_id"), "eid", "copies")


def i05_duplicates(spark, d):
    return i05_collisions(spark, d).where("eid NOT LIKE '%\\_\\_%'")


def c05_external(spark, d):
    return _corpus(spark, d, "text", "node_id block_no kind context eid text headings").cited.where("external").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).select(F.col("doc_id").cast("long").alias("doc_id"), "n")


def m01_meta(spark, d):
    return _corpus(spark, d, "front", "text rows heading").meta.select(F.col("doc_id").cast("long").alias("doc_id"), "number", "year", "jurisdiction", "work_date", "title", "manifestation_uri")


def v04_dangling(spark, d):
    li = _t(spark, d, "lineitem")
    e = li.select(F.col("l_orderkey").alias("doc_id"), F.concat(F.lit("sec_"), F.col("l_linenumber").cast("string")).alias("eid"))
    r = _t(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.concat(F.lit("#sec_"), (F.col("o_orderkey") % 7 + 1).cast("string")).alias("href"))
    return checks.dangling(r, e).select("doc_id", "href")


def v05_residue(spark, d):
    p = _t(spark, d, "part").select(F.col("p_partkey").alias("doc_id"), F.concat("p_name", F.repeat(F.lit("ಕ"), (F.col("p_size") % 4).cast("int"))).alias("text"))
    return checks.residue(p).select("doc_id", "letters")


def w01_outline(spark, d):
    return _corpus(spark, d, "node", "eid kind num heading name schedule_no").outline.select(F.col("doc_id").cast("long").alias("doc_id"), "eid", "parent_eid", "label")


QUERIES = {f.__name__: f for f in (
    f01_sanitise, f02_letter_counts, f03_span_class, f08_misencoded, f14_numbers, f17_words, f19_units, f22_slug, f25_uris, f30_order, p01_pages, p02_readmit, p05_furniture, l02_runs, l06_orphans, l07_reflow, k04_ranges,
    w01_outline, w02_attrs, t03_markers, t04_headings, i02_eids, i05_duplicates, i05_collisions, c05_external, m01_meta, v04_dangling, v05_residue,
)}

# ---------------------------------------------------------------- SQL

_LETTERS = r"regexp_replace(coalesce(text, ''), '[^\p{L}]', '', 'g')"
_N = lambda c, k: f"length(regexp_replace({c}, '[^{k}]', '', 'g'))"
_SANE = rf"regexp_replace(coalesce(text, ''), '{chars.NOT_XML}', '', 'g')"
_CLEAN = (
    rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({_SANE}, '[\x{{2010}}\x{{2011}}]', '-', 'g'), '[\x{{2018}}\x{{2019}}]', '''', 'g'), "
    rf"'[\x{{201C}}\x{{201D}}]', chr(34), 'g'), '[\x{{00A0}}\x{{2007}}\x{{202F}}]', ' ', 'g'), '[ \t]+', ' ', 'g'), '\n{{2,}}', chr(10), 'g'), '([\p{{L}}\p{{N}}_])-\n([a-z])', '\1\2', 'g')"
)
_LINES = f"""
raw AS (SELECT doc_id, generate_subscripts(string_split({_CLEAN}, chr(10)), 1) - 1 AS line_no, trim(unnest(string_split({_CLEAN}, chr(10))), ' ' || chr(9) || chr(13) || chr(12) || chr(11)) AS text FROM documents),
ln AS (SELECT * FROM raw WHERE text <> '')"""
_q = lambda p: p.replace("'", "''")
_SEC = "sec AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n FROM lineitem)"
_STATS = rf"""
s AS (SELECT conv_id AS doc_id, turn AS page, {_N(_LETTERS, chars.LATIN)} AS t, length(coalesce(text, '')) AS n FROM conversations),
p AS (SELECT doc_id, page, CASE WHEN t < 200 THEN 'too few letters' WHEN t / n < 0.55 THEN 'share below threshold' ELSE '' END AS reason FROM s)"""
ORACLES = {
    "f01_sanitise": f"SELECT doc_id, sha256({_SANE}) AS clean FROM documents",
    "f02_letter_counts": f"SELECT doc_id, {_N(_LETTERS, chars.LATIN)} AS eng, {_N(_LETTERS, chars.KANNADA)} AS kan FROM documents",
    "f03_span_class": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_N("coalesce(text, '')", chars.LATIN)} AS latin, {_N("coalesce(text, '')", '\\x{00C0}-\\x{024F}')} AS acc FROM documents),
c AS (SELECT doc_id, CASE WHEN NOT regexp_matches(text, '\S') THEN 'neutral' WHEN regexp_matches(text, '[{chars.KANNADA}]') THEN 'kan' WHEN latin > 0 AND (doc_id % 5 = 0 OR acc / latin > 0.25) THEN 'kanl' WHEN latin > 0 THEN 'eng' ELSE 'neutral' END AS x FROM d)
SELECT doc_id, CASE x WHEN 'kanl' THEN 'kan' ELSE x END AS lang, CASE x WHEN 'kanl' THEN 'legacy' WHEN 'neutral' THEN '' ELSE 'unicode' END AS encoding,
  CASE x WHEN 'kanl' THEN 'kn-Latn-x-nudi' WHEN 'kan' THEN 'kn' WHEN 'eng' THEN 'en' ELSE 'neutral-Latn-x-nudi' END AS tag FROM c""",
    "f08_misencoded": rf"""
WITH d AS (SELECT doc_id, {_N("coalesce(text, '')", chars.SYMBOLS)} - {_N("coalesce(text, '')", chars.GOOD_SYMBOLS)} AS w, {_N("coalesce(text, '')", 'A-Za-z')} AS l FROM documents)
SELECT doc_id, round(CASE WHEN w + l = 0 THEN 0.0 ELSE w / (w + l) END, 9) AS share FROM d""",
    "f14_numbers": "SELECT p_partkey, array_to_string(list_filter(string_split_regex(replace(p_name, ' ', '') || '(' || p_size || ').bis', '[^A-Za-z0-9]+'), lambda x: x <> ''), '-') AS num FROM part",
    "f17_words": r"""
WITH w AS (SELECT *, regexp_replace(lower(p_name || [' categories', 'Sub-sections', ' class', ''][p_partkey % 4 + 1]), '[-\s]', '', 'g') AS w FROM part)
SELECT p_partkey, CASE WHEN ends_with(w, 'ies') THEN left(w, -3) || 'y' WHEN ends_with(w, 's') AND NOT ends_with(w, 'ss') THEN left(w, -1) ELSE w END AS keyword, 'iv-' || p_size AS num,
  [p_size || '.', p_size::VARCHAR, '(' || p_size || ')', p_size || '.', '(' || p_size || ')'][p_partkey % 5 + 1] AS shown,
  CASE WHEN p_partkey % 2 = 0 THEN '/akn/in-ka/act/2020/1/eng@/!main' ELSE '' END || '#sec_' || p_size AS href, p_partkey % 3 <> 1 AS legacy, p_name || ' &lt;a href=&quot;x&quot;&gt;&amp;amp;' AS escaped, p_name AS name FROM w""",
    "f19_units": """
WITH e AS (SELECT l_orderkey, l_linenumber, 'sec_' || l_linenumber AS s, 'chp_' || (l_orderkey % 9 + 1) AS c FROM lineitem),
p AS (SELECT *, CASE l_orderkey % 4 WHEN 0 THEN [c, s, 'subsec_2'] WHEN 1 THEN ['part_I', c, s] WHEN 2 THEN [s, 'cl_a'] ELSE ['part_I', c] END AS p FROM e)
SELECT l_orderkey, l_linenumber, array_to_string(p, '__') AS eid, CASE l_orderkey % 4 WHEN 0 THEN c || '__' || s WHEN 1 THEN 'part_I__' || c || '__' || s WHEN 2 THEN s ELSE '' END AS unit,
  array_to_string(list_transform(range(len(p), -1, -1), lambda n: array_to_string(p[1:n], '__')), '|') AS ancestors, l_orderkey % 5 <> 0 AS conformant FROM p""",
    "f30_order": f"""
WITH o AS (SELECT o_orderkey, o_orderkey % 20 + 1 AS i, CASE WHEN o_orderkey % 2 = 0 THEN {chars.LETTERS!r} ELSE {chars.ROMANS!r} END AS l FROM orders)
SELECT o_orderkey, l[i] AS num, CASE WHEN i > 1 THEN l[i - 1] END AS before, l[i + 1] AS after FROM o""",
    "f22_slug": """
SELECT p_partkey, CASE WHEN len(w) = 0 THEN 'term' ELSE lower(w[1]) || array_to_string(list_transform(w[2:], lambda x: upper(x[1]) || lower(x[2:])), '') END AS slug,
  CASE WHEN len(r) = 0 THEN 'Act' ELSE array_to_string(list_transform(r, lambda x: upper(x[1]) || lower(x[2:])), '') END AS short
FROM (SELECT p_partkey, regexp_extract_all(p_name, '[A-Za-z0-9]+') AS w, regexp_extract_all(p_name, '[A-Za-z]+|[0-9]+') AS r FROM part)""",
    "f25_uris": "SELECT o_orderkey, '/akn/in-ka/act/' || strftime(o_orderdate, '%Y-%m-%d') || '/' || o_orderkey AS work, '/akn/in-ka/act/' || strftime(o_orderdate, '%Y-%m-%d') || '/' || o_orderkey || '/eng@.xml' AS manifestation FROM orders",
    "p01_pages": f"WITH {_STATS} SELECT doc_id, page, reason = '' AS kept, reason FROM p",
    "p02_readmit": f"""WITH {_STATS}, b AS (SELECT *, min(CASE WHEN reason = '' THEN page END) OVER w AS a, max(CASE WHEN reason = '' THEN page END) OVER w AS z FROM p WINDOW w AS (PARTITION BY doc_id))
SELECT doc_id, page, coalesce(page BETWEEN a AND z, false) AS kept, CASE WHEN reason <> '' AND page BETWEEN a AND z THEN 're-admitted' ELSE reason END AS reason FROM b""",
    "p05_furniture": f"WITH {_LINES} SELECT doc_id, count(*) AS lines, count(*) FILTER (NOT regexp_matches(text, '{_q(lines.FURNITURE)}')) AS kept FROM ln GROUP BY doc_id",
    "l06_orphans": rf"""WITH {_LINES}, b AS (SELECT *, coalesce(lag(regexp_matches(text, '{_q(lines.STRANDED)}')) OVER (PARTITION BY doc_id ORDER BY line_no), false) AS glued FROM ln),
g AS (SELECT *, sum(CASE WHEN glued THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS g FROM b)
SELECT doc_id, CAST(min(line_no) AS INTEGER) AS line_no, string_agg(text, ' ' ORDER BY line_no) AS text FROM g GROUP BY doc_id, g""",
    "l07_reflow": rf"""WITH {_LINES}, b AS (SELECT *, regexp_matches(text, '{_q(lines.CAPS)}') AS caps, lag(text) OVER (PARTITION BY doc_id ORDER BY line_no) AS was FROM ln),
c AS (SELECT *, was IS NULL OR caps <> regexp_matches(was, '{_q(lines.CAPS)}') OR (regexp_matches(text, '{_q(lines.STARTS)}') AND NOT (regexp_matches(was, '{_q(lines.CITES_ON)}') OR (regexp_matches(text, '{_q(lines.CITED)}') AND NOT regexp_matches(was, '{_q(lines.CLOSED)}')))) AS new FROM b),
g AS (SELECT *, sum(CASE WHEN new THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS g FROM c)
SELECT doc_id, CAST(min(line_no) AS INTEGER) AS line_no, sha256(trim(regexp_replace(string_agg(text, ' ' ORDER BY line_no), '\s+', ' ', 'g'))) AS text FROM g GROUP BY doc_id, g""",
    "l02_runs": rf"""
WITH t AS (SELECT conv_id, turn, role, {_SANE} AS text FROM conversations), d AS (SELECT conv_id AS doc_id, turn, text, {_N('text', chars.LATIN)} AS latin, {_N('text', '\\x{00C0}-\\x{024F}')} AS acc, role FROM t WHERE text <> ''),
k AS (SELECT *, latin > 0 AND (role = 'user' OR acc / latin > 0.25) AS f, CASE WHEN latin > 0 AND (role = 'user' OR acc / latin > 0.25) THEN 'foreign' ELSE 'text' END AS kind FROM d),
b AS (SELECT *, CASE WHEN lag(kind) OVER (PARTITION BY doc_id ORDER BY turn) = kind THEN 0 ELSE 1 END AS new FROM k),
g AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY turn) AS g FROM b)
SELECT doc_id, CAST(g - 1 AS INTEGER) AS run, kind, sha256(string_agg(text, '' ORDER BY turn)) AS text FROM g GROUP BY doc_id, g, kind""",
    "k04_ranges": """
WITH d AS (SELECT DISTINCT l_orderkey AS doc_id, l_linenumber AS page FROM lineitem), g AS (SELECT *, page - row_number() OVER (PARTITION BY doc_id ORDER BY page) AS g FROM d),
r AS (SELECT doc_id, min(page) AS a, max(page) AS b FROM g GROUP BY doc_id, g)
SELECT doc_id, string_agg(CASE WHEN a = b THEN a::VARCHAR ELSE a || '-' || b END, ', ' ORDER BY a) AS ranges FROM r GROUP BY doc_id""",
    "w02_attrs": r"""SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract(html, '\blang="([^"]*)"', 1) AS lang, len(regexp_extract_all(html, '<a\s[^>]*href=([^ >]*)')) AS links FROM pages""",
    "t03_markers": f"""
WITH n AS (SELECT o_orderkey AS doc_id, unnest(range(0, o_orderkey % 20 + 1)) AS i FROM orders)
SELECT doc_id, CAST(i AS INTEGER) AS tok_no, CASE WHEN doc_id % 2 = 0 THEN 'alpha' ELSE 'roman' END AS kind,
  CASE WHEN doc_id % 2 = 0 THEN {chars.LETTERS!r}[i + 1] ELSE {chars.ROMANS!r}[i + 1] END AS num FROM n""",
    "t04_headings": "SELECT p_partkey, p_name AS heading, '(1) Size ' || p_size AS rest FROM part",
    "i02_eids": f"""WITH {_SEC}, x AS (SELECT k, 'sec_' || n AS s FROM sec)
SELECT k AS doc_id, s || e AS eid, kind, CAST(depth AS INTEGER) AS depth FROM x, (VALUES ('', 'section', 1), ('__subsec_1', 'subsection', 2), ('__subsec_2', 'subsection', 2), ('__subsec_2__cl_a', 'clause', 3), ('__subsec_2__cl_b', 'clause', 3), ('__subsec_2__proviso_1', 'proviso', 3)) v(e, kind, depth)""",
    "i05_duplicates": "SELECT l_orderkey AS doc_id, 'sec_' || l_linenumber AS eid, count(*) AS copies FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
    "i05_collisions": """WITH r AS (SELECT l_orderkey AS k, 'sec_' || l_linenumber AS s, count(*) AS copies FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
SELECT k AS doc_id, s || e AS eid, copies FROM r, (VALUES ('', 'section', 1), ('__subsec_1', 'subsection', 2), ('__subsec_2', 'subsection', 2), ('__subsec_2__cl_a', 'clause', 3), ('__subsec_2__cl_b', 'clause', 3), ('__subsec_2__proviso_1', 'proviso', 3)) v(e, kind, depth)""",
    "c05_external": f"WITH {_SEC} SELECT k AS doc_id, count(*) AS n FROM sec WHERE n % 2 = 1 GROUP BY k",
    "m01_meta": """
WITH d AS (SELECT DISTINCT o_orderkey AS k, o_orderdate AS d FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
SELECT k AS doc_id, (k % 60 + 1)::VARCHAR AS number, strftime(d, '%Y') AS year, 'in-ka' AS jurisdiction, strftime(d, '%Y-%m-%d') AS work_date, 'An Act to provide for orders.' AS title,
  '/akn/in-ka/act/' || strftime(d, '%Y-%m-%d') || '/' || (k % 60 + 1) || '/eng@' || strftime(d, '%Y-%m-%d') || '.xml' AS manifestation_uri FROM d""",
    "v04_dangling": "SELECT o_orderkey AS doc_id, '#sec_' || (o_orderkey % 7 + 1) AS href FROM orders ANTI JOIN lineitem ON l_orderkey = o_orderkey AND l_linenumber = o_orderkey % 7 + 1",
    "v05_residue": "SELECT p_partkey AS doc_id, CAST(p_size % 4 AS BIGINT) AS letters FROM part WHERE p_size % 4 > 0",
}
