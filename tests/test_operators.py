"""Operators on small inline inputs."""

from types import SimpleNamespace

import duckdb
import pytest
from pyspark.sql import functions as F

from lexweave.functions import chars
from lexweave.operators import citations, ids, lines, meta, pages, render, tokens, tree, views
from lexweave.plans import queries
from lexweave.plans.corpus import Corpus
from lexweave.operators.tree import Placer


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_scalars(spark):
    lit = F.lit
    cases = [
        (chars.normal_num(lit("(1)")), "1"), (chars.normal_num(lit("12A.")), "12A"), (chars.normal_num(lit("(iv)")), "iv"), (chars.normal_num(lit("")), ""),
        (chars.element_ref(lit("section")), "sec"), (chars.element_ref(lit("proviso")), "proviso"),
        (chars.keyword(lit("sub-sections")), "subsection"), (chars.keyword(lit("categories")), "category"),
        (chars.num_key(lit("(IV)")), "iv"), (chars.enclosing_unit(lit("chp_III__sec_24__subsec_2")), "chp_III__sec_24"), (chars.enclosing_unit(lit("")), ""),
        (chars.ancestors(lit("a_1__b_2")), ["a_1__b_2", "a_1", ""]), (chars.slug(lit("Local body")), "localBody"), (chars.slug(lit("--")), "term"),
        (chars.is_conformant(lit("sec_1__subsec_2")), True), (chars.is_conformant(lit("sec-1_ x")), False),
        (chars.iso_date(lit("26"), lit("March"), lit("2020")), "2020-03-26"), (chars.iso_date(lit("31"), lit("Feb"), lit("2020")), None), (chars.iso_date(lit("1"), lit("Foo"), lit("2020")), ""),
        (chars.bcp47(lit("kan"), lit("unicode"), lit("nudi")), "kn"), (chars.bcp47(lit("kan"), lit("legacy"), lit("nudi")), "kn-Latn-x-nudi"), (chars.bcp47(lit("kan"), lit("suspect"), lit("nudi")), "kn-x-misencoded"),
        (chars.font_encoding(lit("ShreeLipi")), "shreelipi"), (chars.font_encoding(lit("Tunga")), "nudi"), (chars.sanitise(lit("a\u0001b\U0001F600")), "ab"),
    ]
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, (c, _) in enumerate(cases)]).first()
    assert [row[f"c{i}"] for i in range(len(cases))] == [w for _, w in cases]


def test_lines_to_tree(spark):
    text = (
        "KARNATAKA ACT NO. 04 OF 2020\nBe it enacted as follows:-\n1. Short title.-(1) This Act may\nbe called so, under sub-section\n(1) of section 8.\n(a) first;\nProvided that it rests.\n(b) second;\n(i) inner\n(ii) more\nFIRST SCHEDULE\n(See section 1)\nText of it."
    )
    d = spark.createDataFrame([("d", text)], "doc_id string, text string")
    out = tree.tree(tokens.tokens(lines.logical_lines(lines.raw_lines(d)))).persist()
    got = {r["eid"]: r["kind"] for r in ids.node_ids(out).collect()}
    assert got == {
        "sec_1": "section", "sec_1__subsec_1": "subsection", "sec_1__subsec_1__cl_a": "clause", "sec_1__subsec_1__proviso_1": "proviso", "sec_1__subsec_1__cl_b": "clause",
        "sec_1__subsec_1__cl_b__subcl_i": "subclause", "sec_1__subsec_1__cl_b__subcl_ii": "subclause", "att_1__hcontainer_1": "hcontainer",
    }
    first = out.where("record = 'block' AND node_id = 2").first()["text"]
    assert first == "This Act may be called so, under sub-section (1) of section 8."


def test_placer_restarted_list():
    class T:
        inline = heading = ""
        rows = None

        def __init__(self, kind, num="", text="x"):
            self.kind, self.num, self.text, self.raw = kind, num, text, text

    p = Placer()
    for t in (T("text", text="Be it enacted"), T("section", "1"), T("alpha", "a"), T("alpha", "b"), T("roman", "i"), T("alpha", "a"), T("alpha", "b"), T("roman", "ii"), T("alpha", "c")):
        p.feed(t)
    at = [(r["kind"], r["num"], r["depth"]) for r in p.finish() if r["record"] == "node"]
    assert at == [("section", "1", 1), ("clause", "a", 2), ("clause", "b", 2), ("subclause", "i", 3), ("point", "a", 4), ("point", "b", 4), ("subclause", "ii", 3), ("clause", "c", 2)]


def test_found_citations():
    f = citations.find("in clause (i) to (iv) of sub-section (1) of section 10, and section 6 of the General Clauses Act, 1899; the fourth proviso and the Schedule")
    assert [(x["kind"], x["external"]) for x in f] == [("chain", False), ("chain", True), ("schedule", False), ("proviso", False)]
    assert [[n["key"] for n in link["nums"]] for link in f[0]["links"]] == [["i", "iv"], ["1"], ["10"]]


def test_long_chain_walks_every_middle_link(spark):
    text = "under item (a) of sub-clause (i) of clause (b) of sub-section (2) of section 10, or item (z) of sub-clause (ix) of clause (b) of sub-section (2) of section 10"
    eids = ["sec_10", "sec_10__subsec_2", "sec_10__subsec_2__cl_b", "sec_10__subsec_2__cl_b__subcl_i", "sec_10__subsec_2__cl_b__subcl_i__item_a", "sec_10__subsec_2__cl_b__item_a", "sec_10__subsec_2__cl_b__item_z"]
    index = spark.createDataFrame([("d", e, e.split("__")[-1]) for e in eids], "doc_id string, eid string, tail string")
    texts = spark.createDataFrame([("d", "sec_1__content__p_1", "sec_1", text)], "doc_id string, owner string, context string, text string")
    refs, warnings = citations.resolve(citations.citations(texts), index)
    assert [(r["seq"], r["href"]) for r in refs.collect()] == [(0, "#sec_10__subsec_2__cl_b__subcl_i__item_a")]
    assert [r["reason"] for r in warnings.collect()] == ["subclause ix not found under sec_10__subsec_2__cl_b"]


def test_stored_metadata(spark):
    xml = """<?xml version="1.0" encoding="UTF-8"?>
<akomaNtoso xmlns="http://docs.oasis-open.org/legaldocml/ns/akn/3.0"><act name="act"><meta><identification source="#e">
<FRBRWork><FRBRthis value="w/!main"/><FRBRuri value="w"/><FRBRalias name="title" value="THE ACT, 2020"/><FRBRalias name="title" value="PÀ" xml:lang="kn-Latn-x-nudi"/><FRBRalias name="short" value="no"/>
<FRBRdate date="2020-03-26" name="assent"/><FRBRcountry value="in-ka"/><FRBRnumber value="4"/></FRBRWork>
<FRBRExpression><FRBRuri value="e"/><FRBRdate date="2020-03-27" name="publication"/><FRBRlanguage language="eng"/></FRBRExpression>
<FRBRManifestation><FRBRuri value="m"/><FRBRdate date="2024-01-01" name="generation"/></FRBRManifestation></identification>
<publication date="1999-09-09" name="Gazette" number="DPAL 12 SHASANA 2020"/><classification><keyword showAs="Rent Law"/><keyword showAs="Housing"/></classification></meta><body/>
<attachments><attachment><doc name="schedule"><meta><identification><FRBRWork><FRBRuri value="other"/></FRBRWork></identification></meta></doc></attachment></attachments></act></akomaNtoso>"""
    bare = '<akomaNtoso><act><meta/><body/><attachments><attachment><doc><meta><identification><FRBRWork><FRBRuri value="other"/></FRBRWork></identification></meta></doc></attachment></attachments></act></akomaNtoso>'
    got = {r["doc_id"]: r.asDict() for r in views.metadata(spark.createDataFrame([("a", xml), ("b", bare)], "doc_id string, xml string")).collect()}
    assert got["a"] == {
        "doc_id": "a", "title": "THE ACT, 2020", "source_title": "PÀ", "source_title_lang": "kn-Latn-x-nudi", "source_title_legacy": True, "work_uri": "w", "work_date": "2020-03-26",
        "expression_uri": "e", "expression_date": "2020-03-27", "manifestation_uri": "m", "jurisdiction": "in-ka", "number": "4", "publication_date": "2020-03-27", "generation_date": "2024-01-01",
        "language": "eng", "gazette": "Gazette", "notification": "DPAL 12 SHASANA 2020", "keywords": ["Rent Law", "Housing"],
    }
    assert {k: v for k, v in got["b"].items() if v is not None} == {"doc_id": "b", "source_title_legacy": False, "keywords": []}


def test_html_drops_no_element(spark):
    xml = """<?xml version="1.0" encoding="UTF-8"?>
<akomaNtoso xmlns="http://docs.oasis-open.org/legaldocml/ns/akn/3.0"><act><meta><identification/></meta><preface><p eId="preface__p_1">ACT &amp; NO. 4</p></preface><preamble><p eId="preamble__formula_1">Be it enacted</p></preamble>
<body><section eId="sec_1"><num>1.</num><heading>Title</heading><intro eId="sec_1__intro"><p eId="p1">In <ref href="#sec_2">section 2</ref> and <span xml:lang="kn-Latn-x-nudi">PÀ</span>, <def refersTo="#rent">rent</def> <omissis/>end</p></intro>
<proviso eId="sec_1__proviso_1"><content><p eId="p2">Provided also that it rests</p></content></proviso><subsection eId="s"><num>(2)</num><content><table eId="t"><tr><th><p eId="c1">A</p></th></tr><tr><td><p eId="c2">b</p></td></tr></table></content></subsection><odd><p eId="p3">kept</p></odd></section></body>
<conclusions><p eId="conclusions__p_1">By order</p></conclusions><attachments><attachment eId="att_1"><doc><mainBody><hcontainer eId="h"><content><p eId="p4"><ref href="/akn/x#sec_1">there</ref></p></content></hcontainer></mainBody></doc></attachment></attachments></act></akomaNtoso>"""
    got = {r["doc_id"]: r["html"] for r in views.html(spark.createDataFrame([("a", xml), ("b", "<akomaNtoso/>"), ("c", None)], "doc_id string, xml string")).collect()}
    assert (got["b"], got["c"]) == ("", None)
    for part in (
        '<div class="akn akn-preface" data-eid=""><div class="akn-container-label">Preface</div><p id="preface__p_1" class="akn-p" data-eid="preface__p_1">ACT &amp; NO. 4</p></div>',
        '<p id="preamble__formula_1" class="akn-p" data-eid="preamble__formula_1">Be it enacted</p>',
        '<div id="sec_1" class="akn akn-section akn-headed" data-eid="sec_1" data-kind="section"><div class="akn-label"><span class="akn-num">1.</span> <span class="akn-heading-text">Title</span></div>',
        'In <a class="akn-ref" href="#sec_2">section 2</a> and <span class="akn-foreign akn-foreign-legacy" lang="kn-Latn-x-nudi"', '<dfn class="akn-def" title="Defined term: rent">rent</dfn>', "[omitted]</span>end</p>",
        '<em class="akn-proviso-lead">Provided also that</em> it rests', 'akn-subsection akn-hanging', '<table id="t" class="akn-table" data-eid="t"><tbody><tr><th><p id="c1"', "<td><p id=\"c2\" class=\"akn-p\" data-eid=\"c2\">b</p></td>",
        '<p id="p3" class="akn-p" data-eid="p3">kept</p></div></div>', 'By order</p></div>', '<span class="akn-ref akn-ref-external" title="/akn/x#sec_1">there</span>',
    ):
        assert part in got["a"], part


def test_document_has_meta_definitions_and_tagged_runs(spark):
    run = F.struct(F.lit("PÀ ಕ").alias("text"), F.lit("kan").alias("lang"), F.lit("legacy").alias("encoding"), F.lit("nudi").alias("font_encoding"))
    token = one(spark, pages.run_token(run))
    assert [r["kind"] for r in one(spark, pages.runs(F.lit(f"a {token} b \ue000")))] == ["text", "foreign", "text", "omissis"]
    assert [r["text"] for r in one(spark, pages.runs(F.lit("a\ue002_w==\ue002b\ue002e30=\ue002c\ue002abc\ue002d")))] == ["a", "b", "c", "d"]  # none can be read
    assert one(spark, render.tagged(F.lit(None).cast("string"), F.lit("p"))) == ""
    assert one(spark, render.tagged(F.lit(f"<{token}"), F.lit("p"))) == '&lt;<span eId="p__span_1" xml:lang="kn-Latn-x-nudi">PÀ ಕ</span>'
    text = f"KARNATAKA ACT NO. 04 OF 2020\nOrdered that the translation of {token} in the English language, be published\nNo. DPAL 12 SHASANA 2020\nTHE RENT ACT, 2020\nBe it enacted as follows:-\n1. Definitions.-(1) In this Act {token} holds.\n(a) \"fair rent\" means rent under section 2.\n2. Rent.-Rent is due."
    c = Corpus(spark.createDataFrame([("d", text)], "doc_id string, text string"))
    xml = c.xml.first()["xml"]
    (m,) = views.metadata(spark.createDataFrame([("d", xml)], "doc_id string, xml string")).collect()
    assert (m["title"], m["source_title"], m["source_title_lang"], m["source_title_legacy"]) == ("THE RENT ACT, 2020", "PÀ ಕ", "kn-Latn-x-nudi", True)
    assert (m["number"], m["jurisdiction"], m["language"], m["notification"], m["generation_date"]) == ("4", "in-ka", "eng", "DPAL 12 SHASANA 2020", "2024-01-01")
    for part in (
        '<FRBRauthor href="#karnatakaLegislature"/>', '<FRBRthis value="/akn/in-ka/act/2020/4/eng@2020/!main.xml"/>', '<FRBRformat value="xml"/>', '<eventRef eId="eref_1" date="2020" type="generation" source="#karnatakaLegislature"/>',
        '<TLCRole eId="lexweave" href="/akn/ontology/role/editor" showAs="lexweave automated parser"/><TLCTerm eId="fairRent" href="/akn/ontology/term/fairRent" showAs="fair rent"/></references>',
        '__p_1__def_1" refersTo="#fairRent">&quot;fair rent&quot;</def> means rent under <ref eId="', '__p_1__ref_2" href="#sec_2">section 2</ref>', '__span_1" xml:lang="kn-Latn-x-nudi">PÀ ಕ</span> holds',
    ):
        assert part in xml or part.replace("&quot;", '"') in xml, (part, xml)
    assert "\ue002" not in xml
    given = spark.createDataFrame([("a", {"keywords": '["Rent Law"]'})], "key string, values map<string,string>")
    k = render.meta_xml(meta.apply_overrides(c.meta, spark.createDataFrame([("d", "/x/a.pdf")], "doc_id string, path string"), given)).first()["meta_xml"]
    assert '<classification source="#lexweave"><keyword eId="rentLaw" value="rent law" showAs="Rent Law" dictionary="#lexweaveSubjects"/></classification>' in k


def test_collisions_at_every_level(spark):
    sf = "/root/testdata/sf0.001"
    got = sorted(tuple(r) for r in queries.QUERIES["i05_collisions"](spark, sf).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{sf}/lineitem.parquet'")
    assert got == sorted(con.execute(queries.ORACLES["i05_collisions"]).fetchall())
    assert {e.count("__") for _, e, _ in got} == {0, 1, 2}


def test_outline_labels(spark):
    rows = [("1", "Short title", "section", "", None, "sec_1"), ("1", "", "subsection", "", None, "sec_1__subsec_1"), ("IV", "Of fees", "chapter", "", None, "chp_4"), ("V", "", "part", "", None, "part_5"), ("", "", "proviso", "", None, "sec_1__proviso_1"), ("", "THE SCHEDULE", "hcontainer", "schedule", 2, "att_2"), ("", "Loose", "crossHeading", "", None, "x")]
    d = spark.createDataFrame([("d", *r) for r in rows], "doc_id string, num string, heading string, kind string, name string, schedule_no int, eid string")
    got = {r["eid"]: (r["tag"], r["label"]) for r in views.outline(d).collect()}
    assert got == {
        "sec_1": ("section", "1. Short title"), "sec_1__subsec_1": ("subsection", "(1)"), "chp_4": ("chapter", "Chapter IV: Of fees"),
        "part_5": ("part", "Part V"), "sec_1__proviso_1": ("proviso", "proviso"), "att_2": ("attachment", "Schedule 2"),
    }


def test_marks_in_a_row_are_one(spark):
    m = chars.OMITTED
    d = spark.createDataFrame([(f"a{m} {m}\t{m}b",), (f"{m}",), ("a  b\n\n\nc",)], "t string")
    assert [r[0] for r in d.select(chars.clean("t")).collect()] == [f"a {m} b", f" {m} ", "a b\nc"]


def test_citation_after_much_white_space():
    text = "under the Karnataka Societies Act, 1960" + " " * 3000 + ", in section 5"
    assert [x["external"] for x in citations.find(text)] == [True]


def _placed(*tokens):
    """path, kind of each node: tokens are (kind, num)."""
    placer, path, out = Placer(), {0: ""}, []
    placer.state = "body"
    for kind, num in tokens:
        placer.feed(SimpleNamespace(kind=kind, num=num, text="", heading="", raw="", inline="", rows=None))
    for r in placer.finish():
        if r["record"] == "node":
            path[r["node_id"]] = f"{path[r['parent_id']]}/{r['num'] or r['kind']}"
            out.append((path[r["node_id"]], r["kind"]))
    return out


@pytest.mark.parametrize("tokens, want", [
    # roman below alpha, then alpha goes on
    ([("section", "1"), ("alpha", "a"), ("roman", "i"), ("roman", "ii"), ("alpha", "b")], ["/1", "/1/a", "/1/a/i", "/1/a/ii", "/1/b"]),
    # a list goes on after a proviso, whose own list is its own
    ([("section", "1"), ("alpha", "a"), ("proviso", ""), ("alpha", "a"), ("alpha", "b"), ("subsection", "2"), ("alpha", "a")], ["/1", "/1/a", "/1/proviso", "/1/proviso/a", "/1/proviso/b", "/1/2", "/1/2/a"]),
    # a restarted list nests
    ([("section", "1"), ("alpha", "a"), ("alpha", "a"), ("alpha", "b")], ["/1", "/1/a", "/1/a/a", "/1/a/b"]),
    # an item that follows none joins the deepest list of its type
    ([("section", "1"), ("alpha", "a"), ("alpha", "f")], ["/1", "/1/a", "/1/f"]),
    # a chapter closes all
    ([("section", "1"), ("subsection", "1"), ("chapter", "II"), ("section", "2"), ("explanation", "")], ["/1", "/1/1", "/II", "/II/2", "/II/2/hcontainer"]),
])
def test_placing(tokens, want):
    assert [p for p, _ in _placed(*tokens)] == want


@pytest.mark.parametrize("name", ["f17_words", "f19_units", "f30_order"])
def test_scalar_queries_equal_their_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, sf).select(*columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))
