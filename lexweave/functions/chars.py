"""Scalar functions over text, as Column expressions (JVM side, no Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: languages, encodings, character classes, abbreviations
ENG, KAN, NEUTRAL = "eng", "kan", "neutral"
UNICODE, LEGACY, SUSPECT = "unicode", "legacy", "suspect"
KANNADA = r"\x{0C80}-\x{0CFF}"
ACCENTED = r"\x{00C0}-\x{024F}"
LATIN = "A-Za-z" + ACCENTED
LEGACY_FONTS = r"(?i)nudi|baraha|brh[a-z]*|shree.?lipi|akshar|kannada|kailasam|sampige|nadanika|tunga.?ascii|kedage|malige"
UNICODE_FONTS = r"(?i)tunga|nirmala|noto.?sans.?kannada|kedage|malige|iskoolapota|arialunicode"
NOT_XML = r"[^\x09\x0A\x0D\x20-\x{D7FF}\x{E000}-\x{FFFD}]"
SYMBOLS = r"\x{2000}-\x{2BFF}"
GOOD_SYMBOLS = r"\x{2000}-\x{200B}\x{2010}-\x{2015}\x{2018}-\x{2022}\x{2026}\x{2032}\x{2033}\x{20B9}\x{2116}"
ELEMENT_REF = {
    "alinea": "al", "article": "art", "attachment": "att", "blockList": "list", "chapter": "chp", "clause": "cl",
    "component": "cmp", "components": "cmpnts", "division": "dvs", "mainBody": "body", "paragraph": "para",
    "section": "sec", "subchapter": "subchp", "subclause": "subcl", "subdivision": "subdvs", "subparagraph": "subpara",
    "subsection": "subsec", "wrapUp": "wrapup",
}
EID = r"\A[A-Za-z][A-Za-z0-9]*(_[A-Za-z0-9\-]+)?(__[A-Za-z][A-Za-z0-9]*(_[A-Za-z0-9\-]+)?)*\z"
FONT_ENCODINGS = {"nudi": "nudi", "baraha": "nudi", "brh": "nudi", "shree": "shreelipi", "akshar": "akruti", "akruti": "akruti"}
BCP47 = {ENG: "en", KAN: "kn"}
LEVEL_WORD = r"(?i)\A(section|sec\.?|article|art\.?|clause|cl\.?|para\.?|paragraph|rule|item)\s+"
ROMANS = ("i ii iii iv v vi vii viii ix x xi xii xiii xiv xv xvi xvii xviii xix xx").split()
LETTERS = list("abcdefghijklmnopqrstuvwxyz")
MONTHS = "january february march april may june july august september october november december".split()
DEFAULT_FONT_ENCODING = "nudi"
SPELLINGS = (("-", "\u2010\u2011"), ("'", "\u2018\u2019"), ('"', "\u201c\u201d"), (" ", "\u00a0\u2007\u202f"))


def _text(c) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def count_of(c: Column, members: str) -> Column:
    """How many characters of c are in the class; what lies between them goes a run at a time."""
    return F.char_length(only(c, members))


def only(c: Column, members: str) -> Column:
    """The characters of c that are in the class."""
    return F.regexp_replace(c, f"[^{members}]+", "")


def lookup(c: Column, values: dict) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), c)


def sanitise(c) -> Column:
    """F1: without characters that XML 1.0's BMP range lacks; all beyond the BMP go."""
    return F.regexp_replace(_text(c), NOT_XML, "")


def letter_counts(c) -> Column:
    """struct<eng, kan>; only letters count."""
    c = only(_text(c), r"\p{L}")
    return F.struct(count_of(c, LATIN).cast("long").alias(ENG), count_of(c, KANNADA).cast("long").alias(KAN))


def span_class(text, font) -> Column:
    """struct<lang, encoding> of a span."""
    t = _text(text)
    font = _text(font)
    latin, accented = t.rlike(f"[{LATIN}]"), t.rlike(f"[{ACCENTED}]")
    kind = lambda lang, enc: F.struct(F.lit(lang).alias("lang"), F.lit(enc).alias("encoding"))
    return (
        F.when(~t.rlike(r"(?U)\S"), kind(NEUTRAL, ""))
        .when(t.rlike(f"[{KANNADA}]"), kind(KAN, UNICODE))
        .when(latin & font.rlike(LEGACY_FONTS), kind(KAN, LEGACY))
        .when(accented & (count_of(t, ACCENTED) / count_of(t, LATIN) > 0.25), kind(KAN, LEGACY))
        .when(latin, kind(ENG, UNICODE))
        .otherwise(kind(NEUTRAL, ""))
    )


def span_lang(text, font) -> Column:
    """F4."""
    return span_class(text, font)["lang"]


def is_unicode_font(font) -> Column:
    """F5."""
    return _text(font).rlike(UNICODE_FONTS)


def font_encoding(font) -> Column:
    """the first known name in the font's."""
    f = F.lower(_text(font))
    out = F.lit(DEFAULT_FONT_ENCODING)
    for name, encoding in reversed(FONT_ENCODINGS.items()):
        out = F.when(F.instr(f, name) > 0, F.lit(encoding)).otherwise(out)
    return out


def bcp47(lang, encoding, font_enc) -> Column:
    """language tag; an unknown language passes through."""
    lang, encoding, font_enc = _text(lang), _text(encoding), _text(font_enc)
    base = F.coalesce(lookup(lang, BCP47), lang)
    tail = F.when(font_enc == "", F.lit(DEFAULT_FONT_ENCODING)).otherwise(font_enc)
    return F.when(encoding == SUSPECT, F.concat(base, F.lit("-x-misencoded"))).when(encoding == UNICODE, base).otherwise(F.concat(base, F.lit("-Latn-x-"), tail))


def misencoded_share(c, script: str = KANNADA) -> Column:
    """F8: misplaced symbols against them and the script's letters; 0 of nothing."""
    t = _text(c)
    symbols = only(t, SYMBOLS)
    wrong = F.char_length(symbols) - count_of(symbols, GOOD_SYMBOLS)
    return F.coalesce(F.try_divide(wrong, count_of(t, script) + wrong), F.lit(0.0))


#: fixed value: stands for text that was left out
OMITTED = chr(0xE000)


def clean_cell(c, keep_kannada: bool = False, mark: str = "") -> Column:
    """a table cell; Kannada runs go (or become the mark) unless kept."""
    t = F.regexp_replace(sanitise(c), r"\s+", " ")
    if not keep_kannada:
        t = F.regexp_replace(t, f"[{KANNADA}]+[{KANNADA}\\s]*", mark)
    return F.btrim(t)


def clean(c) -> Column:
    """one mark between single blanks for marks in a row; one spelling of quotes, hyphens and blanks; no blank lines.

    Single characters are replaced without patterns, and patterns begin with what they change: they leave most places at once.
    """
    t = F.regexp_replace(sanitise(c), f"{OMITTED}(?:[ \\t]*{OMITTED})*+", f" {OMITTED} ")
    for new, old in SPELLINGS:
        for x in old:
            t = F.replace(t, F.lit(x), F.lit(new))
    return F.regexp_replace(F.regexp_replace(t, r"[ \t]{2,}+|\t", " "), r"\n{2,}+", "\n")


def dehyphenate(c) -> Column:
    """joins a word that a hyphen and a line end part, before a lower-case letter."""
    # the optional character lets the lookbehind reach a letter of two code units
    return F.regexp_replace(_text(c), r"(?U)-\n(?=[a-z])(?<=[^-]?\w-\n)", "")


def normal_num(c) -> Column:
    """the identifier form of a number."""
    t = F.regexp_replace(F.btrim(_text(c)), LEVEL_WORD, "")
    t = F.btrim(t, F.lit("()[]{}.,;: \t "))
    body = F.regexp_replace(F.regexp_replace(t, r"\A-+", ""), r"\s+", "")
    body = F.array_join(F.filter(F.split(body, r"[^A-Za-z0-9]+"), lambda x: x != ""), "-")
    return F.concat(F.when(t.startswith("-"), F.lit("-")).otherwise(F.lit("")), body)


def element_ref(kind) -> Column:
    """F15."""
    k = _text(kind)
    return F.coalesce(lookup(k, ELEMENT_REF), k)


def is_conformant(eid) -> Column:
    """F16."""
    return _text(eid).rlike(EID)


def keyword(c) -> Column:
    """a citation keyword in the singular, without hyphen or blank."""
    w = F.regexp_replace(F.lower(_text(c)), r"[-\s]", "")
    return F.when(w.endswith("ies"), F.regexp_replace(w, "ies$", "y")).when(w.endswith("s") & ~w.endswith("ss"), F.regexp_replace(w, "s$", "")).otherwise(w)


def num_key(c) -> Column:
    """F18."""
    return F.lower(F.btrim(_text(c), F.lit("() \t")))


def enclosing_unit(eid) -> Column:
    """the eId up to its first level that is neither chapter nor part; '' if none."""
    parts = F.split(_text(eid), "__")
    inner = F.filter(F.transform(parts, lambda p, i: F.when(~p.startswith("chp_") & ~p.startswith("part_"), i)), lambda i: i.isNotNull())
    return F.when(_text(eid) == "", F.lit("")).otherwise(F.coalesce(F.array_join(F.slice(parts, 1, F.get(inner, F.lit(0)) + 1), "__"), F.lit("")))


def ancestors(eid) -> Column:
    """the eId, each prefix innermost first, then ''."""
    parts = F.when(_text(eid) == "", F.array().cast("array<string>")).otherwise(F.split(_text(eid), "__"))
    return F.transform(F.sequence(F.size(parts), F.lit(0)), lambda n: F.array_join(F.slice(parts, 1, n), "__"))


def display_num(kind, num) -> Column:
    """F21."""
    k, n = _text(kind), _text(num)
    return F.when(n == "", n).when(k.isin("section", "article", "rule"), F.concat(n, F.lit("."))).when(k.isin("chapter", "part"), n).otherwise(F.concat(F.lit("("), n, F.lit(")")))


def slug(c) -> Column:
    """lowerCamel of the ASCII words; 'term' of none."""
    w = F.transform(F.regexp_extract_all(_text(c), F.lit(r"([A-Za-z0-9]+)")), lambda x, i: F.when(i == 0, F.lower(x)).otherwise(F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 2**30)))))
    return F.when(F.size(w) == 0, F.lit("term")).otherwise(F.array_join(w, ""))


def short_name(c) -> Column:
    """CamelCase of the words; a letter after anything but a letter is a capital. 'Act' of none."""
    runs = F.regexp_extract_all(F.lower(_text(c)), F.lit(r"([A-Za-z]+|[0-9]+)"))
    out = F.array_join(F.transform(runs, lambda x: F.initcap(x)), "")
    return F.when(out == "", F.lit("Act")).otherwise(out)


def iso_date(day, month, year) -> Column:
    """yyyy-MM-dd; '' for an unknown month, null for an impossible date."""
    m = F.lower(_text(month))
    number = F.lit(None).cast("int")
    for i in range(12, 0, -1):
        number = F.when((F.length(m) > 0) & F.lit(MONTHS[i - 1]).startswith(F.substring(m, 1, 3)), F.lit(i)).otherwise(number)
    day = F.date_format(F.try_make_timestamp(year.cast("int"), number, day.cast("int"), F.lit(0), F.lit(0), F.lit(0)), "yyyy-MM-dd")
    return F.when(number.isNull(), F.lit("")).otherwise(day)


def work_uri(jurisdiction, doc_type, date, year, number) -> Column:
    """F25; the other URIs extend it."""
    some = F.coalesce(F.nullif(_text(date), F.lit("")), F.nullif(_text(year), F.lit("")), F.lit("nn"))
    return F.concat(F.lit("/akn/"), _text(jurisdiction), F.lit("/"), _text(doc_type), F.lit("/"), some, F.lit("/"), _text(number))


def expression_uri(work, lang, date) -> Column:
    return F.concat(work, F.lit("/"), _text(lang), F.lit("@"), _text(date))


def manifestation_uri(expression) -> Column:
    return F.concat(expression, F.lit(".xml"))


def component_uri(uri, component: str, manifestation: bool = False) -> Column:
    return F.concat(uri, F.lit(f"/!{component}" + (".xml" if manifestation else "")))


def href(fragment, expression, in_schedule) -> Column:
    """a fragment; inside an attachment qualified by the main component."""
    return F.when(in_schedule, F.concat(expression, F.lit("/!main"), fragment)).otherwise(fragment)


def is_legacy_tag(lang) -> Column:
    """F27."""
    t = F.lower(_text(lang))
    return t.contains("-latn-") | t.contains("misencoded")


def target_ratio(target, foreign) -> Column:
    """F28."""
    return F.coalesce(F.try_divide(target, target + foreign), F.lit(0.0))


def escape_xml(c) -> Column:
    """F29."""
    t = F.replace(F.replace(F.replace(_text(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.replace(t, F.lit('"'), F.lit("&quot;"))


def local_name(c) -> Column:
    return F.substring_index(_text(c), "}", -1)


def predecessor(list_type, num) -> Column:
    """the number before num in its list; null for the first and for none of the list."""
    before = lambda s: lookup(num, dict(zip(s[1:], s[:-1], strict=True)))
    return F.when(list_type == "alpha", before(LETTERS)).otherwise(before(ROMANS))


def successor(list_type: str, num) -> Column:
    s = LETTERS if list_type == "alpha" else ROMANS
    return lookup(num, dict(zip(s[:-1], s[1:], strict=True)))
