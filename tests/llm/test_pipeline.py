"""corpus_pipeline.run against a plain version of its five stages."""

import re
from collections import Counter, defaultdict

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from lexweave.llm import bpe

from . import corpora

GAP = r"[\x20\x09-\x0D]+"
words_of = lambda t: [w for w in re.split(GAP, t or "") if w]
ascii_lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def quality(docs):
    normal = lambda x: re.sub("[0-9]+", "0", " ".join(words_of(x))).lower()
    hosts, seen = Counter(s for _, s in docs.values()), defaultdict(set)
    for i, (text, host) in docs.items():
        for x in (text or "").split("\n"):
            if words_of(x):
                seen[host, normal(x)].add(i)
    common = {k for k, v in seen.items() if len(v) > max(5, 0.02 * hosts[k[0]])}
    out = {}
    for i, (text, host) in docs.items():
        w = words_of(text)
        at = defaultdict(list)
        for j in range(len(w) - 7):
            at[tuple(w[j : j + 8])].append(j)
        repeated = {j + k for v in at.values() if len(v) > 1 for j in v for k in range(8)}
        lines = [x for x in (text or "").split("\n") if (host, normal(x)) not in common]
        left = sum(len(words_of(x)) for x in lines)
        if len(w) >= 20 and 100 * len(repeated) <= 30 * len(w) and left >= 20 and left >= 0.5 * len(w):
            out[i] = ("\n".join(lines), host)
    return out


def line_dedup(docs):
    earlier, out = [], {}
    for i in sorted(docs):
        kept = []
        for x in docs[i][0].split("\n"):
            s = frozenset(t for t in x.split(" ") if t)
            if s and any(100 * len(s & e) >= 80 * len(s | e) for e in earlier):
                earlier.append(s)  # also a removed line removes later ones
                continue
            if s:
                earlier.append(s)
            kept.append(x)
        out[i] = ("\n".join(kept), docs[i][1])
    return out


def near_duplicates(docs):
    sets = {}
    for i, (text, _) in docs.items():
        w = words_of(ascii_lower(text))
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    group = {i: i for i in docs}
    for i in docs:
        for j in docs:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = {k: low if v == high else v for k, v in group.items()}
    return {i: d for i, d in docs.items() if group[i] == i}


def decontaminate(docs, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t))
    windows = defaultdict(set)
    for i, t in items:
        w = split(t)
        for j in range(max(1, len(w) - 7) if w else 0):
            windows[tuple(w[j : j + 8])].add(i)
    sizes = {len(x) for x in windows}
    hits = lambda w: {i for n in sizes for j in range(len(w) - n + 1) for i in windows.get(tuple(w[j : j + n]), ())}
    return {i: d for i, d in docs.items() if len(hits(split(d[0]))) < 2}


def test_stages_equal_plain_version(spark, tmp_path):
    path = corpora.unique(tmp_path / "unique")
    d = spark.read.parquet(f"{path}/documents.parquet")
    docs = {r["doc_id"]: (r["text"], r["source"]) for r in d.collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{path}/benchmark.parquet").collect()]
    plain = [quality, line_dedup, near_duplicates, lambda x: decontaminate(x, items)]
    for i, ((name, stage), expect) in enumerate(zip(corpus_pipeline.STAGES, plain, strict=False)):
        before, docs = docs, expect(docs)
        out = stage(spark, d, path)
        assert out.columns == d.columns
        out.write.parquet(f"{tmp_path}/{i}")
        d = spark.read.parquet(f"{tmp_path}/{i}")
        got = {r["doc_id"]: r for r in d.collect()}
        assert {k: (r["text"], r["source"]) for k, r in got.items()} == docs, name
        assert all(r["n_chars"] == len(r["text"]) for r in got.values())
        assert docs != before, f"{name} has something to do"
    lib = Tokenizer.from_file(public_tokenizers.path(bpe.NAME))
    lib.no_truncation()
    lib.no_padding()
    want = sorted((i, len(e.ids), " ".join(map(str, e.ids))) for i, (t, _) in docs.items() for e in [lib.encode(t, add_special_tokens=False)])
    assert sorted(map(tuple, corpus_pipeline.run(spark, path).collect())) == want


def test_odd_and_empty(spark, tmp_path):
    """Nulls, repeats and clashing names run through; nothing comes of an empty table."""
    assert corpus_pipeline.run(spark, corpora.empty(tmp_path / "empty")).count() == 0
    rows = corpus_pipeline.run(spark, corpora.odd(tmp_path / "odd")).collect()
    ids = [r["doc_id"] for r in rows if r["doc_id"] is not None]
    assert len(ids) == len(set(ids)) and None in [r["doc_id"] for r in rows]
