"""Every operator over nulls, empty and long texts, ties, repeats, empty tables and clashing names."""

import duckdb
import pyarrow.parquet as pq
import pytest

from lexweave.llm import chat_format, decontaminate, line_dedup, ngram_join, quality_rules, substring_index
from lexweave.llm.queries import ORACLES, QUERIES

from . import corpora

WITH_SQL = [q for q in QUERIES if q in ORACLES and q != "op9_chat_format"]
ON_DOCUMENTS = [q for q in QUERIES if q not in ("op9_chat_format", "op4_zip_warc")]


@pytest.fixture(scope="module")
def dirs(tmp_path_factory):
    at = tmp_path_factory.mktemp("corpora")
    return {f.__name__: f(at / f.__name__) for f in (corpora.unique, corpora.odd, corpora.empty)}


@pytest.mark.parametrize("name", WITH_SQL)
def test_equals_sql(spark, dirs, name):
    out = QUERIES[name](spark, dirs["unique"])
    with duckdb.connect() as db:
        for t in ("documents", "benchmark"):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{dirs['unique']}/{t}.parquet'")
        want = db.execute(f"SELECT {', '.join(out.columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, out.collect())) == sorted(want)


@pytest.mark.parametrize("name", ON_DOCUMENTS)
def test_odd_rows(spark, dirs, name):
    """Each row of the table has one row in the result; one with unique id and text has the values it has alone."""
    ids = pq.read_table(f"{dirs['odd']}/documents.parquet", columns=["doc_id"]).column(0).to_pylist()
    got = [r["doc_id"] for r in QUERIES[name](spark, dirs["odd"]).collect()]
    assert sorted(got, key=str) == sorted(ids, key=str)


@pytest.mark.parametrize("name", ON_DOCUMENTS)
def test_empty_table(spark, dirs, name):
    assert QUERIES[name](spark, dirs["empty"]).count() == 0


def _rows(spark, path):
    return spark.read.parquet(f"{path}/documents.parquet")


@pytest.mark.parametrize("kind", ["unique", "odd", "empty"])
@pytest.mark.parametrize("operator", ["quality", "lines", "near", "benchmark"])
def test_columns_pass(spark, dirs, kind, operator):
    """What stays keeps all its columns, those with names that operators use inside too."""
    docs = _rows(spark, dirs[kind])
    run = {
        "quality": quality_rules.clean, "lines": line_dedup.dedup_lines, "near": ngram_join.deduplicate,
        "benchmark": lambda d: decontaminate.clean(d, spark.read.parquet(f"{dirs[kind]}/benchmark.parquet")),
    }[operator]
    out = run(docs)
    assert out.columns == docs.columns
    key = ["doc_id", *corpora.CLASHING] + (["text"] if operator in ("near", "benchmark") else [])
    assert out.select(*key).exceptAll(docs.select(*key)).count() == 0
    if operator == "lines":
        assert out.count() == docs.count()


def test_repeats_of_lines(spark):
    """Repeated rows share one verdict; a null id is first."""
    d = spark.createDataFrame([(2, "a b c\nd e f"), (2, "a b c\nd e f"), (None, "d e f"), (3, "a b c"), (4, None), (5, "")], "doc_id long, text string")
    got = sorted((str(r[0]), str(r[1])) for r in line_dedup.dedup_lines(d).collect())
    assert got == sorted([("2", "a b c"), ("2", "a b c"), ("None", "d e f"), ("3", ""), ("4", "None"), ("5", "")])


def test_substring_of_null_and_shared_ids(spark):
    words = " ".join(f"w{i}" for i in range(60))
    d = spark.createDataFrame([(None, words), (2, words), (2, words + " x"), (3, "y " + words), (1, None)], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"]) for r in substring_index.remove(d).collect())
    assert got == [("1", 0, 0), ("2", 60, 0), ("2", 61, 0), ("3", 61, 60), ("None", 60, 0)]


def test_many_runs_equal_one(spark, dirs):
    """Several batches, compacted on the way, remove what a single batch does."""
    docs = _rows(spark, dirs["unique"])
    want = sorted(map(tuple, substring_index.remove(docs, batches=1).collect()))
    assert sorted(map(tuple, substring_index.remove(docs, batches=4, fan_in=2).collect())) == want
    assert any(r[2] for r in want)


def test_benchmark_blocks(spark, dirs):
    """Blocks of strings give what one search gives."""
    docs, items = _rows(spark, dirs["unique"]), spark.read.parquet(f"{dirs['unique']}/benchmark.parquet")
    both = [sorted((r["doc_id"], r["n_words"], str(r["runs"]), sorted(r["items"])) for r in decontaminate.search(docs, items, block_bytes=b).collect()) for b in (10**6, 100, 1)]
    assert both[0] == both[1]


def test_chat_edges(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "<|x\\<\\|"), (2, 0, "assistant", "a"), (2, 0, "assistant", "a"), (None, None, None, None), (3, 0, "a>b\n", "<|im_end|>\n")]
    d = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_conversations(d)).collect()}
    assert {k: [tuple(t) for t in r["turns"]] for k, r in got.items()} == {1: [("user", ""), ("assistant", "<|x\\<\\|")], 2: [("assistant", "a")] * 2, None: [("", "")], 3: [("a>b\n", "<|im_end|>\n")]}
    assert {k: r["valid"] for k, r in got.items()} == {1: True, 2: False, None: False, 3: False}
    assert got[1]["loss_text"] == "<|x\\<\\|" and got[2]["loss_text"] == "aa"
    assert chat_format.format_conversations(d.limit(0)).count() == 0
