"""Two different words of 1024 letters whose polynomial hashes modulo 2**64 are equal in any base: no operator may take one for the other."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lexweave.llm import bpe, decontaminate, line_dedup, ngram_join, record_files, substring_index
from lexweave.llm.common import chunks, windows

TURNS = [0]
for _ in range(10):
    TURNS += [1 - x for x in TURNS]
T, U = "".join("ab"[x] for x in TURNS), "".join("ba"[x] for x in TURNS)


def frame(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string")


def test_bpe():
    path = public_tokenizers.path(bpe.NAME)
    lib = Tokenizer.from_file(path)
    lib.no_truncation()
    got = bpe.WordBpe(path).encode_texts([T.encode(), U.encode()])
    for t, (n, ids, decoded) in zip((T, U), got, strict=True):
        e = lib.encode(t, add_special_tokens=False)
        assert (n, ids, decoded) == (len(e.ids), " ".join(map(str, e.ids)).encode(), lib.decode(e.ids, skip_special_tokens=False).encode())


def test_pieces():
    path = public_tokenizers.path(record_files.NAME)
    lib = Tokenizer.from_file(path)
    got = record_files.PieceEncoder(path).encode([T.encode(), U.encode()])
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [lib.encode(t, add_special_tokens=False).ids for t in (T, U)]


def test_long_texts_in_stretches(monkeypatch):
    """Texts taken in stretches of a few bytes have the ids they have whole."""
    text = ("It's  a,b  cat;\n\n don't \t ÉÉ x<y  " + T + " 12 34  \n") * 7
    for module, make, path in ((bpe, bpe.WordBpe, bpe.NAME), (record_files, record_files.PieceEncoder, record_files.NAME)):
        enc = make(public_tokenizers.path(path))
        run = enc.ids_of if module is bpe else enc.encode
        want = run([text.encode(), b"a b"])
        monkeypatch.setattr(module, "chunks", lambda t: chunks(t, 9))
        monkeypatch.setattr(module, "CHUNKED", 9)
        enc.cache.most = 500
        assert run([text.encode(), b"a b"]) == want


def test_shingles(spark):
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.cluster(frame(spark, T, U, T + " x", T)).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 1}


def test_lines(spark):
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(frame(spark, T, U, U)).collect()}
    assert got == {1: T, 2: U, 3: ""}


def test_windows(spark):
    words = " ".join(f"w{i}" for i in range(49))
    got = {r["doc_id"]: r["n_removed"] for r in substring_index.remove(frame(spark, f"{words} {T}", f"{words} {U}", f"{words} {T}")).collect()}
    assert got == {1: 0, 2: 0, 3: 50}


def test_benchmark(spark):
    items = spark.createDataFrame([("1", T), ("2", U)], "item_id string, text string")
    got = {r["doc_id"]: list(r["items"]) for r in decontaminate.search(frame(spark, T, U, "x"), items).collect()}
    assert got == {1: ["1"], 2: ["2"], 3: []}


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 16, 50])
def test_sequences_of_two_values(size):
    """Equal windows have equal hashes, different ones of the sequence (few values, so the hardest) different ones."""
    x = np.array([3, 5], np.uint64)[np.array(TURNS)]
    got = windows(x, size)
    spelled = [tuple(TURNS[i : i + size]) for i in range(len(TURNS) - size + 1)]
    assert len(got) == len(spelled) and len(set(got.tolist())) == len(set(spelled)) == len(set(zip(got.tolist(), spelled, strict=True)))
