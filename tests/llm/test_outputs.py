"""Operators whose results SQL cannot give, against brute force and the library."""

import base64
import hashlib
import io
import random
import struct
import zipfile
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lexweave.llm import bpe, record_files, zip_warc

SF = "/root/testdata/sf0.001"


def odd_texts(n=3000):
    rnd = random.Random(1)
    alpha = "aabbcc de  \n\t.,'sStTß éÉ̈́ΣσςİıK1２²Ⅷ_-<|>\x1c\x85\xa0　日本😀‍'ll're"
    return ["".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 60))) for _ in range(n)] + ["<|endoftext|>", "a <|startoftext|> B<|endoftext|>c", "a" * 3000, "É" * 500, ""]


@pytest.fixture(scope="module")
def texts(spark):
    return odd_texts() + [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]


def test_bpe_equals_library(texts):
    path = public_tokenizers.path(bpe.NAME)
    lib = Tokenizer.from_file(path)
    lib.no_truncation()
    lib.no_padding()
    for got, e in zip(bpe.WordBpe(path).encode_texts([t.encode() for t in texts]), lib.encode_batch(texts, add_special_tokens=False), strict=True):
        assert got == (len(e.ids), " ".join(map(str, e.ids)).encode(), lib.decode(e.ids, skip_special_tokens=False).encode())


def test_pieces_equal_library(texts):
    path = public_tokenizers.path(record_files.NAME)
    lib = Tokenizer.from_file(path)
    got = record_files.PieceEncoder(path).encode([t.encode() for t in texts])
    for x, e in zip(got, lib.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(x, "<u2").tolist() == e.ids


def test_bpe_query(spark):
    lib = Tokenizer.from_file(public_tokenizers.path(bpe.NAME))
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = bpe.op7_bpe(spark, SF).collect()
    assert len(got) == len(text)
    for r in got:
        ids = lib.encode(text[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_record_query(spark):
    lib = Tokenizer.from_file(public_tokenizers.path(record_files.NAME))
    start = 0
    want = []
    for r in sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r["doc_id"]):
        ids = lib.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        want.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, record_files.op3_record_files(spark, SF).collect())) == want


def test_records_of_nulls_and_ties(spark, tmp_path):
    rows = [(None, "x"), (2, None), (2, "b a"), (2, "b a"), (1, "")]
    d = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, start int")
    path = f"file://{tmp_path}/r"
    files = record_files.manifest(record_files.write_records(d, path, public_tokenizers.path(record_files.NAME)))
    got = record_files.read_records(spark, path, files, per_task=2).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, 1, 2, 2, 2]
    assert [r["n_tokens"] for r in got] == [2, 1, 1, 3, 3]
    empty = record_files.write_records(d.limit(0), f"file://{tmp_path}/e", public_tokenizers.path(record_files.NAME))
    assert record_files.read_records(spark, f"file://{tmp_path}/e", record_files.manifest(empty)).count() == 0


def test_frame():
    data = record_files.frame(b"abc")
    assert record_files.unframe(data) == b"abc"
    for i in range(len(data)):
        with pytest.raises(ValueError):
            record_files.unframe(data[:i] + bytes([data[i] ^ 1]) + data[i + 1 :])


def test_warc_query(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    payload = {p["page_id"]: (p["html"] or "").encode() for p in pages}
    last = {}
    for i, x in payload.items():
        last[x] = max(i, last.get(x, i))
    want = sorted((i, len(x), base64.b32encode(hashlib.sha1(x).digest()).decode(), "response" if last[x] == i else "revisit", None if last[x] == i else last[x]) for i, x in payload.items())
    assert sorted(map(tuple, zip_warc.op4_zip_warc(spark, SF).collect())) == want


def test_warc_edges(spark, tmp_path):
    rows = [(1, "u", "a"), (2, "u\r\nX: y", "a"), (2, "u", "a"), (3, None, None), (4, "", ""), (None, "u", "a"), (5, "u", "ß" * 100000)]
    d = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, last int")
    path = f"file://{tmp_path}/w"
    files = [tuple(r) for r in zip_warc.write_packages(d, path).collect()]
    got = zip_warc.read_packages(spark, path, files, per_task=2).collect()
    kinds = sorted((str(r["page_id"]), r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got)
    assert kinds == [("1", "revisit", 2, 1), ("2", "response", None, 1), ("2", "response", None, 1), ("3", "revisit", 4, 0), ("4", "response", None, 0), ("5", "response", None, 200000), ("None", "response", None, 1)]
    assert zip_warc.read_packages(spark, path, []).count() == 0


def test_zip64_directory():
    """A directory with ZIP64 end record and extras, as large archives have."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name in ("a", "b"):
            with z.open(name, "w", force_zip64=True) as f:
                f.write(name.encode() * 5)
    data = out.getvalue()
    end = data.rfind(zip_warc.END)
    n, size, place = struct.unpack_from("<HII", data, end + 10)
    central = bytearray()
    at = place
    for _ in range(n):  # every entry with its sizes and place in the extra
        packed, whole, ln, lx, lc = struct.unpack_from("<IIHHH", data, at + 20)
        where = struct.unpack_from("<I", data, at + 42)[0]
        if packed == zip_warc.WIDE:
            packed = whole = 5
        entry = bytearray(data[at : at + 46])
        struct.pack_into("<II", entry, 20, zip_warc.WIDE, zip_warc.WIDE)
        struct.pack_into("<HHH", entry, 28, ln, 28, 0)
        struct.pack_into("<I", entry, 42, zip_warc.WIDE)
        central += entry + data[at + 46 : at + 46 + ln] + struct.pack("<HHQQQ", 1, 24, 5, 5, where)
        at += 46 + ln + lx + lc
    wide = zip_warc.END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, len(central), place)
    locator = zip_warc.LOCATOR + struct.pack("<IQI", 0, place + len(central), 1)
    tail = zip_warc.END + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, zip_warc.WIDE, zip_warc.WIDE, 3) + b"end"
    data = data[:place] + bytes(central) + wide + locator + tail
    found = zip_warc.members(lambda a, k: data[a : a + k], len(data))
    assert {k: data[a : a + m] for k, (_, a, m) in found.items()} == {"a": b"aaaaa", "b": b"bbbbb"}


def test_bpe_decodes_ids(spark):
    path = public_tokenizers.path(bpe.NAME)
    lib = Tokenizer.from_file(path)
    texts = {1: "Ärger über 12 Straßen\nund 中文", 2: "", 3: None, 4: "a <|endoftext|> b", 5: "The rent is due. The rent is due."}
    enc = bpe.encode(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), path)
    got = {r["doc_id"]: r["decoded"] for r in bpe.decode(enc.select("doc_id", "ids"), path).collect()}
    want = {k: lib.decode(lib.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False) for k, t in texts.items()}
    assert got == want == {r["doc_id"]: r["decoded"] for r in enc.collect()}
    with pytest.raises(ValueError, match="99999999"):
        bpe.shared(path).decode_ids(b"1 99999999")


def test_pieces_of_record_encoder_meet_the_library_at_every_boundary():
    import random

    import numpy as np
    import public_tokenizers

    from lexweave.llm.record_files import NAME, PieceEncoder

    enc, rnd = PieceEncoder(public_tokenizers.path(NAME)), random.Random(5)
    letters = ["a", "t", "s", "é", "×", "÷", "ŕ", "ÿ", "À", "Ж", "中", "́", " ", "  ", "\n", "\t", " ", "'s", "'", ".", ",", "!", "#", "1", "-", "_", "<|", "%"]
    texts = ["".join(rnd.choices(letters, k=rnd.randint(0, 30))) for _ in range(20_000)]
    enc.cache.most = 200_000  # so that generations go
    for i in range(0, len(texts), 1000):
        got = enc.encode([t.encode() for t in texts[i : i + 1000]])
        expected = enc.lib.encode_batch_fast(texts[i : i + 1000], add_special_tokens=False)
        assert [np.frombuffer(x, enc.dtype).tolist() for x in got] == [e.ids for e in expected]
