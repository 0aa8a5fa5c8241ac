"""BPE encoding and decoding in batched numpy merge rounds.

The symbols of many words lie in one flat array. A round looks up the keys of all
neighbouring pairs by binary search over the sorted pair keys, takes each word's pair
of lowest rank and merges it; words without a pair leave. Words repeat, so each is
merged once per worker as long as a bounded cache of words (by their bytes) holds it.

The file's normaliser (NFC, white space, lower case) and its split pattern run per
stretch between ASCII white space. A null text is empty and has no tokens; empty
tables give no rows; repeated rows give a row each; no text is cut.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PieceCache, chunks, column_bytes, slices, table

NAME = "word_bpe_49k.json"
NONE = np.iinfo(np.int64).max
#: Texts of more bytes are taken in stretches.
CHUNKED = 4_000_000


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class WordBpe:
    """Encoder and decoder of a tokenizers file of this kind; refuses files of another."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in pre] != ["Split", "ByteLevel"] or spec["decoder"] or spec["post_processor"]:
            raise ValueError(f"{path} is not a word BPE file of the expected form")
        self.pattern = regex.compile("\n|" + pre[0]["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        vocab = model["vocab"]
        self.tokens = {str(i).encode(): t.encode() for t, i in [*vocab.items(), *self.special.items()]}
        self.spelled = [b" %d" % i for i in range(max(vocab.values()) + 1)]
        suffix = model["end_of_word_suffix"] or ""
        letters = _byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.final = np.array([vocab[c + suffix] for c in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        a, b = (np.array([vocab[p[i]] for p in pairs], np.int64) for i in (0, 1))
        self.width = len(vocab)
        key = a * self.width + b
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks = key[order], order
        self.made = np.array([vocab[x + y] for x, y in pairs], np.int64)
        # a round may merge every occurrence of a pair at once unless the new symbol starts an earlier merge
        first = np.full(self.width, NONE)
        np.minimum.at(first, a, np.arange(len(a)))
        np.minimum.at(first, b, np.arange(len(b)))
        self.alone = (first[self.made] <= np.arange(len(self.made))) | (a == b)
        self.cache = PieceCache(240_000_000)

    def merge(self, words: list[bytes]) -> tuple[list[int], list[int]]:
        """Ids of the words (none is empty) and where each word's begin."""
        sizes = np.array([len(w) for w in words])
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(sizes)
        ids = self.inner[data]
        ids[ends - 1] = self.final[data[ends - 1]]
        owner = np.repeat(np.arange(len(words)), sizes)
        rank = self._ranks(ids, owner, np.arange(len(ids)))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            begin = np.flatnonzero(np.diff(owner, prepend=-1))
            length = np.diff(begin, append=len(ids))
            least = np.minimum.reduceat(rank, begin)
            live = np.repeat(least < NONE, length)
            if not live.all():
                done.append((owner[~live], ids[~live]))
                ids, owner, rank = ids[live], owner[live], rank[live]
                keep = least < NONE
                length, least = length[keep], least[keep]
                if not len(ids):
                    break
            best = np.repeat(least, length)
            hit = np.flatnonzero(rank == best)
            lone = self.alone[rank[hit]]
            if lone.any():  # only the first in its word, as later ones may change
                again = np.append(False, owner[hit][1:] == owner[hit][:-1])
                hit = hit[~(lone & again)]
            ids[hit] = self.made[rank[hit]]
            stay = np.ones(len(ids), bool)
            stay[hit + 1] = False
            changed = (np.cumsum(stay) - 1)[hit]
            ids, owner, rank = ids[stay], owner[stay], rank[stay]
            changed = np.unique(np.append(changed, np.maximum(changed - 1, 0)))  # only pairs with a new symbol have a new rank
            rank[changed] = self._ranks(ids, owner, changed)
        own = np.concatenate([o for o, _ in done])
        flat = np.concatenate([i for _, i in done])
        order = np.argsort(own, kind="stable")
        return flat[order].tolist(), [0, *np.cumsum(np.bincount(own, minlength=len(words))).tolist()]

    def _ranks(self, ids: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The rank of the pairs that begin at these places; NONE where none does."""
        after = np.minimum(at + 1, len(ids) - 1)
        key = ids[at] * self.width + ids[after]
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[found] == key) & (owner[at] == owner[after]) & (at != after), self.ranks[found], NONE)

    def pieces(self, stretches: list[str]) -> list[list[str]]:
        """The words of stretches (without line feeds and special strings), normalised."""
        s = "\n".join(stretches)
        s = lower(s if s.isascii() else unicodedata.normalize("NFC", s))
        out: list[list[str]] = [[]]
        for w in self.pattern.findall(s):
            if w == "\n":
                out.append([])
            else:
                out[-1].append(w)
        return out

    def learn(self, stretches: list[bytes]) -> list[bytes]:
        """The ids of each in decimals, every one after a space."""
        parts = self.pieces([x.decode() for x in stretches])
        distinct = list(set().union(*parts))
        flat, at = self.merge([w.encode() for w in distinct]) if distinct else ([], [0])
        ids = list(map(self.spelled.__getitem__, flat))
        of = {w: b"".join(ids[i:j]) for w, i, j in zip(distinct, at, at[1:], strict=False)}
        return [of[p[0]] if len(p) == 1 else b"".join([of[w] for w in p]) for p in parts]

    def encode_texts(self, texts: list[bytes]) -> list[tuple[int, bytes, bytes]]:
        """Of each text: number of ids, decimal ids joined by a space, what these decode to."""
        return [(n, ids, self.decode_ids(ids)) for n, ids in self.ids_of(texts)]

    def ids_of(self, texts: list[bytes]) -> list[tuple[int, bytes]]:
        """Of each text: number of ids, decimal ids joined by a space."""
        special = [b"<|" in t and self.split_special.search(t.decode()) is not None for t in texts]
        out = []
        for many in self._in_turn([t for t, s in zip(texts, special, strict=True) if not s]):
            ids = b"".join(many)
            out.append((ids.count(b" "), ids[1:]))
        self.cache.trim()
        plain = iter(out)
        return [self.with_special(t.decode()) if s else next(plain) for t, s in zip(texts, special, strict=True)]

    def _in_turn(self, texts: list[bytes]):
        """Of each text the records of its stretches between white space; words of all short texts are learned at once."""
        short = [t.split() if len(t) <= CHUNKED else None for t in texts]
        self.cache.fill(chain.from_iterable(filter(None, short)), self.learn)
        for text, words in zip(texts, short, strict=True):
            if words is not None:
                yield list(map(self.cache.__getitem__, words))
                continue
            found = []
            for piece in chunks(text):
                words = piece.split()
                self.cache.trim()
                self.cache.fill(words, self.learn)
                found.append(b"".join(map(self.cache.__getitem__, words)))
            yield found
            self.cache.fill(chain.from_iterable(filter(None, short)), self.learn)

    def with_special(self, text: str) -> tuple[int, bytes]:
        n, found = 0, []
        for i, part in enumerate(self.split_special.split(text)):
            got = (1, str(self.special[part]).encode()) if i % 2 else self.ids_of([part.encode()])[0]
            n += got[0]
            found.extend([got[1]] if got[0] else [])
        return n, b" ".join(found)

    def decode_ids(self, ids: bytes) -> bytes:
        """The tokens of decimal ids, joined by a space, as the file has no decoder; refuses an id it does not know."""
        try:
            return b" ".join([self.tokens[i] for i in ids.split()])
        except KeyError as e:
            raise ValueError(f"no token has the id {e.args[0].decode()!r}") from None


def shared(path: str) -> WordBpe:
    """The worker's encoder, kept between tasks."""
    if path not in _SHARED:
        _SHARED[path] = WordBpe(path)
    return _SHARED[path]


_SHARED: dict[str, WordBpe] = {}


def lower(s: str) -> str:
    """Lower case code point by code point: no rule for a sigma that ends a word."""
    return s.replace("Σ", "σ").lower()


def _encoder(path: str, digests: bool, decoded: bool):
    def run(batches):
        enc = shared(path)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        shown = sha if digests else bytes.decode
        for batch in batches:
            texts = column_bytes(batch.column("text"))
            for a, b in slices([len(t) for t in texts], 1_000_000):
                got = enc.ids_of(texts[a:b])
                cols = [batch.column("doc_id").slice(a, b - a), pa.array([n for n, _ in got], pa.int64()), pa.array([shown(ids) for _, ids in got], pa.string())]
                if decoded:
                    cols.append(pa.array([shown(enc.decode_ids(ids)) for _, ids in got], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, NAMES[: len(cols)])

    return run


NAMES = ["doc_id", "n_tokens", "ids", "decoded"]


def encode(docs: DataFrame, path: str, digests: bool = False, decoded: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (decimal, joined by a space) and decoded (from these ids, as decode() does); their SHA-256 instead if digests.

    path: the tokenizers file, which every executor has, like the library. decoded: whether that column is wanted.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return d.mapInArrow(_encoder(path, digests, decoded), "doc_id bigint, n_tokens bigint, ids string" + ", decoded string" * decoded)


def _decoder(path: str):
    def run(batches):
        enc = shared(path)
        for batch in batches:
            ids = column_bytes(batch.column("ids"))
            for a, b in slices([len(t) for t in ids]):
                decoded = pa.array([enc.decode_ids(t).decode() for t in ids[a:b]], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), decoded], ["doc_id", "decoded"])

    return run


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and decoded of doc_id and ids, as encode() writes them; null ids are no ids."""
    d = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids")
    return d.mapInArrow(_decoder(path), "doc_id bigint, decoded string")


def op7_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    d = encode(table(spark, sf_dir, "documents"), public_tokenizers.path(NAME), digests=True)
    return d.withColumnsRenamed({"ids": "ids_sha256", "decoded": "decoded_sha256"})
