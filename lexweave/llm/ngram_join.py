"""N-gram Jaccard join by multiple-global-order filtering, and its components.

A document's set holds its distinct shingles of k words (A-Z lower-cased), or the whole
sequence where it has fewer. Two documents link when 100 x intersection >= percent x union.

Rows of equal sets are one class from the start; classes are joined. Two sets that link
share a token in the prefixes that any global order of tokens gives them, and l tokens in
prefixes that are l - 1 longer. The orders:
1. by hash: prefixes of order 1, longer by l - 1, are posted; a token that no other
   class posts can't be shared.
2. by rarity among the posted: of what a class posted, its l' - 1 most frequent tokens
   (l' the least l of a set that may link with it) are not needed, as of l' shared ones
   one remains.
3., 4. by two other hashes: candidates whose prefixes in either share no token go before
   any set is fetched. The prefixes stand in a table of sketches.
A bitmap in the sketch (BITS bits of which each token flips one) differs in no more bits than
the sets differ in tokens; it is compared as classes meet in a bucket.

As components are wanted, not pairs, a bucket of classes that post one token is not
expanded. Each class is first verified with one leader of a bucket; what is linked counts
as one, and this repeats STARS times. Then all pairs of a bucket between different
components that pass the filters are verified, so no link between components is lost.

Words are told by 64-bit hashes, shingles by 64 bits mixed from these, equal sets by a
128-bit digest; a collision of shingles of one pair of sets can shift its overlap by one.

Null texts and texts without words have an empty set and link with nothing. A null
doc_id links with nothing and is its own component (null). Rows that share a doc_id are
compared on their own and share a component. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NUMBERS, column_bytes, cut, match_rows, mix, packed, slices, table, unpacked, windows, with_row_key, word_numbers
from .components import components

K, PERCENT = 4, 85
STARS = 2
SHORT = 128
BITS = 512
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_ORDERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def needed(n, percent: int):
    """The least overlap of a set of n tokens with one that links with it."""
    return -(-percent * n // 100)


def spare(n, percent: int):
    """l: how many tokens the prefixes of order 1 of linked sets share; short sets are posted whole or nearly."""
    return np.maximum(n // 16, np.minimum(needed(n, percent), SHORT))


def sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """The sorted hashes of each text's set."""
    first, (numbers,) = word_numbers([t.translate(LOWER) for t in texts], NUMBERS)
    every = windows(numbers, k)
    out = []
    for a, b in zip(first, first[1:], strict=False):
        if b - a >= k:
            out.append(np.unique(every[a : b - k + 1]))
        else:
            out.append(windows(numbers[a:b], int(b - a)) if b > a else numbers[:0])
    return out


def _per_set(columns: list[str], k: int, fn, types):
    """A mapInArrow function: fn(set) gives the new columns' values of a row, or None."""

    def run(batches):
        for batch in batches:
            texts = column_bytes(batch.column("text"))
            for a, b in slices([len(t) for t in texts]):
                got = [(i, x) for i, s in enumerate(sets(texts[a:b], k)) if (x := fn(s)) is not None]
                if got:
                    which = pa.array([i for i, _ in got])
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(c).slice(a, b - a).take(which) for c in columns), *(pa.array([x[j] for _, x in got], t) for j, t in enumerate(types.values()))], [*columns, *types]
                    )

    return run


def summaries(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, _rk, n, digest (of the set) of every row."""
    d = with_row_key(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "text")
    fn = lambda s: (len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest())
    return d.mapInArrow(_per_set(["doc_id", "_rk"], k, fn, {"n": pa.int64(), "digest": pa.binary()}), "doc_id bigint, _rk bigint, n bigint, digest binary")


def postings(texts: DataFrame, k: int, percent: int) -> DataFrame:
    """token, rid, n: prefixes of order 1 of rid, text; long by l - 1."""

    def run(batches):
        for batch in batches:
            text = column_bytes(batch.column("text"))
            rid = batch.column("rid").to_numpy()
            for a, b in slices([len(t) for t in text]):
                found = sets(text[a:b], k)
                n = np.array([len(s) for s in found], np.int64)
                size = np.minimum(n, n - needed(n, percent) + spare(n, percent))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([s[:m] for s, m in zip(found, size, strict=True)]).view(np.int64)),
                    pa.array(np.repeat(rid[a:b], size)), pa.array(np.repeat(n, size).astype(np.int32)),
                ], ["token", "rid", "n"])

    return texts.select("rid", "text").mapInArrow(run, "token bigint, rid bigint, n int")


def buckets(posted: DataFrame, percent: int) -> DataFrame:
    """token, rid, n, own, rank: what order 2 leaves of the tokens that several classes posted.

    own: how many rid alone posted; rank: the token's place in order 2 among all posted by rid.
    """
    p = posted.repartition("token")
    # reads all columns of p, so both uses of p are one shuffle and the texts are read once
    many = p.groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.min("rid").alias("low"), F.max("rid").alias("high"), F.max("n").alias("most")).where("low < high AND most > 0")
    p = p.join(many.select("token", "c").hint("shuffle_hash"), "token")
    lists = p.groupBy("rid", "n").agg(F.sort_array(F.collect_list(F.struct("c", "token"))).alias("x"))
    need, more, size = _sizes(percent)
    n = F.col("n")
    drop = more(need(n)) - 1  # need(n) is also the size of the smallest set that may link
    lists = lists.withColumn("own", (size(n) - F.size("x")).cast("int"))
    lists = lists.select("rid", "n", "own", F.posexplode(F.slice("x", 1, F.greatest(F.lit(0), F.size("x") - drop).cast("int"))).alias("at", "x"))
    return lists.select("x.token", "rid", "n", "own", (F.col("own") + F.col("at") + 1).alias("rank"))


def _sizes(percent: int):
    """needed() and spare() in columns, and how many tokens a set of n posts."""
    need = lambda n: F.ceil(F.lit(percent) * n / 100)
    more = lambda n: F.greatest(F.floor(n / 16), F.least(need(n), F.lit(SHORT)))
    return need, more, lambda n: n - need(n) + more(n)


def may_link(n, rank, m, rank_m, percent: int):
    """Whether the sizes, and a token's ranks among what the two posted, let it be their rarest common one.

    Sets that link have `both` tokens in common, of which they post `least`; before the
    rarest of these stands at most the rest of what a set posted.
    """
    need, more, size = _sizes(percent)
    both = F.ceil(F.lit(percent) * (n + m) / (100 + percent))
    least = F.least(both - need(n) + more(n), both - need(m) + more(m), both)
    fit = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    return fit & (rank <= size(n) - least + 1) & (rank_m <= size(m) - least + 1)


def _prefix(s: np.ndarray, order: np.uint64, percent: int) -> np.ndarray:
    x = mix(s ^ order)
    size = len(s) - needed(len(s), percent) + 1
    return np.partition(x, size - 1)[:size] if size < len(x) else x


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets link."""
    if min(len(x), len(y)) < needed(max(len(x), len(y)), percent):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def sketch(s: np.ndarray, percent: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The set, its prefixes in orders 3 and 4 (32 bits of each token), its bitmap as longs."""
    flips = (np.bincount((s & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1).astype(np.uint8)
    low = lambda x: x.astype(np.uint32).view(np.int32)
    return s.tobytes(), *(low(_prefix(s, o, percent)) for o in _ORDERS), np.packbits(flips).view(np.int64)


def near(percent: int):
    """The bitmap filter on columns bits and n, bits_b and m."""
    flipped = sum(F.bit_count(F.get("bits", i).bitwiseXOR(F.get("bits_b", i))) for i in range(BITS // 64))
    both = F.ceil(F.lit(percent) * (F.col("n") + F.col("m")) / (100 + percent))
    return flipped <= F.col("n") + F.col("m") - 2 * both


def verify(pairs: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b that link; held: rid, set (its hashes' bytes), o3 and o4. Orders 3 and 4 come first, and the sets of what they leave."""

    def run(batches):
        for batch in batches:
            read = lambda c: [np.frombuffer(v, np.uint64) for v in batch.column(c).to_pylist()]
            keep = pa.array([linked(x, y, percent) for x, y in zip(read("x"), read("y"), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(keep)

    side = lambda k, *names: held.select(F.col("rid").alias(k), *(F.col(n).alias(f"{n}_{k}") for n in names))
    p = pairs.join(side("a", "o3", "o4"), "a").join(side("b", "o3", "o4"), "b")
    p = p.where(F.arrays_overlap("o3_a", "o3_b") & F.arrays_overlap("o4_a", "o4_b")).select("a", "b")
    p = p.join(side("a", "set"), "a").join(side("b", "set"), "b")
    return p.select("a", "b", F.col("set_a").alias("x"), F.col("set_b").alias("y")).mapInArrow(run, "a bigint, b bigint")


def cluster(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """doc_id, _rk, n (set size), component_id of every row."""
    d = with_row_key(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "text")
    rows = cut(summaries(docs, k), "sets")
    real = rows.where("n > 0 AND doc_id IS NOT NULL")
    # rid: one number per class; the doc_id of its first row unless several classes have that
    first = real.groupBy("digest").agg(F.min(F.struct("doc_id", "_rk", "n")).alias("f")).select("digest", "f.*")
    shared = first.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c"))
    classes = cut(first.join(shared, "doc_id").withColumn("rid", F.when(F.col("c") == 1, F.col("doc_id")).otherwise(F.xxhash64("doc_id", "_rk"))).drop("c"), "classes")
    texts = match_rows(d, classes.select("doc_id", "_rk", "rid"))
    texts = texts.dropDuplicates(["rid"]) if _repeats(rows) else texts
    posted = cut(buckets(postings(texts, k, percent), percent), "buckets")
    several = posted.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("token")
    posted = cut(posted.join(several, "token"), "buckets")
    active = posted.select("rid").distinct()
    kinds = {"set": pa.binary(), "o3": pa.list_(pa.int32()), "o4": pa.list_(pa.int32()), "bits": pa.list_(pa.int64())}
    to_sketch = _per_set(["rid"], k, lambda s: sketch(s, percent), kinds)
    held = cut(texts.join(active, "rid").select("rid", "text").mapInArrow(to_sketch, "rid bigint, set binary, o3 array<int>, o4 array<int>, bits array<bigint>"), "active")
    links = tested = None
    # rows of one doc_id with different texts share a component
    same = classes.where("rid <> doc_id").select(F.col("rid").alias("b"), F.min("rid").over(_by("doc_id")).alias("a")).where("a <> b").select("a", "b")
    comps = posted.select("rid").distinct().withColumn("comp", F.col("rid"))
    for star in range(STARS + 1):
        p = posted.join(comps, "rid")
        # the leader: first the class with the fewest tokens of its own, which an original has; then any other
        first = F.col("own").cast("long") if star == 0 else F.xxhash64("rid", F.lit(star))
        mixed = p.groupBy("token").agg(F.min(F.struct(first.alias("first"), "rid", "n", "comp", "rank")).alias("lead"), F.min("comp").alias("low"), F.max("comp").alias("top")).where("low < top")
        if star < STARS:
            p = p.join(mixed, "token").where(F.expr("comp <> lead.comp") & may_link(F.col("n"), F.col("rank"), F.col("lead.n"), F.col("lead.rank"), percent))
            p = p.groupBy("rid", F.col("lead.rid").alias("to")).agg(F.count(F.lit(1)).alias("c"))
            p = p if tested is None else p.join(tested, (F.least("rid", "to") == tested["a"]) & (F.greatest("rid", "to") == tested["b"]), "left_anti")
            pairs = p.groupBy("rid").agg(F.max_by("to", F.struct("c", -F.col("to"))).alias("to")).select(F.least("rid", "to").alias("a"), F.greatest("rid", "to").alias("b")).distinct()
        else:
            p = p.join(mixed.select("token"), "token").select("token", "rid", "comp", "n", "rank").join(held.select("rid", "bits"), "rid").repartition("token")
            q = p.withColumnsRenamed({"rid": "b", "comp": "comp_b", "n": "m", "rank": "rank_m", "bits": "bits_b"})
            p = p.join(q, "token").where(F.expr("rid < b AND comp <> comp_b") & may_link(F.col("n"), F.col("rank"), F.col("m"), F.col("rank_m"), percent) & near(percent))
            pairs = p.select(F.col("rid").alias("a"), "b").distinct().join(tested, ["a", "b"], "left_anti")
        pairs = cut(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = cut(verify(pairs, held, percent), "links")
        links = found if links is None else links.unionByName(found)
        if star == STARS and found.isEmpty():
            break
        comps = components(links.unionByName(same))
        ids = posted.select("rid").distinct() if star < STARS else classes.select("rid")
        comps = cut(ids.join(comps, ids["rid"] == comps["node"], "left").select("rid", F.coalesce("comp", "rid").alias("comp")), "comps")
    comps = classes.select("rid").join(comps, "rid", "left").select("rid", F.coalesce("comp", "rid").alias("comp"))
    named = classes.join(comps, "rid")
    least = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "comp").select("digest", "component_id")
    out = rows.join(named, "digest", "left")
    return out.select("doc_id", "_rk", "n", F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _by(*columns):
    from pyspark.sql import Window

    return Window.partitionBy(*columns)


def _repeats(rows: DataFrame) -> bool:
    """Whether a row occurs more than once."""
    return not rows.groupBy("doc_id", "_rk").agg(F.count(F.lit(1)).alias("c")).where("c > 1").isEmpty()


def deduplicate(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component stays, that of the smallest doc_id, with all its columns.

    Of rows that share this doc_id the one with the smallest hash stays; rows without a
    doc_id and rows with an empty set all stay.
    """
    c = cluster(docs, k, percent)
    alone = c.where("n = 0 OR doc_id IS NULL").select("doc_id", "_rk")
    first = c.where("n > 0 AND doc_id = component_id").groupBy("doc_id").agg(F.min("_rk").alias("_rk"))
    stay = alone.unionByName(first.select("doc_id", "_rk")).distinct()
    out = match_rows(with_row_key(packed(docs, F.col("doc_id").cast("long").alias("doc_id"), "text"), "text"), stay)
    if _repeats(c):
        out = out.where("doc_id IS NULL OR text IS NULL").unionByName(out.where("doc_id IS NOT NULL AND text IS NOT NULL").dropDuplicates(["doc_id", "_rk"]))
    return unpacked(out)


def op5_ngram_join(spark, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "documents")).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def clusters_sql(source: str = "documents", k: int = K, percent: int = PERCENT) -> str:
    """CTEs that end in `clusters` (doc_id, n_shingles, component_id); needs WITH RECURSIVE."""
    words = r"coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), [])"
    return f"""
n_words AS MATERIALIZED (SELECT doc_id, {words} AS w FROM {source}),
n_sh AS MATERIALIZED (SELECT DISTINCT doc_id, hash(x) AS x FROM (SELECT doc_id, array_to_string(w[i:i + {k - 1}], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {k - 1}, 1) + 1)) AS i FROM n_words WHERE len(w) > 0))),
n_size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM n_sh GROUP BY doc_id),
n_df AS MATERIALIZED (SELECT x, count(*) AS c FROM n_sh GROUP BY x),
n_pre AS MATERIALIZED (SELECT doc_id, x, n FROM (SELECT doc_id, x, n, c, row_number() OVER (PARTITION BY doc_id ORDER BY c, x) AS r FROM n_sh JOIN n_size USING (doc_id) JOIN n_df USING (x)) WHERE r <= n - ({percent} * n + 99) // 100 + 1 AND c > 1),
n_cand AS MATERIALIZED (SELECT DISTINCT p.doc_id AS a, q.doc_id AS b, p.n AS na, q.n AS nb FROM n_pre p JOIN n_pre q ON p.x = q.x AND p.doc_id < q.doc_id WHERE 100 * least(p.n, q.n) >= {percent} * greatest(p.n, q.n)),
n_link AS MATERIALIZED (SELECT a, b FROM (SELECT a, b, na, nb, count(*) AS o FROM n_cand JOIN n_sh s ON s.doc_id = a JOIN n_sh t ON t.doc_id = b AND s.x = t.x GROUP BY a, b, na, nb) WHERE 100 * o >= {percent} * (na + nb - o)),
n_edge AS MATERIALIZED (SELECT a, b FROM n_link UNION SELECT b, a FROM n_link),
n_reach AS (SELECT doc_id AS a, doc_id AS b FROM n_words UNION SELECT n_reach.a, n_edge.b FROM n_reach JOIN n_edge ON n_reach.b = n_edge.a),
clusters AS (SELECT n_words.doc_id, coalesce(n, 0) AS n_shingles, c AS component_id FROM n_words JOIN (SELECT a, min(b) AS c FROM n_reach GROUP BY a) ON n_words.doc_id = a LEFT JOIN n_size ON n_size.doc_id = n_words.doc_id)"""


SQL = f"WITH RECURSIVE {clusters_sql()} SELECT * FROM clusters"
