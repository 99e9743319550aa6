"""MinHash near-duplicates (operator 9): many universal hash minima, banding, checked links, connected components.

Texts with the same set of shingles are one class, of which only the smallest id goes on. Classes that agree on a
band of minima share a bucket. A bucket is not expanded into pairs: its members are compared with its smallest one. Members of
buckets that still hold different components meet again on rare shingles: two sets that are similar enough share one of the
first shingles of both in any common order, and with the rarest first, texts that have but a passage in common do not
meet. There they are compared with a few members at a time, until every pair that could join two components has been. Pairs whose sizes rule a link out, whose parities show
that too many shingles differ (each differing bit is one at least), or whose signatures of a few bits a minimum are
too far apart, are dropped; the rest is decided on the full sets.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesync.llm.common import load, map_batches, staged
from tablesync.llm.components import connected_components
from tablesync.llm.shingles import shingle_set

SHINGLE = 5
PERCENT = 85
#: 32 bands of 5 minima: a pair at the threshold of 0.85 shares none with probability 7e-9 (at 0.8: 3e-6).
BANDS, ROWS = 32, 5
#: Members of a bucket at most that are compared with its others in the first round on rare shingles, and by how much
#: more in each later one.
PIVOTS, GROWTH = 4096, 8
#: Bits of each minimum in a signature; BANDS * ROWS * SIGNATURE_BITS is a multiple of 64.
SIGNATURE_BITS = 4
#: Bits of a set's parity: how many of its shingles fall on each bit, modulo 2.
PARITY_BITS = 512
#: Standard deviations of the signature distance that a pair at the threshold may be off and still be checked.
SIGMAS = 6.0


def _hash_functions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return rng.integers(0, 1 << 31, BANDS * ROWS, np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, BANDS * ROWS, np.uint32)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each universal hash (multiply and add, modulo 2^32) over a non-empty set."""
    a, b = _hash_functions()
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 512):
        np.minimum(least, (x[i : i + 512, None] * a + b).min(0), out=least)
    return least


def sketch(text: str | None) -> dict[str, object]:
    shingles = shingle_set(text, SHINGLE)
    if not len(shingles):
        return {"n_shingles": 0, "set_key": None, "bands": None, "signature": None, "parity": None}
    least = minima(shingles)
    bits = np.unpackbits((least >> np.uint32(8)).astype(np.uint8)[:, None], axis=1, count=SIGNATURE_BITS, bitorder="little")
    signature = np.packbits(bits).view(np.int64).tolist()
    rows = least.reshape(BANDS, ROWS)
    bands = [xxhash.xxh3_64_intdigest(rows[i].tobytes(), seed=i) - (1 << 63) for i in range(BANDS)]
    return {
        "n_shingles": len(shingles), "set_key": xxhash.xxh3_128_digest(shingles.tobytes()), "bands": bands,
        "signature": signature, "parity": parity(shingles).view(np.int64).tolist(),
    }


def parity(shingles: np.ndarray) -> np.ndarray:
    """Two sets differ in as many shingles as their parities do in bits, or in more."""
    falls = np.bincount((shingles & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS)
    return np.packbits((falls & 1).astype(np.uint8))


def sketches(docs: DataFrame) -> DataFrame:
    def each(doc_id, text):
        rows = [sketch(t) for t in text]
        return {"doc_id": doc_id} | {k: [r[k] for r in rows] for k in ("n_shingles", "set_key", "bands", "signature", "parity")}

    schema = "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>, signature array<bigint>, parity array<bigint>"
    return map_batches(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), schema, each)


def _distance(a: str, b: str, field: str, bits: int) -> Column:
    return sum((F.bit_count(F.col(a)[field][i].bitwiseXOR(F.col(b)[field][i])) for i in range(bits // 64)), F.lit(0))


def _farthest(percent: int) -> float:
    """Signature distance within which nearly all pairs at the threshold lie."""
    # A minimum differs with probability q, and then half its bits do, give or take.
    n, q, half = BANDS * ROWS, 1 - percent / 100, SIGNATURE_BITS / 2
    return n * q * half + SIGMAS * (n * (q * (half / 2 + half**2) - (q * half) ** 2)) ** 0.5


def _sets(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """The full shingle sets of the documents ``ids`` (``doc_id``, distinct)."""

    def each(doc_id, text):
        sets = [shingle_set(t, SHINGLE) for t in text]
        keys = [xxhash.xxh3_64_intdigest(x.tobytes()) - (1 << 63) for x in sets]
        return {"doc_id": doc_id, "set": keys, "n": [len(x) for x in sets], "shingles": [x.view(np.int64) for x in sets]}

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string")).join(ids, "doc_id", "left_semi")
    return staged(map_batches(texts, "doc_id bigint, set bigint, n bigint, shingles array<bigint>", each), "near-sets", few=True)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("u").alias("doc_id")).union(pairs.select(F.col("v").alias("doc_id"))).distinct()


def checked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (``u``, ``v``) whose full sets are similar enough; both must be stored."""
    one = sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("a"))
    other = sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    return pairs.join(other, "v").join(one, "u").where(100 * both >= percent * (F.size("a") + F.size("b") - both)).select(*pairs.columns)


def rare_buckets(sets: DataFrame, percent: int) -> DataFrame:
    """``bucket, doc_id``: the documents of ``sets`` under their rarest shingles that others of them have too.

    Of a set of n, sets that are similar enough hold at least ceil(n * percent / 100), so that one of the first
    n - ceil(n * percent / 100) + 1 of both, in one order of all shingles, is common to them.
    """
    each = sets.select("doc_id", "set", "n", F.explode("shingles").alias("bucket"))
    held = each.join(each.groupBy("bucket").agg(F.count("*").alias("times")), "bucket")
    rank = F.row_number().over(Window.partitionBy("doc_id", "set").orderBy("times", "bucket"))  # a document at a time
    first = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    return held.withColumn("rank", rank).where((F.col("rank") <= first) & (F.col("times") > 1)).select("bucket", "doc_id")


def link(sketched: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Components (``node``, ``component``) of the documents of ``sketched``; it must be stored."""
    spark = docs.sparkSession
    rows = sketched.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = staged(
        rows.groupBy("set_key").agg(
            F.min("doc_id").alias("rep"), F.first("bands").alias("bands"),
            F.struct(
                F.first("n_shingles").alias("size"), F.first("signature").alias("bits"), F.first("parity").alias("parity")
            ).alias("signature"),
        ), "near-classes", few=True,
    )
    copies = rows.select("doc_id", "set_key").join(classes.select("set_key", "rep"), "set_key").where("doc_id <> rep").select(
        F.col("doc_id").alias("u"), F.col("rep").alias("v")
    )
    banded = classes.select(F.col("rep").alias("doc_id"), F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).where("n > 1")
    signatures = classes.select(F.col("rep").alias("doc_id"), "signature")
    members = staged(banded.join(shared.select("bucket", "first"), "bucket").join(signatures, "doc_id"), "near-members", few=True)
    edges = copies
    far = _farthest(percent)

    def near(pairs: DataFrame, *more: str) -> DataFrame:
        a, b = F.col("su.size"), F.col("sv.size")
        alike = pairs.where(F.col("u") != F.col("v")).where(100 * F.least(a, b) >= percent * F.greatest(a, b))
        # Of S shingles in both sets together, at most (100 - percent) / (100 + percent) * S may be in one only.
        close = alike.where((100 + percent) * _distance("su", "sv", "parity", PARITY_BITS) <= (100 - percent) * (a + b)).where(
            _distance("su", "sv", "bits", BANDS * ROWS * SIGNATURE_BITS) <= far
        )
        return staged(close.select("u", "v", *more).distinct(), "near-pairs", few=True)

    su, sv = F.col("signature").alias("su"), F.col("signature").alias("sv")
    firsts = members.where("doc_id = first").select("bucket", F.col("doc_id").alias("u"), su).dropDuplicates(["bucket"])
    pairs = near(members.select("bucket", F.col("doc_id").alias("v"), sv).join(firsts, "bucket"))
    label = connected_components(edges.union(checked(pairs, _sets(_ends(pairs), docs), percent)))

    def unsettled(members: DataFrame) -> DataFrame:
        placed = members.join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
            "component", F.coalesce("component", "doc_id")
        )
        spread = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
        return staged(placed.join(spread.select("bucket"), "bucket"), "near-open", few=True)

    sets = _sets(unsettled(members).select("doc_id").distinct(), docs)
    members = staged(rare_buckets(sets, percent).join(signatures, "doc_id"), "near-members", few=True)
    done, slots = members.select("bucket", "doc_id").limit(0), PIVOTS
    while True:
        still = unsettled(members)
        waiting = still.join(done, ["bucket", "doc_id"], "left_anti")
        pivot = staged(waiting.groupBy("bucket", F.pmod(F.xxhash64("doc_id", "bucket"), F.lit(slots))).agg(
            F.min_by(F.struct("doc_id", "component", "signature"), "doc_id").alias("p")
        ).select("bucket", "p.*"), "near-pivots", few=True)
        if pivot.isEmpty():
            return label
        chosen = pivot.select("bucket", F.col("doc_id").alias("u"), F.col("component").alias("cu"), su)
        others = still.select("bucket", F.col("doc_id").alias("v"), F.col("component").alias("cv"), sv)
        pairs = near(others.join(chosen, "bucket").where("cu <> cv"), "cu", "cv")
        if not pairs.isEmpty():
            # Links between components, not documents: few, and their components are new names of the old ones.
            joined = checked(pairs, sets, percent).select(F.col("cu").alias("u"), F.col("cv").alias("v"))
            moved = connected_components(joined)
            to = moved.select(F.col("node").alias("component"), F.col("component").alias("to"))
            label = staged(label.join(to, "component", "left").select("node", F.coalesce("to", "component").alias("component")).union(moved), "near-labels", few=True)
        done, slots = staged(done.union(pivot.select("bucket", "doc_id")), "near-done", few=True), slots * GROWTH


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs`` (``doc_id``, ``text``; others are not read).

    Null and empty texts have no shingles and no links. An id that repeats is one document with several texts, linked if one
    of them is; all its rows are kept or none. Rows without an id are kept and have no component.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    sketched = staged(sketches(docs), "near-sketches")
    component = link(sketched, docs, percent).withColumnRenamed("node", "doc_id")
    joined = sketched.select("doc_id", "n_shingles").join(component, "doc_id", "left")
    found = joined.withColumn("component_id", F.coalesce("component", "doc_id"))
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "documents"))


OP9_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
        WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
-- Two sets can only be similar enough if they share one of the first tenths of their shingles in any fixed order.
o AS (SELECT s.doc_id, shingle, n, row_number() OVER (PARTITION BY s.doc_id ORDER BY shingle) AS k FROM s JOIN n USING (doc_id)),
c AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM o a JOIN o b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
      AND a.k <= a.n - (85 * a.n + 99) // 100 + 1 AND b.k <= b.n - (85 * b.n + 99) // 100 + 1),
i AS (SELECT a, b, count(*) AS i FROM c JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b AND y.shingle = x.shingle GROUP BY a, b),
e AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS seen FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.seen),
m AS (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)
"""
