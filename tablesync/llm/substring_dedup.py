"""Substring deduplication (operator 5): seed and extend on winnowed anchors.

Every window of 20 words has one anchor, the rightmost least hash of its runs of 6 words, wherever the window
stands. Documents meet on anchors; an anchor is extended both ways to all words that a window around it can have. If the
extended stretch stands elsewhere too, all windows of the anchor repeat at once; where an anchor is met again with other
neighbours, which is so at the ends of a repeat, the windows of the first place of each stretch are compared one by one. What repeats an earlier place, in
maximal stretches, is removed.

No pairs are made: a stretch or window is looked up once in the first place of its 128-bit key, so that a passage in a
third of all documents costs as many rows as it has places.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import broadcast_object, load, map_batches, staged
from tablesync.llm.shingles import hashes_at, run_hashes, word_hashes

WINDOW = 20
RUN = 6
#: 64-bit words of a filter at most (128 MB); beyond, it lets more through that is then found not to repeat.
FILTER_WORDS = 1 << 24
#: Words of several texts that are looked at together; a longer text is looked at alone.
LINE_WORDS = 1 << 17


class Line:
    """The word hashes of several texts in one array, so that numpy runs over all of them at once.

    Beside each text stand as many zeros as an anchor's stretch can reach beyond it; texts shorter than a window are left out.
    ``windows`` holds where each window starts, text by text, in order; per anchor there are its place, its hash, the hash of
    the stretch around it, the text it stands in, its first and last window in that text (from 0) and its first in ``windows``.
    """

    def __init__(self, texts: list[np.ndarray], window: int = WINDOW, run: int = RUN):
        span, side = window - run + 1, window - run
        owner = np.array([i for i, t in enumerate(texts) if len(t) >= window], np.int64)
        sizes = np.array([len(texts[i]) for i in owner], np.int64)
        begin = np.cumsum(sizes + 2 * side) - sizes - side  # of the words of each text
        gap = np.zeros(side, np.uint64)
        self.hashes = np.concatenate([x for i in owner for x in (gap, texts[i], gap)] or [gap])
        counts = sizes - window + 1
        before = np.cumsum(counts) - counts
        self.windows = np.repeat(begin - before, counts) + np.arange(counts.sum())
        runs = least = run_hashes(self.hashes, run)
        place, width = np.arange(len(runs)), 1
        while width < span and len(owner):  # the least of two stretches that together make the wider one, the right one on ties
            step = min(width, span - width)
            right = least[step:] <= least[:-step]
            least, place = np.where(right, least[step:], least[:-step]), np.where(right, place[step:], place[:-step])
            width += step
        place = place[self.windows]  # of windows within a text only
        self.begins = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else place
        self.counts = np.diff(np.concatenate([self.begins, [len(place)]]))
        at = place[self.begins]
        text = np.searchsorted(before, self.begins, "right") - 1
        self.owner, self.h = owner[text], runs[at]
        self.first = self.begins - before[text]
        self.last = self.first + self.counts - 1
        # The stretch: the anchor and as many words on both sides as a window with it can have; beyond the text, zeros.
        stretch = np.full(len(at), 77, np.uint64)
        for j in (*range(0, 2 * side, run), 2 * side):  # runs that together hold all its words
            stretch = (stretch ^ (stretch >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93) + runs[at + (j - side)]
        self.stretch = stretch ^ (stretch >> np.uint64(32))


def lines(texts: list[str | None], window: int = WINDOW) -> Iterator[tuple[int, Line]]:
    """The texts in order, as many at once as have about :data:`LINE_WORDS` words, each time with the number of the first."""
    start, words, part = 0, 0, []
    for i, t in enumerate(texts):
        part.append(word_hashes(t))
        words += len(part[-1])
        if words >= LINE_WORDS or i == len(texts) - 1:
            yield start, Line(part, window)
            start, words, part = i + 1, 0, []


def anchors(hashes: np.ndarray, window: int = WINDOW, run: int = RUN) -> tuple[np.ndarray, ...]:
    """Of a text's word hashes: anchor hashes, hashes of the stretch around each, first and last window of each."""
    line = Line([hashes], window, run)
    return line.h, line.stretch, line.first, line.last


class Filter:
    """A Bloom filter with two probes over mixed 64-bit hashes."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def has(self, hashes: np.ndarray) -> np.ndarray:
        mask = np.uint64(len(self.words) - 1)
        one = self.words[hashes & mask] >> (hashes >> np.uint64(58))
        two = self.words[(hashes >> np.uint64(26)) & mask] >> ((hashes >> np.uint64(50)) & np.uint64(63))
        return (one & two & np.uint64(1)).astype(bool)


def build_filter(hashes: DataFrame, count: int) -> Filter:
    """Of a column ``h`` of distinct hashes; summed up by Spark, at most :data:`FILTER_WORDS` words reach the driver."""
    size = 1 << 10
    while size < FILTER_WORDS and size * 3 < count:
        size *= 2
    h = F.col("h")
    place = lambda shift: F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(size - 1))
    bit = lambda shift: F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(h, {shift}) & 63 AS INT))")
    probes = hashes.select(F.explode(F.array(
        F.struct(place(0).alias("w"), bit(58).alias("b")), F.struct(place(26).alias("w"), bit(50).alias("b"))
    )).alias("p")).select("p.*")
    rows = probes.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()  # columns, not row objects
    words = np.zeros(size, np.int64)
    words[rows.column("w").to_numpy()] = rows.column("b").to_numpy()
    return Filter(words.view(np.uint64))


def find_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, text_key, repeats`` of rows with words to remove: array of ``lo``, ``hi`` (words, end exclusive),
    stretches that may overlap. ``text_key`` is the hash of the text, which tells rows with the same id apart."""
    source = docs.select("doc_id", F.hash("text").alias("text_key"), "text")

    def seeds(text):
        return _joined([{"h": line.h, "stretch": line.stretch} for _, line in lines(text, window)], ("h", "stretch"))

    met = staged(
        map_batches(source.select("text"), "h bigint, stretch bigint", seeds).groupBy("h").agg(
            F.count("*").alias("n"), (F.min("stretch") != F.max("stretch")).alias("varied")
        ).where("n > 1").select("h", "varied"), "repeat-seeds",
    )
    counts = met.agg(F.count("*"), F.count_if("varied")).first()
    filters = broadcast_object(
        docs.sparkSession, (build_filter(met.select("h"), counts[0]), build_filter(met.where("varied").select("h"), counts[1]))
    )

    def extend(doc_id, text_key, text):
        out = []
        met, varied = filters()
        for start, line in lines(text, window):
            at = np.flatnonzero(met.has(line.h))
            out.append({
                "k1": line.h[at], "k2": line.stretch[at], "lo": line.first[at], "hi": line.last[at] + window,
                "varied": varied.has(line.h[at]), "row": start + line.owner[at],
            })
        return _joined(out, ("k1", "k2", "lo", "hi", "varied", "row"), doc_id=doc_id, text_key=text_key)

    schema = "k1 bigint, k2 bigint, lo bigint, hi bigint, varied boolean, doc_id bigint, text_key int"
    stretches = staged(map_batches(source, schema, extend), "repeat-stretches")
    firsts = stretches.groupBy("k1", "k2").agg(
        F.min(F.struct("doc_id", "lo")).alias("first"), F.count("*").alias("n"), F.bool_or("varied").alias("varied")
    )
    chosen = staged(firsts.where("varied").select(F.xxhash64("k1", "k2", "first.doc_id", "first.lo").alias("h")), "repeat-firsts")
    windowed = broadcast_object(docs.sparkSession, build_filter(chosen, chosen.count()))

    def single(doc_id, text_key, text):
        out = []
        wanted = windowed()
        ids = pa.array(doc_id, pa.int64())
        null, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
        for start, line in lines(text, window):
            row = start + line.owner
            hit = wanted.has(_place(line.h, line.stretch, ids[row], null[row], line.first))
            each = np.flatnonzero(np.repeat(hit, line.counts))  # windows of an anchor follow one another
            at = line.windows[each]
            anchor = np.searchsorted(line.begins, each, "right") - 1
            lo = line.first[anchor] + each - line.begins[anchor]
            out.append({
                "k1": hashes_at(line.hashes, at, window, 1), "k2": hashes_at(line.hashes, at, window, 2),
                "lo": lo, "hi": lo + window, "row": row[anchor],
            })
        return _joined(out, ("k1", "k2", "lo", "hi", "row"), doc_id=doc_id, text_key=text_key)

    schema = "k1 bigint, k2 bigint, lo bigint, hi bigint, doc_id bigint, text_key int"
    windows = staged(map_batches(source, schema, single), "repeat-windows")
    later = _later(stretches).union(_later(windows))
    return later.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("lo", "hi")).alias("repeats"))


def _later(units: DataFrame) -> DataFrame:
    """The units that repeat an earlier one with their key."""
    firsts = units.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "lo")).alias("first"), F.count("*").alias("n")).where("n > 1")
    found = units.join(firsts, ["k1", "k2"]).where(F.struct("doc_id", "lo") > F.col("first"))
    return found.select("doc_id", "text_key", "lo", "hi")


#: The primes of XXH64, which Spark's ``xxhash64`` chains over columns from seed 42 on.
_PRIMES = tuple(map(np.uint64, (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)))


def _place(h: np.ndarray, stretch: np.ndarray, doc_id: np.ndarray, null: np.ndarray, first: np.ndarray) -> np.ndarray:
    """What ``xxhash64(k1, k2, doc_id, lo)`` is in Spark: an anchor, its stretch and where it stands. Nulls are passed over."""
    p1, p2, p3, p4, p5 = _PRIMES
    turn = lambda x, n: (x << np.uint64(n)) | (x >> np.uint64(64 - n))
    out = np.full(len(h), 42, np.uint64)
    for part in (h, stretch, doc_id, first):
        before = out
        out = out + p5 + np.uint64(8)
        out ^= turn(part.view(np.uint64) * p2, 31) * p1
        out = turn(out, 27) * p1 + p4
        out = (out ^ (out >> np.uint64(33))) * p2
        out = (out ^ (out >> np.uint64(29))) * p3
        out ^= out >> np.uint64(32)
        if part is doc_id:
            out = np.where(null, before, out)
    return out


def _joined(parts: list[dict[str, np.ndarray]], names: tuple[str, ...], **columns: list) -> dict[str, object]:
    """The parts one after another; ``columns`` are taken at the number in ``row``."""
    out = {k: np.concatenate([p[k] for p in parts] or [np.zeros(0, np.int64)]) for k in names}
    out = {k: v.view(np.int64) if v.dtype == np.uint64 else v for k, v in out.items()}
    for k, v in columns.items():
        out[k] = pa.array(v, pa.int64()).take(pa.array(out["row"]))
    return out


def remove_repeats(docs: DataFrame, window: int = WINDOW, texts: bool = True) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` and, with ``texts``, ``kept_text`` and ``repeats`` per row of ``docs``.

    The first place of a window is that with the smallest id (a null id is the smallest), then the smallest start; a repeated
    row has its windows at the same places, so neither of the two loses them to the other. A null text has no words. Stretches
    of ``repeats`` are maximal and apart. Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    found = staged(find_repeats(docs, window).withColumnRenamed("doc_id", "id").withColumnRenamed("text_key", "key"), "repeats")
    # Only texts that may have something to remove are shuffled to meet it.
    keys = found.select(F.xxhash64("id", "key").alias("h"))
    touched = broadcast_object(docs.sparkSession, build_filter(keys, keys.count()))

    @F.pandas_udf("boolean")
    def may_repeat(h):
        import pandas as pd

        return pd.Series(touched().has(h.to_numpy().view(np.uint64)))

    hit = may_repeat(F.xxhash64("doc_id", F.hash("text")))
    rest = docs.where(~hit).select("doc_id", "text", F.lit(None).cast(found.schema["repeats"].dataType).alias("repeats"))
    rows = rest.union(docs.where(hit).join(
        found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.hash("text") == F.col("key")), "left"
    ).select("doc_id", "text", "repeats"))

    def each(doc_id, text, repeats):
        out = {k: [] for k in ("n_words", "n_removed", "kept_sha256", "kept_text", "repeats")}
        for t, spans in zip(text, repeats):
            words = (t or "").encode("utf-8", "surrogatepass").split()
            merged: list[list[int]] = []
            for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or ()):
                if merged and lo <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], hi)
                else:
                    merged.append([lo, hi])
            kept, at = [], 0
            for lo, hi in merged:
                kept += words[at:lo]
                at = hi
            kept = b" ".join(kept + words[at:])
            out["n_words"].append(len(words))
            out["n_removed"].append(sum(hi - lo for lo, hi in merged))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            if texts:
                out["kept_text"].append(kept.decode("utf-8", "surrogatepass"))
                out["repeats"].append([{"lo": lo, "hi": hi} for lo, hi in merged])
        return {"doc_id": doc_id} | out

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    return map_batches(rows, schema + (", kept_text string, repeats array<struct<lo:bigint,hi:bigint>>" if texts else ""), each)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(load(spark, sf_dir, "documents"), texts=False)


OP5_SQL = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(words) - 18)) AS i, words FROM w WHERE len(words) >= 20),
k AS (SELECT doc_id, i, sha256(array_to_string(words[i:i + 19], ' ')) AS key FROM s),
f AS (SELECT key, min({'d': doc_id, 'i': i}) AS first, count(*) AS n FROM k GROUP BY key HAVING n > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS place FROM k JOIN f USING (key) WHERE {'d': doc_id, 'i': i} > first),
r AS (SELECT doc_id, list(place) AS gone, count(*) AS n FROM c GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(r.n, 0) AS n_removed,
       sha256(array_to_string(CASE WHEN r.n IS NULL THEN words
              ELSE list_filter(words, lambda x, j: NOT list_contains(gone, j)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN r USING (doc_id)
"""
