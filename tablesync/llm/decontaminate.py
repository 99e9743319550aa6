"""Benchmark decontamination (operator 7): CGK walks and bit-sampling keys for candidates, edit distance; all over words.

An item is cut into windows that share its allowed edits, so that in every passage within them some window has one edit
at most. A CGK walk embeds a window: at each step it notes the word it stands at, and a random bit of that word decides
whether it goes on to the next, so that windows an edit apart soon walk in step again and differ in few places. Keys of a few
places of the embedding, sampled anew for each of several walks, meet with a probability that the number of keys brings to
the target recall. Windows of all texts are embedded alike, those that hold as many words and pairs of neighbours of the
items as one edit must leave. Where a key meets,
the words around must be the item's but for the allowed edits; there the edit distance to the best stretch decides.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import broadcast_object, load, map_batches

#: A passage is a leak if its words are within this share of an item's words in edits.
EDIT_SHARE = 0.2
#: Walks over a window, keys sampled from each, and places of the embedding a key is made of. With them a window with one
#: edit meets its item's with a probability of 0.99 (measured in the tests), one without edits always.
WALKS, SAMPLES, PLACES = 24, 3, 4
#: Bits that tell the known pairs of neighbours, at most.
PAIR_BITS = 24
#: Words of the joined texts of a batch that are looked up at once.
CHUNK_WORDS = 100_000
#: Items that one pass over the documents searches for; a larger benchmark takes more passes.
BLOCK_ITEMS = 20_000
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def edits_allowed(length: int) -> int:
    return int(EDIT_SHARE * length)


def best_stretch(item: list[int], text: list[int] | np.ndarray) -> tuple[int, int, int]:
    """``(edits, start, end)`` of the stretch of ``text`` nearest to ``item``; of equals the first to end, then the longest."""
    text = np.asarray(text, np.int64)
    n = len(text)
    unit = n + 1  # a cell is edits * unit + where the stretch starts
    steps = np.arange(n + 1) * unit
    row = np.arange(n + 1)
    for i, symbol in enumerate(item, 1):
        new = row + unit
        np.minimum(new[1:], row[:-1] + (text != symbol) * unit, out=new[1:])
        new[0] = i * unit
        row = np.minimum.accumulate(new - steps) + steps
    edits = row // unit
    end = int(edits.argmin())
    return int(edits[end]), int(row[end] % unit), end


def windows_of(length: int) -> list[tuple[int, int]]:
    """``(start, words)`` of the windows of an item, as equal as they can be: so many that some has one edit at most."""
    parts = edits_allowed(length) // 2 + 1
    cuts = [length * k // parts for k in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """Random-looking 64-bit values of small numbers."""
    x = (numbers.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pairs(line: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Places in a table for each two neighbours of a line of mixed words."""
    return ((line[:-1] * np.uint64(0xD6E8FEB86659FD93) ^ line[1:]) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - (len(table).bit_length() - 1))).astype(np.int64)


def walk_keys(line: np.ndarray, starts: np.ndarray, size: int, walk: int) -> list[np.ndarray]:
    """The sampled keys of one CGK walk over each window of ``size`` words of ``line`` (mixed words) from ``starts`` on.

    A walk takes two steps a word; a window that is walked through stays at its end.
    """
    rng = np.random.default_rng((size, walk))
    steps = 2 * size
    turns = rng.integers(0, 1 << 63, steps, np.uint64) * np.uint64(2) + np.uint64(1)
    # The last places are reached by few walks only in step, and say little.
    places = [set(rng.choice(steps - 1, min(PLACES, steps - 1), replace=False).tolist()) for _ in range(SAMPLES)] if steps > 2 else [{0}]
    keys = [np.full(len(starts), size * 1_000_003 + walk * 1009 + k, np.uint64) for k in range(len(places))]
    at, end = starts.copy(), starts + size
    for step in range(steps):
        word = line[np.minimum(at, end - 1)]
        word = np.where(at < end, word, np.uint64(1))
        for k, sampled in enumerate(places):
            if step in sampled:
                keys[k] = (keys[k] ^ word) * np.uint64(0x9E3779B97F4A7C15)
                keys[k] ^= keys[k] >> np.uint64(29)
        at += ((word * turns[step]) >> np.uint64(63)).astype(np.int64)
    return keys


@dataclass(frozen=True)
class Items:
    """A block of benchmark items with everything a task needs to find them."""

    ids: list[int]
    words: list[list[int]]
    vocabulary: dict[str, int]
    #: words of a window, edits it may have -> per walk and sample, sorted keys of the windows, and the item and start of each
    seeds: dict[tuple[int, int], list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]]]
    #: by hash: do two words stand side by side in an item (or others of the same hash)
    pairs: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, str | None]]) -> Items:
        vocabulary: dict[str, int] = {}
        texts = [(i, words_of(t)) for i, t in rows]
        texts = [(i, w) for i, w in texts if w]
        words = [[vocabulary.setdefault(x, len(vocabulary) + 1) for x in w] for _, w in texts]
        by_size: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for n, w in enumerate(words):
            for start, size in windows_of(len(w)):
                by_size.setdefault((size, min(1, edits_allowed(len(w)))), []).append((n, start))
        begin = np.cumsum([0] + [len(w) for w in words])
        line = _mixed(np.array([x for w in words for x in w], np.int64))
        seeds = {}
        for (size, edits), found in by_size.items():
            item, start = np.array(found, np.int64).T
            seeds[size, edits] = []
            for walk in range(WALKS if edits else 1):  # without edits every walk meets
                made = []
                for keys in walk_keys(line, begin[item] + start, size, walk)[: None if edits else 1]:
                    rank = np.argsort(keys, kind="stable")
                    made.append((keys[rank], item[rank], start[rank]))
                seeds[size, edits].append(made)
        pairs = np.zeros(1 << min(PAIR_BITS, max(10, (16 * len(line)).bit_length())), bool)
        pairs[_pairs(line, pairs)] = True
        return cls([i for i, _ in texts], words, vocabulary, seeds, pairs)

    def _places(self, line: np.ndarray) -> dict[int, np.ndarray]:
        """item number -> where it would start in ``line``, could be outside, by the windows whose keys meet there."""
        found: dict[int, list[np.ndarray]] = {}
        known = np.concatenate([[0], np.cumsum(line > 0)])
        mixed = _mixed(np.arange(len(self.vocabulary) + 1))[line]
        near = np.concatenate([[0], np.cumsum(self.pairs[_pairs(mixed, self.pairs)] & (line[:-1] > 0) & (line[1:] > 0))])
        for (size, edits), walks in self.seeds.items():
            # An edit leaves all words but one of an item's window in the text's, and all pairs but two.
            enough = known[size:] - known[:-size] >= max(1, size - edits)
            enough &= near[size - 1 :] - near[: len(near) - size + 1] >= size - 1 - 2 * edits
            windows = np.flatnonzero(enough)
            for low in range(0, len(windows), CHUNK_WORDS):
                at = windows[low : low + CHUNK_WORDS]
                part = mixed[at[0] : at[-1] + size]
                for walk, made in enumerate(walks):
                    for (keys, items, offsets), wanted in zip(made, walk_keys(part, at - at[0], size, walk)):
                        first = np.searchsorted(keys, wanted, "left")
                        hit = np.flatnonzero(keys[np.minimum(first, len(keys) - 1)] == wanted)
                        if not len(hit):
                            continue
                        first = first[hit]
                        count = np.searchsorted(keys, wanted[hit], "right") - first
                        seed = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
                        place = np.repeat(at[hit], count) - offsets[seed]
                        order = np.argsort(items[seed], kind="stable")
                        numbers, starts = np.unique(items[seed][order], return_index=True)
                        for n, places in zip(numbers.tolist(), np.split(place[order], starts[1:])):
                            found.setdefault(n, []).append(places)
        return {n: np.unique(np.concatenate(parts)) for n, parts in found.items()}

    def find(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """``(text number, item id, start, end, edits)``: the best place of every item found in every text."""
        if not self.words:
            return []
        get = self.vocabulary.get
        longest = max(map(len, self.words))
        gap = longest + 2 * edits_allowed(longest)  # no stretch that is looked at reaches another text
        numbers = [np.fromiter((get(w, 0) for w in words_of(t)), np.int64) for t in texts]
        starts = gap + np.cumsum([0] + [len(x) + gap for x in numbers])
        line = np.zeros(starts[-1] + gap, np.int64)
        for at, x in zip(starts, numbers):
            line[at : at + len(x)] = x
        inside = np.zeros(len(self.vocabulary) + 1, bool)
        out = []
        for n, places in self._places(line).items():
            item = self.words[n]
            length, allowed = len(item), edits_allowed(len(item))
            inside[item] = True
            reach = np.arange(-allowed, length + allowed)
            step = max(1, 2_000_000 // len(reach))
            kept = [part[inside[line[part[:, None] + reach]].sum(1) >= length - allowed] for part in np.split(places, range(step, len(places), step))]
            inside[item] = False
            places = np.concatenate(kept)
            if not len(places):
                continue
            # A place may start before its text: the first piece can stand at the start with words before it left out.
            owner = np.searchsorted(starts, places + length - 1, "right") - 1
            # Places whose stretches overlap are looked at together.
            cut = np.flatnonzero((np.diff(places) > length + 2 * allowed) | (np.diff(owner) > 0)) + 1
            best: dict[int, tuple[int, int, int]] = {}
            for group, text in zip(np.split(places, cut), owner[np.concatenate([[0], cut])].tolist()):
                low = max(0, int(group[0] - starts[text]) - allowed)
                high = int(group[-1] - starts[text]) + length + allowed
                edits, a, b = best_stretch(item, numbers[text][low:high])
                if edits <= allowed and (text not in best or edits < best[text][0]):
                    best[text] = edits, low + a, low + b
            out += [(text, self.ids[n], a, b, edits) for text, (edits, a, b) in best.items()]
        return out


def item_blocks(benchmark: DataFrame, block: int = BLOCK_ITEMS) -> list[Items]:
    """The benchmark in blocks of a bounded number of items, each small enough for every task."""
    rows = benchmark.select(F.col("item_id").cast("bigint"), F.col("text").cast("string"))
    parts = max(1, -(-rows.count() // block))
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    return [Items.of(sorted(((r[0], r[1]) for r in rows.where(number == i).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")))
            for i in range(parts)]


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, start_word, end_word, edits``: each benchmark item that a row of ``docs`` holds, at its best place.

    Words are runs of letters and digits, lower-cased. Null and empty texts and items hold nothing; items of fewer than five
    words are found where they stand unchanged; repeated rows are reported each, null ids as null. Other columns are not read.
    """
    source = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    out = None
    for items in item_blocks(benchmark):
        shared = broadcast_object(docs.sparkSession, items)  # at most BLOCK_ITEMS items

        def each(doc_id, text, shared=shared):
            found = shared().find(text)
            column = lambda k: [f[k] for f in found]
            return {"doc_id": [doc_id[f[0]] for f in found], "item_id": column(1), "start_word": column(2), "end_word": column(3), "edits": column(4)}

        part = map_batches(source, "doc_id bigint, item_id bigint, start_word bigint, end_word bigint, edits int", each)
        out = part if out is None else out.union(part)
    return out


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of ``docs`` that hold no item of ``benchmark``, with all their columns; no shuffle."""
    for items in item_blocks(load(spark, sf_dir, "benchmark")):
        docs = docs.where(_clean(broadcast_object(spark, items))(F.col("text").cast("string")))
    return docs


def _clean(shared):
    @F.pandas_udf("boolean")
    def clean(text):
        import pandas as pd

        values = [None if t is None else str(t) for t in text]
        hit = {i + f[0] for i in range(0, len(values), 1000) for f in shared().find(values[i : i + 1000])}
        return pd.Series([i not in hit for i in range(len(values))], dtype=bool)

    return clean
