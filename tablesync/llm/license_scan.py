"""License scans (operator 1): fuzzy search for short notices in whole texts.

A notice of ``n`` characters that may differ by ``k`` edits is split into ``k + 1`` pieces; one of them must stand
unchanged wherever the notice does (pigeonhole). The pieces are searched exactly, and only around a hit the
``regex`` library matches the whole notice with at most ``k`` errors and reports where. Notices with ``k = 0`` are one piece.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from functools import cached_property

import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import load, map_batches

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {i: i + 32 for i in range(65, 91)}


@dataclass(frozen=True)
class Notice:
    """``phrase``: lower-case words with one space between; ``errors``: edits (characters) that a match may have."""

    phrase: str
    label: str
    errors: int = 0

    @cached_property
    def seeds(self) -> list[tuple[int, str]]:
        n, parts = len(self.phrase), self.errors + 1
        cuts = [i * n // parts for i in range(parts + 1)]
        return [(a, self.phrase[a:b]) for a, b in zip(cuts, cuts[1:])]

    @cached_property
    def pattern(self) -> regex.Pattern:
        body = f"(?:{regex.escape(self.phrase, special_only=True)}){{e<={self.errors}}}" if self.errors else regex.escape(self.phrase)
        return regex.compile(rf"(?<![^ ]){body}(?![^ ])", regex.BESTMATCH if self.errors else 0)


#: The base phrases and their labels.
BASE = (
    Notice("under the mit license", "mit"),
    Notice("apache license version 2", "apache-2"),
    Notice("cc by nc", "cc-by-nc"),
)

#: Short notices that the method finds with edits; about one edit in eight characters.
FUZZY = (
    Notice("released under the mit license", "mit", 3),
    Notice("licensed under the apache license version 2 0", "apache-2", 5),
    Notice("licensed under cc by nc 4 0", "cc-by-nc", 3),
    Notice("licensed under cc by sa 4 0", "cc-by-sa", 1),
    Notice("licensed under the gnu general public license version 3", "gpl-3", 6),
    Notice("licensed under the gnu lesser general public license", "lgpl", 4),
    Notice("redistribution and use in source and binary forms", "bsd", 5),
    Notice("subject to the terms of the mozilla public license", "mpl", 5),
    Notice("dedicated to the public domain", "public-domain", 3),
    Notice("all rights reserved", "all-rights-reserved", 1),
)


def find_notice(text: str, notice: Notice) -> list[tuple[int, int, int]]:
    """``(start, end, edits)`` in a text of words with single spaces; matches start and end with a word.

    Every place of a notice without errors, overlapping ones too. With errors, one match per place: of matches that
    overlap the one with the fewest edits, then the leftmost.
    """
    n, k = len(notice.phrase), notice.errors
    found: dict[tuple[int, int], int] = {}
    tried = -1
    starts = sorted({max(0, at - offset) for offset, seed in notice.seeds for at in _places(text, seed)})
    for start in starts:
        if k == 0:
            if notice.pattern.match(text, start):
                found[start, start + n] = 0
            continue
        if start <= tried:  # the last window began at most k characters before: it covers this one
            continue
        tried = start + k
        low, high = max(0, start - 2 * k - 1), min(len(text), start + n + 3 * k + 1)
        while match := notice.pattern.search(text, low, high):
            found[match.span()] = sum(match.fuzzy_counts)
            low = match.end()
    best: list[tuple[int, int, int]] = []
    if k == 0:
        return [(a, b, 0) for a, b in sorted(found)]
    for (a, b), edits in sorted(found.items(), key=lambda x: (x[1], x[0])):
        if all(b <= x or y <= a for x, y, _ in best):
            best.append((a, b, edits))
    return sorted(best)


def _places(text: str, seed: str):
    at = text.find(seed)
    while at >= 0:
        yield at
        at = text.find(seed, at + 1)


def scan(text: str | None, base=BASE, fuzzy=FUZZY) -> dict[str, object]:
    """Everything about one whole text: word count, base places and spans of notices in code points of the text."""
    lowered = (text or "").translate(_LOWER)
    words = WORD.findall(lowered)
    joined = " ".join(words)
    places = [(notice, *hit) for notice in base for hit in find_notice(joined, notice)]
    more = [(notice, *hit) for notice in fuzzy for hit in find_notice(joined, notice)]
    out = {"n_words": len(words), "n_base": len(places), "first_word": None, "last_word": None, "spans": []}
    score = 1.0 if places else max((1 - e / len(n.phrase) for n, _, _, e in more), default=0.0)
    if places or more:
        begins, at = [], 0
        for word in words:
            begins.append(at)
            at += len(word) + 1
        source = [m.span() for m in WORD.finditer(lowered)]
        firsts = [bisect_left(begins, a) for _, a, _, _ in places]
        out |= {"first_word": min(firsts, default=None), "last_word": max(firsts, default=None)}
        for notice, a, b, edits in places + more:
            start, end = source[bisect_right(begins, a) - 1][0], source[bisect_right(begins, b - 1) - 1][1]
            out["spans"].append({"label": notice.label, "start": start, "end": end, "edits": edits, "found": text[start:end]})
        out["spans"].sort(key=lambda s: (s["start"], s["end"], s["label"], s["edits"]))
    base_labels = {n.label for n, *_ in places}
    return out | {
        "score": float(score), "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(base_labels | {n.label for n, *_ in more})),
    }


_COLUMNS = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, "
    "spans array<struct<label:string,start:int,end:int,edits:int,found:string>>"
)


def scan_licenses(docs: DataFrame, base=BASE, fuzzy=FUZZY) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``; others are not read), no shuffle.

    ``spans`` has each match with its label, code points in the text (end exclusive), edits and wording. A null text counts
    as empty, a null id stays null, repeated rows stay repeated, and no match gives empty labels and the score 0.
    """

    def each(doc_id, text):
        rows = [scan(x, base, fuzzy) for x in text]
        return {"doc_id": doc_id} | {
            k: [r[k] for r in rows]
            for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")
        }

    return map_batches(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), f"doc_id bigint, {_COLUMNS}", each)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(load(spark, sf_dir, "documents"))
