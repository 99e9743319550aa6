"""Best-fit packing (operator 10): token pieces into sequences of a fixed length by bin completion.

Texts are tokenised in the tasks that read them; from then on only piece lengths move. Pieces are dealt by a hash
into blocks of a bounded number, each packed on its own: the largest piece left opens a sequence, a branch and bound over
the lengths left enumerates the fillings of its gap that no other dominates, a best-fit filling being the first
incumbent, bounded by the sums that the lengths left can reach, until the waste cannot shrink. A block wastes at most about one sequence more than one pack of
everything would.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from bisect import bisect_right
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.llm.common import load, map_batches, staged, worker_state

TOKENS = 4096
END_ID = 1
#: Pieces per block: bounds what a task holds.
BLOCK_PIECES = 8192
#: Words whose ids a worker keeps.
KEPT_WORDS = 800_000

# What the tokenizer file makes of a text before its merges: lower case, white space dropped, these pieces apart. The plain
# form gives the same where there are no numbers but digits and none of the controls that only Python takes for space.
_PIECES = regex.compile(r"\p{L}+|'(?:s|t|re|ve|m|ll|d)|\p{N}|[^\s\p{L}\p{N}]+")
_PLAIN_PIECES = re.compile(r"[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)|\d|(?:[^\w\s]|_)+")
_CONTROLS = re.compile(r"[\x1c-\x1f]")
_NOT_PLAIN = regex.compile(r"[\p{Nl}\p{No}\x1c-\x1f]")


class WordTokenizer:
    """Ids of whole texts through a cache of the ids of their words, which the merges never cross."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = False
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        # Tokens that end a piece; a vocabulary without such a mark has none, and words are then encoded apart.
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.words: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split, plain = [], []
        for text in texts:
            whole = any(x in text for x in self.special)
            plain.append(not whole)
            split.append([] if whole else pieces_of(self.lower(unicodedata.normalize("NFC", text))))
        if len(self.words) > KEPT_WORDS:
            self.words = {}
        known = self.words
        missing = sorted(set(chain.from_iterable(split)) - known.keys())
        for i in range(0, len(missing), 5000):
            part = missing[i : i + 5000]
            known.update(zip(part, self.word_ids(part)))
        get = known.__getitem__
        return [
            b"".join(map(get, words)) if ok else np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            for words, ok, text in zip(split, plain, texts)
        ]

    def word_ids(self, words: list[str]) -> list[bytes]:
        """The ids of each word: all words as one text, which is cut behind the tokens that end a piece."""
        whole = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0]
        ids = np.array(whole.ids, "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words) or (len(ends) and ends[-1] != len(ids)):  # a word that is not one piece alone
            return [np.array(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch(words, add_special_tokens=False)]
        data, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    @staticmethod
    def lower(text: str) -> str:
        # The tokenizer lowers character by character; Python knows a final sigma, which depends on its neighbours.
        return text.lower() if "Σ" not in text else "".join(map(str.lower, text))


def pieces_of(text: str) -> list[str]:
    plain = not (_CONTROLS.search(text) if text.isascii() else _NOT_PLAIN.search(text))
    return (_PLAIN_PIECES if plain else _PIECES).findall(text)


def tokenizer_at(path: str) -> WordTokenizer:
    state = worker_state()
    if ("tokenizer", path) not in state:
        state["tokenizer", path] = WordTokenizer(path)
    return state["tokenizer", path]


def pieces(docs: DataFrame, path: str, tokens: int = TOKENS, end_id: int = END_ID) -> DataFrame:
    """``doc_id, row, piece, start, length, ids_crc32`` of every piece; only texts over ``tokens`` ids are cut.

    A null text counts as empty: its one piece is ``end_id``. ``row`` tells rows with the same id apart.
    """
    end = np.array([end_id], "<u4").tobytes()

    def each(doc_id, row, text):
        out = {k: [] for k in ("doc_id", "row", "piece", "start", "length", "ids_crc32")}
        for i, r, data in zip(doc_id, row, tokenizer_at(path).encode([x or "" for x in text])):
            data += end
            for piece, at in enumerate(range(0, len(data), 4 * tokens)):
                part = data[at : at + 4 * tokens]
                for k, v in zip(out, (i, r, piece, at // 4, len(part) // 4, zlib.crc32(part))):
                    out[k].append(v)
        return out

    source = docs.select(F.col("doc_id").cast("bigint"), F.monotonically_increasing_id().alias("row"), F.col("text").cast("string"))
    return map_batches(source, "doc_id bigint, row bigint, piece int, start bigint, length bigint, ids_crc32 bigint", each)


class _Left:
    """How many pieces of each length are left."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.count = np.bincount(lengths, minlength=capacity + 1).tolist()
        self.sizes = [i for i, n in enumerate(self.count) if n and i]  # lengths that are left, ascending

    def take(self, size: int) -> None:
        self.count[size] -= 1
        if not self.count[size]:
            del self.sizes[bisect_right(self.sizes, size) - 1]

    def largest_within(self, gap: int) -> int:
        at = bisect_right(self.sizes, gap)
        return self.sizes[at - 1] if at else 0


def best_fit(left: _Left, gap: int) -> list[int]:
    """The largest length that fits, again and again."""
    filling: list[int] = []
    used: dict[int, int] = {}
    while size := left.largest_within(gap):
        while size and left.count[size] <= used.get(size, 0):
            at = bisect_right(left.sizes, size - 1)
            size = left.sizes[at - 1] if at else 0
        if not size:
            break
        used[size] = used.get(size, 0) + 1
        filling.append(size)
        gap -= size
    return filling


def complete(left: _Left, gap: int) -> list[int]:
    """The lengths that fill a gap with the least waste, by branch and bound.

    Fillings are enumerated in descending lengths, as many of each as can be first. The sums that the lengths below can
    reach, as bit sets, bound each branch: the waste of the best filling is known from all of them, and a branch from which
    it cannot be reached is not followed, so that the search ends without going back. A filling of the least waste is
    dominated by none. The best-fit filling is the first incumbent.
    """
    best = best_fit(left, gap)
    if sum(best) == gap:
        return best
    room = (1 << (gap + 1)) - 1
    sizes = left.sizes[: bisect_right(left.sizes, gap)]
    reach = [1]  # bit s: some of the lengths so far add up to s
    for size in sizes:
        sums, copies, step = reach[-1], min(left.count[size], gap // size), 1
        while copies:  # binary parts of the number of copies reach every number of them
            step = min(step, copies)
            sums |= (sums << (size * step)) & room
            copies -= step
            step *= 2
        reach.append(sums)
    goal = reach[-1].bit_length() - 1
    if goal == sum(best):
        return best
    filling: list[int] = []
    for below, size in zip(reach[-2::-1], sizes[::-1]):
        copies = min(left.count[size], goal // size)
        while not below >> (goal - copies * size) & 1:
            copies -= 1
        filling += [size] * copies
        goal -= copies * size
    return filling


def pack(lengths: np.ndarray, capacity: int = TOKENS) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; lengths are 1 to ``capacity``."""
    order = np.argsort(-lengths, kind="stable")
    queues: dict[int, list[int]] = {}
    for i in order[::-1].tolist():
        queues.setdefault(int(lengths[i]), []).append(i)
    left = _Left(lengths, capacity)
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    number = 0
    while left.sizes:
        filling = [left.sizes[-1]]
        left.take(filling[0])
        if filling[0] < capacity:
            filling += complete(left, capacity - filling[0])
            for size in filling[1:]:
                left.take(size)
        at = 0
        for size in filling:
            i = queues[size].pop()
            sequence[i], offset[i] = number, at
            at += size
        number += 1
    return sequence, offset


def pack_pieces(parts: DataFrame, capacity: int = TOKENS, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """Place every piece: ``sequence_id`` and ``offset``. ``parts`` must be stored (it is counted first)."""
    blocks = max(1, -(-parts.count() // block_pieces))
    order = ["doc_id", "row", "piece"]

    def each(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order, kind="stable", ignore_index=True)
        sequence, offset = pack(rows["length"].to_numpy(np.int64), capacity)
        return rows.assign(sequence_id=rows["block"].to_numpy(np.int64) * (1 << 32) + sequence, offset=offset)

    block = F.pmod(F.xxhash64("doc_id", "row", "piece"), F.lit(blocks))
    more = [T.StructField(name, T.LongType()) for name in ("block", "sequence_id", "offset")]
    schema = T.StructType([*parts.schema.fields, *more])
    return parts.withColumn("block", block).groupBy("block").applyInPandas(each, schema)


def pack_documents(docs: DataFrame, path: str | None = None, tokens: int = TOKENS) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for all rows of ``docs``.

    Every row is packed, also those with a null or repeated id; a null or empty text is the end id alone. Equal lengths are
    interchangeable, so ties are broken by id. An empty table gives no rows.
    """
    parts = staged(pieces(docs, path or public_tokenizers.path("word_bpe_49k.json"), tokens), "packing")
    return pack_pieces(parts, tokens).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(load(spark, sf_dir, "documents"))
