"""Spelling variant grouping (operator 13): words one edit apart, by blocked Gram matrices of letter counts.

One inserted or deleted code point changes the letter counts of a word by a squared distance of one, a replaced one by
two. Words are put into blocks by their length and by how many of their letters fall into each of five fixed classes: an
edit leads to the same block or to one of a few next to it. Blocks are cut into tiles of about a thousand words, and
each pair of tiles that may hold near words is one product of two letter-count matrices, which gives all squared
distances; pairs at the distance an edit makes are then verified on their code points. No pair leaves the task: each word
keeps the number of its near words and the best of them.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import load, staged

MIN_LENGTH = 7
MIN_COUNT = 2
FORM_RATIO = 10
#: Words a tile holds on average, at most.
TILE_WORDS = 1024
#: Different words that a task counts before it hands them on.
HELD_WORDS = 300_000
#: Letters of the classes but for the last, which holds all others: the alphabet by frequency, dealt round.
CLASSES = ("enlfvz", "tscgk", "ahuyj", "ormpx")
_KINDS = len(CLASSES) + 1
#: Pairs verified at once, times their length.
_CHUNK = 1 << 22

_RUN = re.compile("[A-Za-zÀ-ÿ]+")


def text_words(doc_id: int | None, text: str | None) -> Counter:
    """The words of one whole text with their counts, long enough ones only.

    A run whose crc32 with the id (a null one is empty) is divisible by 31 loses one code point.
    """
    found: Counter = Counter()
    head = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
    lowered = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z only
    for run, n in Counter(_RUN.findall(lowered)).items():
        if len(run) >= MIN_LENGTH:
            h = zlib.crc32(run.encode(), head)
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
                if len(run) < MIN_LENGTH:
                    continue
            found[run] += n
    return found


def count_words(docs: DataFrame) -> DataFrame:
    """``word`` and ``n`` of all words over all texts that occur often enough. Repeated rows count again; null texts have no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for row in range(batch.num_rows):
                held.update(text_words(batch.column(0)[row].as_py(), batch.column(1)[row].as_py()))
                if len(held) >= HELD_WORDS:
                    yield out()
                    held = Counter()
        yield out()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def _cell(word: F.Column) -> F.Column:
    """Letters per class; they add up to the length."""
    length = F.length(word)
    counts = [length - F.length(F.translate(word, letters, "")) for letters in CLASSES]
    return F.array(*counts, length - sum(counts[1:], counts[0])).cast("array<int>")


def _steps() -> list[list[int]]:
    """What an edit adds to the letters per class, one of each pair of opposite steps: none, a replacement, an insertion."""
    unit = lambda *at: [sum(x for k, x in at if k == i) for i in range(_KINDS)]
    replaced = [unit((i, 1), (j, -1)) for i in range(_KINDS) for j in range(i + 1, _KINDS)]
    return [[0] * _KINDS, *replaced, *(unit((i, 1)) for i in range(_KINDS))]


def tile_pairs(words: DataFrame) -> DataFrame:
    """Rows ``a``, ``a_n``, ``b``, ``b_n``: the joined words of two tiles that may hold near words, and their counts.

    ``b`` is null where a tile meets itself. A word lies in one tile; a group is at most two tiles.
    """
    celled = words.select("word", "n", _cell(F.col("word")).alias("cell"))
    cells = staged(celled.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / TILE_WORDS).cast("int").alias("tiles")), "spelling-cells")
    tiles = (
        celled.join(cells, "cell")
        .groupBy("cell", "tiles", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int").alias("tile"))
        .agg(F.array_sort(F.collect_list(F.struct("word", "n"))).alias("w"))
        .select("cell", "tile", F.concat_ws("", F.col("w.word")).alias("words"), F.col("w.n").alias("counts"))
    )
    steps = F.array(*[F.array(*[F.lit(x) for x in step]) for step in _steps()])
    ahead = cells.select("cell", "tiles", F.explode(steps).alias("step")).select(
        F.col("cell").alias("one"), F.col("tiles").alias("one_tiles"), F.zip_with("cell", "step", lambda a, b: a + b).alias("other")
    ).join(cells.select(F.col("cell").alias("other"), F.col("tiles").alias("other_tiles")), "other")
    ways = ahead.select(F.col("one").alias("cell"), F.lit(0).alias("side"), "one", "other", F.col("one_tiles").alias("own"), F.col("other_tiles").alias("many"))
    ways = ways.unionByName(
        ahead.where("one != other").select(F.col("other").alias("cell"), F.lit(1).alias("side"), "one", "other", F.col("other_tiles").alias("own"), F.col("one_tiles").alias("many"))
    )
    # By tile, so that a block of many tiles is dealt over many tasks.
    ways = ways.withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("own") - 1)))
    met = tiles.join(ways, ["cell", "tile"]).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("many") - 1)))
    within = F.col("one") == F.col("other")
    first = F.when(within, F.least("tile", "with")).when(F.col("side") == 0, F.col("tile")).otherwise(F.col("with"))
    second = F.when(within, F.greatest("tile", "with")).when(F.col("side") == 0, F.col("with")).otherwise(F.col("tile"))
    side = F.when(within, (F.col("tile") > F.col("with")).cast("int")).otherwise(F.col("side"))
    keyed = met.select("one", "other", first.alias("i"), second.alias("j"), side.alias("side"), "words", "counts")
    at = lambda k, name: F.max(F.when(F.col("side") == k, F.col(name)))
    return keyed.groupBy("one", "other", "i", "j").agg(
        at(0, "words").alias("a"), at(0, "counts").alias("a_n"), at(1, "words").alias("b"), at(1, "counts").alias("b_n")
    ).select("a", "a_n", "b", "b_n")


def _matrix(joined: str, n: int) -> np.ndarray:
    return np.frombuffer(joined.encode("latin-1"), np.uint8).reshape(n, -1)


def _letter_counts(codes: np.ndarray, letters: np.ndarray) -> np.ndarray:
    place = np.zeros(256, np.int64)
    place[letters] = np.arange(len(letters))
    at = place[codes] + np.arange(len(codes))[:, None] * len(letters)
    kind = np.float32 if codes.shape[1] < 1000 else np.float64  # squares stay exact
    return np.bincount(at.ravel(), minlength=len(codes) * len(letters)).reshape(len(codes), -1).astype(kind)


def near_pairs(a: np.ndarray, b: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the words of two tiles (code matrices) that are one edit apart; ``b`` None: within one tile, each pair once."""
    within = b is None
    b = a if within else b
    if a.shape[1] > b.shape[1]:
        j, i = near_pairs(b, a)
        return i, j
    letters = np.unique(np.concatenate([a.ravel(), b.ravel()]))
    x, y = _letter_counts(a, letters), _letter_counts(b, letters)
    one = np.ones((max(len(x), len(y)), 1), x.dtype)
    squares = np.hstack([-2 * x, (x**2).sum(1)[:, None], one[: len(x)]]) @ np.hstack([y, one[: len(y)], (y**2).sum(1)[:, None]]).T
    wanted = 2 if a.shape[1] == b.shape[1] else 1
    i, j = np.nonzero(squares == wanted)
    if within:
        i, j = i[i < j], j[i < j]
    step = max(1, _CHUNK // a.shape[1])
    good = [_one_edit(a[i[s : s + step]], b[j[s : s + step]]) for s in range(0, len(i), step)]
    good = np.concatenate(good) if good else np.zeros(0, bool)
    return i[good], j[good]


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row: exactly one code point replaced, or one inserted into ``a``."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    length = a.shape[1]
    head, tail = a != b[:, :length], a != b[:, 1:]
    first = np.where(head.any(1), head.argmax(1), length)  # where the heads part
    last = np.where(tail.any(1), length - 1 - tail[:, ::-1].argmax(1), -1)  # the last place where the tails differ
    return last < first


def _best(i: np.ndarray, j: np.ndarray, words: np.ndarray, others: np.ndarray, counts: np.ndarray) -> dict[str, list]:
    """Per word ``i`` with near words ``j``: how many, the largest count, and the smallest word of that count."""
    rank = np.lexsort((j, -counts[j], i))  # tiles are sorted by word
    i, j = i[rank], j[rank]
    heads = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else np.zeros(0, np.int64)
    text = lambda codes: codes.tobytes().decode("latin-1")
    return {
        "word": [text(words[k]) for k in i[heads]], "n_near": np.diff(np.r_[heads, len(i)]).tolist(),
        "best_n": counts[j[heads]].tolist(), "best": [text(others[k]) for k in j[heads]],
    }


_NEAR = "word string, n_near bigint, best_n bigint, best string"


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``n_near``, ``best_n`` and ``best`` (most frequent near word, ties to the smallest) of words with near words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list] = {"word": [], "n_near": [], "best_n": [], "best": []}
            for row in range(batch.num_rows):
                a, a_n, b, b_n = (c[row] for c in batch.columns)
                n = a_n.values.to_numpy()
                codes = _matrix(a.as_py(), len(n))
                m, others = (n, codes) if not b.is_valid else (b_n.values.to_numpy(), None)
                if others is None:
                    others = _matrix(b.as_py(), len(m))
                i, j = near_pairs(codes, others if b.is_valid else None)
                if not len(i):
                    continue
                if b.is_valid:
                    sides = _best(i, j, codes, others, m), _best(j, i, others, codes, n)
                else:
                    sides = (_best(np.r_[i, j], np.r_[j, i], codes, codes, n),)
                for side in sides:
                    for name, values in side.items():
                        found[name] += values
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[k], pa.string() if k in ("word", "best") else pa.int64()) for k in found], names=list(found)
            )

    parts = tile_pairs(words).mapInArrow(run, _NEAR)
    top = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("best")))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), top.alias("top")).select(
        "word", "n_near", (-F.col("top.m")).alias("best_n"), F.col("top.best").alias("best")
    )


def follow_forms(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` from ``word`` and ``form``: the last word along the forms.

    Counts grow tenfold along a form, so that the way is short and has no circle; each round doubles the steps taken.
    """
    roots = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = staged(roots.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        roots = moved.select("word", "root")


def group_spellings(docs: DataFrame) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of all words of ``docs``.

    Only ``doc_id`` and ``text`` are read; no documents or no words give no rows.
    """
    words = staged(count_words(docs), "spelling-words")
    near = near_words(words)
    formed = F.col("best_n") >= FORM_RATIO * F.col("n")
    found = staged(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = follow_forms(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_spellings(load(spark, sf_dir, "documents"))
