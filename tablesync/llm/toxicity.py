"""Toxicity (operator 12): how much better a window of text compresses with what toxic text adds to ordinary text.

Two zstandard dictionaries are trained on labelled texts. The ordinary one holds what the trainer keeps of the words of
ordinary texts. The toxic one holds the windows that are significantly more frequent in toxic texts, laid over the same
ordinary content, so that the compressed lengths of a window differ by what toxic text adds and by nothing else. Each
text is cut into windows of ten words that overlap by two; the gains of its windows, against a ladder of thresholds,
are calibrated into a probability by weighted logistic regression on texts the dictionaries have not seen.

Frequency counts distinct contexts (the words on both sides), so that copies of a text count once.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import bounded_sample, broadcast_object, load, map_batches, staged

#: Labelled texts to learn from, at most (about; a hash of the id picks them): toxic and ordinary ones.
SAMPLE_TOXIC = 5_000
SAMPLE_ORDINARY = 10_000
#: Bytes of the two dictionaries, and the words that the trainer of the ordinary one is given (most frequent first).
TOXIC_BYTES = 16 << 10
ORDINARY_BYTES = 110 << 10
ORDINARY_WORDS = 40_000
#: A word is toxic from this G statistic of its contexts (chance: about one word in fifty thousand) and this ratio of rates on.
SIGNIFICANT = 18.0
RATIO = 4.0
LEVEL = 9
WINDOW, STEP = 10, 8
GAINS = (1, 2, 3, 4, 5, 6)
FEATURES = 2 + 2 * len(GAINS)
THRESHOLD = 0.3

#: The compressor begins no match in the last eight bytes.
_PAD = " " * 9

_WORD = re.compile(r"[^\W_]{1,64}")


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits of a whole text, cut at 64 characters."""
    return _WORD.findall((text or "").lower())


@dataclass(frozen=True)
class Dictionaries:
    ordinary: bytes
    toxic: bytes

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        def one(content: bytes) -> zstandard.ZstdCompressor:
            if len(content) < 8:  # too short to be a dictionary: none
                return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_dict_id=False, write_content_size=False)

        return one(self.ordinary), one(self.toxic)


def train(ordinary: Sequence[tuple[str, int]], toxic: Sequence[str]) -> Dictionaries:
    """Dictionaries from ordinary words with their counts and from toxic words, the most telling first.

    Too few words to train on are taken as they are.
    """
    samples = [f" {word}".encode("utf-8", "surrogatepass") for word, n in ordinary for _ in range(min(n, 50))]
    # The trainer picks from one stretch of samples after another: mixed, each stretch is like the whole.
    mixed = [samples[i] for i in np.random.default_rng(1).permutation(len(samples))]
    try:
        content = zstandard.train_dictionary(ORDINARY_BYTES, mixed).as_bytes()
    except (zstandard.ZstdError, ValueError):
        content = b"".join(dict.fromkeys(reversed(samples)))[-ORDINARY_BYTES:]
    added = b"".join(f" {word}".encode("utf-8", "surrogatepass") for word in reversed(toxic))[-TOXIC_BYTES:]
    return Dictionaries(content, added + b" " + content if added else content)


def window_gains(text: str | None, compressors: tuple) -> np.ndarray:
    """Bytes that the toxic dictionary saves against the ordinary one, per window of the whole text."""
    ordinary, toxic = compressors
    words = words_of(text)
    out = []
    last = max(0, len(words) - WINDOW)  # a text ends with a whole window: short ones hardly compress
    for start in range(0, last + STEP if words else 0, STEP):
        start = min(start, last)
        window = f" {' '.join(words[start : start + WINDOW])}{_PAD}".encode("utf-8", "surrogatepass")
        out.append(len(ordinary.compress(window)) - len(toxic.compress(window)))
    return np.array(out, np.int64)


def gain_features(gains: np.ndarray) -> list[float]:
    """Size of the text, its largest gain, and per threshold how many windows reach it, plainly and against the size."""
    n = max(len(gains), 1)
    reached = [int((gains >= g).sum()) for g in GAINS]
    return [float(np.log(n)), float(max(gains.max(initial=0), 0))] + [f for k in reached for f in (float(np.log1p(k)), k / n**0.5)]


@dataclass(frozen=True)
class Calibration:
    """Logistic regression over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.hstack([np.ones((len(x), 1)), (x - self.mean) / self.scale]) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Calibration:
    """Weighted, ridge-penalised logistic regression by Newton steps. With no rows, or one class, a constant."""
    if len(x) == 0 or y.min() == y.max():
        rate = (float(y @ weight) + 0.1) / (float(weight.sum()) + 1) if len(x) else 0.1
        return Calibration(np.zeros(FEATURES), np.ones(FEATURES), np.r_[np.log(rate / (1 - rate)), np.zeros(FEATURES)])
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.hstack([np.ones((len(x), 1)), (x - mean) / scale])
    ridge = np.eye(z.shape[1])
    ridge[0, 0] = 1e-6
    w = np.zeros(z.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (y - p)) - ridge @ w
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + ridge, slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return Calibration(mean, scale, w)


@dataclass(frozen=True)
class ToxicityModel:
    dictionaries: Dictionaries
    calibration: Calibration


def learns_from(doc_id: F.Column) -> F.Column:
    """Rows that may teach: crc32 of the id as text, modulo 4, is not 2. A null id may not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def _contexts(text: list, toxic: list, half: list) -> dict[str, object]:
    found = set()
    for one, label, part in zip(text, toxic, half):
        words = words_of(one)
        around = ["", *words, ""]
        found.update((part, label, w, xxhash.xxh3_64_intdigest(f"{a} {b}".encode("utf-8", "surrogatepass")) >> 1)
                     for a, w, b in zip(around, words, around[2:]))
    rows = list(zip(*found)) or [[], [], [], []]
    return {"half": rows[0], "toxic": rows[1], "word": [w.encode("utf-8", "surrogatepass").decode("utf-8", "replace") for w in rows[2]],
            "context": rows[3]}


def learn_dictionaries(counts: DataFrame, halves: Sequence[int]) -> Dictionaries:
    """Dictionaries from the context counts (half, toxic, word, n) of some halves of the sample."""
    both = counts.where(F.col("half").isin(list(halves))).groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b"),
    )
    total = both.agg(F.sum("a"), F.sum("b")).first()
    n1, n0 = float(total[0] or 0), float(total[1] or 0)
    if not n1 or not n0:
        telling = []
    else:
        expected = f"(a + b) * {n1 / (n1 + n0)!r}D"
        scored = both.selectExpr(
            "word", "a", "b",
            f"2 * (CASE WHEN a > 0 THEN a * ln(a / ({expected})) ELSE 0 END"
            f" + CASE WHEN b > 0 THEN b * ln(b / (a + b - {expected})) ELSE 0 END) AS g",
        ).where(f"g >= {SIGNIFICANT} AND a * {n0!r}D >= {RATIO} * b * {n1!r}D")
        # A word takes two bytes at least.
        telling = [r["word"] for r in scored.orderBy(F.desc("g"), "word").limit(TOXIC_BYTES // 2).collect()]
    known = set(telling)
    top = both.where("b > 1").orderBy(F.desc("b"), "word").limit(ORDINARY_WORDS).select("word", "b").collect()
    return train([(r["word"], r["b"]) for r in top if r["word"] not in known], telling)


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Fit on bounded samples of the labelled texts that may teach.

    Labels other than 0 and 1 teach nothing; an id with both counts as toxic. Null texts are empty. With labels of one
    kind only, every text gets the share of the toxic ones.
    """
    spark = docs.sparkSession
    marked = labels.select(F.col("doc_id").cast("bigint"), F.col("toxic").cast("int"))
    marked = marked.where(learns_from(F.col("doc_id")) & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = staged(marked, "toxicity-labels")
    held = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    picked = bounded_sample(marked.where("toxic = 1"), "doc_id", SAMPLE_TOXIC).unionByName(
        bounded_sample(marked.where("toxic = 0"), "doc_id", SAMPLE_ORDINARY)
    )
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Copies of a text share a half, so that a half is scored by texts it has not seen.
    sample = staged(
        texts.join(F.broadcast(picked), "doc_id").select("text", "toxic", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("half")),
        "toxicity-sample",
    )
    contexts = map_batches(sample, "half int, toxic int, word string, context bigint", _contexts).distinct()
    counts = staged(contexts.groupBy("half", "toxic", "word").agg(F.count(F.lit(1)).alias("n")), "toxicity-words")
    crossed = broadcast_object(spark, {half: learn_dictionaries(counts, [1 - half]) for half in (0, 1)})

    def each(text: list, toxic: list, half: list) -> dict[str, object]:
        by_half = {k: d.compressors() for k, d in crossed().items()}
        return {"toxic": toxic, "x": [gain_features(window_gains(t, by_half[h])) for t, h in zip(text, half)]}

    rows = map_batches(sample, "toxic int, x array<double>", each).collect()
    rows.sort(key=lambda r: (r["toxic"], r["x"]))
    y = np.array([r["toxic"] for r in rows], float)
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), FEATURES)
    # Each kind weighs as much as it does among all labelled rows.
    share = {k: held.get(k, 0) / max((y == k).sum(), 1) for k in (0, 1)}
    weight = np.where(y == 1, share[1], share[0])
    weight = weight * (len(weight) / weight.sum()) if len(weight) else weight
    return ToxicityModel(learn_dictionaries(counts, [0, 1]), calibrate(x, y, weight))


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` and ``max_gain`` (bytes) per row of ``docs``.

    Null texts are empty; a text without letters and digits has no window and gets the score of an empty one. Equal texts
    get equal scores. Other columns are not read; a null id is not held out.
    """
    sent = broadcast_object(docs.sparkSession, model)

    def each(doc_id: list, text: list) -> dict[str, object]:
        model = sent()
        compressors = model.dictionaries.compressors()
        x = np.array([gain_features(window_gains(t, compressors)) for t in text], float).reshape(len(text), FEATURES)
        score = model.calibration.score(x)
        return {"doc_id": doc_id, "score": score, "predicted": (score >= THRESHOLD).astype(np.int32), "max_gain": x[:, 1].astype(np.int64)}

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = map_batches(rows, "doc_id bigint, score double, predicted int, max_gain bigint", each)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", "max_gain")


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, load(spark, sf_dir, "labels")))
