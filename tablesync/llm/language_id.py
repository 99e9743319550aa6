"""Language ID (operator 6): interpolated Kneser-Ney character models, one per language.

Texts are lower-cased, runs of anything but letters become one space, and windows of four characters are counted
per language over every text that may teach. A model keeps, per order, sorted arrays of n-gram keys with their
discounted probability and back-off weight; a text goes to the language with the least cross-entropy per character.
Rejection is calibrated on all labelled texts: a text whose cross-entropy lies far above what texts of its language
and length have is not in any language known.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import broadcast_object, load, map_batches, staged

ORDER = 4
#: A code point has 16 bits of a key; those beyond the basic plane share the codes of its private use area.
_BITS = 16
#: Share of the counts of a language and order from which on a model keeps an n-gram, the same at every size; all n-grams
#: are counted and estimated, and the probability of those not kept goes to the shorter context.
LEAST_SHARE = 2e-7
#: Share of the labelled texts told right that may lie beyond the limit of rejection.
FALSE_REJECTION = 0.001
#: Standard deviations above the mean of its language and length at which a text is rejected, where too few texts are
#: labelled to tell that share.
REJECT_SIGMAS = 8.0
#: Labelled texts that a mean and deviation are taken from at least; a thinner length is joined with its neighbours.
CELL_ROWS = 30
#: Lengths are told apart by their log2, up to this one.
LENGTHS = 25
#: Texts that are scored at once: their windows are held as numbers together. The pipeline, whose workers go on to other
#: stages, takes fewer, for a tenth more time.
SLICE_ROWS, STAGE_ROWS = 1000, 250
_OTHER = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")


def characters(text: str) -> np.ndarray:
    """Codes of a normalised text with a space at either end."""
    plain = f" {_OTHER.sub(' ', text.lower()).strip()} "
    codes = np.frombuffer(plain.encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    return np.where(codes > 0xFFFF, 0xE000 + codes % 0x1900, codes).astype(np.uint64)


def windows(codes: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Keys of the windows that end at each character from the second on; short ones are padded with spaces."""
    padded = np.concatenate([np.full(order - 2, 32, np.uint64), codes])
    n = len(codes) - 1
    keys = np.zeros(n, np.uint64)
    for j in range(order):
        keys = (keys << np.uint64(_BITS)) | padded[j : j + n]
    return keys


def count_windows(docs: DataFrame) -> DataFrame:
    """``lang, gram, n`` over all rows of ``docs`` (``lang``, ``text``); each task sums before it sends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        waiting: dict[str, list[np.ndarray]] = {}
        held = 0

        def settle():
            for lang, arrays in waiting.items():
                keys, n = np.unique(np.concatenate(arrays), return_counts=True)
                if lang in totals:
                    both = np.concatenate([totals[lang][0], keys])
                    weights = np.concatenate([totals[lang][1], n])
                    keys, where = np.unique(both, return_inverse=True)
                    n = np.bincount(where, weights, len(keys)).astype(np.int64)
                totals[lang] = keys, n
            waiting.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys = windows(characters(text.as_py()))
                waiting.setdefault(lang, []).append(keys)
                held += len(keys)
                if held > 2_000_000:
                    settle()
                    held = 0
        settle()
        for lang, (keys, n) in totals.items():
            for i in range(0, len(keys), 100_000):
                part = keys[i : i + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part)), pa.array(part.view(np.int64)), pa.array(n[i : i + 100_000])],
                    names=["lang", "gram", "n"],
                )

    usable = docs.select("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL")
    return usable.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Model:
    """Per order 1..n: sorted ``keys``, ``value`` (discounted probability) and ``weight`` (mass left to the shorter
    context) of the context ``keys`` of one character less, both as sorted arrays."""

    keys: list[np.ndarray]
    value: list[np.ndarray]
    contexts: list[np.ndarray]
    weight: list[np.ndarray]
    floor: float

    def log2(self, grams: np.ndarray) -> np.ndarray:
        """log2 of the probability of the last character of each window, after the others."""
        p = np.full(len(grams), self.floor)
        for order, (keys, value, contexts, weight) in enumerate(zip(self.keys, self.value, self.contexts, self.weight), 1):
            gram = grams & np.uint64((1 << (_BITS * order)) - 1)
            p = _look_up(keys, value, gram, 0.0) + _look_up(contexts, weight, gram >> np.uint64(_BITS), 1.0) * p
        return np.log2(p)


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), default)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], default)


def kneser_ney(grams: np.ndarray, counts: np.ndarray, order: int = ORDER) -> Model:
    """Interpolated Kneser-Ney with one discount per order; shorter orders count the distinct characters before."""
    levels = []
    keys, n = grams, counts.astype(float)
    for o in range(order, 0, -1):
        _, where = np.unique(keys >> np.uint64(_BITS), return_inverse=True)
        levels.append((keys, n, np.bincount(where, n)[where], _discount((n == 1).sum(), (n == 2).sum())))
        keys, n = np.unique(keys & np.uint64((1 << (_BITS * (o - 1))) - 1), return_counts=True)
        n = n.astype(float)
    return _model(levels)


def _discount(ones: int, twos: int) -> float:
    return float(ones / (ones + 2 * twos)) if ones and twos else 0.5


def _model(levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, float]]) -> Model:
    """From the longest order to 1: keys, their counts, those of all keys of their context, and the discount.

    Where keys of a context are not given, their probability goes to the shorter context as the discounts do."""
    parts = [[], [], [], []]
    for keys, n, total, discount in reversed(levels):
        at = np.argsort(keys)
        keys, value = keys[at], ((n - discount) / total)[at]
        contexts, where = np.unique(keys >> np.uint64(_BITS), return_inverse=True)
        weight = np.maximum(1 - np.bincount(where, value, len(contexts)), 0) if len(keys) else np.zeros(0)
        for part, x in zip(parts, (keys, value, contexts, weight)):
            part.append(x)
    return Model(*parts, floor=1 / 0x10000)


def count_levels(counts: DataFrame) -> DataFrame:
    """``lang, o, gram, n, total``: the counts of all orders and those of each gram's context, from ``lang, gram, n``.

    Shorter orders count the distinct characters before; all orders are aggregated at once.
    """
    mask = lambda o: F.lit((1 << (_BITS * o)) - 1 if o < ORDER else -1).cast("bigint")
    shorter = F.array(*[
        F.struct(F.lit(o).alias("o"), F.col("gram").bitwiseAND(mask(o)).alias("gram"), F.col("gram").bitwiseAND(mask(o + 1)).alias("longer"))
        for o in range(1, ORDER)
    ])
    met = counts.select("lang", F.explode(shorter).alias("x")).select("lang", "x.*").distinct()
    every = counts.select("lang", F.lit(ORDER).alias("o"), "gram", "n").unionByName(
        met.groupBy("lang", "o", "gram").agg(F.count(F.lit(1)).alias("n"))
    ).withColumn("context", F.shiftrightunsigned("gram", _BITS))
    totals = every.groupBy("lang", "o", "context").agg(F.sum("n").alias("total"))
    return every.join(totals, ["lang", "o", "context"]).select("lang", "o", "gram", "n", "total")


def estimate(counts: DataFrame, least_share: float = LEAST_SHARE) -> dict[str, Model]:
    """The model of each language of ``counts`` (``lang, gram, n``): counts, totals and discounts over all n-grams, in Spark."""
    levels = staged(count_levels(counts), "language-levels", few=True)
    ladder = levels.groupBy("lang", "o").agg(
        F.sum("n").alias("all"), F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos")
    ).collect()  # one row a language and order
    if not ladder:
        return {}
    langs = sorted({r["lang"] for r in ladder})
    known = counts.sparkSession.createDataFrame(
        [(r["lang"], r["o"], langs.index(r["lang"]), float(r["all"] * least_share)) for r in ladder], "lang string, o int, k int, least double"
    )
    # At most 1 / least_share n-grams of a language and order come back: their shares add up to one.
    rows = levels.join(F.broadcast(known), ["lang", "o"]).where(F.col("n") >= F.col("least")).select("k", "o", "gram", "n", "total").toArrow()
    k, o, grams, n, totals = (rows.column(name).to_numpy() for name in rows.column_names)
    discount = {(r["lang"], r["o"]): _discount(r["ones"], r["twos"]) for r in ladder}
    found = {}
    for i, lang in enumerate(langs):
        parts = []
        for order in range(ORDER, 0, -1):
            at = (k == i) & (o == order)
            parts.append((grams[at].view(np.uint64), n[at].astype(float), totals[at].astype(float), discount[lang, order]))
        found[lang] = _model(parts)
    return found


@dataclass(frozen=True)
class Models:
    langs: list[str]
    models: list[Model]
    #: language x log2 of the number of windows: mean and deviation of the cross-entropy; NaN for a language without texts.
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    #: Deviations above the mean beyond which a text is rejected.
    limit: float = REJECT_SIGMAS

    def score(self, texts: list[str | None], rows: int = SLICE_ROWS) -> dict[str, list]:
        """For each text: best language or ``und``, posterior of it, cross-entropy per character, and ``rejected``.

        The distinct windows of a slice of texts are looked up once for all of them. Equal cross-entropies go to the first
        language.
        """
        if len(texts) > rows:
            parts = [self.score(texts[i : i + rows], rows) for i in range(0, len(texts), rows)]
            return {name: [x for part in parts for x in part[name]] for name in parts[0]}
        known = [bool(t and _LETTER.search(t)) for t in texts]
        parts = [windows(characters(t)) for t, ok in zip(texts, known) if ok]
        sizes = np.array([len(p) for p in parts], np.int64)
        out = {"lang_pred": ["und"] * len(texts), "score": [0.0] * len(texts), "entropy": [None] * len(texts), "rejected": [True] * len(texts), "n_windows": [0] * len(texts)}
        if not parts or not self.langs:
            return out
        every = np.concatenate(parts)
        grams = np.unique(every)
        where = np.searchsorted(grams, every)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        entropy = np.stack([-np.add.reduceat(m.log2(grams)[where], starts) / sizes for m in self.models], 1)
        best = entropy.argmin(1)
        # Windows overlap, so that the evidence of a text is worth about a quarter of its characters.
        weight = np.exp2(-(entropy - entropy.min(1, keepdims=True)) * sizes[:, None] / ORDER)
        posterior = 1 / weight.sum(1)
        least = entropy.min(1)
        rejected = np.zeros(len(parts), bool)
        if self.mean is not None:
            size = np.minimum(np.log2(sizes).astype(int), self.mean.shape[1] - 1)
            mean, spread = self.mean[best, size], self.spread[best, size]
            rejected = least > mean + self.limit * spread  # false where nothing is known
        for k, i in enumerate(j for j, ok in enumerate(known) if ok):
            out["lang_pred"][i] = self.langs[best[k]]
            out["score"][i] = float(posterior[k])
            out["entropy"][i] = float(least[k])
            out["rejected"][i] = bool(rejected[k])
            out["n_windows"][i] = int(sizes[k])
        return out


SCORE_SCHEMA = "doc_id bigint, lang_pred string, score double, entropy double, rejected boolean"


def fit_models(docs: DataFrame, least_share: float = LEAST_SHARE, slice_rows: int = SLICE_ROWS) -> Models:
    """Learn from ``lang`` and ``text`` of all rows of ``docs``; null languages and texts teach nothing."""
    teach = docs.select(F.col("doc_id").cast("bigint"), "lang", "text").where("lang IS NOT NULL AND text IS NOT NULL")
    # Counted by halves: a text is measured by models that have not learned from it or its copies.
    half = F.pmod(F.xxhash64("text"), F.lit(2)).cast("string")
    counts = staged(count_windows(teach.select(F.concat(half, "lang").alias("lang"), "text")), "language-halves", few=True)
    # The whole is their sum; all three are estimated together.
    whole = counts.groupBy(F.expr("'2' || substr(lang, 2)").alias("lang"), "gram").agg(F.sum("n").alias("n"))
    halves = estimate(counts.unionByName(whole), least_share)
    langs = sorted(lang[1:] for lang in halves if lang[0] == "2")
    if not langs:
        return Models([], [])
    models = [halves["2" + lang] for lang in langs]
    size = F.least(F.floor(F.log2("n_windows")), F.lit(LENGTHS - 1)).cast("int")
    measured = []
    for k, other in ("01", "10"):
        known = sorted(lang[1:] for lang in halves if lang[0] == other)
        measured.append(score_languages(teach.where(half == k), Models(known, [halves[other + lang] for lang in known]), "lang", slice_rows))
    told = staged(measured[0].union(measured[1]).where("lang = lang_pred").select("lang", size.alias("size"), "entropy"), "language-told")
    cells = told.groupBy("lang", "size").agg(
        F.count("*").alias("rows"), F.avg("entropy").alias("mean"), F.var_pop("entropy").alias("variance")
    ).toPandas()
    rows, first, second = (np.zeros((len(langs), LENGTHS)) for _ in range(3))
    for r in cells.itertuples():
        cell = langs.index(r.lang), int(r.size)
        rows[cell], first[cell], second[cell] = r.rows, r.rows * r.mean, r.rows * (r.variance + r.mean**2)
    mean, spread = backed_off(rows, first, second)
    limit = REJECT_SIGMAS
    if rows.sum() >= 1 / FALSE_REJECTION:
        known = told.sparkSession.createDataFrame(
            [(lang, k, float(mean[n, k]), float(spread[n, k])) for n, lang in enumerate(langs) for k in range(LENGTHS)],
            "lang string, size int, mean double, spread double",
        )
        far = told.join(F.broadcast(known), ["lang", "size"])  # 25 rows a language
        limit = float(far.agg(F.percentile_approx((F.col("entropy") - F.col("mean")) / F.col("spread"), 1 - FALSE_REJECTION, F.lit(100_000))).first()[0])
    return Models(langs, models, mean, spread, limit)


def backed_off(rows: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation per language and length from counts, sums and sums of squares.

    A length of fewer than :data:`CELL_ROWS` texts takes in as many lengths on either side as it needs, at last all."""
    mean, spread = np.full(rows.shape, np.nan), np.zeros(rows.shape)
    for lang, k in np.ndindex(*rows.shape):
        for reach in range(rows.shape[1]):
            near = slice(max(0, k - reach), k + reach + 1)
            n = rows[lang, near].sum()
            if n >= min(CELL_ROWS, max(1, rows[lang].sum())):
                m = first[lang, near].sum() / n
                mean[lang, k], spread[lang, k] = m, max(np.sqrt(max(second[lang, near].sum() / n - m * m, 0.0)), 0.05)
                break
    return mean, spread


def score_languages(docs: DataFrame, models: Models, extra: str | None = None, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """:data:`SCORE_SCHEMA` per row of ``docs`` (``doc_id``, ``text``), with ``n_windows`` and the column ``extra`` if named.

    ``und``, score 0 and rejected for a null text or one without a letter. Null ids stay null, repeated rows repeated.
    """
    shared = broadcast_object(docs.sparkSession, models)  # bounded by 1 / LEAST_SHARE n-grams a language and order

    def each(doc_id, text, **more):
        found = shared().score(text, slice_rows)
        return {"doc_id": doc_id} | found | more

    columns = [F.col("doc_id").cast("bigint"), F.col("text").cast("string"), *([extra] if extra else [])]
    schema = SCORE_SCHEMA + ", n_windows bigint" + (f", {extra} string" if extra else "")
    return map_batches(docs.select(*columns), schema, each)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_on_rest(docs: DataFrame, slice_rows: int = SLICE_ROWS) -> Models:
    """The models of every row that is not held out; rows without an id do not teach."""
    return fit_models(docs.where("doc_id IS NOT NULL").where(~held_out(F.col("doc_id"))), slice_rows=slice_rows)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    scored = score_languages(docs, fit_on_rest(docs))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "entropy", "rejected")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of ``docs`` whose language is known and that are not rejected, with all their columns.

    The models learn from these documents themselves. Learning needs the labels of ``lang``; without any, no text is known
    and none is kept.
    """
    models = broadcast_object(spark, fit_on_rest(docs, STAGE_ROWS))

    @F.pandas_udf("boolean")
    def known(text):
        import pandas as pd

        rejected: list[bool] = []
        for i in range(0, len(text), STAGE_ROWS):
            rejected += models().score([None if t is None else str(t) for t in text.iloc[i : i + STAGE_ROWS]])["rejected"]
        return pd.Series([not r for r in rejected], dtype=bool)

    return docs.where(known(F.col("text").cast("string")))
