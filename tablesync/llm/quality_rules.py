"""Quality rules (operator 3): a decision list learned by sequential covering, applied as Spark expressions.

The list is learned from statistics of labelled texts: a rule is grown condition by condition on two thirds of
the sample (information gain of the covered bad rows), pruned from its end on the other third, kept if it is precise
there, and the rows it covers are set aside before the next rule. What remains is plain: ordered ``CASE WHEN``
branches over named ratios, each with the precision it had on the rows it was pruned on.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import bounded_sample, load, map_batches, staged
from tablesync.llm.stats import COUNT_SCHEMA, FEATURES, count_batch

#: Labelled rows that a list is learned from, at most (about; a hash of the id picks them).
SAMPLE_ROWS = 20_000
#: Thresholds tried per statistic.
CUTS = 64
MAX_RULES = 12
MAX_CONDITIONS = 4
#: A rule must be right on this share of the rows that it covers in the pruning part, and cover this many.
MIN_PRECISION = 0.9
MIN_COVER = 10


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > F.lit(self.cut) if self.above else value <= F.lit(self.cut)


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    precision: float

    def __str__(self) -> str:
        return " AND ".join(f"{c.feature} {'>' if c.above else '<='} {c.cut:g}" for c in self.conditions)


def _covers(conditions, values: dict[str, np.ndarray], n: int) -> np.ndarray:
    covered = np.ones(n, bool)
    for c in conditions:
        covered &= values[c.feature] > c.cut if c.above else values[c.feature] <= c.cut
    return covered


def _best_condition(values, bad, covered, cuts) -> tuple[float, Condition | None]:
    """The condition with the largest information gain over the rows covered so far."""
    p0, n0 = bad[covered].sum(), covered.sum()
    base = np.log2(p0 / n0) if p0 else -np.inf
    best, choice = 0.0, None
    for feature, points in cuts.items():
        where = np.searchsorted(points, values[feature][covered], side="left")  # value > points[i] iff where > i
        every = np.bincount(where, minlength=len(points) + 1)
        wrong = np.bincount(where, weights=bad[covered], minlength=len(points) + 1)
        below, below_bad = np.cumsum(every)[:-1], np.cumsum(wrong)[:-1]
        for above, count, hits in ((True, n0 - below, p0 - below_bad), (False, below, below_bad)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(hits > 0, hits * (np.log2(hits / count) - base), 0.0)
            at = int(np.argmax(gain)) if len(gain) else -1
            if at >= 0 and gain[at] > best + 1e-9:
                best, choice = float(gain[at]), Condition(feature, above, float(points[at]))
    return best, choice


def learn(values: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Ordered rules that each cover bad rows. No rules if there is nothing to learn from."""
    n = len(bad)
    order = np.random.default_rng(0).permutation(n)
    growing = np.zeros(n, bool)
    growing[order[: 2 * n // 3]] = True
    left = np.ones(n, bool)
    cuts = {k: np.unique(np.quantile(v, np.linspace(0, 1, CUTS + 1)[1:-1])) for k, v in values.items()} if n else {}
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        covered = left & growing
        conditions: list[Condition] = []
        while len(conditions) < MAX_CONDITIONS and bad[covered].sum() >= MIN_COVER and not bad[covered].all():
            gain, choice = _best_condition(values, bad, covered, cuts)
            if choice is None or gain < 1:
                break
            conditions.append(choice)
            covered &= _covers([choice], values, n)
        best: tuple[float, int] | None = None
        for size in range(1, len(conditions) + 1):
            held = left & ~growing & _covers(conditions[:size], values, n)
            if held.sum() >= MIN_COVER:
                hits = int(bad[held].sum())
                worth = (2 * hits - int(held.sum())) / int(held.sum())
                if hits / held.sum() >= MIN_PRECISION and (best is None or worth > best[0] + 1e-9):
                    best = (worth, size)
        if best is None:
            break
        rule = conditions[: best[1]]
        held = left & ~growing & _covers(rule, values, n)
        rules.append(Rule(tuple(rule), float(bad[held].mean())))
        left &= ~_covers(rule, values, n)
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that holds, from 1, or NULL: one ``CASE WHEN`` in the order learned."""
    chain = F.when(F.lit(False), F.lit(0))
    for i, rule in enumerate(rules, 1):
        holds = rule.conditions[0].column()
        for c in rule.conditions[1:]:
            holds &= c.column()
        chain = chain.when(holds, F.lit(i))
    return chain


def text_stats(docs: DataFrame) -> DataFrame:
    """One row of counts per row of ``docs`` (``doc_id``, ``text``); other columns are not read.

    A null text counts as empty, a null id stays null, repeated rows stay repeated.
    """
    return map_batches(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), COUNT_SCHEMA, count_batch)


def fit_rules(stats: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Learn from labelled rows of ``stats``; ``labels`` holds ``doc_id`` and ``quality`` (0: bad).

    Labels that are null or of unknown ids teach nothing; an id labelled twice counts twice.
    """
    marked = labels.select(F.col("doc_id").cast("bigint"), "quality").where("doc_id IS NOT NULL AND quality IS NOT NULL")
    sample = bounded_sample(marked, "doc_id", sample_rows)
    rows = stats.join(sample, "doc_id").selectExpr(
        "doc_id", "quality", *(f"double({sql}) AS {name}" for name, sql in FEATURES.items())
    ).toPandas().sort_values(["doc_id", "quality", "words"], kind="stable")
    return learn({name: rows[name].to_numpy(float) for name in FEATURES}, rows["quality"].to_numpy(int) == 0)


def apply_rules(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """Counts, ``base_failed``, ``rule`` (text of the rule that rejects, or NULL) and ``kept``."""
    failed = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    names = F.array(*(F.lit(str(r)) for r in rules)).cast("array<string>")
    return stats.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & verdict(rules).isNull()).alias("kept"),
        F.try_element_at(names, verdict(rules)).alias("rule"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = staged(text_stats(load(spark, sf_dir, "documents")), "quality-rules")
    return apply_rules(stats, fit_rules(stats, load(spark, sf_dir, "labels")))
