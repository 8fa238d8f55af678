"""Quality rules: an ordered decision list learned by sequential covering.

Rules are conjunctions of thresholds on the text statistics.  Each is grown
on two thirds of the sample (the condition with the best information gain is
added until no good document is covered), pruned from its end on the other
third, and kept if its precision there is high enough; the documents it
covers then leave both parts and the next rule is grown.  The list compiles
to one ordered Spark conditional expression, so scoring runs in the JVM.

Learning sees a bounded sample: at most ``SAMPLE_ROWS`` labelled documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripscope.llm.common import labelled_sample
from tripscope.llm.text_stats import features, sample_matrix, with_stats

SAMPLE_ROWS = 6000
MAX_RULES = 24
MAX_CONDITIONS = 4
CUTS = 48
MIN_PRECISION = 0.9
MIN_COVERED = 3

# The fixed base limits of the contract.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # value > cut, else value <= cut
    cut: float

    def column(self, measures: dict[str, Column]) -> Column:
        value = measures[self.feature]
        return value > F.lit(self.cut) if self.above else value <= F.lit(self.cut)

    def mask(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        value = x[:, names.index(self.feature)]
        return value > self.cut if self.above else value <= self.cut


Rule = tuple[Condition, ...]


def covered(rule: Rule, x: np.ndarray, names: list[str]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        out &= c.mask(x, names)
    return out


def _candidates(x: np.ndarray, names: list[str]) -> list[Condition]:
    found = []
    for j, name in enumerate(names):
        cuts = np.unique(np.quantile(x[:, j], np.linspace(0, 1, CUTS + 2)[1:-1]))
        found += [Condition(name, above, float(c)) for c in cuts for above in (True, False)]
    return found


def _grow(x: np.ndarray, bad: np.ndarray, names: list[str]) -> Rule:
    rule: Rule = ()
    now = np.ones(len(x), bool)
    while len(rule) < MAX_CONDITIONS and (now & ~bad).any():
        p0, n0 = (now & bad).sum(), (now & ~bad).sum()
        before = np.log2(p0 / (p0 + n0))
        best, best_gain, best_mask = None, 1e-9, now
        for c in _candidates(x[now], names):
            m = now & c.mask(x, names)
            p, n = (m & bad).sum(), (m & ~bad).sum()
            if p and p + n < p0 + n0:
                gain = p * (np.log2(p / (p + n)) - before)
                if gain > best_gain:
                    best, best_gain, best_mask = c, gain, m
        if best is None:
            break
        rule, now = (*rule, best), best_mask
    return rule


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray, names: list[str]) -> tuple[Rule, float, int]:
    best: tuple[Rule, float, int] = ((), -1.0, 0)
    for k in range(len(rule), 0, -1):
        m = covered(rule[:k], x, names)
        p, n = int((m & bad).sum()), int((m & ~bad).sum())
        precision = (p + 1) / (p + n + 2)
        if p and precision >= best[1]:
            best = (rule[:k], precision, p + n)
    return best


def learn_rules(names: list[str], x: list[list[float]], labels: list[int]) -> list[Rule]:
    """The decision list (each rule says "bad") for rows ``x`` labelled 1
    (good) or 0.  No rows, or one class only: an empty list."""
    data, bad = np.asarray(x, float).reshape(len(labels), len(names)), np.asarray(labels) == 0
    if not bad.any() or bad.all():
        return []
    order = np.arange(len(bad))
    test = order % 3 == 2
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < MAX_RULES:
        grow, prune = left & ~test, left & test
        if (grow & bad).sum() < MIN_COVERED:
            break
        rule = _grow(data[grow], bad[grow], names)
        rule, precision, n = _prune(rule, data[prune], bad[prune], names)
        if not rule or n < MIN_COVERED or precision < MIN_PRECISION * (n + 1) / (n + 2):
            break
        rules.append(rule)
        left &= ~covered(rule, data, names)
    return rules


def compile_rules(rules: list[Rule], stats: str = "stats") -> Column:
    """true if no rule of the list fires, as one ordered conditional."""
    measures = features(stats)
    out = None
    for rule in rules:
        test = F.lit(True)
        for c in rule:
            test = test & c.column(measures)
        out = F.when(test, F.lit(False)) if out is None else out.when(test, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def fit_quality_rules(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Learn the list from at most ``sample_rows`` labelled documents
    (``labels``: doc_id, quality)."""
    return learn_rules(*sample_matrix(labelled_sample(docs, labels, "quality", sample_rows)))


def base_failed(stats: str = "stats") -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    words, repeats = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words)


def apply_quality_rules(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """(row, stats, base_failed, kept) for every row of ``docs``.

    A null or empty text has no words and fails the base limits.  Repeated
    rows are judged one by one; further columns stay inside ``row``.
    """
    return with_stats(docs).select(
        "row",
        "stats",
        base_failed().alias("base_failed"),
        (~base_failed() & compile_rules(rules)).alias("kept"),
    )
