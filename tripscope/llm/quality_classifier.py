"""Quality classifier: a sparse rule ensemble over text statistics.

Shallow trees are boosted on a bounded labelled sample; every path from the
root to a node becomes a rule (a conjunction of thresholds); lasso logistic
regression picks and weighs few of them; the model compiles to one Spark
column, so scoring runs in the JVM on whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripscope.llm.common import labelled_sample, remainder
from tripscope.llm.quality_rules import Condition, Rule, covered
from tripscope.llm.text_stats import features, sample_matrix, with_stats

SAMPLE_ROWS = 6000
TREES = 40
DEPTH = 3
CUTS = 32
LASSO = 1e-3
STEPS = 600
SEED = 20


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def probability(self, stats: str = "stats") -> Column:
        """P(label 1) as a column expression over the counts struct."""
        measures = features(stats)
        margin = F.lit(self.intercept)
        for rule, weight in self.rules:
            test = F.lit(True)
            for c in rule:
                test = test & c.column(measures)
            margin = margin + F.when(test, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def _tree_paths(x: np.ndarray, grad: np.ndarray, cuts: list[np.ndarray], names: list[str], rows: np.ndarray, path: Rule, out: dict) -> np.ndarray:
    """Grow one regression tree on ``grad``; record every path; return the
    fitted value of each row."""
    fit = np.zeros(len(x))
    fit[rows] = grad[rows].mean() if rows.any() else 0.0
    if len(path) == DEPTH or rows.sum() < 20:
        return fit
    total, n = grad[rows].sum(), rows.sum()
    best = (1e-9, None)
    for j, name in enumerate(names):
        v, g = x[rows, j], grad[rows]
        at = np.searchsorted(cuts[j], v, side="left")  # v <= cuts[k] iff at <= k
        sums = np.cumsum(np.bincount(at, g, len(cuts[j]) + 1))[:-1]
        counts = np.cumsum(np.bincount(at, minlength=len(cuts[j]) + 1))[:-1]
        ok = (counts >= 5) & (n - counts >= 5)
        if ok.any():
            gain = np.where(ok, sums**2 / np.maximum(counts, 1) + (total - sums) ** 2 / np.maximum(n - counts, 1) - total**2 / n, -1.0)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], (j, k))
    if best[1] is None:
        return fit
    j, k = best[1]
    for above in (False, True):
        c = Condition(names[j], above, float(cuts[j][k]))
        part = rows & c.mask(x, names)
        step = (*path, c)
        out[step] = None
        sub = _tree_paths(x, grad, cuts, names, part, step, out)
        fit[part] = sub[part]
    return fit


def _lasso(z: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient for L1 logistic regression of the rule
    outcomes ``z`` (rows by rules, 0 or 1), each scaled by its deviation.

    ``z`` is float32 and never copied: the scale is applied to the weights.
    """
    n, d = z.shape
    scale = np.maximum(z.std(axis=0, dtype=np.float64), 1e-9).astype(np.float32)
    v = np.random.default_rng(SEED).random(d).astype(np.float32)
    largest = 1.0
    for _ in range(30):  # power iteration for the step size
        v = (z.T @ (z @ (v / scale))) / scale
        largest = float(np.linalg.norm(v))
        v /= largest
    step = 4.0 * n / (1.1 * largest + n)
    w0, w = 0.0, np.zeros(d)
    v0, v, t = w0, w.copy(), 1.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(v0 + z @ (v / scale).astype(np.float32), -30, 30)))
        error = (p - y) / n
        u0 = v0 - step * error.sum()
        u = v - step * (z.T @ error.astype(np.float32)) / scale
        u = np.sign(u) * np.maximum(np.abs(u) - step * LASSO, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v0, v = u0 + (t - 1) / t2 * (u0 - w0), u + (t - 1) / t2 * (u - w)
        w0, w, t = u0, u, t2
    return float(w0), w / scale


def learn_ensemble(names: list[str], x: list[list[float]], labels: list[int]) -> RuleEnsemble:
    """Boost, extract, select.  Without both classes the model is constant:
    the smoothed share of label 1 (0.5 for no rows)."""
    y = np.asarray(labels, float)
    share = (y.sum() + 1) / (len(y) + 2)
    if len(y) == 0 or y.min() == y.max():
        return RuleEnsemble(float(np.log(share / (1 - share))), ())
    data = np.asarray(x, float)
    cuts = [np.unique(np.quantile(data[:, j], np.linspace(0, 1, CUTS + 2)[1:-1])) for j in range(len(names))]
    random = np.random.default_rng(SEED)
    margin = np.full(len(y), np.log(share / (1 - share)))
    paths: dict[Rule, None] = {}
    for _ in range(TREES):
        grad = y - 1 / (1 + np.exp(-margin))
        rows = random.random(len(y)) < 0.6
        fit = _tree_paths(data, grad, cuts, names, rows, (), paths)
        margin += np.where(rows, fit, 0.0) * 2.0
    masks, rules = [], []
    seen: set[bytes] = set()
    for rule in paths:
        m = covered(rule, data, names)
        if 0 < m.sum() < len(y) and (key := m.tobytes()) not in seen and (~m).tobytes() not in seen:
            seen.add(key)
            masks.append(m)
            rules.append(rule)
    if not rules:
        return RuleEnsemble(float(np.log(share / (1 - share))), ())
    intercept, w = _lasso(np.array(masks, np.float32).T, y)
    return RuleEnsemble(intercept, tuple((r, float(v)) for r, v in zip(rules, w) if abs(v) > 1e-6))


def fit_quality_classifier(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> RuleEnsemble:
    """Fit on at most ``sample_rows`` labelled documents of the training folds
    (crc32 of the id as text, modulo 3, other than 1)."""
    return learn_ensemble(*sample_matrix(labelled_sample(docs, labels, "quality", sample_rows)))


def score_quality(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """(row, score) for every row: null and empty texts get the score of a
    text without words; repeated rows are scored one by one."""
    return with_stats(docs).select("row", model.probability().alias("score"))


def held_out(doc_id: Column) -> Column:
    """The fold that labels are never learned from (a null id: false)."""
    return F.coalesce(remainder(doc_id) == 1, F.lit(False))
