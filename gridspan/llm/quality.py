"""Quality scores from a sparse rule ensemble.

Small trees are boosted on statistics of labelled texts; every path from a root to a node
is a conjunctive rule. A logistic model with an absolute-value penalty picks few of the
rules and weighs them. The weighted rules are compiled into one column expression, so texts
are scored by built-in functions.

Learned from at most SAMPLE labelled rows, those whose ids have the smallest hashes, one row
of each id, never from held-out ids; an id labelled twice counts as bad if any of its labels does. Without
labels the score is 0.5, with labels of one kind their share. A missing text is an empty
one, and empty texts are scored as such. Each row is scored by itself. Only doc_id and text
of the documents are read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspan.llm.frames import held_out
from gridspan.llm.rules import Condition, conditions, holds, met, sample
from gridspan.llm.statistics import FEATURES, counted

#: Labelled rows that reach the driver, as seven statistics each.
SAMPLE = 8000
TREES, DEPTH, RATE, LEAST_LEAF = 30, 3, 0.3, 20
PENALTY, STEPS = 0.002, 400
THRESHOLD = 0.3


@dataclass
class RuleEnsemble:
    """Conjunctions with weights, and what is added to their sum."""

    intercept: float = 0.0
    rules: list[tuple[list[Condition], float]] = field(default_factory=list)

    def column(self) -> Column:
        """The probability that a text is good."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            whole = holds(rule[0])
            for condition in rule[1:]:
                whole &= holds(condition)
            total = total + F.when(whole, weight).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))


def _tree(meets: np.ndarray, gradient: np.ndarray, hessian: np.ndarray
          ) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """Paths to all nodes of one boosted tree, as signed conditions, and its scores."""
    paths: list[tuple[int, ...]] = []
    scores = np.zeros(len(gradient))

    def split(rows: np.ndarray, path: tuple[int, ...]) -> None:
        g, h = gradient[rows].sum(), hessian[rows].sum()
        if path:
            paths.append(path)
        if len(path) < DEPTH:
            own = meets[rows]
            gl, hl, n = gradient[rows] @ own, hessian[rows] @ own, own.sum(axis=0)
            gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
            gain[(n < LEAST_LEAF) | (len(rows) - n < LEAST_LEAF)] = 0
            best = int(gain.argmax())
            if gain[best] > 1e-6:
                inside = own[:, best] > 0
                split(rows[inside], (*path, best + 1))
                split(rows[~inside], (*path, -best - 1))
                return
        scores[rows] = RATE * g / (h + 1)

    split(np.arange(len(gradient)), ())
    return paths, scores


def paths_of_trees(meets: np.ndarray, good: np.ndarray) -> list[tuple[int, ...]]:
    """The different paths of all boosted trees; each condition is one of `meets`, or its negative."""
    total, paths = np.full(len(good), np.log(good.mean() / (1 - good.mean()))), {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        found, scores = _tree(meets.astype(float), good - p, p * (1 - p))
        paths |= dict.fromkeys(tuple(sorted(f)) for f in found)
        total += scores
    return list(paths)


def lasso(features: np.ndarray, good: np.ndarray) -> tuple[float, np.ndarray]:
    """Intercept and weights of a penalised logistic model, by accelerated proximal steps."""
    n, k = features.shape
    mean, deviation = features.mean(axis=0), features.std(axis=0) + 1e-9
    z = (features - mean) / deviation
    step = 4 * n / (np.linalg.norm(z, 2) ** 2 + n) if k else 1.0
    w = v = np.zeros(k)
    b = c = float(np.log(good.mean() / (1 - good.mean())))
    t = 1.0
    for _ in range(STEPS):
        error = good - 1 / (1 + np.exp(-(z @ v + c)))
        moved = v + step * (z.T @ error) / n
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * PENALTY, 0)
        level = c + step * error.mean()
        u = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / u * (new - w), level + (t - 1) / u * (level - b)
        w, b, t = new, level, u
    w = w / deviation
    return float(b - w @ mean), w


def learn(x: np.ndarray, good: np.ndarray, names: list[str] = FEATURES) -> RuleEnsemble:
    if not len(x) or good.all() or not good.any():
        share = (good.sum() + 1) / (len(good) + 2)
        return RuleEnsemble(float(np.log(share / (1 - share))))
    tests = [c for c in conditions(x, names) if c[1] == "<="]
    meets = met(x, names, tests)
    paths = paths_of_trees(meets, good)
    features = np.stack(
        [np.all([meets[:, i - 1] if i > 0 else ~meets[:, -i - 1] for i in p], axis=0) for p in paths]
        or [np.zeros(len(x), bool)],
        axis=1,
    ).astype(float)
    intercept, weights = lasso(features, good.astype(float))

    def condition(i: int) -> Condition:
        name, _, threshold = tests[abs(i) - 1]
        return name, "<=" if i > 0 else ">", threshold

    rules = [([condition(i) for i in p], float(w)) for p, w in zip(paths, weights) if w]
    return RuleEnsemble(intercept, rules)


def score(docs: DataFrame, labels: DataFrame, modulus: int = 5, rest: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; held-out ids' labels aren't seen."""
    model = learn(*sample(docs, labels, SAMPLE, ~held_out(modulus, rest)))
    stats = counted(docs, ["doc_id"], features=True).withColumn("score", model.column())
    return stats.select(
        "doc_id", held_out(modulus, rest).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
