"""Quality rules: base limits and a learned decision list.

The list is learned by sequential covering from statistics of labelled texts: a rule that
rejects grows by the threshold that adds most information, is pruned on rows it hasn't grown
on and drawn in to the bad rows it covers; these are set aside before the next rule grows. The list becomes one
ordered conditional expression over statistics columns, so texts are judged by built-in
functions alone.

Learned from at most SAMPLE labelled rows, those whose ids have the smallest hashes, one row
of each id; an id labelled twice counts as bad if any of its labels does. Without labels of both kinds, or
without a rule that holds on unseen rows, the list is empty and keeps everything. A missing
text is an empty one, which the base limits reject. Each row is judged by itself, so
repeated rows get equal results. Only doc_id and text are read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspan.llm.statistics import COUNTS, FEATURES, counted

#: Labelled rows that reach the driver, as seven statistics each.
SAMPLE = 4000
THRESHOLDS = 24
MOST_CONDITIONS, MOST_RULES = 4, 20
#: A rule has to be right on so many of the unseen rows it covers, and cover so many rows.
LEAST_PRECISION, LEAST_COVER = 0.9, 5

#: Base limits: fewest words, and the percentage of words in repeated windows.
LEAST_WORDS, MOST_REPEATED = 20, 30

Condition = tuple[str, str, float]


def holds(condition: Condition) -> Column:
    name, sign, threshold = condition
    return F.col(name) <= threshold if sign == "<=" else F.col(name) > threshold


@dataclass
class DecisionList:
    """Conjunctions in order; the first that holds rejects, else the text is kept."""

    rules: list[list[Condition]] = field(default_factory=list)

    def column(self) -> Column:
        out = None
        for rule in self.rules:
            whole = holds(rule[0])
            for condition in rule[1:]:
                whole &= holds(condition)
            out = F.when(whole, False) if out is None else out.when(whole, False)
        return F.lit(True) if out is None else out.otherwise(True)

    def __str__(self) -> str:
        lines = [" and ".join(f"{n} {s} {t:.4g}" for n, s, t in r) for r in self.rules]
        return "\n".join([*(f"reject if {x}" for x in lines), "else keep"])


def conditions(x: np.ndarray, names: list[str], thresholds: int = THRESHOLDS) -> list[Condition]:
    """Thresholds for every statistic, both ways.

    They lie halfway between neighbouring values, at quantiles of all rows and of all
    different values, so a statistic that is mostly 0 is still divided above 0.
    """
    out = []
    at = np.linspace(0, 1, thresholds + 2)[1:-1]
    for j, name in enumerate(names):
        values = np.unique(x[:, j])
        below = [np.quantile(v, at, method="lower") for v in (x[:, j], values)]
        below = np.searchsorted(values, np.unique(np.concatenate(below)))
        below = below[below < len(values) - 1]
        cuts = (values[below] + values[below + 1]) / 2
        out += [(name, sign, float(t)) for t in cuts for sign in ("<=", ">")]
    return out


def met(x: np.ndarray, names: list[str], tests: list[Condition]) -> np.ndarray:
    """Which rows meet which conditions."""
    columns = [x[:, names.index(n)] <= t if s == "<=" else x[:, names.index(n)] > t
               for n, s, t in tests]
    return np.stack(columns, axis=1) if columns else np.zeros((len(x), 0), bool)


def _grown(meets: np.ndarray, bad: np.ndarray) -> list[int]:
    """Conditions added one by one, each with the largest information gain."""
    covered, chosen = np.ones(len(bad), bool), []
    while len(chosen) < MOST_CONDITIONS and not bad[covered].all():
        p = meets[covered & bad].sum(axis=0).astype(float)
        n = meets[covered & ~bad].sum(axis=0)
        before = bad[covered].mean()
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(before)), 0)
        best = int(gain.argmax())
        if gain[best] <= 1e-9:
            break
        chosen.append(best)
        covered &= meets[:, best]
    return chosen


def _pruned(chosen: list[int], meets: np.ndarray, bad: np.ndarray) -> tuple[list[int], float]:
    """The shortest prefix that does best on other rows, and its precision there."""
    best, value, precision = chosen, -2.0, 0.0
    for size in range(1, len(chosen) + 1):
        covered = meets[:, chosen[:size]].all(axis=1)
        share = bad[covered].mean() if covered.any() else 0.0
        if 2 * share - 1 > value + 1e-12:
            best, value, precision = chosen[:size], 2 * share - 1, float(share)
    return best, precision


def _tightened(rule: list[Condition], x: np.ndarray, good: np.ndarray, names: list[str]
               ) -> list[Condition]:
    """The rule with each threshold drawn in to the bad rows it covers.

    It then lies halfway between the outermost bad row and the next good one, so good rows
    beyond all bad ones are no longer covered.
    """
    out = list(rule)
    for i, (name, sign, threshold) in enumerate(rule):
        value = x[:, names.index(name)] * (1 if sign == "<=" else -1)
        others = met(x, names, out[:i] + out[i + 1 :]).all(axis=1)
        limit = threshold if sign == "<=" else -threshold
        bad = value[others & ~good & (value <= limit)]
        if len(bad):
            beyond = value[others & good & (value > bad.max())]
            drawn = (bad.max() + beyond.min()) / 2 if len(beyond) else limit
            limit = min(limit, drawn)
        out[i] = (name, sign, float(limit if sign == "<=" else -limit))
    return out


def learn(x: np.ndarray, good: np.ndarray, names: list[str] = FEATURES, seed: int = 5) -> DecisionList:
    """A decision list out of statistics and whether each row is good."""
    if not len(x) or good.all() or not good.any():
        return DecisionList()
    tests = conditions(x, names)
    meets, left = met(x, names, tests), np.ones(len(x), bool)
    rng = np.random.default_rng(seed)
    rules: list[list[Condition]] = []
    while len(rules) < MOST_RULES and (~good & left).sum() >= LEAST_COVER:
        grow = left & (rng.random(len(x)) < 2 / 3)
        prune = left & ~grow
        chosen = _grown(meets[grow], ~good[grow])
        if not chosen:
            break
        chosen, precision = _pruned(chosen, meets[prune], ~good[prune])
        covered = left & meets[:, chosen].all(axis=1)
        if precision < LEAST_PRECISION or covered.sum() < LEAST_COVER:
            break
        rules.append(_tightened([tests[i] for i in chosen], x[left], good[left], names))
        left &= ~met(x, names, rules[-1]).all(axis=1)
    return DecisionList(rules)


def labelled(docs: DataFrame, labels: DataFrame, most: int, only: Column | None = None) -> DataFrame:
    """(doc_id, text, quality) of at most `most` labelled documents, the same ones each time.

    Of rows that repeat an id, the one whose text has the smallest hash.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    known = known.filter(only) if only is not None else known
    chosen = (
        known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    row = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("row")
    return rows.groupBy("doc_id", "quality").agg(row).select("doc_id", "row.text", "quality")


def sample(docs: DataFrame, labels: DataFrame, most: int, only: Column | None = None
           ) -> tuple[np.ndarray, np.ndarray]:
    """Statistics (rows x FEATURES) and quality of labelled documents, in a fixed order."""
    stats = counted(labelled(docs, labels, most, only), ["doc_id", "quality"], features=True)
    rows = stats.select("doc_id", "quality", *FEATURES).collect()
    rows = sorted(tuple(r) for r in rows)
    x = np.array([r[2:] for r in rows], float).reshape(len(rows), len(FEATURES))
    return x, np.array([r[1] == 1 for r in rows], bool)


def base_failed() -> Column:
    few = F.col("n_words") < LEAST_WORDS
    return few | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def judged(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of every row with its counts, base verdict and verdict."""
    keep = keep or ["doc_id"]
    found = learn(*sample(docs, labels, SAMPLE))
    stats = counted(docs, keep, features=True)
    stats = stats.withColumn("base_failed", base_failed())
    verdict = F.when(F.col("base_failed"), False).otherwise(found.column())
    return stats.select(*keep, *COUNTS, "base_failed", verdict.alias("kept"))


def filtered(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that aren't rejected, with their own columns."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    text = names[docs.columns.index("text")]
    found = learn(*sample(docs, labels, SAMPLE))
    stats = counted(plain.withColumn("text", F.col(text)), names, features=True)
    kept = F.when(base_failed(), False).otherwise(found.column())
    # A filter on what is worked out step by step would be moved below the steps and work
    # them out again for each mention; it stays above a column that isn't deterministic.
    stats = stats.select(*names, kept.alias("_kept"), F.monotonically_increasing_id().alias("_row"))
    return stats.filter(F.col("_kept") & (F.col("_row") >= 0)).select(*names).toDF(*docs.columns)
