"""Quality rules: decision lists learned by sequential covering.

Labelled documents are reduced to statistics (:mod:`.text_stats`), and a
decision list "reject if ... and ..., else reject if ..., else keep" is
learned from them:

* *grow*: the rule starts empty and takes, condition by condition, the
  threshold test with the largest information gain until it covers no good
  document of the growing set;
* *prune*: conditions are dropped from the end while the precision on the
  pruning set (documents not grown on) does not fall;
* *cover*: the rejected documents leave the training set and the next rule is
  learned, until a rule's precision on the pruning set is under
  ``min_precision`` or it catches fewer than ``min_covered`` documents.

The list becomes one ordered conditional Spark expression (:func:`verdict`)
over the statistics, so that applying it is plain SQL on the executors.

The rules are fitted on at most ``max_rows`` labelled rows (those with the
smallest hash of ``doc_id``); everything else runs over all rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actlens.llm.text_stats import COUNTS, with_counts

#: Most labelled rows that a model of this subpackage is fitted on.
MAX_TRAINING_ROWS = 20_000

#: The measures that conditions test, as SQL over the counts.  Ratios are a
#: thousandth, rounded down, so that Python and Spark test the same integers.
MEASURES = {
    "words": "n_words",
    "mean_word": "1000 * word_chars div greatest(n_words, 1)",
    "symbols": "1000 * n_symbols div greatest(n_words, 1)",
    "symbol_words": "1000 * n_symbol_words div greatest(n_words, 1)",
    "upper_words": "1000 * n_upper_words div greatest(n_words, 1)",
    "repeats": "1000 * n_repeat_words div greatest(n_words, 1)",
    "dup_lines": "1000 * n_dup_lines div greatest(n_words, 1)",
    "stops": "1000 * n_stops div greatest(n_words, 1)",
}


@dataclass(frozen=True)
class Condition:
    """``measure >= threshold`` (or ``<=`` where ``at_least`` is false)."""

    measure: str
    at_least: bool
    threshold: int

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.measure] >= self.threshold if self.at_least else x[self.measure] <= self.threshold

    def column(self) -> Column:
        value = F.expr(MEASURES[self.measure])
        return value >= self.threshold if self.at_least else value <= self.threshold


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: dict[str, np.ndarray]) -> np.ndarray:
    hit = np.ones(len(next(iter(x.values()))), bool)
    for condition in rule:
        hit &= condition.holds(x)
    return hit


def _best_condition(x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, Condition | None]:
    """The test with the largest gain ``p1 * (log2 p1/(p1+n1) - log2 p0/(p0+n0))``."""
    p0, n0 = int(bad.sum()), int((~bad).sum())
    best: tuple[float, Condition | None] = (0.0, None)
    if not p0:
        return best
    base = np.log2(p0 / (p0 + n0))
    for name, values in x.items():
        cuts, index = np.unique(values, return_inverse=True)
        p = np.bincount(index, bad, len(cuts))
        n = np.bincount(index, ~bad, len(cuts))
        for at_least in (True, False):
            ps, ns = (np.cumsum(a[::-1])[::-1] if at_least else np.cumsum(a) for a in (p, n))
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(ps > 0, ps * (np.log2(ps / (ps + ns)) - base), 0.0)
            gain[0 if at_least else -1] = 0.0  # a test that all rows pass
            k = int(np.argmax(gain))
            if gain[k] > best[0] + 1e-9:
                # halfway to the next value outside, so that the border is not a training value
                other = cuts[k - 1] if at_least else cuts[k + 1]
                cut = int(other + cuts[k] + 1) // 2 if at_least else int(other + cuts[k]) // 2
                best = float(gain[k]), Condition(name, at_least, cut)
    return best


def _precision(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> float:
    """Share of bad documents among those covered (Laplace's estimate)."""
    hit = covers(rule, x)
    return (int((hit & bad).sum()) + 1) / (int(hit.sum()) + 2)


def learn(x: dict[str, np.ndarray], bad: np.ndarray, min_precision: float = 0.9, min_covered: int = 5,
          max_conditions: int = 4, max_rules: int = 16) -> list[Rule]:
    """Learn the decision list that rejects ``bad`` rows of the measures ``x``.
    Every third row is kept for pruning.  Without rows of both kinds the
    list is empty (everything is kept)."""
    rules: list[Rule] = []
    prune = np.arange(len(bad)) % 3 == 2
    left = np.ones(len(bad), bool)
    while len(rules) < max_rules and (left & bad & ~prune).sum() and (left & ~bad).sum():
        grow_x = {k: v[left & ~prune] for k, v in x.items()}
        grow_bad = bad[left & ~prune]
        rule: Rule = ()
        while len(rule) < max_conditions:
            hit = covers(rule, grow_x)
            if not (hit & ~grow_bad).any():
                break
            _, condition = _best_condition({k: v[hit] for k, v in grow_x.items()}, grow_bad[hit])
            if condition is None:
                break
            rule += (condition,)
        prune_x = {k: v[left & prune] for k, v in x.items()}
        prune_bad = bad[left & prune]
        while len(rule) > 1 and _precision(rule[:-1], prune_x, prune_bad) >= _precision(rule, prune_x, prune_bad):
            rule = rule[:-1]
        caught = covers(rule, x) & left
        if not rule or (caught & bad).sum() < min_covered or (caught & bad).sum() < min_precision * caught.sum() or (
                _precision(rule, prune_x, prune_bad) < min_precision - 0.2):
            break
        rules.append(rule)
        left &= ~caught
    return rules


def verdict(rules: Sequence[Rule]) -> Column:
    """The decision list as one ordered conditional expression: false for a
    row that a rule rejects, else true."""
    kept: Column = F.lit(True)
    for rule in reversed(rules):
        test = F.lit(True)
        for condition in rule:
            test = test & condition.column()
        kept = F.when(test, F.lit(False)).otherwise(kept)
    return kept


def sampled_labels(labels: DataFrame, label: str = "quality", limit: int = MAX_TRAINING_ROWS) -> DataFrame:
    """``doc_id, label`` of at most ``limit`` labelled rows, those with the
    smallest hash.  Rows with nulls or values other than 0 and 1 are left
    out; a document labelled more than once counts by its lowest label."""
    chosen = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(label).cast("int").alias("label"))
    return chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAINING_ROWS) -> list[Rule]:
    """Learn the rules from the labelled rows of ``docs`` (``doc_id, text``).
    Labels are bounded by ``limit``, so they may be broadcast; the rows that have them are
    bounded by it too, however often a ``doc_id`` is repeated in ``docs``: those with the
    smallest hash are collected, as rows of a few integers.  Rows of a document with
    equal counts are one row.  Without labels, or with labels of one kind only, the
    list is empty.  Other columns are not read."""
    sample = sampled_labels(labels, limit=limit)
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id", "left_semi")
    measured = with_counts(chosen).join(F.broadcast(sample), "doc_id").selectExpr(
        "doc_id", "label", *(f"cast({e} as bigint) {m}" for m, e in MEASURES.items())).distinct()
    own = ["doc_id", *MEASURES]
    measured = measured.orderBy(F.xxhash64(*own), *own).limit(limit).toPandas()
    measured = measured.sort_values(["doc_id", *MEASURES]).sample(frac=1, random_state=7)
    x = {m: measured[m].to_numpy(np.int64) for m in MEASURES}
    return learn(x, measured["label"].to_numpy() == 0)


def base_failed() -> Column:
    """Fewer than 50 words, or over half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` of every row of
    ``docs``.  Null and empty texts have no words, so they fail the base test."""
    return with_counts(docs).withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & verdict(rules))


def keep_good(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, all columns as they are."""
    good = with_counts(docs, whole=True).where(~base_failed() & verdict(rules))
    return good.select("row.*")


__all__ = ["COUNTS", "Condition", "base_failed", "covers", "fit", "judge", "keep_good", "learn", "sampled_labels", "verdict"]
