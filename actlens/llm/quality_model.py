"""Quality classifier: logistic regression over hashed word n-grams, trained
with follow-the-regularised-leader (FTRL-proximal) updates.

Features are the words and word pairs of the whole text, hashed into
``2 ** BITS`` slots; a slot's value is ``log(1 + count)``, and the vector is
scaled to length one, so that the score does not grow with the text.  Two
more say how much of the text's pairs and triples repeat.  A text
is scored as the sparse dot product of its vector with the weights, plus a
bias.  Texts without words have the bias alone.

Training: at most ``max_rows`` labelled rows (a documented bound; the rows
with the smallest hash of ``doc_id``) are vectorised on the executors and
dealt by hash into ``SHARDS`` groups.  In each round every shard runs FTRL
over its rows in a fixed order, starting from the common state; a Spark
aggregate then adds up, slot by slot, what the shards have changed, and the
sums go into the common state (the squared gradients as well, which slow down
the steps of slots that many shards move).  The state sent around
has ``2 ** BITS + 3`` slots at most, whatever the input.

Defined cases: null and empty texts have no words; texts of any length are counted whole; a score of
exactly 0.5 (all of them without training rows) predicts 1; rows of a document with equal texts are one
training row and are scored each; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actlens.llm.batches import WORD_HASH, slices, words
from actlens.llm.quality_rules import MAX_TRAINING_ROWS, sampled_labels
from actlens.sources.scratch import materialize

#: log2 of the number of weights; the model is 2 ** BITS doubles (2 MB).
BITS = 18
SHARDS = 8
_PAIR = np.uint64(0x9E3779B97F4A7C15)  # mixes the first word of a pair
_ODD = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class FTRL:
    """Parameters of the updates: learning rate, its offset, L1 and L2."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1
    rounds: int = 6


def features(text: str | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text: its hashed words and word pairs; the share
    of pairs and of triples that repeat an earlier one (slots
    ``2 ** bits + 1`` and ``+ 2``); and the bias, slot ``2 ** bits``."""
    tokens = words(text)
    h = np.fromiter(map(WORD_HASH.__getitem__, tokens), np.uint64, len(tokens))
    pairs = (h[:-1] * _PAIR) ^ h[1:]
    triples = (pairs[:-1] * _PAIR) ^ h[2:]
    slots = (np.concatenate([h, pairs]) * _ODD) >> np.uint64(64 - bits)
    slots, counts = np.unique(slots.astype(np.int64), return_counts=True)
    values = np.log1p(counts)
    norm = np.sqrt(np.square(values).sum()) or 1.0
    again = [1 - len(np.unique(x)) / max(1, len(x)) if len(x) else 0.0 for x in (pairs, triples)]
    return (np.concatenate([slots, [1 << bits, (1 << bits) + 1, (1 << bits) + 2]]).astype(np.int32),
            np.concatenate([values / norm, [1.0], again]))


def _weights(z: np.ndarray, n: np.ndarray, p: FTRL) -> np.ndarray:
    """The weights that FTRL's state stands for: zero within L1."""
    return np.where(np.abs(z) <= p.l1, 0.0, -(z - np.sign(z) * p.l1) / ((p.beta + np.sqrt(n)) / p.alpha + p.l2))


def ftrl_pass(rows: list[tuple[np.ndarray, np.ndarray, int]], z: np.ndarray, n: np.ndarray, p: FTRL) -> None:
    """One pass of updates over ``(slots, values, label)`` rows, in place."""
    for slots, values, label in rows:
        w = _weights(z[slots], n[slots], p)
        g = (1 / (1 + np.exp(-np.clip(w @ values, -35, 35))) - label) * values
        sigma = (np.sqrt(n[slots] + g * g) - np.sqrt(n[slots])) / p.alpha
        z[slots] += g - sigma * w
        n[slots] += g * g


def _one_shard(state: Broadcast, p: FTRL) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """One pass over a shard from the common state: what changed in it."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        z, n = (a.copy() for a in state.value)
        # a fixed order that has nothing to do with the ids' order
        rows = rows.sort_values("doc_id", ignore_index=True).sample(frac=1, random_state=11)
        ftrl_pass(list(zip(rows["slots"], rows["vals"], rows["label"])), z, n, p)
        changed = np.flatnonzero(n != state.value[1])
        return pd.DataFrame({"slot": changed, "dz": z[changed] - state.value[0][changed],
                             "dn": n[changed] - state.value[1][changed]})

    return run


def fit(docs: DataFrame, labels: DataFrame, train: Column, p: FTRL = FTRL(), max_rows: int = MAX_TRAINING_ROWS,
        bits: int = BITS) -> np.ndarray:
    """Train on the labelled rows of ``docs`` whose ``doc_id`` meets ``train``;
    returns the weights.  Without such rows all are zero."""
    spark = docs.sparkSession
    sample = sampled_labels(labels.where(train), limit=max_rows)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            slots, values = zip(*(features(t, bits) for t in batch.column(2).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(slots, pa.list_(pa.int32())),
                 pa.array(values, pa.list_(pa.float32()))], ["doc_id", "label", "slots", "vals"])

    # Labels are bounded, and so are the rows that have them: an id may be repeated in docs.
    # Rows of a document with equal texts are one row; those with the smallest hash are taken.
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), "text").join(
        F.broadcast(sample), "doc_id")
    taken = labelled.select("doc_id", "hash").distinct().orderBy(F.xxhash64("doc_id", "hash"), "doc_id", "hash").limit(max_rows)
    rows = labelled.join(F.broadcast(taken), ["doc_id", "hash"]).select("doc_id", "label", "text").mapInArrow(
        vectors, "doc_id long, label int, slots array<int>, vals array<float>").dropDuplicates()
    # A bounded table of sparse vectors, written once: each round reads it.
    rows = materialize(rows.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS))).repartition(SHARDS, "shard"),
                       "ftrl-rows")
    size = (1 << bits) + 3
    z, n = np.zeros(size), np.zeros(size)

    for _ in range(p.rounds):
        state = spark.sparkContext.broadcast((z, n))

        moved = rows.groupBy("shard").applyInPandas(_one_shard(state, p), "slot int, dz double, dn double")
        # At most 2 ** bits + 3 rows: the changes, added up over the shards.
        moved = moved.groupBy("slot").agg(F.sort_array(F.collect_list(F.struct("dz", "dn"))).alias("d")).select(
            "slot", F.expr("aggregate(d, 0D, (a, x) -> a + x.dz)").alias("dz"),
            F.expr("aggregate(d, 0D, (a, x) -> a + x.dn)").alias("dn")).toPandas()
        z[moved["slot"]] += moved["dz"]
        n[moved["slot"]] += moved["dn"]
        state.unpersist()
    return _weights(z, n, p)


def score(docs: DataFrame, weights: np.ndarray, bits: int = BITS) -> DataFrame:
    """``doc_id, score`` of every row of ``docs`` (``doc_id, text``): the
    probability that the text is of good quality.  One pass, no shuffle."""
    model = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = []
            for text in batch.column(1).to_pylist():
                slots, values = features(text, bits)
                out.append(1 / (1 + np.exp(-np.clip(model.value[slots] @ values, -35, 35))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def held_out() -> Column:
    """The fold that labels are never learned from: crc32 of ``doc_id`` as text, modulo 3, is 1."""
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    Null and empty texts are scored by the bias; a null ``doc_id`` is scored
    and counts as not held out; repeated rows are scored each."""
    weights = fit(docs, labels, ~held_out())
    scored = score(docs, weights)
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
