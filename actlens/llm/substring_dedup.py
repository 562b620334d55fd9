"""Substring dedup by seed and extend.

Removed is every word that lies in a window of ``length`` words whose word
sequence also starts in a document with a smaller ``doc_id``.

*Seeds*: the hashes of all ``k``-word sequences are winnowed: a window of
``length`` words is represented by the smallest hash of the
``length - k + 1`` sequences in it, its anchor.  Equal windows have equal
anchors, so two documents can only share a window where they share an
anchor.  Neighbouring windows mostly have the same anchor and form one run;
documents are joined on anchors, and anchors that occur in one document only
are dropped first.

*Extension*: around an anchor the match is extended to both sides as far as
its run goes.  Runs that are equal as a whole are settled by one row each.
Where an anchor has several different surroundings, the first document of each
is extended window by window to the left and right.  For every run and window
only the smallest ``doc_id`` is looked up (a pre-aggregated minimum joined
back), so a passage in ``n`` documents costs ``n`` rows, not ``n * n`` pairs.

*Maximal repeats*: overlapping matches are merged per document, which gives
the longest stretches that are covered by repeats of at least ``length`` words.

Hashes are 64-bit polynomials of 64-bit word hashes; a match has to agree in
the anchor's and in the run's or window's.  Null and empty texts have no words.
Rows with a null ``doc_id`` are not compared and stay whole.  If rows share a
``doc_id``, each is judged on its own text against smaller ids only; equal rows are one document, whose
runs are looked up once.  Texts of any length are cut whole; an empty table gives an empty one;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actlens.llm.batches import WORD_HASH, slices, words
from actlens.sources.scratch import materialize

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``_BASE ** i`` and its inverse for ``i < n``, modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        _powers = tuple(np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(2 * n, b, np.uint64))))
                        for b in (_BASE, inverse))
    return _powers


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Rolling:
    """Hashes of any stretch of a sequence of word hashes."""

    def __init__(self, h: np.ndarray):
        up, self._down = _power_tables(len(h) + 1)
        self._sum = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * up[: len(h)], dtype=np.uint64)))

    def of(self, start: np.ndarray, size) -> np.ndarray:
        """Hashes of the stretches of ``size`` words from ``start`` on."""
        value = (self._sum[start + size] - self._sum[start]) * self._down[start]
        return _mixed(value + np.asarray(size).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(WORD_HASH.__getitem__, tokens), np.uint64, len(tokens))


def runs(h: np.ndarray, sizes: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """The runs of windows with one anchor in documents that lie one behind
    the other in ``h``: position of the first window, windows, anchor, hash."""
    none = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64))
    if len(h) < length:
        return none
    rolling = Rolling(h)
    least, width = rolling.of(np.arange(len(h) - k + 1), k), 1
    want = length - k + 1
    while width < want:  # least[i]: smallest of the next `width` hashes
        step = min(width, want - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    ends = np.cumsum(sizes)
    whole = np.ones(len(least), bool)  # windows that lie in one document
    for e in ends[:-1].tolist():
        whole[max(0, e - length + 1):e] = False
    at = np.flatnonzero(whole)
    if not len(at):
        return none
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (least[at[1:]] != least[at[:-1]])
    first = np.flatnonzero(new)
    start, count = at[first], np.diff(np.append(first, len(at)))
    return start, count, least[start], rolling.of(start, count + length - 1)


def _seeds(docs: DataFrame, length: int, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            tokens = [words(t) for t in batch.column(2).to_pylist()]
            sizes = np.array([len(t) for t in tokens])
            start, count, anchor, span = runs(np.concatenate([word_hashes(t) for t in tokens]), sizes, length, k)
            ends = np.cumsum(sizes)
            owner = np.searchsorted(ends, start, "right")
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(owner)), batch.column(1).take(pa.array(owner)),
                pa.array((start - (ends - sizes)[owner]).astype(np.int32)), pa.array(count.astype(np.int32)),
                pa.array(anchor.view(np.int64)), pa.array(span.view(np.int64))],
                ["doc_id", "tag", "start", "n", "anchor", "span"])

    return docs.mapInArrow(run, "doc_id long, tag long, start int, n int, anchor long, span long")


def _windows(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The windows of the runs ``wanted`` (``doc_id, tag, runs``): a row each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 64):
            for doc, tag, text, asked in zip(*(batch.column(i).to_pylist() for i in range(4))):
                rolling = Rolling(word_hashes(words(text)))
                start, n = (np.array([r[f] for r in asked]) for f in ("start", "n"))
                at = np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())
                anchor = np.repeat(np.array([r["anchor"] for r in asked], np.int64), n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * len(at), pa.int64()), pa.array([tag] * len(at), pa.int64()),
                     pa.array(at.astype(np.int32)), pa.array(anchor), pa.array(rolling.of(at, length).view(np.int64))],
                    ["doc_id", "tag", "start", "anchor", "span"])

    return docs.join(wanted, ["doc_id", "tag"]).select("doc_id", "tag", "text", "runs").mapInArrow(
        run, "doc_id long, tag long, start int, anchor long, span long")


def _earlier(rows: DataFrame) -> DataFrame:
    """The ``rows`` whose anchor and span also occur under a smaller ``doc_id``."""
    first = rows.groupBy("anchor", "span").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    first = materialize(first.where("first < last").select("anchor", "span", "first"), "first")
    return rows.join(first, ["anchor", "span"]).where("doc_id > first").drop("first")


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, a checksum of the text and the text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.crc32("text"), F.lit(0)).alias("tag"), "text")


def repeats(docs: DataFrame, length: int = 50, k: int = 20) -> DataFrame:
    """``doc_id, tag, start, n``: ``n`` windows from word ``start`` on whose
    words also start in a document with a smaller ``doc_id``; every such window
    is in some row (equal rows of a document repeat them).  ``tag`` is the text's CRC32."""
    keyed = _keyed(docs).where("doc_id is not null")
    seeds = materialize(_seeds(keyed, length, k), "seeds")
    shared = seeds.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b")
    # Minima are written before they are joined back: the join is then apart
    # from their aggregate, and a hot anchor's rows can be split.
    shared = materialize(shared.select("anchor"), "shared-anchors")
    seeds = materialize(seeds.join(shared, "anchor", "left_semi"), "shared-seeds")
    whole = _earlier(seeds).select("doc_id", "tag", "start", "n")
    # Anchors with several surroundings: the first document of each surrounding is looked at window by window.
    first = seeds.groupBy("anchor", "span").agg(F.min("doc_id").alias("first"))
    several = first.groupBy("anchor").agg(F.count("span").alias("spans"), F.min("first").alias("a"),
                                          F.max("first").alias("b")).where("spans > 1 and a < b")
    several = materialize(several.select("anchor"), "several")
    firsts = materialize(first.join(several, "anchor", "left_semi"), "firsts")
    open_runs = seeds.join(firsts, ["anchor", "span"]).where("doc_id = first")
    # A set: equal rows of a document ask for the same runs.
    wanted = open_runs.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("start", "n", "anchor")).alias("runs"))
    windows = materialize(_windows(keyed, wanted, length), "windows")
    return whole.union(_earlier(windows).select("doc_id", "tag", "start", F.lit(1).alias("n")))


def dedup(docs: DataFrame, length: int = 50, k: int = 20) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` (the kept words joined by one
    blank) of every row of ``docs`` (``doc_id, text``)."""
    found = materialize(repeats(docs, length, k), "repeats")
    # A set, so that a document's entries are bounded by its own words, however often its row is repeated.
    found = found.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("start", "n")).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            total, removed, kept = [], [], []
            for text, hits in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                tokens = words(text)
                total.append(len(tokens))
                if hits:
                    edge = np.zeros(len(tokens) + 1, np.int64)
                    np.add.at(edge, [x["start"] for x in hits], 1)
                    np.add.at(edge, [x["start"] + x["n"] + length - 1 for x in hits], -1)
                    tokens = [tokens[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                removed.append(total[-1] - len(tokens))
                kept.append(b" ".join(tokens).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    return _keyed(docs).join(found, ["doc_id", "tag"], "left").select("doc_id", "text", "found").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept string")
