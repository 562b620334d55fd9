"""Benchmark decontamination: BM25 with block-max WAND, then overlap checks.

The benchmark items are the indexed documents; every training text is a set
of queries: passages of ``2 m`` words, one starting at every ``m``-th word,
where ``m`` is the length of the longest item, so that any occurrence of an
item lies within one passage.  An item's score is the BM25 weight of its
terms that are in the passage, as a share of the weight of all its terms
(0 to 1); all items that reach ``threshold`` are retrieved, and an item whose
weight sits in few words from the least score on that a verified one can have.

*Inverted index*: per term the items in order, with their impacts, cut into
at most ``BLOCKS`` blocks of items that carry their largest impact.  The
queries of a batch of texts are run in step (:meth:`Index.retrieve`): WAND's
pivot test leaves the passages whose terms' upper bounds together miss the
threshold; the block maxima of the others are summed, and only the blocks
that can still reach the threshold have their postings read.

*Verification*: the passage must hold at least ``overlap`` of the five-word
shingles of the item's question and of its answer (a part with fewer words:
all of it, in order).  Items are plain text: the last sentence is taken for
the answer and the rest for the question; of a single sentence, the last
quarter of its words.  As that split is a guess, and one word decides over a
short answer, an item is also verified if the passage holds at least
``overlap`` of the shingles of the whole item.

The index is built in shards of a bounded number of bytes, each by one task, and written to
the scratch folder; from there the shards are sent to the executors one by one, and
:data:`SHARDS_PER_PASS` of them are looked up in one pass over the texts.
Document frequencies and the mean length count over all items, so results do not depend on the
shards.  Null and empty texts match nothing, texts of any length are cut into passages whole,
and rows that share a ``doc_id`` are reported each.  Items repeated in the benchmark
are each reported; an item without words never matches.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actlens.llm.batches import slices
from actlens.sources.scratch import materialize

BLOCKS = 64
#: Most bytes of item text in one index sent to the executors.
SHARD_BYTES = 4 << 20
#: Shards looked up in one pass over the texts; a worker holds so many at a time.
SHARDS_PER_PASS = 8
_K1, _B, _SHINGLE = 1.2, 0.75, 5
#: ASCII other than letters, digits and the six spaces.
_DELETE = bytes(c for c in range(128) if not chr(c).isalnum() and not chr(c).isspace() or 28 <= c < 32)
_SENTENCE_END = re.compile(r"(?<=[.?!])\s+")


def terms_of(text: str | None) -> list[bytes]:
    """The words in lower case without ASCII punctuation."""
    return text.lower().encode().translate(None, _DELETE).split() if text else []


def question_and_answer(text: str | None) -> tuple[list[bytes], list[bytes]]:
    """The terms of an item's question and of its answer."""
    sentences = _SENTENCE_END.split((text or "").strip())
    parts = [t for t in map(terms_of, sentences) if t]
    if len(parts) > 1:
        return sum(parts[:-1], []), parts[-1]
    whole = parts[0] if parts else []
    cut = len(whole) - len(whole) // 4
    return whole[:cut], whole[cut:]


class _Shingles(dict):
    """The sets of shingles of ``n`` words of ``ids``, by ``n``, made when first asked for."""

    def __init__(self, ids: list[int]):
        super().__init__()
        self._ids = ids

    def __missing__(self, n: int) -> set[tuple[int, ...]]:
        self[n] = set(zip(*[self._ids[i:] for i in range(n)]))
        return self[n]


def _share(part: list[int], passage: _Shingles) -> float:
    """Share of the shingles of ``part`` that are in ``passage`` (an empty part: 1)."""
    if not part:
        return 1.0
    n = min(_SHINGLE, len(part))
    want = _Shingles(part)[n]
    return len(want & passage[n]) / len(want)


def _most_lost(part: list[int], weight: dict[int, float], overlap: float) -> float:
    """No less than the weight of the terms of ``part`` that a passage can lack
    which holds ``overlap`` of its shingles: each term takes its shingles with
    it, and a lost shingle has at most ``n`` terms."""
    n = min(_SHINGLE, len(part))
    want = _Shingles(part)[n] if n else set()
    spare = int((1 - overlap) * len(want) + 1e-9)
    held = Counter(t for s in want for t in set(s))
    lost, room = 0.0, n * spare
    for t in sorted((t for t, k in held.items() if k <= spare), key=lambda t: -weight[t] / held[t]):
        lost += weight[t] * min(1.0, room / held[t])
        room -= held[t]
        if room <= 0:
            break
    return lost


class Index:
    """Inverted index of items ``(item_id, question terms, answer terms)``.
    ``frequency`` has the number of items of each term, ``total`` the number
    of all items and ``mean`` their mean length in words."""

    def __init__(self, items: list[tuple], frequency: dict[bytes, int], total: int, mean: float):
        self.ids = [i for i, _, _ in items]
        self.number: dict[bytes, int] = {}
        self.parts = []
        self.longest = 1
        postings = []
        for j, (_, question, answer) in enumerate(items):
            bag = Counter(question + answer)
            length = sum(bag.values())
            self.longest = max(self.longest, length)
            weight = {}
            for t, tf in bag.items():
                idf = np.log(1 + (total - frequency[t] + 0.5) / (frequency[t] + 0.5))
                weight[t] = float(idf * tf * (_K1 + 1) / (tf + _K1 * (1 - _B + _B * length / mean)))
            whole = sum(weight.values())
            postings += [(self.number.setdefault(t, len(self.number)), j, w / whole) for t, w in weight.items()]
            self.parts.append(tuple([self.number[t] for t in part] for part in (question, answer)))
        postings.sort()
        self.width = max(1, -(-len(items) // BLOCKS))  # items in a block
        term, item, impact = (np.array(x) for x in zip(*postings))
        block = item // self.width
        self.item, self.impact = item.astype(np.int32), impact
        # where the postings of a term in a block begin, and their largest impact
        self.begin = np.searchsorted(term * (BLOCKS + 1) + block,
                                     np.arange(len(self.number) * (BLOCKS + 1))).reshape(-1, BLOCKS + 1).astype(np.int32)
        self.block_max = np.zeros((len(self.number), BLOCKS), np.float32)
        np.maximum.at(self.block_max, (term, block), impact.astype(np.float32))
        self.upper = self.block_max.max(axis=1)
        self._reach: dict[tuple[float, float], tuple[np.ndarray, ...]] = {}

    def reach(self, threshold: float, overlap: float) -> tuple[np.ndarray, ...]:
        """The scores from which items are retrieved to be verified, and the
        impacts, block maxima and upper bounds that reach ``threshold`` there."""
        if (threshold, overlap) not in self._reach:
            size = self.begin[:, -1] - self.begin[:, 0]
            term = np.repeat(np.arange(len(size)), size)
            weight: list[dict[int, float]] = [{} for _ in self.parts]
            for t, j, w in zip(term.tolist(), self.item.tolist(), self.impact.tolist()):
                weight[j][t] = w
            least = np.empty(len(self.parts))
            for j, (w, (question, answer)) in enumerate(zip(weight, self.parts)):
                lost = max(_most_lost(question, w, overlap) + _most_lost(answer, w, overlap), _most_lost(question + answer, w, overlap))
                least[j] = min(threshold, max(1 - lost, min(w.values()))) * (1 - 1e-9)
            impact = self.impact * (threshold / least)[self.item]
            block_max = np.zeros_like(self.block_max)
            np.maximum.at(block_max, (term, self.item // self.width), impact.astype(np.float32))
            self._reach[threshold, overlap] = least, impact, block_max, block_max.max(axis=1)
        return self._reach[threshold, overlap]

    def encode(self, text: str | None) -> np.ndarray:
        """The terms of a text as numbers (-1: in no item)."""
        terms = terms_of(text)
        return np.fromiter(map(self.number.get, terms, repeat(-1)), np.int64, len(terms))

    def retrieve(self, texts: list[np.ndarray], threshold: float, weights: tuple[np.ndarray, ...] | None = None) -> tuple[np.ndarray, ...]:
        """All items whose score for some passage of the encoded ``texts``
        reaches ``threshold``: text, passage, item and score.  Passage ``p``
        has the words from ``p * longest`` to ``(p + 2) * longest``.  Scores
        are by ``weights`` (impacts, block maxima, upper bounds) if given."""
        impact, block_max, upper = weights or (self.impact, self.block_max, self.upper)
        m, slack = self.longest, 1e-4  # block maxima are rounded to single precision
        none = (np.empty(0, np.int64),) * 3 + (np.empty(0),)
        # Texts one behind the other, each from a multiple of m on and with an empty stretch after it.
        stretches = np.array([-(-len(t) // m) + 1 for t in texts])
        first = np.cumsum(stretches) - stretches
        there = [np.flatnonzero(t >= 0) for t in texts]
        at = np.concatenate([p + f * m for p, f in zip(there, first)]) if texts else none[0]
        if not len(at):
            return none
        term = np.concatenate([t[p] for t, p in zip(texts, there)])
        order = np.argsort(term, kind="stable")
        before = np.full(len(term), -1)  # where the term was last
        same = term[order[1:]] == term[order[:-1]]
        before[order[1:][same]] = at[order[:-1][same]]
        # A term counts once in a passage: where the passage holds it first.
        half = at // m
        owner = np.concatenate([half, half - 1])
        starts = np.zeros(int(stretches.sum()) + 1, bool)
        starts[first] = True
        once = np.concatenate([before < half * m, (before < (half - 1) * m) & ~starts[half]])
        owner, term = owner[once], np.concatenate([term, term])[once]
        bound = np.bincount(owner, upper[term], int(stretches.sum()) + 1)
        hopeful = bound[owner] >= threshold - slack
        owner, term = owner[hopeful], term[hopeful]
        order = np.argsort(owner, kind="stable")
        owner, term = owner[order], term[order]
        out = []
        passages, start = np.unique(owner, return_index=True)
        end = np.append(start[1:], len(owner))
        for k in range(0, len(passages), 256):
            lo, hi = start[k], end[min(k + 256, len(passages)) - 1]
            sums = np.add.reduceat(block_max[term[lo:hi]], start[k:k + 256] - lo, axis=0)
            which, block = np.nonzero(sums >= threshold - slack)
            if not len(which):
                continue
            # Read the postings of these blocks: one row a (passage, block, term), then one a posting.
            n = (end - start)[k + which]
            pair = np.repeat(np.arange(len(which)), n)
            own = term[np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[k + which], n)]
            a, b = self.begin[own, block[pair]], self.begin[own, block[pair] + 1]
            size = b - a
            posting = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(a, size)
            slot = np.repeat(pair, size) * self.width + self.item[posting] % self.width
            score = np.bincount(slot, impact[posting], len(which) * self.width)
            hit = np.flatnonzero(score >= threshold - 1e-9)
            out.append((passages[k + which[hit // self.width]],
                        block[hit // self.width] * self.width + hit % self.width, score[hit]))
        if not out:
            return none
        passage, item, score = (np.concatenate(x) for x in zip(*out))
        text = np.searchsorted(first, passage, "right") - 1
        return text, passage - first[text], item, score

    def matches(self, texts: list[np.ndarray], threshold: float, overlap: float) -> dict[tuple[int, int], tuple]:
        """Verified items: ``(text, item position)`` -> question share, answer
        share, score and minus the first word of the passage, for the verified
        passage with the largest shares."""
        found: dict[tuple[int, int], tuple] = {}
        passage, held = (-1, -1), _Shingles([])
        least, *weights = self.reach(threshold, overlap)
        text, p, item, score = self.retrieve(texts, threshold, tuple(weights))
        hits = sorted(zip(*(x.tolist() for x in (text, p, item, score * least[item] / threshold))))
        for text, p, item, score in hits:
            if passage != (text, p):
                passage, held = (text, p), _Shingles(texts[text][p * self.longest:(p + 2) * self.longest].tolist())
            question, answer = (_share(part, held) for part in self.parts[item])
            if (question >= overlap and answer >= overlap) or _share(sum(self.parts[item], []), held) >= overlap:
                best = (question, answer, score, -p * self.longest)
                found[text, item] = max(found.get((text, item), best), best)
        return found


def _shards(benchmark: DataFrame, threshold: float, overlap: float, id_col: str, text_col: str) -> DataFrame | None:
    """The index of the benchmark, ``shard, index`` (pickled), in shards of about
    :data:`SHARD_BYTES`; None without any item."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).where("text is not null")

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            terms = [terms_of(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(map(len, terms)), pa.int64()),
                 pa.array([list(dict.fromkeys(t)) for t in terms], pa.list_(pa.binary()))], ["item_id", "text", "words", "terms"])

    # Rows are dealt by a number of their own, so that copies of an item are spread as well.
    items = materialize(items.mapInArrow(words_of, "item_id long, text string, words long, terms array<binary>").where(
        "words > 0").withColumn("row", F.monotonically_increasing_id()), "benchmark-items")
    size, total, length = items.agg(F.sum(F.octet_length("text")), F.count("text"), F.sum("words")).first()
    if not total:
        return None
    shards = max(1, -(-size // SHARD_BYTES))
    items = items.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    seen = items.select((F.col("shard") + 0).alias("part"), F.explode("terms").alias("term"))
    frequency = seen.groupBy("term").agg(F.count("part").alias("n"))
    known = seen.distinct().join(frequency, "term")

    def build(rows: pd.DataFrame, terms: pd.DataFrame) -> pd.DataFrame:
        own = [(None if pd.isna(i) else int(i), *question_and_answer(t)) for i, t in
               rows.sort_values(["item_id", "text", "row"])[["item_id", "text"]].itertuples(index=False)]
        own.sort(key=lambda x: len(x[1]) + len(x[2]))
        index = Index(own, dict(zip(map(bytes, terms["term"]), terms["n"])), total, length / total)
        index.reach(threshold, overlap)
        return pd.DataFrame({"shard": rows["shard"].iloc[:1], "index": [pickle.dumps(index)]})

    return materialize(items.select("item_id", "text", "row", "shard").groupBy("shard").cogroup(known.groupBy("part")).applyInPandas(
        build, "shard long, index binary"), "benchmark-index")


def _hits(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.6, overlap: float = 0.8,
          id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs`` (any long columns, then ``text``) and benchmark item that it holds."""
    spark = docs.sparkSession
    keys = docs.columns[:-1]
    schema = ", ".join(f"{k} long" for k in keys) + (
        ", item_id long, score double, question_overlap double, answer_overlap double, passage long")
    out = spark.createDataFrame([], schema)
    shards = _shards(benchmark, threshold, overlap, id_col, text_col)
    # One shard at a time goes through the driver, from the written table to a broadcast.
    sent = [] if shards is None else [
        spark.sparkContext.broadcast(pickle.loads(r["index"])) for r in shards.orderBy("shard").select("index").toLocalIterator()]
    for start in range(0, len(sent), SHARDS_PER_PASS):
        def run(batches: Iterator[pa.RecordBatch], held=sent[start:start + SHARDS_PER_PASS]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                of_row = list(zip(*[batch.column(i).to_pylist() for i in range(len(keys))]))
                whole = batch.column(len(keys)).to_pylist()
                for index in (b.value for b in held):
                    texts = [index.encode(t) for t in whole]
                    rows = [(*of_row[text], index.ids[item], score, q, a, -start) for (text, item), (q, a, score, start)
                            in sorted(index.matches(texts, threshold, overlap).items())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(
                            [*[pa.int64()] * len(keys), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()])],
                        [*keys, "item_id", "score", "question_overlap", "answer_overlap", "passage"])

        out = out.union(docs.mapInArrow(run, schema))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.6, overlap: float = 0.8,
                 id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per document of ``docs`` (``doc_id, text``) and benchmark item
    that it holds: ``doc_id, item_id, score, question_overlap,
    answer_overlap, passage`` (the first word of the passage, counted in
    terms).  One pass over the documents for :data:`SHARDS_PER_PASS` index shards, no shuffle."""
    return _hits(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark, threshold, overlap, id_col, text_col)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns kept.
    Rows that share a ``doc_id`` are one document; a row with a null
    ``doc_id`` is known by 96 bits of its text."""
    unnamed = F.col("doc_id").isNull()
    keys = {"a": F.when(unnamed, F.xxhash64("text")), "b": F.when(unnamed, F.crc32("text"))}
    # Written first, so that its size is known when the join is planned.
    leaks = materialize(_hits(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[c.alias(k) for k, c in keys.items()], "text"),
                              benchmark, **how).select("doc_id", *keys).distinct(), "leaks")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id"), *[c.alias(k) for k, c in keys.items()])
    same = [rows[k].eqNullSafe(leaks[k]) for k in ("doc_id", *keys)]
    return rows.join(leaks, same, "left_anti").select(*[F.col("row")[c].alias(c) for c in docs.columns])
