"""SimHash near-duplicates with bit-sliced comparison.

*Fingerprint*: the text in lower case (A-Z only), its words and shingles of
``width`` words joined by blanks, repeats included (fewer words: the whole
sequence; none: fingerprint zero); each bit is set if it is set in over half
of the shingles' XXH64 values (seed 42).

*Candidates*: 64 bits are cut into ``radius + spare`` blocks; two fingerprints
that differ in at most ``radius`` bits agree on some ``spare`` of the blocks,
so they meet in the table that is keyed by those blocks.  Only distinct
fingerprints are compared.

*Comparison*: the fingerprints that share a key are stored as vertical bit
planes, 64 fingerprints to a machine word for each bit.  Distances to a query
are counted for all lanes at once with carry-save adders; words in which every
lane has exceeded the radius are abandoned.  Within a key only a spanning
forest of links is emitted, not all pairs.  A key with many fingerprints is
cut into parts of ``CELL``, and each pair of parts is compared in a task's
step of its own, so no task holds more than two parts.

*Groups*: connected components over the links (:mod:`.components`).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actlens.llm.batches import slices, words
from actlens.llm.components import components
from actlens.sources.scratch import materialize

CELL = 4096
#: Keys with up to so many fingerprints are compared by shifting the planes.
SMALL = 48
_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, width: int = 4) -> int:
    """The 64-bit SimHash of one text (null: as empty)."""
    tokens = words(text)
    if not tokens:
        return 0
    joined = b" ".join(tokens).lower()
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(width, len(tokens))
    spans = zip(starts[: len(tokens) - k + 1].tolist(), ends[k - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], 42) for a, b in spans], "<u8")
    columns = h.view(np.uint8).reshape(-1, 8)
    count = np.concatenate([np.bincount(columns[:, j], minlength=256) @ _BITS_OF_BYTE for j in range(8)])
    return int(np.packbits(2 * count > len(h), bitorder="little").view("<u8")[0])


def planes(prints: np.ndarray) -> np.ndarray:
    """Bit planes of fingerprints: row ``b``, word ``w`` holds bit ``b`` of
    fingerprints ``64 w`` to ``64 w + 63``."""
    padded = np.zeros(-(-len(prints) // 64) * 64, "<u8")
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(bits.T.copy(), axis=1, bitorder="little").view("<u8")


def lanes(flags: np.ndarray) -> np.ndarray:
    """Pack booleans into words, one bit a lane; lanes past the end are set to false."""
    padded = np.zeros(-(-len(flags) // 64) * 64, bool)
    padded[: len(flags)] = flags
    return np.packbits(padded, bitorder="little").view("<u8")


def unpacked(mask: np.ndarray) -> np.ndarray:
    """The booleans of packed lanes, along the last axis."""
    return np.unpackbits(np.ascontiguousarray(mask).view(np.uint8), axis=-1, bitorder="little").astype(bool)


def within(left: np.ndarray, right: np.ndarray, exceeded: np.ndarray, radius: int) -> np.ndarray:
    """Lanes in which ``left`` and ``right`` differ in at most ``radius`` bits.

    ``left`` and ``right`` are planes, 64 by the shape of ``exceeded`` (or
    broadcast to it); ``exceeded`` has the lanes that need not be looked at.
    The last axis counts words; columns of words are abandoned once all their
    lanes have exceeded the radius."""
    out = exceeded.copy()
    live = np.flatnonzero((exceeded != _ALL).any(axis=tuple(range(exceeded.ndim - 1))))
    over = exceeded[..., live]
    pick = lambda p, keep: p if p.shape[-1] == 1 else p[..., keep]
    left, right = pick(left, live), pick(right, live)
    digits = [np.zeros_like(over) for _ in range(max(1, radius.bit_length()))]
    for b in range(64):
        carry = left[b] ^ right[b]
        for i, digit in enumerate(digits):
            digits[i], carry = digit ^ carry, digit & carry
        over = over | carry
        if b % 8 == 7:
            more, same = np.zeros_like(over), np.full_like(over, _ALL)
            for i in reversed(range(len(digits))):
                if radius >> i & 1:
                    same &= digits[i]
                else:
                    more |= same & digits[i]
                    same &= ~digits[i]
            over = over | more
            keep = (over != _ALL).any(axis=tuple(range(over.ndim - 1)))
            if not keep.all():
                out[..., live[~keep]] = _ALL
                live, over = live[keep], over[..., keep]
                digits = [d[..., keep] for d in digits]
                left, right = pick(left, keep), pick(right, keep)
                if not len(live):
                    break
    out[..., live] = over
    return ~out


def _masks(prints: np.ndarray) -> np.ndarray:
    """For each bit and query, a word of all ones where the bit is set: 64 x queries x 1."""
    bits = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.where(bits.T.astype(bool), _ALL, np.uint64(0))[:, :, None]


def forest(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions) that connect the same groups as all links among
    distinct ``prints`` would: at most one less than there are prints."""
    n = len(prints)
    every = planes(prints)
    outside = ~lanes(np.ones(n, bool))
    linked = np.zeros(n, bool)
    for at in range(0, n, 64):  # prints with no neighbour go first
        here = np.arange(at, min(at + 64, n))
        own = np.repeat(outside[None], len(here), axis=0)
        own[here - at, here // 64] |= np.uint64(1) << (here % 64).astype(np.uint64)
        close = within(every[:, None, :], _masks(prints[here]), own, radius)
        linked[here] = close.any(axis=1)
    a, b = [], []
    rest = np.flatnonzero(linked)
    while len(rest):
        own, left = planes(prints[rest]), np.ones(len(rest), bool)
        queue = [0]
        left[0] = False
        while queue:
            some, queue = queue[:64], queue[64:]
            close = unpacked(within(own[:, None, :], _masks(prints[rest[some]]), np.repeat(~lanes(left)[None], len(some), 0),
                                    radius))[:, : len(rest)]
            new = np.flatnonzero(close.any(axis=0))
            if len(new):
                a.append(rest[np.array(some)[close[:, new].argmax(axis=0)]])
                b.append(rest[new])
                left[new] = False
                queue.extend(new.tolist())
                if left.sum() == 0:
                    break
        rest = rest[left]
    none = np.empty(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def links_in(cell: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions) among rows that are sorted by ``cell`` and share it."""
    starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    sizes = np.diff(np.append(starts, len(cell)))
    a, b = [], []
    for start, size in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
        x, y = forest(prints[start:start + size], radius)
        a.append(x + start)
        b.append(y + start)
    small = np.repeat((sizes <= SMALL) & (sizes > 1), sizes)
    rows = np.flatnonzero(small)
    if len(rows):
        group, own = cell[rows], prints[rows]
        flat = planes(own)
        flat = np.concatenate([flat, np.zeros((64, 1), "<u8")], axis=1)
        for shift in range(1, int(sizes[sizes <= SMALL].max())):
            same = np.zeros(len(rows), bool)
            same[:-shift] = group[shift:] == group[:-shift]
            if not same.any():
                break
            # lane i beside lane i + shift (shift < 64): move the planes by that many lanes
            moved = (flat[:, :-1] >> np.uint64(shift)) | (flat[:, 1:] << np.uint64(64 - shift))
            hit = np.flatnonzero(unpacked(within(flat[:, :-1], moved, ~lanes(same), radius))[: len(rows)])
            a.append(rows[hit])
            b.append(rows[hit + shift])
    none = np.empty(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed long) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            fp = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def _tables(radius: int, spare: int) -> list[int]:
    """Bit masks (signed) of the choices of ``spare`` among ``radius + spare`` blocks."""
    n = radius + spare
    edges = [64 * i // n for i in range(n + 1)]
    block = [((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in range(n)]
    masks = [sum(block[i] for i in chosen) for chosen in combinations(range(n), spare)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def link(distinct: DataFrame, radius: int = 4, spare: int = 2) -> DataFrame:
    """Links ``a, b`` between the ``node`` values of distinct fingerprints
    (``fp, node``) that differ in at most ``radius`` bits: a table whose
    connected components are those of all such links."""
    masks = F.array(*[F.lit(m) for m in _tables(radius, spare)])
    keyed = distinct.select("fp", "node", F.posexplode(masks).alias("t", "mask")).select(
        "fp", "node", F.xxhash64("t", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"))
    shared = materialize(keyed.groupBy("key").agg(F.count("fp").alias("n")).where("n > 1"), "shared-keys")
    parts = F.ceil(F.col("n") / CELL).cast("int")
    mine = F.pmod(F.xxhash64("fp"), parts).cast("int")
    cells = keyed.join(shared, "key").select(
        "key", "fp", "node", mine.alias("mine"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
    cells = cells.select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("cell"), "fp", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        def out(rows):
            cell, fp, node = rows
            x, y = links_in(cell, fp.view(np.uint64), radius)
            return pa.RecordBatch.from_arrays([pa.array(node[x]), pa.array(node[y])], ["a", "b"])

        for batch in batches:
            rows = [batch.column(i).to_numpy() for i in range(3)]
            rows = rows if held is None else [np.concatenate(x) for x in zip(held, rows)]
            cut = int(np.searchsorted(rows[0], rows[0][-1]))  # the last cell may go on in the next batch
            held = [x[cut:] for x in rows]
            if cut:
                yield out([x[:cut] for x in rows])
        if held is not None:
            yield out(held)

    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a long, b long").distinct()


def _grouped(docs: DataFrame, radius: int = 4, width: int = 4, spare: int = 2) -> tuple[DataFrame, DataFrame]:
    """(``doc_id, fp`` of every row; ``fp, part, component_id`` of every fingerprint).

    Fingerprints are the nodes, whoever has them, so those that only rows without an
    id have are linked and bridge like others.  ``part`` is the smallest
    fingerprint of the component, ``component_id`` the smallest ``doc_id`` in it, if any."""
    prints = materialize(fingerprints(docs, width), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    groups = components(link(distinct.select("fp", F.col("fp").alias("node")), radius, spare))
    placed = distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("part"))
    placed = materialize(placed, "parts")
    # Written before they are joined back: a component with most fingerprints can then be split.
    ids = materialize(placed.groupBy("part").agg(F.min("least").alias("component_id")), "components")
    return prints, placed.join(ids, "part").select("fp", "part", "component_id")


def near_duplicates(docs: DataFrame, radius: int = 4, width: int = 4, spare: int = 2) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id``, the
    smallest ``doc_id`` reachable over links of at most ``radius`` differing
    bits (the document itself included), for every row of ``docs``.

    Null and empty texts have fingerprint zero and are linked like others, texts of any
    length are hashed whole, and repeated rows get the same result each.
    Rows with a null ``doc_id`` are linked and bridge like others; where no row of a
    component has an id, its ``component_id`` is null.  An empty table gives an
    empty one; other columns are not read."""
    prints, of_print = _grouped(docs, radius, width, spare)
    return prints.join(of_print, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, radius: int = 4, width: int = 4, spare: int = 2) -> DataFrame:
    """One document of each component of :func:`near_duplicates`, all columns as they
    are: the one with the smallest ``doc_id``.  Rows that share that ``doc_id`` are one document,
    of which the first row in text order stays.  Rows without an id go where a row with one is
    in the component; else the one whose text has the smallest hash stays."""
    prints, of_print = _grouped(docs, radius, width, spare)
    first = prints.join(of_print, "fp").where("doc_id = component_id").groupBy("doc_id").count()
    kept = docs.join(first.where("count = 1"), "doc_id", "left_semi")
    in_text_order = F.struct(*[F.col(c) for c in sorted(docs.columns, key=lambda c: c != "text")])
    repeated = docs.join(first.where("count > 1"), "doc_id", "left_semi").groupBy("doc_id").agg(
        F.min(in_text_order).alias("row"))
    unnamed, text_hash = docs.where("doc_id is null"), F.xxhash64("text")
    of_text = fingerprints(unnamed.select(text_hash.alias("doc_id"), "text"), width).distinct()
    alone = of_text.join(of_print.where("component_id is null"), "fp").groupBy("part").agg(F.min("doc_id").alias("_text"))
    unnamed = unnamed.select(text_hash.alias("_text"), in_text_order.alias("row")).join(
        alone.select("_text"), "_text", "left_semi").groupBy("_text").agg(F.min("row").alias("row"))
    whole = [F.col("row")[c].alias(c) for c in docs.columns]
    return kept.unionByName(repeated.select(*whole)).unionByName(unnamed.select(*whole))
