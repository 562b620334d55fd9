"""Session ranks and time-ordered action sequences (WN1-WN5).

Events are ordered by (time, event key), so equal times still give one stable
order.  The event sequence is in long form, a row per event, whatever a
session's size; a text sequence is built in consecutive segments of a size that
the caller names, so that no row or task has to hold an unbounded session.
Nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actlens.functions import labels as L
from actlens.functions.exprs import count_of
from actlens.operators.ordinal import group_in_ranges, ordinal_within, rank_within

SESSION = ("session_id", "user_id")
ORDER = ("time",)
TIEBREAK = ("event_id",)


def _tiebreak(df: DataFrame, used: Sequence[str]) -> tuple:
    """Order within equal times: the event key when the frame has one, else
    the remaining columns -- rows equal on all of them are indistinguishable,
    so any order among them gives the same result."""
    if all(c in df.columns for c in TIEBREAK):
        return TIEBREAK
    return tuple(c for c in df.columns if c not in used)


def session_rank(df: DataFrame, keys: Sequence[str] = ("session_id",)) -> DataFrame:
    """WN1: rank of each event in its session by time; equal times share."""
    return rank_within(df, keys, ORDER, _tiebreak(df, (*keys, *ORDER)), "action_rank")


def session_position(df: DataFrame, keys: Sequence[str] = ("session_id",)) -> DataFrame:
    """WN2: unique 1-based position of each event in its session."""
    return ordinal_within(df, keys, ORDER + _tiebreak(df, (*keys, *ORDER)), "rn")


def _numbered(df: DataFrame, keep_range: bool = False) -> DataFrame:
    tiebreak = TIEBREAK if all(c in df.columns for c in TIEBREAK) else ()
    df = df.select(*SESSION, *ORDER, *tiebreak, "action")
    return ordinal_within(df, SESSION, ORDER + _tiebreak(df, (*SESSION, *ORDER)), "position", keep_range=keep_range)


def session_events(df: DataFrame) -> DataFrame:
    """WN3: the ordered events of each (session, user), one row per event:
    ``session_id, user_id, position, time, action``."""
    return _numbered(df).select(*SESSION, "position", "time", "action")


def session_sequences(df: DataFrame, segment_size: int, sep: str = L.SEQUENCE_SEP) -> DataFrame:
    """WN4: ``view → cart → ...`` per (session, user), in time order, in
    segments of at most ``segment_size`` events: ``session_id, user_id,
    segment`` (from 0), ``first_position`` and ``action_sequence``.  A session
    of at most ``segment_size`` events is one row; the segments of a longer
    one, joined by ``sep`` in order, are its whole sequence.

    The events of a segment are joined inside the ranges in which they were
    numbered, without a shuffle; only these pieces, one row per segment and range, are
    shuffled and joined to whole segments."""
    if segment_size < 1:
        raise ValueError("segment_size must be at least 1")
    rows = _numbered(df, keep_range=True).withColumn("segment", F.expr(f"(position - 1) div {int(segment_size)}"))

    def joined(entries: str, text: str):
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(entries, text))), lambda e: e[text]), sep)

    pieces = group_in_ranges(rows, [*SESSION, "segment"], F.min("position").alias("first_position"),
                             joined("position", "action").alias("piece"))
    return pieces.groupBy(*SESSION, "segment").agg(
        F.min("first_position").alias("_first"), joined("first_position", "piece").alias("action_sequence")).select(
        *SESSION, "segment", F.col("_first").alias("first_position"), "action_sequence")


def complete_sessions(df: DataFrame, match: str = "exact") -> DataFrame:
    """WN5: sessions holding a view, a cart and a purchase, in any order.

    ``match='exact'`` compares whole action names; ``'substring'`` keeps the
    looser test of searching the names inside the sequence text (an action
    ``review`` then counts as a view).  A two-phase aggregate: no sequence is
    materialised."""
    if match == "exact":
        has = [count_of(a) > 0 for a in L.ACTIONS]
    elif match == "substring":
        has = [F.count_if(F.col("action").contains(a)) > 0 for a in L.ACTIONS]
    else:
        raise ValueError(f"match must be 'exact' or 'substring', not {match!r}")
    flags = df.groupBy(*SESSION).agg(*[h.alias(f"_h{i}") for i, h in enumerate(has)])
    return flags.filter(F.col("_h0") & F.col("_h1") & F.col("_h2")).select(*SESSION)


def complete_session_count(df: DataFrame, match: str = "exact") -> DataFrame:
    """WN5: the number of complete sessions, as a one-row frame."""
    return complete_sessions(df, match).agg(F.count(F.lit(1)).alias("complete_sessions"))
