"""Exact word, symbol and repetition counts of whole texts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actlens.llm.batches import slices, words

#: The characters counted as symbols.
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\v\f\r"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_stops", "n_upper_words", "n_symbol_words")


def repeated_words(tokens: list, width: int = 3) -> int:
    """Words inside a window of ``width`` words that occurs twice or more in
    ``tokens`` (its first occurrence included)."""
    n = len(tokens) - width + 1
    if n < 2:
        return 0
    number: dict = {}
    ids = np.fromiter([number.setdefault(w, len(number)) for w in tokens], np.int64, len(tokens))
    if len(number) == len(tokens):
        return 0
    # Number the windows exactly, one word more at a time.
    code = ids
    for k in range(1, width):
        code = code[: len(ids) - k] * len(number) + ids[k:]
        if k < width - 1 and len(number) > 2_000_000:
            code = np.unique(code, return_inverse=True)[1]
    _, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    covered = np.zeros(len(tokens), bool)
    for k in range(width):
        covered[k:k + n] |= again
    return int(covered.sum())


def counts_of(text: str | None) -> tuple[int, ...]:
    """The values of :data:`COUNTS` for one text (null: all zero)."""
    if not text:
        return (0,) * len(COUNTS)
    tokens = words(text)
    n_symbols = sum(map(text.count, SYMBOLS))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(_SPACES):
            dup += line in seen
            seen.add(line)
    stops = text.count(".") + text.count("!") + text.count("?")
    upper = sum(map(bytes.isupper, tokens))
    marked = sum(n for w, n in Counter(w[-1:] for w in tokens).items() if w in b"#*$%&|<>!") if tokens else 0
    return (len(tokens), len(text) - sum(map(text.count, _SPACES)), n_symbols, dup, repeated_words(tokens),
            stops, upper, marked)


def with_counts(docs: DataFrame, text_col: str = "text", whole: bool = False) -> DataFrame:
    """``doc_id`` and :data:`COUNTS` (long) of every row; one pass, no shuffle.
    With ``whole`` the row itself comes instead of ``doc_id``, as struct ``row``."""
    chosen = docs.select(F.struct(*docs.columns).alias("row")) if whole else docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    name = chosen.columns[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if whole:
            batches = (pa.RecordBatch.from_arrays([b.column(0), b.column(0).field(text_col)], [name, "text"]) for b in batches)
        for batch in slices(batches, "text"):
            rows = [counts_of(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(c), pa.int64()) for c in zip(*rows))], [name, *COUNTS])

    return chosen.mapInArrow(run, T.StructType([chosen.schema[0], *[T.StructField(c, T.LongType()) for c in COUNTS]]))
