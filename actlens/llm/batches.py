"""Helpers shared by the text operators: words, bounded caches, Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash


def words(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` as UTF-8 (null: none).

    ``bytes.split`` cuts at exactly the six ASCII spaces, where ``str.split``
    would also cut at no-break spaces and other Unicode separators."""
    return text.encode().split() if text else []


#: White space other than blank and line feed (and the separators U+001C-1F).
_ODD_SPACE = re.compile("[\t\v\f\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")


def plain_spacing(text: str) -> bool:
    """Whether every white space is one blank or line feed between other characters."""
    return not ("  " in text or " \n" in text or "\n " in text or "\n\n" in text
                or text[0] in " \n" or text[-1] in " \n" or _ODD_SPACE.search(text))


class BoundedCache(dict):
    """A memo of ``make(key)`` with at most ``2 * limit`` entries, so that a
    worker's memory stays bounded whatever it reads.  When ``limit`` new
    entries have come together, those not used since the last time go."""

    def __init__(self, make: Callable, limit: int = 100_000):
        super().__init__()
        self._make, self._limit, self._older = make, limit, {}

    def __missing__(self, key):
        value = self._older.get(key)
        if value is None:
            value = self._make(key)
        if len(self) >= self._limit:
            self._older = dict(self)
            self.clear()
        self[key] = value
        return value


#: 64-bit hash of a word, remembered.
WORD_HASH = BoundedCache(xxhash.xxh64_intdigest)


def slices(batches: Iterator[pa.RecordBatch], column: str, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that what one step holds as Python objects is
    about ``rows`` documents, and a very long text comes alone."""
    limit = 4 << 20
    at = None
    for batch in batches:
        at = batch.schema.get_field_index(column) if at is None else at
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if i > start and (held + n > limit or i - start >= rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start)
