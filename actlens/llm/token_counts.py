"""Token counts with a whole-token shortcut.

Counting needs no ids.  Before any text is read, :func:`prove` shows for every
vocabulary string whether it encodes alone as one token: it has to be a single
piece of the tokenizer's pattern, and its merges, made in order from its
bytes, have to end in one symbol.  While texts are read, a piece that is such a
string counts one, and only the other pieces are merged (their counts are
remembered, at most a fixed number of them).  Nothing is shuffled.

The tokenizer is a file of the ``tokenizers`` library: byte-level BPE with its
own split pattern.  Results are those of that library's defaults: a special
string inside a text is one token, and the text on both sides of it is cut into
pieces separately.

Defined cases: a null or empty text has no bytes and no tokens; texts of any
length are counted whole (a long piece is merged through a heap); every row
gives a row, repeated rows, rows with equal ids and rows without an id too; an empty
table gives an empty one; other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actlens.llm.batches import BoundedCache, plain_spacing, slices

#: Scripts from U+0530 on have letters that one Unicode version knows and an
#: older one does not; texts with such characters are cut by the library itself.
_NEWER = re.compile("[\u0530-\U0010ffff]")


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable Latin-1 characters for
    themselves, the others by U+0100, U+0101, ... in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Merges:
    """The merge list of a byte-level BPE file and its special strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], spec["pre_tokenizer"]
        odd = [t for t in spec["added_tokens"] if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
        if model["type"] != "BPE" or cut["type"] != "ByteLevel" or not cut.get("use_regex", True) or cut["add_prefix_space"] \
                or spec["normalizer"] or odd or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError(f"{path}: only plain byte-level BPE is counted")
        self.path, self.vocabulary = path, list(model["vocab"])
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self._rank = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self._symbols = byte_symbols()
        self._of_byte = dict(enumerate(self._symbols))
        self.specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)

    def text_of(self, token: str) -> str | None:
        """The text that a vocabulary string stands for; None if its bytes are
        no whole characters."""
        byte = {c: b for b, c in enumerate(self._symbols)}
        try:
            return bytes(byte[c] for c in token).decode()
        except (KeyError, UnicodeDecodeError):
            return None

    def count(self, piece: str) -> int:
        """Tokens of one piece: its bytes, merged pair by pair, lowest rank
        first and leftmost first among equals."""
        parts = list(piece.encode().decode("latin-1").translate(self._of_byte))
        if len(parts) > 64:
            return self._count_long(parts)
        rank, none = self._rank.get, len(self._rank)
        ranks = [rank(p, none) for p in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            parts[i] += parts.pop(i + 1)
            del ranks[i]
            if i:
                ranks[i - 1] = rank((parts[i - 1], parts[i]), none)
            if i < len(ranks):
                ranks[i] = rank((parts[i], parts[i + 1]), none)
        return len(parts)

    def _count_long(self, parts: list[str | None]) -> int:
        """The same with a heap of pairs over a linked list: n log n."""
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, p in enumerate(zip(parts, parts[1:])) if (r := self._rank.get(p)) is not None]
        heapq.heapify(heap)
        left = n
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            # An entry may be out of date: its left symbol gone, or one side changed.
            if parts[i] is None or j >= n or self._rank.get((parts[i], parts[j])) != r:
                continue
            parts[i] += parts[j]
            parts[j] = None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            left -= 1
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (again := self._rank.get((parts[a], parts[b]))) is not None:
                    heapq.heappush(heap, (again, a))
        return left


@lru_cache(maxsize=4)
def merges(path: str) -> Merges:
    """The merge list of a file, read once per Python process (the file must be
    at ``path`` on every node, as installed packages are)."""
    return Merges(path)


@lru_cache(maxsize=4)
def prove(path: str, pattern: str) -> tuple[str, ...]:
    """The texts of all vocabulary strings that encode alone as one token: one
    piece of the pattern, whose merges end in one symbol."""
    own, cut = merges(path), regex.compile(pattern)
    texts = (own.text_of(token) for token in own.vocabulary)
    return tuple(t for t in texts if t and cut.findall(t) == [t] and own.count(t) == 1)


class _Shortcut(BoundedCache):
    """A bounded memo of counts in which the proven strings always stand with 1."""

    def __init__(self, proven: Iterable[str], count: Callable[[str], int], limit: int):
        self._proven = dict.fromkeys(proven, 1)
        super().__init__(count, limit + len(self._proven))
        self.update(self._proven)

    def clear(self) -> None:
        super().clear()
        self.update(self._proven)


class TokenCounter:
    """Counts the tokens of texts, given the proven strings.

    ``memo`` bounds the remembered counts of merged words (at most twice as
    many are held); it has no influence on results."""

    def __init__(self, path: str, pattern: str, proven: Iterable[str], memo: int = 400_000):
        self._merges, self._cut = merges(path), regex.compile(pattern)
        proven = list(proven)
        self._piece = _Shortcut(proven, self._merges.count, memo // 4)
        # A word after a blank is looked up as a whole, so that most words need no pattern.
        self._word = _Shortcut((t[1:] for t in proven if t[0] == " " and len(t) > 1), self._spaced, memo)
        self._bare = BoundedCache(self._pieces, memo // 4)
        self._special = re.compile("|".join(map(re.escape, self._merges.specials))) if self._merges.specials else None
        self._library = None

    def _pieces(self, text: str) -> int:
        return sum(map(self._piece.__getitem__, self._cut.findall(text)))

    def _spaced(self, word: str) -> int:
        """Tokens of a word and the blank before it.  Letters, and letters with a
        mark behind, need no search for the pattern."""
        if word.isalpha():
            return self._merges.count(" " + word)
        head, last = word[:-1], word[-1:]
        if last in ".,;:!?" and head.isalpha():
            return self._word[head] + self._piece[last]
        return self._pieces(" " + word)

    def _by_library(self, text: str) -> int:
        """Pieces as the library cuts them."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self._merges.path).pre_tokenizer
        return sum(self._piece[text[a:b]] for _, (a, b) in self._library.pre_tokenize_str(text))

    def _segment(self, text: str) -> int:
        if not text:
            return 0
        if _NEWER.search(text):
            return self._by_library(text)
        if not plain_spacing(text):
            return self._pieces(text)
        # Every white space is one blank or line feed between other characters:
        # no piece reaches from one blank-separated word into the next.
        lines = text.split("\n")
        total = (len(lines) - 1) * self._piece["\n"]
        for line in lines:
            head, *rest = line.split(" ")
            total += self._bare[head] + sum(map(self._word.__getitem__, rest))
        return total

    def count(self, text: str | None) -> int:
        """Tokens of a whole text (null: 0)."""
        if not text:
            return 0
        if self._special is None or not self._special.search(text):
            return self._segment(text)
        parts = self._special.split(text)
        return len(parts) - 1 + sum(map(self._segment, parts))


def count_tokens(docs: DataFrame, path: str, pattern: str, limit: int = 1024, text_col: str = "text",
                 memo: int = 400_000) -> DataFrame:
    """``doc_id, n_bytes`` (UTF-8), ``n_tokens`` (long) and ``over_limit`` (more
    than ``limit`` tokens) of every row.  One pass over the texts, no shuffle; the
    proven strings, at most the vocabulary, are broadcast."""
    proven = docs.sparkSession.sparkContext.broadcast(prove(path, pattern))
    held: list[TokenCounter] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not held:
            held.append(TokenCounter(path, pattern, proven.value, memo))
        for batch in slices(batches, "text"):
            texts = batch.column(1)
            counts = list(map(held[0].count, texts.to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.fill_null(pc.binary_length(texts).cast(pa.int64()), 0), pa.array(counts, pa.int64()),
                 pa.array([n > limit for n in counts], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
