"""Byte-level BPE encoding and decoding.

A text is cut into pieces by the tokenizer's pattern, and each piece is
encoded on its own.  Instead of merging pairs again and again, a piece is read
from left to right: take the longest token that starts here, keep it if it
can stand next to the token before it, else try the next shorter token, and
step back when none is left.  Positions that turned out to be dead ends are
remembered, and whether two tokens can stand side by side is decided once and
remembered, so the time is linear in the piece.  The result is the one that
the merges give:

* ``split`` -- every token is the merge of exactly two lower tokens (the last
  merge made when the token's own bytes are encoded).  A token that its own
  bytes do not merge into is only produced when it is a whole piece.
* two tokens are compatible if undoing their merges, latest first, never
  exposes a pair across the border that would have been merged earlier.

Bytes are mapped to Latin-1 characters, and the tokens are the words of a
pyahocorasick trie: its leftmost longest matches are the first way that is tried, in
one call; only where two of them cannot stand side by side does the reading above begin, and
then the longest known prefix, shortened to the next token,
gives the longest token that starts at a position.

That pair compatibility decides a merge order's result, and the backtracking over it,
follow the published linear-time BPE method (H. van Antwerpen and A. Neubeck, "So many
tokens, so little time", 2024).

Empty and null texts give no tokens; a null text counts as empty.  Texts of
any length are encoded whole.  Repeated rows give a row each, an empty table an empty one.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

from actlens.llm.batches import BoundedCache, plain_spacing, slices

#: Fixed value: the split pattern for which words may be cut out at blanks and line feeds.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Words whose ids are remembered (at most twice as many are held at a time).
MEMO = 450_000


class ByteBPE:
    """Encoder and decoder for a rank file (base64 token, rank; one a line).

    The file is read once in each Python worker; it must be at ``path`` on
    every node, as installed packages are.  ``memo`` bounds the words whose ids are
    remembered; it has no influence on results."""

    def __init__(self, path: str, pattern: str, memo: int = MEMO):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        # Tokens are numbered single bytes first, then by rank: the order of merging.
        order = sorted(self.rank, key=lambda t: (len(t) > 1, self.rank[t]))
        number = {t: i for i, t in enumerate(order)}
        self._id = [self.rank[t] for t in order]
        self._length = [len(t) for t in order]
        self.bytes_of = dict(zip(self._id, order))
        #: Each id as int32 and as decimal digits.
        self._four = {i: array("i", [i]).tobytes() for i in self._id}
        self.digits = {i: b"%d" % i for i in self._id}
        self._left, self._right, self._pair = list(range(len(order))), list(range(len(order))), {}
        usable = set()
        for i, t in enumerate(order):
            if len(t) > 1:
                parts = [number[x] for x in self._merged(t, i, number)]
                if len(parts) != 2:
                    continue
                self._left[i], self._right[i] = parts
                self._pair[tuple(parts)] = i
            usable.add(t)
        self._shorter = [
            next((number[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in usable), -1) for t in order
        ]
        self._token = {t.decode("latin-1"): number[t] for t in usable}
        self._whole = {t.decode("latin-1"): [i] for t, i in self.rank.items()}
        self._trie = ahocorasick.Automaton()
        for t, i in self._token.items():
            self._trie.add_word(t, i)
        self._trie.make_automaton()
        self._reach = max(self._length)
        self._by_words = pattern == WORD_PATTERN
        self._fits = BoundedCache(lambda pair: self._compatible(*pair), memo)
        # Ids packed as int32, four bytes each.
        self._piece = BoundedCache(lambda piece: self._pack(self.encode_piece(piece.encode())), memo // 4)
        self._bare = BoundedCache(self._pieces, memo // 4)
        self._spaced = BoundedCache(self._word, memo)

    @staticmethod
    def _merged(piece: bytes, below: int, number: dict[bytes, int]) -> list[bytes]:
        """Merge ``piece`` by the tokens numbered under ``below``, lowest first."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = min((number.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
            if best >= below:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _compatible(self, first: int, second: int) -> bool:
        limit = len(self._id)
        while True:
            if self._pair.get((first, second), limit) < limit:
                return False
            if first > second:
                limit, first = first, self._right[first]
                if first == limit:  # a single byte: go on undoing the other side
                    limit, second = second + 1, self._left[second]
                    if second + 1 == limit:
                        return True
            else:
                limit, second = second + 1, self._left[second]
                if second + 1 == limit:
                    limit, first = first, self._right[first]
                    if first == limit:
                        return True

    def _longest(self, piece: str, at: int) -> int:
        """The longest token that starts at ``at``."""
        ahead = piece[at:at + self._reach]
        ahead = ahead[:self._trie.longest_prefix(ahead)]
        while ahead not in self._token:
            ahead = ahead[:-1]
        return self._token[ahead]

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        return self._encode(piece.decode("latin-1"))

    def _encode(self, chars: str) -> list[int]:
        """The ids of one piece, whose bytes are given as Latin-1 characters."""
        whole = self._whole.get(chars)
        if whole is not None or not chars:
            return whole or []
        n, length, fits, longest = len(chars), self._length, self._fits, self._longest
        # Mostly the longest tokens, one after the other, can all stand side by side ...
        first = [token for _, token in self._trie.iter_long(chars)]
        side = list(map(fits.__getitem__, zip(first, first[1:])))
        if False not in side:
            return [self._id[t] for t in first]
        # ... and where two cannot, the reading goes on from there, token by token.
        out = first[:side.index(False) + 1]
        token, at = first[len(out)], sum([length[t] for t in out])
        dead = set()
        while True:
            end = at + length[token]
            if end not in dead and (not out or fits[out[-1], token]):
                out.append(token)
                if end == n:
                    return [self._id[t] for t in out]
                at, token = end, longest(chars, end)
            elif self._shorter[token] >= 0:
                token = self._shorter[token]
            else:  # nothing that starts here follows on: the position is a dead end
                dead.add(at)
                token = out.pop()
                at -= length[token]

    def _pack(self, ids: list[int]) -> bytes:
        return b"".join([self._four[i] for i in ids])

    def _pieces(self, text: str) -> bytes:
        return b"".join([self._piece[p] for p in self.pattern.findall(text)])

    def _word(self, word: str) -> bytes:
        """The ids of a word and the blank before it.  Letters, and letters
        with a mark behind, need no search for the pattern."""
        if word.isalpha():
            return self._pack(self._encode(" " + (word if word.isascii() else word.encode().decode("latin-1"))))
        head, last = word[:-1], word[-1:]
        if last in ".,;:!?" and head.isalpha():
            return self._spaced[head] + self._piece[last]
        return self._pieces(" " + word)

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of ``text`` as int32.

        Where every white space is a single blank or line feed between other
        characters, no piece of :data:`WORD_PATTERN` reaches from one blank-separated word into
        the next, so words (with the blank before them) are encoded and remembered
        as a whole; any other text, and any text under another pattern, goes
        through the pattern directly."""
        if not text:
            return np.empty(0, np.int32)
        if not self._by_words or not plain_spacing(text):
            return np.frombuffer(self._pieces(text), np.int32)
        out = []
        for i, line in enumerate(text.split("\n")):
            if i:
                out.append(self._piece["\n"])
            head, *rest = line.split(" ")
            out.append(self._bare[head])
            out.extend(map(self._spaced.__getitem__, rest))
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=4)
def tokenizer(path: str, pattern: str, memo: int = MEMO) -> ByteBPE:
    """The tokenizer of a rank file, built once per Python process."""
    return ByteBPE(path, pattern, memo)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(x) for x in arrays], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else [], pa.int32()))


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """Replace ``text_col`` by the array ``ids_col`` of token ids; the other
    columns stay.  One pass over the rows, no shuffle.  An ``ids_col`` that
    is already there is replaced."""
    keep = [c for c in docs.columns if c not in (text_col, ids_col)]
    schema = docs.select(*keep).withColumn(ids_col, F.lit(None).cast("array<int>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path, pattern)
        for batch in slices(batches, text_col):
            ids = [bpe.encode(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], _lists(ids)], [*keep, ids_col])

    return docs.select(*keep, text_col).mapInArrow(run, schema)


def decode(ids_col, path: str, pattern: str):
    """Column expression: the bytes that an array of token ids stands for (null: null)."""

    @arrow_udf("binary")
    def run(ids: pa.Array) -> pa.Array:
        bpe = tokenizer(path, pattern)
        return pa.array([None if x is None else bpe.decode(x) for x in ids.to_pylist()], pa.binary())

    return run(ids_col)


def digests(docs: DataFrame, path: str, pattern: str, with_ids: bool = False, memo: int = MEMO) -> DataFrame:
    """Encode ``text``, decode the ids again, and return per document
    ``doc_id, n_tokens, ids_sha256`` (of the decimal ids joined by commas),
    ``decoded_sha256`` (of the decoded bytes) and, if asked for, ``token_ids``.
    One pass in one Python worker, which so holds one tokenizer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path, pattern, memo)
        for batch in slices(batches, "text"):
            ids, of_ids, of_bytes = [], [], []
            for text in batch.column(1).to_pylist():
                ids.append(bpe.encode(text))
                own = ids[-1].tolist()
                of_ids.append(sha256(b",".join(map(bpe.digits.__getitem__, own))).hexdigest())
                of_bytes.append(sha256(bpe.decode(own)).hexdigest())
            columns = [batch.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array(of_ids, pa.string()),
                       pa.array(of_bytes, pa.string()), *([_lists(ids)] if with_ids else [])]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * with_ids
    names = [c.split()[0] for c in schema.split(", ")]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
