"""Token counts under a unigram model, by dynamic programming shared over a trie.

A text is cut into pre-tokens. The best segmentation of a pre-token into
vocabulary pieces is a forward recurrence over its bytes, and its value after a
byte depends on the prefix alone. So the distinct pre-tokens form a trie whose
nodes hold that forward value: each shared prefix is scored once, and the value
at a pre-token's terminal node gives its token count, which is kept.

The trie is laid out by sorting the pre-tokens: a row's first ``shared`` bytes are
nodes of rows before it, the rest are its own. Nodes of one depth are scored
together down to depth ``WIDTH``, as arrays; the few deeper ones follow from there in
sorted order, each row going on from the last node it shares with the row before.
A hash finds a piece, its bytes confirm it. The vocabulary is a public byte-level one; its piece scores follow
Zipf's law in the piece's rank, as whole micro-nats, so equal scores are exact
ties and the segmentation with fewer tokens wins. Every single byte is a piece,
so any text has a segmentation. The work is map-only: a task keeps the counts of
at most about ``KEPT`` pre-tokens, then begins anew, which changes no count.
"""

from __future__ import annotations

import base64
import math
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from feedlake.llm.common import slices

# Fixed value: the pre-token pattern of byte-level vocabularies.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts of ASCII characters, where letters and digits need no Unicode tables.
ASCII_PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
KEPT = 400_000
#: Depth of the trie down to which nodes of one depth are scored together.
WIDTH = 32
#: A value is cost * ONE + tokens: sums compare by cost first, then by tokens.
ONE = 1 << 24
NONE = np.int64(1) << np.int64(61)
BASE, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def read_vocabulary(path: str = VOCABULARY) -> dict[bytes, int]:
    """Pieces with their ranks; the file has a base64 piece and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def piece_values(ranks: dict[bytes, int]) -> dict[bytes, int]:
    """Cost of a piece in micro-nats under p(rank) proportional to 1 / (rank + 2.7), and one token."""
    norm = math.log(sum(1 / (r + 2.7) for r in ranks.values()))
    return {piece: round((math.log(r + 2.7) + norm) * 1e6) * ONE + 1 for piece, r in ranks.items()}


def segment(word: bytes, values: dict[bytes, int], longest: int) -> int:
    """Tokens of one pre-token by the plain recurrence."""
    forward = [0]
    for end in range(1, len(word) + 1):
        forward.append(min(forward[start] + value for start in range(max(0, end - longest), end)
                           if (value := values.get(word[start:end])) is not None))
    return forward[-1] % ONE


class Counter(dict):
    """Token counts of the pre-tokens seen; ``learn`` adds new ones by way of a trie."""

    def __init__(self, values: dict[bytes, int]):
        super().__init__()
        self.pieces, self.longest = values, max(map(len, values))
        short = sorted((p for p in values if len(p) <= WIDTH), key=len)
        rows = np.frombuffer(b"".join(p.ljust(WIDTH, b"\0") for p in short), np.uint8).reshape(-1, WIDTH)
        found = self._hash(rows.T)[[len(p) for p in short], np.arange(len(short))]
        order = found.argsort(kind="stable")
        self.keys_, self.values_ = found[order], np.array([values[p] for p in short], np.int64)[order]
        self.bytes_, self.sizes = rows[order], np.array([len(p) for p in short])[order]
        # keys fall evenly: the first one at or after the top 16 bits, then a short walk
        self.first = np.searchsorted(self.keys_, np.arange(1 << 16, dtype=np.uint64) << np.uint64(48))
        self.walk = int(np.diff(np.append(self.first, len(found))).max())
        self.keys_, self.values_ = np.append(self.keys_, np.full(self.walk, ~np.uint64(0))), np.append(self.values_, np.full(self.walk, NONE))
        self.sizes = np.append(self.sizes, np.zeros(self.walk, int))  # no piece has size 0
        self.powers = np.cumprod(np.r_[np.uint64(1), np.full(WIDTH, BASE)], dtype=np.uint64)

    @staticmethod
    def _hash(bytes_: np.ndarray) -> np.ndarray:
        """Hashes of the prefixes of each column, the empty one first."""
        out = np.zeros((bytes_.shape[0] + 1, bytes_.shape[1]), np.uint64)
        for d, row in enumerate(bytes_.astype(np.uint64)):
            out[d + 1] = out[d] * BASE + (row + np.uint64(1)) * SPREAD
        return out

    def _value(self, hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Values of the pieces with these hashes whose bytes are the columns of ``text``; NONE where there is none."""
        at = self.first[hashes >> np.uint64(48)]
        value = np.full(len(hashes), NONE)
        for _ in range(self.walk):
            hit = np.flatnonzero(self.keys_[at] == hashes)
            if len(hit):
                piece = at[hit]
                hit, piece = (x[self.sizes[piece] == len(text)] for x in (hit, piece))
                same = (self.bytes_[piece, :len(text)] == text[:, hit].T).all(axis=1)
                value[hit[same]] = self.values_[piece[same]]
            at = at + 1
        return value

    def learn(self, tokens: set[str]) -> None:
        words = sorted((t.encode(), t) for t in tokens)
        deep = [p for p in words if len(p[0]) > WIDTH]
        # a longer word's first WIDTH bytes are a row too, which no token ends in
        pairs = sorted([p for p in words if len(p[0]) <= WIDTH] + [(w, None) for w in {w[:WIDTH] for w, _ in deep}], key=lambda p: p[0])
        if not pairs:
            return
        length = np.array([len(w) for w, _ in pairs])
        width = int(length.max())
        rows = np.frombuffer(b"".join(w.ljust(width, b"\0") for w, _ in pairs), np.uint8).reshape(len(pairs), width).T.copy()
        hashes = self._hash(rows)
        inside = np.arange(width)[:, None] < length
        same = np.zeros(rows.shape, bool)
        same[:, 1:] = (rows[:, 1:] == rows[:, :-1]) & inside[:, 1:] & inside[:, :-1]
        shared = np.logical_and.accumulate(same, axis=0).sum(axis=0)
        forward = np.zeros(hashes.shape, np.int64)
        row = np.arange(len(pairs))
        for depth in range(1, width + 1):
            own = np.flatnonzero((shared < depth) & (length >= depth))  # the trie's new nodes of this depth
            best = np.full(len(own), NONE)
            end, text = hashes[depth, own], rows[:, own]
            for size in range(1, depth + 1):
                piece = end - hashes[depth - size, own] * self.powers[size]
                best = np.minimum(best, forward[depth - size, own] + self._value(piece, text[depth - size:depth]))
            # a row with shared nodes reads them from the row that owns them
            forward[depth, own] = best
            forward[depth] = forward[depth, np.maximum.accumulate(np.where(shared < depth, row, 0))]
        for (_, token), count in zip(pairs, (forward[length, row] % ONE).tolist()):
            if token is not None:
                self[token] = count
        heads = {w: i for i, (w, token) in enumerate(pairs) if token is None}
        self._deeper(deep, {w: forward[:, i].tolist() for w, i in heads.items()})

    def _deeper(self, words: list[tuple[bytes, str]], heads: dict[bytes, list[int]]) -> None:
        """The nodes below depth WIDTH, in sorted order: ``heads`` has the forward values of the words' first bytes."""
        path, before = [], b""
        for word, token in words:
            if word[:WIDTH] == before[:WIDTH]:
                del path[len(os.path.commonprefix([word, before])) + 1:]
            else:
                path = heads[word[:WIDTH]]
            for end in range(len(path), len(word) + 1):
                path.append(min(path[start] + value for start in range(max(0, end - self.longest), end)
                                if (value := self.pieces.get(word[start:end])) is not None))
            self[token] = path[-1] % ONE
            before = word


def count_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``key, n_pretokens, n_tokens`` for every row; no shuffle.

    A null or empty text has 0 and 0. Rows are counted one by one, so repeated
    rows and null keys each give a row; other columns are ignored. An empty table
    gives no rows. Whole texts are read; the longest text bounds a task's memory.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))  # one vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        find, find_ascii = regex.compile(PRE_TOKEN).findall, re.compile(ASCII_PRE_TOKEN, re.ASCII).findall
        counts = Counter(piece_values(ranks.value))
        for batch in batches:
            for part in slices(batch, text):
                found = [(find_ascii if t.isascii() else find)(t) if t else [] for t in part.column(1).to_pylist()]
                if len(counts) > KEPT:
                    counts.clear()
                counts.learn(set().union(*found) - counts.keys())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(f) for f in found], pa.int64()),
                     pa.array([sum(map(counts.__getitem__, f)) for f in found], pa.int64())],
                    names=[key, "n_pretokens", "n_tokens"])

    picked = docs.select(key, text)
    return picked.mapInArrow(run, f"{key} {picked.schema[0].dataType.simpleString()}, n_pretokens long, n_tokens long")
