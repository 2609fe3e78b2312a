"""Byte-level BPE by a rank queue over a hierarchical bitmap.

The bytes of a pre-token form a linked list of parts. Each pair of neighbours whose
joined bytes have a rank waits in the bucket of that rank. A bitmap of two levels marks
the buckets that hold anything: a bit of the upper one stands for a word of the lower
one, so two find-first-set steps give the lowest rank. A bucket's pairs are joined
from left to right; an entry whose pair has changed since is stale and skipped. Every
join makes at most two new entries, so a pre-token of any length costs about its length.
Many pre-tokens wait in one queue: no pair crosses their borders, so each is joined as
if alone, and they share the search for the lowest rank.

A pre-token that is a piece itself is that one token, as in the public encoders.
Encoding is map-only. A worker keeps the ids of at most twice ``KEPT`` pre-tokens, which
changes no result: those not met again for that long go. One longer than ``LONG`` is not kept.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from feedlake.llm.common import slices
from feedlake.llm.token_counts import read_vocabulary

KEPT = 400_000
LONG = 64
#: Bytes of new pre-tokens in one queue, and characters of texts that are looked through for them at a time.
QUEUE = 1 << 13
AT_ONCE = 1 << 17
ABSENT = -1
#: A word of the bitmap has 256 bits, and its upper level up to as many words.
SHIFT, MASK = 8, 255
BITS = [1 << i for i in range(1 << 12)]
# Code points that became letters or numbers in Unicode 17 and 18. The public encoder's
# tables end at Unicode 16, so it cuts these as other signs.
LATER_LETTERS = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F),
    (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D),
    (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB),
    (0x11DF1, 0x11DF1), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF3), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA),
    (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168),
    (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F),
    (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)
LATER_NUMBERS = ((0x11DE0, 0x11DE9), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16FF4, 0x16FF6))


def splitter(pattern: str):
    """A function that cuts texts by the pattern, with letters and numbers as of Unicode 16."""
    import regex
    spans = {name: "".join(f"\\U{low:08X}-\\U{high:08X}" for low, high in later)
             for name, later in ((r"\p{L}", LATER_LETTERS), (r"\p{N}", LATER_NUMBERS))}
    exact = pattern
    for name, span in spans.items():
        exact = exact.replace(name, f"[{name}--[{span}]]")
    exact, usual = regex.compile(exact, regex.VERSION1).findall, regex.compile(pattern).findall
    later = re.compile(f"[{''.join(spans.values())}]").search
    return lambda text: (exact if later(text) else usual)(text)


def ascii_splitter(pattern: str):
    """The same for texts of ASCII characters, which need no tables."""
    classes = {r"\p{L}": "A-Za-z", r"\p{N}": "0-9"}

    def plain(found: re.Match) -> str:
        piece = found.group()
        if piece in classes:
            return f"[{classes[piece]}]"
        for name, letters in classes.items():
            piece = piece.replace(name, letters)
        return piece
    return re.compile(re.sub(r"\[[^\]]*\]|\\p\{[LN]\}", plain, pattern), re.ASCII)


class Encoder:
    """Ids of pre-tokens by the ranks of a vocabulary that holds every single byte."""

    def __init__(self, ranks: dict[bytes, int]):
        absent = [b for b in range(256) if bytes([b]) not in ranks]
        if absent:
            raise ValueError(f"the vocabulary has no piece for the bytes {absent}")
        self.ranks = ranks
        self.of_byte = [ranks[bytes([b])] for b in range(256)]
        self.words = [0] * ((max(ranks.values()) >> SHIFT) + 1)

        self.of_pair: list[int | None] = [None] * (1 << 16)
        for piece, rank in ranks.items():
            if len(piece) == 2:
                self.of_pair[piece[0] << 8 | piece[1]] = rank

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian unsigned 32-bit integers."""
        out: list[bytes | None] = []
        queue: list[bytes] = []
        places: list[int] = []
        size = 0
        for word in words:
            whole = self.ranks.get(word)
            if whole is None:
                queue.append(word)
                places.append(len(out))
                size += len(word)
            out.append(None if whole is None else struct.pack("<I", whole))
            if size >= QUEUE:
                for at, ids in zip(places, self.merge_all(queue)):
                    out[at] = ids
                queue, places, size = [], [], 0
        for at, ids in zip(places, self.merge_all(queue)):
            out[at] = ids
        return out

    def merge(self, word: bytes) -> list[int]:
        return [rank for rank, in struct.iter_unpack("<I", self.merge_all([word])[0])]

    def merge_all(self, queued: list[bytes]) -> list[bytes]:
        ranks, word = self.ranks.get, b"".join(queued)
        size = len(word)
        parts = [self.of_byte[b] for b in word]  # the rank of the part that begins here
        after = list(range(1, size + 1))         # where it ends
        before = list(range(-1, size))           # where the part before begins, if it is of the same pre-token
        of_pair = self.of_pair                   # the rank of this part joined with the next
        pair = [of_pair[a << 8 | b] for a, b in zip(word, word[1:])]
        pair.append(None)
        before[size], end = -1, 0
        for one in queued:
            before[end] = -1
            end += len(one)
            pair[end - 1] = None
        # the queue: positions by rank, and a bitmap of the ranks that have any; all empty again at the end
        buckets: dict[int, list[int]] = {}
        words, top = self.words, 0

        for at, rank in enumerate(pair):
            if rank is not None:
                if rank in buckets:
                    buckets[rank].append(at)
                else:
                    buckets[rank] = [at]
                    words[rank >> SHIFT] |= BITS[rank & MASK]
                    top |= BITS[rank >> SHIFT]
        while top:
            # the lowest rank that has any: find-first-set in the upper level, then in the word it names
            upper = top & -top
            at_word = upper.bit_length() - 1
            bits = words[at_word]
            lower = bits & -bits
            rank = at_word << SHIFT | lower.bit_length() - 1
            waiting = buckets.pop(rank)
            if len(waiting) > 1:
                waiting.sort()
            low = rank  # the lowest rank that came in while these are joined
            for done, at in enumerate(waiting, 1):
                if pair[at] != rank:
                    continue  # stale: joined or grown since
                middle = after[at]
                end = after[at] = after[middle]
                parts[at] = rank
                pair[at] = pair[middle] = None
                if before[end] >= 0:
                    before[end] = at
                    new = ranks(word[at:after[end]])
                    if new is not None:
                        pair[at] = new
                        if new in buckets:
                            buckets[new].append(at)
                        else:
                            buckets[new] = [at]
                            words[new >> SHIFT] |= BITS[new & MASK]
                            top |= BITS[new >> SHIFT]
                        if new < low:
                            low = new
                left = before[at]
                if left >= 0:
                    pair[left] = new = ranks(word[left:end])
                    if new is not None:
                        if new in buckets:
                            buckets[new].append(left)
                        else:
                            buckets[new] = [left]
                            words[new >> SHIFT] |= BITS[new & MASK]
                            top |= BITS[new >> SHIFT]
                        if new < low:
                            low = new
                if low < rank and done < len(waiting):
                    buckets[rank] = waiting[done:]  # a lower rank goes first
                    break
            else:
                words[at_word] = bits = words[at_word] ^ lower
                if not bits:
                    top ^= upper
        found, marks, at, end = [], [0], 0, 0
        for one in queued:
            end += len(one)
            while at < end:
                found.append(parts[at])
                at = after[at]
            marks.append(4 * len(found))
        ids = struct.pack(f"<{len(found)}I", *found)
        return [ids[a:b] for a, b in zip(marks, marks[1:])]


class Texts:
    """Encodes texts, with the ids of the pre-tokens met so far at hand."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        self.find, self.find_ascii = splitter(pattern), ascii_splitter(pattern).findall
        self.encoder = Encoder(ranks)
        self.kept: dict[str, bytes] = {}
        self.aged: dict[str, bytes] = {}  # kept before; what is met again is kept again

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """The same of each text; texts of ``AT_ONCE`` characters in all are looked through together."""
        start, size = 0, 0
        for end, text in enumerate(texts, 1):
            size += len(text)
            if size >= AT_ONCE or end == len(texts):
                yield from self._encode(texts[start:end])
                start, size = end, 0

    def _encode(self, texts: list[str]) -> Iterator[bytes]:
        cut = [(self.find_ascii if text.isascii() else self.find)(text) for text in texts]
        known = [list(map(self.kept.get, tokens)) for tokens in cut]
        new = {token: b"" for tokens, ids in zip(cut, known) if None in ids for token, one in zip(tokens, ids) if one is None}
        if new:
            self._learn(new)
        for tokens, ids in zip(cut, known):
            yield b"".join([new[token] if one is None else one for token, one in zip(tokens, ids)] if None in ids else ids)

    def _learn(self, new: dict[str, bytes]) -> None:
        """Fill in the ids of pre-tokens that are not kept, and keep them."""
        unmet = []
        for token in new:
            ids = self.aged.get(token)
            if ids is None:
                unmet.append(token)
            else:
                new[token] = ids
        new.update(zip(unmet, self.encoder.encode([token.encode() for token in unmet])))
        for token, ids in new.items():
            if len(token) <= LONG:
                if len(self.kept) >= KEPT:
                    self.aged, self.kept = self.kept, {}
                self.kept[token] = ids


_AT_HAND: list[Texts] = []


def _texts(ranks: dict[bytes, int], pattern: str) -> Texts:
    """The worker's encoder: tasks that run one after the other in a worker share what it keeps."""
    if not _AT_HAND or _AT_HAND[0].ranks is not ranks or _AT_HAND[0].pattern != pattern:
        _AT_HAND[:] = [Texts(ranks, pattern)]
    return _AT_HAND[0]


def encode(docs: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, ids``: every row's whole text as ids, each a little-endian unsigned 32-bit integer; no shuffle.

    ``vocabulary`` is the path of a rank file and ``pattern`` cuts the texts into pre-tokens.
    A null text is encoded as an empty one: no ids. Repeated rows and null keys stay rows of
    their own, other columns are ignored, an empty table gives no rows. The longest text
    bounds a task's memory.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))  # one vocabulary file
    picked = docs.select(docs[key].alias("key"), docs[text].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = _texts(ranks.value, pattern)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = list(texts.encode_all([t or "" for t in part.column(1).to_pylist()]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=["key", "ids"])
    return (picked.mapInArrow(run, f"key {picked.schema['key'].dataType.simpleString()}, ids binary")
            .withColumnRenamed("key", key))


def decode(encoded: DataFrame, vocabulary: str, key: str = "doc_id") -> DataFrame:
    """``key, ids, decoded``: the bytes of every row's ids (null ids: none). An id without a piece is an error."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))  # one vocabulary file
    picked = encoded.select(encoded[key].alias("key"), "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = {rank: piece for piece, rank in ranks.value.items()}.__getitem__
        for batch in batches:
            for part in slices(batch, "ids"):
                out = [b"".join(map(bytes_of, np.frombuffer(ids, "<u4").tolist())) if ids else b"" for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.binary())], names=["key", "ids", "decoded"])
    return (picked.mapInArrow(run, f"key {picked.schema['key'].dataType.simpleString()}, ids binary, decoded binary")
            .withColumnRenamed("key", key))
