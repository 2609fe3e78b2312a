"""Language identification by inference of a mixture of languages.

A document's lower-cased text is read as byte trigrams within and at the edges of
words, hashed to ``2**bits`` ids. Training counts the trigrams of every labelled
document by language, one model row per language. Prediction treats a document's
trigrams as drawn from a mixture of the language models: expectation-maximisation
estimates the proportions, and the set of languages is the one with the largest
log-likelihood less a penalty per language. Model and counts are bounded by
languages x 2**bits, so the model may be broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedlake.llm.common import slices

BITS = 16
SMOOTHING = 0.5
ROUNDS = 25
#: Log-likelihood that one more language must gain, in units of the log of the number of trigrams.
PENALTY = 4.0
UNKNOWN = "und"

#: ASCII bytes that are no letters become spaces; bytes of other characters stay.
_LETTERS = np.full(256, 0x20, np.uint8)
_LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTERS[0x80:] = np.arange(0x80, 0x100)


def trigrams(texts: list[str | None], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Row number and hashed id of every trigram whose middle byte belongs to a word."""
    encoded = [f" {t.lower()} ".encode() if t else b"  " for t in texts]
    data = _LETTERS[np.frombuffer(b"".join(encoded), np.uint8)]
    row = np.repeat(np.arange(len(texts), dtype=np.uint32), [len(e) for e in encoded])
    middle = np.flatnonzero(data[1:-1] != 0x20) + 1  # a row begins and ends with a space
    wide = data.astype(np.uint32)
    code = wide[middle - 1] << np.uint32(16) | wide[middle] << np.uint32(8) | wide[middle + 1]
    return row[middle], (code * np.uint32(2654435761)) >> np.uint32(32 - bits)


def trigram_counts(docs: DataFrame, text: str = "text", lang: str = "lang", bits: int = BITS) -> DataFrame:
    """``lang, gram, n``: trigram counts by language over every row with a text and a language.

    Each task adds up its own rows first, so a language that most rows share costs
    one row per trigram and task in the shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, text):
                told = part.column(lang).dictionary_encode()
                names, codes = told.dictionary.to_pylist(), told.indices.to_numpy()
                row, gram = trigrams(part.column(text).to_pylist(), bits)
                counts = np.bincount((codes[row].astype(np.int64) << bits) + gram, minlength=len(names) << bits).reshape(len(names), -1)
                for name, one in zip(names, counts):
                    sums[name] = sums.get(name, 0) + one
        for name, one in sums.items():
            at = np.flatnonzero(one)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()),
                                              pa.array(one[at], pa.int64())], names=["lang", "gram", "n"])

    picked = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text), F.col(lang))
    return (picked.mapInArrow(run, "lang string, gram int, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", bits: int = BITS) -> tuple[list[str], np.ndarray]:
    """Languages in order, and their smoothed trigram probabilities (2**bits x languages)."""
    found = trigram_counts(docs, text, lang, bits).toPandas()
    langs = sorted(found["lang"].unique())
    counts = np.full((1 << bits, len(langs)), SMOOTHING)
    np.add.at(counts, (found["gram"].to_numpy(), np.searchsorted(langs, found["lang"].to_numpy(str))), found["n"].to_numpy())
    return langs, (counts / counts.sum(axis=0)).astype(np.float32)


class _Grams:
    """Distinct trigrams of some documents: for each its count ``n`` and likelihood by language
    (``like``: languages x trigrams); a document's trigrams begin at ``start``."""

    def __init__(self, like: np.ndarray, n: np.ndarray, start: np.ndarray):
        self.like, self.n, self.start = like, n, start
        self.sizes = np.diff(np.r_[start, len(n)])
        self.total = np.add.reduceat(n, start)

    def of(self, docs: np.ndarray) -> _Grams:
        keep = np.zeros(len(self.start), bool)
        keep[docs] = True
        rows = np.repeat(keep, self.sizes)
        return _Grams(self.like[:, rows], self.n[rows], np.r_[0, np.cumsum(self.sizes[keep])[:-1]])

    def mixed(self, share: np.ndarray) -> np.ndarray:
        return sum(like * np.repeat(s, self.sizes) for like, s in zip(self.like, share))

    def loglike(self, share: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.n * np.log(self.mixed(share), dtype=np.float64), self.start)

    def maximise(self, share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        """Rounds of expectation-maximisation from ``share`` (languages x documents; 0 stays 0), and the last
        round's growth factors by language."""
        for _ in range(rounds):
            weight = self.n / self.mixed(share)
            growth = np.array([np.add.reduceat(like * weight, self.start) for like in self.like]) / self.total
            share, last = share * growth, share
            if np.abs(share - last).max() < 1e-4:
                break
        return share, growth


def infer(texts: list[str | None], model: np.ndarray, bits: int = BITS,
          penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (rows x languages, all 0 without trigrams) and the margin of the best language, 0 to 1."""
    n_langs = model.shape[1]
    shares, margin = np.zeros((len(texts), n_langs)), np.zeros(len(texts))
    if len(texts) >> 16:  # row and trigram share a 32-bit key below
        cut = 1 << 15
        found = [infer(texts[i:i + cut], model, bits, penalty) for i in range(0, len(texts), cut)]
        return tuple(np.concatenate(part) for part in zip(*found))
    row, gram = trigrams(texts, bits)
    if not len(row) or not n_langs:
        return shares, margin
    both = np.sort(row.astype(np.uint32) << np.uint32(bits) | gram)
    first = np.flatnonzero(np.r_[True, both[1:] != both[:-1]])
    n = np.diff(np.r_[first, len(both)]).astype(np.float32)
    doc, code = both[first] >> np.uint32(bits), both[first] & np.uint32((1 << bits) - 1)
    start = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    docs, grams = doc[start], _Grams(np.ascontiguousarray(model[code].T), n, start)

    single = np.array([np.add.reduceat(n * np.log(like, dtype=np.float64), start) for like in grams.like])
    best = single.argmax(axis=0)
    at = np.arange(len(best))
    top = single[best, at]
    chosen = np.eye(n_langs)[best].T
    # No set is likelier than the best mixture of all languages, and that exceeds a mixture's likelihood by at most
    # total * log(largest growth factor). Where even this gains less than the price of one more language, the
    # single language is the penalised optimum. The other documents try their languages by proportion.
    near = np.full((n_langs, len(best)), 0.04 / max(1, n_langs - 1), np.float32)
    near[best, at] = 0.96
    price = penalty * np.log(grams.total + 1)
    share, growth = grams.maximise(near, 3)
    last = share / np.where(growth > 0, growth, 1)  # the factors belong to the round before
    bound = grams.loglike(last) + grams.total * np.log(np.maximum(growth.max(axis=0), 1e-9), dtype=np.float64)
    left = np.flatnonzero(bound - top > price) if n_langs > 1 else []
    if len(left):
        sub, value = grams.of(left), top[left]
        full, _ = sub.maximise(np.full((n_langs, len(left)), 1 / n_langs, np.float32), ROUNDS)
        rank = (-full).argsort(axis=0, kind="stable").argsort(axis=0)
        for size in range(2, n_langs + 1):
            share, _ = sub.maximise((rank < size).astype(np.float32) / np.float32(size), ROUNDS)
            worth = sub.loglike(share) - (size - 1) * price[left]
            better = worth > value
            value = np.where(better, worth, value)
            chosen[:, left[better]] = share[:, better]
    shares[docs] = chosen.T
    # A single language's margin over the others counts against near ties of short texts.
    odds = 1 / np.exp(np.maximum(single - top, -500)).sum(axis=0)
    margin[docs] = np.where((chosen > 0).sum(axis=0) > 1, 1.0, odds)
    return shares, margin


def _judge(texts: list[str | None], langs: list[str], model: np.ndarray, bits: int, penalty: float):
    """Language, score and proportions of each text."""
    import regex
    letter = regex.compile(r"\p{L}").search
    shares, margin = infer([t if t and letter(t) else None for t in texts], model, bits, penalty)
    if not langs:
        return [UNKNOWN] * len(texts), [0.0] * len(texts), shares
    best, known = shares.argmax(axis=1), shares.sum(axis=1) > 0
    score = np.where(known, np.minimum(1.0, shares.max(axis=1) * margin), 0.0)
    return [langs[b] if k else UNKNOWN for b, k in zip(best, known)], score.tolist(), shares


def identify(docs: DataFrame, langs: list[str], model: np.ndarray, key: str = "doc_id", text: str = "text",
             bits: int = BITS, penalty: float = PENALTY) -> DataFrame:
    """``key, lang_pred, score, langs, shares`` for every row; no shuffle.

    ``lang_pred`` is the language of the largest proportion (ties: the first in
    order), ``und`` with score 0 where the text is null or has no letter (Unicode
    category L) or nothing was learned. ``score``: that proportion, times the
    chance of the language against the others for a single language. ``langs``
    and ``shares``: the selected set. Repeated rows are judged one by one, extra
    columns are ignored, an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages x 2**bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                lang, score, shares = _judge(part.column(1).to_pylist(), langs, sent.value, bits, penalty)
                among = [np.flatnonzero(s > 0).tolist() for s in shares]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                    pa.array([[langs[i] for i in a] for a in among], pa.list_(pa.string())),
                    pa.array([s[a].tolist() for s, a in zip(shares, among)], pa.list_(pa.float64()))],
                    names=[key, "lang_pred", "score", "langs", "shares"])

    picked = docs.select(key, text)
    kind = picked.schema[0].dataType.simpleString()
    return picked.mapInArrow(run, f"{key} {kind}, lang_pred string, score double, langs array<string>, shares array<double>")


def identified(docs: DataFrame, langs: list[str], model: np.ndarray, least: float, text: str = "text",
               bits: int = BITS, penalty: float = PENALTY) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose languages are known: a set of several, however evenly
    the text is split among them, or a single one with at least the score ``least``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                lang, score, shares = _judge(part.column(text).to_pylist(), langs, sent.value, bits, penalty)
                several = (shares > 0).sum(axis=1) > 1
                yield part.filter(pa.array([n != UNKNOWN and bool(m or s >= least) for n, s, m in zip(lang, score, several)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
