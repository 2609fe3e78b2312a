"""Benchmark decontamination by latent semantic retrieval.

Passages are vectors over hashed words, each word counted once; the square of a word's
weight is its inverse frequency, which comes from the number of corpus documents that
hold its bucket, counted over all of them. Items are cut into passages short enough to
lie whole in a window, each pointing to its item. A randomised SVD of a block's passages,
spread over its rows, gives the latent space: each pass adds up outer products by Spark,
the driver holds the BUCKETS x (rank + EXTRA) range at most. The rank is the number of
passages, so the space holds each of them whole. Each document is cut into overlapping
windows, the windows are projected, and a passage is a candidate if the window covers
COVERED of it, whatever else the window holds. Windows whose words cannot reach that are
not projected. A candidate's surroundings are then aligned with the whole item word by
word (longest common subsequence). A document is contaminated if the common part is most
of an item, or a good part of it that also holds the item's answer, so that paraphrases
are found while shared phrases are left alone.

The benchmark is taken in blocks of about ITEMS passages, which bounds each broadcast and
what the driver collects at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F

from feedlake.llm.common import give_back, slices, stored
from feedlake.llm.near_dedup import hash_words

BITS = 17
RANK, EXTRA, POWER = 128, 16, 2
#: Words of a window, and of the step to the next; a span of WINDOW - STEP + 1 words lies whole in some window.
WINDOW, STEP = 32, 8
#: Most words of a passage.
PASSAGE = WINDOW - STEP
#: Share of a passage's weight that a window's words must carry; a word's weight here is its inverse frequency.
COVERED = 0.3
#: Share of a passage's weight, in its lightest words, that the bound grants every window unseen.
GRANTED = 0.15
#: Share of an item's words in the common subsequence: enough by itself, and enough with the answer.
STRONG, WEAK = 0.8, 0.55
#: Share of the answer's words; without an answer column it is the item's last quarter.
ANSWER = 0.6
#: Passages of a block, on average; the space has a dimension for each.
ITEMS = 192
_ROWS = 1024  # rows of a block of the range

#: ASCII marks part words; letters, digits and bytes of other characters do not.
_BETWEEN = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])


_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")


def words_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    return hash_words([(t or "").lower().encode() for t in texts], _BETWEEN)


def bucket(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - BITS)).astype(np.int64)


def inverse_frequencies(docs: DataFrame, text: str) -> np.ndarray:
    """Weight of each bucket: log((rows + 1) / (rows that hold it + 1)), at least 0.001, over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((1 << BITS) + 1, np.int64)  # the last one counts rows
        for batch in batches:
            for part in slices(batch, text):
                words, counts = words_of(part.column(0).to_pylist())
                row = np.repeat(np.arange(len(counts)), counts)
                held += np.bincount(np.unique(row << BITS | bucket(words)) & ((1 << BITS) - 1), minlength=len(held))
                held[-1] += part.num_rows
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(held[at])], names=["at", "n"])

    held = np.zeros((1 << BITS) + 1)
    found = docs.select(text).mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()  # one row a bucket
    held[found["at"].to_numpy()] = found["n"].to_numpy()
    return np.maximum(np.log((held[-1] + 1) / (held[:-1] + 1)), 1e-3).astype(np.float32)


def _vectors(texts: list[str | None], idf: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets and unit-length weights of each text; a word counts once, its squared weight is its inverse frequency."""
    words, counts = words_of(texts)
    out = []
    for own in np.split(bucket(words), np.cumsum(counts)[:-1]):
        at = np.unique(own)
        weight = np.sqrt(idf[at].astype(np.float64))
        out.append((at, weight / max(np.linalg.norm(weight), 1e-9)))
    return out


def _summed(items: DataFrame, text: str, width: int, each) -> np.ndarray:
    """Sum over the rows of the BUCKETS x ``width`` matrices that ``each`` adds to. Tasks add up their own rows;
    only rows of buckets in use move, in blocks of _ROWS buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, values in each(batch.column(0).to_pylist()):
                for i, row in zip(at.tolist(), values):
                    own[i] = own[i] + row if i in own else row
        at = np.array(sorted(own), np.int32)
        for b in np.unique(at // _ROWS):
            mine = at[at // _ROWS == b]
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([mine.tobytes()], pa.binary()),
                                              pa.array([np.array([own[i] for i in mine.tolist()]).tobytes()], pa.binary())],
                                             names=["b", "at", "rows"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros((_ROWS, width))
        used = np.zeros(_ROWS, bool)
        for at, rows in zip(table.column("at").to_pylist(), table.column("rows").to_pylist()):
            at = np.frombuffer(at, np.int32) % _ROWS
            total[at] += np.frombuffer(rows).reshape(-1, width)
            used[at] = True
        b = table.column("b")[0].as_py()
        at = np.flatnonzero(used).astype(np.int32) + np.int32(b * _ROWS)
        return pa.table({"b": pa.array([b], pa.int32()), "at": pa.array([at.tobytes()], pa.binary()),
                         "rows": pa.array([total[used].astype(np.float32).tobytes()], pa.binary())})

    kind = "b int, at binary, rows binary"
    out = np.zeros((1 << BITS, width), np.float32)
    for row in items.select(text).mapInArrow(run, kind).groupBy("b").applyInArrow(add, kind).collect():  # BUCKETS x width at most
        out[np.frombuffer(row["at"], np.int32)] = np.frombuffer(row["rows"], np.float32).reshape(-1, width)
    return out


def latent_space(items: DataFrame, text: str, idf: np.ndarray, rank: int = RANK) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors of the items' TF-IDF matrix as buckets in use and their rows (buckets x rank)."""
    width = rank + EXTRA
    weights = items.sparkSession.sparkContext.broadcast(idf)

    def sketch(texts):
        for (at, w), t in zip(_vectors(texts, weights.value), texts):
            seed = np.frombuffer((t or "").encode()[:4096].ljust(8, b"\0"), np.uint8)
            yield at, w[:, None] * np.random.default_rng(seed).standard_normal(width)

    z = _summed(items, text, width, sketch)
    used = np.flatnonzero(np.abs(z).sum(axis=1))
    if not len(used):
        return used, np.zeros((0, 1), np.float32)
    place = np.zeros(1 << BITS, np.int64)
    place[used] = np.arange(len(used))
    q = np.linalg.qr(z[used])[0]
    for last in [False] * POWER + [True]:
        basis = items.sparkSession.sparkContext.broadcast((place, q))

        def project(texts):
            where, own = basis.value
            for at, w in _vectors(texts, weights.value):
                down = w @ own[where[at]]
                # the last pass adds up the small matrix of the projections, at the first rows
                yield (np.arange(len(down)), np.outer(down, down)) if last else (at, np.outer(w, down))

        z = _summed(items, text, q.shape[1], project)
        if last:
            values, vectors = np.linalg.eigh(z[:q.shape[1]].astype(np.float64))
            keep = [i for i in np.argsort(-values)[:rank] if values[i] > 1e-9]
            return used, (q @ vectors[:, keep]).astype(np.float32)
        q = np.linalg.qr(z[used])[0]


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    where: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b.tolist():
        hit = row & where.get(x, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


@dataclass
class Space:
    """One block of the benchmark: what the tasks get."""

    ids: list[int]
    words: list[np.ndarray]
    answers: list[np.ndarray]
    weight: np.ndarray  # of each bucket
    place: np.ndarray  # bucket to row of the basis, -1 where no passage has it
    basis: np.ndarray
    passages: np.ndarray  # projected; a window's product with one is the share of it that the window covers
    item: np.ndarray  # whose passage it is
    #: Passages that hold a bucket, with its share of the passage's weight: begins by bucket, passages, shares; and
    #: the share of each passage that its words left out of these lists carry.
    begins: np.ndarray
    holders: np.ndarray
    shares: np.ndarray
    granted: np.ndarray

    def windows(self, at: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Texts and the first words of their windows that may cover enough of some passage."""
        n = self.begins[at + 1] - self.begins[at]
        hit = np.flatnonzero(n)
        if not len(hit):
            return
        n, steps = n[hit], WINDOW // STEP
        first = np.cumsum(counts) - counts
        cells = counts // STEP + steps  # steps of a text, and as many empty ones that no window reaches across
        base = np.cumsum(cells) - cells
        row = np.searchsorted(first, hit, side="right") - 1
        cell = base[row] + (hit - first[row]) // STEP
        entry = np.arange(n.sum()) + np.repeat(self.begins[at[hit]] - (np.cumsum(n) - n), n)
        width = int(cells.sum())
        spot = self.holders[entry].astype(np.int64) * width + np.repeat(cell, n)
        order = np.argsort(spot)
        spot = spot[order]
        total = np.r_[0.0, np.cumsum(self.shares[entry[order]], dtype=np.float64)]
        lead = np.flatnonzero(np.r_[True, spot[1:] != spot[:-1]])
        own = spot[lead]
        reached = total[np.r_[lead, len(spot)][np.searchsorted(own, own + steps)]] - total[lead]
        # the window that begins at these words holds all of them; one that begins a little earlier may hold more
        enough = np.unique(own[reached + self.granted[own // width] >= COVERED - 1e-4] % width)
        row = np.searchsorted(base, enough, side="right") - 1
        early = np.maximum(enough[:, None] - np.arange(steps), base[row][:, None])
        enough = np.unique(early)
        row = np.searchsorted(base, enough, side="right") - 1
        for i in np.unique(row).tolist():
            yield i, (enough[row == i] - base[i]) * STEP

    def candidates(self, words: np.ndarray, begin: np.ndarray, block: int = 1024) -> Iterator[tuple[int, int]]:
        """Item and first word of those windows of one document that cover enough of a passage."""
        at = bucket(words)
        row = self.place[at]
        for near in np.array_split(begin, max(1, len(begin) // block)):
            inside = np.minimum(near[:, None] + np.arange(WINDOW), len(words) - 1)
            inside = np.take_along_axis(inside, np.argsort(at[inside], axis=1), axis=1)
            once = np.ones(inside.shape, bool)  # a word counts once a window
            once[:, 1:] = at[inside[:, 1:]] != at[inside[:, :-1]]
            of, which = np.nonzero(once & (row[inside] >= 0))
            if not len(of):
                continue
            first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            spots = inside[of, which]
            down = np.add.reduceat(self.basis[row[spots]] * self.weight[at[spots]][:, None], first, axis=0)
            for w, passage in zip(*np.nonzero(down @ self.passages.T >= COVERED - 1e-4)):
                yield int(self.item[passage]), int(near[of[first[w]]])

    def match(self, words: np.ndarray, begin: np.ndarray) -> dict[int, float]:
        """Items that the document holds, with the share of their words in the common subsequence."""
        found: dict[int, float] = {}
        reach: dict[int, int] = {}
        for item, begin in sorted(set(self.candidates(words, begin))):
            own = self.words[item]
            if begin < reach.get(item, 0):
                continue  # inside the surroundings that were compared
            lo, hi = max(0, begin - len(own) - WINDOW), begin + 2 * WINDOW + len(own)
            reach[item] = begin + WINDOW // 2
            near = words[lo:hi]
            share = common_subsequence(own, near) / len(own)
            if share < STRONG and (share < WEAK or common_subsequence(self.answers[item], near) < ANSWER * len(self.answers[item])):
                continue
            found[item] = max(found.get(item, 0.0), share)
        return found


def _passages(items: DataFrame, text: str) -> DataFrame:
    """``_item, _passage``: the passages of each item, of even lengths."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = _WORD.findall((whole or "").lower())
                n = -(-len(own) // PASSAGE)
                cut = [" ".join(own[len(own) * i // n:len(own) * (i + 1) // n]) for i in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array([item] * n, pa.string()), pa.array(cut, pa.string())], names=["_item", "_passage"])

    return items.select("_item", text).mapInArrow(run, "_item string, _passage string")


def _space(items: DataFrame, passages: DataFrame, key: str, text: str, answer: str | None, idf: np.ndarray) -> Space:
    cut: list[Row] = passages.collect()  # about ITEMS
    used, basis = latent_space(passages, "_passage", idf, max(1, len(cut)))
    rows: list[Row] = items.join(F.broadcast(passages.select("_item").distinct()), "_item", "left_semi").collect()  # no more than passages
    texts = [r[text] for r in rows]
    words, counts = words_of(texts)
    words = np.split(words, np.cumsum(counts)[:-1]) if len(rows) else []
    number = {r["_item"]: i for i, r in enumerate(rows)}
    place = np.full(1 << BITS, -1, np.int32)
    place[used] = np.arange(len(used))
    weight = np.sqrt(idf)
    projected = np.zeros((len(cut), basis.shape[1]), np.float32)
    granted = np.zeros(len(cut))
    held: list[tuple[np.ndarray, ...]] = []
    for n, (at, w) in enumerate(_vectors([r["_passage"] for r in cut], idf) if cut else []):
        projected[n] = w @ basis[place[at]]
        projected[n] /= max(float(projected[n] @ projected[n]) * np.linalg.norm(weight[at]), 1e-9)
        share = (w * w).astype(np.float64)
        order = np.argsort(share)
        light = np.cumsum(share[order]) <= GRANTED
        granted[n] = share[order][light].sum()
        own = order[~light]
        held.append((at[own], np.full(len(own), n), share[own]))
    at, holders, shares = (np.concatenate(part) for part in zip(*held)) if held else (np.zeros(0, np.int64),) * 3
    order = np.argsort(at, kind="stable")
    begins = np.searchsorted(at[order], np.arange((1 << BITS) + 1)).astype(np.int32)

    def answer_of(i: int) -> np.ndarray:
        told = words_of([rows[i][answer]])[0] if answer else words[i][:0]
        return told if len(told) else words[i][-max(3, len(words[i]) // 4):]
    return Space([r[key] for r in rows], words, [answer_of(i) for i in range(len(rows))], weight, place, basis, projected,
                 np.array([number[r["_item"]] for r in cut], np.int64), begins, holders[order].astype(np.int32), shares[order].astype(np.float32), granted)


def _spaces(docs: DataFrame, benchmark: DataFrame, text: str, item_key: str, item_text: str, answer: str | None):
    """A broadcast Space for each block of the passages of the benchmark's distinct rows."""
    spark = docs.sparkSession
    idf = inverse_frequencies(docs, text)
    picked = [item_key, item_text, *([answer] if answer else [])]
    items = stored(benchmark.select(*picked).dropDuplicates(picked)
                   .withColumn("_item", F.sha2(F.to_json(F.struct(*picked)), 256)), "benchmark-items")
    cut = stored(_passages(items, item_text), "benchmark-passages")
    blocks = max(1, -(-cut.count() // ITEMS))
    cut = stored(cut.withColumn("_block", F.pmod(F.xxhash64("_item", "_passage"), F.lit(blocks))), "benchmark-blocks")
    for number in range(blocks):
        yield spark.sparkContext.broadcast(_space(items, cut.where(F.col("_block") == number), item_key, item_text, answer, idf))


def _found(space: Space, texts: list[str | None]) -> list[dict[int, float]]:
    words, counts = words_of(texts)
    out: list[dict[int, float]] = [{} for _ in texts]
    if len(space.ids) and len(words):
        own = np.split(words, np.cumsum(counts)[:-1])
        for i, begin in space.windows(bucket(words), counts):
            out[i] = space.match(own[i], begin)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                  item_text: str = "text", answer: str | None = None) -> DataFrame:
    """``key, contaminated, item_ids, best_share``: a row for every row of ``docs``.

    ``item_ids``: the items found, ascending, each once; ``best_share``: the largest
    share of an item's words, 0 if none. Null, empty and wordless texts and items
    match nothing; an empty benchmark finds nothing; of items with the same text
    all are reported, and one without an id counts but is not listed. Repeated rows
    are judged one by one; a null id gives a row; extra columns are ignored. Whole
    texts are read, in windows.
    """
    spaces = list(_spaces(docs, benchmark, text, item_key, item_text, answer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                texts = part.column(1).to_pylist()
                ids, best = [set() for _ in texts], [0.0] * len(texts)
                for space in spaces:
                    for i, found in enumerate(_found(space.value, texts)):
                        ids[i] |= {space.value.ids[n] for n in found}
                        best[i] = max([best[i], *found.values()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([b > 0 for b in best]),
                     pa.array([sorted(i for i in own if i is not None) for own in ids], pa.list_(pa.int64())), pa.array(best)],
                    names=[key, "contaminated", "item_ids", "best_share"])

    picked = docs.select(key, text)
    return picked.mapInArrow(run, f"{key} {picked.schema[0].dataType.simpleString()}, contaminated boolean, item_ids array<long>, best_share double")


def uncontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
                   answer: str | None = None) -> DataFrame:
    """The rows of ``docs``, all columns as they are, in which no item is found."""
    spaces = list(_spaces(docs, benchmark, text, item_key, item_text, answer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                for space in spaces:
                    part = part.filter(pa.array([not f for f in _found(space.value, part.column(text).to_pylist())], pa.bool_()))
                    if not part.num_rows:
                        break
                yield part
        give_back()

    return docs.mapInArrow(run, docs.schema)
