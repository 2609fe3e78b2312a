"""Ranked lexical search: accumulators for short lists, document-at-a-time skipping over long ones.

``build`` turns documents into an index of segments: each holds some thousand documents in
the order of their ids, their lengths, and a posting list for each of their terms. A segment
is made inside one task from whole texts, so no text and no common term's list ever has to
come together in one place. Corpus statistics are sums over the segments.

``search`` reads the posting lists of the items' terms and works a segment at a time. For an
item, the short lists of the segment are added up into accumulators (term at a time). These
then count as a single sorted list with one bound, beside the long lists. The windows of
document numbers are passed in order (document at a time): a window whose bounds cannot
reach the item's ``k``-th best score so far is skipped in all long lists at once; in others
the lists are joined to the candidates by falling bound, and candidates leave as soon as the
bounds of the lists still to come cannot lift them to that score. Only what provably cannot
be among the best is left out, so the best of all segments are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DataType

from feedlake.llm.common import slices

#: A segment closes at about so many bytes of text, or so many documents (numbers fit 16 bits).
SEGMENT_BYTES, SEGMENT_DOCS = 16 << 20, 1 << 16
#: Lists of at most a 32nd of a segment's documents are summed up before; documents of a skipping window.
SHORT, WINDOW = 32, 256
#: Items that are searched together; a block's terms are the only thing that is broadcast.
BLOCK = 4096
# Fixed values of the score: weights are whole thousandths, a term's share of a document whole millionths.
LONG_TEXT, SATURATION = 50, 20
#: A term as a pattern over code points, for the items; documents are cut by the table of bytes below.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes that belong to no term become spaces, A-Z become a-z.
_CLEAN = bytes((c + 32 if 65 <= c <= 90 else c) if chr(c).isalnum() or c > 127 else 32 for c in range(256))


def terms(text: str) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of all other characters beyond ASCII; only A-Z are lower-cased."""
    return text.encode().translate(_CLEAN).split()


class _Segment:
    """Documents of a segment under construction."""

    def __init__(self):
        self.ids, self.words, self.numbers, self.lengths, self.size = [], {}, [], [], 0

    def add(self, key, text: str | None) -> None:
        found = terms(text or "")
        words = self.words
        self.ids.append(key)
        self.lengths.append(len(found))
        self.numbers.append(np.fromiter((words.setdefault(w, len(words)) for w in found), np.int64, len(found)))
        self.size += len(text or "")

    def rows(self, number: int, key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        """A row with the documents, then one for each term; documents in the order of their ids, null ids last."""
        keys = [(k is None, 0 if k is None else k) for k in self.ids]
        order = sorted(range(len(keys)), key=keys.__getitem__)
        lengths = np.array(self.lengths, np.int64)[order]
        found = np.concatenate([self.numbers[i] for i in order])
        # (term, document) pairs in order, and how often each occurs
        pairs, counts = np.unique(found * SEGMENT_DOCS + np.repeat(np.arange(len(order)), lengths), return_counts=True)
        starts = np.searchsorted(pairs, np.arange(len(self.words) + 1) * SEGMENT_DOCS)
        head = [[number], [None], [int(np.count_nonzero(lengths))], [int(lengths.sum())], [[self.ids[i] for i in order]],
                [None], [lengths.astype("<u4").tobytes()]]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(head, _kinds(key_type))], names=NAMES)
        names, n = pa.array(list(self.words), pa.binary()).cast(pa.string()), len(self.words)
        totals = np.add.reduceat(counts, starts[:-1]) if n else counts
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, number)), names, pa.array(np.diff(starts)), pa.array(totals.astype(np.int64)), pa.nulls(n, pa.list_(key_type)),
             _binaries((pairs % SEGMENT_DOCS).astype("<u2"), starts), _binaries(counts.astype("<u4"), starts)], names=NAMES)


NAMES = ["segment", "term", "size", "total", "ids", "docs", "counts"]


def _kinds(key_type: pa.DataType) -> list[pa.DataType]:
    return [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(key_type), pa.binary(), pa.binary()]


def _binaries(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The values between one start and the next, as binaries."""
    offsets = (starts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])


def build(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of all rows; store it before searching. No shuffle.

    Columns ``segment, term, size, total, ids, docs, counts``. A row with a null ``term`` lists
    a segment's ids and lengths (``counts``), with the number of documents that have a term and
    the sum of the lengths; any other is the posting list of a term: ``size`` documents by their
    place in the segment, and how often each holds it, ``total`` times altogether.
    Every row of ``docs`` is a document of its own, repeated rows and null ids too; a null text
    has no terms. Other columns are ignored and an empty table gives an empty index.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    picked = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    kind = picked.schema["key"].dataType
    key_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, closed, segment = TaskContext.get().partitionId() << 32, 0, _Segment()
        for batch in batches:
            for part in slices(batch, "text"):
                for row_key, row_text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    segment.add(row_key, row_text)
                    if segment.size >= SEGMENT_BYTES or len(segment.ids) == SEGMENT_DOCS:
                        yield from segment.rows(first + closed, key_type)
                        closed, segment = closed + 1, _Segment()
        if segment.ids:
            yield from segment.rows(first + closed, key_type)
    return picked.mapInArrow(run, f"segment bigint, term string, size bigint, total bigint, ids array<{kind.simpleString()}>, docs binary, counts binary")


def weight(n: Column, df: Column) -> Column:
    """A term's weight in whole thousandths."""
    return F.floor(F.lit(1000.0) * F.log((2 * n + 2) / (2 * df + 1))).cast("bigint")


class Lists:
    """The posting lists of one segment, with each posting's share of a score worked out once."""

    def __init__(self, lengths: np.ndarray, n: int, total: int):
        self.size = len(lengths)
        self.norm = 100 - LONG_TEXT + (LONG_TEXT * lengths * n) // max(1, total)
        self.windows = -(-self.size // WINDOW)
        self.docs, self.gains, self.tops = {}, {}, {}

    def add(self, term: str, docs: np.ndarray, counts: np.ndarray, w: int) -> None:
        gains = w * ((1_000_000_000 * counts) // (1000 * counts + SATURATION * self.norm[docs]))
        self.docs[term], self.gains[term], self.tops[term] = docs, gains, self._tops(docs, gains)

    def _tops(self, docs: np.ndarray, gains: np.ndarray) -> np.ndarray:
        """The largest gain of each window."""
        tops = np.zeros(self.windows, np.int64)
        if len(docs):
            window = docs // WINDOW
            starts = np.flatnonzero(np.r_[True, window[1:] != window[:-1]])
            tops[window[starts]] = np.maximum.reduceat(gains, starts)
        return tops

    def best(self, wanted: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` documents of the segment with the highest scores above 0, equal ones by number, and the scores."""
        lists = [t for t in wanted if t in self.docs]
        short = [t for t in lists if len(self.docs[t]) * SHORT <= self.size]
        long = sorted((t for t in lists if len(self.docs[t]) * SHORT > self.size), key=lambda t: -int(self.tops[t].max()))
        # term at a time: the short lists become one list of summed accumulators
        sums = np.zeros(self.size, np.int64)
        for t in short:
            sums[self.docs[t]] += self.gains[t]
        held = np.flatnonzero(sums)
        if not long:
            return _first(held, sums[held], k)
        bounds = self._tops(held, sums[held])
        reach = bounds + np.sum([self.tops[t] for t in long], axis=0)
        # accumulators are scores already reached: the k-th of them is a bound to beat from the start
        least = int(np.partition(sums[held], -k)[-k]) if len(held) >= k else 1
        found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        # document at a time: windows in order, several in one step as long as the bound is low
        at, step = 0, 4
        while at < self.windows:
            here = at + np.flatnonzero(reach[at:at + step] >= least)
            at, step = at + step, min(64, step * 2)
            if not len(here):
                continue
            more, points = self._window(here, sums, long, least)
            found, scores = _first(np.r_[found, more], np.r_[scores, points], k)
            if len(found) == k:
                least = max(least, int(scores[-1]))
        return found, scores

    def _window(self, here: np.ndarray, sums: np.ndarray, long: list[str], least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the windows ``here`` that reach ``least``, and their scores."""
        low, high = int(here[0]) * WINDOW, min(self.size, (int(here[-1]) + 1) * WINDOW)
        points = sums[low:high].copy()
        live = np.zeros(self.windows, bool)
        live[here] = True
        alive = np.repeat(live[low // WINDOW:int(here[-1]) + 1], WINDOW)[:high - low]
        rest = np.cumsum([0, *(int(self.tops[t][here].max()) for t in reversed(long))])[::-1]
        for t, left in zip(long, rest):
            # who cannot come up to the bound with all lists still to come leaves; the list is entered at the window
            alive &= points + left >= least
            docs = self.docs[t]
            first, last = np.searchsorted(docs, (low, high))
            local = docs[first:last] - low
            keep = alive[local]
            points[local[keep]] += self.gains[t][first:last][keep]
        alive &= points >= least
        numbers = np.flatnonzero(alive)
        return numbers + low, points[numbers]


def _first(docs: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest scores above 0, equal ones by document number."""
    above = scores > 0
    docs, scores = docs[above], scores[above]
    order = np.lexsort((docs, -scores))[:k]
    return docs[order], scores[order]


def search(index: DataFrame, items: DataFrame, key: str = "item_id", text: str = "text", k: int = 50, doc: str = "doc_id") -> DataFrame:
    """``key, rank, doc, score``: for each item its ``k`` documents with the highest scores above 0.

    Equal scores go by ascending document id, null ids last; ranks are unique. Each row of
    ``items`` is an item of its own, also if its key is null or repeated. An item without
    terms, or whose terms are in no document, has no rows; so it is for an empty index and no
    items. Items are taken in blocks of ``BLOCK``: their terms are all that is broadcast.
    """
    spark = index.sparkSession
    kinds = {key: items.schema[key].dataType, doc: index.schema["ids"].dataType.elementType}
    heads = index.where(F.col("term").isNull())
    n, total = heads.agg(F.sum("size"), F.sum("total")).first()
    best = spark.createDataFrame([], f"number bigint, `{key}` {kinds[key].simpleString()}, `{doc}` {kinds[doc].simpleString()}, score bigint")
    if n:
        lower = F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        asked = items.select(F.col(key), F.array_distinct(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))).alias("terms"))
        rows = enumerate((r[0], r[1]) for r in asked.toLocalIterator() if r[1])
        while block := list(islice(rows, BLOCK)):
            best = best.unionByName(_search_block(index, heads, block, n, total, k, kinds, key, doc))
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last(doc))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(key, "rank", doc, "score")


def _search_block(index: DataFrame, heads: DataFrame, block: list[tuple], n: int, total: int, k: int, kinds: dict[str, DataType],
                  key: str, doc: str) -> DataFrame:
    """The best documents of every segment for each item of a block."""
    from pyspark.sql.pandas.types import to_arrow_type
    spark = index.sparkSession
    words = sorted({t for _, (_, asked) in block for t in asked})
    # the terms of a block of items, so a bounded table
    posts = index.join(F.broadcast(spark.createDataFrame([(w,) for w in words], "term string")), "term", "left_semi")
    weights = dict(posts.groupBy("term").agg(weight(F.lit(n), F.sum("size")).alias("w")).collect())
    sent = spark.sparkContext.broadcast(([(number, name, asked) for number, (name, asked) in block], weights))
    key_type, doc_type = to_arrow_type(kinds[key]), to_arrow_type(kinds[doc])

    def run(table: pa.Table) -> pa.Table:
        asked, weights = sent.value
        rows = table.to_pylist()
        head = next(r for r in rows if r["term"] is None)
        lists = Lists(np.frombuffer(head["counts"], "<u4").astype(np.int64), n, total)
        for r in rows:
            if r["term"] is not None:
                lists.add(r["term"], np.frombuffer(r["docs"], "<u2").astype(np.int64), np.frombuffer(r["counts"], "<u4").astype(np.int64),
                          weights[r["term"]])
        numbers, names, docs, scores = [], [], [], []
        for number, name, wanted in asked:
            found, points = lists.best(wanted, k)
            numbers += [number] * len(found)
            names += [name] * len(found)
            docs += [head["ids"][i] for i in found.tolist()]
            scores += points.tolist()
        return pa.table({"number": pa.array(numbers, pa.int64()), key: pa.array(names, key_type), doc: pa.array(docs, doc_type),
                         "score": pa.array(scores, pa.int64())})
    schema = f"number bigint, `{key}` {kinds[key].simpleString()}, `{doc}` {kinds[doc].simpleString()}, score bigint"
    return heads.unionByName(posts.select(heads.columns)).groupBy("segment").applyInArrow(run, schema)
