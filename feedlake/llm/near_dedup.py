"""MinHash near-deduplication of word shingles.

Words are runs of bytes other than ASCII white space, with A-Z lower-cased; a
document's set holds its distinct ``SIZE``-word shingles as 64-bit hashes. Documents
with the same set form a class, and only the classes' smallest documents go on. Each
gets ``BANDS * ROWS`` minima of universal hashes; documents that agree in all rows of
a band share a bucket. First each document is compared with the one that is smallest in
the most of its buckets, and components of these links are found by large-star and
small-star. Then the buckets that hold several components are searched whole, in pairs
of blocks of ``BLOCK`` members: a task has the members' full sets, compares every pair of
different components on them and returns a spanning forest of the links it finds, less
rows than members. Members of a bucket's largest component meet only those outside it.
A pair is compared in the first band that it shares, so once. No bucket is capped.

Pairs whose lengths cannot reach the similarity are left out, which loses nothing. At a
similarity of 0.75 a pair shares no bucket with a chance of 5e-6, and fails the
signature check with one of 5e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedlake.llm.common import give_back, slices, stored
from feedlake.llm.components import components

SIZE, PERCENT = 5, 75
BANDS, ROWS = 32, 4
#: Rows of a signature that must agree (of 128; 96 are expected at a similarity of 0.75, with a deviation of 4.9).
AGREE = 72
#: Members of a block when the rest of a bucket is compared.
BLOCK = 1024
#: Up to this many ids are broadcast to pick their texts; more are joined.
BROADCAST_IDS = 100_000

_random = np.random.default_rng(20240229)
_A = _random.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_B = _random.integers(0, 1 << 63, BANDS * ROWS, np.uint64)
_BYTES = _random.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PLACES = _random.integers(0, 1 << 63, max(64, SIZE, ROWS) + 1, np.uint64) * np.uint64(2) + np.uint64(1)
_WHITE = np.zeros(256, bool)
_WHITE[list(b" \t\n\v\f\r")] = True


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def hash_words(encoded: list[bytes], between: np.ndarray = _WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and how many each text has; ``between``: which bytes part words (a space must)."""
    encoded = [e + b" " for e in encoded]
    data = np.frombuffer(b"".join(encoded), np.uint8)
    white = between[data]
    begins = np.flatnonzero(~white & np.r_[True, white[:-1]])
    counts = np.diff(np.searchsorted(begins, np.cumsum([0] + [len(e) for e in encoded])))
    if not len(begins):
        return np.zeros(0, np.uint64), counts
    place = np.arange(len(data)) - np.repeat(np.r_[0, begins], np.diff(np.r_[0, begins, len(data)]))
    place[white] = 0
    powers = np.cumprod(np.r_[np.uint64(1), np.full(int(place.max()), _STEP)], dtype=np.uint64)
    value = _BYTES[data] * powers[place]
    value[white] = 0
    return mixed(np.add.reduceat(value, begins)), counts


def shingle_sets(texts: list[str | None], size: int = SIZE) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes; a text of fewer words has its whole sequence, one of none nothing."""
    words, counts = hash_words([(t or "").encode().lower() for t in texts])  # bytes.lower() changes A-Z alone
    padded = np.r_[words, np.zeros(size, np.uint64)]
    rolled = sum(padded[j:j + len(words)] * _PLACES[j] for j in range(size)) if len(words) else words
    sets, first = [], 0
    for n in counts.tolist():
        if n >= size:
            own = np.sort(mixed(rolled[first:first + n - size + 1]))
            sets.append(own[np.r_[True, own[1:] != own[:-1]]])
        elif n:
            sets.append(mixed((words[first:first + n] * _PLACES[:n]).sum(keepdims=True) + _PLACES[-1:] * np.uint64(n)))
        else:
            sets.append(np.zeros(0, np.uint64))
        first += n
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The minima of the universal hashes (a * x + b, upper 32 bits) of each set that is not empty."""
    flat = np.concatenate(sets)
    start = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), BANDS * ROWS), np.uint32)
    for k in range(BANDS * ROWS):
        out[:, k] = np.minimum.reduceat(flat * _A[k] + _B[k], start) >> np.uint64(32)
    return out


def _rows(column: pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def signed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc_id, n_shingles, set_key, signature`` (the last two null for an empty set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                sets = shingle_sets(part.column(1).to_pylist())
                full = [s for s in sets if len(s)]
                rows = iter(signatures(full)) if full else iter(())
                keys = [np.array([s.sum(), mixed(s).sum()]).tobytes() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                     pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary())],
                    names=["doc_id", "n_shingles", "set_key", "signature"])
        give_back()

    picked = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text))
    return picked.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, signature binary")


def buckets(rows: DataFrame) -> DataFrame:
    """``bucket, band, doc_id``: the band hashes of ``doc_id, signature``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = _rows(batch.column(1), np.uint32).reshape(-1, BANDS, ROWS).astype(np.uint64)
                keys = mixed((rows * _PLACES[:ROWS]).sum(axis=2) + np.arange(BANDS, dtype=np.uint64) * _PLACES[-1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)),
                                                  pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(keys))),
                                                  pa.array(np.repeat(batch.column(0).to_numpy(), BANDS))], names=["bucket", "band", "doc_id"])

    return rows.select("doc_id", "signature").mapInArrow(run, "bucket long, band int, doc_id long")


def full_sets(ids: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc_id, hashes``: the whole sets of the documents in ``ids`` (column _id)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                sets = [s.tobytes() for s in shingle_sets(part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["doc_id", "hashes"])

    ids = stored(ids.distinct(), "near-ids")
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    own = (docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text))
           .join(ids, F.col("doc_id") == F.col("_id"), "left_semi"))
    # a repeated id's texts have one set each; the pair's sets are those of the smallest
    return stored(own.mapInArrow(read, "doc_id long, hashes binary").groupBy("doc_id").agg(F.min("hashes").alias("hashes")), "near-sets")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b``: the pairs that reach the similarity on their full sets."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    def of(end: str) -> DataFrame:
        return sets.select(F.col("doc_id").alias(end), F.col("hashes").alias(f"of_{end}"))
    few, many = F.least(F.octet_length("of_a"), F.octet_length("of_b")), F.greatest(F.octet_length("of_a"), F.octet_length("of_b"))
    joined = pairs.select("a", "b").join(of("a"), "a").join(of("b"), "b").where(100 * few >= PERCENT * many).select("a", "b", "of_a", "of_b")
    return stored(joined.mapInArrow(compare, "a long, b long"), "near-links")


def forest(ids: np.ndarray, band: int, sig: np.ndarray, sets: list[np.ndarray], component: np.ndarray,
           left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links that join the members' components: every pair of ``left`` and ``right`` members that first agrees in
    ``band`` and is not joined yet is compared on the full sets."""
    _, root = np.unique(component, return_inverse=True)
    members = [np.flatnonzero(root == r) for r in range(int(root.max()) + 1)]
    names, flat = np.unique(np.concatenate(sets), return_inverse=True)
    size = np.array([len(s) for s in sets])
    start = np.cumsum(size) - size
    within, rows = np.zeros(len(names), bool), sig.reshape(len(ids), BANDS, ROWS)
    links = []
    for x in left:
        some = right[(root[right] != root[x]) & (100 * np.minimum(size[right], size[x]) >= PERCENT * np.maximum(size[right], size[x]))]
        some = some[(rows[some, band] == rows[x, band]).all(axis=1) & ((sig[some] == sig[x]).sum(axis=1) >= AGREE)]
        if band and len(some):
            some = some[~(rows[some, :band] == rows[x, :band]).all(axis=2).any(axis=1)]
        if not len(some):
            continue
        own = flat[start[x]:start[x] + size[x]]
        within[own] = True
        both = np.array([np.count_nonzero(within[flat[start[y]:start[y] + size[y]]]) for y in some])
        within[own] = False
        for y in some[100 * both >= PERCENT * (size[some] + size[x] - both)]:
            if root[x] != root[y]:
                small, large = sorted((root[x], root[y]), key=lambda r: len(members[r]))
                root[members[small]] = large
                members[large] = np.concatenate([members[large], members[small]])
                links.append((max(ids[x], ids[y]), min(ids[x], ids[y])))
    return links


def rest_of_buckets(members: DataFrame, rows: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b``: links between different components that share a bucket, enough to join those that are near.

    ``members``: bucket, band, doc_id, component. Of a bucket with several components,
    the members outside its largest one are dealt into blocks of about ``BLOCK``, and so
    are those of the largest; each pair of blocks but two of the largest is one group.
    """
    def run(table: pa.Table) -> pa.Table:
        ids, component, own = (table.column(c).to_numpy() for c in ("doc_id", "component", "own"))
        i, j, band = (table.column(c)[0].as_py() for c in ("i", "j", "band"))
        sig = _rows(table.column("signature").combine_chunks(), np.uint32)
        full = [np.frombuffer(v.as_buffer(), np.uint64) for v in table.column("hashes")]
        links = forest(ids, band, sig, full, component, np.flatnonzero(own == i), np.flatnonzero(own == j))
        if table.num_rows >= BLOCK:
            give_back()
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    parts = members.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    live = (parts.groupBy("bucket").agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("top"), F.count(F.lit(1)).alias("c"))
            .where("c > 1").select("bucket", F.col("top.component").alias("top"), F.ceil((F.col("n") - F.col("top.n")) / BLOCK).cast("int").alias("few"),
                                   F.ceil(F.col("top.n") / BLOCK).cast("int").alias("many")))
    outside = F.col("component") != F.col("top")
    deal = lambda n: F.pmod(F.xxhash64("doc_id"), n)
    dealt = (members.join(live, "bucket")
             .withColumn("own", F.when(outside, deal(F.col("few"))).otherwise(F.col("few") + deal(F.col("many"))).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.when(outside, F.col("few") + F.col("many")).otherwise(F.col("few")) - 1)))
             .join(rows.select("doc_id", "signature"), "doc_id").join(sets, "doc_id")
             .select("bucket", "band", "doc_id", "component", "signature", "hashes", "own",
                     F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))
    return dealt.groupBy("bucket", "i", "j").applyInArrow(run, "a long, b long")


def _merged(links: DataFrame, found: DataFrame | None) -> DataFrame:
    """``node, component`` after the links: components of the components where some are known already."""
    if found is None:
        return stored(components(links), "near-components")
    between = _component(found, _component(found, links, "a", "ca"), "b", "cb")
    merged = stored(components(between.select(F.col("ca").alias("a"), F.col("cb").alias("b"))), "near-merged")
    label = merged.select(F.col("node").alias("component"), F.col("component").alias("new"))
    moved = found.join(label, "component", "left").select("node", F.coalesce("new", "component").alias("component"))
    return stored(moved.unionByName(merged.join(found, "node", "left_anti").select("node", "component")), "near-components")


def _component(found: DataFrame, df: DataFrame, node: str, name: str) -> DataFrame:
    known = found.select(F.col("node").alias(node), F.col("component").alias(name))
    return df.join(known, node, "left").withColumn(name, F.coalesce(name, node))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: a row for every row of ``docs``.

    Null, empty and blank texts have an empty set: linked with nothing, their own
    component and kept. Repeated rows give a row each with the same component. A
    row without an id takes its class's component and gives no component its
    number. Extra columns are ignored; an empty table gives no rows.
    """
    base = stored(signed(docs, key, text), "near-signed")
    full = base.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    # the rows of a class hold the same signature, so any of them will do
    classes = stored(full.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature")), "near-classes")
    rows = classes.select(F.col("rep").alias("doc_id"), "signature")

    every = buckets(rows)
    shared = every.groupBy("bucket").agg(F.min("doc_id").alias("center"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    members = stored(every.join(shared, "bucket"), "near-buckets")
    sets = full_sets(members.select(F.col("doc_id").alias("_id")), docs, key, text)
    # in how many buckets a document has the same smallest one tells which is likeliest near
    stars = members.where("doc_id <> center").groupBy(F.col("doc_id").alias("a"), F.col("center").alias("b")).agg(F.count(F.lit(1)).alias("times"))
    likeliest = stars.groupBy("a").agg(F.max_by("b", F.struct("times", -F.col("b"))).alias("b"))
    found = _merged(confirmed(likeliest, sets), None)
    inside = _component(found, members, "doc_id", "component").select("bucket", "band", "doc_id", "component")
    links = stored(rest_of_buckets(inside, rows, sets), "near-rest")
    found = _merged(links, found)
    final = _component(found, classes.select("set_key", "rep"), "rep", "component_id").select("set_key", "component_id")
    return (base.join(final, "set_key", "left")
            .withColumn("component_id", F.coalesce("component_id", "doc_id"))
            .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that ``near_duplicates`` keeps.

    Rows without an id of their own (null, or one that several rows have) take part as if
    they had ids above all others, each its own: one whose group has another id is dropped,
    and of a group without any one row is kept; so of repeated rows one stays.
    """
    ids = docs.select(F.col(key).cast("long").alias("_id"))
    repeated = ids.groupBy("_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1 OR _id IS NULL").select("_id")
    if repeated.limit(1).count():
        own = "_own"
        while own in docs.columns:
            own = f"_{own}"
        top = F.lit(ids.agg(F.max("_id")).first()[0] or 0)
        shared = repeated.select(F.col("_id").alias(f"{own}_id"), F.lit(True).alias(f"{own}_shared"))
        marked = docs.join(shared, docs[key].cast("long").eqNullSafe(shared[f"{own}_id"]), "left")
        number = F.when(F.col(f"{own}_shared"), top + 1 + F.monotonically_increasing_id()).otherwise(docs[key].cast("long"))
        # stored, as the numbers hold for one reading only
        numbered = stored(marked.select(*[docs[c] for c in docs.columns], number.alias(own)), "near-numbered")
        return one_of_each(numbered, own, text).drop(own)
    gone = stored(near_duplicates(docs, key, text).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct(), "near-gone")
    if gone.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, docs[key] == gone["_gone"], "left_anti")
