"""Removal of repeated byte strings by suffix arrays of content shards.

A string of ``LENGTH`` bytes is removed where the same string begins in a document
with a smaller id. Equal strings must meet, and no text may be sent to more than one
place, so every window of LENGTH bytes is led by its anchor, the smallest hash of the
K-byte strings in it: equal windows have equal anchors. Consecutive windows with one
anchor form a fragment.

1. The documents are packed, some megabytes of whole texts a row.
2. The packs' anchors meet by hash; those seen in one document alone end here.
3. The fragments of shared anchors, each once a pack with its smallest document, go to
   shards by anchor. Of the distinct fragments, those that are alone with their anchor
   share no window; a shard sorts all suffixes of the others by induced sorting; permuted common prefixes of LENGTH bytes or more join equal windows, and
   each gets the smallest document it occurs in.
4. That goes back to the packs, which remove what a smaller document has.

Anchors that occur in very many packs would overload a shard; their windows are dealt
one by one, by the window's hash, with the same result. No string is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from feedlake.llm.common import give_back, nullable, parts, slices, stored, text_bytes
from feedlake.llm.near_dedup import mixed
from feedlake.llm.suffix_array import permuted_common_prefixes, suffix_array

LENGTH, K = 50, 24
WINDOW = LENGTH - K + 1
#: Bytes of text in a pack, and of all texts for each shard.
PACK, SHARD = 2 << 20, 2 << 20
#: Packs that hold an anchor before its windows are dealt one by one.
HOT = 2000
#: Anchors are compared by their upper 48 bits when shared ones are looked for.
DROP = np.uint64(16)
_NO_ID = np.iinfo(np.int64).max
_M = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB,
               0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


def _squeeze(array: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(array).tobytes(), codec="zstd", asbytes=True) if array.size else b""


def _spread(data: bytes, kind: type, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind) if n else np.zeros(0, kind)


def _deltas(sorted_: np.ndarray) -> np.ndarray:
    """Byte planes of the differences, which squeeze well."""
    return np.diff(sorted_, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T


def _from_deltas(data: bytes, n: int) -> np.ndarray:
    planes = _spread(data, np.uint8, 8 * n).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _sliding(f, a: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        a = f(a[:-size], a[size:])
        size *= 2
    return f(a[:size - width], a[width - size:]) if size < width else a


def _within(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which of the values are among the ordered ones."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


class Pack:
    """Whole texts as one run of bytes; ``fragments`` gives its anchored fragments."""

    def __init__(self, batch: pa.RecordBatch):
        self.batch = batch
        texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
        self.ids = batch.column("doc_id").fill_null(_NO_ID).to_numpy()
        self.ends = np.cumsum([len(t) for t in texts])
        self.begins = np.r_[0, self.ends[:-1]].astype(np.int64)
        self.bytes = b"".join(texts)
        self.data = np.frombuffer(self.bytes, np.uint8)

    def _anchors(self, lo: int, hi: int) -> np.ndarray:
        """The smallest hash in the windows that begin in lo..hi."""
        data = np.zeros(hi - lo + LENGTH + 8, np.uint8)
        own = self.data[lo:hi + LENGTH + 8]
        data[:len(own)] = own
        loads = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1)).copy().view(np.uint64).ravel()
        n = hi - lo + WINDOW - 1
        code = sum(loads[8 * j:8 * j + n] * _M[j] for j in range(K // 8))
        return _sliding(np.minimum, mixed(code), WINDOW)[:hi - lo]

    def fragments(self, step: int = 1 << 16) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Begin, number of windows, anchor and document of the fragments, in order."""
        out, i = [], 0
        while i < len(self.ids):
            j = max(i + 1, int(np.searchsorted(self.ends, self.begins[i] + step)))
            lo, hi = int(self.begins[i]), int(self.ends[j - 1])
            sizes = self.ends[i:j] - self.begins[i:j]
            if hi > lo:
                value = self._anchors(lo, hi)
                doc = np.repeat(np.arange(i, j), sizes)
                inside = np.arange(lo, hi) + LENGTH <= self.ends[doc]
                new = np.r_[True, (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])]
                new[1:] |= ~inside[:-1]
                begin = np.flatnonzero(new & inside)
                # a fragment ends at the next one or where windows no longer fit
                stop = np.minimum(np.r_[begin[1:], hi - lo], self.ends[doc[begin]] - LENGTH + 1 - lo)
                # smallest hashes crowd at the low end: mixed again, they fall evenly on the shards
                out.append((begin + lo, stop - begin, mixed(value[begin]), doc[begin]))
            i = j
        return tuple(np.concatenate(x) for x in zip(*out)) if out else tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.int64))

    def shared(self, keys: np.ndarray, hot: np.ndarray, shards: int):
        """The fragments of shared anchors (windows one by one for hot ones), and by shard what is sent of them:
        begin, windows, document, number of the distinct fragment; (shard, texts, smallest ids) of those."""
        begin, windows, anchor, doc = self.fragments()
        keep = _within(anchor >> DROP, keys)
        begin, windows, anchor, doc = begin[keep], windows[keep], anchor[keep], doc[keep]
        single = _within(anchor >> DROP, hot)
        if single.any():
            times = np.where(single, windows, 1)
            offset = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            begin, windows, anchor, doc, single = (np.repeat(x, times) for x in (begin, windows, anchor, doc, single))
            begin, windows = np.where(single, begin + offset, begin), np.where(single, 1, windows)
            anchor[single] = [int.from_bytes(hashlib.blake2b(self.bytes[b:b + LENGTH], digest_size=8).digest(), "little") for b in begin[single]]
        shard = (anchor >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
        order = np.argsort(shard, kind="stable")
        begin, windows, doc, shard = begin[order], windows[order], doc[order], shard[order].astype(np.int64)
        number: dict[tuple[int, bytes], int] = {}
        at = np.array([number.setdefault((r, self.bytes[b:e]), len(number)) for r, b, e
                       in zip(shard.tolist(), begin.tolist(), (begin + windows + LENGTH - 1).tolist())], np.int64)
        least = np.full(len(number), _NO_ID)
        np.minimum.at(least, at, self.ids[doc])
        return begin, windows, doc, at, np.array([r for r, _ in number], np.int64), [t for _, t in number], least


def _read_pack(table: pa.Table) -> Pack:
    return Pack(pa.ipc.open_stream(table.column("pack")[0].as_buffer()).read_next_batch())


def packs(docs: DataFrame) -> DataFrame:
    """``pack_id, pack``: rows of whole documents (all columns), squeezed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        waiting, size = [], 0
        for batch in batches:
            for part in slices(batch, "text", PACK):
                waiting.append(part)
                size += part.column("text").nbytes
                if size >= PACK:
                    yield whole(waiting, number, options)
                    number, waiting, size = number + 1, [], 0
        if waiting:
            yield whole(waiting, number, options)

    def whole(waiting, number, options) -> pa.RecordBatch:
        batch = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
            writer.write_batch(batch)
        return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["pack_id", "pack"])

    return docs.mapInArrow(run, "pack_id long, pack binary")


def pack_anchors(packed: DataFrame, shards: int) -> DataFrame:
    """``shard, pack_id, n, keys, twice``: sorted anchors of a pack by shard; which occur in two of its documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                _, _, anchor, doc = _read_pack(pa.Table.from_batches([batch.slice(row, 1)])).fragments()
                order = np.lexsort((doc, anchor >> DROP))
                key, doc = (anchor >> DROP)[order], doc[order]
                first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
                last = np.r_[first[1:], len(key)] - 1 if len(first) else first
                key, twice = key[first], doc[first] != doc[last]
                shard = (key >> np.uint64(16)) * np.uint64(shards) >> np.uint64(32)
                cut = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(key) else []
                stop = np.r_[cut[1:], len(key)].astype(int) if len(key) else []
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(shard[a]) for a in cut], pa.int64()), pa.array([batch.column(0)[row].as_py()] * len(cut), pa.int64()),
                    pa.array([int(b - a) for a, b in zip(cut, stop)], pa.int32()),
                    pa.array([_squeeze(_deltas(key[a:b])) for a, b in zip(cut, stop)], pa.binary()),
                    pa.array([np.packbits(twice[a:b]).tobytes() for a, b in zip(cut, stop)], pa.binary())],
                    names=["shard", "pack_id", "n", "keys", "twice"])

    return packed.mapInArrow(run, "shard long, pack_id long, n int, keys binary, twice binary")


def shared_anchors(anchors: DataFrame, hot: int) -> DataFrame:
    """``pack_id, n, keys, n_hot, hot_keys``: what of a pack's anchors occurs in more than one document."""
    def run(table: pa.Table) -> pa.Table:
        n = table.column("n").to_pylist()
        each = [_from_deltas(k, m) for k, m in zip(table.column("keys").to_pylist(), n)]
        twice = [np.unpackbits(np.frombuffer(t, np.uint8))[:m].astype(bool) for t, m in zip(table.column("twice").to_pylist(), n)]
        key, packs_ = np.unique(np.concatenate(each), return_counts=True)
        again = np.unique(np.concatenate([e[t] for e, t in zip(each, twice)]))
        packs_hot = packs_ > hot
        shared = (packs_ > 1) | _within(key, again)
        found = [np.searchsorted(key, e) for e in each]
        mine = [e[shared[f]] for e, f in zip(each, found)]
        hots = [e[packs_hot[f]] for e, f in zip(each, found)]
        return pa.table({"pack_id": table.column("pack_id"), "n": pa.array([len(m) for m in mine], pa.int32()),
                         "keys": pa.array([_squeeze(_deltas(m)) if len(m) else b"" for m in mine], pa.binary()),
                         "n_hot": pa.array([len(m) for m in hots], pa.int32()),
                         "hot_keys": pa.array([_squeeze(_deltas(m)) if len(m) else b"" for m in hots], pa.binary())})

    return anchors.groupBy("shard").applyInArrow(run, "pack_id long, n int, keys binary, n_hot int, hot_keys binary")


def _keys(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    def of(n: str, keys: str) -> np.ndarray:
        all_ = [_from_deltas(k, m) for k, m in zip(table.column(keys).to_pylist(), table.column(n).to_pylist()) if m]
        return np.sort(np.concatenate(all_)) if all_ else np.zeros(0, np.uint64)
    return of("n", "keys"), of("n_hot", "hot_keys")


def fragments(packed: DataFrame, shared: DataFrame, shards: int) -> DataFrame:
    """``shard, pack_id, sizes, least, data``: a pack's distinct fragments for a shard, with their smallest ids."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows and right.num_rows:
            *_, shard, texts, least = _read_pack(left).shared(*_keys(right), shards)
            cut = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(shard) else []
            for a, b in zip(cut, [*cut[1:], len(shard)]):
                rows.append((int(shard[a]), left.column("pack_id")[0].as_py(), [len(t) for t in texts[a:b]], least[a:b].tolist(),
                             pa.compress(b"".join(texts[a:b]), codec="zstd", asbytes=True)))
        give_back()
        columns = list(zip(*rows)) or [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["shard", "pack_id", "sizes", "least", "data"])

    return (packed.groupBy("pack_id").cogroup(shared.groupBy("pack_id"))
            .applyInArrow(run, "shard long, pack_id long, sizes array<int>, least array<long>, data binary"))


def smallest_documents(texts: list[bytes], ids: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """For every window of the texts, in order: its text's number, and the smallest id among the texts that hold the
    window, by suffix array."""
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    ends = np.cumsum(sizes + 1)
    values = data.astype(np.int16) + 2
    values[ends - 1] = 1  # below all bytes; the text as a whole ends with 0
    sa = suffix_array(np.append(values, np.int16(0)), 258)[1:]
    text = np.repeat(np.arange(len(texts)), sizes + 1)
    whole = np.arange(len(data)) + length <= (ends - 1)[text]  # a window begins here
    windows = np.flatnonzero(whole)
    prefix = permuted_common_prefixes(data, sa, length, windows)
    before = np.zeros(len(data), bool)
    before[sa[1:]] = whole[sa[:-1]]
    kept = sa[whole[sa]]
    first = np.flatnonzero(~(before & (prefix >= length))[kept])
    least = np.full(len(data), _NO_ID)
    if len(kept):
        smallest = np.minimum.reduceat(ids[text[kept]], first)
        least[kept] = np.repeat(smallest, np.diff(np.append(first, len(kept))))
    return text[windows], least[windows]


def window_runs(texts: list[bytes], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one smallest id, text by text: how many a text has, where each stops in its text, its id."""
    met = meeting(texts)
    # a text that meets no other is one run of its own
    text, least = np.flatnonzero(~met), ids[~met]
    stop = np.array([len(t) for t in texts])[text] - LENGTH + 1
    if met.any():
        of, smallest = smallest_documents([t for t, m in zip(texts, met.tolist()) if m], ids[met])
        last = np.flatnonzero(np.append((of[1:] != of[:-1]) | (smallest[1:] != smallest[:-1]), True))
        begin = np.searchsorted(of, of[last])
        text, stop = np.r_[text, np.flatnonzero(met)[of[last]]], np.r_[stop, last - begin + 1]
        least = np.r_[least, smallest[last]]
        order = np.argsort(text, kind="stable")
        text, stop, least = text[order], stop[order], least[order]
    return np.bincount(text, minlength=len(texts)), stop, least


def meeting(texts: list[bytes]) -> np.ndarray:
    """Which of the distinct fragments may hold a window of another: those whose anchor another fragment has as well,
    unless all of these are single windows, which differ."""
    head = np.frombuffer(b"".join(t[:LENGTH] + bytes(8) for t in texts), np.uint8).reshape(len(texts), LENGTH + 8)
    loads = [np.ascontiguousarray(head[:, i:i + 8]).view(np.uint64).ravel() for i in range(LENGTH - 7)]
    code = np.stack([sum(loads[i + 8 * j] * _M[j] for j in range(K // 8)) for i in range(WINDOW)])
    _, group, size = np.unique(mixed(code).min(axis=0), return_inverse=True, return_counts=True)
    longest = np.zeros(len(size), np.int64)
    np.maximum.at(longest, group, [len(t) for t in texts])
    return ((size > 1) & (longest > LENGTH))[group]


def shard_results(sent: DataFrame) -> DataFrame:
    """``pack_id, shard, runs, stops, least``: for a pack's fragments, runs of windows with their smallest ids."""
    def run(table: pa.Table) -> pa.Table:
        sizes, own = (table.column(c).combine_chunks() for c in ("sizes", "least"))
        each = np.append(0, np.cumsum(sizes.value_lengths().to_numpy()))  # fragments of the packs
        sizes, own = sizes.flatten().to_numpy(), own.flatten().to_numpy()
        ends = np.cumsum(sizes)
        raw = np.diff(np.append(0, ends)[each])
        whole = b"".join(pa.decompress(d, int(n), codec="zstd", asbytes=True) for d, n in zip(table.column("data").to_pylist(), raw))
        number: dict[bytes, int] = {}
        at = np.array([number.setdefault(whole[e - n:e], len(number)) for n, e in zip(sizes.tolist(), ends.tolist())], np.int64)
        ids = np.full(len(number), _NO_ID)
        np.minimum.at(ids, at, own)
        counts, stops, least = window_runs(list(number), ids)
        times = counts[at]
        entry = np.repeat((np.cumsum(counts) - counts)[at] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        total = np.append(0, np.cumsum(times))[each]

        del whole, number
        give_back()

        def lists(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
        return pa.table({"pack_id": table.column("pack_id"), "shard": table.column("shard"), "runs": lists(each, times, pa.int32()),
                         "stops": lists(total, stops[entry], pa.int32()), "least": lists(total, least[entry], pa.int64())})

    return sent.groupBy("shard").applyInArrow(run, "pack_id long, shard long, runs array<int>, stops array<int>, least array<long>")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", columns: list[str] | None = None,
                   decode: bool = False, shard_bytes: int = SHARD, hot: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row, then ``kept`` (the bytes left) and the
    given other ``columns``.

    Null texts count as empty; texts below LENGTH bytes lose nothing. Rows with the
    same id are never each other's smaller document, so repeated rows stay alike; a
    null id is larger than all others. A text's repeats of itself stay. Extra
    columns are ignored unless asked for; an empty table gives no rows. Cutting
    bytes may split a character, so ``kept`` is binary; with ``decode`` it is text
    without the halves of such characters, and null where the text is null.
    """
    columns = columns or []
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), *[F.col(c).alias(f"_{c}") for c in columns])
    shards = parts(text_bytes(docs), shard_bytes)
    packed = stored(packs(docs), "repeat-packs")
    shared = stored(shared_anchors(pack_anchors(packed, shards), hot), "repeat-anchors")
    back = shard_results(fragments(packed, shared, shards))
    none = F.lit(None)
    told = (back.withColumns({"n": none.cast("int"), "keys": none.cast("binary"), "n_hot": none.cast("int"), "hot_keys": none.cast("binary")})
            .unionByName(shared.withColumn("shard", F.lit(-1).cast("long")), allowMissingColumns=True))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        pack = _read_pack(left)
        table = right.filter(pa.compute.greater_equal(right.column("shard"), 0)).sort_by("shard")
        covered = np.zeros(len(pack.data) + 1, np.int32)
        if right.num_rows:
            keys = right.filter(pa.compute.less(right.column("shard"), 0))
            begin, windows, doc, at, *_ = pack.shared(*_keys(keys), shards)
            flat = {c: table.column(c).combine_chunks().flatten().to_numpy() if table.num_rows else np.zeros(0, int) for c in ("runs", "stops", "least")}
            first = np.r_[0, np.cumsum(flat["runs"])]
            times = flat["runs"][at] if len(at) else np.zeros(0, int)
            row = np.repeat(np.arange(len(at)), times)
            run_ = np.repeat(first[at], times) + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            start = np.where(run_ == first[at][row], 0, flat["stops"][np.maximum(run_ - 1, 0)])
            gone = flat["least"][run_] < pack.ids[doc[row]]
            np.add.at(covered, begin[row][gone] + start[gone], 1)
            np.add.at(covered, begin[row][gone] + flat["stops"][run_][gone] + LENGTH - 1, -1)
        removed = np.cumsum(covered)[:-1] > 0
        out = []
        for a, b in zip(pack.begins.tolist(), pack.ends.tolist()):
            mask = removed[a:b]
            kept = pack.data[a:b][~mask].tobytes()
            out.append((b - a, int(mask.sum()), int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum()), hashlib.sha256(kept).hexdigest(), kept))
        give_back()
        n_bytes, n_removed, n_spans, sha, kept = zip(*out)
        if decode:
            kept = [k.decode(errors="ignore") if t.is_valid else None for k, t in zip(kept, pack.batch.column("text"))]
        table = {"doc_id": pack.batch.column("doc_id"), "n_bytes": pa.array(n_bytes, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                 "n_spans": pa.array(n_spans, pa.int64()), "kept_sha256": pa.array(sha), "kept": pa.array(kept, pa.string() if decode else pa.binary())}
        return pa.table(table | {c: (own := pack.batch.column(f"_{c}")).cast(nullable(own.type)) for c in columns})

    kinds = "".join(f", `{c}` {docs.schema[f'_{c}'].dataType.simpleString()}" for c in columns)
    return (packed.groupBy("pack_id").cogroup(told.groupBy("pack_id"))
            .applyInArrow(run, f"doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept {'string' if decode else 'binary'}{kinds}"))
