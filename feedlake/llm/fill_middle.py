"""Fill-in-the-middle over a seekable store of compressed frames.

A text is stored as independent zstandard frames of at most ``FRAME`` bytes, cut between
code points. Each frame carries how many units (``[A-Za-z]+|[^A-Za-z]``, left to right) and
code points begin before it. A cut after ``u`` units is found by searching these counts and
decompressing the one frame that holds it; every other frame passes into the output as it
is, still compressed. Digests and rebuilt texts stream the ordered frames, so that a task
holds one frame of a text in the clear at a time.

The output is a store as well: the pieces in the order of their form, with the markers
between them. ``restore`` finds the markers in that stream and puts the pieces back in the
order of the text, again frame by frame.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from feedlake.llm.common import slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FRAME = 1 << 16
LEVEL = 3
FRAMES = "array<struct<units:bigint,chars:bigint,inside:boolean,data:binary>>"
#: Shares of a hundred: texts left plain, and of the rest those that begin with the suffix.
PLAIN, SUFFIX_FIRST = 10, 20


def unit_starts(data: bytes, inside: bool) -> np.ndarray:
    """Byte offsets at which units begin; ``inside``: the bytes before end in a letter."""
    codes = np.frombuffer(data, np.uint8)
    letter = ((codes | 32) - np.uint8(97)) < 26
    begins = (codes & 0xC0) != 0x80
    begins[1:] &= ~(letter[1:] & letter[:-1])
    if inside and len(codes) and letter[0]:
        begins[0] = False
    return np.flatnonzero(begins)


def characters(data: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def _ends_in_letter(data: bytes) -> bool:
    return 0 <= (data[-1] | 32) - 97 < 26


def pieces(data: bytes, size: int) -> Iterator[bytes]:
    """``data`` in pieces of at most ``size`` bytes (4 at least), none cut inside a code point."""
    at = 0
    while at < len(data):
        end = min(len(data), at + size)
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        yield data[at:end]
        at = end


class Frames:
    """Packs pieces of bytes into frames and reads them again."""

    def __init__(self, size: int = FRAME):
        self.size = size
        self.pack, self.unpack = zstandard.ZstdCompressor(level=LEVEL).compress, zstandard.ZstdDecompressor().decompress

    def store(self, data: bytes) -> tuple[list[dict], int]:
        """The frames of a text, and its number of units."""
        frames, units, chars, inside = [], 0, 0, False
        for piece in pieces(data, self.size):
            frames.append({"units": units, "chars": chars, "inside": inside, "data": self.pack(piece)})
            units += len(unit_starts(piece, inside))
            chars += characters(piece)
            inside = _ends_in_letter(piece)
        return frames, units

    def cut(self, frames: list[dict], at: int, units: int) -> tuple[int, int, int]:
        """Where unit ``at`` begins: the frame, the byte offset in it, and the code points before it."""
        if at >= units:
            last = self.unpack(frames[-1]["data"]) if frames else b""
            return max(0, len(frames) - 1), len(last), (frames[-1]["chars"] + characters(last)) if frames else 0
        # of frames with equal counts the last one holds the unit: the others begin none
        number = bisect_right(frames, at, key=lambda f: f["units"]) - 1
        data = self.unpack(frames[number]["data"])
        offset = int(unit_starts(data, frames[number]["inside"])[at - frames[number]["units"]])
        return number, offset, frames[number]["chars"] + characters(data[:offset])

    def between(self, frames: list[dict], start: tuple[int, int], end: tuple[int, int]) -> Iterator[bytes | dict]:
        """The bytes from ``start`` to ``end`` (frame, offset): whole frames as they are, cut ones in the clear."""
        for number in range(start[0], min(end[0] + 1, len(frames))):
            low = start[1] if number == start[0] else 0
            if number < end[0] and low == 0:
                yield frames[number]
            elif number < end[0] or low < end[1]:
                yield self.unpack(frames[number]["data"])[low:end[1] if number == end[0] else None]

    def join(self, parts: Iterator[bytes | dict]) -> list[bytes]:
        """The frames of consecutive parts: whole frames as they are, what is clear between them packed anew."""
        out, held = [], bytearray()

        def flush(least: int) -> None:
            while len(held) >= least:
                out.append(self.pack(bytes(held[:self.size])))
                del held[:self.size]

        for part in parts:
            if isinstance(part, dict):
                flush(1)
                out.append(part["data"])
            else:
                held += part
                flush(self.size)
        flush(1)
        return out

    def markers(self, frames: list[bytes], wanted: tuple[bytes, ...], seen: Callable[[bytes], object]) -> list[tuple[int, int]]:
        """Where each of the wanted markers begins, in this order; ``seen`` takes every frame's bytes on the way."""
        found: list[tuple[int, int]] = []
        carried, sizes = b"", [0, 0, 0]  # a marker may cross frames, of a byte or two each at least
        for number, frame in enumerate(frames):
            data = self.unpack(frame)
            seen(data)
            window, sizes = carried + data, [*sizes[1:], len(data)]
            base, at = -len(carried), 0
            while len(found) < len(wanted) and (hit := window.find(wanted[len(found)], at)) >= 0:
                at, offset, back = hit + len(wanted[len(found)]), base + hit, number
                while offset < 0:
                    back -= 1
                    offset += sizes[-1 - (number - back)]
                found.append((back, offset))
            carried = window[max(at, len(window) - 2):]
        return found


def store(docs: DataFrame, key: str = "doc_id", text: str = "text", frame: int = FRAME) -> DataFrame:
    """``key, n, marked, frames``: the seekable store of every row's text, in units; no shuffle.

    ``n`` counts the units, ``marked`` tells whether the text holds one of the markers. A null
    text is an empty one: no units, no frames. Repeated rows and null keys stay rows of their
    own, other columns are ignored, and an empty table gives no rows.
    """
    marks = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marks = marks | F.contains(F.coalesce(F.col(text), F.lit("")), F.lit(mark))
    picked = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"), marks.alias("marked"))
    key_type = picked.schema["key"].dataType
    out_type = f"key {key_type.simpleString()}, n bigint, marked boolean, frames {FRAMES}"
    frames_type = _frames_type()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = Frames(frame)
        for batch in batches:
            for part in slices(batch, "text"):
                rows = [frames.store(t or b"") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([n for _, n in rows], pa.int64()), part.column(2), pa.array([f for f, _ in rows], frames_type)],
                    names=["key", "n", "marked", "frames"])
    return picked.mapInArrow(run, out_type).withColumnRenamed("key", key)


def _frames_type() -> pa.DataType:
    return pa.list_(pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("inside", pa.bool_()), ("data", pa.binary())]))


def _decisions(key: Column, n: Column, marked: Column, seed: int) -> dict[str, Column]:
    """Form and cuts by the sha256 of the seed and the key's decimal text (null key: no text)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]
    cuts = [h[i] % (n + 1) for i in range(2)]
    form = (F.when((n == 0) | marked | (h[2] % 100 >= 100 - PLAIN), F.lit("plain"))
            .when(h[3] % 100 < SUFFIX_FIRST, F.lit("spm")).otherwise(F.lit("psm")))
    return {"form": form, "first": F.least(*cuts), "second": F.greatest(*cuts)}


def transform(stored: DataFrame, key: str = "doc_id", seed: int = 1, frame: int = FRAME) -> DataFrame:
    """``key, n, form, prefix_chars, middle_chars, output``: each stored text in its form, as frames.

    ``stored`` has the columns of ``store``. Plain: the text. Psm: ``<P>`` prefix ``<S>`` suffix
    ``<M>`` middle. Spm: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle. Texts that are empty or hold a
    marker, and ten of a hundred others, are plain; their numbers of characters are null. A null
    key decides by the seed alone. Rows are independent, so repeated ones give equal rows.
    """
    made = _decisions(F.col(key), F.col("n"), F.col("marked"), seed)
    picked = stored.select(F.col(key).alias("key"), "n", made["form"].alias("form"), made["first"].alias("first"),
                           made["second"].alias("second"), "frames")
    out = f"key {picked.schema['key'].dataType.simpleString()}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output array<binary>"
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = Frames(frame)
        for batch in batches:
            rows = {"prefix_chars": [], "middle_chars": [], "output": []}
            held, start = 0, 0
            for i in range(batch.num_rows):
                parts = batch.column(5)[i].as_py()
                n, form = batch.column(1)[i].as_py(), batch.column(2)[i].as_py()
                if form == "plain":
                    prefix_chars = middle_chars = None
                    output = [f["data"] for f in parts]
                else:
                    low = frames.cut(parts, batch.column(3)[i].as_py(), n)
                    high = frames.cut(parts, batch.column(4)[i].as_py(), n)
                    prefix_chars, middle_chars = low[2], high[2] - low[2]
                    prefix = lambda: frames.between(parts, (0, 0), low[:2])
                    middle = lambda: frames.between(parts, low[:2], high[:2])
                    suffix = lambda: frames.between(parts, high[:2], (len(parts), 0))
                    order = ((p, prefix), (s, suffix), (m, middle)) if form == "psm" else ((s, suffix), (p, prefix), (m, middle))
                    output = frames.join(x for mark, piece in order for x in (mark, *piece()))
                rows["prefix_chars"].append(prefix_chars)
                rows["middle_chars"].append(middle_chars)
                rows["output"].append(output)
                held += sum(map(len, output))
                if held > 1 << 20 or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(c).slice(start, i + 1 - start) for c in range(3)]
                        + [pa.array(rows["prefix_chars"], pa.int64()), pa.array(rows["middle_chars"], pa.int64()),
                           pa.array(rows["output"], pa.list_(pa.binary()))],
                        names=["key", "n", "form", "prefix_chars", "middle_chars", "output"])
                    rows = {name: [] for name in rows}
                    held, start = 0, i + 1
    return picked.mapInArrow(run, out).withColumnRenamed("key", key)


def rebuilt(frames: Frames, output: list[bytes], form: str, seen: Callable[[bytes], object] = len) -> Iterator[bytes]:
    """The text of an output, piece by piece, from its frames and its form alone; ``seen`` gets the output's bytes."""
    if form == "plain":
        for frame in output:
            data = frames.unpack(frame)
            seen(data)
            yield data
        return
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    order = (p, s, m) if form == "psm" else (s, p, m)
    at = dict(zip(order, frames.markers(output, order, seen)))
    ends = dict(zip(order, [at[order[1]], at[order[2]], (len(output), 0)]))
    parts = [{"data": frame} for frame in output]
    for mark in (p, m, s):
        skip = len(mark)  # the marker itself may lie across two frames
        for part in frames.between(parts, at[mark], ends[mark]):
            data = frames.unpack(part["data"]) if isinstance(part, dict) else part
            yield data[skip:]
            skip = max(0, skip - len(data))


def restore(transformed: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, text``: the whole texts again, from ``form`` and ``output`` alone."""
    picked = transformed.select(F.col(key).alias("key"), "form", "output")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = Frames()
        for batch in batches:
            for i in range(batch.num_rows):
                text = b"".join(rebuilt(frames, batch.column(2)[i].as_py(), batch.column(1)[i].as_py()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([text.decode()])], names=["key", "text"])
    return (picked.mapInArrow(run, f"key {picked.schema['key'].dataType.simpleString()}, text string")
            .withColumnRenamed("key", key))


def digests(transformed: DataFrame) -> DataFrame:
    """All columns but ``output``, with the sha256 of the output and of the text rebuilt from it, both streamed."""
    others = [c for c in transformed.columns if c != "output"]
    picked = transformed.select(*others, "output")
    kinds = {f.name: f.dataType.simpleString() for f in picked.schema.fields}
    at = others.index("form")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = Frames()
        for batch in batches:
            whole, again = [], []
            for form, output in zip(batch.column(at).to_pylist(), batch.column(len(others))):
                digest, text = hashlib.sha256(), hashlib.sha256()
                for data in rebuilt(frames, output.as_py(), form, digest.update):
                    text.update(data)
                whole.append(digest.hexdigest())
                again.append(text.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(others)], pa.array(whole, pa.string()), pa.array(again, pa.string())],
                                             names=[*others, "output_sha256", "restored_sha256"])
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in others)
    return picked.mapInArrow(run, f"{schema}, output_sha256 string, restored_sha256 string")
