"""Fill-in-middle transformation over seekable compressed frames.

A text is stored as independent zstandard frames of bounded size, each with the units (lines) and code points that come
before it.  A cut after a number of units is found by those counts, and only the frame that holds it is decompressed and
divided; the other frames of prefix, middle and suffix are passed on as they are.  The output is again a list of
frames, the sentinels between them, so text is never put together whole to be reordered.  Digests stream the frames
in order, one at a time.

Forms: ``plain`` (the text), ``psm`` (``<P>`` prefix ``<S>`` suffix ``<M>`` middle) and ``spm`` (``<S>`` suffix ``<P>`` prefix
``<M>`` middle).  A text that holds a sentinel stays plain, so the parts can be told apart in the output again.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesmith.llm.common import table

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
#: Bytes of text per frame and rows per block of work.
FRAME_BYTES, ROWS = 64 << 10, 256
SEED, FIM_PERCENT, SPM_PERCENT = 7, 100, 50

STORED = ("frames array<struct<data: binary, units: bigint, chars: bigint>>, n bigint, chars bigint, sentinel boolean")
FRAMES = pa.list_(pa.struct([("data", pa.binary()), ("units", pa.int64()), ("chars", pa.int64())]))


class Frame(NamedTuple):
    """Compressed bytes, and the newlines and code points of the text before them."""
    data: bytes
    units: int
    chars: int


def _code_points(data: bytes) -> int:
    b = np.frombuffer(data, np.uint8)
    return len(b) - int(np.count_nonzero((b & 0xC0) == 0x80))


def _ends(data: bytes, size: int) -> Iterator[int]:
    """Ends of pieces of at most ``size`` bytes that don't divide a character."""
    end = 0
    while end < len(data):
        end = min(end + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        yield end


def store(data: bytes, size: int = FRAME_BYTES) -> list[Frame]:
    """Frames of a UTF-8 text; an empty text has none."""
    press, frames, start, units, chars = zstandard.ZstdCompressor(level=3), [], 0, 0, 0
    for end in _ends(data, size):
        piece = data[start:end]
        frames.append(Frame(press.compress(piece), units, chars))
        units, chars, start = units + piece.count(b"\n"), chars + _code_points(piece), end
    return frames


def stream(frames: list[Frame]) -> Iterator[bytes]:
    """The text, a frame at a time."""
    unpress = zstandard.ZstdDecompressor()
    for f in frames:
        yield unpress.decompress(f.data)


def divide(frames: list[Frame], cut: int, n: int) -> tuple[list[Frame], list[Frame], int]:
    """(frames before, frames after, code points before or -1 at the end) of the place after ``cut`` of ``n`` units."""
    if cut == 0:
        return [], frames, 0
    if cut == n:
        return frames, [], -1
    # the last frame with fewer newlines before it than the cut holds the newline that ends it
    at = bisect_left(frames, cut, key=lambda f: f.units) - 1
    frame = frames[at]
    data = zstandard.ZstdDecompressor().decompress(frame.data)
    end = 0
    for _ in range(cut - frame.units):
        end = data.index(b"\n", end) + 1
    press, points = zstandard.ZstdCompressor(level=3), frame.chars + _code_points(data[:end])
    after = [Frame(press.compress(data[end:]), cut, points)] if end < len(data) else []
    return [*frames[:at], Frame(press.compress(data[:end]), frame.units, frame.chars)], after + frames[at + 1:], points


def rearrange(frames: list[Frame], n: int, chars: int, low: int, high: int, form: str) -> tuple[list[Frame], int, int]:
    """(output frames, code points of the prefix, of the middle) with cuts after ``low`` and ``high`` units."""
    head, suffix, to_high = divide(frames, high, n)
    prefix, middle, to_low = divide(head, low, high)
    to_high = chars if to_high < 0 else to_high
    to_low = to_high if to_low < 0 else to_low
    press = zstandard.ZstdCompressor(level=3)
    parts = {PREFIX: prefix, SUFFIX: suffix, MIDDLE: middle}
    out = [f for mark in ORDER[form] for f in (Frame(press.compress(mark), 0, 0), *parts[mark])]
    return out, to_low, to_high - to_low


def _part(frames: list[Frame], start: tuple[int, int], end: tuple[int, int]) -> Iterator[bytes]:
    """The text between two places, each a frame and a byte in it."""
    unpress = zstandard.ZstdDecompressor()
    for k in range(start[0], min(end[0] + 1, len(frames))):
        data = unpress.decompress(frames[k].data)
        yield data[start[1] if k == start[0] else 0:end[1] if k == end[0] else len(data)]


def restore(frames: list[Frame], form: str) -> Iterator[bytes]:
    """The original text from output frames and form: the sentinels are looked for in the output's text (also across
    frames, each in its turn), and the parts are streamed in the text's order."""
    if form == "plain":
        yield from stream(frames)
        return
    marks, places, offsets, offset, carry = list(ORDER[form]), [], [], 0, b""
    for data in stream(frames):
        offsets.append(offset)
        window, base, at = carry + data, offset - len(carry), 0
        while marks and (hit := window.find(marks[0], at)) >= 0:
            at = hit + len(marks.pop(0))
            places.append((base + hit, base + at))
        if not marks:
            break
        offset += len(data)
        carry = window[max(at, len(window) - 2):]

    def place(byte):  # offset in the output -> (frame, byte in it)
        k = bisect_right(offsets, byte) - 1
        return k, byte - offsets[k]

    first, second, third = places
    spans = {ORDER[form][0]: (place(first[1]), place(second[0])), ORDER[form][1]: (place(second[1]), place(third[0])),
             MIDDLE: (place(third[1]), (len(frames), 0))}
    for part in (PREFIX, MIDDLE, SUFFIX):
        yield from _part(frames, *spans[part])


def _sha(pieces: Iterator[bytes]) -> str:
    h = hashlib.sha256()
    for x in pieces:
        h.update(x)
    return h.hexdigest()


def store_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """(id, frames, n, chars, sentinel) per row: the seekable store of the texts, with their units and code points.
    A null text is stored as an empty one."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                frames, n, chars, sentinel = [], [], [], []
                for x in part.column(1).cast(pa.large_binary()):
                    data = x.as_py() or b""
                    frames.append([f._asdict() for f in store(data, frame_bytes)])
                    n.append(data.count(b"\n") + (data[-1:] not in (b"", b"\n")))
                    chars.append(_code_points(data))
                    sentinel.append(any(m in data for m in (PREFIX, SUFFIX, MIDDLE)))
                yield pa.record_batch([part.column(0), pa.array(frames, FRAMES), pa.array(n, pa.int64()), pa.array(chars, pa.int64()),
                                       pa.array(sentinel, pa.bool_())], ["id", "frames", "n", "chars", "sentinel"])

    return d.mapInArrow(run, f"id {d.schema['id'].dataType.simpleString()}, {STORED}").withColumnRenamed("id", id_col)


def plan(stored: DataFrame, id_col: str = "doc_id", seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """``stored`` with cuts (``low``, ``high``) and ``form``, drawn from the SHA-256 of seed and id (a null id counts as empty)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    cuts = [h[0] % (F.col("n") + 1), h[1] % (F.col("n") + 1)]
    plain = (F.col("chars") == 0) | F.col("sentinel") | (h[2] % 100 >= fim_percent)
    form = F.when(plain, "plain").when(h[3] % 100 < spm_percent, "spm").otherwise("psm")
    return stored.withColumns({"low": F.least(*cuts), "high": F.greatest(*cuts), "form": form})


def transform(planned: DataFrame, id_col: str = "doc_id", texts: bool = False) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of planned rows; with ``texts`` the
    transformed text, too, as ``output``.  Digests stream the output's frames; the restored one is that of the text that
    output and form give back.  Frames are read one row at a time."""
    d = planned.select(F.col(id_col).alias("id"), "frames", "n", "chars", "low", "high", "form")
    names = ["id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"] + ["output"] * texts
    longs = pa.int64()

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                rows = []
                for frames, n, chars, low, high, form in zip(*(part.column(c) for c in range(1, 7))):
                    out, form = [Frame(x["data"].as_py(), x["units"].as_py(), x["chars"].as_py()) for x in frames], form.as_py()
                    prefix = middle = None
                    if form != "plain":
                        out, prefix, middle = rearrange(out, n.as_py(), chars.as_py(), low.as_py(), high.as_py(), form)
                    rows.append((form, prefix, middle, _sha(stream(out)), _sha(restore(out, form)), b"".join(stream(out)).decode() if texts else None))
                form, prefix, middle, out, back, text = map(list, zip(*rows))
                columns = [part.column(0), part.column(2), pa.array(form), pa.array(prefix, longs), pa.array(middle, longs), pa.array(out), pa.array(back)]
                yield pa.record_batch(columns + [pa.array(text)] * texts, names)

    schema = f"id {d.schema['id'].dataType.simpleString()}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string"
    return d.mapInArrow(run, schema + ", output string" * texts).withColumnRenamed("id", id_col)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, fim_percent: int = FIM_PERCENT,
                   spm_percent: int = SPM_PERCENT, texts: bool = True) -> DataFrame:
    """Stores the texts as frames (a written table), plans the cuts and transforms every row; see ``transform``.

    * Null and empty texts are plain with no units.  ``n`` counts lines with their ends, a last one without end, too.
    * Rows are judged alone: repeated rows, and rows of equal id, get the cuts of their id; a null id has cuts as well.
    * Texts are cut whole, however long: frames are bounded, and so is what is decompressed at once.
    * Extra columns are ignored; an empty table gives an empty one.
    """
    stored = table(store_documents(docs, id_col, text_col), "fim-frames")
    return transform(plan(stored, id_col, seed, fim_percent, spm_percent), id_col, texts)
