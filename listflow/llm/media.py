"""Media columns: GIF files read into timed frames with colour histograms, and written losslessly.

The reader decodes LZW code streams, applies global and local palettes, interlacing, the disposal
of the frame before and transparency. The writer stores bytes as palette indexes, one index per
sample, so any payload comes back bit by bit.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from listflow.llm.frames import schema_with
from listflow.llm.textbytes import byte_slices

#: Width of a stored frame. Its height is a multiple of it, so a payload is filled up to squares.
SIDE = 24
UNIT = SIDE * SIDE
#: Squares in a stored frame; the last frame of a payload may have fewer.
SQUARES = 32
#: Time that a stored frame is shown, in hundredths of a second.
DELAY = 10


@dataclass
class Frame:
    """``index`` holds the frame's own samples; ``canvas`` the whole picture after it is drawn, as RGB."""

    index: np.ndarray
    canvas: np.ndarray
    start_ms: int
    delay_ms: int
    disposal: int
    transparent: int | None


#: Codes whose places are worked out at once; by then every code has 12 bits.
_RUN = 4096


def _schedule(first: int) -> tuple[np.ndarray, np.ndarray]:
    """Bit offset and width of each of the first ``_RUN`` codes after a clear code.

    The table grows by one entry per code after the first; codes widen with its next number.
    """
    number = np.minimum((1 << (first - 1)) + 2 + np.maximum(np.arange(_RUN) - 1, 0), 4095)
    width = np.maximum(first, np.floor(np.log2(number)).astype(np.int64) + 1)
    return np.concatenate([[0], np.cumsum(width)]), width


_SCHEDULES = {first: _schedule(first) for first in range(3, 10)}
_LITERALS = {least: [bytes([i]) for i in range(1 << least)] + [b"", b""] for least in range(2, 9)}


def _places(first: int, since: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bit offsets and widths of ``n`` codes, the first of which stands ``since`` codes after a clear code."""
    offsets, widths = _SCHEDULES[first]
    if since + n <= _RUN:
        return offsets[since:since + n], widths[since:since + n]
    i = np.arange(since, since + n)
    return offsets[np.minimum(i, _RUN)] + 12 * np.maximum(i - _RUN, 0), widths[np.minimum(i, _RUN - 1)]


def lzw_decode(stream: bytes, least: int, samples: int) -> bytes:
    """The first ``samples`` indexes of an LZW stream whose literal codes have ``least`` bits.

    A damaged or short stream gives the samples before the damage, filled up with zeros.
    """
    clear, stop = 1 << least, (1 << least) + 1
    padded = np.frombuffer(stream + b"\0\0\0\0", np.uint8).astype(np.uint32)
    bits, start, since, out, done = len(stream) * 8, 0, 0, [], 0
    table, last = list(_LITERALS[least]), b""
    while done < samples:
        offsets, widths = _places(least + 1, since, min(_RUN, samples - done + 2))
        where = start + offsets
        n = int(np.searchsorted(where + widths, bits, side="right"))
        if not n:
            break
        where, widths = where[:n], widths[:n]
        byte = where >> 3
        word = padded[byte] | padded[byte + 1] << np.uint32(8) | padded[byte + 2] << np.uint32(16)
        codes = (word >> (where & 7).astype(np.uint32)) & ((1 << widths) - 1).astype(np.uint32)
        ends = np.flatnonzero((codes == clear) | (codes == stop))
        length = int(ends[0]) if len(ends) else n
        for code in codes[:length].tolist():
            if code < len(table):
                entry = table[code]
            elif code == len(table) and last:
                entry = last + last[:1]
            else:
                return (b"".join(out) + bytes(samples))[:samples]
            out.append(entry)
            done += len(entry)
            if last and len(table) < 4096:
                table.append(last + entry[:1])
            last = entry
        if not len(ends):
            since += n
            continue
        if codes[length] == stop:
            break
        start, since = int(where[length] + widths[length]), 0
        table, last = list(_LITERALS[least]), b""
    return (b"".join(out) + bytes(samples))[:samples]


def lzw_encode(data: bytes, least: int = 8) -> bytes:
    """An LZW stream of ``data``; the table is cleared whenever it is full."""
    clear, stop = 1 << least, (1 << least) + 1
    widths = _SCHEDULES[least + 1][1]
    packed_codes: list[np.ndarray] = []
    packed_widths: list[np.ndarray] = []

    def pack(codes: list[int], mark: int) -> None:
        packed_codes.append(np.array(codes + [mark], np.uint32))
        packed_widths.append(widths[:len(codes) + 1])

    packed_codes.append(np.array([clear], np.uint32))
    packed_widths.append(np.array([least + 1]))
    codes: list[int] = []
    table: dict[int, int] = {}
    known, after = table.get, stop + 1
    entry = data[0] if data else 0
    for byte in data[1:]:
        key = entry << 8 | byte
        longer = known(key)
        if longer is not None:
            entry = longer
            continue
        codes.append(entry)
        entry = byte
        if after < 4095:
            table[key] = after
            after += 1
        else:
            pack(codes, clear)
            codes, table, after = [], {}, stop + 1
            known = table.get
    if data:
        codes.append(entry)
    pack(codes, stop)
    every, width = np.concatenate(packed_codes), np.concatenate(packed_widths).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(width)])
    room = np.zeros((int(at[-1]) >> 3) + 4, np.uint32)
    shifted = every << (at[:-1] & 7).astype(np.uint32)
    for k in range(3):
        # neighbouring codes share no bit, so adding is joining
        room[:] += np.bincount((at[:-1] >> 3) + k, (shifted >> np.uint32(8 * k)) & np.uint32(255), len(room)).astype(np.uint32)
    return room[:(int(at[-1]) + 7) >> 3].astype(np.uint8).tobytes()


def _blocks(stream: bytes) -> bytes:
    return b"".join(bytes([len(stream[i:i + 255])]) + stream[i:i + 255] for i in range(0, len(stream), 255)) + b"\0"


#: Three bits of red, three of green, two of blue: each index is a colour of its own.
PALETTE = np.stack([
    (np.arange(256) >> 5) * 255 // 7, (np.arange(256) >> 2 & 7) * 255 // 7, (np.arange(256) & 3) * 85], axis=1).astype(np.uint8)


def write_gif(payload: bytes) -> bytes:
    """A GIF of frames that are ``SIDE`` wide and hold up to ``SQUARES`` units of the payload each."""
    if not payload or len(payload) % UNIT:
        raise ValueError(f"the payload's length must be a positive multiple of {UNIT}")
    step = SQUARES * UNIT
    out = [b"GIF89a", struct.pack("<HHBBB", SIDE, min(len(payload), step) // SIDE, 0xF7, 0, 0), PALETTE.tobytes()]
    for at in range(0, len(payload), step):
        part = payload[at:at + step]
        out.append(struct.pack("<BBBBHBB", 0x21, 0xF9, 4, 1 << 2, DELAY, 0, 0))
        out.append(struct.pack("<BHHHHB", 0x2C, 0, 0, SIDE, len(part) // SIDE, 0))
        out.append(b"\x08" + _blocks(lzw_encode(part)))
    return b"".join(out) + b";"


def _sub_blocks(raw: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while at < len(raw) and raw[at]:
        parts.append(raw[at + 1:at + 1 + raw[at]])
        at += 1 + raw[at]
    return b"".join(parts), at + 1


def _interlaced(rows: np.ndarray) -> np.ndarray:
    """Rows sent in four passes, back in their places."""
    height = len(rows)
    order = [y for first, step in ((0, 8), (4, 8), (2, 4), (1, 2)) for y in range(first, height, step)]
    out = np.empty_like(rows)
    out[order] = rows
    return out


def read_gif(raw: bytes) -> Iterator[Frame]:
    """The frames of a GIF in order. What follows damage in the container is not read: a file cut anywhere
    gives the frames before the cut, a frame outside the canvas ends the reading, and a canvas larger than
    the file's bytes can fill has no frames.

    Disposal 2 clears the frame's area and 3 brings back what was there before it; the frame's
    transparent index leaves the canvas as it is. A frame of no delay starts with the next one.
    """
    if raw[:3] != b"GIF" or len(raw) < 13:
        return
    width, height, flags = struct.unpack("<HHB", raw[6:11])
    at, shared = 13, None
    if flags & 0x80:
        size = 2 << (flags & 7)
        shared = np.frombuffer(raw[at:at + 3 * size], np.uint8)
        if len(shared) < 3 * size:
            return
        shared = shared.reshape(-1, 3)
        at += 3 * size
    # a code of three bits at least stands for 4096 pixels at most
    if width * height > len(raw) * 8 // 3 * 4096:
        return
    canvas = np.zeros((height, width, 3), np.uint8)
    delay, disposal, transparent, start = 0, 0, None, 0
    while at < len(raw):
        kind = raw[at]
        if kind == 0x21:
            if raw[at + 1:at + 3] == b"\xf9\x04" and at + 8 <= len(raw):
                packed, delay, index = struct.unpack("<BHB", raw[at + 3:at + 7])
                disposal, transparent = packed >> 2 & 7, index if packed & 1 else None
            _, at = _sub_blocks(raw, at + 2)
        elif kind == 0x2C and at + 11 <= len(raw):
            left, top, w, h, packed = struct.unpack("<HHHHB", raw[at + 1:at + 10])
            at += 10
            palette = shared
            if packed & 0x80:
                size = 2 << (packed & 7)
                palette = np.frombuffer(raw[at:at + 3 * size], np.uint8)
                if len(palette) < 3 * size:
                    return
                palette = palette.reshape(-1, 3)
                at += 3 * size
            if at >= len(raw) or not 2 <= raw[at] <= 8 or left + w > width or top + h > height:
                return
            stream, after = _sub_blocks(raw, at + 1)
            index = np.frombuffer(lzw_decode(stream, raw[at], w * h), np.uint8).reshape(h, w)
            at = after
            if packed & 0x40:
                index = _interlaced(index)
            palette = np.repeat(np.arange(256, dtype=np.uint8)[:, None], 3, axis=1) if palette is None else palette
            before = canvas.copy() if disposal == 3 else None
            area = canvas[top:top + h, left:left + w]
            seen = index[:area.shape[0], :area.shape[1]]
            colours = palette[np.minimum(seen, len(palette) - 1)]
            if transparent is None:
                area[:] = colours
            else:
                area[:] = np.where((seen == transparent)[:, :, None], area, colours)
            yield Frame(index, canvas.copy(), start, delay * 10, disposal, transparent)
            if disposal == 2:
                area[:] = 0
            elif disposal == 3:
                canvas = before
            start += delay * 10
            delay, disposal, transparent = 0, 0, None
        else:
            return


def colour_histogram(canvas: np.ndarray) -> np.ndarray:
    """Pixels by the top two bits of red, green and blue: 64 counts."""
    top = (canvas.reshape(-1, 3) >> 6).astype(np.int64)
    return np.bincount(top[:, 0] * 16 + top[:, 1] * 4 + top[:, 2], minlength=64)


def _rest(batch: pa.RecordBatch, names: list[str]) -> list[pa.Array]:
    return [batch.column(batch.schema.get_field_index(n)) for n in names]


def store_texts(docs: DataFrame, text_col: str = "text", into: str = "media") -> DataFrame:
    """``docs`` without its text, with the GIF of the text's payload in ``into`` and its length in ``n_bytes``.

    The payload is the UTF-8 text (null: empty) and bytes 255 up to a positive multiple of ``UNIT``.
    Columns of those two names are replaced; repeated rows stay.
    """
    kept = [c for c in docs.columns if c not in (text_col, into, "n_bytes")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, text_col):
                raw = [(t or "").encode() for t in part[text_col].to_pylist()]
                media = [write_gif(t + b"\xff" * (-len(t) % UNIT or (0 if t else UNIT))) for t in raw]
                yield pa.RecordBatch.from_arrays(
                    _rest(part, kept) + [pa.array(map(len, raw), pa.int64()), pa.array(media, pa.binary())],
                    names=kept + ["n_bytes", into])

    return docs.select(*kept, text_col).mapInArrow(run, schema_with(docs, kept, f"n_bytes long, `{into}` binary"))


def media_frames(media: DataFrame, key: str, media_col: str = "media") -> DataFrame:
    """One row per frame: ``key``, frame number, start and delay in ms, size, disposal, samples, 64 colour counts.

    A null or unreadable file has no frames. ``histogram`` counts the drawn canvas, ``samples``
    are the frame's own palette indexes.
    """
    schema = schema_with(media, [key], "frame int, start_ms long, delay_ms int, width int, height int, disposal int, "
                                       "samples binary, histogram array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, media_col):
                rows = [(k, i, f.start_ms, f.delay_ms, f.index.shape[1], f.index.shape[0], f.disposal,
                         f.index.tobytes(), colour_histogram(f.canvas).tolist())
                        for k, raw in zip(part[key].to_pylist(), part[media_col].to_pylist())
                        for i, f in enumerate(read_gif(raw or b""))]
                columns = list(zip(*rows)) if rows else [()] * 9
                kinds = [part[key].type, pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(),
                         pa.binary(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=[key, "frame", "start_ms", "delay_ms", "width", "height", "disposal", "samples", "histogram"])

    return media.select(key, media_col).mapInArrow(run, schema)


def media_digest(media: DataFrame, media_col: str = "media") -> DataFrame:
    """``media`` without the file, with digests of the stored form and of what is read back from it.

    ``payload_*`` come from the samples that the reader returns, ``tail_crc32`` from the last 32 of
    them. ``feature`` names frames, size, length in ms and the colour histogram over all frames, its
    counts as hexadecimal shares of 255. A null or unreadable file has an empty payload.
    """
    made = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kept = [c for c in media.columns if c != media_col and c not in made]

    def digest(raw: bytes) -> tuple:
        payload, counts, frames, ms, size = [], np.zeros(64, np.int64), 0, 0, "0x0"
        for frame in read_gif(raw):
            payload.append(frame.index.tobytes())
            counts += colour_histogram(frame.canvas)
            frames, ms = frames + 1, frame.start_ms + frame.delay_ms
            size = f"{frame.canvas.shape[1]}x{frame.canvas.shape[0]}"
        whole = b"".join(payload)
        shares = bytes((counts * 255 // max(1, counts.sum())).astype(np.uint8)).hex()
        return (len(whole), hashlib.sha256(whole).hexdigest(), zlib.crc32(whole[-32:]), len(raw),
                hashlib.sha256(raw).hexdigest(), f"gif {size} frames={frames} ms={ms} rgb={shares}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        for batch in batches:
            for part in byte_slices(batch, media_col):
                rows = [digest(raw or b"") for raw in part[media_col].to_pylist()]
                columns = list(zip(*rows)) if rows else [()] * 6
                yield pa.RecordBatch.from_arrays(
                    _rest(part, kept) + [pa.array(c, k) for c, k in zip(columns, kinds)], names=kept + made)

    return media.select(*kept, media_col).mapInArrow(run, schema_with(
        media, kept, "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, "
                     "media_sha256 string, feature string"))
