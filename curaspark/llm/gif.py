"""GIF media columns: LZW code streams, palettes, disposal, transparency and timed frames.

``gif_frames`` decodes a binary column into one row of frames per image. ``texts_as_gif`` stores
any text losslessly as an 8-bit GIF (a pixel is a byte) and decodes the stored bytes again.

Defined results: a null or broken image gives an empty frame list and a message in ``error``; a null
or empty text is stored as one row of spaces; equal inputs give equal outputs; further columns of
the input with clashing names are not read. Work is per row, so skew in any key does not matter.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curaspark.llm import common

FRAME = (
    "struct<frame_no:int,delay_ms:int,left:int,top:int,width:int,height:int,canvas_width:int,"
    "canvas_height:int,disposal:int,mode:string,pixels:binary,hist_rgb:array<int>,hist_luma:array<int>>"
)
_FRAME_ARROW = pa.struct(
    [(n, pa.int32()) for n in ("frame_no", "delay_ms", "left", "top", "width", "height", "canvas_width", "canvas_height", "disposal")]
    + [("mode", pa.string()), ("pixels", pa.binary()), ("hist_rgb", pa.list_(pa.int32())), ("hist_luma", pa.list_(pa.int32()))]
)
ROW_BYTES = 192
MAX_ROWS = 4096


class BrokenGif(ValueError):
    pass


# ---- LZW ----


def _widths(n: int, size: int) -> np.ndarray:
    """Bits of the first n codes after a clear code, for a minimum code size."""
    free = (1 << size) + 2 + np.maximum(np.arange(n) - 1, 0)
    return np.clip(np.ceil(np.log2(free + 1)).astype(np.int64), size + 1, 12)


_LAYOUT: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _layout(n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bit offsets (n + 1) and widths (n) of the codes that follow a clear code."""
    if size not in _LAYOUT or len(_LAYOUT[size][1]) < n:
        widths = _widths(max(n, 8192), size)
        _LAYOUT[size] = (np.concatenate([[0], np.cumsum(widths)]), widths)
    offsets, widths = _LAYOUT[size]
    return offsets[: n + 1], widths[:n]


def lzw_encode(data: bytes, size: int = 8) -> bytes:
    """Greedy LZW; the table is cleared when it is full."""
    clear = 1 << size
    out: list[int] = []
    runs: list[int] = []  # number of codes in each run that a clear code starts
    append, table, free, begun = out.append, {}, clear + 2, 0
    word = data[0]
    for byte in data[1:]:
        key = word << 8 | byte
        known = table.get(key)
        if known is not None:
            word = known
            continue
        append(word)
        if free < 4096:
            table[key] = free
            free += 1
        else:
            append(clear)
            runs.append(len(out) - begun)
            table, free, begun = {}, clear + 2, len(out)
        word = byte
    out += [word, clear + 1]
    runs.append(len(out) - begun)
    codes = np.array([clear, *out], dtype=np.uint32)
    widths = np.concatenate([[size + 1], *[_layout(n, size)[1] for n in runs]])
    at = np.cumsum(widths) - widths
    value = codes.astype(np.uint32) << (at & 7).astype(np.uint32)
    byte_at = at >> 3
    n = int((at[-1] + widths[-1] + 7) >> 3)
    packed = sum(np.bincount(byte_at + k, weights=(value >> np.uint32(8 * k)) & 255, minlength=n + 3) for k in range(3))
    return packed[:n].astype(np.uint8).tobytes()


def _expand(codes: np.ndarray, clear: int) -> np.ndarray:
    """Bytes of one run of codes without clear or end code.

    The entry that code i makes is the string of code i and the first byte of what follows, and both
    stand in the output from code i's own start on. So each code names a place further left to
    copy from, and following the places (doubling the step each time) ends at literal bytes.
    """
    index = np.arange(len(codes), dtype=np.int64)
    literal = codes < clear
    place = np.where(literal, index, codes - (clear + 2))
    if (place[~literal] >= index[~literal]).any():
        raise BrokenGif("a code that is not yet defined")
    steps, jump = (~literal).astype(np.int64), place
    while True:
        further = jump[jump]
        if (further == jump).all():
            break
        steps = steps + steps[jump]
        jump = further
    lengths = steps + 1
    starts = np.cumsum(lengths) - lengths
    total = int(lengths.sum())
    source = np.arange(total, dtype=np.int64) + np.repeat(starts[place] - starts, lengths)
    while True:
        further = source[source]
        if (further == source).all():
            break
        source = further
    values = np.zeros(total, np.uint8)
    values[starts[literal]] = codes[literal]
    return values[source]


def lzw_decode(stream: bytes, size: int, wanted: int) -> np.ndarray:
    """The first ``wanted`` palette indices of a code stream."""
    clear, end = 1 << size, (1 << size) + 1
    buffer = np.frombuffer(stream + b"\0\0\0", dtype=np.uint8).astype(np.uint32)
    bits, at, got, parts = 8 * len(stream), 0, 0, []
    while got < wanted:
        guess = 4200
        while True:
            offsets, widths = _layout(guess, size)
            n = int(np.searchsorted(offsets, bits - at, side="right")) - 1
            n = min(n, guess)
            place = at + offsets[:n]
            byte = place >> 3
            three = buffer[byte] | buffer[byte + 1] << 8 | buffer[byte + 2] << 16
            codes = (three >> (place & 7).astype(np.uint32) & ((1 << widths[:n]) - 1).astype(np.uint32)).astype(np.int64)
            special = np.flatnonzero((codes == clear) | (codes == end))
            if len(special) or n < guess:
                break
            guess *= 2
        stop = int(special[0]) if len(special) else n
        if stop:
            if ((codes[:stop] - (clear + 2)) >= 4096 - (clear + 2)).any():
                raise BrokenGif("a code beyond the table")
            parts.append(_expand(codes[:stop], clear))
            got += len(parts[-1])
        if not len(special) or codes[stop] == end:
            break
        at += int(offsets[stop] + widths[stop])
    if got < wanted:
        raise BrokenGif(f"{got} of {wanted} pixels")
    return np.concatenate(parts)[:wanted]


# ---- the file ----


def _blocks(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while True:
        n = data[at]
        if not n:
            return b"".join(parts), at + 1
        parts.append(data[at + 1 : at + 1 + n])
        if len(parts[-1]) < n:
            raise BrokenGif("the file ends in a block")
        at += n + 1


def _palette(data: bytes, at: int, flags: int) -> tuple[np.ndarray | None, int]:
    if not flags & 0x80:
        return None, at
    n = 2 << (flags & 7)
    colours = np.zeros((256, 3), np.uint8)
    colours[:n] = np.frombuffer(data[at : at + 3 * n], np.uint8).reshape(-1, 3)
    return colours, at + 3 * n


def _stored(canvas: np.ndarray) -> tuple[str, bytes, list[int], list[int]]:
    """The smallest lossless pixel form, and the histograms of the shown pixels."""
    red, green, blue, alpha = (canvas[:, :, k] for k in range(4))
    shown = alpha > 0
    if shown.all():
        if np.array_equal(red, green) and np.array_equal(red, blue):
            levels = np.bincount(red.ravel(), minlength=256)
            cube = np.zeros(64, np.int64)
            cube[np.arange(4) * 21] = levels.reshape(4, 64).sum(axis=1)
            return "L", red.tobytes(), cube.tolist(), levels.reshape(16, 16).sum(axis=1).tolist()
        mode, stored = "RGB", np.ascontiguousarray(canvas[:, :, :3]).tobytes()
    else:
        mode, stored = "RGBA", canvas.tobytes()
    r, g, b = (x[shown].astype(np.int64) for x in (red, green, blue))
    cube = np.bincount((r >> 6) * 16 + (g >> 6) * 4 + (b >> 6), minlength=64)
    luma = np.bincount((299 * r + 587 * g + 114 * b) // 16000, minlength=16)
    return mode, stored, cube.tolist(), luma.tolist()


#: Bounds of what one image may need: pixels of its screen, and bytes of all its shown frames together.
MAX_PIXELS, MAX_BYTES = 1 << 24, 1 << 28


def decode_gif(data: bytes, max_pixels: int = MAX_PIXELS, max_bytes: int = MAX_BYTES) -> list[dict]:
    """The timed frames as they show, after palette, transparency and disposal. An image beyond the bounds counts as broken."""
    try:
        return _decode(data, max_pixels, max_bytes)
    except (IndexError, struct.error, ValueError) as error:
        raise BrokenGif(str(error) or "broken") from error


def _decode(data: bytes, max_pixels: int, max_bytes: int) -> list[dict]:
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise BrokenGif("no GIF signature")
    wide, high, flags = struct.unpack("<HHB", data[6:11])
    if wide * high > max_pixels:
        raise BrokenGif(f"a screen of {wide} x {high} is beyond {max_pixels} pixels")
    shared, at = _palette(data, 13, flags)
    canvas = np.zeros((high, wide, 4), np.uint8)
    frames: list[dict] = []
    disposal = delay = held = 0
    clear_index = None
    while data[at] != 0x3B:
        kind = data[at]
        if kind == 0x21:
            label = data[at + 1]
            body, at = _blocks(data, at + 2)
            if label == 0xF9 and len(body) >= 4:
                disposal, delay = body[0] >> 2 & 7, 10 * (body[1] | body[2] << 8)
                clear_index = body[3] if body[0] & 1 else None
            continue
        if kind != 0x2C:
            raise BrokenGif(f"unknown block {kind}")
        left, top, width, height, flags = struct.unpack("<HHHHB", data[at + 1 : at + 10])
        own, at = _palette(data, at + 10, flags)
        colours = own if own is not None else shared
        if colours is None:
            raise BrokenGif("no palette")
        if left + width > wide or top + height > high:
            raise BrokenGif("a frame beyond the screen")
        size = data[at]
        if not 2 <= size <= 8:
            raise BrokenGif("code size")
        stream, at = _blocks(data, at + 1)
        index = lzw_decode(stream, size, width * height).reshape(height, width)
        if flags & 0x40:
            order = np.concatenate([np.arange(a, height, b) for a, b in ((0, 8), (4, 8), (2, 4), (1, 2))])
            woven = np.empty_like(index)
            woven[order] = index
            index = woven
        before = canvas.copy() if disposal == 3 else None
        part = canvas[top : top + height, left : left + width]
        painted = np.empty((height, width, 4), np.uint8)
        painted[:, :, :3] = colours[index]
        painted[:, :, 3] = 255
        if clear_index is None:
            part[:] = painted
        else:
            opaque = index != clear_index
            part[opaque] = painted[opaque]
        mode, stored, cube, luma = _stored(canvas)
        held += len(stored)
        if held > max_bytes:
            raise BrokenGif(f"frames beyond {max_bytes} bytes")
        frames.append(
            {"frame_no": len(frames), "delay_ms": delay, "left": left, "top": top, "width": width, "height": height, "canvas_width": wide,
             "canvas_height": high, "disposal": disposal, "mode": mode, "pixels": stored, "hist_rgb": cube, "hist_luma": luma}
        )
        if disposal == 2:
            part[:] = 0
        elif before is not None:
            canvas = before
        disposal, delay, clear_index = 0, 0, None
    return frames


_GREY = bytes(np.repeat(np.arange(256, dtype=np.uint8), 3))


def encode_grey(payload: bytes, width: int = ROW_BYTES, max_rows: int = MAX_ROWS, delay_cs: int = 10) -> bytes:
    """Bytes as the pixels of a grey GIF, full width, at most ``max_rows`` rows a frame."""
    step = width * max_rows
    high = min(max_rows, len(payload) // width)
    parts = [b"GIF89a", struct.pack("<HHBBB", width, high, 0xF7, 0, 0), _GREY]
    for at in range(0, len(payload), step):
        frame = payload[at : at + step]
        stream = lzw_encode(frame)
        parts += [b"\x21\xf9\x04", struct.pack("<BHB", 1 << 2, delay_cs, 0), b"\0\x2c", struct.pack("<HHHHB", 0, 0, width, len(frame) // width, 0), b"\x08"]
        parts += [x for k in range(0, len(stream), 255) for x in (bytes([len(stream[k : k + 255])]), stream[k : k + 255])]
        parts.append(b"\0")
    return b"".join([*parts, b"\x3b"])


# ---- on Spark ----

#: Images and pixels that a task holds before it hands them on.
_BATCH_ROWS, _BATCH_BYTES = 512, 8 << 20


def _sliced(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        begun = held = 0
        for k, n in enumerate(sizes):
            held += n
            if held >= _BATCH_BYTES or k + 1 - begun >= _BATCH_ROWS:
                yield batch.slice(begun, k + 1 - begun)
                begun, held = k + 1, 0
        if begun < len(batch):
            yield batch.slice(begun)


def gif_frames(images: DataFrame, id_col: str, gif_col: str, max_pixels: int = MAX_PIXELS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """(id, error, frames) for every row of a binary GIF column; a null, broken or too large image has an error and no frames."""
    kind = images.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in _sliced(batches, "gif"):
            found, errors = [], []
            for data in batch.column("gif").to_pylist():
                try:
                    found.append(decode_gif(data, max_pixels, max_bytes) if data is not None else [])
                    errors.append(None if data is not None else "null")
                except BrokenGif as error:
                    found.append([])
                    errors.append(str(error))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(errors, pa.string()), pa.array(found, pa.list_(_FRAME_ARROW))], ["id", "error", "frames"])

    rows = images.select(F.col(id_col).alias("id"), F.col(gif_col).alias("gif"))
    return common.map_arrow(rows, run, f"id {kind}, error string, frames array<{FRAME}>").withColumnRenamed("id", id_col)


def texts_as_gif(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store each whole text as a GIF and read the stored bytes back: (doc_id, n_bytes, gif, frames)."""
    rows = common.id_and_text(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in _sliced(batches, "text"):
            sizes, media, found = [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                text = text or b""
                image = encode_grey(text.ljust(max(ROW_BYTES, -(-len(text) // ROW_BYTES) * ROW_BYTES)))
                sizes.append(len(text))
                media.append(image)
                found.append(decode_gif(image, max_bytes=len(text) + ROW_BYTES * MAX_ROWS * (len(text) // (ROW_BYTES * MAX_ROWS) + 2)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(media, pa.binary()), pa.array(found, pa.list_(_FRAME_ARROW))],
                ["doc_id", "n_bytes", "gif", "frames"],
            )

    return common.map_arrow(rows, run, f"doc_id {kind}, n_bytes bigint, gif binary, frames array<{FRAME}>")


def gif_digest(stored: DataFrame) -> DataFrame:
    """The digest columns of stored texts, from the decoded frames."""
    payload = F.expr(
        "aggregate(frames, cast('' as binary), (whole, f) -> concat(whole, substring(f.pixels, f.top * f.canvas_width + 1, f.width * f.height)))"
    )
    feature = F.expr(
        "concat('frames=', size(frames), ';ms=', aggregate(frames, 0, (t, f) -> t + f.delay_ms), ';luma=',"
        " array_join(transform(frames, f -> array_join(f.hist_luma, ',')), '|'))"
    )
    rows = stored.select("doc_id", "n_bytes", payload.alias("payload"), "gif", feature.alias("feature"))
    return rows.select(
        "doc_id",
        "n_bytes",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -16, 16)")).alias("tail_crc32"),
        F.length("gif").cast("long").alias("media_bytes"),
        F.sha2("gif", 256).alias("media_sha256"),
        "feature",
    )
