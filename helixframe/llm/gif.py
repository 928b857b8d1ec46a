"""GIF media columns: an encoder, a decoder of the LZW code streams, and frames
on their canvas with colour histograms."""

from __future__ import annotations

import struct
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import long_rows, written

WIDTH, FRAME_ROWS, DELAY = 64, 1024, 10
#: Bins of a colour channel.
BINS = 16
FRAME = "struct<frame:int,start_ms:int,delay_ms:int,width:int,height:int,disposal:int,red:array<int>,green:array<int>,blue:array<int>>"
MOST_CODES = 4096
#: Pixels of a screen or frame; broken media may ask for 65535 x 65535.
MOST_PIXELS = 1 << 26


@cache
def _widths(first_bits: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits of the k-th code after a clear code, and where it begins."""
    ready = (1 << (first_bits - 1)) + 2 + np.maximum(np.arange(n) - 1, 0)
    bits = np.clip(np.ceil(np.log2(ready + 1)).astype(np.int64), first_bits, 12)
    return bits, np.concatenate([[0], np.cumsum(bits)])


def lzw_encode(samples: bytes) -> bytes:
    """8-bit samples as a GIF code stream."""
    clear, end = 256, 257
    parts: list[list[int]] = []
    codes: list[int] = []
    table: dict[int, int] = {}
    get, ready = table.get, 258
    rest = iter(samples)
    word = next(rest, None)
    for c in rest:
        key = word << 8 | c
        if (code := get(key)) is not None:
            word = code
            continue
        codes.append(word)
        table[key] = ready
        ready += 1
        word = c
        if ready == MOST_CODES:
            parts.append([*codes, clear])
            codes, ready = [], 258
            table.clear()
    parts.append([*codes, *([] if word is None else [word]), end])
    bits = [np.unpackbits(np.array([clear, 0], "<u2").view(np.uint8), bitorder="little")[:9]]
    for part in parts:
        width, _ = _widths(9, MOST_CODES)
        all_bits = np.unpackbits(np.array(part, "<u2").view(np.uint8).reshape(-1, 2), axis=1, bitorder="little")
        bits.append(all_bits[np.arange(16) < width[: len(part), None]])
    return np.packbits(np.concatenate(bits), bitorder="little").tobytes()


def _strings(codes: np.ndarray, first: int) -> np.ndarray:
    """The samples that the codes between two clear codes stand for.

    Entry `first + k` is the string of code k and the first sample of the next
    string: in the output both lie side by side. So each string is a copy of
    earlier output, and all copies are followed to their literals at once."""
    n = len(codes)
    source = np.where(codes >= first, codes - first, -1)
    if (source >= np.arange(n)).any() or (codes == first - 1).any():
        raise ValueError("broken LZW code stream")
    up, length = source.copy(), (source >= 0).astype(np.int64)
    live = np.flatnonzero(up >= 0)
    while len(live):
        length[live], up[live] = length[live] + length[up[live]], up[up[live]]
        live = live[up[live] >= 0]
    length += 1
    start = np.cumsum(length) - length
    total = int(length.sum())
    owner = np.repeat(np.arange(n), length)
    place = np.arange(total)
    copied = source[owner] >= 0
    origin = np.where(copied, start[np.maximum(source[owner], 0)] + place - start[owner], place)
    while not np.array_equal(origin, far := origin[origin]):
        origin = far
    return codes[owner[origin]].astype(np.uint8)


def lzw_decode(data: bytes, min_bits: int) -> np.ndarray:
    """The samples of a GIF code stream."""
    clear = 1 << min_bits
    stream = np.frombuffer(data + bytes(4), np.uint8).astype(np.uint32)
    n_bits, at = 8 * len(data), 0
    out: list[np.ndarray] = []
    segment: list[np.ndarray] = []
    done = 0
    while True:
        most = max(MOST_CODES, 2 * done)
        width, begin = _widths(min_bits + 1, most + MOST_CODES)
        k = np.arange(done, done + min(MOST_CODES, (n_bits - at) // (min_bits + 1) + 1))
        asked = len(k)
        bit = at + begin[k] - begin[done]
        k = k[: int(np.searchsorted(bit + width[k], n_bits, "right"))]
        bit = bit[: len(k)]
        byte = bit >> 3
        codes = ((stream[byte] | stream[byte + 1] << 8 | stream[byte + 2] << 16) >> (bit & 7).astype(np.uint32)) & ((1 << width[k]) - 1).astype(np.uint32)
        codes = codes.astype(np.int64)
        stops = np.flatnonzero((codes == clear) | (codes == clear + 1))
        stop = int(stops[0]) if len(stops) else len(codes)
        segment.append(codes[:stop])
        if len(stops):
            joined = np.concatenate(segment)
            if len(joined):
                out.append(_strings(joined, clear + 2))
            if codes[stop] == clear + 1:
                break
            at, segment, done = int(bit[stop] + width[k[stop]]), [], 0
        elif len(k) < asked or asked < MOST_CODES:  # the stream ends without its end code
            joined = np.concatenate(segment)
            if len(joined):
                out.append(_strings(joined, clear + 2))
            break
        else:
            at, done = int(bit[-1] + width[k[-1]]), done + asked
    return np.concatenate(out) if out else np.zeros(0, np.uint8)


def _blocks(data: bytes) -> bytes:
    return b"".join(bytes([len(data[i : i + 255])]) + data[i : i + 255] for i in range(0, len(data), 255)) + b"\0"


def encode_gif(samples: bytes, width: int = WIDTH, frame_rows: int = FRAME_ROWS, delay: int = DELAY) -> bytes:
    """Samples, a whole number of rows, as the indices of an animated GIF with a grey palette."""
    rows = len(samples) // width
    height = min(rows, frame_rows)
    grey = np.repeat(np.arange(256, dtype=np.uint8), 3).tobytes()
    out = [b"GIF89a", struct.pack("<HHBBB", width, height, 0xF7, 0, 0), grey, b"\x21\xff\x0bNETSCAPE2.0\x03\x01\0\0\0"]
    for first in range(0, rows, frame_rows):
        n = min(frame_rows, rows - first)
        out.append(b"\x21\xf9\x04" + struct.pack("<BHBB", 2 << 2, delay, 0, 0))
        out.append(b"\x2c" + struct.pack("<HHHHB", 0, 0, width, n, 0) + b"\x08" + _blocks(lzw_encode(samples[first * width : (first + n) * width])))
    return b"".join([*out, b"\x3b"])


def _sub_blocks(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while n := data[at]:
        if at + 1 + n > len(data):
            raise ValueError("block cut off")
        parts.append(data[at + 1 : at + 1 + n])
        at += 1 + n
    return b"".join(parts), at + 1


def decode_gif(data: bytes):
    """Frames in turn: indices as stored, the canvas (height, width, RGBA) with
    the frame drawn (good until the next frame), disposal and delay in ms. Transparent pixels leave the
    canvas as it is; disposal 2 clears the frame's rectangle afterwards and 3
    brings back what it covered."""
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    width, height, flags = struct.unpack_from("<HHB", data, 6)
    if width * height > MOST_PIXELS:
        raise ValueError(f"screen of {width} x {height} pixels")
    at = 13
    palette = None
    if flags & 0x80:
        n = 2 << (flags & 7)
        palette = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
        at += 3 * n
    canvas = np.zeros((height, width, 4), np.uint8)
    disposal, delay, clear = 0, 0, None
    while data[at] != 0x3B:
        if data[at] == 0x21:
            label = data[at + 1]
            body, at = _sub_blocks(data, at + 2)
            if label == 0xF9:
                bits, delay, index = struct.unpack_from("<BHB", body)
                disposal, clear = bits >> 2 & 7, index if bits & 1 else None
            continue
        if data[at] != 0x2C:
            raise ValueError(f"no GIF block at byte {at}")
        x, y, w, h, bits = struct.unpack_from("<HHHHB", data, at + 1)
        at += 10
        if w * h > MOST_PIXELS:
            raise ValueError(f"frame of {w} x {h} pixels")
        colours = palette
        if bits & 0x80:
            n = 2 << (bits & 7)
            colours = np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3)
            at += 3 * n
        if not 1 <= (min_bits := data[at]) <= 8:
            raise ValueError(f"codes of {min_bits} bits")
        stream, at = _sub_blocks(data, at + 1)
        indices = lzw_decode(stream, min_bits)[: w * h]
        if len(indices) < w * h:
            indices = np.pad(indices, (0, w * h - len(indices)))
        indices = indices.reshape(h, w)
        if bits & 0x40:  # interlaced: rows were stored in four passes
            order = np.concatenate([np.arange(a, h, b) for a, b in ((0, 8), (4, 8), (2, 4), (1, 2))])
            plain = np.empty_like(indices)
            plain[order] = indices
            indices = plain
        before = canvas.copy() if disposal == 3 else None
        hh, ww = max(0, min(h, height - y)), max(0, min(w, width - x))
        part = indices[:hh, :ww]
        table = np.zeros((256, 4), np.uint8)
        if colours is not None:
            table[: len(colours), :3] = colours
        table[:, 3] = 255
        if clear is None:
            canvas[y : y + hh, x : x + ww] = table[part]
        else:
            drawn = part != clear
            canvas[y : y + hh, x : x + ww][drawn] = table[part[drawn]]
        yield indices, canvas, disposal, 10 * delay
        if disposal == 2:
            canvas[y : y + hh, x : x + ww] = 0
        elif disposal == 3:
            canvas = before
        disposal, delay, clear = 0, 0, None


def stored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_bytes, media): every text as a GIF. Its UTF-8 bytes, filled
    up with zeros to a positive multiple of 64, are the samples, 64 a row and
    FRAME_ROWS rows a frame. Null texts count as empty; ids are not looked at;
    other columns are not read."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                raw = [x.as_py() or b"" for x in batch.column(1).slice(lo, 256).cast(pa.large_binary())]
                media = [encode_gif(x + bytes(-len(x) % WIDTH if x else WIDTH)) for x in raw]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 256), pa.array(list(map(len, raw)), pa.int64()), pa.array(media, pa.binary())], ["id", "n_bytes", "media"])

    kind = docs.schema[id_col].dataType.simpleString()
    return long_rows(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_bytes long, media binary").withColumnRenamed("id", id_col)


def frames(media: DataFrame, id_col: str = "doc_id", media_col: str = "media", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id_col, keep..., samples, frames, error) for every GIF: the stored
    samples of all frames one after another, and the timed frames with
    histograms of their canvases' colours (BINS bins for red, green and blue,
    of pixels that are drawn). A null media column gives no samples and no
    frames. Media that are broken or cut off before the trailer, or that ask
    for a screen or frame of more than MOST_PIXELS, give null samples and
    frames and say why in error, which is null otherwise."""

    def histogram(canvas):
        drawn = canvas.reshape(-1, 4)
        if not (seen := drawn[:, 3] > 0).all():
            drawn = drawn[seen]
        return [np.bincount(drawn[:, c] // (256 // BINS), minlength=BINS).tolist() for c in range(3)]

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                samples, timed, errors = [], [], []
                for x in batch.column(1).slice(lo, 256):
                    own, rows, start, error = [], [], 0, None
                    try:
                        for k, (indices, canvas, disposal, delay) in enumerate(decode_gif(x.as_py()) if x.is_valid else ()):
                            own.append(indices.tobytes())
                            red, green, blue = histogram(canvas)
                            rows.append({"frame": k, "start_ms": start, "delay_ms": delay, "width": canvas.shape[1], "height": canvas.shape[0], "disposal": disposal, "red": red, "green": green, "blue": blue})
                            start += delay
                    except (ValueError, IndexError, struct.error) as e:  # what broken bytes raise
                        own, rows, error = None, None, str(e) or type(e).__name__
                    samples.append(None if own is None else b"".join(own))
                    timed.append(rows)
                    errors.append(error)
                ints = pa.list_(pa.int32())
                kind = pa.list_(pa.struct([(n, ints if n in ("red", "green", "blue") else pa.int32()) for n in ("frame", "start_ms", "delay_ms", "width", "height", "disposal", "red", "green", "blue")]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 256), *(c.slice(lo, 256) for c in batch.columns[2:]), pa.array(samples, pa.binary()), pa.array(timed, kind), pa.array(errors, pa.string())], ["id", *batch.schema.names[2:], "samples", "frames", "error"])

    rows = long_rows(media).select(F.col(id_col).alias("id"), F.col(media_col).alias("media"), *(F.col(c).alias(f"k{k}") for k, c in enumerate(keep)))
    extra = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema.fields[2:])
    out = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {extra}samples binary, frames array<{FRAME}>, error string")
    return out.select(F.col("id").alias(id_col), *(F.col(f"k{k}").alias(c) for k, c in enumerate(keep)), "samples", "frames", "error")


def media_digests(docs: DataFrame) -> DataFrame:
    """Every text stored as a GIF in the shared folder, read back and decoded, as digests."""
    table = written(stored(docs), "media")
    table = table.withColumns({"media_bytes": F.octet_length("media").cast("long"), "media_sha256": F.sha2("media", 256)})
    read = frames(table, keep=("n_bytes", "media_bytes", "media_sha256"))
    shade = F.aggregate("frames", F.array_repeat(F.lit(0).cast("long"), BINS), lambda have, f: F.zip_with(have, f["red"], lambda a, b: a + b))
    return read.select(
        "doc_id",
        "n_bytes",
        F.octet_length("samples").cast("long").alias("payload_bytes"),
        F.sha2("samples", 256).alias("payload_sha256"),
        F.crc32(F.substring("samples", -64, 64)).alias("tail_crc32"),
        "media_bytes",
        "media_sha256",
        F.concat(F.lit("frames="), F.size("frames").cast("string"), F.lit(";grey="), F.array_join(shade.cast("array<string>"), ",")).alias("feature"),
    )
