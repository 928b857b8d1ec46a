import hashlib
import struct
import zlib

import numpy as np
import pytest
from helixframe.llm import gif

from .helpers import documents, empty


def brute_lzw(data, min_bits):
    """A plain GIF code stream decoder."""
    bits = int.from_bytes(data, "little")
    clear, at, out = 1 << min_bits, 0, []
    table, width, before = [], min_bits + 1, None
    while True:
        code = bits >> at & ((1 << width) - 1)
        at += width
        if code == clear + 1:
            return bytes(out)
        if code == clear:
            table, width, before = [bytes([i]) for i in range(clear)] + [b"", b""], min_bits + 1, None
            continue
        word = table[code] if code < len(table) else before + before[:1]
        if before is not None and len(table) < 4096:
            table.append(before + word[:1])
        if len(table) == 1 << width and width < 12:
            width += 1
        before = word
        out += word


@pytest.mark.parametrize("top", [1, 2, 40, 256])
@pytest.mark.parametrize("n", [0, 1, 2, 3, 700, 60_000])
def test_lzw_round_trip(n, top):
    samples = np.random.default_rng(n + top).integers(0, top, n).astype(np.uint8).tobytes()
    stream = gif.lzw_encode(samples)
    assert gif.lzw_decode(stream, 8).tobytes() == samples
    assert brute_lzw(stream, 8) == samples


def test_digests_against_brute_force(spark):
    docs = documents(spark)
    rows = {(r.doc_id, r.payload_sha256): r for r in gif.media_digests(docs).collect()}
    for r in docs.collect():
        raw = (r.text or "").encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        got = rows[r.doc_id, hashlib.sha256(payload).hexdigest()]
        media = gif.encode_gif(payload)
        assert (got.n_bytes, got.payload_bytes, got.tail_crc32) == (len(raw), len(payload), zlib.crc32(payload[-64:]))
        assert (got.media_bytes, got.media_sha256) == (len(media), hashlib.sha256(media).hexdigest())
        shade = np.bincount(np.frombuffer(payload, np.uint8) // 16, minlength=16)
        assert got.feature.endswith("grey=" + ",".join(map(str, shade)))
    assert gif.media_digests(docs).count() == docs.count()


def test_empty_table(spark):
    assert gif.media_digests(empty(spark)).count() == 0


def picture(frames, width=4, height=4, palette=((0, 0, 0), (255, 0, 0), (0, 255, 0), (0, 0, 255))):
    """frames: (x, y, w, h, indices, disposal, transparent, delay, interlaced)."""
    out = [b"GIF89a", struct.pack("<HHBBB", width, height, 0xF1, 0, 0), bytes(c for p in palette for c in p)]
    for x, y, w, h, indices, disposal, clear, delay, interlaced in frames:
        out.append(b"\x21\xf9\x04" + struct.pack("<BHBB", disposal << 2 | (clear is not None), delay, clear or 0, 0))
        out.append(b"\x2c" + struct.pack("<HHHHB", x, y, w, h, 0x40 if interlaced else 0) + b"\x08" + gif._blocks(gif.lzw_encode(bytes(indices))))
    return b"".join([*out, b"\x3b"])


def test_disposal_and_transparency():
    full = [1] * 16
    data = picture([(0, 0, 4, 4, full, 1, None, 5, False), (1, 1, 2, 2, [2, 0, 0, 2], 3, 0, 7, False), (0, 0, 1, 1, [3], 2, None, 9, False), (3, 3, 1, 1, [2], 0, None, 0, False)])
    seen = [(c[:, :, :3].tolist(), c[:, :, 3].tolist(), d, t) for _, c, d, t in gif.decode_gif(data)]
    red, green, blue = [255, 0, 0], [0, 255, 0], [0, 0, 255]
    assert [t for *_, t in seen] == [50, 70, 90, 0]
    assert seen[1][0][1][1] == green and seen[1][0][1][2] == red and seen[1][0][2][2] == green
    assert seen[2][0][1][1] == red and seen[2][0][0][0] == blue
    assert seen[3][1][0][0] == 0 and seen[3][0][3][3] == green


def test_interlaced_rows():
    rows = [[r % 4] * 2 for r in range(11)]
    order = [*range(0, 11, 8), *range(4, 11, 8), *range(2, 11, 4), *range(1, 11, 2)]
    stored = [v for r in order for v in rows[r]]
    (indices, *_), = gif.decode_gif(picture([(0, 0, 2, 11, stored, 0, None, 0, True)], 2, 11))
    assert indices.tolist() == rows


def test_frames_table(spark):
    data = picture([(0, 0, 4, 4, [1] * 16, 1, None, 5, False), (0, 0, 4, 4, [2] * 16, 1, None, 7, False)])
    rows = gif.frames(spark.createDataFrame([(1, bytearray(data)), (2, None)], "doc_id long, media binary")).orderBy("doc_id").collect()
    first, second = rows[0].frames
    assert (first.start_ms, first.delay_ms, second.start_ms, second.delay_ms) == (0, 50, 50, 70)
    assert first.red[15] == 16 and first.green[0] == 16 and second.green[15] == 16
    assert rows[1].frames == [] and bytes(rows[1].samples) == b""


def test_broken_stream():
    with pytest.raises(ValueError):
        gif.lzw_decode(np.packbits(np.unpackbits(np.array([256, 300], "<u2").view(np.uint8).reshape(-1, 2), axis=1, bitorder="little")[:, :9].ravel(), bitorder="little").tobytes(), 8)


def test_broken_media_are_told(spark):
    good = gif.encode_gif(bytes(range(64)) * 40)
    broken = [good[:n] for n in (0, 3, 9, 20, 400, 900, len(good) - 1)]
    broken += [b"nothing", good[:6] + b"\xff" * 4 + good[10:], good.replace(b"\x2c\0\0\0\0", b"\x2d\0\0\0\0", 1)]
    media = spark.createDataFrame([(0, good, "e"), *((k + 1, x, "e") for k, x in enumerate(broken)), (99, None, "e")], "doc_id long, media binary, error string")
    got = {r.doc_id: r for r in gif.frames(media).collect()}
    assert len(got) == len(broken) + 2
    assert bytes(got[0].samples) == bytes(range(64)) * 40 and got[0].error is None
    assert bytes(got[99].samples) == b"" and got[99].frames == [] and got[99].error is None
    for k in range(1, len(broken) + 1):
        assert got[k].samples is None and got[k].frames is None and got[k].error
