"""Words and hashes of Arrow string columns as numpy arrays, without a Python
object per word."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes handled at a time, but for single texts that are longer.
BLOCK = 1 << 20

SPACES = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]


@cache
def space_words() -> np.ndarray:
    """True for the bytes of words [^\\x20\\x09-\\x0D]+."""
    table = np.ones(256, bool)
    table[SPACES] = False
    return table


@cache
def alnum_words() -> np.ndarray:
    """True for the bytes of words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of lower-cased text."""
    table = np.zeros(256, bool)
    table[0x30:0x3A] = table[0x41:0x5B] = table[0x61:0x7B] = table[0x80:] = True
    return table


@cache
def byte_values(lower: bool, salt: int = 0) -> np.ndarray:
    """A random odd 64-bit number for each byte; A-Z as a-z if lower."""
    table = np.random.default_rng(20240229 + salt).integers(0, 1 << 63, 256, dtype=U64) << U64(1) | U64(1)
    if lower:
        table[0x41:0x5B] = table[0x61:0x7B]
    return table


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """The finishing rounds of splitmix64."""
    with np.errstate(over="ignore"):
        x = x + U64((0x9E3779B97F4A7C15 * (salt + 1)) % (1 << 64))
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i mod 2^64 for i < n."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        n = -(-n // 65_536) * 65_536
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            out = np.full(n, b, U64)
            out[0] = 1
            with np.errstate(over="ignore"):
                both.append(np.multiply.accumulate(out))
        have = _POWERS[base] = tuple(both)
    return have[0][:n], have[1][:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n+1 offsets; null as empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, size: int = BLOCK):
    """Ranges of whole texts, each of about size bytes or one text."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of all words; none runs from one text into the next."""
    inside = table[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    before[cuts] = False
    after[cuts - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool, salt: int = 0) -> np.ndarray:
    """64-bit hashes of the words data[starts:ends]: polynomials of their bytes, mixed with their lengths. Other salts give independent hashes."""
    if not len(starts):
        return np.zeros(0, U64)
    up, down = powers((0x5851F42D4C957F2D + 0x2F8B1A6E4D3C5970 * salt) % (1 << 64), len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    with np.errstate(over="ignore"):
        np.cumsum(byte_values(lower, salt)[data] * up[: len(data)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def window_hashes(hashes: np.ndarray, n: int, salt: int) -> np.ndarray:
    """A hash for each n consecutive words, whatever text they are of."""
    if len(hashes) < n:
        return np.zeros(0, U64)
    up, down = powers((0xD1342543DE82EF95 + 8 * salt) % (1 << 64), len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, U64)
    with np.errstate(over="ignore"):
        np.cumsum(mixed(hashes, salt) * up[: len(hashes)], out=sums[1:])
        return mixed((sums[n:] - sums[:-n]) * down[: len(hashes) - n + 1], salt)
