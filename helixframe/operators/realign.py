"""Base alignment qualities: how sure the place of each letter of a read is,
by a profile hidden Markov model of the reference around it.

Reads are worked through side by side, a row of the band at a time, forward
and backward; deletions, which go along a row, are a product with a small
triangular matrix. A task holds the bands of one block of reads."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Fixed values of the model: gap opening and extension, and the emission of an inserted letter and of each wrong one.
GAP_OPEN, GAP_EXTEND, INSERTED, WRONG = 0.001, 0.1, 0.25, 0.33333333333
#: The band at least, the factor from natural logarithms to phred, the largest quality, qualities that count as known for the cap, and the most that one mismatch weighs.
BAND, PHRED, MOST_QUALITY, LEAST_KNOWN, MOST_MISMATCH = 7, 4.343, 99, 13, 33
#: Cells of a block of reads.
BLOCK = 1 << 21
CODES = np.full(256, 4, np.int8)
for _code, _pair in enumerate(("Aa", "Cc", "Gg", "Tt")):
    CODES[[ord(c) for c in _pair]] = _code


def operations(cigar: str) -> list[tuple[int, str]]:
    return [(int(n), op) for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar or "")]


def posterior(refs: list[np.ndarray], reads: list[np.ndarray], quals: list[np.ndarray], band: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each letter of each read: the likeliest place in its reference (from
    0), whether the letter is inserted after it instead of standing there, and
    the phred-scaled probability that this is wrong. Letters are codes 0 to 3,
    4 for unknown. All reads have the same band; the bands' places are those
    from i - band to i + band."""
    n, size = (np.array(list(map(len, x))) for x in (reads, refs))
    rows, width = int(n.max()), 2 * band + 1
    every = np.arange(len(reads))
    read, qual = np.full((len(reads), rows + 2), 4, np.int8), np.zeros((len(reads), rows + 2))
    ref = np.full((len(reads), int(size.max()) + 2), 4, np.int8)
    for k, (x, y, z) in enumerate(zip(reads, quals, refs, strict=True)):
        read[k, 1 : len(x) + 1], qual[k, 1 : len(x) + 1], ref[k, 1 : len(z) + 1] = x, 10 ** (-np.asarray(y, float) / 10), z
    along = np.arange(width)
    stop = 1 / (2 * n + 2)[:, None]
    mm, mg = (1 - 2 * GAP_OPEN) * (1 - stop), GAP_OPEN * (1 - stop)
    im, ii = (1 - GAP_EXTEND) * (1 - stop), GAP_EXTEND * (1 - stop)
    dm, dd = 1 - GAP_EXTEND, GAP_EXTEND
    chain = np.where(along[None, :] > along[:, None], dd ** np.maximum(along[None, :] - along[:, None] - 1, 0), 0.0)  # a deletion from a column to a later one

    # places before and behind the reference are there, so that a row's columns are a slice
    letters = np.full((len(reads), rows + width + 1), 4, np.int8)
    letters[:, band : band + ref.shape[1]] = ref[:, : letters.shape[1] - band]
    at = np.arange(letters.shape[1]) - band
    there = (at >= 1) & (at <= size[:, None])
    hit, miss = np.where(read > 3, 1.0, 1 - qual), np.where(read > 3, 1.0, qual * WRONG)
    unknown = bool((letters[there] > 3).any())

    def emission(i: int) -> np.ndarray:
        letter = letters[:, i : i + width]
        e = np.where(letter == read[:, i, None], hit[:, i, None], miss[:, i, None])
        e = np.where(letter > 3, 1.0, e) if unknown else e
        return np.where(there[:, i : i + width], e, 0.0)

    def inside(i: int) -> np.ndarray:
        return there[:, i : i + width] & (i <= n)[:, None]

    left = lambda x: np.concatenate([x[:, 1:], np.zeros((len(x), 1))], 1)  # noqa: E731  the row above, its columns are one place further on
    right = lambda x: np.concatenate([np.zeros((len(x), 1)), x[:, :-1]], 1)
    match, gap, scale = (np.zeros((rows + 2, len(reads), *([width] if k < 2 else []))) for k in range(3))
    deleted = np.zeros((len(reads), width))
    emitted = np.zeros((rows + 1, len(reads), width))
    for i in range(1, rows + 1):
        e, ok = emission(i), inside(i)
        emitted[i] = e
        if i == 1:
            m, g, d = e * (1 - GAP_OPEN) / size[:, None], np.broadcast_to(INSERTED * GAP_OPEN / size[:, None], e.shape), np.zeros_like(e)
            m, g = np.where(ok, m, 0), np.where(ok, g, 0)
        else:
            m = np.where(ok, e * (mm * match[i - 1] + im * gap[i - 1] + dm * deleted), 0)
            g = np.where(ok, INSERTED * (mg * left(match[i - 1]) + ii * left(gap[i - 1])), 0)
            d = np.where(ok, mg * (m @ chain), 0)
        s = (m + g + d).sum(1)
        scale[i] = np.where(i <= n, s, 1)
        down = np.where((i <= n) & (s > 0), 1 / np.where(s > 0, s, 1), 0)[:, None]
        match[i], gap[i], deleted = m * down, g * down, d * down
    place_of, inserted, wrong = (np.zeros((len(reads), rows), x) for x in (np.int64, bool, np.int64))
    b_match, b_gap = np.zeros((len(reads), width)), np.zeros((len(reads), width))
    last = ((match[n, every] + gap[n, every]) * stop).sum(1)
    last = np.where(last > 0, last, 1)
    for i in range(rows, 0, -1):
        ok = inside(i)
        ends = (i == n)[:, None]
        # what follows from the next row: b_match and b_gap are still that row's
        to_match = emitted[i + 1] * b_match if i < rows else np.zeros_like(b_match)
        to_gap = INSERTED * right(b_gap)
        first = to_match * dm
        later = first @ (np.where(along[None, :] >= along[:, None], dd ** np.maximum(along[None, :] - along[:, None], 0), 0.0).T) if i > 1 else np.zeros_like(first)
        later = np.where(ok, later, 0)
        m = to_match * mm + to_gap * mg + mg * left(later)
        g = to_match * im + to_gap * ii
        m, g = np.where(ok, m, 0) / scale[i][:, None], np.where(ok, g, 0) / scale[i][:, None]
        b_match = np.where(ends, np.where(ok, stop / scale[i][:, None] / last[:, None], 0), m)
        b_gap = np.where(ends, np.where(ok, stop / scale[i][:, None] / last[:, None], 0), g)
        both = np.stack([match[i] * b_match, gap[i] * b_gap], 2).reshape(len(reads), -1)
        best, total = both.argmax(1), both.sum(1)
        sure = both[every, best] / np.where(total > 0, total, 1)
        place_of[:, i - 1], inserted[:, i - 1] = i - band + best // 2 - 1, best % 2 == 1
        with np.errstate(divide="ignore"):
            q = np.floor(np.minimum(-PHRED * np.log(np.maximum(1 - sure, 0)), 1000) + 0.499)
        wrong[:, i - 1] = np.where(q > 100, MOST_QUALITY, q)
    return [(place_of[k, : n[k]], inserted[k, : n[k]], wrong[k, : n[k]]) for k in range(len(reads))]


def window(ops: list[tuple[int, str]], pos: int, n: int, ref_size: int) -> tuple[int, int, int] | None:
    """Begin and end of the reference around an alignment, and the band; None where there is no matched letter or a part of the reference is skipped."""
    x, y, begin, end = pos, 0, None, None
    for k, op in ops:
        if op == "N":
            return None
        if op in "M=X":
            begin = begin or (x, y)
            x, y = x + k, y + k
            end = (x, y)
        elif op in "SI":
            y += k
        elif op == "D":
            x += k
    if begin is None:
        return None
    drift = abs((end[0] - begin[0]) - (end[1] - begin[1]))
    band = BAND if drift <= BAND else drift + 3
    lo, hi = max(0, begin[0] - begin[1] - band // 2), end[0] + n - end[1] + band // 2
    if hi - lo - n > band:
        cut = int((hi - lo - n - band) / 2)
        lo, hi = lo + cut, hi - cut
    return lo, min(hi, ref_size), band


def capped(ops: list[tuple[int, str]], pos: int, begin: int, found: tuple, qual: np.ndarray, extended: bool) -> np.ndarray:
    """Qualities with those of matched letters capped: by the letter's own
    probability of being misplaced, 0 where the likeliest place is another one.
    Extended, a letter takes the smaller of the best of its matched stretch up to it and from it on."""
    place, inserted, sure = found
    out = np.array(qual, np.int64)
    x, y = pos, 0
    for k, op in ops:
        if op in "M=X":
            at = np.arange(y, y + k)
            own = np.where(inserted[at] | (place[at] != x - begin + at - y), 0, sure[at])
            if extended:
                own = np.minimum(np.maximum.accumulate(own), np.maximum.accumulate(own[::-1])[::-1])
            out[at] = np.minimum(out[at], own)
            x, y = x + k, y + k
        elif op in "SI":
            y += k
        elif op == "D":
            x += k
    return out


def realigned(rows: list[tuple[str, np.ndarray, str, int, str]], extended: bool = False) -> list[np.ndarray]:
    """Capped qualities of rows (read, qualities, reference, place from 0, CIGAR)."""
    out: list[np.ndarray] = [np.array(r[1], np.int64) for r in rows]
    work: dict[int, list[tuple]] = {}
    for k, (read, _, ref, pos, cigar) in enumerate(rows):
        ops = operations(cigar)
        if not read or (around := window(ops, pos, len(read), len(ref))) is None or around[1] <= around[0]:
            continue
        lo, hi, band = around
        size = hi - lo
        band = max(min(max(size, len(read)), band), abs(size - len(read)))
        work.setdefault(band, []).append((k, ops, lo, CODES[np.frombuffer(ref[lo:hi].encode("latin-1", "replace"), np.uint8)], CODES[np.frombuffer(read.encode("latin-1", "replace"), np.uint8)]))
    for band, same in work.items():
        same.sort(key=lambda w: len(w[4]))
        lo = 0
        while lo < len(same):
            hi = lo + 1
            while hi < len(same) and (hi - lo + 1) * len(same[hi][4]) * (2 * band + 1) <= BLOCK:
                hi += 1
            some = same[lo:hi]
            for w, found in zip(some, posterior([w[3] for w in some], [w[4] for w in some], [rows[w[0]][1] for w in some], band), strict=True):
                out[w[0]] = capped(w[1], rows[w[0]][3], w[2], found, rows[w[0]][1], extended)
            lo = hi
    return out


def mapping_quality_cap(read: str, qual: np.ndarray, ref: str, pos: int, cigar: str, threshold: int = 40) -> int:
    """The mapping quality that an alignment's mismatches and clips leave it: -1 if they are too many."""
    x, y, known, misses, weight, clipped = pos, 0, 0, 0, 0, 0
    for k, op in operations(cigar):
        if op in "M=X":
            here = min(k, max(0, len(ref) - x))
            a, b = (CODES[np.frombuffer(s.encode("latin-1", "replace"), np.uint8)] for s in (read[y : y + here], ref[x : x + here]))
            q = np.asarray(qual[y : y + here])
            ok = (a < 4) & (b < 4) & (q >= LEAST_KNOWN)
            known += int(ok.sum())
            misses += int((ok & (a != b)).sum())
            weight += int(np.minimum(q, MOST_MISMATCH)[ok & (a != b)].sum())
            if here < k:
                break
            x, y = x + k, y + k
        elif op == "D":
            if x + k > len(ref):
                break
            x += k
        elif op == "S":
            clipped += int(np.asarray(qual[y : y + k]).sum())
            y += k
        elif op == "H":
            clipped += LEAST_KNOWN * k
        elif op == "I":
            y += k
        elif op == "N":
            x += k
    ways = np.prod([known / (i + 1) for i in range(misses)]) if misses else 1.0
    t = weight - PHRED * np.log(ways) + clipped / 5 if ways > 0 else np.inf
    if t > threshold:
        return -1
    return int(np.sqrt((threshold - max(t, 0)) / threshold) * threshold + 0.499)


def base_alignment_qualities(rows: DataFrame, read: str = "read", qual: str = "qual", ref: str = "ref", pos: str = "pos", cigar: str = "cigar", extended: bool = False, drop: tuple[str, ...] = ()) -> DataFrame:
    """rows, without the columns of drop, with baq (an array of capped
    qualities) and cap (the mapping quality that is left, -1 for none).

    qual is an array of phred numbers, one for each letter of the read; pos
    counts from 0. A read that is null or empty, or whose alignment skips a part
    of the reference, keeps its qualities."""
    keep = [c for c in rows.columns if c not in drop]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (read, qual, ref, pos, cigar)]
            work = [(r or "", np.array(q or [], np.int64), f or "", p or 0, c or "") for r, q, f, p, c in zip(*columns, strict=True)]
            caps = [mapping_quality_cap(*w) for w in work]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array([x.tolist() for x in realigned(work, extended)], pa.list_(pa.int32())), pa.array(caps, pa.int32())], [*keep, "baq", "cap"])

    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, f"{fields}, baq array<int>, cap int")
