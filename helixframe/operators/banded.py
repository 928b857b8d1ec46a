"""Pairwise alignment with affine gaps in a band, many pairs side by side.

A row of the dynamic program is worked out for all pairs of a block at once.
Gaps along the row come from a running maximum, so that no letter is a step of
Python. Kept are one row of scores and a byte for each cell of the band, of
which the path is read back."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOW = -(1 << 29)
#: Bytes of the cells of a block of pairs; a single pair may have more.
BLOCK = 32 << 20
#: Cells of a row of a block without a moving band, so that its tables stay near the processor; rows after which alignments that have ended are left behind.
ROW, SETTLED = 1 << 15, 8
#: Of a cell: the state of its best score (match, a alone, b alone), and whether the gaps that end there are longer than one.
STATE, LONG_A, LONG_B = 3, 4, 8


class Scores(NamedTuple):
    """A gap of n letters costs gap_open + n gap_extend."""

    match: int = 2
    mismatch: int = -4
    gap_open: int = -4
    gap_extend: int = -2


class Found(NamedTuple):
    score: int
    a_end: int
    b_end: int
    cigar: str


def _letters(texts: list[bytes]) -> np.ndarray:
    out = np.zeros((len(texts), max(map(len, texts), default=0) + 1), np.uint8)
    for row, x in enumerate(texts):
        out[row, : len(x)] = np.frombuffer(x, np.uint8)
    return out


def _block(a: list[bytes], b: list[bytes], half: int, scores: Scores, zdrop: int | None) -> list[Found]:
    n, m = (np.array(list(map(len, x)), np.int64) for x in (a, b))
    x, y = _letters(a), _letters(b)
    every, rows, width = np.arange(len(a)), int(n.max()), 2 * half + 1
    along = np.arange(width)
    extend, opened = scores.gap_extend, scores.gap_open + scores.gap_extend
    cells = np.zeros((rows + 1, len(a), width), np.uint8)
    # the band's middle runs from corner to corner, or along the diagonal if the end is open
    middle = (np.arange(rows + 1)[:, None] * m // np.maximum(n, 1)) if zdrop is None else np.broadcast_to(np.arange(rows + 1)[:, None], (rows + 1, len(a)))

    j = middle[0][:, None] - half + along
    inside = (j >= 0) & (j <= m[:, None])
    high = np.where(inside, np.where(j == 0, 0, scores.gap_open + extend * j), LOW)
    gap_a = np.full(high.shape, LOW)
    cells[0] = np.where(j == 0, 0, 2 | np.where(j > 1, LONG_B, 0))
    best, best_i, best_j = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    going = np.ones(len(a), bool)
    final = np.where(n == 0, np.take_along_axis(high, np.clip(m - j[:, 0], 0, width - 1)[:, None], 1)[:, 0], LOW)
    edge = np.full((len(a), 1), LOW)
    for i in range(1, rows + 1):
        moved = middle[i] - middle[i - 1]
        j = middle[i][:, None] - half + along
        inside = (j >= 0) & (j <= m[:, None]) & (i <= n)[:, None]
        at = along + moved[:, None]  # the same column in the row above
        wide = np.concatenate([edge, high, edge], 1)
        above = np.take_along_axis(wide, np.clip(at + 1, 0, width + 1), 1)
        before = np.take_along_axis(wide, np.clip(at, 0, width + 1), 1)
        longer = np.take_along_axis(np.concatenate([edge, gap_a, edge], 1), np.clip(at + 1, 0, width + 1), 1)
        same = np.take_along_axis(y, np.clip(j - 1, 0, y.shape[1] - 1), 1) == x[every, min(i - 1, x.shape[1] - 1)][:, None]
        matched = np.where(inside & (j > 0), before + np.where(same, scores.match, scores.mismatch), LOW)
        gap_a = np.where(inside, np.maximum(above + opened, longer + extend), LOW)
        two = np.maximum(matched, gap_a)
        run = np.maximum.accumulate(two - extend * along, 1)
        gap_b = np.full(two.shape, LOW)
        gap_b[:, 1:] = np.where(inside[:, 1:], run[:, :-1] + scores.gap_open + extend * along[1:], LOW)
        cell = np.where(matched >= np.maximum(gap_a, gap_b), 0, np.where(gap_a >= gap_b, 1, 2)).astype(np.uint8)
        cell |= np.where(longer + extend > above + opened, LONG_A, 0).astype(np.uint8)
        cell[:, 1:] |= np.where(gap_b[:, :-1] + extend > two[:, :-1] + opened, LONG_B, 0).astype(np.uint8)
        cells[i] = cell
        high = np.maximum(np.maximum(two, gap_b), LOW)
        if zdrop is None:
            ends = n == i
            if ends.any():
                final[ends] = high[ends, np.clip(m - j[:, 0], 0, width - 1)[ends]]
            continue
        c = high.argmax(1)
        top, top_j = high[every, c], j[every, c]
        better = going & (top > best)
        best[better], best_i[better], best_j[better] = top[better], i, top_j[better]
        drift = np.abs((i - top_j) - (best_i - best_j))
        going &= (best - top <= zdrop - extend * drift) & (i < n)
        if not going.any():
            break
    if zdrop is None:
        best, best_i, best_j = final, n, m
    return [Found(int(best[k]), int(best_i[k]), int(best_j[k]), ops) for k, ops in enumerate(_paths(cells, middle, half, best_i.copy(), best_j.copy()))]


def _square(a: list[bytes], b: list[bytes], half: int, scores: Scores, zdrop: int | None) -> list[Found]:
    """_block() where the band holds all columns of b, or, with zdrop, is the same for all pairs: columns stay where they are."""
    n, m = (np.array(list(map(len, x)), np.int64) for x in (a, b))
    x, y = _letters(a), _letters(b)
    rows, width = int(n.max()), int(m.max()) + 1
    extend, opened = scores.gap_extend, scores.gap_open + scores.gap_extend
    along = np.arange(width, dtype=np.int32)
    price = np.int32(extend) * along
    match, mismatch, low = np.int32(scores.match), np.int32(scores.mismatch), np.int32(LOW)
    cells = np.zeros((rows + 1, len(a), width), np.uint8)
    live = np.arange(len(a))
    beyond = along > m[:, None]

    high = np.where((along == 0) | (along > half), np.where(along == 0, np.int32(0), low), np.int32(scores.gap_open) + price).astype(np.int32)
    high = np.repeat(high[None], len(a), 0)
    gap_a = np.full(high.shape, low)
    cells[0] = np.where(along == 0, 0, 2 | np.where(along > 1, LONG_B, 0))
    final = np.where(n == 0, high[np.arange(len(a)), m], low).astype(np.int64)
    best, best_i, best_j = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    going = np.ones(len(a), bool)
    for i in range(1, rows + 1):
        lo, hi = max(0, i - half), min(width, i + half + 1)
        if lo >= hi:
            break
        above = high[:, lo:hi] + np.int32(opened)
        longer = gap_a[:, lo:hi] + np.int32(extend)
        matched = np.full(above.shape, low)
        first = 1 if lo == 0 else 0
        matched[:, first:] = high[:, lo + first - 1 : hi - 1] + np.where(y[live, lo + first - 1 : hi - 1] == x[live, i - 1, None], match, mismatch)
        long_a = longer > above
        next_a = np.maximum(above, longer)
        two = np.maximum(matched, next_a)
        gap_b = np.full(two.shape, low)
        gap_b[:, 1:] = np.maximum.accumulate(two - price[lo:hi], 1)[:, :-1] + (np.int32(scores.gap_open) + price[lo + 1 : hi])
        cell = np.where(matched >= np.maximum(next_a, gap_b), np.uint8(0), np.where(next_a >= gap_b, np.uint8(1), np.uint8(2)))
        cell |= long_a.view(np.uint8) * np.uint8(LONG_A)
        cell[:, 1:] |= (gap_b[:, :-1] + np.int32(extend) > two[:, :-1] + np.int32(opened)).view(np.uint8) * np.uint8(LONG_B)
        cells[i, live, lo:hi] = cell
        high = np.full(high.shape, low)
        high[:, lo:hi] = np.maximum(np.maximum(two, gap_b), low)
        gap_a = np.full(high.shape, low)
        gap_a[:, lo:hi] = next_a
        if zdrop is None:
            ends = n[live] == i
            final[live[ends]] = high[ends, m[live[ends]]]
            going[live[ends]] = False
        else:
            seen = np.where(beyond[live], low, high)
            c = seen.argmax(1)
            top = seen[np.arange(len(live)), c].astype(np.int64)
            better = going[live] & (top > best[live])
            up = live[better]
            best[up], best_i[up], best_j[up] = top[better], i, c[better]
            drift = np.abs((i - c) - (best_i[live] - best_j[live]))
            going[live] &= (best[live] - top <= zdrop - extend * drift) & (i < n[live])
        left = int(going[live].sum())
        if not left:
            break
        if i % SETTLED == 0 and 4 * left <= 3 * len(live):
            on = going[live]
            live, high, gap_a = live[on], high[on], gap_a[on]
    if zdrop is None:
        best, best_i, best_j = final, n, m
    return [Found(int(best[k]), int(best_i[k]), int(best_j[k]), ops) for k, ops in enumerate(_paths(cells, None, 0, best_i.copy(), best_j.copy()))]


def _paths(cells: np.ndarray, middle: np.ndarray | None, half: int, i: np.ndarray, j: np.ndarray) -> list[str]:
    """CIGARs by the way back from cells (i, j). middle: None if columns do not move."""
    every = np.arange(len(i))
    cell = lambda i, j: cells[i, every, j if middle is None else np.clip(j - middle[i, every] + half, 0, 2 * half)]
    state = cell(i, j) & STATE
    steps = []
    while (on := (i > 0) | (j > 0)).any():
        state = np.where(i == 0, 2, np.where(j == 0, 1, state))
        steps.append(np.where(on, state, 3).astype(np.uint8))
        here = cell(i, j)
        stays = ((state == 1) & (here & LONG_A > 0)) | ((state == 2) & (here & LONG_B > 0))
        i, j = i - (on & (state != 2)), j - (on & (state != 1))
        state = np.where(stays, state, cell(i, j) & STATE)
    # many alignments have the same steps
    known: dict[bytes, str] = {}
    out = []
    for ops in np.ascontiguousarray(np.array(steps, np.uint8).reshape(len(steps), len(every)).T):
        text = known.get(own := ops.tobytes())
        if text is None:
            ops = ops[ops < 3][::-1]
            cuts = np.flatnonzero(np.diff(ops, prepend=9))
            text = known[own] = "".join(f"{c}{'MID'[ops[at]]}" for at, c in zip(cuts, np.diff(np.append(cuts, len(ops))), strict=True))
        out.append(text)
    return out


def align(pairs: list[tuple[bytes, bytes]], band: int | None = None, scores: Scores = Scores(), zdrop: int | None = None) -> list[Found]:
    """The best alignment of each pair within band letters of the line from
    corner to corner (None: everywhere). With zdrop the end is open: the
    alignment goes from the beginning to where the score is highest, and no
    further than where a row falls zdrop below that, with a gap's price allowed for."""
    # equal pairs are aligned once
    if len(known := dict.fromkeys(pairs)) < len(pairs):
        return list(map(dict(zip(known, align(list(known), band, scores, zdrop), strict=True)).__getitem__, pairs))
    out: list[Found | None] = [None] * len(pairs)
    # a band that is wider than the letters of a pair has nothing more in it
    need = lambda k: min(max(len(pairs[k][0]), len(pairs[k][1])) + 1, 1 << 62 if band is None else band)
    still = lambda k: len(pairs[k][1]) <= 4 * band if zdrop is not None and band is not None else band is None or need(k) < band
    small = [k for k in range(len(pairs)) if still(k)]
    small.sort(key=lambda k: (len(pairs[k][0]) >> 2, len(pairs[k][1])))
    for own in _blocks([tuple(map(len, pairs[k])) for k in small]):
        keys = [small[z] for z in own]
        half = max(map(need, keys)) if zdrop is None or band is None else band
        for k, found in zip(keys, _square([pairs[k][0] for k in keys], [pairs[k][1] for k in keys], half, scores, zdrop), strict=True):
            out[k] = found
    order = sorted(set(range(len(pairs))).difference(small), key=lambda k: (need(k), len(pairs[k][0])))
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end - at + 1) * (len(pairs[order[end]][0]) + 1) * (2 * need(order[end]) + 1) <= BLOCK and need(order[end]) <= 2 * need(order[at]) + 16:
            end += 1
        own = order[at:end]
        for k, found in zip(own, _block([pairs[k][0] for k in own], [pairs[k][1] for k in own], max(map(need, own)), scores, zdrop), strict=True):
            out[k] = found
        at = end
    return out


def _blocks(sizes: list[tuple[int, int]]) -> Iterator[range]:
    """The places of pairs of such lengths, in order, as many as make a block."""
    at = 0
    while at < len(sizes):
        end, most = at, (0, 0)
        while end < len(sizes):
            n, m = (max(x, y) for x, y in zip(most, sizes[end], strict=True))
            if end > at and ((end - at + 1) * (m + 1) > ROW or (end - at + 1) * (m + 1) * (n + 1) > BLOCK or m > 2 * sizes[at][1] + 16):
                break
            end, most = end + 1, (n, m)
        yield range(at, end)
        at = end


def aligned(pairs: DataFrame, a: str = "a", b: str = "b", band: int | None = None, scores: Scores = Scores(), zdrop: int | None = None) -> DataFrame:
    """pairs with score, a_end, b_end and cigar. Null sequences are empty. Memory is that of a block of bands, whatever the sequences' length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [[(v or "").encode() for v in batch.column(c).to_pylist()] for c in (a, b)]
            found = align(list(zip(*texts, strict=True)), band, scores, zdrop)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([f[c] for f in found], kind) for c, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string())))], [*batch.schema.names, "score", "a_end", "b_end", "cigar"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema)
    return pairs.mapInArrow(run, f"{fields}, score long, a_end long, b_end long, cigar string")


def cigar_columns(rows: DataFrame, cigar: str = "cigar") -> DataFrame:
    """rows with columns: the number of columns of the alignment, and of those in gaps."""
    sizes = lambda ops: F.aggregate(F.regexp_extract_all(cigar, F.lit(f"(\\d+)[{ops}]"), 1), F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))
    return rows.withColumns({"columns": sizes("MID"), "in_gaps": sizes("ID")})
