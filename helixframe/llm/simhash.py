"""SimHash near-duplicates by anchor-point covering.

The anchors are the words of a covering code of the 64-bit space: a product of
perfect block codes (repetition codes and the binary Golay code), so that every
fingerprint lies within the covering radius of one anchor, its home. A pair
within the threshold t shares the home of either: it is enough to send each
fingerprint to all anchors within covering radius plus t, and there to compare
it with the fingerprints at home. Distances beyond the radius are counted block
by block, which is the same bound but tighter: the excesses over the blocks'
radii add up to t at most.
"""

from __future__ import annotations

from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import long_rows, written
from .vectors import mixed

U64 = np.uint64
SEED = 42


class Block(NamedTuple):
    """A cyclic perfect code: length, generator polynomial, covering radius."""

    n: int
    generator: int
    radius: int


def repetition(n: int) -> Block:
    return Block(n, (1 << n) - 1, n // 2)


GOLAY = Block(23, 0b101011100011, 3)
#: From few anchors, for small tables, to many. Bits beyond the blocks choose no anchor.
CODES = ((repetition(9),) * 7, (GOLAY, repetition(13), repetition(13), repetition(15)), (GOLAY, GOLAY, repetition(9), repetition(9)))
#: Copies of a fingerprint that are shuffled in one job; a code that makes more has its anchors dealt into as many jobs as it takes.
MOST_COPIES = 256
#: Seconds to replicate, send and sort one row; to compare two fingerprints.
ROW_S, PAIR_S = 3e-6, 2e-9


@cache
def syndromes(block: Block) -> np.ndarray:
    """Of every word of the block's length: its remainder by the generator."""
    degree = block.generator.bit_length() - 1
    out = np.zeros(1, np.uint32)
    rest = 1
    for bit in range(block.n):
        if bit:
            rest <<= 1
        if degree and rest >> degree & 1:
            rest ^= block.generator
        out = np.concatenate([out, out ^ np.uint32(rest)])
    return out


@cache
def cosets(block: Block, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every syndrome the error patterns up to weight radius + t, the
    lightest first: patterns, each syndrome's first, and how many there are
    with an excess over the radius of at most 0..t."""
    patterns = np.arange(1 << block.n, dtype=np.uint32)
    excess = np.maximum(np.bitwise_count(patterns).astype(np.int64) - block.radius, 0)
    patterns, excess = patterns[excess <= t], excess[excess <= t]
    syndrome = syndromes(block)[patterns].astype(np.int64)
    order = np.lexsort((excess, syndrome))
    size = 1 << (block.generator.bit_length() - 1)
    counts = np.zeros((size, t + 1), np.int64)
    np.add.at(counts, (syndrome, excess), 1)
    counts = counts.cumsum(1)
    return patterns[order], np.concatenate([[0], counts[:, -1].cumsum()[:-1]]), counts


def anchors(fingerprints: np.ndarray, code: tuple[Block, ...], t: int) -> tuple[np.ndarray, np.ndarray]:
    """For each fingerprint every anchor whose excess is t at most: indices into fingerprints, anchor numbers. With t = 0 the home alone."""
    index = np.arange(len(fingerprints))
    anchor = np.zeros(len(fingerprints), np.int64)
    left = np.full(len(fingerprints), t)
    at = 0
    for block in code:
        word = ((fingerprints >> U64(at)) & U64((1 << block.n) - 1)).astype(np.int64)[index]
        patterns, first, counts = cosets(block, t)
        syndrome = syndromes(block)[word]
        n = counts[syndrome, left]
        row = np.repeat(np.arange(len(index)), n)
        rank = np.arange(len(row)) - np.repeat(n.cumsum() - n, n)
        error = patterns[first[syndrome][row] + rank].astype(np.int64)
        degree = block.generator.bit_length() - 1
        index, word = index[row], word[row]
        anchor = (anchor[row] << (block.n - degree)) | ((word ^ error) >> degree)
        left = left[row] - np.maximum(np.bitwise_count(error).astype(np.int64) - block.radius, 0)
        at += block.n
    return index, anchor


def spread(code: tuple[Block, ...], t: int) -> tuple[float, float]:
    """Anchors in all, and how many a random fingerprint is sent to."""
    ways = np.zeros(t + 1)
    ways[0] = 1
    total = 1.0
    for block in code:
        each = np.diff(cosets(block, t)[2].mean(0), prepend=0)
        ways = np.convolve(ways, each)[: t + 1]
        total *= 2.0 ** (block.n - block.generator.bit_length() + 1)
    return total, ways.sum()


def chosen_code(n: int, t: int) -> tuple[Block, ...]:
    """The code that costs least for n fingerprints; all are exact."""

    def cost(code):
        total, sent = spread(code, t)
        return n * sent * ROW_S + n * n * sent / total * PAIR_S

    return min(CODES, key=cost)


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of the lower-cased text's word shingles, repeats included; a text of fewer words is one shingle, one of none has none."""
    parts = text.lower().split()
    line = b" ".join(parts)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(line, SEED)] if parts else [], U64)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest, n = xxhash.xxh64_intdigest, len(parts) - words + 1
    spans = zip(starts[:n].tolist(), ends[words - 1 :].tolist(), strict=True)
    return np.fromiter((digest(line[s:e], SEED) for s, e in spans), U64, n)


def fingerprint(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half the hashes."""
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 1 << 16):
        some = hashes[lo : lo + (1 << 16)]
        bits = np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        # eight counters side by side, which 255 rows cannot overflow
        sums = np.add.reduceat(bits.view(U64), np.arange(0, len(some), 255), axis=0)
        ones += sums.view(np.uint8).sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(U64)[0])


def fingerprint_of(text: bytes, words: int = 4) -> int:
    """The 64-bit SimHash of the lower-cased text's word shingles."""
    return fingerprint(shingle_hashes(text, words))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """(id_col, fp long) for every row; fp holds the 64 bits, signed. A null or blank text has fingerprint 0."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            fps = np.fromiter((fingerprint_of(x.as_py() or b"", words) for x in texts), U64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return long_rows(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, fp long").withColumnRenamed("id", id_col)


class _Home:
    """The home rows of a unit and which of them are known to be linked."""

    def __init__(self) -> None:
        self.parts: list[np.ndarray] = []
        self.rows = np.zeros(0, U64)
        self.root = np.zeros(0, np.int64)

    def add(self, rows: np.ndarray) -> None:
        self.parts.append(rows)

    def ready(self) -> None:
        if self.parts:
            self.rows = np.concatenate([self.rows, *self.parts])
            self.root = np.arange(len(self.rows))
            self.parts = []

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def flatten(self) -> None:
        while not np.array_equal(self.root, up := self.root[self.root]):
            self.root = up

    def links(self, others: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        """Edges that connect whatever pairs of home and others within t connect: a forest, not all pairs."""
        self.ready()
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for lo in range(0, len(others), 4096):
            theirs = others[lo : lo + 4096]
            linked = np.full(len(theirs), -1)
            for at in range(0, len(self.rows), 64):
                mine = self.rows[at : at + 64]
                near = np.bitwise_count(theirs[:, None] ^ mine[None, :]) - np.uint8(1) < t  # distance 0 wraps to 255
                if not near.any():
                    continue
                i, j = np.nonzero(near)
                roots = self.root[j + at]
                begins = np.flatnonzero(np.diff(i, prepend=-1))
                who, least = i[begins], np.minimum.reduceat(roots, begins)
                joined = np.repeat(least, np.diff(np.append(begins, len(i))))
                pairs = [np.stack([joined, roots], 1)[joined != roots]]
                old = linked[who]
                pairs.append(np.stack([old, least], 1)[(old >= 0) & (old != least)])
                linked[who] = np.where(old >= 0, old, least)
                if len(pairs := np.unique(np.concatenate(pairs), axis=0)):
                    a, b = [], []
                    for x, y in pairs.tolist():
                        p, q = self.find(x), self.find(y)
                        if p != q:
                            self.root[max(p, q)] = min(p, q)
                            a.append(p)
                            b.append(q)
                    self.flatten()
                    out.append((self.rows[a], self.rows[b]))
            has = linked >= 0
            out.append((theirs[has], self.rows[self.root[linked[has]]]))
        if not out:
            return np.zeros(0, U64), np.zeros(0, U64)
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def _compare(t: int):
    def run(batches):
        unit, home = None, _Home()
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False)
            fps = batch.column(1).to_numpy(zero_copy_only=False).view(U64)
            cuts = np.append(np.flatnonzero(np.diff(key, prepend=key[:1] - 1)), len(key)) if len(key) else [0]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if key[lo] >> 1 != unit:
                    unit, home = key[lo] >> 1, _Home()
                if not key[lo] & 1:
                    home.add(fps[lo:hi])
                elif home.parts or len(home.rows):
                    a, b = home.links(fps[lo:hi], t)
                    if len(a := a[keep := a != b]):
                        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b[keep].view(np.int64))], ["a", "b"])

    return run


def links(distinct: DataFrame, t: int = 4, most_home: int = 4096) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that join exactly
    what pairs within t bits join.

    An anchor with more than max(most_home, n / 1000) rows at home is split
    into units by a hash of the home row; its replicas go to each. There are
    under 1000 such anchors, whatever n is, so their list may travel with the
    tasks. Larger codes work through their anchors slice by slice, so that the
    shuffle files of one time have MOST_COPIES copies of a fingerprint at most."""
    spark = distinct.sparkSession
    n = distinct.count()
    code = chosen_code(n, t)
    most = max(most_home, n // 1000)

    def homes(batches):
        for batch in batches:
            number, count = np.unique(anchors(batch.column(0).to_numpy().view(U64), code, 0)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(count)], ["anchor", "n"])

    at_home = distinct.select("fp").mapInArrow(homes, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    hot = {r["anchor"]: -(-r["n"] // most) for r in at_home.where(F.col("n") > most).collect()}
    hot_anchor = np.array(sorted(hot), np.int64)
    hot_parts = np.array([hot[k] for k in sorted(hot)], np.int64)
    step = max(64, int(400_000 / spread(code, t)[1]))

    def units(anchor: np.ndarray) -> np.ndarray:
        parts = np.ones(len(anchor), np.int64)
        if len(hot_anchor):
            at = np.minimum(np.searchsorted(hot_anchor, anchor), len(hot_anchor) - 1)
            parts = np.where(hot_anchor[at] == anchor, hot_parts[at], 1)
        return parts

    slices = -(-int(spread(code, t)[1]) // MOST_COPIES)

    def replicate(own: int):
        mine = lambda anchor: mixed(anchor.astype(U64)) % U64(slices) == own

        def run(batches):
            for batch in batches:
                every = batch.column(0).to_numpy().view(U64)
                for lo in range(0, len(every), step):
                    fps = every[lo : lo + step]
                    _, home = anchors(fps, code, 0)
                    part = ((fps * U64(0x9E3779B97F4A7C15)) >> U64(40)).astype(np.int64) % units(home)
                    index, anchor = anchors(fps, code, t)
                    stay = np.ones(len(fps), bool)
                    if slices > 1:
                        stay, some = mine(home), mine(anchor)
                        index, anchor = index[some], anchor[some]
                    parts = units(anchor)
                    index, anchor = np.repeat(index, parts), np.repeat(anchor, parts)
                    other = np.arange(len(anchor)) - np.repeat(parts.cumsum() - parts, parts)
                    key = np.concatenate([((home << 11 | part) << 1)[stay], (anchor << 11 | other) << 1 | 1])
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.concatenate([fps[stay], fps[index]]).view(np.int64))], ["key", "fp"])

        return run

    def linked(own: int) -> DataFrame:
        sent = distinct.select("fp").mapInArrow(replicate(own), "key long, fp long")
        return sent.repartition(F.shiftright("key", 1)).sortWithinPartitions("key").mapInArrow(_compare(t), "a long, b long")

    if slices == 1:
        return linked(0)
    out = None
    for own in range(slices):
        edges = written(linked(own), "links")
        out = edges if out is None else out.unionByName(edges)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, t: int = 4) -> DataFrame:
    """(id_col, fingerprint, component_id) for every row of docs.

    Texts link at t or fewer differing bits; component_id is the smallest id
    reachable over links. Equal fingerprints meet first, in an aggregate, so
    copies cost nothing afterwards. Null and blank texts have fingerprint
    zero and link like any other; a row whose id is null is kept and takes
    its component's smallest id that is not null, or null; repeated rows stay
    repeated; other columns of docs are not read. An empty table gives an
    empty result."""
    spark = docs.sparkSession
    # short rows: dealt anew, they make few files
    each = written(fingerprints(docs, id_col, text_col, words).repartition("fp", id_col), "fingerprints")
    distinct = written(each.groupBy("fp").agg(F.min(id_col).alias("first")), "distinct")
    roots = components(links(distinct, t))
    of = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = of.groupBy("root").agg(F.min("first").alias("component_id"))
    of = of.join(least, "root").select("fp", "component_id")
    return each.join(of, "fp").select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
