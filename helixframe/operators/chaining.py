"""Chains of anchors: shared seeds of two sequences in one order, with gaps
that cost what they drift."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import kmer

#: Places of a seed that are joined in one group: more are dealt out.
MOST_PLACES = 100_000
#: Fixed values of the gap cost: two letters of drift cost one, beyond FAR letters each costs two.
FAR, NEAR_SHARE, FAR_COST = 100, 2, 2
#: Anchors of groups that are worked through side by side, and that groups are taken from; a place behind all anchors.
BLOCK, POOL, AFTER = 1 << 15, 1 << 18, 1 << 60


def anchors(left: DataFrame, right: DataFrame, split: int = MOST_PLACES) -> DataFrame:
    """(a, b, back, a_pos, b_pos): every place of a seed of left (id, pos,
    minimizer, back) with each of its places in right. No seed is passed over: one
    with more than split places in right has them dealt into groups, to each of
    which its places in left are sent. back tells that the strands differ; b_pos
    then counts downwards from 0."""
    hot = right.groupBy("minimizer").agg(F.count("*").alias("n")).where(F.col("n") > split).select("minimizer", F.ceil(F.col("n") / split).cast("int").alias("parts"))
    parts = F.coalesce("parts", F.lit(1))
    r = right.join(hot, "minimizer", "left").select("minimizer", F.pmod(F.xxhash64("id", "pos"), parts).cast("int").alias("part"), F.col("id").alias("b"), F.col("pos").alias("b_at"), F.col("back").alias("b_back"))
    l_ = left.join(hot, "minimizer", "left").select("minimizer", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.col("id").alias("a"), F.col("pos").alias("a_pos"), F.col("back").alias("a_back"))
    back = F.col("a_back") != F.col("b_back")
    return l_.join(r, ["minimizer", "part"]).select("a", "b", back.alias("back"), "a_pos", F.when(back, -F.col("b_at")).otherwise(F.col("b_at")).alias("b_pos"))


def scored(a: np.ndarray, b: np.ndarray, k: int, most_jump: int, most_back: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Best scores of chains that end at each anchor, and the anchors before (-1: none), of groups side by side: arrays groups x anchors, ascending by a and then b, with AFTER in a behind the last anchor of a group.

    An anchor adds the letters of it that the one before does not cover, k at
    most, less the cost of the drift; of equals the nearest one before counts.
    most_back: how many anchors it looks back over at most."""
    score, before = np.full(a.shape, k, np.int64), np.full(a.shape, -1, np.int64)
    rows = np.arange(len(a))
    lo = 0
    for i in range(1, a.shape[1]):
        while lo < i and (a[:, lo] <= a[:, i] - most_jump).all():
            lo += 1
        lo = lo if most_back is None else max(lo, i - most_back)
        if lo == i:
            continue
        da, db = a[:, i, None] - a[:, lo:i], b[:, i, None] - b[:, lo:i]
        drift = np.abs(da - db)
        cost = np.where(drift > FAR, drift * FAR_COST, drift // NEAR_SHARE)
        fits = (da > 0) & (da < most_jump) & (db > 0) & (db < most_jump)
        chained = np.where(fits, score[:, lo:i] + np.minimum(np.minimum(da, db), k) - cost, -1)
        j = i - 1 - chained[:, ::-1].argmax(1)
        most = chained[rows, j - lo]
        better = most > k
        score[better, i], before[better, i] = most[better], j[better]
    return score, before


def side_by_side(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """The numbers of groups of about equal size, as many as make a block."""
    order = np.argsort(sizes, kind="stable")
    ranked = sizes[order]
    lo = 0
    while lo < len(order):
        hi = int(np.searchsorted(ranked, (int(ranked[lo]) * 4 + 3) // 3, "right"))
        fits = np.arange(1, hi - lo + 1) * ranked[lo:hi] <= BLOCK
        hi = lo + max(1, int(np.count_nonzero(fits)))
        yield order[lo:hi]
        lo = hi


def best_of(score: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, anchors, score) of the best chain of each group of a block; scores behind a group's last anchor are below those of anchors."""
    rows = np.arange(len(score))
    last = score.argmax(1)
    first, n, at = last.copy(), np.ones(len(score), np.int64), before[rows, last]
    while (on := at >= 0).any():
        first[on], n[on] = at[on], n[on] + 1
        at = np.where(on, before[rows, at], -1)
    return first, last, n, score[rows, last]


def taken(score: np.ndarray, before: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(first, last, anchors, score) of a group's chains: from the anchor of the best score back to one that a better chain has, or to the beginning."""
    used = np.zeros(len(score), bool)
    for last in np.argsort(-score, kind="stable").tolist():
        if used[last]:
            continue
        at, n = last, 0
        while at >= 0 and not used[at]:
            used[at] = True
            first, at, n = at, int(before[at]), n + 1
        yield first, last, n, int(score[last] - (score[at] if at >= 0 else 0))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """The rows of batches that are sorted by their first columns, keys in number, so dealt that no group of equal keys is in two batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, bool)
        for c in range(keys):
            column = batch.column(c).to_numpy(zero_copy_only=False)
            new[1:] |= column[1:] != column[:-1]
            new[0] |= bool(held) and column[0] != held[-1].column(c)[-1].as_py()
        cuts = np.flatnonzero(new)
        if len(cuts) and (held or cuts[-1]):
            yield pa.Table.from_batches([*held, batch.slice(0, int(cuts[-1]))]).combine_chunks().to_batches()[0]
            held = []
        held.append(batch.slice(int(cuts[-1]) if len(cuts) else 0))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def pooled(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until they have so many rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def chains(rows: DataFrame, k: int, most_jump: int = 1500, least: int = 3, only_best: bool = False, most_back: int | None = None) -> DataFrame:
    """(a, b, back, n, score, a_lo, a_hi, b_lo, b_hi) of chains of least
    anchors or more: anchors (a, b, back, a_pos, b_pos) of k letters, taken by a
    dynamic program over each pair and strand. An anchor takes part in one chain.

    Chains do not go on over gaps of most_jump letters, so that a pair's
    anchors are cut there, and a task holds one stretch between such gaps. With
    only_best there is at most one chain for each pair and strand: that of the
    largest score, of equals the one that ends first, if it has least anchors.
    With most_back an anchor looks back over so many others at most, which
    keeps tandem repeats, where anchors are the product of the repeats'
    lengths, from taking the square of that; None is exact. Ends are outside; b_lo and b_hi
    are on b's own strand."""
    by = ["a", "b", "back"]
    w = Window.partitionBy(*by).orderBy("a_pos", "b_pos")
    far = F.col("a_pos") - F.lag("a_pos").over(w) >= most_jump
    rows = rows.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"), "back", F.col("a_pos").cast("long").alias("a_pos"), F.col("b_pos").cast("long").alias("b_pos"))
    rows = rows.withColumn("island", F.sum(F.when(far, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # a pair of fewer anchors has no chain; its rows do not go to Python
    rows = rows.withColumn("n", F.count("*").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).where(F.col("n") >= least)
    rows = rows.select(*by, "island", "a_pos", "b_pos").sortWithinPartitions(*by, "island", "a_pos", "b_pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*by, "n", "score", "a_lo", "a_hi", "b_first", "b_last"]
        for batch in pooled(whole_groups(batches, 4), POOL):
            *keys, x, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(6))
            new = np.append(True, np.zeros(batch.num_rows - 1, bool))
            for c in keys:
                new[1:] |= c[1:] != c[:-1]
            begin = np.flatnonzero(new)
            sizes = np.diff(np.append(begin, batch.num_rows))
            if not only_best:
                begin, sizes = begin[sizes >= least], sizes[sizes >= least]
            for own in side_by_side(sizes):
                at = begin[own, None] + np.arange(sizes[own[-1]])
                inside = np.arange(at.shape[1]) < sizes[own, None]
                at = np.minimum(at, batch.num_rows - 1)
                a, b = np.where(inside, x[at], AFTER), np.where(inside, y[at], 0)
                score, before = scored(a, b, k, most_jump, most_back)
                if only_best:
                    group, (first, last, n, value) = np.arange(len(own)), best_of(np.where(inside, score, -1), before)
                else:
                    chains_ = [(row, *chain) for row, size in enumerate(sizes[own].tolist()) for chain in taken(score[row, :size], before[row, :size]) if chain[2] >= least]
                    if not chains_:
                        continue
                    group, first, last, n, value = np.array(chains_, np.int64).T
                columns = [*(c[begin[own[group]]] for c in keys[:3]), n, value, a[group, first], a[group, last] + k, b[group, first], b[group, last]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    found = rows.mapInArrow(run, "a long, b long, back boolean, n long, score long, a_lo long, a_hi long, b_first long, b_last long")
    if only_best:
        best = F.max(F.struct("score", (-F.col("a_hi")).alias("e"), (-F.col("b_last")).alias("f"), "n", "a_lo", "a_hi", "b_first", "b_last")).alias("x")
        found = found.groupBy(*by).agg(best).select(*by, "x.n", "x.score", "x.a_lo", "x.a_hi", "x.b_first", "x.b_last").where(F.col("n") >= least)
    turned = lambda forward, backward: F.when(F.col("back"), backward).otherwise(forward)
    return found.select(*by, "n", "score", "a_lo", "a_hi", turned(F.col("b_first"), -F.col("b_last")).alias("b_lo"), turned(F.col("b_last") + k, k - F.col("b_first")).alias("b_hi"))


#: Letters of sequences that are sent to all tasks at most.
SENT = 2_000_000


class AtOnce(NamedTuple):
    """What is worked through at once, and more only where one sequence or anchor has more: letters, anchors, anchors
    of one sequence beyond which the others are gone through in parts, and pairs of anchors of which one may come before the other."""

    letters: int = 1 << 19
    anchors: int = 1 << 20
    most: int = 1 << 23
    pairs: int = 1 << 16


class Index(NamedTuple):
    """Places of seeds in sequences, sorted by code: of[strand] has (sequence, whether strands differ, place) for a seed of that strand, the places of a code and sequence ascending as anchors have them."""

    code: np.ndarray
    of: tuple[tuple[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]

    def part(self, lo: int, hi: int) -> Index:
        """The places in the sequences from lo to hi."""
        # both orders are by code and sequence first
        at = (self.of[0][0] >= lo) & (self.of[0][0] < hi)
        return Index(self.code[at], tuple(tuple(c[at] for c in side) for side in self.of))


def _seeds(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, code of the smaller strand, whether that is the other one) of all k-mers."""
    raw = [t.encode() for t in texts]
    lengths = np.array([len(x) + 1 for x in raw])
    own, other, good = kmer._codes(np.frombuffer(b"\n".join(raw), np.uint8), k)
    at = np.flatnonzero(good & (own != other))
    text = np.repeat(np.arange(len(raw)), lengths)[at]
    return text, at - (np.cumsum(lengths) - lengths)[text], np.minimum(own, other)[at], own[at] > other[at]


def index(texts: list[str], of: list[int], k: int) -> Index:
    """of: the number of the sequence that a text is, or is one of."""
    text, pos, code, back = _seeds(texts, k)
    number = np.array(of, np.int64)[text]
    sides = []
    for strand in (False, True):
        differ = back != strand
        place = np.where(differ, -pos, pos)
        at = np.lexsort((place, differ, number, code))
        sides.append((number[at], differ[at], place[at]))
    return Index(np.sort(code), (sides[0], sides[1]))


def _met(places: Index, code: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, ...]:
    """(seed, sequence, whether strands differ, place) of all places of seeds."""
    lo = np.searchsorted(places.code, code, "left")
    n = np.searchsorted(places.code, code, "right") - lo
    seed = np.repeat(np.arange(len(code)), n)
    at = np.arange(len(seed)) + (lo - (np.cumsum(n) - n))[seed]
    on = back[seed]
    return seed, *(np.where(on, two[at], one[at]) for one, two in zip(*places.of, strict=True))


def _best(group: np.ndarray, x: np.ndarray, y: np.ndarray, k: int, most_jump: int, least: int, pairs: int) -> tuple[np.ndarray, ...]:
    """(group, anchors, score, first a, last a, first b, last b) of the best chain of each group; anchors are sorted by group, x and y."""
    new = np.append(True, group[1:] != group[:-1])
    begin = np.flatnonzero(new)
    many = np.repeat(np.diff(np.append(begin, len(group))) >= least, np.diff(np.append(begin, len(group))))
    group, x, y = group[many], x[many], y[many]
    if not len(group):
        return tuple(np.zeros((7, 0), np.int64))
    begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    score, before = by_levels(np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(group)))), x, y, k, most_jump, pairs)
    top = score == np.repeat(np.maximum.reduceat(score, begin), np.diff(np.append(begin, len(group))))
    # of equals the one that ends first: in a, and then in b
    ends = np.flatnonzero(top)
    last = ends[np.append(True, group[ends[1:]] != group[ends[:-1]])]
    first, n, at = last.copy(), np.ones(len(last), np.int64), before[last]
    while len(on := np.flatnonzero(at >= 0)):
        first[on], n[on] = at[on], n[on] + 1
        at[on] = before[at[on]]
    enough = n >= least
    first, last, n = first[enough], last[enough], n[enough]
    return group[last], n, score[last], x[first], x[last], y[first], y[last]


def by_levels(group: np.ndarray, x: np.ndarray, y: np.ndarray, k: int, most_jump: int, pairs: int) -> tuple[np.ndarray, np.ndarray]:
    """scored() of groups (numbered from 0, in order), one after another: best scores of chains that end at each anchor, and the anchors before (-1: none).

    A chain goes up in b, so that all anchors that have the r-th place in b of
    their group are worked out at once, in slices of so many pairs."""
    score, before = np.full(len(x), k, np.int64), np.full(len(x), -1, np.int64)
    wide = int(x.max()) - int(x.min()) + most_jump + 1
    key = group * wide + (x - x.min())
    # within a group: from the first anchor that is near enough up to those of the same place in a
    lo = np.maximum(np.searchsorted(key, key - most_jump, "right"), np.searchsorted(group, group, "left"))
    n = np.searchsorted(key, key, "left") - lo
    order = np.lexsort((y, group))
    new = np.append(False, (y[order[1:]] != y[order[:-1]]) & (group[order[1:]] == group[order[:-1]]))
    rank = np.cumsum(new)
    first = np.searchsorted(group[order], group[order], "left")
    level = np.empty(len(x), np.int64)
    level[order] = rank - rank[first]
    some = np.flatnonzero((n > 0) & (level > 0))
    some = some[np.argsort(level[some], kind="stable")]
    if not len(some):
        return score, before
    cuts = np.flatnonzero(np.append(True, level[some[1:]] != level[some[:-1]]))
    far = np.cumsum(n[some])
    down, diagonal = (c.astype(np.int32) for c in (y, x - y))
    drifts = np.arange(most_jump)  # of two steps below most_jump
    cost = np.where(drifts > FAR, drifts * FAR_COST, drifts // NEAR_SHARE)
    for begin, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(some)], strict=True):
        while begin < end:
            stop = max(begin + 1, min(end, int(np.searchsorted(far, (far[begin - 1] if begin else 0) + pairs, "right"))))
            own = some[begin:stop]
            size = n[own]
            starts = np.cumsum(size) - size
            j = np.arange(int(size.sum()), dtype=np.int32) + np.repeat((lo[own] - starts).astype(np.int32), size)
            db = np.repeat(down[own], size) - down[j]
            fits = np.flatnonzero((db > 0) & (db < most_jump))
            db, at = db[fits], j[fits]
            drift = np.repeat(diagonal[own], size)[fits] - diagonal[at]
            chained = score[at] + np.minimum(db + np.minimum(drift, 0), k) - cost[np.abs(drift)]
            # the best, of equals the nearest one before
            value = np.full(len(j), -1, np.int64)
            value[fits] = np.maximum(chained, -1) << 32 | at
            best = np.maximum.reduceat(value, starts)
            better = best >> 32 > k
            score[own[better]], before[own[better]] = best[better] >> 32, best[better] & 0xFFFFFFFF
            begin = stop
    return score, before


#: Of a chain: cut(a_seq, b_seq, back, a_lo, a_hi, b_lo, b_hi) are two strings of it.
Cut = Callable[[str, str, bool, int, int, int, int], tuple[str, str]]


def best_between(left: DataFrame, right: DataFrame, k: int, most_jump: int, least: int, cut: Cut | None = None, at_once: AtOnce = AtOnce()) -> DataFrame:
    """chains(anchors(), only_best=True) of the k-mers (of an odd number of
    letters) of left with those of right: id, seq. With cut the chains have the
    columns x and y of it, too.

    Where right has SENT letters at most, its seeds are sent to where the
    sequences of left are: all anchors of one meet there, and none is shuffled.
    Sequences of less than k letters are left out. Those of an id that comes
    more than once count as one; cut is asked for each of them."""
    if k % 2 == 0:
        raise ValueError("a seed has an odd number of letters")
    of = lambda rows: rows.where(F.octet_length("seq") >= k).select(F.col("id").cast("long").alias("id"), "seq")
    left, right = of(left), of(right)
    if (right.agg(F.sum(F.octet_length("seq"))).first()[0] or 0) > SENT:
        seeds = lambda rows: kmer.codes(rows, k, both_strands=False, keep=("id",), positions=True, strands=True).withColumnRenamed("code", "minimizer")
        found = chains(anchors(seeds(left), seeds(right)), k, most_jump, least, only_best=True)
        return found if cut is None else _with_cuts(found, left, right, cut)
    rows = right.collect()
    numbers = {i: n for n, i in enumerate(dict.fromkeys(r["id"] for r in rows))}
    places = index([r["seq"] for r in rows], [numbers[r["id"]] for r in rows], k)
    texts: list[list[str]] = [[] for _ in numbers]
    for r in rows:
        texts[numbers[r["id"]]].append(r["seq"])
    right_ids = pa.array(list(numbers), pa.int64())
    names = ["a", "b", "back", "n", "score", "a_lo", "a_hi", "b_lo", "b_hi"] + ([] if cut is None else ["x", "y"])

    def found_in(own: Index, lo: int, hi: int, a: np.ndarray, pos: np.ndarray, code: np.ndarray, back: np.ndarray, mixed: bool) -> Iterator[tuple[np.ndarray, ...]]:
        n = np.searchsorted(own.code, code, "right") - np.searchsorted(own.code, code, "left")
        if n.sum() > at_once.most and hi - lo > 1:
            mid = (lo + hi) // 2
            for part in ((lo, mid), (mid, hi)):
                yield from found_in(own.part(*part), *part, a, pos, code, back, mixed)
            return
        seed, b, differ, y = _met(own, code, back)
        group, x = (a[seed] * len(texts) + b) * 2 + differ, pos[seed]
        order = np.lexsort((y, x, group)) if mixed else np.argsort(group, kind="stable")
        if len(order):
            yield _best(group[order], x[order], y[order], k, most_jump, least, at_once.pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, 1):
            ids, seqs = batch.column(0), batch.column(1).to_pylist()
            known = ids.to_numpy(zero_copy_only=False)
            new = np.append(True, known[1:] != known[:-1])
            number, begins = np.cumsum(new) - 1, np.append(np.flatnonzero(new), len(seqs))
            far = np.cumsum([len(s) for s in seqs])
            lo = 0
            while lo < len(begins) - 1:
                # whole ids until they have so many letters
                before = far[begins[lo] - 1] if begins[lo] else 0
                hi = max(lo + 1, int(np.searchsorted(far[begins[lo + 1 :] - 1] - before, at_once.letters, "right")) + lo)
                text, pos, code, back = _seeds(seqs[begins[lo] : begins[hi]], k)
                a = number[begins[lo] + text]
                n = np.searchsorted(places.code, code, "right") - np.searchsorted(places.code, code, "left")
                met = n > 0
                a, pos, code, back, n = a[met], pos[met], code[met], back[met], n[met]
                # whole ids again until they have so many anchors
                ends = np.flatnonzero(np.append(a[1:] != a[:-1], True))[: len(a)] + 1
                total, at = np.cumsum(n), 0
                while at < len(a):
                    before = total[at - 1] if at else 0
                    some = ends[ends > at]
                    end = int(some[max(0, int(np.searchsorted(total[some - 1] - before, at_once.anchors, "right")) - 1)])
                    own = slice(at, end)
                    mixed = int(begins[a[end - 1] + 1] - begins[a[at]]) > len(set(a[own].tolist()))
                    for group, count, value, a_lo, a_hi, b_first, b_last in found_in(places, 0, len(texts), a[own], pos[own], code[own], back[own], mixed):
                        yield from sent_back(ids, seqs, begins, group, count, value, a_lo, a_hi + k, b_first, b_last)
                    at = end
                lo = hi

    def sent_back(ids: pa.Array, seqs: list[str], begins: np.ndarray, group: np.ndarray, n: np.ndarray, value: np.ndarray, a_lo: np.ndarray, a_hi: np.ndarray, b_first: np.ndarray, b_last: np.ndarray) -> Iterator[pa.RecordBatch]:
        back, pair = group % 2 == 1, group // 2
        a, b = pair // len(texts), pair % len(texts)
        b_lo, b_hi = np.where(back, -b_last, b_first), np.where(back, k - b_first, b_last + k)
        columns = [ids.take(pa.array(begins[a])), right_ids.take(pa.array(b)), *(pa.array(c) for c in (back, n, value, a_lo, a_hi, b_lo, b_hi))]
        if cut is not None:
            at, cuts = [], []
            for row, (i, j, *place) in enumerate(zip(*(c.tolist() for c in (a, b, back, a_lo, a_hi, b_lo, b_hi)), strict=True)):
                for s in seqs[begins[i] : begins[i + 1]]:
                    for t in texts[j]:
                        at.append(row)
                        cuts.append(cut(s, t, *place))
            columns = [c.take(pa.array(at, pa.int64())) for c in columns] + [pa.array([c[z] for c in cuts], pa.string()) for z in range(2)]
        yield pa.RecordBatch.from_arrays(columns, names)

    kinds = "a long, b long, back boolean, n long, score long, a_lo long, a_hi long, b_lo long, b_hi long" + ("" if cut is None else ", x string, y string")
    return dealt(left, "id").sortWithinPartitions("id").mapInArrow(run, kinds)


def _with_cuts(found: DataFrame, left: DataFrame, right: DataFrame, cut: Cut) -> DataFrame:
    """Chains with x and y, where sequences are joined to them."""
    places, names = ["back", "a_lo", "a_hi", "b_lo", "b_hi"], found.columns
    rows = found.join(left.select(F.col("id").alias("a"), F.col("seq").alias("__a")), "a").join(right.select(F.col("id").alias("b"), F.col("seq").alias("__b")), "b").select(*found.columns, "__a", "__b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = [cut(*row) for row in zip(*(batch.column(c).to_pylist() for c in ("__a", "__b", *places)), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *(pa.array([c[z] for c in cuts], pa.string()) for z in range(2))], [*names, "x", "y"])

    return rows.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema) + ", x string, y string")


def dealt(rows: DataFrame, *by: str) -> DataFrame:
    """rows dealt out, so that few bytes with much work are not put into one task."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *by)


def divergence(n: Column, a: Column, b: Column, k: int) -> Column:
    """The share of letters that differ, by how many of the k-mers of the longer stretch are in the chain."""
    return F.ln(1 / F.least(F.lit(1.0), n / F.greatest(a, b))) / k
