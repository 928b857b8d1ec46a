"""Filters and reports over pairwise alignments: ref, qry, s_r, e_r, s_q, e_q
(from 1, both ends inside) and idy, a percentage."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .chaining import whole_groups


def span(a: str, b: str) -> Column:
    return F.abs(F.col(b) - F.col(a)) + 1


def filter_simple(rows: DataFrame, least_identity: float, least_length: int) -> DataFrame:
    return rows.where((F.col("idy") >= least_identity) & (span("s_r", "e_r") >= least_length) & (span("s_q", "e_q") >= least_length))


def unique_share(rows: DataFrame, name: str, lo: str, hi: str, key: str) -> DataFrame:
    """(key, share): the percentage of each alignment that no other of the same
    sequence covers. Depth-one regions come from a sweep over the ends; each
    of them is the part of one alignment alone."""
    rows = rows.select(key, name, F.least(lo, hi).alias("lo"), (F.greatest(lo, hi) + 1).alias("hi"))
    events = rows.select(name, F.explode(F.array(F.struct(F.col("lo").alias("at"), F.lit(1).alias("d"), F.col(key).alias("k")), F.struct(F.col("hi").alias("at"), F.lit(-1).alias("d"), (-F.col(key)).alias("k")))).alias("e"))
    at = events.groupBy(name, F.col("e.at").alias("at")).agg(F.sum("e.d").alias("d"), F.sum("e.k").alias("k"))
    w = Window.partitionBy(name).orderBy("at")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    # the running sum of keys is, where the depth is one, the key of the one that is open
    alone = at.withColumn("depth", F.sum("d").over(run)).withColumn(key, F.sum("k").over(run)).withColumn("n", F.lead("at").over(w) - F.col("at")).where("depth = 1").groupBy(key).agg(F.sum("n").alias("n"))
    return rows.join(alone, key, "left").select(key, (100 * F.coalesce("n", F.lit(0)) / (F.col("hi") - F.col("lo"))).alias("share"))


def filter_unique(rows: DataFrame, least_share: float, key: str = "aln") -> DataFrame:
    """Alignments of which least_share percent or more is unique on the reference and then, among those left, on the query."""
    kept = rows.join(unique_share(rows, "ref", "s_r", "e_r", key).where(F.col("share") >= least_share), key, "left_semi")
    return kept.join(unique_share(kept, "qry", "s_q", "e_q", key).where(F.col("share") >= least_share), key, "left_semi")


def best_chain(rows: DataFrame, side: str = "ref", most_overlap: float = 100.0, key: str = "aln") -> DataFrame:
    """Keys of the best chain of each reference (side="ref") or query sequence:
    the ascending set of alignments with the largest score, where one adds
    trunc((length - overlap) * identity^2) to the best chain before it, if the
    overlap is at most most_overlap percent of both. Ties go to the earlier.

    Of alignments that have ended before one begins only the best counts, so
    that it is compared with those alone that are open where it begins. Where many
    are, and may overlap freely, those with the same end are one: the best. Equal
    alignments are one from the start, that of the smallest key, as no other is ever taken."""
    lo, hi = ("s_r", "e_r") if side == "ref" else ("s_q", "e_q")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["lo", "hi", key], kind="stable")
        los, his, keys = (pdf[c].to_numpy(np.int64) for c in ("lo", "hi", key))
        weights = (pdf.idy.to_numpy(float) / 100) ** 2
        ends = np.unique(his)
        open_ = (np.searchsorted(ends, his) - np.searchsorted(ends, los)).mean()
        score, before = (_chained_by_ends(los, his, weights, ends) if most_overlap >= 100 and open_ > MANY_OPEN else _chained_by_one(los, his, weights, most_overlap))
        at, out = int(np.argmax(score)), []
        while at >= 0:
            out.append(int(keys[at]))
            at = int(before[at])
        return pd.DataFrame({key: out})

    rows = rows.select(side, "idy", F.least(lo, hi).alias("lo"), F.greatest(lo, hi).alias("hi"), key)
    return rows.groupBy(side, "lo", "hi", "idy").agg(F.min(key).alias(key)).groupBy(side).applyInPandas(run, f"{key} long")


#: Different ends between begin and end of a mean alignment of a sequence, from which on alignments are chained by their ends.
MANY_OPEN = 16


def _chained_by_one(begins: np.ndarray, ends: np.ndarray, weights: np.ndarray, most_overlap: float) -> tuple[list[int], list[int]]:
    """Scores of the best chains up to each alignment, and the alignments before (-1: none)."""
    los, his = begins.tolist(), ends.tolist()
    score, before = [0] * len(los), [-1] * len(los)
    open_: list[tuple[int, int]] = []  # (end, alignment), the first end on top
    closed, of = -1, -1
    for i, (begin, end, w) in enumerate(zip(los, his, weights.tolist(), strict=True)):
        while open_ and open_[0][0] < begin:
            j = heapq.heappop(open_)[1]
            if score[j] > closed or (score[j] == closed and j < of):
                closed, of = score[j], j
        n = end - begin + 1
        own = int(n * w)
        best, at = (closed + own, of) if of >= 0 else (-1, -1)
        for far, j in open_:
            overlap = far - begin + 1
            if end > far and 100 * overlap <= most_overlap * n and 100 * overlap <= most_overlap * (far - los[j] + 1):
                value = score[j] + int((n - overlap) * w)
                if value > best or (value == best and j < at):
                    best, at = value, j
        score[i], before[i] = (best, at) if best > own else (own, -1)
        heapq.heappush(open_, (end, i))
    return score, before


def _chained_by_ends(los: np.ndarray, his: np.ndarray, weights: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for overlaps of any size. What an alignment adds depends on where the
    one before ends, so that of each end the best one counts, the first of equals;
    alignments of one place are worked out together."""
    score, before = np.zeros(len(los), np.int64), np.full(len(los), -1, np.int64)
    top, of = np.full(len(ends), -1, np.int64), np.full(len(ends), len(los), np.int64)
    own = ((his - los + 1) * weights).astype(np.int64)
    first = np.flatnonzero(np.append(True, (los[1:] != los[:-1]) | (his[1:] != his[:-1])))
    left, right = np.searchsorted(ends, los[first]).tolist(), np.searchsorted(ends, his[first]).tolist()
    closed, closed_of, past = -1, -1, 0
    for lo, hi, l_, r, end in zip(first.tolist(), np.append(first[1:], len(los)).tolist(), left, right, his[first].tolist(), strict=True):
        if past < l_:  # ends before this place, of which none is behind the next
            most = int(top[past:l_].max())
            j = int(of[past:l_][top[past:l_] == most].min())
            if most > closed or (most == closed and j < closed_of):
                closed, closed_of = most, j
            past = l_
        best = own[lo:hi] + closed if closed_of >= 0 else np.full(hi - lo, -1, np.int64)
        at = np.full(hi - lo, closed_of, np.int64)
        if l_ < r:
            value = top[l_:r] + ((end - ends[l_:r]) * weights[lo:hi, None]).astype(np.int64)
            value[:, top[l_:r] < 0] = -1
            most = value.max(1)
            j = np.where(value == most[:, None], of[l_:r], len(los)).min(1)
            better = (most > best) | ((most == best) & (j < at))
            best, at = np.where(better, most, best), np.where(better, j, at)
        goes_on = best > own[lo:hi]
        score[lo:hi], before[lo:hi] = np.where(goes_on, best, own[lo:hi]), np.where(goes_on, at, -1)
        k = lo + int(score[lo:hi].argmax())
        if score[k] > top[r] or (score[k] == top[r] and k < of[r]):
            top[r], of[r] = score[k], k
    return score, before


def one_to_one(rows: DataFrame, key: str = "aln") -> DataFrame:
    """Alignments of the best chains of both their sequences."""
    return rows.join(best_chain(rows, "ref", key=key), key, "left_semi").join(best_chain(rows, "qry", key=key), key, "left_semi")


def many_to_many(rows: DataFrame, key: str = "aln") -> DataFrame:
    """Alignments of the best chain of either sequence."""
    return rows.join(best_chain(rows, "ref", key=key).unionByName(best_chain(rows, "qry", key=key)).distinct(), key, "left_semi")


def clusters(matches: DataFrame, most_gap: int = 90, diagonal_difference: int = 5, diagonal_factor: float = 0.12, least: int = 65) -> DataFrame:
    """(ref, qry, cluster, n, total, s_r, e_r, s_q, e_q): exact matches (ref,
    qry, r, q, length) joined while the next one along the reference begins at
    most most_gap after the end of an earlier one of its cluster and the
    diagonals differ by at most max(diagonal_difference, diagonal_factor *
    separation); clusters of least matched bases or more, named by the place of
    their first match among those of the pair.

    A pair's matches are cut where most_gap letters of the reference follow
    without one; a task holds one stretch between such gaps, of which all
    matches are compared with their next ones at once."""
    by = Window.partitionBy("ref", "qry").orderBy("r", "q", "length")
    far = F.max(F.col("r") + F.col("length")).over(by.rowsBetween(Window.unboundedPreceding, -1))
    rows = matches.select(*(F.col(c).cast("long").alias(c) for c in ("ref", "qry", "r", "q", "length"))).withColumn("k", F.row_number().over(by).cast("long") - 1)
    rows = rows.withColumn("island", F.sum(F.when(F.col("r") - far > most_gap, 1).otherwise(0)).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.select("ref", "qry", "island", "r", "q", "length", "k").sortWithinPartitions("ref", "qry", "island", "k")

    def joined(r: np.ndarray, q: np.ndarray, n: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Of each match the first one of its cluster."""
        root = np.arange(len(r))
        live, step = np.arange(len(r)), 0
        while len(live):
            step += 1
            live = live[live + step < len(r)]
            apart = r[live + step] - r[live] - n[live]
            near = (group[live + step] == group[live]) & (apart <= most_gap)
            live, apart = live[near], apart[near]
            drift = np.abs(q[live + step] - r[live + step] - q[live] + r[live])
            hit = drift <= np.maximum(diagonal_difference, (diagonal_factor * apart).astype(np.int64))
            a, b = live[hit], live[hit] + step
            while len(a):  # roots only fall, and both ends of a link end up under one
                x, y = root[a], root[b]
                np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
                while not np.array_equal(root, up := root[root]):
                    root = up
                apart_ = root[a] != root[b]
                a, b = a[apart_], b[apart_]
        return root

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 3):
            c = [table.column(i).to_numpy() for i in range(7)]
            new = np.append(True, (c[0][1:] != c[0][:-1]) | (c[1][1:] != c[1][:-1]) | (c[2][1:] != c[2][:-1]))
            root = joined(c[3], c[4], c[5], np.cumsum(new))
            first, of = np.unique(root, return_inverse=True)
            total = np.bincount(of, c[5]).astype(np.int64)
            ends = []
            for f, start, values in ((np.minimum, 1 << 62, c[3]), (np.maximum, -1, c[3] + c[5]), (np.minimum, 1 << 62, c[4]), (np.maximum, -1, c[4] + c[5])):
                out = np.full(len(first), start, np.int64)
                f.at(out, of, values)
                ends.append(out)
            some = total >= least
            columns = [c[0][first], c[1][first], c[6][first], np.bincount(of).astype(np.int64), total, *ends]
            if some.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in columns], ["ref", "qry", "cluster", "n", "total", "s_r", "e_r", "s_q", "e_q"])

    return rows.mapInArrow(run, "ref long, qry long, cluster long, n long, total long, s_r long, e_r long, s_q long, e_q long")


def snp_buffers(snps: DataFrame, sizes: DataFrame) -> DataFrame:
    """snps (ref, pos) with the distance to the nearest other one or to an end of the sequence. sizes: ref, size."""
    w = Window.partitionBy("ref").orderBy("pos")
    rows = snps.withColumn("before", F.col("pos") - F.lag("pos").over(w)).withColumn("after", F.lead("pos").over(w) - F.col("pos")).join(sizes, "ref")
    return rows.select("ref", "pos", F.least("before", "after", F.col("pos"), F.col("size") - F.col("pos") + 1).alias("buffer"))


def structural_breaks(rows: DataFrame) -> DataFrame:
    """Between neighbours along a reference: SEQ (another query), INV (another
    direction), JMP (not in order on the query), DUP (they overlap on the
    reference), else GAP, with the lengths between them."""
    forward = F.col("s_q") <= F.col("e_q")
    w = Window.partitionBy("ref").orderBy("s_r", "e_r", "qry", "s_q")
    before = lambda c: F.lag(c).over(w)
    rows = rows.withColumn("fwd", forward).withColumns({"p_qry": before("qry"), "p_e_r": before("e_r"), "p_e_q": before("e_q"), "p_fwd": before("fwd")}).where(F.col("p_qry").isNotNull())
    gap_r = F.col("s_r") - F.col("p_e_r") - 1
    gap_q = F.when(F.col("fwd"), F.col("s_q") - F.col("p_e_q") - 1).otherwise(F.col("p_e_q") - F.col("s_q") - 1)
    wrong = F.when(F.col("fwd"), F.col("s_q") <= F.col("p_e_q") - 1000).otherwise(F.col("s_q") >= F.col("p_e_q") + 1000)
    kind = F.when(F.col("p_qry") != F.col("qry"), "SEQ").when(F.col("p_fwd") != F.col("fwd"), "INV").when(wrong, "JMP").when(gap_r < 0, "DUP").otherwise("GAP")
    return rows.select("ref", F.col("p_e_r").alias("from_r"), F.col("s_r").alias("to_r"), kind.alias("kind"), gap_r.alias("gap_r"), F.when(F.col("p_qry") == F.col("qry"), gap_q).alias("gap_q"))


def coverage_report(rows: DataFrame, ref_sizes: DataFrame, qry_sizes: DataFrame) -> DataFrame:
    """Alignments with lengths and the shares of both sequences that they cover; sizes: ref or qry, and r_size or q_size."""
    out = rows.join(ref_sizes, "ref").join(qry_sizes, "qry").withColumn("len_r", span("s_r", "e_r")).withColumn("len_q", span("s_q", "e_q"))
    return out.withColumn("cov_r", 100 * F.col("len_r") / F.col("r_size")).withColumn("cov_q", 100 * F.col("len_q") / F.col("q_size"))


def assignments(rows: DataFrame) -> DataFrame:
    """Per query the reference with most aligned bases weighted by identity, and its mean place there."""
    n = span("s_r", "e_r") * F.col("idy") / 100
    of = rows.groupBy("qry", "ref").agg(F.sum(n).alias("weight"), (F.sum(n * (F.col("s_r") + F.col("e_r")) / 2) / F.sum(n)).alias("place"))
    best = F.max(F.struct("weight", (-F.col("ref")).alias("r"), "place")).alias("x")
    return of.groupBy("qry").agg(best).select("qry", (-F.col("x.r")).alias("ref"), F.col("x.weight").alias("weight"), F.col("x.place").alias("place"))


def difference_report(rows: DataFrame) -> DataFrame:
    """One row: alignments, sequences, aligned bases and mean identity, weighted."""
    n = span("s_r", "e_r")
    return rows.agg(F.count("*").alias("n_alignments"), F.countDistinct("ref").alias("n_refs"), F.countDistinct("qry").alias("n_qrys"), F.sum(n).alias("aligned_r"), F.sum(span("s_q", "e_q")).alias("aligned_q"), (F.sum(n * F.col("idy")) / F.sum(n)).alias("identity"))


def sampled_evenly(rows: DataFrame, width: int = 100, ratio: float = 1.25, least: int = 10, key: str = "aln") -> DataFrame:
    """Keys of the alignments that are, in more than half of the windows they
    are in, among the max(ratio * the reference's median window coverage, least)
    best by identity."""
    w = rows.select(key, "ref", "idy", F.explode(F.sequence(F.floor(F.col("s_r") / width), F.floor(F.col("e_r") / width))).alias("win"))
    median = w.groupBy("ref", "win").agg(F.count("*").alias("c")).groupBy("ref").agg(F.greatest(F.lit(float(least)), ratio * F.percentile("c", 0.5)).alias("most"))
    rank = F.row_number().over(Window.partitionBy("ref", "win").orderBy(F.desc("idy"), key))
    return w.withColumn("r", rank).join(median, "ref").groupBy(key).agg(F.count_if(F.col("r") <= F.col("most")).alias("good"), F.count("*").alias("n")).where("2 * good > n").select(key)
