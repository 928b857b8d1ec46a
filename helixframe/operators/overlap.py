"""Overlaps between reads: seeds, best edges, matches to unitigs."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import overlap_kind, reverse_complement
from . import graph
from .kmer import codes, enumerate_kmers


#: Letters of reads whose k-mers are on disk at once.
SLICE = 1 << 27


def slices(reads: DataFrame, seq_col: str = "seq") -> list[tuple[int, int] | None]:
    """The parts of k-mers that are worked through one after another, so that shuffles hold those of SLICE letters."""
    n = -(-(reads.agg(F.sum(F.octet_length(seq_col))).first()[0] or 0) // SLICE)
    return [(k, n) for k in range(n)] if n > 1 else [None]


def seed_overlaps(reads: DataFrame, k: int, most: int, least_seeds: int = 1, id_col: str = "id", seq_col: str = "seq") -> DataFrame:
    """(a, b, diagonal, seeds) with a < b: pairs of reads and the diagonal on
    which they share most k-mers (the smallest of equals), if those are
    least_seeds or more. k-mers that occur more than most times seed nothing:
    that cut is part of the operator, and it bounds the join."""
    reads = graph.kept(reads.select(id_col, seq_col))
    key = ["a", "b", "diagonal"]

    def on_diagonals(part: tuple[int, int] | None) -> DataFrame:
        # places meet on their k-mer (k <= 31) once; what is left of one is a short list
        seeds = codes(reads, k, seq_col, both_strands=False, keep=(id_col,), positions=True, part=part)
        rare = seeds.withColumn("n", F.count("*").over(Window.partitionBy("code"))).where((F.col("n") > 1) & (F.col("n") <= most))
        lists = rare.groupBy("code").agg(F.collect_list(F.struct(F.col(id_col).alias("id"), "pos")).alias("y"))
        pairs = lists.select(F.explode("y").alias("x"), "y").select("x", F.explode("y").alias("y")).where("x.id < y.id")
        return pairs.groupBy(F.col("x.id").alias("a"), F.col("y.id").alias("b"), (F.col("x.pos") - F.col("y.pos")).alias("diagonal")).agg(F.count("*").alias("seeds"))

    parts = slices(reads, seq_col)
    if len(parts) == 1:
        on = on_diagonals(None)
    else:
        on = reduce(DataFrame.unionByName, [graph.kept(on_diagonals(p)) for p in parts]).groupBy(*key).agg(F.sum("seeds").alias("seeds"))
    best = on.groupBy("a", "b").agg(F.max(F.struct("seeds", -F.col("diagonal"))).alias("x"))
    return best.select("a", "b", (-F.col("x")["col2"]).alias("diagonal"), F.col("x.seeds").alias("seeds")).where(F.col("seeds") >= least_seeds)


#: Rows that are sent to all tasks at most; with more, both sides of a join are shuffled.
SENT = 1_000_000


def sent(rows: DataFrame) -> DataFrame | None:
    """rows for a join to which they are sent, if they are few."""
    return F.broadcast(rows) if rows.limit(SENT + 1).count() <= SENT else None


def seed_pairs(reads: DataFrame, other: DataFrame, key: str, most: int | None, id_col: str = "id") -> DataFrame:
    """(a, b, shared): how many distinct keys a read of one table shares with one of another; keys in more than most rows of other (None: of any number) are passed over."""
    right = other.select(key, F.col(id_col).alias("b")).distinct()
    if most is not None:
        right = right.join(right.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") <= most).select(key), key)
    left = reads.select(key, F.col(id_col).alias("a"))
    few = sent(right)
    if few is None:
        return left.distinct().join(right, key).groupBy("a", "b").agg(F.count("*").alias("shared"))
    return left.join(few, key).select("a", "b", key).distinct().groupBy("a", "b").agg(F.count("*").alias("shared"))


def select(overlaps: DataFrame, kinds: list[str], most_error: float = 1.0, least_b: int | None = None) -> DataFrame:
    """Overlaps of the named kinds (5p, 3p, contained, contains) with an error rate of at most most_error."""
    out = overlaps.withColumn("kind", overlap_kind(F.col("a_hang"), F.col("b_hang"))).where(F.col("kind").isin(kinds) & (F.col("erate") <= most_error))
    return out if least_b is None else out.where(F.col("b_iid") >= least_b)


def with_lengths(overlaps: DataFrame, lengths: DataFrame, least: int) -> DataFrame:
    """Overlaps (a_iid, b_iid, a_hang, b_hang) with their length, of least bases or more; lengths: iid, size."""
    of = lambda c: lengths.select(F.col("iid").alias(c), F.col("size").alias(f"{c[0]}_size"))
    rows = overlaps.join(of("a_iid"), "a_iid").join(of("b_iid"), "b_iid")
    length = F.col("a_size") - F.greatest("a_hang", F.lit(0)) + F.least("b_hang", F.lit(0))
    return rows.withColumn("length", length).where(F.col("length") >= least)


def best_per_end(overlaps: DataFrame) -> DataFrame:
    """Of each read and end (5p, 3p) the longest dovetail, then that of least error, then of least b_iid."""
    kind = overlap_kind(F.col("a_hang"), F.col("b_hang"))
    rows = overlaps.withColumn("end", kind).where(F.col("end").isin("5p", "3p"))
    best = F.max(F.struct(F.col("length").alias("length"), (-F.col("erate")).alias("e"), (-F.col("b_iid")).alias("b"))).alias("x")
    return rows.groupBy("a_iid", "end").agg(best).select("a_iid", "end", (-F.col("x.b")).alias("b_iid"), F.col("x.length").alias("length"), (-F.col("x.e")).alias("erate"))


def top_per_end(overlaps: DataFrame, n: int) -> DataFrame:
    """The n dovetails of least error of each read and end; ties by b_iid."""
    rows = overlaps.withColumn("end", overlap_kind(F.col("a_hang"), F.col("b_hang"))).where(F.col("end").isin("5p", "3p"))
    w = Window.partitionBy("a_iid", "end").orderBy("erate", "b_iid", "a_hang", "b_hang")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def mutual_best(best: DataFrame) -> DataFrame:
    """Best edges that are the best of the other read, too, at either of its ends: a_iid < b_iid."""
    back = best.select(F.col("a_iid").alias("b_iid"), F.col("b_iid").alias("a_iid")).distinct()
    return best.join(back, ["a_iid", "b_iid"], "left_semi").where("a_iid < b_iid").select("a_iid", "b_iid").distinct()


def spurs(best: DataFrame, reads: DataFrame) -> DataFrame:
    """Per read whether it has best edges at both ends, one (a spur) or none (a singleton)."""
    ends = best.groupBy(F.col("a_iid").alias("iid")).agg(F.count("*").alias("n"))
    return reads.select("iid").join(ends, "iid", "left").select("iid", F.when(F.col("n").isNull(), "singleton").when(F.col("n") == 1, "spur").otherwise("inner").alias("status"))


#: Of unitigs that share an end, so many on either side meet in one place, and the second are put into lists of so many.
FIRST, SECOND, LIST = 1024, 4096, 128


def end_overlaps(unitigs: DataFrame, k: int, id_col: str = "id", seq_col: str = "seq") -> DataFrame:
    """(a, a_ori, b, b_ori): unitigs whose last k - 1 letters, read in one of
    two orientations, begin the other. All pairs are returned, however many
    share an end: they are made in blocks of FIRST times SECOND, dealt out on
    their own, where an a goes through a list of b before the next a does, so
    that files hold the a as runs and the lists as repeats."""
    n, seq = k - 1, F.col(seq_col)
    ends = graph.kept(unitigs.where(F.length(seq) >= n).select(F.col(id_col).alias("id"), F.substr(seq, F.lit(1), F.lit(n)).alias("head"), F.substr(seq, F.length(seq) - n + 1).alias("tail")))

    def both(name: str, f: Column, r: Column) -> DataFrame:
        end = F.explode(F.map_from_arrays(F.array(F.lit("F"), F.lit("R")), F.array(f, r))).alias(f"{name}_ori", "end")
        return ends.select(F.col("id").alias(name), end)

    left = both("a", F.col("tail"), reverse_complement(F.col("head")))
    right = both("b", F.col("head"), reverse_complement(F.col("tail")))
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    each = left.select("end", one.alias("l"), zero.alias("r")).unionByName(right.select("end", zero.alias("l"), one.alias("r")))
    sizes = each.groupBy("end").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    total = sizes.agg(F.sum(F.col("l") * F.col("r") + F.col("l") + F.col("r"))).first()[0] or 0
    parts = max(1, min(total >> 22, int(unitigs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), total >> 26)
    # at most one in FIRST of the ends
    often = F.broadcast(sizes.where((F.col("l") > FIRST) | (F.col("r") > SECOND)).select("end", F.ceil(F.col("l") / FIRST).alias("n"), F.ceil(F.col("r") / SECOND).alias("m")))
    blocks = lambda rows: rows.join(often, "end", "left").withColumns({c: F.greatest(F.coalesce(c, one), one) for c in "nm"})
    own = lambda name, c: F.pmod(F.xxhash64(name, f"{name}_ori"), c)
    every = lambda c: F.explode(F.sequence(zero, F.col(c) - 1))
    rows = blocks(left).select("end", "a", "a_ori", own("a", F.col("n")).alias("i"), every("m").alias("j"))
    lists = blocks(right).groupBy("end", own("b", F.col("m")).alias("j"), "b_ori", "n").agg(F.array_sort(F.collect_list("b")).alias("b"))
    lists = lists.select("end", "j", "b_ori", "n", F.explode(F.transform(F.sequence(F.lit(1), F.size("b"), F.lit(LIST)), lambda x: F.slice("b", x, LIST))).alias("b"))
    lists = lists.select("end", every("n").alias("i"), "j", "b_ori", "b")
    on = ["end", "i", "j"]
    # by merging: for each row of the first table it goes through those of the second in one order
    met = lists.repartition(parts, *on).join(rows.repartition(parts, *on).hint("merge"), on)
    return met.select("a", "a_ori", F.explode("b").alias("b"), "b_ori").where("a <> b")


def match_runs(queries: DataFrame, targets: DataFrame, k: int, most: int | None = 1, id_col: str = "id", seq_col: str = "seq") -> DataFrame:
    """(q, t, q_begin, t_begin, length): maximal runs of k-mers, one after
    another on a diagonal, that occur in both; k-mers with more than most
    places among the targets are passed over. With most = 1 the matches are
    unique in the targets; with None all k-mers count, as in MAXMATCH."""
    left = enumerate_kmers(queries, k, seq_col, both_strands=False, keep=(id_col,), positions=True).select("kmer", F.col(id_col).alias("q"), F.col("pos").alias("q_pos"))
    right = enumerate_kmers(targets, k, seq_col, both_strands=False, keep=(id_col,), positions=True).select("kmer", F.col(id_col).alias("t"), F.col("pos").alias("t_pos"))
    if most is not None:
        rare = right.groupBy("kmer").agg(F.count("*").alias("n")).where(F.col("n") <= most).select("kmer")
        right = right.join(rare, "kmer")
    hits = left.join(right, "kmer").withColumn("diagonal", F.col("q_pos") - F.col("t_pos"))
    w = Window.partitionBy("q", "t", "diagonal").orderBy("q_pos")
    hits = hits.withColumn("island", F.col("q_pos") - F.row_number().over(w))
    return hits.groupBy("q", "t", "diagonal", "island").agg(F.min("q_pos").alias("q_begin"), F.min("t_pos").alias("t_begin"), (F.count("*") + k - 1).alias("length")).drop("diagonal", "island")


def containments(rows: DataFrame, by: list[str], lo: str, hi: str, id_col: str) -> DataFrame:
    """Rows whose interval lies within another's of their group; of equal ones the first by id stays."""
    w = Window.partitionBy(*by).orderBy(lo, F.desc(hi), id_col).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("__far", F.max(hi).over(w)).where(F.col("__far") >= F.col(hi)).drop("__far")


#: Units of a list that it meets others by: lists of so many at most are compared by that alone.
MEET = 16


def super_read_contained(names: DataFrame, units: str = "units", id_col: str = "id") -> DataFrame:
    """(id, within): super-reads whose list of unitigs is a slice of a longer
    one's, and the smallest such. Equal lists are looked at once. They meet on the
    whole list where it has MEET units at most, and on the first MEET of more; there the rest is compared."""
    lists = names.select(F.col(units).alias("short")).where(F.size(units) > 0).distinct()
    key = lambda c: F.slice(c, 1, MEET)
    n = F.size("long")
    places = names.select(F.col(id_col).alias("within"), F.col(units).alias("long"), F.explode(F.when(F.size(units) > 0, F.sequence(F.lit(1), F.size(units)))).alias("at"))
    slices = places.select("within", n.alias("n"), "long", "at", F.explode(F.sequence(F.lit(1), F.least(F.lit(MEET), n - F.col("at") + 1))).alias("k"))
    few = slices.where("k < n").groupBy(F.slice("long", F.col("at"), F.col("k")).alias("short")).agg(F.min("within").alias("within"))
    out = lists.where(F.size("short") <= MEET).join(few, "short")
    long_ = lists.where(F.size("short") > MEET).withColumn("key", key("short"))
    rest = places.where(n - F.col("at") >= MEET).withColumn("key", F.slice("long", F.col("at"), F.lit(MEET)))
    both = long_.join(rest, "key").where((F.size("short") < n) & (F.slice("long", F.col("at"), F.size("short")) == F.col("short")))
    out = out.unionByName(both.groupBy("short").agg(F.min("within").alias("within")))
    return names.select(F.col(id_col).alias("id"), F.col(units).alias("short")).join(out, "short").select("id", "within")


def projected(child: DataFrame, parent: DataFrame, names: tuple[str, str, str]) -> DataFrame:
    """Places in a grandparent: child (key, mid, bgn, end, ori) through parent
    (mid, top, bgn, end, ori), where a reversed parent turns its children. names: columns key, mid, top."""
    key, mid, top = names
    p = parent.select(mid, top, F.col("bgn").alias("p_bgn"), F.col("end").alias("p_end"), F.col("ori").alias("p_ori"))
    rows = child.join(p, mid)
    forward = F.col("p_ori") == "f"
    bgn = F.when(forward, F.col("p_bgn") + F.col("bgn")).otherwise(F.col("p_end") - F.col("end"))
    ori = F.when(F.col("ori") == F.col("p_ori"), "f").otherwise("r")
    return rows.select(key, top, bgn.alias("bgn"), (bgn + F.col("end") - F.col("bgn")).alias("end"), ori.alias("ori"))


def demoted(child: DataFrame, parent: DataFrame, names: tuple[str, str, str]) -> DataFrame:
    """The inverse: child (key, top, bgn, end) in parent (mid, top, bgn, end, ori) places that hold it whole."""
    key, mid, top = names
    p = parent.select(mid, top, F.col("bgn").alias("p_bgn"), F.col("end").alias("p_end"), F.col("ori").alias("p_ori"))
    rows = child.join(p, top).where("bgn >= p_bgn and `end` <= p_end")
    bgn = F.when(F.col("p_ori") == "f", F.col("bgn") - F.col("p_bgn")).otherwise(F.col("p_end") - F.col("end"))
    return rows.select(key, mid, bgn.alias("bgn"), (bgn + F.col("end") - F.col("bgn")).alias("end"))


def anchors(left: DataFrame, right: DataFrame, most: int) -> DataFrame:
    """(a, b, back, a_pos, b_pos): places of a minimizer of left (id, pos,
    minimizer, back) in right, where it has most places at most: that cut is
    part of the operator. back tells that the strands differ; b_pos then counts downwards."""
    rare = right.groupBy("minimizer").agg(F.count("*").alias("n")).where(F.col("n") <= most).select("minimizer")
    r = right.join(rare, "minimizer").select("minimizer", F.col("id").alias("b"), F.col("pos").alias("b_at"), F.col("back").alias("b_back"))
    few = sent(r)
    r = r if few is None else few
    l_ = left.select("minimizer", F.col("id").alias("a"), F.col("pos").alias("a_pos"), F.col("back").alias("a_back"))
    back = F.col("a_back") != F.col("b_back")
    return l_.join(r, "minimizer").select("a", "b", back.alias("back"), "a_pos", F.when(back, -F.col("b_at")).otherwise(F.col("b_at")).alias("b_pos"))


def chained(rows: DataFrame, most_gap: int, band: int, least: int) -> DataFrame:
    """(a, b, back, n, a_lo, a_hi, b_lo, b_hi): anchors of a pair of sequences and
    strand in the order of a_pos, chained while the next one lies ahead on
    both by most_gap at most and drifts from the diagonal by band at most; chains
    of least anchors or more."""
    by = ["a", "b", "back"]
    w = Window.partitionBy(*by).orderBy("a_pos", "b_pos")
    da, db = F.col("a_pos") - F.lag("a_pos").over(w), F.col("b_pos") - F.lag("b_pos").over(w)
    goes_on = F.coalesce((da > 0) & (db > 0) & (da <= most_gap) & (db <= most_gap) & (F.abs(da - db) <= band), F.lit(False))
    rows = rows.withColumn("goes_on", goes_on).withColumn("chain", F.sum(F.when(F.col("goes_on"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = rows.groupBy(*by, "chain").agg(F.count("*").alias("n"), *(f(c).alias(n) for f, c, n in ((F.min, "a_pos", "a_lo"), (F.max, "a_pos", "a_hi"), (F.min, "b_pos", "b_lo"), (F.max, "b_pos", "b_hi"))))
    return out.where(F.col("n") >= least).drop("chain")


def with_reads(pairs: DataFrame, reads: DataFrame) -> DataFrame:
    """Overlaps (a, b, diagonal) with the letters of both reads, a_seq and b_seq. reads: id, seq."""
    of = lambda c: reads.select(F.col("id").alias(c), F.coalesce("seq", F.lit("")).alias(f"{c}_seq"))
    return pairs.select("a", "b", "diagonal").join(of("a"), "a").join(of("b"), "b").select("a", "b", "diagonal", "a_seq", "b_seq")


def sharing_rare_kmers(pairs: DataFrame, reads: DataFrame, k: int, bad: DataFrame) -> DataFrame:
    """The overlaps (a, b, diagonal) with at least one k-mer that both reads have
    inside the region the overlap implies and that bad (kmer) does not name. reads: id, seq.

    Places of bad k-mers are found once a read, and a pair is looked at until
    the first good one: no row is made for a k-mer of a pair."""
    places = enumerate_kmers(reads, k, both_strands=False, keep=("id",), positions=True).join(bad.select("kmer").distinct(), "kmer", "left_semi")
    rows = with_reads(pairs, reads).join(places.groupBy(F.col("id").alias("a")).agg(F.collect_list("pos").alias("bad")), "a", "left").select("a", "b", "diagonal", "a_seq", "b_seq", "bad")

    def shares(d: int, a: str, b: str, passed: list[int] | None) -> bool:
        lo, hi = max(d, 0), min(len(a), len(b) + d)
        places = set(range(lo, hi - k + 1)).difference(passed or ())
        good = {x for i in places if not (x := a[i : i + k]).strip("ACGT")}
        return not good.isdisjoint(b[j : j + k] for j in range(lo - d, hi - d - k + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shares(*row) for row in zip(*(batch.column(c).to_pylist() for c in range(2, 6)), strict=True)]
            yield batch.select(["a", "b", "diagonal"]).filter(pa.array(found, pa.bool_()))

    shared = rows.mapInArrow(run, ", ".join(f"{c} {pairs.schema[c].dataType.simpleString()}" for c in ("a", "b", "diagonal")))
    return pairs.join(shared.distinct(), ["a", "b", "diagonal"], "left_semi")


def refined(pairs: DataFrame, reads: DataFrame, k: int, drift: int) -> DataFrame:
    """(a, b, diagonal, n): overlaps with the number of shared k-mers, of a smaller
    k than found them, within drift of their diagonal. Letters are compared
    diagonal by diagonal, so that k-mers elsewhere in the reads cost nothing."""

    def shared(d: int, a: bytes, b: bytes) -> int:
        x, y, n = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8), 0
        known = np.isin(x, np.frombuffer(b"ACGT", np.uint8))
        for s in range(d - drift, d + drift + 1):
            lo, hi = max(s, 0), min(len(x), len(y) + s)
            if hi - lo >= k:
                runs = np.append(0, np.cumsum((x[lo:hi] == y[lo - s : hi - s]) & known[lo:hi]))
                n += int(np.count_nonzero(runs[k:] - runs[:-k] == k))
        return n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = [[s.encode() for s in batch.column(c).to_pylist()] for c in (3, 4)]
            n = pa.array(list(map(shared, batch.column(2).to_pylist(), *letters)), pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(3)), n], ["a", "b", "diagonal", "n"])

    kinds = ", ".join(f"{c} {pairs.schema[c].dataType.simpleString()}" for c in ("a", "b", "diagonal"))
    return with_reads(pairs, reads).mapInArrow(run, f"{kinds}, n long").where("n > 0")
