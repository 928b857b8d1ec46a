"""Operators over sequence records (id, seq and whatever else)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import canonical, reverse_complement
from .graph import kept


def grep_headers(records: DataFrame, pattern: str, header: str = "id", invert: bool = False) -> DataFrame:
    found = F.col(header).rlike(pattern)
    return records.where(~found if invert else found)


def grep_lines(records: DataFrame, pattern: str, id_col: str = "id", seq_col: str = "seq") -> DataFrame:
    """(id, line_no from 1, line) of the lines of seq that match; a record's header goes with its first one."""
    lines = records.select(id_col, F.posexplode(F.split(seq_col, "\n")).alias("line_no", "line"))
    return lines.where(F.col("line").rlike(pattern)).withColumn("line_no", F.col("line_no") + 1)


def extract(records: DataFrame, names: DataFrame, key: str = "id", invert: bool = False) -> DataFrame:
    """Records whose key is (or is not) among names' keys."""
    return records.join(names.select(key).distinct(), key, "left_anti" if invert else "left_semi")


def subrange(records: DataFrame, begin: int, end: int, seq_col: str = "seq") -> DataFrame:
    """seq cut to [begin, end), from 0."""
    return records.withColumn(seq_col, F.substr(F.col(seq_col), F.lit(begin + 1), F.lit(end - begin)))


def head(records: DataFrame, n: int, order: str = "id") -> DataFrame:
    """The first n records; all but the last -n if n is negative."""
    if n >= 0:
        return records.orderBy(order).limit(n)
    last = records.orderBy(F.desc(order)).limit(-n).select(order)
    return records.join(last, order, "left_anti")


def tail(records: DataFrame, n: int, order: str = "id") -> DataFrame:
    """The last n records; all but the first n if n is negative."""
    if n >= 0:
        return records.orderBy(F.desc(order)).limit(n)
    first = records.orderBy(order).limit(-n).select(order)
    return records.join(first, order, "left_anti")


def one_line(seq: Column) -> Column:
    return F.regexp_replace(seq, "\\n", "")


def wrapped(seq: Column, width: int) -> Column:
    """seq in lines of width letters."""
    return F.regexp_replace(F.regexp_replace(one_line(seq), f"(.{{{width}}})", "$1\n"), "\\n$", "")


def reversed_records(records: DataFrame, seq_col: str = "seq", only_canonical: bool = False) -> DataFrame:
    seq = F.col(seq_col)
    return records.withColumn(seq_col, canonical(seq) if only_canonical else reverse_complement(seq))


def numbered(records: DataFrame, order: list, name: str = "place") -> DataFrame:
    """records with their places from 0 along order. Places come from counts of
    range partitions, so that no task sees all rows. The dealt rows are written
    first: rows and counts have to be of the same ranges, which are drawn anew
    whenever a plan is run."""
    by = records.repartitionByRange(*order).sortWithinPartitions(*order)
    by = kept(by.withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = by.groupBy("__p").count()
    before = sizes.withColumn("__before", F.sum("count").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))).select("__p", F.coalesce("__before", F.lit(0)).alias("__before"))
    return by.join(F.broadcast(before), "__p").withColumn(name, F.col("__before") + F.col("__i")).drop("__p", "__i", "__before")  # a row for each range


def split_round_robin(records: DataFrame, n: int, order: str = "id") -> DataFrame:
    """records with `part`: 0..n-1 in turn along order."""
    return numbered(records, [order], "__place").withColumn("part", (F.col("__place") % n).cast("int")).drop("__place")


def gaps(records: DataFrame, id_col: str = "id", seq_col: str = "seq") -> DataFrame:
    """(id, begin, end), from 0 and half-open, of the runs of N."""
    runs = F.regexp_extract_all(F.col(seq_col), F.lit("(N+|[^N]+)"), 1)
    rows = records.select(id_col, F.posexplode(runs).alias("k", "run")).select(id_col, "k", F.length("run").alias("n"), F.col("run").startswith("N").alias("gap"))
    end = F.sum("n").over(Window.partitionBy(id_col).orderBy("k").rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("end", end).where("gap").select(id_col, (F.col("end") - F.col("n")).alias("begin"), "end")


def pieces_between_gaps(records: DataFrame, id_col: str = "id", seq_col: str = "seq") -> DataFrame:
    """(id, piece from 0, seq) of what stands between runs of N; nothing for runs at the ends."""
    parts = F.filter(F.split(seq_col, "N+"), lambda p: p != "")
    return records.select(id_col, F.posexplode(parts).alias("piece", "seq"))


def split_long(records: DataFrame, most: int, overlap: int, id_col: str = "id", seq_col: str = "seq") -> DataFrame:
    """(id, part, seq): sequences longer than most letters in parts that overlap."""
    step = most - overlap
    n = F.greatest(F.lit(1), F.ceil((F.length(seq_col) - overlap) / step)).cast("int")
    rows = records.select(id_col, seq_col, F.explode(F.sequence(F.lit(0), n - 1)).alias("part"))
    return rows.select(id_col, "part", F.substr(F.col(seq_col), F.col("part") * step + 1, F.lit(most)).alias("seq"))


def homopolymer_trim(records: DataFrame, least_peak: int, id_col: str = "id", seq_col: str = "seq") -> DataFrame:
    """(id, kept): what is left when the tail of one letter is cut off the 3'
    end. From the end, a letter equal to the last one scores 1, any other -1;
    the tail goes to the first place of the best running score, if that is
    least_peak or more."""
    rows = records.where(F.length(seq_col) > 0).select(id_col, F.col(seq_col).alias("kept"))

    def left(seq: str) -> str:
        letters = np.frombuffer(seq.encode("utf-32-le"), np.uint32)[::-1]
        score = np.where(letters == letters[0], 1, -1).cumsum()
        at = int(score.argmax())
        return seq[: len(seq) - at - 1] if score[at] >= least_peak else seq

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([left(s) for s in batch.column(1).to_pylist()], pa.string())], [id_col, "kept"])

    return rows.mapInArrow(run, f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, kept string")


def best_quality_segment(reads: DataFrame, cutoff: int, least: int, id_col: str = "id", qual_col: str = "qual", offset: int = 33) -> DataFrame:
    """(id, begin, end): the segment with the largest sum of quality - cutoff,
    the first of equals, of reads where it has least letters or more."""
    scores = F.transform(F.split(qual_col, ""), lambda q: F.ascii(q) - offset - cutoff)
    zero = F.struct(*(F.lit(0).alias(c) for c in ("i", "sum", "from", "best", "begin", "end")))

    def step(s: Column, x: Column) -> Column:
        begins = s["sum"] <= 0
        total = F.when(begins, x).otherwise(s["sum"] + x)
        at = F.when(begins, s["i"]).otherwise(s["from"])
        better = total > s["best"]
        return F.struct((s["i"] + 1).alias("i"), total.alias("sum"), at.alias("from"), F.when(better, total).otherwise(s["best"]).alias("best"), F.when(better, at).otherwise(s["begin"]).alias("begin"), F.when(better, s["i"] + 1).otherwise(s["end"]).alias("end"))

    rows = reads.where(F.length(qual_col) > 0).select(id_col, F.aggregate(scores, zero, step).alias("s"))
    return rows.select(id_col, F.col("s.begin").alias("begin"), F.col("s.end").alias("end")).where(F.col("end") - F.col("begin") >= least)


def analyze_quality(reads: DataFrame, seq_col: str = "seq", qual_col: str = "qual") -> DataFrame:
    """One row: reads, bases, smallest and largest quality letter, and the offset (33 or 64) that they tell."""
    letters = F.transform(F.split(qual_col, ""), F.ascii)
    some = F.length(qual_col) > 0
    out = reads.agg(F.count("*").alias("n_reads"), F.sum(F.length(seq_col)).alias("n_bases"), F.min(F.when(some, F.array_min(letters))).alias("least"), F.max(F.when(some, F.array_max(letters))).alias("most"))
    return out.withColumn("offset", F.when(F.col("least") < 59, 33).otherwise(64))


def rename_pairs(reads: DataFrame, pair: str = "pair", mate: str = "mate", seq_col: str = "seq", prefix: str = "pe", most: int = 250) -> DataFrame:
    """(id, seq): both mates of every pair, renamed, cut to most letters; a mate that is missing becomes one N."""
    pairs = reads.select(F.col(pair).alias("pair")).distinct().select("pair", F.explode(F.array(F.lit(0), F.lit(1))).alias("mate"))
    own = reads.select(F.col(pair).alias("pair"), F.col(mate).alias("mate"), F.col(seq_col).alias("s"))
    return pairs.join(own, ["pair", "mate"], "left").select(F.concat(F.lit(prefix), (F.col("pair") * 2 + F.col("mate")).cast("string")).alias("id"), F.coalesce(F.substr("s", F.lit(1), F.lit(most)), F.lit("N")).alias("seq"))


def lengths(records: DataFrame, id_col: str = "id", seq_col: str = "seq") -> DataFrame:
    return records.select(id_col, F.length(seq_col).cast("long").alias("size"))


def size_at(sizes: DataFrame, percents: list[int], size_col: str = "size", strict: bool = False, total: int | None = None, whole: bool = True) -> DataFrame:
    """(percent, n_size): the size of the first record, from the largest down,
    at which the running sum reaches ceil(percent of the total), or with
    strict exceeds that share rounded down; null if it never does.

    The running sum goes over sizes grouped by value, of which there are far
    fewer than records; their window is not partitioned."""
    grouped = sizes.groupBy(F.col(size_col).alias("s")).agg((F.col("s") * F.count("*")).alias("t"))
    run = grouped.withColumn("c", F.sum("t").over(Window.orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)))
    wanted = sizes.sparkSession.createDataFrame([(p,) for p in percents], "percent int")
    sums = sizes.agg(F.coalesce(F.sum(size_col), F.lit(0)).alias("total")) if total is None else sizes.sparkSession.createDataFrame([(total,)], "total long")
    goal = F.floor(F.col("percent") * F.col("total") / 100) if strict else F.ceil(F.col("percent") * F.col("total") / 100)
    goals = wanted.crossJoin(F.broadcast(sums)).select("percent", goal.alias("goal"))
    reached = F.col("c") > F.col("goal") if strict else F.col("c") >= F.col("goal")
    return run.crossJoin(F.broadcast(goals)).groupBy("percent").agg(F.max(F.when(reached, F.col("s"))).cast("long").alias("n_size"))


def size_stats(sizes: DataFrame, by: list[str], size_col: str = "size") -> DataFrame:
    """Per group: records, sum, mean, smallest and largest size, and the E-size, the mean weighted by size."""
    s = F.col(size_col)
    return sizes.groupBy(*by).agg(F.count("*").alias("n"), F.sum(s).cast("long").alias("total"), F.avg(s).alias("mean"), F.min(s).alias("least"), F.max(s).alias("most"), (F.sum(s * s) / F.sum(s)).alias("e_size"))
