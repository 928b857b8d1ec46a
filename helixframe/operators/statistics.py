"""Statistics of assemblies: arrival rates, uniqueness, coverage, consensus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def arrival(layout: DataFrame, tig: str = "tig") -> DataFrame:
    """Per unitig of layout (tig, frag, bgn, end; bgn > end if reversed): reads
    and rho, the mean of the spans of read begins and of read ends."""
    lo, hi = F.least("bgn", "end"), F.greatest("bgn", "end")
    return layout.groupBy(tig).agg(F.count("*").alias("n"), ((F.max(lo) - F.min(lo) + F.max(hi) - F.min(hi)) / 2).alias("rho"))


def global_arrival_rate(rho: DataFrame) -> DataFrame:
    """One row: reads after the first of each unitig over all rho."""
    return rho.agg((F.sum(F.col("n") - 1) / F.sum("rho")).alias("gar"))


def coverage_statistic(layout: DataFrame, tig: str = "tig") -> DataFrame:
    """Per unitig n, rho and the log odds of being unique against doubled: rho * GAR - ln 2 * (n - 1)."""
    rho = arrival(layout, tig)
    return rho.crossJoin(F.broadcast(global_arrival_rate(rho))).select(tig, "n", "rho", (F.col("rho") * F.col("gar") - F.log(F.lit(2.0)) * (F.col("n") - 1)).alias("a_stat"))


def rate_by_big_spans(rho: DataFrame, span: int) -> DataFrame:
    """One row: the arrival rate from unitigs with rho of span or more, or from all if there are none."""
    big = F.col("rho") >= span
    some = F.sum(F.when(big, F.col("rho")))
    return rho.agg(F.coalesce(F.sum(F.when(big, F.col("n") - 1)) / some, F.sum(F.col("n") - 1) / F.sum("rho")).alias("gar"))


def mark_unique(tigs: DataFrame, least_reads: int, most_span: float, long: int, a_low: float, low_coverage: float, short: int) -> DataFrame:
    """Why a unitig is unique or a repeat; the first rule that holds decides.
    tigs: n, span (share of the length that one read covers), length, a_stat, low (share of low coverage)."""
    rules = [
        (F.col("n") == 1, "single read"), (F.col("n") < least_reads, "few reads"), (F.col("span") > most_span, "one read spans"), (F.col("length") >= long, "unique: long"),
        (F.col("a_stat") < a_low, "low statistic"), (F.col("low") > low_coverage, "low coverage"), (F.col("length") < short, "short"),
    ]
    out: Column = F.lit("unique")
    for rule, name in reversed(rules):
        out = F.when(rule, name).otherwise(out)
    return tigs.withColumn("why", out).withColumn("is_unique", F.col("why").startswith("unique"))


def gc_bias(windows: DataFrame, buckets: int) -> DataFrame:
    """Mean and deviation of coverage by share of G and C. windows: gc, coverage."""
    bucket = F.least(F.floor(F.col("gc") * buckets), F.lit(buckets - 1)).cast("int")
    return windows.where("gc is not null").groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"), F.avg("coverage").alias("mean"), F.stddev_pop("coverage").alias("sd"))


def linear_fit(rows: DataFrame, by: str, x: str, y: str) -> DataFrame:
    """Per group the least-squares line and the mean absolute error."""
    line = rows.groupBy(by).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.count("*").alias("n"))
    rows = rows.select(by, F.col(x).alias("x"), F.col(y).alias("y")).join(line, by)
    return rows.groupBy(by).agg(F.first("slope").alias("slope"), F.first("intercept").alias("intercept"), F.avg(F.abs(F.col("y") - F.col("slope") * F.col("x") - F.col("intercept"))).alias("error"), F.count("*").alias("n"))


def insert_size(pairs: DataFrame, by: str, size: str, trim: float = 3.0) -> DataFrame:
    """Per library mean and deviation of the sizes within trim deviations of the first mean."""
    first = pairs.groupBy(by).agg(F.avg(size).alias("m"), F.stddev_pop(size).alias("s"))
    near = pairs.join(first, by).where(F.abs(F.col(size) - F.col("m")) <= trim * F.col("s"))
    return near.groupBy(by).agg(F.count("*").alias("n"), F.avg(size).alias("mean"), F.stddev_pop(size).alias("sd"))


def window_coverage(rows: DataFrame, width: int, by: str = "edge", lo: str = "lo", hi: str = "hi") -> DataFrame:
    """(by, window, n): how many alignments cover each window of width whole."""
    first, end = F.ceil(F.col(lo) / width), F.floor(F.col(hi) / width)
    return rows.where(end > first).select(by, F.explode(F.sequence(first, end - 1)).alias("window")).groupBy(by, "window").agg(F.count("*").alias("n"))


def consensus(columns: DataFrame, by: list[str]) -> DataFrame:
    """Per column (by) of bases the most frequent one (the smallest of equals), its count and the depth."""
    of = columns.groupBy(*by, "base").agg(F.count("*").alias("c"))
    best = F.max(F.struct("c", (-F.ascii("base")).alias("b"), "base")).alias("x")
    return of.groupBy(*by).agg(best, F.sum("c").alias("depth")).select(*by, F.col("x.base").alias("base"), F.col("x.c").alias("n"), "depth")


def divergent_positions(columns: DataFrame, by: list[str], least_share: float) -> DataFrame:
    """Columns in which bases other than the most frequent one make least_share or more."""
    c = consensus(columns, by)
    return c.where(1 - F.col("n") / F.col("depth") >= least_share)


def running_coverage(events: DataFrame, by: str, order: list[str], read: str) -> DataFrame:
    """Coverage after each event: a read's odd occurrences open it, its even ones close it."""
    parity = F.row_number().over(Window.partitionBy(by, read).orderBy(*order)) % 2
    rows = events.withColumn("__d", F.when(parity == 1, 1).otherwise(-1))
    return rows.withColumn("coverage", F.sum("__d").over(Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))).drop("__d")


def multiplicity(edges: DataFrame) -> DataFrame:
    """(edge, coverage, multiplicity): the rounded ratio of an edge's coverage to the mean over length, which is cut to a whole number."""
    mean = edges.agg(F.floor(F.sum(F.col("coverage") * F.col("length")) / F.sum("length")).alias("mean"))
    return edges.crossJoin(F.broadcast(mean)).select("edge", "coverage", F.round(F.col("coverage") / F.greatest(F.col("mean"), F.lit(1))).cast("long").alias("multiplicity"))


def placement_counts(placements: DataFrame, target: str, order: str, pair: str, mate: str) -> DataFrame:
    """Reads of each target: one for every row, but for a second mate directly after its first mate in the same target."""
    w = Window.orderBy(order).partitionBy(pair)
    again = (F.lag(target).over(w) == F.col(target)) & (F.lag(order).over(w) == F.col(order) - 1) & (F.col(mate) == 1) & (F.lag(mate).over(w) == 0)
    rows = placements.withColumn("__again", F.coalesce(again, F.lit(False)))
    return rows.groupBy(target).agg(F.count_if(~F.col("__again")).alias("n"))


def linking_mates(placements: DataFrame, pair: str, mate: str, target: str) -> DataFrame:
    """Pairs whose mates are in different targets."""
    side = lambda m: placements.where(F.col(mate) == m).select(pair, F.col(target).alias(f"target{m}"))
    return side(0).join(side(1), pair).where("target0 <> target1")
