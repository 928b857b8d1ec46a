"""Intervals [lo, hi) of groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merge(rows: DataFrame, by: list[str], lo: str = "lo", hi: str = "hi", least_overlap: int = 0) -> DataFrame:
    """by..., lo, hi, n: intervals that overlap by least_overlap or more (at 0 also those that touch), or contain one another, as one."""
    w = Window.partitionBy(*by).orderBy(lo, F.desc(hi))
    far = F.max(hi).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.select(*by, F.col(lo).alias("lo"), F.col(hi).alias("hi"), far.alias("far"))
    begins = F.coalesce(~((F.col("hi") <= F.col("far")) | (F.col("far") - least_overlap >= F.col("lo"))), F.lit(True))
    rows = rows.withColumn("island", F.sum(begins.cast("int")).over(Window.partitionBy(*by).orderBy("lo", F.desc("hi")).rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*by, "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count("*").alias("n")).drop("island")


def depth(rows: DataFrame, by: list[str], lo: str = "lo", hi: str = "hi") -> DataFrame:
    """by..., lo, hi, depth: the regions between changes of depth, of depth one or more. Events at one place are added up first."""
    events = rows.select(*by, F.explode(F.array(F.struct(F.col(lo).alias("at"), F.lit(1).alias("d")), F.struct(F.col(hi).alias("at"), F.lit(-1).alias("d")))).alias("e"))
    events = events.groupBy(*by, F.col("e.at").alias("lo")).agg(F.sum("e.d").alias("d"))
    w = Window.partitionBy(*by).orderBy("lo")
    out = events.withColumn("depth", F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("hi", F.lead("lo").over(w))
    return out.where("depth > 0").select(*by, "lo", "hi", "depth")


def invert(rows: DataFrame, by: list[str], lo: str = "lo", hi: str = "hi") -> DataFrame:
    """by..., lo, hi: what lies between the merged intervals."""
    w = Window.partitionBy(*by).orderBy("lo")
    return merge(rows, by, lo, hi).withColumn("next", F.lead("lo").over(w)).where("next > hi").select(*by, F.col("hi").alias("lo"), F.col("next").alias("hi"))


def overlaps(a: DataFrame, b: DataFrame, by: list[str], width: int) -> DataFrame:
    """Pairs of intervals of a (a_lo, a_hi) and b (b_lo, b_hi) of one group that
    overlap, and by how much. Both sides go into bins of the given width and
    meet there; a pair counts in the first bin that both are in."""
    bins = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / width), F.floor((F.col(hi) - 1) / width)))
    left = a.where("a_hi > a_lo").withColumn("bin", bins("a_lo", "a_hi"))
    right = b.where("b_hi > b_lo").withColumn("bin", bins("b_lo", "b_hi"))
    pairs = left.join(right, [*by, "bin"]).where("a_lo < b_hi and b_lo < a_hi")
    first = F.floor(F.greatest("a_lo", "b_lo") / width) == F.col("bin")
    return pairs.where(first).drop("bin").withColumn("overlap", F.least("a_hi", "b_hi") - F.greatest("a_lo", "b_lo"))


def depth_summary(regions: DataFrame, by: list[str]) -> DataFrame:
    """Per group of depth(): covered length, mean depth over it, largest depth, and the depth that covers most (the smallest of equals)."""
    n = F.col("hi") - F.col("lo")
    of = regions.groupBy(*by, "depth").agg(F.sum(n).alias("n"))
    return of.groupBy(*by).agg(F.sum("n").cast("long").alias("covered"), (F.sum(F.col("n") * F.col("depth")) / F.sum("n")).alias("mean"), F.max("depth").alias("most"), F.max_by("depth", F.struct("n", -F.col("depth"))).alias("mode"))


def covered_share(rows: DataFrame, whole: DataFrame, by: list[str], size: str, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """by..., covered, share of size: the length of the union of a group's intervals."""
    of = merge(rows, by, lo, hi).groupBy(*by).agg(F.sum(F.col("hi") - F.col("lo")).alias("covered"))
    return whole.join(of, by, "left").select(*by, F.coalesce("covered", F.lit(0)).cast("long").alias("covered"), (F.coalesce("covered", F.lit(0)) / F.col(size)).alias("share"))
