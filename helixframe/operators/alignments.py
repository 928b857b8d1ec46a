"""Alignment tables in the manner of SAM rows: flag, tid, pos, mapq, mates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import natural_key, x31
from . import interval

PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED, REVERSE, MATE_REVERSE, FIRST, SECOND, SECONDARY, FAILED, DUPLICATE = (1 << i for i in range(11))


def has(flag: Column, bit: int) -> Column:
    return flag.bitwiseAND(F.lit(bit)) != 0


def view(rows: DataFrame, need: int = 0, forbid: int = 0, least_mapq: int = 0, least_length: int = 0, sample: float | None = None, seed: int = 0, name: str = "qname") -> DataFrame:
    """Rows with all bits of need, none of forbid, and the qualities asked for;
    sample keeps whole templates by a hash of their names."""
    flag = F.col("flag")
    out = rows.where((flag.bitwiseAND(F.lit(need)) == need) & (flag.bitwiseAND(F.lit(forbid)) == 0) & (F.col("mapq") >= least_mapq) & (F.col("l_seq") >= least_length))
    if sample is not None:
        out = out.where((x31(F.col(name)) + seed).bitwiseAND(F.lit((1 << 24) - 1)) / float(1 << 24) < sample)
    return out


def flagstat(rows: DataFrame) -> DataFrame:
    """A row for passed and one for failed reads, with the counts by flag."""
    f = F.col("flag")
    paired = has(f, PAIRED)
    mapped = ~has(f, UNMAPPED)
    both = paired & mapped & ~has(f, MATE_UNMAPPED)
    far = both & (F.col("mtid") != F.col("tid"))
    counts = {
        "total": F.lit(True), "duplicates": has(f, DUPLICATE), "mapped": mapped, "paired": paired, "read1": paired & has(f, FIRST), "read2": paired & has(f, SECOND),
        "proper": paired & has(f, PROPER) & mapped, "both_mapped": both, "singletons": paired & has(f, MATE_UNMAPPED) & mapped, "other_tid": far, "other_tid_high": far & (F.col("mapq") >= 5),
    }
    return rows.groupBy(has(f, FAILED).alias("failed")).agg(*(F.count_if(c).alias(n) for n, c in counts.items()))


def idxstats(rows: DataFrame) -> DataFrame:
    """tid, mapped and unmapped rows."""
    unmapped = has(F.col("flag"), UNMAPPED)
    return rows.groupBy("tid").agg(F.count_if(~unmapped).alias("n_mapped"), F.count_if(unmapped).alias("n_unmapped"))


def depth(rows: DataFrame, least_mapq: int = 0) -> DataFrame:
    """(tid, pos, depth) of every covered position of [pos, pos + l_seq)."""
    some = rows.where(F.col("mapq") >= least_mapq).where("l_seq > 0").select("tid", F.col("pos").alias("lo"), (F.col("pos") + F.col("l_seq")).alias("hi"))
    # begins and ends are shuffled, not bases
    return interval.depth(some, ["tid"]).select("tid", F.explode(F.sequence("lo", F.col("hi") - 1)).alias("pos"), "depth")


def remove_duplicates(rows: DataFrame, by: list[str], score: str, order: str) -> DataFrame:
    """Of rows that share by, the one of the highest score, the first of equals."""
    w = Window.partitionBy(*by).orderBy(F.desc(score), order)
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def fix_mates(rows: DataFrame, name: str = "qname", order: tuple[str, ...] = ("ordinal",)) -> DataFrame:
    """The first two rows of each name, each with the other's place: mtid, mpos."""
    w = Window.partitionBy(name).orderBy(*order)
    rows = rows.withColumn("__n", F.row_number().over(w)).withColumn("__after_tid", F.lead("tid").over(w)).withColumn("__after_pos", F.lead("pos").over(w)).withColumn("__before_tid", F.lag("tid").over(w)).withColumn("__before_pos", F.lag("pos").over(w))
    first = F.col("__n") == 1
    out = rows.where("__n <= 2").withColumn("mtid", F.when(first, F.col("__after_tid")).otherwise(F.col("__before_tid"))).withColumn("mpos", F.when(first, F.col("__after_pos")).otherwise(F.col("__before_pos")))
    return out.drop("__n", "__after_tid", "__after_pos", "__before_tid", "__before_pos")


def sort_by_name(rows: DataFrame, name: str = "qname") -> DataFrame:
    """Digit runs of names go as numbers."""
    return rows.orderBy(natural_key(F.col(name)), name)
