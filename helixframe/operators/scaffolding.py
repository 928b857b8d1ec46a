"""Order, strand and places of contigs, from links between them.

Contigs are signed numbers, a negative one is the contig turned round; a link
a to b with a gap says as well that -b is followed by -a. In each round weak
links are cut, links that two others replace are left out, contigs that have
one way on and are the one way back are joined, and what has been joined is a
contig of the next round, to whose ends the links are carried. Joins are by
shuffle: contigs are numbers in a row, which are few bytes in files, by which a
table is taken for one to be sent, and many where it is sent from."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import kept, unbranching_paths


def both_ways(links: DataFrame) -> DataFrame:
    """(a, b, gap, weight): links with their mirror images, parallel ones as one, with gaps weighted."""
    turned = links.select((-F.col("b")).alias("a"), (-F.col("a")).alias("b"), "gap", "weight")
    rows = links.select("a", "b", "gap", "weight").unionByName(turned).where("abs(a) <> abs(b)")
    return rows.groupBy("a", "b").agg((F.sum(F.col("gap") * F.col("weight")) / F.sum("weight")).alias("gap"), F.sum("weight").alias("weight"))


def strong(links: DataFrame, least: float, share: float) -> DataFrame:
    """Links of weight least or more and of share of the best one out of a and of the best one into b."""
    best = lambda side: F.max("weight").over(Window.partitionBy(side))
    rows = links.where(F.col("weight") >= least).withColumns({"__o": best("a"), "__i": best("b")})
    return rows.where((F.col("weight") >= share * F.col("__o")) & (F.col("weight") >= share * F.col("__i"))).drop("__o", "__i")


def direct(links: DataFrame, sizes: DataFrame, slack: float) -> DataFrame:
    """Links without those that lead past a contig that others put in between, with gaps that agree within slack."""
    one = links.select("a", F.col("b").alias("m"), F.col("gap").alias("x"))
    two = links.select(F.col("a").alias("m"), "b", F.col("gap").alias("y"))
    of = sizes.select(F.col("ctg").alias("of"), "size")
    way = one.hint("merge").join(two, "m").hint("merge").join(of, F.abs("m") == F.col("of")).hint("merge").join(links.select("a", "b", "gap"), ["a", "b"])
    way = way.where(F.abs(F.col("x") + F.col("size") + F.col("y") - F.col("gap")) <= slack).select("a", "b").distinct()
    return links.hint("merge").join(way, ["a", "b"], "left_anti")


def joined(links: DataFrame) -> DataFrame:
    """Links that are the only one out of a and the only one into b."""
    alone = lambda side: F.count("*").over(Window.partitionBy(side))
    return links.withColumns({"__o": alone("a"), "__i": alone("b")}).where("__o = 1 and __i = 1").drop("__o", "__i")


def ordered(contigs: DataFrame, links: DataFrame, least: float = 3, share: float = 0.3, slack: float = 50.0, most_rounds: int = 20) -> DataFrame:
    """(scaffold, place, ctg, ori, bgn, end) of every contig (ctg > 0, size):
    its scaffold, named by its smallest contig, which stands forward, its place
    from 0 and where it lies there (the end outside; gaps below 0 overlap).

    links: a, b (signed), gap, weight. Rounds end when nothing is joined; a
    ring of links is opened before its smallest contig. Rounds are written, so
    that a lost executor costs one of them. A contig without links is a
    scaffold of its own."""
    sizes = contigs.select(F.col("ctg").cast("long").alias("ctg"), F.col("size").cast("double").alias("size")).distinct()
    inside = kept(sizes.select("ctg", F.col("ctg").alias("scf"), F.lit(1).alias("ori"), F.lit(0.0).alias("bgn"), "size"))
    links = kept(links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"), F.col("gap").cast("double").alias("gap"), F.col("weight").cast("double").alias("weight")))
    known = sizes.select("ctg")
    links = links.hint("merge").join(known.select(F.col("ctg").alias("x")), F.abs("a") == F.col("x"), "left_semi").hint("merge").join(known.select(F.col("ctg").alias("x")), F.abs("b") == F.col("x"), "left_semi")
    for _ in range(most_rounds):
        now = inside.groupBy("scf").agg(F.max(F.col("bgn") + F.col("size")).alias("long"))
        # links within a scaffold stay there: no later round looks at them
        between = kept(_carried(links, inside, now))
        links = between.select(*(F.col(f"{c}_was").alias(c) for c in ("a", "b", "gap")), "weight")
        lifted = kept(both_ways(between))
        steps = kept(joined(direct(strong(lifted, least, share), now.select(F.col("scf").alias("ctg"), F.col("long").alias("size")), slack)))
        if steps.isEmpty():
            break
        inside = kept(_consolidated(inside, now, steps))
    by = Window.partitionBy("scf").orderBy("bgn", "ctg")
    return inside.select(F.col("scf").alias("scaffold"), (F.row_number().over(by) - 1).alias("place"), "ctg", F.when(F.col("ori") > 0, "f").otherwise("r").alias("ori"), F.round("bgn", 3).alias("bgn"), F.round(F.col("bgn") + F.col("size"), 3).alias("end"))


def _carried(links: DataFrame, inside: DataFrame, now: DataFrame) -> DataFrame:
    """Links between contigs as links between what they are in (and as they were): the gap is less by what lies between a contig and its scaffold's end."""
    at = inside.hint("merge").join(now, "scf")
    after = lambda sign: F.when(F.col("ori") * sign > 0, F.col("long") - F.col("bgn") - F.col("size")).otherwise(F.col("bgn"))
    left = at.select(F.col("ctg").alias("a_of"), F.col("scf").alias("a_scf"), F.col("ori").alias("a_ori"), after(1).alias("a_f"), after(-1).alias("a_r"))
    right = at.select(F.col("ctg").alias("b_of"), F.col("scf").alias("b_scf"), F.col("ori").alias("b_ori"), after(-1).alias("b_f"), after(1).alias("b_r"))
    rows = links.hint("merge").join(left, F.abs("a") == F.col("a_of")).hint("merge").join(right, F.abs("b") == F.col("b_of")).where("a_scf <> b_scf")
    gap = F.col("gap") - F.when(F.col("a") > 0, F.col("a_f")).otherwise(F.col("a_r")) - F.when(F.col("b") > 0, F.col("b_f")).otherwise(F.col("b_r"))
    return rows.select((F.signum("a") * F.col("a_ori") * F.col("a_scf")).cast("long").alias("a"), (F.signum("b") * F.col("b_ori") * F.col("b_scf")).cast("long").alias("b"), gap.alias("gap"), "weight", *(F.col(c).alias(f"{c}_was") for c in ("a", "b", "gap")))


def _consolidated(inside: DataFrame, now: DataFrame, steps: DataFrame) -> DataFrame:
    """inside after the joins of steps. Of a path and its mirror image the one counts in which the smallest scaffold stands forward."""
    paths = unbranching_paths(steps.select("a", "b")).select(F.col("node").alias("b"), "path", "place")
    own = F.min(F.struct(F.abs("b").alias("n"), (-F.signum("b")).alias("s"))).over(Window.partitionBy("path"))
    paths = paths.withColumn("own", own).where("own.s < 0").withColumn("k", F.row_number().over(Window.partitionBy(F.abs("b")).orderBy("path"))).where("k = 1")
    # where each begins: the lengths and gaps before it
    before = paths.select("path", (F.col("place") + 1).alias("place"), F.col("b").alias("a"))
    rows = paths.hint("merge").join(before, ["path", "place"], "left").hint("merge").join(steps.select("a", "b", "gap"), ["a", "b"], "left").hint("merge").join(now.select("scf", "long"), F.abs("b") == F.col("scf"))
    by = Window.partitionBy("path").orderBy("place")
    moved = rows.withColumn("far", F.coalesce(F.lag("long").over(by), F.lit(0.0)) + F.coalesce("gap", F.lit(0.0)))
    moved = moved.withColumn("start", F.sum("far").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    to = moved.select("scf", F.col("own.n").alias("to"), F.signum("b").cast("int").alias("turn"), "start", "long")
    out = inside.hint("merge").join(to, "scf", "left")
    bgn = F.when(F.col("turn").isNull(), F.col("bgn")).when(F.col("turn") > 0, F.col("start") + F.col("bgn")).otherwise(F.col("start") + F.col("long") - F.col("bgn") - F.col("size"))
    out = out.select("ctg", F.coalesce("to", "scf").alias("scf"), (F.col("ori") * F.coalesce("turn", F.lit(1))).alias("ori"), bgn.alias("bgn"), "size")
    least = F.min("bgn").over(Window.partitionBy("scf"))
    return out.withColumn("bgn", F.col("bgn") - least)
