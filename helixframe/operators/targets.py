"""Targets: stretches of a contig that a two-state hidden Markov model takes as
covered, with their consensus."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The price of entering a target, the scores in it of a place without bases, with an undecided one and with a call; the least quality of a base, and bounds of what counts of it.
ENTER, EMPTY, UNSURE, CALLED = 14000, -4, 1, 6
LEAST, LOW, HIGH = 13, 4, 63


def sites(columns: DataFrame) -> DataFrame:
    """(id, pos, base, qual): the base with the largest sum of qualities, of
    equals the first letter, and by how much it leads, 63 at most. columns: id, pos from 0, base, q. Errors are taken as
    independent; bases other than A, C, G, T, those of a quality below 13 and rows with nulls are passed over."""
    rows = columns.where(F.col("base").isin(*"ACGT") & (F.col("q") >= LEAST) & F.col("id").isNotNull() & (F.col("pos") >= 0))
    of = rows.groupBy("id", F.col("pos").cast("long").alias("pos"), "base").agg(F.sum(F.least(F.greatest("q", F.lit(LOW)), F.lit(HIGH))).cast("long").alias("w"))
    order = F.reverse(F.array_sort(F.collect_list(F.struct("w", (-F.ascii("base")).alias("c")))))
    best = of.groupBy("id", "pos").agg(order.alias("x"))
    lead = F.get("x", F.lit(0))["w"] - F.coalesce(F.get("x", F.lit(1))["w"], F.lit(0))
    return best.select("id", "pos", F.char(-F.get("x", F.lit(0))["c"]).alias("base"), F.least(lead, F.lit(HIGH)).cast("int").alias("qual"))


def best_path(runs: list[tuple[int, int, int]], enter: int, empty: int) -> list[tuple[int, int]]:
    """The targets (begin, end) of covered runs (begin, end, score) in order, by the best path; of equal paths the one that is longer in a target.

    As covered places score above and empty ones below zero, a path enters at a
    run's begin (or is in a target from the contig's begin on) and leaves at a run's end."""
    out_score, in_score, at = 0, 0, 0
    entered, taken = [], []
    for lo, hi, score in runs:
        stays = in_score + empty * (lo - at)
        entered.append(out_score - enter > stays)
        in_score = max(out_score - enter, stays) + score
        taken.append(in_score >= out_score)
        out_score, at = max(out_score, in_score), hi
    found, k = [], len(runs) - 1
    while k >= 0:
        if not taken[k]:
            k -= 1
            continue
        end = runs[k][1]
        while k >= 0 and not entered[k]:
            k -= 1
        found.append((runs[k][0] if k >= 0 else 0, end))
        k -= 1
    return found[::-1]


def targets(rows: DataFrame, enter: int = ENTER, empty: int = EMPTY, unsure: int = UNSURE, called: int = CALLED) -> DataFrame:
    """(id, lo, hi) of targets in sites (id, pos, base, qual); hi is outside.

    A site of the base A without a lead is unsure, all others are called. A
    contig's first place is in no target. Covered places are first drawn together to runs,
    and contigs cut at gaps that cost more than entering again, so that a task
    holds the runs between two such gaps."""
    if enter < 0 or empty >= 0 or unsure <= 0 or called <= 0:
        raise ValueError("covered places score above zero, empty ones below, and entering has a price")
    w = Window.partitionBy("id").orderBy("pos")
    score = F.when((F.col("qual") == 0) & (F.col("base") == "A"), unsure).otherwise(called).cast("long")
    runs = rows.select("id", "pos", score.alias("s"), (F.col("pos") - F.row_number().over(w)).alias("run"))
    runs = runs.groupBy("id", "run").agg(F.min("pos").alias("lo"), (F.max("pos") + 1).alias("hi"), F.sum("s").alias("score"))
    w = Window.partitionBy("id").orderBy("lo")
    far = (F.col("lo") - F.lag("hi").over(w)) * -empty > enter
    runs = runs.withColumn("island", F.sum(F.when(far, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("lo")
        found = best_path(list(zip(*(group[c].to_pylist() for c in ("lo", "hi", "score")), strict=True)), enter, empty)
        found = [(max(lo, 1), hi) for lo, hi in found if hi > 1]
        return pa.table([pa.array([group["id"][0].as_py()] * len(found), group["id"].type), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], ["id", "lo", "hi"])

    return runs.groupBy("id", "island").applyInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, lo long, hi long")


def with_consensus(found: DataFrame, rows: DataFrame) -> DataFrame:
    """Targets with seq (N where nothing is) and quality (as in FASTQ, offset 33)."""
    begins = found.select("id", F.col("lo").alias("pos"), F.struct("lo", "hi").alias("target"), F.lit(None).cast("string").alias("base"), F.lit(None).cast("int").alias("qual"))
    every = begins.unionByName(rows.select("id", "pos", F.lit(None).cast("struct<lo:bigint,hi:bigint>").alias("target"), "base", "qual"))
    w = Window.partitionBy("id").orderBy("pos", F.col("base").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    inside = every.withColumn("target", F.last("target", True).over(w)).where("base IS NOT NULL AND pos < target.hi")
    of = inside.groupBy("id", "target").agg(F.array_sort(F.collect_list(F.struct("pos", "base", "qual"))).alias("x"))

    def line(nothing: str, letter):
        before = lambda i: F.when(i > 0, F.get("x", i - 1)["pos"]).otherwise(F.col("target.lo") - 1)
        return F.array_join(F.transform("x", lambda c, i: F.concat(F.repeat(F.lit(nothing), (c["pos"] - before(i) - 1).cast("int")), letter(c))), "")

    undecided = lambda c: (c["qual"] == 0) & (c["base"] == "A")
    return of.select("id", "target.lo", "target.hi", line("N", lambda c: F.when(undecided(c), "N").otherwise(c["base"])).alias("seq"), line("!", lambda c: F.char(33 + c["qual"])).alias("quality"))
