"""Connected components of an edge table, by rounds of DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of an edge; equal roots mean one component.

    Each round joins every node to the neighbour (or itself) of least hashed
    rank and contracts the edges. Hashed ranks are in random order along any
    path, so rounds grow with the logarithm of a component's width; a star
    takes two. Neighbourhoods are reduced by a partial aggregate (min), never
    collected, so a hub with a third of all edges is no special case. Null
    ends are ignored."""
    spark = edges.sparkSession
    left = written(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "edges")
    moves = []
    for _ in range(most_rounds):
        if left.isEmpty():
            break
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
        move = both.groupBy("a").agg(F.min(rank("b")).alias("least")).select(F.col("a").alias("node"), F.least("least", rank("a"))["v"].alias("to"))
        move = written(move, "moves")
        moves.append(move)
        at = lambda c: move.select(F.col("node").alias(c), F.col("to").alias(f"{c}2"))
        left = left.join(at("a"), "a").join(at("b"), "b").select(F.col("a2").alias("a"), F.col("b2").alias("b")).where("a <> b").distinct()
        left = written(left, "edges")
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    if not moves:
        kind = left.schema["a"].dataType
        return spark.createDataFrame([], "node long, root long").select(F.col("node").cast(kind), F.col("root").cast(kind))
    out = moves[0].select("node", F.col("to").alias("root"))
    for move in moves[1:]:
        out = out.join(move.select(F.col("node").alias("root"), "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return out
