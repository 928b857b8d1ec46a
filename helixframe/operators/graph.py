"""Graphs as edge tables. Iterations run as DataFrame jobs; each round's table
goes to the folder of spark.checkpoint.dir, so that lineage stays short and a
lost executor costs one round."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _folder(spark: SparkSession) -> str:
    sc = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if sc.master.startswith("local-cluster") or not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="graph-"))
    return sc.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str = "graph") -> str:
    """A path of its own in the shared folder."""
    return f"{_folder(spark)}/{name}-{uuid.uuid4().hex}"


#: Of the session: files of a query's shuffles are removed when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def kept(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder. What was shuffled for it is removed."""
    spark = df.sparkSession
    path = new_path(spark)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that is reachable. In each round
    every node takes the least label around it, and labels jump to their own
    labels, so that rounds grow with the logarithm of a component's width. A
    node's neighbours are reduced by partial aggregates."""
    both = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct()
    both = kept(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = kept(both.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")))
    while True:
        around = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        hooked = labels.join(around, "node").withColumn("least", F.least("label", "near"))
        # the old label's node learns of the least one, too
        up = hooked.groupBy(F.col("label").alias("node")).agg(F.min("least").alias("up"))
        step = kept(hooked.join(up, "node", "left").select("node", F.least("least", F.coalesce("up", "least")).alias("new"), "label"))
        jump = step.select(F.col("node").alias("new"), F.col("new").alias("newer"))
        after = kept(step.join(jump, "new").select("node", F.least("new", "newer").alias("label"), (F.least("new", "newer") < F.col("label")).alias("moved")))
        if after.where("moved").isEmpty():
            return after.select("node", F.col("label").alias("component"))
        labels = after.select("node", "label")


def unbranching_paths(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, path, place): maximal paths whose inner edges are the only way
    out of one node and the only way into the next; path is the first node,
    place counts from 0. Nodes of cycles without an entry form a path from
    their smallest node. By pointer doubling: rounds are the logarithm of the
    longest path, and nodes take part in them while their path goes on further back.
    Joins are by shuffle: tables of numbers in a row are small in files, and large where they are sent from."""
    e = kept(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).distinct())
    one_out = e.groupBy("a").agg(F.count("*").alias("n"), F.first("b").alias("b")).where("n = 1").select("a", "b")
    one_in = e.groupBy("b").agg(F.count("*").alias("n")).where("n = 1").select("b")
    inner = kept(one_out.where("a <> b").hint("merge").join(one_in, "b", "left_semi").select("a", "b"))
    nodes = e.select(F.col("a").alias("node")).unionByName(e.select(F.col("b").alias("node"))).distinct()
    # a node without an inner edge into it is the first of its path
    firsts = nodes.hint("merge").join(inner.select(F.col("b").alias("node")), "node", "left_anti")
    linear = firsts.select("node", F.col("node").alias("path"), F.lit(0).cast("long").alias("place"))
    # (node, to, steps, least): to is 2^r inner edges back; least is the smallest node from node to before to
    at = inner.select(F.col("b").alias("node"), F.col("a").alias("to"), F.lit(1).cast("long").alias("steps"), F.least("a", "b").alias("least"))
    settled = None  # (node, path, place), of paths that have nodes that are not
    total = max(1, inner.count())
    for r in range(total.bit_length() + 1):
        far = at.select(F.col("node").alias("to"), F.col("to").alias("to2"), F.col("steps").alias("steps2"), F.col("least").alias("least2"), F.lit(None).cast("long").alias("place2"))
        if settled is not None:
            far = far.unionByName(settled.select(F.col("node").alias("to"), F.col("path").alias("to2"), F.lit(None).cast("long").alias("steps2"), F.col("path").alias("least2"), F.col("place").alias("place2")))
        # what is not found is the first of a path
        all_ = kept(at.hint("merge").join(far, "to", "left").select("node", F.coalesce("to2", "to").alias("to"), (F.col("steps") + F.coalesce("steps2", "place2", F.lit(0))).alias("steps"), F.least("least", "least2").alias("least"), F.col("steps2").isNotNull().alias("open")))
        done = all_.where("not open").select("node", F.col("to").alias("path"), F.col("steps").alias("place"))
        linear = linear.unionByName(done)
        at = all_.where("open").drop("open")
        if done.isEmpty() or at.isEmpty():  # a round that comes to no path's first node leaves cycles alone
            break
        # paths that go on have a node 2^(r+1) - 1 edges from their first
        going = done.where(F.col("place") == (2 << r) - 1).select("path")
        settled = (done if settled is None else settled.unionByName(done)).hint("merge").join(going, "path", "left_semi")
        settled = kept(settled.select("node", "path", "place"))
    if at.isEmpty():
        return linear
    # a cycle: as many rounds as go round it find its smallest node; it is cut before that and counted anew from there
    for _ in range(total.bit_length() + 1):
        far = at.select(F.col("node").alias("to"), F.col("to").alias("to2"), F.col("least").alias("least2"))
        after = kept(at.hint("merge").join(far, "to").select("node", F.col("to2").alias("to"), F.least("least", "least2").alias("least"), (F.col("least2") < F.col("least")).alias("moved")))
        at = after.drop("moved")
        if after.where("moved").isEmpty():
            break
    round_ = at.select("node", F.col("least").alias("path"))
    opened = inner.hint("merge").join(round_.select(F.col("node").alias("a")), "a", "left_semi").hint("merge").join(round_.where("node = path").select(F.col("node").alias("b")), "b", "left_anti")
    singles = opened.unionByName(round_.where("node = path").select(F.col("node").alias("a"), F.col("node").alias("b")).where("a <> b"))
    return linear.unionByName(unbranching_paths(singles))


def transitive_reduction(edges: DataFrame, slack: float, a: str = "a", b: str = "b", length: str = "length") -> DataFrame:
    """Edges without those that two others replace: a-c goes if there are a-b and b-c with lengths that add up to its own within slack."""
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b"), F.col(length).alias("length"))
    one = e.select("a", F.col("b").alias("m"), F.col("length").alias("x"))
    two = e.select(F.col("a").alias("m"), "b", F.col("length").alias("y"))
    way = one.join(two, "m").join(e, ["a", "b"]).where(F.abs(F.col("x") + F.col("y") - F.col("length")) <= slack).select("a", "b").distinct()
    return e.join(way, ["a", "b"], "left_anti")


def degrees(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, n_in, n_out)."""
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).distinct()
    ends = e.select(F.col("a").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("o")).unionByName(e.select(F.col("b").alias("node"), F.lit(1).alias("i"), F.lit(0).alias("o")))
    return ends.groupBy("node").agg(F.sum("i").alias("n_in"), F.sum("o").alias("n_out"))


def classify_nodes(edges: DataFrame) -> DataFrame:
    """(node, kind): tip (one side has no edge), linear (one each), else junction."""
    return degrees(edges).select("node", F.when((F.col("n_in") == 0) | (F.col("n_out") == 0), "tip").when((F.col("n_in") == 1) & (F.col("n_out") == 1), "linear").otherwise("junction").alias("kind"))


def clip_tips(edges: DataFrame, coverage: str = "coverage") -> DataFrame:
    """Edges without tips: an edge from or to a dead end goes if its other end
    has a better covered edge in the same direction."""
    d = degrees(edges)
    n_in = d.select(F.col("node").alias("a"), "n_in")
    n_out = d.select(F.col("node").alias("b"), "n_out")
    best_in = F.max(coverage).over(Window.partitionBy("b"))
    best_out = F.max(coverage).over(Window.partitionBy("a"))
    rows = edges.withColumn("__in", best_in).withColumn("__out", best_out).join(n_in, "a").join(n_out, "b")
    tip = ((F.col("n_in") == 0) & (F.col(coverage) < F.col("__in"))) | ((F.col("n_out") == 0) & (F.col(coverage) < F.col("__out")))
    return rows.where(~tip).select(*edges.columns)


def weak_edges_removed(edges: DataFrame, least: int, share: float, coverage: str = "coverage") -> DataFrame:
    """Edges covered least times or more and by share or more of the best edge out of their node."""
    best = F.max(coverage).over(Window.partitionBy("a"))
    return edges.withColumn("__best", best).where((F.col(coverage) >= least) & (F.col(coverage) >= share * F.col("__best"))).drop("__best")


def bubbles(edges: DataFrame, coverage: str = "coverage") -> DataFrame:
    """(a, b, kept, removed): two ways of two edges from a to b over different
    nodes that have no other edges; the better covered one is kept (of equals the smaller node)."""
    d = degrees(edges).where("n_in = 1 and n_out = 1").select(F.col("node").alias("m"))
    one = edges.select("a", F.col("b").alias("m"), F.col(coverage).alias("x")).join(d, "m", "left_semi")
    two = edges.select(F.col("a").alias("m"), "b", F.col(coverage).alias("y"))
    ways = one.join(two, "m").withColumn("c", F.least("x", "y"))
    w = Window.partitionBy("a", "b").orderBy(F.desc("c"), "m")
    ranked = ways.withColumn("rank", F.row_number().over(w)).withColumn("kept", F.first("m").over(w))
    return ranked.where("rank > 1").select("a", "b", "kept", F.col("m").alias("removed"))


def bundled_links(links: DataFrame) -> DataFrame:
    """(a, b, n, gap, sd): links between two contigs as one, weighted by their inverse variances."""
    weight = 1 / (F.col("sd") * F.col("sd"))
    return links.groupBy("a", "b").agg(F.count("*").alias("n"), (F.sum(F.col("gap") * weight) / F.sum(weight)).alias("gap"), F.sqrt(1 / F.sum(weight)).alias("sd"))


def parallel_edges_removed(edges: DataFrame, coverage: str = "coverage", name: str = "id") -> DataFrame:
    """Of edges between the same two nodes the best covered, of equals that of the smallest name."""
    w = Window.partitionBy("a", "b").orderBy(F.desc(coverage), name)
    return edges.withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k")


def path_edges(paths: DataFrame, weights: DataFrame) -> DataFrame:
    """(path, a, b, n, weight): the paths of unbranching_paths() as edges between
    their first and last nodes, with their inner edges' number and weights (a, b, weight) added up."""
    ends = paths.groupBy("path").agg(F.min_by("node", "place").alias("a"), F.max_by("node", "place").alias("b"), (F.count("*") - 1).alias("n"))
    at = lambda c, p: paths.select("path", F.col("node").alias(c), F.col("place").alias(p))
    inner = at("a", "x").join(weights, "a").join(at("b", "y"), ["path", "b"]).where("y = x + 1").groupBy("path").agg(F.sum("weight").alias("weight"))
    return ends.where("n > 0").join(inner, "path").select("path", "a", "b", "n", "weight")


def connections(walks: DataFrame) -> DataFrame:
    """(a, m, b, n): how many walks (walk, place, node) go from a over m to b."""
    w = Window.partitionBy("walk").orderBy("place")
    rows = walks.select(F.lag("node").over(w).alias("a"), F.col("node").alias("m"), F.lead("node").over(w).alias("b"))
    return rows.where("a is not null and b is not null").groupBy("a", "m", "b").agg(F.count("*").alias("n"))


def resolved_repeats(found: DataFrame, least: int) -> DataFrame:
    """Of connections() those with least walks or more that are the most walked
    from their way in and into their way out, and no other as much: the pairs that a repeat node is split by."""
    ways = lambda side: Window.partitionBy("m", side)
    best = lambda side: (F.max("n").over(ways(side)) == F.col("n")) & (F.count("*").over(Window.partitionBy("m", side, "n")) == 1)
    return found.withColumn("__a", best("a")).withColumn("__b", best("b")).where((F.col("n") >= least) & F.col("__a") & F.col("__b")).drop("__a", "__b")


def longest_paths(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, weight, first): for each node of a graph without cycles the largest
    sum of node weights on a path that ends there, and where that path begins
    (the smallest of equals). nodes: node, weight. Rounds are the edges of the
    longest path. Joins are by shuffle, so that no round's table goes through the driver."""
    own = kept(nodes.select("node", F.col("weight").cast("double").alias("own")))
    best = own.select("node", F.col("own").alias("weight"), F.col("node").alias("first"))
    # an edge brings the weight of its end, and a round one join less
    step = kept(edges.select(F.col("a").alias("node"), F.col("b").alias("to")).distinct().hint("merge").join(own.withColumnRenamed("node", "to"), "to"))
    while True:
        come = best.hint("merge").join(step, "node").select(F.col("to").alias("node"), F.struct((F.col("weight") + F.col("own")).alias("weight"), (-F.col("first")).alias("first")).alias("x"))
        most = come.groupBy("node").agg(F.max("x").alias("x"))
        both = best.hint("merge").join(most, "node", "left")
        better = F.col("x").isNotNull() & ((F.col("x.weight") > F.col("weight")) | ((F.col("x.weight") == F.col("weight")) & (-F.col("x.first") < F.col("first"))))
        after = kept(both.select("node", F.when(better, F.col("x.weight")).otherwise(F.col("weight")).alias("weight"), F.when(better, -F.col("x.first")).otherwise(F.col("first")).alias("first"), F.coalesce(better, F.lit(False)).alias("moved")))
        best = after.drop("moved")
        if after.where("moved").isEmpty():
            return best


def kept_in_order(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, kept): in the order of nodes, one is kept unless a kept smaller one
    has an edge with it. Each round settles the nodes that have a kept smaller
    neighbour, or only settled ones; rounds grow with the longest chain of such decisions."""
    pairs = kept(edges.select(F.least("a", "b").alias("small"), F.greatest("a", "b").alias("node")).where("small <> node").distinct())
    state = kept(nodes.select("node").distinct().withColumn("kept", F.lit(None).cast("boolean")))
    while not state.where("kept is null").isEmpty():
        near = pairs.join(state.select(F.col("node").alias("small"), F.col("kept").alias("near")), "small")
        found = near.groupBy("node").agg(F.bool_or(F.coalesce("near", F.lit(False))).alias("hit"), F.count_if(F.col("near").isNull()).alias("waiting"))
        told = F.when(F.coalesce("hit", F.lit(False)), False).when(F.coalesce("waiting", F.lit(0)) == 0, True)
        state = kept(state.join(found, "node", "left").select("node", F.coalesce("kept", told).alias("kept")))
    return state
