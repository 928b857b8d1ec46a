"""Graphs and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import graph, statistics
from .record_queries import DAY, DOCS, SHIP, ships
from .kmer_queries import seqs
from .registry import query, table

EDGES = "(SELECT o_custkey % 700 AS a, (o_custkey * 7 + o_orderkey) % 900 AS b, count(*) AS coverage, CAST(sum(o_orderkey % 50) AS BIGINT) AS length FROM orders GROUP BY 1, 2 HAVING count(*) > 0)"


def edges(spark, sf_dir) -> DataFrame:
    a, b = F.col("o_custkey") % 700, (F.col("o_custkey") * 7 + F.col("o_orderkey")) % 900
    return table(spark, sf_dir, "orders").groupBy(a.alias("a"), b.alias("b")).agg(F.count("*").alias("coverage"), F.sum(F.col("o_orderkey") % 50).alias("length"))


PAIRS = "(SELECT DISTINCT c_custkey AS a, CASE WHEN c_custkey % 4 = 0 THEN c_custkey ELSE (c_custkey * 13) // 3 END AS b FROM customer)"


@query(f"""WITH RECURSIVE e AS (SELECT a, b FROM {PAIRS} UNION SELECT b, a FROM {PAIRS}), n AS (SELECT DISTINCT a AS node FROM e),
r(node, x) AS (SELECT node, node FROM n UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.x)
SELECT node, min(x) AS component FROM r WHERE node IN (SELECT a FROM e WHERE a <> b) GROUP BY node""")
def graph_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    b = F.when(c % 4 == 0, c).otherwise(F.floor(c * 13 / 3))  # every fourth is linked to itself alone
    pairs = table(spark, sf_dir, "customer").select(c.alias("a"), b.alias("b")).distinct()
    return graph.connected_components(pairs)


CHAIN = "(SELECT DISTINCT p_partkey AS a, CASE WHEN p_size % 11 = 0 THEN -p_size WHEN p_size % 9 = 0 THEN p_partkey + 3 ELSE p_partkey + 1 END AS b FROM part)"


@query(f"""WITH RECURSIVE e AS (SELECT * FROM {CHAIN}), i AS (SELECT a, b FROM e WHERE a IN (SELECT a FROM e GROUP BY a HAVING count(*) = 1) AND b IN (SELECT b FROM e GROUP BY b HAVING count(*) = 1)),
n AS (SELECT a AS node FROM e UNION SELECT b FROM e),
r(node, path, place) AS (SELECT node, node, 0 FROM n WHERE node NOT IN (SELECT b FROM i) UNION ALL SELECT i.b, r.path, r.place + 1 FROM r JOIN i ON i.a = r.node)
SELECT node, path, CAST(place AS BIGINT) AS place FROM r""")
def graph_unbranching_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.col("p_partkey")
    size = F.col("p_size")
    b = F.when(size % 11 == 0, -size).when(size % 9 == 0, a + 3).otherwise(a + 1)
    chain = table(spark, sf_dir, "part").select(a.alias("a"), b.alias("b")).distinct()
    return graph.unbranching_paths(chain)


@query(f"""SELECT e.a, e.b, e.length FROM {EDGES} e WHERE NOT EXISTS (SELECT 1 FROM {EDGES} x JOIN {EDGES} y ON x.b = y.a WHERE x.a = e.a AND y.b = e.b AND abs(x.length + y.length - e.length) <= 5)""")
def graph_transitive_reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.transitive_reduction(edges(spark, sf_dir), 5)


DEGREES = f"(SELECT node, CAST(sum(i) AS BIGINT) AS n_in, CAST(sum(o) AS BIGINT) AS n_out FROM (SELECT a AS node, 0 AS i, 1 AS o FROM {EDGES} UNION ALL SELECT b, 1, 0 FROM {EDGES}) GROUP BY node)"


@query(f"SELECT node, CASE WHEN n_in = 0 OR n_out = 0 THEN 'tip' WHEN n_in = 1 AND n_out = 1 THEN 'linear' ELSE 'junction' END AS kind FROM {DEGREES}")
def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.classify_nodes(edges(spark, sf_dir))


@query(f"""SELECT e.a, e.b, e.coverage FROM (SELECT *, max(coverage) OVER (PARTITION BY b) AS mi, max(coverage) OVER (PARTITION BY a) AS mo FROM {EDGES}) e JOIN {DEGREES} x ON x.node = e.a JOIN {DEGREES} y ON y.node = e.b
WHERE NOT ((x.n_in = 0 AND coverage < mi) OR (y.n_out = 0 AND coverage < mo))""")
def graph_clip_tips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.clip_tips(edges(spark, sf_dir)).select("a", "b", "coverage")


@query(f"SELECT a, b, coverage FROM (SELECT *, max(coverage) OVER (PARTITION BY a) AS best FROM {EDGES}) WHERE coverage >= 1 AND coverage >= 0.6 * best")
def graph_weak_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.weak_edges_removed(edges(spark, sf_dir), 1, 0.6).select("a", "b", "coverage")


@query(f"""WITH w AS (SELECT x.a, y.b, x.b AS m, least(x.coverage, y.coverage) AS c FROM {EDGES} x JOIN {EDGES} y ON x.b = y.a JOIN {DEGREES} d ON d.node = x.b AND n_in = 1 AND n_out = 1),
r AS (SELECT *, row_number() OVER w AS k, first_value(m) OVER w AS kept FROM w WINDOW w AS (PARTITION BY a, b ORDER BY c DESC, m)) SELECT a, b, kept, m AS removed FROM r WHERE k > 1""")
def graph_bubbles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.bubbles(edges(spark, sf_dir))


@query("SELECT l_suppkey AS a, l_partkey % 40 AS b, count(*) AS n, sum(l_extendedprice / ((l_quantity + 1) * (l_quantity + 1))) / sum(1 / ((l_quantity + 1) * (l_quantity + 1))) AS gap, sqrt(1 / sum(1 / ((l_quantity + 1) * (l_quantity + 1)))) AS sd FROM lineitem GROUP BY 1, 2")
def graph_bundled_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("a"), (F.col("l_partkey") % 40).alias("b"), F.col("l_extendedprice").alias("gap"), (F.col("l_quantity") + 1).alias("sd"))
    return graph.bundled_links(links)


LAYOUT = f"(SELECT l_suppkey AS tig, CASE WHEN l_linestatus = 'O' THEN {DAY.format('l_shipdate')} + CAST(l_quantity AS INTEGER) ELSE {DAY.format('l_shipdate')} END AS bgn, CASE WHEN l_linestatus = 'O' THEN {DAY.format('l_shipdate')} ELSE {DAY.format('l_shipdate')} + CAST(l_quantity AS INTEGER) END AS e FROM lineitem)"
RHO = f"(SELECT tig, count(*) AS n, (max(least(bgn, e)) - min(least(bgn, e)) + max(greatest(bgn, e)) - min(greatest(bgn, e))) / 2 AS rho FROM {LAYOUT} GROUP BY tig)"


def layout(spark, sf_dir) -> DataFrame:
    lo = F.datediff(F.to_date("l_shipdate"), F.lit("1990-01-01").cast("date"))
    hi = lo + F.col("l_quantity").cast("int")
    back = F.col("l_linestatus") == "O"
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("tig"), F.when(back, hi).otherwise(lo).alias("bgn"), F.when(back, lo).otherwise(hi).alias("end"))


@query(f"SELECT tig, n, rho, rho * (SELECT sum(n - 1) / sum(rho) FROM {RHO}) - ln(2) * (n - 1) AS a_stat FROM {RHO}")
def coverage_statistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.coverage_statistic(layout(spark, sf_dir))


@query(f"SELECT coalesce(sum(n - 1) FILTER (WHERE rho >= 2600) / sum(rho) FILTER (WHERE rho >= 2600), sum(n - 1) / sum(rho)) AS gar FROM {RHO}")
def arrival_rate_big_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.rate_by_big_spans(statistics.arrival(layout(spark, sf_dir)), 2600)


@query("""SELECT p_partkey AS tig, CASE WHEN p_size = 1 THEN 'single read' WHEN p_size < 5 THEN 'few reads' WHEN p_retailprice / 2500 > 0.7 THEN 'one read spans' WHEN p_retailprice >= 1700 THEN 'unique: long' WHEN p_size - 20 < -8 THEN 'low statistic' WHEN p_partkey % 100 / 100.0 > 0.8 THEN 'low coverage' WHEN p_retailprice < 950 THEN 'short' ELSE 'unique' END AS why FROM part""")
def mark_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    tigs = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("tig"), F.col("p_size").alias("n"), (F.col("p_retailprice") / 2500).alias("span"), F.col("p_retailprice").alias("length"), (F.col("p_size") - 20).alias("a_stat"), (F.col("p_partkey") % 100 / 100).alias("low"))
    return statistics.mark_unique(tigs, 5, 0.7, 1700, -8, 0.8, 950).select("tig", "why")


@query(f"""SELECT CAST(least(floor(gc * 20), 19) AS INTEGER) AS bucket, count(*) AS n, avg(coverage) AS mean, stddev_pop(coverage) AS sd FROM (SELECT length(regexp_replace(seq, '[^GC]', '', 'g')) / nullif(length(seq), 0) AS gc, length(seq) AS coverage FROM {DOCS}) WHERE gc IS NOT NULL GROUP BY 1""")
def gc_bias(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.sequence import gc_fraction

    return statistics.gc_bias(seqs(spark, sf_dir).select(gc_fraction(F.col("seq")).alias("gc"), F.length("seq").alias("coverage")), 20)


@query("""WITH f AS (SELECT user_id, regr_slope(value, event_id) AS slope, regr_intercept(value, event_id) AS intercept, count(*) AS n FROM events GROUP BY user_id HAVING count(*) >= 3)
SELECT f.user_id, round(slope, 9) AS slope, round(intercept, 6) AS intercept, round(avg(abs(value - slope * event_id - intercept)), 6) AS error, f.n FROM f JOIN events e ON e.user_id = f.user_id GROUP BY ALL""")
def linear_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = statistics.linear_fit(table(spark, sf_dir, "events"), "user_id", "event_id", "value").where("n >= 3")
    return out.select("user_id", F.round("slope", 9).alias("slope"), F.round("intercept", 6).alias("intercept"), F.round("error", 6).alias("error"), "n")


@query("""WITH f AS (SELECT l_returnflag, avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS s FROM lineitem GROUP BY 1)
SELECT l.l_returnflag AS lib, count(*) AS n, avg(l_extendedprice) AS mean, stddev_pop(l_extendedprice) AS sd FROM lineitem l JOIN f ON l.l_returnflag = f.l_returnflag WHERE abs(l_extendedprice - m) <= 1.5 * s GROUP BY 1""")
def insert_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.insert_size(table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "lib"), "lib", "l_extendedprice", 1.5)


WINDOWS = f"(SELECT grp, w AS \"window\", count(*) AS n FROM (SELECT grp, unnest(range(CAST(ceil(lo / 10) AS BIGINT), CAST(floor(hi / 10) AS BIGINT))) AS w FROM {SHIP}) GROUP BY grp, w)"


@query(f"SELECT * FROM {WINDOWS}")
def window_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.window_coverage(ships(spark, sf_dir), 10, "grp")


@query(f"""WITH e AS (SELECT grp AS edge, median(n) AS coverage, count(*) * 10 AS length FROM {WINDOWS} GROUP BY grp)
SELECT edge, coverage, CAST(round(coverage / greatest(1, (SELECT floor(sum(coverage * length) / sum(length)) FROM e))) AS BIGINT) AS multiplicity FROM e""")
def edge_multiplicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges_ = window_coverage(spark, sf_dir).groupBy(F.col("grp").alias("edge")).agg(F.percentile("n", 0.5).alias("coverage"), (F.count("*") * 10).alias("length"))
    return statistics.multiplicity(edges_)


COLUMNS = f"(SELECT id % 50 AS tig, i AS pos, substr(seq, CAST(i AS BIGINT), 1) AS base FROM (SELECT id, seq, unnest(range(1, length(seq) + 1)) AS i FROM {DOCS}))"


@query(f"SELECT tig, pos, base, n, depth FROM (SELECT tig, pos, base, count(*) AS n, sum(count(*)) OVER (PARTITION BY tig, pos) AS depth, row_number() OVER (PARTITION BY tig, pos ORDER BY count(*) DESC, base) AS k FROM {COLUMNS} GROUP BY tig, pos, base) WHERE k = 1")
def consensus_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.consensus(_columns(spark, sf_dir), ["tig", "pos"])


def _columns(spark, sf_dir) -> DataFrame:
    rows = seqs(spark, sf_dir).where(F.length("seq") > 0)
    return rows.select((F.col("id") % 50).alias("tig"), F.posexplode(F.split("seq", "")).alias("pos", "base")).select("tig", (F.col("pos") + 1).cast("long").alias("pos"), "base")


@query(f"SELECT tig, pos, depth FROM (SELECT tig, pos, max(n) AS n, sum(n) AS depth FROM (SELECT tig, pos, base, count(*) AS n FROM {COLUMNS} GROUP BY ALL) GROUP BY tig, pos) WHERE 1 - n / depth >= 0.6")
def divergent_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.divergent_positions(_columns(spark, sf_dir), ["tig", "pos"], 0.6).select("tig", "pos", "depth")


@query("""SELECT event_id, CAST(sum(d) OVER (PARTITION BY event_type ORDER BY event_id) AS BIGINT) AS coverage FROM (SELECT event_id, event_type, CASE WHEN row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) % 2 = 1 THEN 1 ELSE -1 END AS d FROM events)""")
def running_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.running_coverage(table(spark, sf_dir, "events"), "event_type", ["event_id"], "user_id").select("event_id", "coverage")


@query("""SELECT target, count(*) FILTER (WHERE NOT coalesce(again, false)) AS n FROM (SELECT target, lag(target) OVER w = target AND lag(turn) OVER w = turn - 1 AND mate = 1 AND lag(mate) OVER w = 0 AS again FROM (SELECT conv_id, turn, turn % 2 AS mate, length(text) % 20 AS target FROM conversations) WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) GROUP BY target""")
def placement_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", (F.col("turn") % 2).alias("mate"), (F.length("text") % 20).cast("long").alias("target"))
    return statistics.placement_counts(rows, "target", "turn", "conv_id", "mate")


@query("""SELECT a.conv_id, length(a.text) % 20 AS target0, length(b.text) % 20 AS target1 FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn = 0 AND b.turn = 1 WHERE length(a.text) % 20 <> length(b.text) % 20""")
def linking_mates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("mate"), (F.length("text") % 20).cast("long").alias("target"))
    return statistics.linking_mates(rows, "conv_id", "mate", "target")
