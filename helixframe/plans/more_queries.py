"""Further operators of all kinds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.sequence import canonical, cigar_operations, reference_span, reverse_complement
from ..operators import alignment_sets, graph, interval, kmer, sequential
from .assembly_queries import DEGREES, EDGES, edges
from .kmer_queries import _links_sql, seqs
from .overlap_queries import ALIGNMENTS, ONE_TO_ONE, aligned
from .record_queries import DOCS, MERGED, SHIP, ships
from .registry import query, table


@query(f"""WITH l AS (SELECT length(seq) AS n FROM {DOCS}), o AS (SELECT n, row_number() OVER (ORDER BY n DESC) - 1 AS k, count(*) OVER () AS c FROM l),
m AS (SELECT n FROM o WHERE k = floor((c - 1) * 0.75)), g AS (SELECT sum(length(regexp_replace(seq, '[^GC]', '', 'g'))) / sum(length(seq)) AS gc FROM {DOCS}),
x AS (SELECT CAST(floor(n * CASE WHEN gc >= 0.35 AND gc <= 0.6 THEN 0.66 ELSE 0.33 END) AS BIGINT) AS k FROM m, g)
SELECT least(99, greatest(31, k + CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END)) AS k FROM x""")
def kmer_optimal_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k from the length that three quarters of the reads reach and the share of G and C: odd, from 31 to 99."""
    s = seqs(spark, sf_dir)
    by = s.where("seq is not null").groupBy(F.length("seq").alias("n")).agg(F.count("*").alias("c"))
    run = by.withColumn("above", F.sum("c").over(Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)))
    both = s.agg((F.sum(F.length(F.regexp_replace("seq", "[^GC]", ""))) / F.sum(F.length("seq"))).alias("gc"), F.floor((F.count("seq") - 1) * 0.75).alias("at"))
    n = run.join(F.broadcast(both), F.col("above") > F.col("at")).agg(F.max("n").alias("n"), F.first("gc").alias("gc"))
    k = F.floor(F.col("n") * F.when((F.col("gc") >= 0.35) & (F.col("gc") <= 0.6), 0.66).otherwise(0.33))
    return n.select(F.least(F.lit(99), F.greatest(F.lit(31), k + F.when(k % 2 == 0, 1).otherwise(0))).alias("k"))


@query("SELECT doc_id AS id, array_to_string(list_sort(string_split(text, chr(10))), chr(10)) AS seq FROM documents")
def fasta_dsort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.array_join(F.array_sort(F.split("text", "\n")), "\n").alias("seq"))


@query(f"SELECT DISTINCT least(seq, reverse(translate(seq, 'ACGT', 'TGCA'))) AS seq FROM {DOCS} WHERE length(seq) > 0")
def unique_mega_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pipelines import unique_mega_reads as unique

    return unique(seqs(spark, sf_dir).where(F.length("seq") > 0))


@query(f"SELECT least(seq, reverse(translate(seq, 'ACGT', 'TGCA'))) AS canon, count(*) AS n, min(id) AS first FROM {DOCS} GROUP BY 1 HAVING count(*) > 1")
def duplicate_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seqs(spark, sf_dir).groupBy(canonical(F.col("seq")).alias("canon")).agg(F.count("*").alias("n"), F.min("id").alias("first")).where("n > 1")


@query(f"""WITH m AS (SELECT CAST(floor(sum(length(seq) * (id % 40)) / sum(length(seq))) AS BIGINT) AS m FROM {DOCS}) SELECT id FROM {DOCS}, m WHERE id % 40 >= greatest(5, m // 4) AND id % 40 <= 3 * m""")
def contigs_by_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contigs with coverage of at least a quarter of the mean (5 at least) and at most three times it; the mean is weighted by length and cut to a whole number."""
    c = seqs(spark, sf_dir).select("id", F.length("seq").alias("n"), (F.col("id") % 40).alias("cov"))
    mean = c.agg(F.floor(F.sum(F.col("n") * F.col("cov")) / F.sum("n")).alias("m"))
    return c.join(F.broadcast(mean), (F.col("cov") >= F.greatest(F.lit(5), F.floor(F.col("m") / 4))) & (F.col("cov") <= 3 * F.col("m"))).select("id")


@query(f"SELECT s_suppkey AS grp FROM supplier LEFT JOIN (SELECT grp, sum(hi - lo) AS c FROM {MERGED} GROUP BY grp) ON grp = s_suppkey WHERE coalesce(c, 0) / (4000 + s_nationkey) < 0.67")
def unmapped_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("grp"), (4000 + F.col("s_nationkey")).alias("size"))
    return interval.covered_share(ships(spark, sf_dir), whole, ["grp"], "size").where("share < 0.67").select("grp")


@query(f"""WITH w AS (SELECT grp, x AS win, count(*) AS n FROM (SELECT grp, unnest(range(lo // 20, (hi - 1) // 20 + 1)) AS x FROM {SHIP} WHERE hi > lo) GROUP BY grp, x),
m AS (SELECT grp, avg(n) AS mean, min(win) AS a, max(win) AS b FROM w GROUP BY grp)
SELECT w.grp, w.win, w.n FROM w JOIN m ON m.grp = w.grp WHERE w.n < greatest(1, round(mean / 5)) AND w.win > a + 2 AND w.win < b - 2""")
def chimeric_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows inside the flanks whose overlap coverage falls below a fifth of the mean."""
    s = ships(spark, sf_dir).where("hi > lo")
    w = s.select("grp", F.explode(F.sequence(F.floor(F.col("lo") / 20), F.floor((F.col("hi") - 1) / 20))).alias("win")).groupBy("grp", "win").agg(F.count("*").alias("n"))
    m = w.groupBy("grp").agg(F.avg("n").alias("mean"), F.min("win").alias("a"), F.max("win").alias("b"))
    return w.join(m, "grp").where((F.col("n") < F.greatest(F.lit(1), F.round(F.col("mean") / 5))) & (F.col("win") > F.col("a") + 2) & (F.col("win") < F.col("b") - 2)).select("grp", "win", "n")


@query("""WITH e AS (SELECT user_id, event_id, value, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS grp FROM events)
SELECT user_id, grp, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, grp ORDER BY value, event_id) AS k FROM e) WHERE k = 1""")
def split_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per break group the place of least coverage, the first of equals."""
    run = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    e = table(spark, sf_dir, "events").withColumn("grp", F.sum(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).over(run))
    return e.groupBy("user_id", "grp").agg(F.min(F.struct("value", "event_id")).alias("x")).select("user_id", "grp", F.col("x.event_id").alias("event_id"), F.col("x.value").alias("value"))


@query("""WITH p AS (SELECT conv_id, turn // 2 AS pair, turn % 2 AS mate, length(text) AS n FROM conversations)
SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, coalesce(a.pair, b.pair) AS pair, coalesce(a.n, 1) AS n1, coalesce(b.n, 1) AS n2 FROM (SELECT * FROM p WHERE mate = 0) a FULL JOIN (SELECT * FROM p WHERE mate = 1) b ON a.conv_id = b.conv_id AND a.pair = b.pair""")
def missing_mates_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both mates of every pair; one that is missing is a single N."""
    p = table(spark, sf_dir, "conversations").select("conv_id", F.floor(F.col("turn") / 2).alias("pair"), (F.col("turn") % 2).alias("mate"), F.col("text").alias("seq"))
    side = lambda m, c: p.where(F.col("mate") == m).select("conv_id", "pair", F.col("seq").alias(c))
    both = side(0, "a").join(side(1, "b"), ["conv_id", "pair"], "full")
    return both.select("conv_id", "pair", *(F.length(F.coalesce(c, F.lit("N"))).cast("long").alias(n) for c, n in (("a", "n1"), ("b", "n2"))))


@query("SELECT o_custkey AS gap, bool_or(o_orderstatus = 'O') AS has_open, bool_or(o_totalprice > 400000) AS has_large, count(*) AS n FROM orders GROUP BY o_custkey HAVING bool_or(o_orderstatus = 'O')")
def gap_reads_needed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags of reads OR-ed over the mates and groups of a gap."""
    return table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("gap")).agg(F.bool_or(F.col("o_orderstatus") == "O").alias("has_open"), F.bool_or(F.col("o_totalprice") > 400_000).alias("has_large"), F.count("*").alias("n")).where("has_open")


@query("SELECT l_partkey % 200 AS gap, count(*) AS n, avg(l_extendedprice) AS mean, stddev_pop(l_extendedprice) AS sd FROM lineitem GROUP BY 1")
def gap_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy((F.col("l_partkey") % 200).alias("gap")).agg(F.count("*").alias("n"), F.avg("l_extendedprice").alias("mean"), F.stddev_pop("l_extendedprice").alias("sd"))


@query("SELECT item_id AS id, left(s, 20) AS head, right(s, 20) AS tail FROM (SELECT item_id, regexp_replace(upper(text), '[^ACGT]', '', 'g') AS s FROM benchmark) WHERE length(s) >= 20")
def contig_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = seqs(spark, sf_dir, "benchmark").where(F.length("seq") >= 20)
    return s.select("id", F.left("seq", F.lit(20)).alias("head"), F.right("seq", F.lit(20)).alias("tail"))


@query(f"""WITH a AS (SELECT *, lag(e_r) OVER w AS per, lag(qry) OVER w AS pq FROM {ALIGNMENTS} WINDOW w AS (PARTITION BY ref ORDER BY s_r, e_r, aln)),
g AS (SELECT *, sum(CASE WHEN pq = qry AND s_r - per <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY ref ORDER BY s_r, e_r, aln) AS island FROM a)
SELECT ref, qry, min(s_r) AS s_r, max(e_r) AS e_r, count(*) AS n, CAST(sum(e_r - s_r + 1) AS BIGINT) AS bases FROM g GROUP BY ref, qry, island HAVING count(*) > 1""")
def collinear_matches_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of one query's matches along a reference, with gaps of at most 50."""
    w = Window.partitionBy("ref").orderBy("s_r", "e_r", "aln")
    a = aligned(spark, sf_dir).withColumn("goes_on", F.coalesce((F.lag("qry").over(w) == F.col("qry")) & (F.col("s_r") - F.lag("e_r").over(w) <= 50), F.lit(False)))
    # only runs of two or more are asked for: what neither goes on nor is gone on from is left out before it is counted
    a = a.withColumn("first", F.coalesce(F.lead("goes_on").over(w), F.lit(False))).where("goes_on or first")
    g = a.withColumn("island", F.sum(F.when(F.col("goes_on"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return g.groupBy("ref", "qry", "island").agg(F.min("s_r").alias("s_r"), F.max("e_r").alias("e_r"), F.count("*").alias("n"), F.sum(F.col("e_r") - F.col("s_r") + 1).alias("bases")).where("n > 1").drop("island")


@query(f"""WITH w AS (SELECT aln, ref, idy, unnest(range(s_r // 100, e_r // 100 + 1)) AS win FROM {ALIGNMENTS}), k AS (SELECT *, row_number() OVER (PARTITION BY ref, win ORDER BY idy DESC, aln) AS r FROM w),
m AS (SELECT ref, greatest(10, 1.25 * quantile_cont(c, 0.5)) AS most FROM (SELECT ref, win, count(*) AS c FROM w GROUP BY ref, win) GROUP BY ref)
SELECT aln FROM k JOIN m ON m.ref = k.ref GROUP BY aln HAVING 2 * count(*) FILTER (WHERE r <= most) > count(*)""")
def alignments_sampled_evenly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_sets.sampled_evenly(aligned(spark, sf_dir))


@query("SELECT event_id // 2 AS pair, min(event_id) AS a, max(event_id) AS b, count(DISTINCT user_id) AS n FROM events GROUP BY 1 HAVING count(*) = 2")
def mate_pairs_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(F.floor(F.col("event_id") / 2).alias("pair")).agg(F.min("event_id").alias("a"), F.max("event_id").alias("b"), F.countDistinct("user_id").alias("n"), F.count("*").alias("c")).where("c = 2").drop("c")


@query(f"SELECT id, substr(seq, 6 + id % 10, 25) AS seq FROM {DOCS} WHERE length(seq) >= 6 + id % 10")
def region_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of regions [bgn, end), from 0, by a join of regions and records."""
    regions = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), (5 + F.col("doc_id") % 10).cast("int").alias("bgn")).withColumn("end", F.col("bgn") + 25)
    rows = regions.join(seqs(spark, sf_dir), "id").where(F.length("seq") > F.col("bgn"))
    return rows.select("id", F.substr("seq", F.col("bgn") + 1, F.col("end") - F.col("bgn")).alias("seq"))


@query(f"SELECT id, CASE WHEN (id % 32) & 16 <> 0 THEN reverse(translate(seq, 'ACGT', 'TGCA')) ELSE seq END AS seq FROM {DOCS}")
def reads_from_alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads as they were sequenced: those aligned in reverse are turned back."""
    back = (F.col("id") % 32).bitwiseAND(F.lit(16)) != 0
    return seqs(spark, sf_dir).select("id", F.when(back, reverse_complement(F.col("seq"))).otherwise(F.col("seq")).alias("seq"))


@query("""WITH c AS (SELECT l_orderkey AS o, l_linenumber AS n, CAST(l_linenumber AS VARCHAR) || 'S' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || 'M2I' || CAST(l_linenumber * 3 AS VARCHAR) || 'D10M' AS cigar, CAST(l_quantity AS INTEGER) + l_linenumber * 3 + 10 AS span FROM lineitem)
SELECT o, n, cigar, CAST(span AS INTEGER) AS span, 5 AS n_ops FROM c""")
def cigar_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = lambda c: F.expr(f"cast({c} as string)")
    cigar = F.concat(s("l_linenumber"), F.lit("S"), s("int(l_quantity)"), F.lit("M2I"), s("l_linenumber * 3"), F.lit("D10M"))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n"), cigar.alias("cigar"))
    return rows.select("o", "n", "cigar", reference_span(F.col("cigar")).alias("span"), F.size(cigar_operations(F.col("cigar"))).alias("n_ops"))


@query(f"SELECT tig, pos, string_agg(base, '' ORDER BY id) AS bases, count(*) AS depth FROM (SELECT id, id % 50 AS tig, i AS pos, substr(seq, CAST(i AS BIGINT), 1) AS base FROM (SELECT id, seq, unnest(range(1, length(seq) + 1)) AS i FROM {DOCS})) GROUP BY tig, pos")
def pileup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per place the bases of all reads over it, in the order of the reads, and their number. A place has as many as its depth."""
    rows = seqs(spark, sf_dir).where(F.length("seq") > 0).select("id", (F.col("id") % 50).alias("tig"), F.posexplode(F.split("seq", "")).alias("pos", "base"))
    ordered = F.array_sort(F.collect_list(F.struct("id", "base")))
    return rows.groupBy("tig", (F.col("pos") + 1).cast("long").alias("pos")).agg(F.array_join(F.transform(ordered, lambda x: x["base"]), "").alias("bases"), F.count("*").alias("depth"))


@query(f"SELECT node FROM {DEGREES} JOIN (SELECT a, sum(coverage) AS c FROM {EDGES} GROUP BY a) ON a = node WHERE n_in >= 2 AND n_out >= 2 AND c >= 2")
def repeat_contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contigs with two links or more on each side and coverage of two or more."""
    e = edges(spark, sf_dir)
    cov = e.groupBy(F.col("a").alias("node")).agg(F.sum("coverage").alias("c")).where("c >= 2")
    return graph.degrees(e).where("n_in >= 2 and n_out >= 2").join(cov, "node").select("node")


@query(f"SELECT kmer, CASE WHEN out_A > 0 THEN 'A' WHEN out_C > 0 THEN 'C' WHEN out_G > 0 THEN 'G' ELSE 'T' END AS next FROM ({_links_sql(11)}) WHERE (out_A > 0)::INT + (out_C > 0)::INT + (out_G > 0)::INT + (out_T > 0)::INT = 1")
def unique_extensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k-mers that are always followed by the same letter, and that letter."""
    rows = kmer.links(seqs(spark, sf_dir), 11)
    ways = F.array(*(F.when(F.col(f"out_{b}") > 0, b) for b in "ACGT"))
    return rows.withColumn("ways", F.array_compact(ways)).where(F.size("ways") == 1).select("kmer", F.element_at("ways", 1).alias("next"))


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def reads_not_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads that are not in an anti-list."""
    listed = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id")).distinct()
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")).join(listed, "id", "left_anti")


@query("""WITH e AS (SELECT user_id, event_id, value, lead(event_id) OVER w AS e2, lead(value) OVER w AS v2 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
SELECT user_id, event_id, value + (v2 - value) * 0.25 AS projected FROM e WHERE e2 IS NOT NULL""")
def projected_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A place a quarter of the way to the next anchor, by linear interpolation."""
    w = Window.partitionBy("user_id").orderBy("event_id")
    e = table(spark, sf_dir, "events").withColumn("v2", F.lead("value").over(w))
    return e.where("v2 is not null").select("user_id", "event_id", (F.col("value") + (F.col("v2") - F.col("value")) * 0.25).alias("projected"))


def low_complexity_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequential.mask_low_complexity(seqs(spark, sf_dir).select("id", "seq"))


_TILES = f"""(WITH RECURSIVE o AS (SELECT ref AS g, list(s_r ORDER BY e_r, s_r, aln) AS los, list(e_r ORDER BY e_r, s_r, aln) AS his, list(idy ORDER BY e_r, s_r, aln) AS ws, list(aln ORDER BY e_r, s_r, aln) AS ks FROM {ALIGNMENTS} GROUP BY ref),
t(g, i, total, take, bf) AS (SELECT g, 0, [CAST(0 AS DOUBLE)], CAST([] AS BOOLEAN[]), CAST([] AS BIGINT[]) FROM o UNION ALL
  SELECT g, i + 1, list_append(total, greatest(total[n + 1] + w, total[i + 1])), list_append(take, total[n + 1] + w > total[i + 1]), list_append(bf, n)
  FROM (SELECT t.g, i, total, take, bf, ws[i + 1] AS w, los[i + 1] AS lo, least(i, len(list_filter(his, lambda h: h <= los[i + 1]))) AS n FROM t JOIN o ON o.g = t.g WHERE i < len(los))),
f AS (SELECT t.g, take, bf, ks, i AS n FROM t JOIN o ON o.g = t.g WHERE i = len(los)),
b(g, x) AS (SELECT g, n FROM f UNION ALL SELECT b.g, CASE WHEN take[x] THEN bf[x] ELSE x - 1 END FROM b JOIN f ON f.g = b.g WHERE x > 0)
SELECT b.g AS ref, ks[x] AS aln FROM b JOIN f ON f.g = b.g WHERE x > 0 AND take[x])"""


@query(f"SELECT ref, aln FROM {_TILES}")
def best_tilings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequential.best_tiling(aligned(spark, sf_dir), "ref", "s_r", "e_r", "idy", "aln")


def _fold_sql(rows: str, group: str, columns: list[str], order: str, clash: str) -> str:
    """Rows (id, columns...) of rows without those that clash with one that is
    kept before them: a fold over a list of flags. clash says so of x[i] and x[j]."""
    lists = ", ".join(f"list({c} ORDER BY {order}) AS {c}s" for c in ("id", *columns))
    return f"""(WITH RECURSIVE o AS (SELECT {group} AS g, {lists} FROM {rows} GROUP BY {group}),
t(g, i, ok) AS (SELECT g, 0, CAST([] AS BOOLEAN[]) FROM o UNION ALL SELECT t.g, i + 1, list_append(ok, len(list_filter(range(1, i + 1), lambda j: ok[j] AND {clash.replace('[i]', '[i + 1]')})) = 0) FROM t JOIN o ON o.g = t.g WHERE i < len(ids)),
f AS (SELECT o.*, ok FROM t JOIN o ON o.g = t.g WHERE i = len(ids)) SELECT g, unnest(ids) AS id, {', '.join(f"unnest({c}s) AS {c}" for c in columns)}, unnest(ok) AS ok FROM f)"""


_PAIRED = "(SELECT l_orderkey * 8 + l_linenumber AS id, l_suppkey AS sr, l_partkey % 500 AS x, CAST(l_quantity AS BIGINT) AS y FROM lineitem)"


@query(f"SELECT id, g AS sr, x, y FROM {_fold_sql(_PAIRED, 'sr', ['x', 'y'], 'id, x, y', 'abs(xs[i] - xs[j]) <= 5 AND abs(ys[i] - ys[j]) <= 5')} WHERE ok")
def redundant_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), F.col("l_suppkey").alias("sr"), (F.col("l_partkey") % 500).alias("x"), F.col("l_quantity").cast("long").alias("y"))
    return sequential.redundant_pairs_removed(rows, ["sr"], "id", "x", "y", 5)


_SPANS = f"(SELECT aln AS id, qry, least(s_q, e_q) AS lo, greatest(s_q, e_q) AS hi, idy FROM {ALIGNMENTS})"


@query(f"SELECT id AS aln, ok AS \"primary\" FROM {_fold_sql(_SPANS, 'qry', ['lo', 'hi'], 'idy DESC, id', 'least(his[i], his[j]) - greatest(los[i], los[j]) >= 0.5 * least(his[i] - los[i], his[j] - los[j])')}")
def alignments_primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Primary and secondary alignments of each query."""
    rows = aligned(spark, sf_dir).select("aln", "qry", F.least("s_q", "e_q").alias("lo"), F.greatest("s_q", "e_q").alias("hi"), "idy")
    return sequential.primary_alignments(rows, "qry", "lo", "hi", "idy", "aln")


@query("""WITH RECURSIVE o AS (SELECT o_custkey AS g, list(o_totalprice ORDER BY o_orderkey) AS vs FROM orders GROUP BY o_custkey),
t(g, i, d) AS (SELECT g, 0, CAST([] AS BIGINT[]) FROM o UNION ALL SELECT t.g, i + 1, list_append(d, 1 + coalesce(list_max(list_transform(range(1, i + 1), lambda j: CASE WHEN vs[j] < vs[i + 1] THEN d[j] ELSE 0 END)), 0)) FROM t JOIN o ON o.g = t.g WHERE i < len(vs))
SELECT t.g AS o_custkey, CAST(len(vs) AS BIGINT) AS n, list_max(d) AS longest FROM t JOIN o ON o.g = t.g WHERE i = len(vs)""")
def longest_increasing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest increasing run, with gaps, in the order of anchors."""
    return sequential.longest_increasing(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey", "o_totalprice")


_TWINS = "(SELECT DISTINCT l_partkey % 400 AS a, l_suppkey * 4 AS b FROM lineitem WHERE l_partkey % 400 <> l_suppkey * 4)"


@query(f"""WITH RECURSIVE n AS (SELECT a AS node FROM {_TWINS} UNION SELECT b FROM {_TWINS}), e AS (SELECT greatest(a, b) AS node, list(DISTINCT least(a, b)) AS near FROM {_TWINS} GROUP BY 1), o AS (SELECT list(node ORDER BY node) AS ns FROM n),
s AS (SELECT node, near, row_number() OVER (ORDER BY node) AS k FROM n LEFT JOIN e USING (node)),
t(i, kept) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]) UNION ALL SELECT i + 1, CASE WHEN list_has_any(kept, coalesce(near, [])) THEN kept ELSE list_append(kept, node) END FROM t JOIN s ON k = i + 1)
SELECT node, list_contains((SELECT arg_max(kept, i) FROM t), node) AS kept FROM n""")
def fragments_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments, in order, that are not duplicates of one that is kept before them."""
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 400).alias("a"), (F.col("l_suppkey") * 4).alias("b")).where("a <> b").distinct()
    nodes = rows.select(F.col("a").alias("node")).unionByName(rows.select(F.col("b").alias("node")))
    return graph.kept_in_order(nodes, rows)


@query(f"SELECT count(*) AS n_alignments, count(DISTINCT ref) AS n_refs, count(DISTINCT qry) AS n_qrys, CAST(sum(abs(e_r - s_r) + 1) AS BIGINT) AS aligned_r, CAST(sum(abs(e_q - s_q) + 1) AS BIGINT) AS aligned_q, sum((abs(e_r - s_r) + 1) * idy) / sum(abs(e_r - s_r) + 1) AS identity FROM {ALIGNMENTS} WHERE aln IN {ONE_TO_ONE}")
def dnadiff_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of the one-to-one alignments."""
    from .pipelines import dnadiff

    return dnadiff(aligned(spark, sf_dir))[1]


@query(f"""WITH a AS (SELECT ref, least(s_r, e_r) AS lo, greatest(s_r, e_r) AS hi FROM {ALIGNMENTS} WHERE idy >= 98), z AS (SELECT s_suppkey AS ref, 60000 + s_nationkey AS size FROM supplier),
x AS (SELECT ref, lo, hi FROM a UNION ALL SELECT ref, 0, 0 FROM z UNION ALL SELECT ref, size, size FROM z), f AS (SELECT *, max(hi) OVER (PARTITION BY ref ORDER BY lo, hi DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM x)
SELECT ref, far AS lo, lo AS hi FROM f WHERE lo - far >= 100""")
def regions_not_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of references, of 100 bases or more, that no alignment covers; ends count."""
    rows = aligned(spark, sf_dir).where("idy >= 98").select("ref", F.least("s_r", "e_r").alias("lo"), F.greatest("s_r", "e_r").alias("hi"))
    size = (60_000 + F.col("s_nationkey")).cast("long")
    ends = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("ref"), F.explode(F.array(F.lit(0).cast("long"), size)).alias("lo"))
    return interval.invert(rows.unionByName(ends.withColumn("hi", F.col("lo"))), ["ref"]).where("hi - lo >= 100")


query()(low_complexity_parts)
