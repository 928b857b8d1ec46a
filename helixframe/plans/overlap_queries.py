"""Overlaps, matches and alignment sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sequence import overlap_kind
from ..operators import alignment_sets, kmer, overlap
from .kmer_queries import dna_sql, seqs
from .record_queries import DAY, DOCS
from .registry import query, table

SEEDS = f"""(WITH s AS (SELECT id, pos, kmer FROM {dna_sql(k=14, both=False)}), r AS (SELECT kmer FROM s GROUP BY kmer HAVING count(*) BETWEEN 2 AND 8),
p AS (SELECT a.id AS a, b.id AS b, a.pos - b.pos AS diagonal, count(*) AS seeds FROM s a JOIN r ON a.kmer = r.kmer JOIN s b ON b.kmer = a.kmer AND a.id < b.id GROUP BY ALL)
SELECT a, b, diagonal, seeds FROM (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY seeds DESC, diagonal) AS k FROM p) WHERE k = 1 AND seeds >= 2)"""


@query(f"SELECT * FROM {SEEDS}")
def seed_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.seed_overlaps(seqs(spark, sf_dir), 14, 8, 2)


@query("""WITH w AS (SELECT DISTINCT doc_id AS id, word FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{6,}')) AS word FROM documents)),
v AS (SELECT DISTINCT item_id AS id, word FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[a-z]{6,}')) AS word FROM benchmark)),
r AS (SELECT word FROM v GROUP BY word HAVING count(*) <= 5)
SELECT w.id AS a, v.id AS b, count(*) AS shared FROM w JOIN v ON w.word = v.word JOIN r ON r.word = v.word GROUP BY ALL""")
def seed_pairs_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    say = lambda t, i: table(spark, sf_dir, t).select(F.col(i).alias("id"), F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{6,})"), 1)).alias("word"))
    return overlap.seed_pairs(say("documents", "doc_id"), say("benchmark", "item_id"), "word", 5)


OVERLAPS = "(SELECT l_partkey % 100 AS a_iid, l_suppkey AS b_iid, CAST(l_quantity AS INTEGER) - 25 AS a_hang, CAST(l_linenumber AS INTEGER) * 3 - 10 AS b_hang, l_discount AS erate FROM lineitem)"
KIND = "CASE WHEN a_hang >= 0 AND b_hang <= 0 THEN 'contains' WHEN a_hang <= 0 AND b_hang >= 0 THEN 'contained' WHEN a_hang > 0 THEN '3p' ELSE '5p' END"


def overlaps(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 100).alias("a_iid"), F.col("l_suppkey").alias("b_iid"), (F.col("l_quantity").cast("int") - 25).alias("a_hang"), (F.col("l_linenumber").cast("int") * 3 - 10).alias("b_hang"), F.col("l_discount").alias("erate"))


@query(f"SELECT a_iid, b_iid, a_hang, b_hang, erate, {KIND} AS kind FROM {OVERLAPS} WHERE {KIND} IN ('5p', 'contained') AND erate <= 0.04 AND b_iid >= 10")
def overlap_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.select(overlaps(spark, sf_dir), ["5p", "contained"], 0.04, 10)


LENGTHS = "(SELECT p_partkey AS iid, p_size + 60 AS size FROM part)"


def lengths(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("iid"), (F.col("p_size") + 60).alias("size"))


LONG = f"(SELECT o.*, a.size - greatest(a_hang, 0) + least(b_hang, 0) AS length FROM {OVERLAPS} o JOIN {LENGTHS} a ON a.iid = a_iid JOIN {LENGTHS} b ON b.iid = b_iid WHERE a.size - greatest(a_hang, 0) + least(b_hang, 0) >= 70)"


@query(f"SELECT a_iid, b_iid, a_hang, b_hang, length FROM {LONG}")
def overlap_filter_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.with_lengths(overlaps(spark, sf_dir), lengths(spark, sf_dir), 70).select("a_iid", "b_iid", "a_hang", "b_hang", "length")


BEST = f"(SELECT a_iid, kind AS \"end\", b_iid, length, erate FROM (SELECT *, {KIND} AS kind, row_number() OVER (PARTITION BY a_iid, {KIND} ORDER BY length DESC, erate, b_iid) AS k FROM {LONG}) WHERE k = 1 AND kind IN ('5p', '3p'))"


def best(spark, sf_dir) -> DataFrame:
    return overlap.best_per_end(overlap.with_lengths(overlaps(spark, sf_dir), lengths(spark, sf_dir), 70))


@query(f"SELECT * FROM {BEST}")
def overlap_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best(spark, sf_dir)


@query(f"SELECT a_iid, \"end\", b_iid, erate, rank FROM (SELECT *, {KIND} AS \"end\", row_number() OVER (PARTITION BY a_iid, {KIND} ORDER BY erate, b_iid, a_hang, b_hang) AS rank FROM {OVERLAPS}) WHERE rank <= 3 AND \"end\" IN ('5p', '3p')")
def overlap_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.top_per_end(overlaps(spark, sf_dir), 3).select("a_iid", "end", "b_iid", "erate", "rank")


@query(f"SELECT DISTINCT b.a_iid, b.b_iid FROM {BEST} b JOIN {BEST} c ON c.a_iid = b.b_iid AND c.b_iid = b.a_iid WHERE b.a_iid < b.b_iid")
def overlap_mutual_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.mutual_best(best(spark, sf_dir))


@query(f"SELECT p_partkey AS iid, CASE WHEN n IS NULL THEN 'singleton' WHEN n = 1 THEN 'spur' ELSE 'inner' END AS status FROM part LEFT JOIN (SELECT a_iid, count(*) AS n FROM {BEST} GROUP BY a_iid) ON a_iid = p_partkey")
def overlap_spurs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.spurs(best(spark, sf_dir), lengths(spark, sf_dir))


@query(f"SELECT {KIND} AS kind, count(*) AS n, avg(erate) AS mean_erate, count(DISTINCT a_iid) AS n_reads FROM {OVERLAPS} GROUP BY 1")
def overlap_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = overlap_kind(F.col("a_hang"), F.col("b_hang")).alias("kind")
    return overlaps(spark, sf_dir).groupBy(kind).agg(F.count("*").alias("n"), F.avg("erate").alias("mean_erate"), F.countDistinct("a_iid").alias("n_reads"))


ORIENTED = f"(SELECT id, 'F' AS ori, seq AS s FROM {DOCS} WHERE length(seq) >= 6 UNION ALL SELECT id, 'R', reverse(translate(seq, 'ACGT', 'TGCA')) FROM {DOCS} WHERE length(seq) >= 6)"


@query(f"SELECT a.id AS a, a.ori AS a_ori, b.id AS b, b.ori AS b_ori FROM {ORIENTED} a JOIN {ORIENTED} b ON right(a.s, 6) = left(b.s, 6) AND a.id <> b.id")
def unitig_end_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.end_overlaps(seqs(spark, sf_dir), 7)


def _runs_sql(most: int | None) -> str:
    rare = "" if most is None else f" HAVING count(*) <= {most}"
    return f"""(WITH q AS (SELECT id, pos, kmer FROM {dna_sql('benchmark', k=12, both=False)}), t AS (SELECT id, pos, kmer FROM {dna_sql(k=12, both=False)}), r AS (SELECT kmer FROM t GROUP BY kmer{rare}),
h AS (SELECT q.id AS q, t.id AS t, q.pos AS qp, t.pos AS tp, q.pos - t.pos AS d FROM q JOIN t ON q.kmer = t.kmer JOIN r ON r.kmer = t.kmer),
i AS (SELECT *, qp - row_number() OVER (PARTITION BY q, t, d ORDER BY qp) AS island FROM h)
SELECT q, t, min(qp) AS q_begin, min(tp) AS t_begin, count(*) + 11 AS length FROM i GROUP BY q, t, d, island)"""


@query(f"SELECT * FROM {_runs_sql(1)}")
def unique_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.match_runs(seqs(spark, sf_dir, "benchmark"), seqs(spark, sf_dir), 12)


@query(f"SELECT * FROM {_runs_sql(50)}")
def maximal_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.match_runs(seqs(spark, sf_dir, "benchmark"), seqs(spark, sf_dir), 12, 50)


@query(f"SELECT * FROM {_runs_sql(None)}")
def maximal_matches_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal matches of k-mers with any number of places (MAXMATCH)."""
    return overlap.match_runs(seqs(spark, sf_dir, "benchmark"), seqs(spark, sf_dir), 12, None)


@query(f"""WITH RECURSIVE m AS (SELECT t AS ref, q AS qry, t_begin AS r, q_begin AS q, length AS n, row_number() OVER (PARTITION BY t, q ORDER BY t_begin, q_begin, length) - 1 AS k FROM {_runs_sql(None)}),
e AS (SELECT x.ref, x.qry, x.k AS a, y.k AS b FROM m x JOIN m y ON y.ref = x.ref AND y.qry = x.qry AND y.k > x.k AND y.r - x.r - x.n <= 90 AND abs(y.q - y.r - x.q + x.r) <= greatest(5, CAST(trunc(0.12 * (y.r - x.r - x.n)) AS BIGINT))),
u AS (SELECT ref, qry, a, b FROM e UNION ALL SELECT ref, qry, b, a FROM e),
c(ref, qry, k, x) AS (SELECT ref, qry, k, k FROM m UNION SELECT c.ref, c.qry, c.k, u.b FROM c JOIN u ON u.ref = c.ref AND u.qry = c.qry AND u.a = c.x),
l AS (SELECT ref, qry, k, min(x) AS cluster FROM c GROUP BY ref, qry, k)
SELECT ref, qry, cluster, count(*) AS n, CAST(sum(n) AS BIGINT) AS total, min(r) AS s_r, max(r + n) AS e_r, min(q) AS s_q, max(q + n) AS e_q FROM l JOIN m USING (ref, qry, k) GROUP BY ref, qry, cluster HAVING sum(n) >= 20""")
def match_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = maximal_matches_all(spark, sf_dir).select(F.col("t").alias("ref"), F.col("q").alias("qry"), F.col("t_begin").cast("long").alias("r"), F.col("q_begin").cast("long").alias("q"), "length")
    return alignment_sets.clusters(found, least=20)


@query("""WITH w AS (SELECT l_suppkey AS g, l_orderkey * 8 + l_linenumber AS id, date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) AS lo, date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) + CAST(l_quantity AS INTEGER) AS hi FROM lineitem),
f AS (SELECT *, max(hi) OVER (PARTITION BY g ORDER BY lo, hi DESC, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM w)
SELECT g, id, lo, hi FROM f WHERE far >= hi""")
def contained_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.datediff(F.to_date("l_shipdate"), F.lit("1990-01-01").cast("date"))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("g"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), day.alias("lo"), (day + F.col("l_quantity").cast("int")).alias("hi"))
    return overlap.containments(rows, ["g"], "lo", "hi", "id")


PATHS = "(SELECT c_custkey AS id, list(o_orderkey % 40 ORDER BY o_orderkey) AS units FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey UNION ALL SELECT -1 - s_suppkey, [s_suppkey % 40, (s_suppkey * 7) % 40] FROM supplier)"


@query(f"""WITH p AS (SELECT id AS within, units AS l, unnest(units) AS first, unnest(range(1, len(units) + 1)) AS k FROM {PATHS})
SELECT s.id, min(within) AS within FROM {PATHS} s JOIN p ON p.first = s.units[1] AND len(s.units) < len(p.l) AND p.l[k : k + len(s.units) - 1] = s.units GROUP BY s.id""")
def super_read_reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda x: x % 40).alias("units"))
    own = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")).join(orders, "id")
    short = table(spark, sf_dir, "supplier").select((-1 - F.col("s_suppkey")).alias("id"), F.array(F.col("s_suppkey") % 40, (F.col("s_suppkey") * 7) % 40).alias("units"))
    return overlap.super_read_contained(own.unionByName(short))


CHILD = "(SELECT l_orderkey * 8 + l_linenumber AS frg, l_orderkey AS ctg, CAST(l_linenumber * 20 AS BIGINT) AS bgn, CAST(l_linenumber * 20 + l_quantity AS BIGINT) AS e, CASE WHEN l_linestatus = 'F' THEN 'f' ELSE 'r' END AS ori FROM lineitem)"
PARENT = "(SELECT o_orderkey AS ctg, o_custkey AS scf, CAST(o_orderkey * 100 AS BIGINT) AS bgn, CAST(o_orderkey * 100 + 400 AS BIGINT) AS e, CASE WHEN o_orderstatus = 'O' THEN 'r' ELSE 'f' END AS ori FROM orders)"
PROJECTED = f"(SELECT frg, scf, CASE WHEN p.ori = 'f' THEN p.bgn + c.bgn ELSE p.e - c.e END AS bgn, CASE WHEN p.ori = 'f' THEN p.bgn + c.e ELSE p.e - c.bgn END AS e, CASE WHEN c.ori = p.ori THEN 'f' ELSE 'r' END AS ori FROM {CHILD} c JOIN {PARENT} p USING (ctg))"


def _places(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    n = F.col("l_linenumber") * 20
    child = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("frg"), F.col("l_orderkey").alias("ctg"), n.cast("long").alias("bgn"), (n + F.col("l_quantity")).cast("long").alias("end"), F.when(F.col("l_linestatus") == "F", "f").otherwise("r").alias("ori"))
    at = F.col("o_orderkey") * 100
    parent = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ctg"), F.col("o_custkey").alias("scf"), at.cast("long").alias("bgn"), (at + 400).cast("long").alias("end"), F.when(F.col("o_orderstatus") == "O", "r").otherwise("f").alias("ori"))
    return child, parent


@query(f'SELECT frg, scf, bgn, e AS "end", ori FROM {PROJECTED}')
def posmap_compose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.projected(*_places(spark, sf_dir), ("frg", "ctg", "scf"))


@query(f'SELECT frg, ctg, CASE WHEN p.ori = \'f\' THEN c.bgn - p.bgn ELSE p.e - c.e END AS bgn, CASE WHEN p.ori = \'f\' THEN c.e - p.bgn ELSE p.e - c.bgn END AS "end" FROM {PROJECTED} c JOIN {PARENT} p ON c.scf = p.scf AND c.bgn >= p.bgn AND c.e <= p.e')
def posmap_demote(spark: SparkSession, sf_dir: str) -> DataFrame:
    child, parent = _places(spark, sf_dir)
    return overlap.demoted(overlap.projected(child, parent, ("frg", "ctg", "scf")), parent, ("frg", "ctg", "scf"))


_D = DAY.format("l_shipdate")
ALIGNMENTS = f"""(SELECT aln, ref, qry, s_r, s_r + n AS e_r, CASE WHEN back THEN s_q + n ELSE s_q END AS s_q, CASE WHEN back THEN s_q ELSE s_q + n END AS e_q, idy FROM (
  SELECT l_orderkey * 8 + l_linenumber AS aln, min(l_suppkey) AS ref, min(l_partkey) % 50 AS qry, CAST(min({_D}) * 10 AS BIGINT) AS s_r, CAST(max(l_quantity) * 4 AS BIGINT) AS n, CAST(max({_D}) * 9 AS BIGINT) AS s_q, max(l_linestatus) = 'O' AS back, 90 + max(l_discount) * 100 AS idy FROM lineitem GROUP BY 1))"""


def aligned(spark, sf_dir) -> DataFrame:
    day = F.datediff(F.to_date("l_shipdate"), F.lit("1990-01-01").cast("date"))
    rows = table(spark, sf_dir, "lineitem").groupBy((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("aln")).agg(
        F.min("l_suppkey").alias("ref"), (F.min("l_partkey") % 50).alias("qry"), (F.min(day) * 10).cast("long").alias("s_r"), (F.max("l_quantity") * 4).cast("long").alias("n"), (F.max(day) * 9).cast("long").alias("q"), (F.max("l_linestatus") == "O").alias("back"), (90 + F.max("l_discount") * 100).alias("idy")
    )
    far = F.col("q") + F.col("n")
    return rows.select("aln", "ref", "qry", "s_r", (F.col("s_r") + F.col("n")).alias("e_r"), F.when(F.col("back"), far).otherwise(F.col("q")).alias("s_q"), F.when(F.col("back"), F.col("q")).otherwise(far).alias("e_q"), "idy")


@query(f"SELECT aln, ref, qry FROM {ALIGNMENTS} WHERE idy >= 95 AND abs(e_r - s_r) + 1 >= 60 AND abs(e_q - s_q) + 1 >= 60")
def alignment_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_sets.filter_simple(aligned(spark, sf_dir), 95, 60).select("aln", "ref", "qry")


def _share_sql(rows: str, name: str, lo: str, hi: str) -> str:
    return f"""(WITH a AS (SELECT aln, {name} AS name, least({lo}, {hi}) AS lo, greatest({lo}, {hi}) + 1 AS hi FROM {rows}),
e AS (SELECT name, lo AS x, 1 AS d, aln AS k FROM a UNION ALL SELECT name, hi, -1, -aln FROM a), s AS (SELECT name, x, sum(d) AS d, sum(k) AS k FROM e GROUP BY name, x),
r AS (SELECT sum(d) OVER w AS depth, sum(k) OVER w AS aln, lead(x) OVER (PARTITION BY name ORDER BY x) - x AS n FROM s WINDOW w AS (PARTITION BY name ORDER BY x)),
u AS (SELECT aln, sum(n) AS n FROM r WHERE depth = 1 GROUP BY aln)
SELECT a.aln, 100.0 * coalesce(n, 0) / (hi - lo) AS share FROM a LEFT JOIN u ON a.aln = u.aln)"""


@query(f"SELECT aln, round(share, 6) AS share FROM {_share_sql(ALIGNMENTS, 'ref', 's_r', 'e_r')}")
def alignment_unique_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_sets.unique_share(aligned(spark, sf_dir), "ref", "s_r", "e_r", "aln").select("aln", F.round("share", 6).alias("share"))


_KEPT = f"(SELECT x.* FROM {ALIGNMENTS} x WHERE aln IN (SELECT aln FROM {_share_sql(ALIGNMENTS, 'ref', 's_r', 'e_r')} WHERE share >= 10))"


@query(f"SELECT aln, ref, qry FROM {_KEPT} WHERE aln IN (SELECT aln FROM {_share_sql(_KEPT, 'qry', 's_q', 'e_q')} WHERE share >= 10)")
def alignment_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_sets.filter_unique(aligned(spark, sf_dir), 10).select("aln", "ref", "qry")


@query(f"SELECT aln FROM {ALIGNMENTS} WHERE (ref, qry) IN (SELECT DISTINCT s_suppkey, s_nationkey FROM supplier)")
def alignment_allowed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    allowed = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("ref"), F.col("s_nationkey").cast("long").alias("qry"))
    return aligned(spark, sf_dir).join(allowed, ["ref", "qry"], "left_semi").select("aln")


def _chain_sql(side: str) -> str:
    """The alignments of the best chain of each sequence of a side: a fold over
    lists of scores and of the places before, and the way back from the best."""
    lo, hi = ("s_r", "e_r") if side == "ref" else ("least(s_q, e_q)", "greatest(s_q, e_q)")
    overlap = "greatest(0, his[j] - lo + 1)"
    fits = f"{overlap} = 0 OR (hi > his[j] AND {overlap} <= hi - lo + 1 AND {overlap} <= his[j] - los[j] + 1)"
    return f"""(WITH RECURSIVE a AS (SELECT aln, {side} AS g, {lo} AS lo, {hi} AS hi, (idy / 100) * (idy / 100) AS w FROM {ALIGNMENTS}),
o AS (SELECT g, list(lo ORDER BY lo, hi, aln) AS los, list(hi ORDER BY lo, hi, aln) AS his, list(aln ORDER BY lo, hi, aln) AS ks, list(w ORDER BY lo, hi, aln) AS ws FROM a GROUP BY g),
t(g, i, sc, bf) AS (SELECT g, 0, CAST([] AS BIGINT[]), CAST([] AS BIGINT[]) FROM o UNION ALL SELECT g, i + 1, list_append(sc, CASE WHEN m > own THEN m ELSE own END), list_append(bf, CASE WHEN m > own THEN list_position(c, m) ELSE 0 END) FROM (
  SELECT *, coalesce(list_max(c), -1) AS m FROM (SELECT g, i, sc, bf, CAST(trunc((hi - lo + 1) * w) AS BIGINT) AS own, list_transform(range(1, i + 1), lambda j: CASE WHEN {fits} THEN sc[j] + CAST(trunc((hi - lo + 1 - {overlap}) * w) AS BIGINT) ELSE -1 END) AS c
  FROM (SELECT t.g, i, sc, bf, los, his, los[i + 1] AS lo, his[i + 1] AS hi, ws[i + 1] AS w FROM t JOIN o ON o.g = t.g WHERE i < len(los))))),
f AS (SELECT t.g, sc, bf, ks FROM t JOIN o ON o.g = t.g WHERE i = len(los)),
b(g, x) AS (SELECT g, list_position(sc, list_max(sc)) FROM f UNION ALL SELECT b.g, bf[x] FROM b JOIN f ON f.g = b.g WHERE bf[x] > 0)
SELECT ks[x] AS aln FROM b JOIN f ON f.g = b.g)"""


@query(f"SELECT aln FROM {_chain_sql('ref')}")
def alignment_best_chain_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_sets.best_chain(aligned(spark, sf_dir), "ref")


ONE_TO_ONE = f"(SELECT aln FROM {_chain_sql('ref')} WHERE aln IN (SELECT aln FROM {_chain_sql('qry')}))"


@query(f"SELECT aln FROM {ONE_TO_ONE}")
def alignment_one_to_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_sets.one_to_one(aligned(spark, sf_dir)).select("aln")


@query(f"SELECT aln FROM {_chain_sql('ref')} UNION SELECT aln FROM {_chain_sql('qry')}")
def alignment_many_to_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_sets.many_to_many(aligned(spark, sf_dir)).select("aln")


@query(f"""WITH p AS (SELECT DISTINCT ref, s_r AS pos FROM {ALIGNMENTS}), b AS (SELECT ref, pos, pos - lag(pos) OVER w AS x, lead(pos) OVER w - pos AS y FROM p WINDOW w AS (PARTITION BY ref ORDER BY pos))
SELECT ref, pos, least(x, y, pos, 60000 + s_nationkey - pos + 1) AS buffer FROM b JOIN supplier ON s_suppkey = ref""")
def snp_buffers(spark: SparkSession, sf_dir: str) -> DataFrame:
    snps = aligned(spark, sf_dir).select("ref", F.col("s_r").alias("pos")).distinct()
    sizes = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("ref"), (60_000 + F.col("s_nationkey")).alias("size"))
    return alignment_sets.snp_buffers(snps, sizes)


@query(f"""WITH a AS (SELECT *, s_q <= e_q AS fwd FROM {ALIGNMENTS}),
p AS (SELECT *, lag(qry) OVER w AS pq, lag(e_r) OVER w AS per, lag(e_q) OVER w AS peq, lag(fwd) OVER w AS pf FROM a WINDOW w AS (PARTITION BY ref ORDER BY s_r, e_r, qry, s_q, aln))
SELECT kind, count(*) AS n FROM (SELECT CASE WHEN pq <> qry THEN 'SEQ' WHEN pf <> fwd THEN 'INV' WHEN CASE WHEN fwd THEN s_q <= peq - 1000 ELSE s_q >= peq + 1000 END THEN 'JMP' WHEN s_r - per - 1 < 0 THEN 'DUP' ELSE 'GAP' END AS kind FROM p WHERE pq IS NOT NULL) GROUP BY kind""")
def structural_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_sets.structural_breaks(aligned(spark, sf_dir)).groupBy("kind").agg(F.count("*").alias("n"))


@query(f"""SELECT aln, abs(e_r - s_r) + 1 AS len_r, abs(e_q - s_q) + 1 AS len_q, 100.0 * (abs(e_r - s_r) + 1) / (5000 + s_nationkey) AS cov_r, 100.0 * (abs(e_q - s_q) + 1) / (4000 + qry) AS cov_q FROM {ALIGNMENTS} JOIN supplier ON s_suppkey = ref""")
def alignment_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("ref"), (5000 + F.col("s_nationkey")).alias("r_size"))
    qrys = spark.range(50).select(F.col("id").alias("qry"), (4000 + F.col("id")).alias("q_size"))
    return alignment_sets.coverage_report(aligned(spark, sf_dir), refs, qrys).select("aln", "len_r", "len_q", "cov_r", "cov_q")


@query(f"""WITH w AS (SELECT qry, ref, sum((abs(e_r - s_r) + 1) * idy / 100) AS weight, sum((abs(e_r - s_r) + 1) * idy / 100 * (s_r + e_r) / 2) / sum((abs(e_r - s_r) + 1) * idy / 100) AS place FROM {ALIGNMENTS} GROUP BY qry, ref)
SELECT qry, ref, round(weight, 6) AS weight, round(place, 4) AS place FROM (SELECT *, row_number() OVER (PARTITION BY qry ORDER BY round(weight, 6) DESC, ref) AS k FROM w) WHERE k = 1""")
def alignment_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_sets.assignments(aligned(spark, sf_dir)).select("qry", "ref", F.round("weight", 6).alias("weight"), F.round("place", 4).alias("place"))


@query(f"SELECT count(*) AS n_alignments, count(DISTINCT ref) AS n_refs, count(DISTINCT qry) AS n_qrys, CAST(sum(abs(e_r - s_r) + 1) AS BIGINT) AS aligned_r, CAST(sum(abs(e_q - s_q) + 1) AS BIGINT) AS aligned_q, sum((abs(e_r - s_r) + 1) * idy) / sum(abs(e_r - s_r) + 1) AS identity FROM {ALIGNMENTS}")
def alignment_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_sets.difference_report(aligned(spark, sf_dir))


@query(f"SELECT id, count(*) AS n_kmers, count(*) FILTER (WHERE c.kmer IS NOT NULL) AS n_found FROM {dna_sql('benchmark', k=10)} b LEFT JOIN (SELECT DISTINCT kmer FROM {dna_sql(k=10)}) c ON c.kmer = b.kmer GROUP BY id")
def kmer_coverage_of_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = kmer.enumerate_kmers(seqs(spark, sf_dir, "benchmark"), 10, keep=("id",))
    found = kmer.enumerate_kmers(seqs(spark, sf_dir), 10).distinct().withColumn("found", F.lit(1))
    return items.join(found, "kmer", "left").groupBy("id").agg(F.count("*").alias("n_kmers"), F.count("found").alias("n_found"))
