"""Layouts, placements, trims and scaffolds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sequence import reverse_complement
from ..operators import fasta, interval, kmer, layouts, overlap
from .assembly_queries import EDGES, edges
from .kmer_queries import dna_sql, seqs
from .overlap_queries import ALIGNMENTS, BEST, CHILD, PARENT, _places, aligned, best
from .record_queries import DOCS, GAPPED, SHIP, gapped, ships
from .registry import query, table

RC = "reverse(translate({0}, 'ACGT', 'TGCA'))"


@query(f"SELECT qry, s_q, e_q, ref, s_r, e_r FROM {ALIGNMENTS} WHERE idy >= 97 AND (qry <> ref OR (abs(s_q - s_r) > 100 AND abs(e_q - e_r) > 100))")
def repeats_of_self_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layouts.self_hits(aligned(spark, sf_dir), 97)


FLIPPED = "(SELECT l_partkey % 100 AS a, l_suppkey AS b, CAST(l_quantity AS INTEGER) - 25 AS a_hang, CAST(l_linenumber AS INTEGER) * 3 - 10 AS b_hang, l_linestatus = 'O' AS flipped FROM lineitem)"


@query(f"SELECT DISTINCT unnest([a, b]) AS iid FROM {FLIPPED} WHERE flipped AND a_hang >= 0 AND b_hang >= 0 AND b = CASE WHEN a % 2 = 0 THEN a + 1 ELSE a - 1 END")
def mates_that_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 100).alias("a_iid"), F.col("l_suppkey").alias("b_iid"), (F.col("l_quantity").cast("int") - 25).alias("a_hang"), (F.col("l_linenumber").cast("int") * 3 - 10).alias("b_hang"), (F.col("l_linestatus") == "O").alias("flipped"))
    iid = F.col("id")
    mates = spark.range(100).select(iid.alias("iid"), F.when(iid % 2 == 0, iid + 1).otherwise(iid - 1).alias("mate"))
    return layouts.overlapping_mates(rows, mates)


@query(f"""WITH t AS (SELECT id, seq, CASE WHEN id % 3 = 0 THEN CAST(id % 20 AS INTEGER) ELSE 0 END AS f, CASE WHEN id % 3 = 0 THEN CAST(id % 7 AS INTEGER) ELSE 0 END AS b FROM {DOCS})
SELECT id, substr(seq, f + 1, greatest(length(seq) - f - b, 0)) AS seq FROM t WHERE length(seq) - f - b >= 100""")
def reads_trimmed_at_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    trims = table(spark, sf_dir, "documents").where("doc_id % 3 = 0").select(F.col("doc_id").alias("id"), (F.col("doc_id") % 20).cast("int").alias("front"), (F.col("doc_id") % 7).cast("int").alias("back"))
    return layouts.trimmed(seqs(spark, sf_dir).select("id", "seq"), trims, 100)


@query(f"""WITH b AS (SELECT DISTINCT doc_id AS id, CAST(unnest([50 + doc_id % 30, 400 + doc_id % 90, 401 + doc_id % 90, 2000]) AS INTEGER) AS x FROM documents),
g AS (SELECT b.id, x FROM b JOIN {GAPPED} s ON s.id = b.id WHERE x < length(seq) AND NOT contains(upper(substr(seq, greatest(x - 3, 0) + 1, least(x, 3) + 3)), 'N')),
p AS (SELECT doc_id AS id, 0 AS "offset" FROM documents WHERE text IS NOT NULL UNION SELECT id, x FROM g)
SELECT p.id, p."offset", substr(seq, p."offset" + 1, coalesce(lead(p."offset") OVER (PARTITION BY p.id ORDER BY p."offset"), length(seq)) - p."offset") AS seq FROM p JOIN {GAPPED} s ON s.id = p.id""")
def contigs_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contigs cut at break points that are not near a gap."""
    i = F.col("doc_id")
    at = F.array(50 + i % 30, 400 + i % 90, 401 + i % 90, F.lit(2000).cast("long"))
    breaks = table(spark, sf_dir, "documents").select(i.alias("id"), F.explode(at.cast("array<int>")).alias("at"))
    return layouts.broken(gapped(spark, sf_dir).select("id", "seq").where("seq is not null"), breaks, 3)


_PAIRS = "(SELECT l_partkey % 3000 AS pair, CASE WHEN l_linenumber % 2 = 0 THEN 'F' ELSE 'R' END AS mate, l_orderkey AS ctg, CASE WHEN l_linestatus = 'F' THEN 'f' ELSE 'r' END AS ori FROM lineitem)"


@query(f"""WITH n AS (SELECT scf, lag(ctg) OVER w AS a, lag(ori) OVER w AS ao, ctg AS b, ori AS bo FROM {PARENT} WINDOW w AS (PARTITION BY scf ORDER BY bgn, ctg)),
e AS (SELECT scf, a, ao, b, bo FROM n WHERE a IS NOT NULL UNION ALL SELECT scf, b, translate(bo, 'fr', 'rf'), a, translate(ao, 'fr', 'rf') FROM n WHERE a IS NOT NULL)
SELECT DISTINCT x.pair, e.scf FROM {_PAIRS} x JOIN {_PAIRS} y ON x.pair = y.pair AND x.mate = 'F' AND y.mate = 'R' JOIN e ON e.a = x.ctg AND e.ao = x.ori AND e.b = y.ctg AND e.bo = translate(y.ori, 'fr', 'rf')""")
def mates_over_scaffold_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, parent = _places(spark, sf_dir)
    i = table(spark, sf_dir, "lineitem")
    reads = i.select((F.col("l_partkey") % 3000).alias("pair"), F.when(F.col("l_linenumber") % 2 == 0, "F").otherwise("R").alias("mate"), F.col("l_orderkey").alias("ctg"), F.when(F.col("l_linestatus") == "F", "f").otherwise("r").alias("ori"))
    return layouts.spanning_mates(parent.select("ctg", "scf", "bgn", "ori"), reads)


_SCAFFOLDED = f"(SELECT id % 50 AS scf, id, CASE WHEN id % 3 = 0 THEN 'r' ELSE 'f' END AS ori, seq FROM {DOCS} WHERE seq <> '')"


@query(f"SELECT scf, length(s) AS n, md5(s) AS digest FROM (SELECT scf, string_agg(CASE WHEN ori = 'r' THEN {RC.format('seq')} ELSE seq END, repeat('N', 100) ORDER BY id) AS s FROM {_SCAFFOLDED} GROUP BY scf)")
def scaffolds_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaffolds from their contigs, gaps of 100 letters."""
    i = F.col("id")
    rows = seqs(spark, sf_dir).where("seq <> ''").select((i % 50).alias("scf"), i.alias("place"), F.when(i % 3 == 0, "r").otherwise("f").alias("ori"), "seq")
    return layouts.scaffold_sequences(rows).select("scf", F.length("seq").cast("long").alias("n"), F.md5("seq").alias("digest"))


@query(f"""WITH c AS (SELECT id % 50 AS scf, id, length(seq) AS size, row_number() OVER w AS k, coalesce(sum(length(seq) + 100) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS x FROM {DOCS} WHERE seq <> '' WINDOW w AS (PARTITION BY id % 50 ORDER BY id))
SELECT scf, CAST(2 * k - 1 AS INTEGER) AS part, CAST(x + 1 AS BIGINT) AS bgn, CAST(x + size AS BIGINT) AS "end", 'W' AS kind, CAST(id AS VARCHAR) AS component FROM c
UNION ALL SELECT scf, CAST(2 * k - 2 AS INTEGER), CAST(x - 99 AS BIGINT), CAST(x AS BIGINT), 'N', NULL FROM c WHERE k > 1""")
def scaffold_agp(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("id")
    return layouts.agp(seqs(spark, sf_dir).where("seq <> ''").select((i % 50).alias("scf"), i.alias("place"), i.alias("ctg"), F.length("seq").alias("size")))


@query(f"""WITH x AS (SELECT grp, lo + 4 AS lo, hi - 4 AS hi FROM {SHIP} WHERE hi - lo > 8),
f AS (SELECT *, max(hi) OVER (PARTITION BY grp ORDER BY lo, hi DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM x)
SELECT grp, far AS lo, lo AS hi FROM f WHERE lo > far""")
def long_read_coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layouts.coverage_gaps(ships(spark, sf_dir), ["grp"], 4)


@query(f"""WITH v AS (SELECT s_suppkey AS grp, s_suppkey * 10 + k AS var, 3000 + 40 * k AS v_lo, 3000 + 40 * k + s_nationkey % 9 + 1 AS v_hi FROM supplier, unnest([0, 1, 2, 3, 4]) AS t(k))
SELECT v.grp, v.var, count(*) FILTER (WHERE s.lo < v_hi AND v_lo < s.hi AND s.lo <= v_lo AND s.hi >= v_hi) AS complete, count(*) FILTER (WHERE s.lo < v_hi AND v_lo < s.hi AND NOT (s.lo <= v_lo AND s.hi >= v_hi)) AS partial
FROM v LEFT JOIN {SHIP} s ON s.grp = v.grp AND s.hi > s.lo GROUP BY v.grp, v.var""")
def fragments_in_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.explode(F.sequence(F.lit(0), F.lit(4)))
    v = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("grp"), "s_nationkey", k.alias("k"))
    v = v.select("grp", (F.col("grp") * 10 + F.col("k")).alias("var"), (3000 + 40 * F.col("k")).alias("v_lo"), (3001 + 40 * F.col("k") + F.col("s_nationkey") % 9).alias("v_hi"))
    return layouts.variants_in_reads(v, ships(spark, sf_dir), ["grp"], 64)


@query("SELECT l_partkey AS utg FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) = count(*) AND count(*) < 30 AND sum(l_quantity) >= 700")
def surrogates_to_toggle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unitigs whose placements are all in different contigs, that are few, and that are large enough to be taken as unique."""
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("utg")).agg(F.countDistinct("l_suppkey").alias("d"), F.count("*").alias("n"), F.sum("l_quantity").alias("size")).where("d = n and n < 30 and size >= 700").select("utg")


@query(f"""SELECT l_returnflag AS lib, count(*) FILTER (WHERE n IS NULL) AS singletons, count(*) FILTER (WHERE n = 1) AS spurs, count(*) FILTER (WHERE n = 2) AS dovetails
FROM (SELECT l_partkey % 100 AS a_iid, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY 1) r LEFT JOIN (SELECT a_iid, count(*) AS n FROM {BEST} GROUP BY a_iid) b USING (a_iid) GROUP BY 1""")
def best_overlaps_by_library(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per library how many reads have best overlaps at none, one or both of their ends."""
    n = best(spark, sf_dir).groupBy("a_iid").agg(F.count("*").alias("n"))
    r = table(spark, sf_dir, "lineitem").groupBy((F.col("l_partkey") % 100).alias("a_iid")).agg(F.min("l_returnflag").alias("lib"))
    return r.join(n, "a_iid", "left").groupBy("lib").agg(F.count_if(F.col("n").isNull()).alias("singletons"), F.count_if(F.col("n") == 1).alias("spurs"), F.count_if(F.col("n") == 2).alias("dovetails"))


@query("SELECT p_partkey AS read FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def reads_not_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("read")).distinct()
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("read")).join(placed, "read", "left_anti")


LARGEST = """(WITH f AS (SELECT grp, lo, hi, max(hi) OVER (PARTITION BY grp ORDER BY lo, hi DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM {0}),
g AS (SELECT *, sum(CASE WHEN far IS NULL OR NOT (hi <= far OR far - {1} >= lo) THEN 1 ELSE 0 END) OVER (PARTITION BY grp ORDER BY lo, hi DESC ROWS UNBOUNDED PRECEDING) AS i FROM f),
m AS (SELECT grp, i, min(lo) AS lo, max(hi) AS hi FROM g GROUP BY grp, i)
SELECT grp, lo, hi FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY hi - lo DESC, lo) AS k FROM m) WHERE k = 1)"""
_FEW = f"(SELECT * FROM {SHIP} WHERE (lo + grp) % 16 = 0)"


@query(f"SELECT * FROM {LARGEST.format(SHIP, 5)}")
def trim_largest_covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layouts.largest_covered(ships(spark, sf_dir), ["grp"], 5)


@query(f"""WITH c AS (SELECT * FROM {LARGEST.format(SHIP, 25)}), r AS (SELECT s_suppkey AS iid, 900 + s_nationkey AS bgn, 3000 - s_nationkey AS e, s_suppkey % 3 <> 0 AS covered FROM supplier),
t AS (SELECT iid, bgn, e, covered, lo, CASE WHEN covered THEN greatest(bgn, lo) ELSE bgn END AS b2, CASE WHEN covered THEN least(e, hi) ELSE e END AS e2 FROM r LEFT JOIN c ON grp = iid),
d AS (SELECT *, (covered AND lo IS NULL) OR e2 - b2 < 1200 AS deleted FROM t)
SELECT iid, CASE WHEN deleted THEN bgn ELSE b2 END AS bgn, CASE WHEN deleted THEN e ELSE e2 END AS "end", deleted FROM d""")
def trim_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    covered = layouts.largest_covered(ships(spark, sf_dir), ["grp"], 25).withColumnRenamed("grp", "iid")
    nation = F.col("s_nationkey")
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("iid"), (900 + nation).alias("bgn"), (3000 - nation).alias("end"), F.when(F.col("s_suppkey") % 3 != 0, "covered").otherwise("as it is").alias("how"))
    return layouts.final_trim(rows, covered, 1200)


@query("SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)")
def links_without_removed_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links that do not name a removed fragment."""
    gone = table(spark, sf_dir, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("l_suppkey"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey").join(gone, "l_suppkey", "left_anti")


@query(f"""WITH g AS (SELECT *, lo - lag(hi) OVER (PARTITION BY grp ORDER BY lo, hi) AS gap FROM {SHIP}), r AS (SELECT *, sum(CASE WHEN gap BETWEEN -12 AND 2 THEN 0 ELSE 1 END) OVER (PARTITION BY grp ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS run FROM g)
SELECT grp, min(lo) AS lo, max(hi) AS hi, count(*) AS n FROM r GROUP BY grp, run""")
def mega_reads_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mega-reads of a long read that follow one another with small gaps or overlaps, as one."""
    return layouts.islands(ships(spark, sf_dir), ["grp"], -12, 2)


@query(f"""WITH s AS (SELECT qry, ref, CASE WHEN s_q <= e_q THEN 'F' ELSE 'R' END AS ori, least(s_q, e_q) AS lo, greatest(s_q, e_q) AS hi, aln FROM {ALIGNMENTS}),
n AS (SELECT ref AS a, ori AS ao, lead(ref) OVER w AS b, lead(ori) OVER w AS bo, lead(lo) OVER w - hi AS gap FROM s WINDOW w AS (PARTITION BY qry ORDER BY lo, hi, aln)),
o AS (SELECT CASE WHEN a > b THEN b ELSE a END AS a, CASE WHEN a > b THEN translate(bo, 'FR', 'RF') ELSE ao END AS a_ori, CASE WHEN a > b THEN a ELSE b END AS b, CASE WHEN a > b THEN translate(ao, 'FR', 'RF') ELSE bo END AS b_ori, gap FROM n WHERE a <> b AND gap BETWEEN -150 AND 500)
SELECT a, a_ori, b, b_ori, count(*) AS n, avg(gap) AS gap FROM o GROUP BY ALL""")
def contig_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contigs that stand side by side along long reads."""
    return layouts.merges(aligned(spark, sf_dir), -150, 500)


_LINKS = "(SELECT o_custkey AS a, o_custkey + 1 + o_orderkey % 5 AS b, count(*) AS n FROM orders GROUP BY ALL)"
_BEST_LINKS = f"(SELECT a, b, n FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY n DESC, b) AS o, row_number() OVER (PARTITION BY b ORDER BY n DESC, a) AS i FROM {_LINKS}) WHERE o = 1 AND i = 1)"


def _links(spark, sf_dir) -> DataFrame:
    a = F.col("o_custkey")
    return table(spark, sf_dir, "orders").groupBy(a.alias("a"), (a + 1 + F.col("o_orderkey") % 5).alias("b")).agg(F.count("*").alias("n"))


@query(f"SELECT * FROM {_BEST_LINKS}")
def scaffold_best_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layouts.best_links(_links(spark, sf_dir))


@query(f"""WITH RECURSIVE e AS (SELECT a, b FROM {_BEST_LINKS}), r(node, path, place) AS (SELECT a, a, 0 FROM e WHERE a NOT IN (SELECT b FROM e) UNION ALL SELECT e.b, r.path, r.place + 1 FROM r JOIN e ON e.a = r.node)
SELECT node, path, CAST(place AS BIGINT) AS place FROM r""")
def scaffolds_from_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contigs in the chains that their mutually best links make."""
    return layouts.merged_contigs(_links(spark, sf_dir))


_ENDS = "(SELECT p_partkey AS id, p_partkey * 3 AS first, CASE WHEN p_size % 5 = 0 THEN p_partkey * 3 ELSE (p_partkey + 1 + p_size % 3) * 3 END AS last FROM part)"


@query(f"""WITH RECURSIVE s AS (SELECT * FROM {_ENDS} WHERE first <> last), l AS (SELECT last AS unit, min(id) AS a FROM s GROUP BY last HAVING count(*) = 1), f AS (SELECT first AS unit, min(id) AS b FROM s GROUP BY first HAVING count(*) = 1),
e AS (SELECT a, b FROM l JOIN f USING (unit) WHERE a <> b), r(id, chain, place) AS (SELECT id, id, 0 FROM {_ENDS} WHERE id NOT IN (SELECT b FROM e) UNION ALL SELECT e.b, r.chain, r.place + 1 FROM r JOIN e ON e.a = r.id)
SELECT id, chain, CAST(place AS BIGINT) AS place FROM r""")
def super_reads_merged_uniquely(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, size = F.col("p_partkey"), F.col("p_size")
    rows = table(spark, sf_dir, "part").select(p.alias("id"), (p * 3).alias("first"), F.when(size % 5 == 0, p * 3).otherwise((p + 1 + size % 3) * 3).alias("last"))
    return layouts.merged_uniquely(rows)


@query(f"""WITH u AS (SELECT id AS unit, left(seq, 60) AS seq FROM {DOCS} WHERE length(seq) >= 60), p AS (SELECT id // 5 AS sr, id AS unit, CASE WHEN id % 4 = 0 THEN 'R' ELSE 'F' END AS ori, row_number() OVER (PARTITION BY id // 5 ORDER BY id) AS k FROM {DOCS} WHERE length(seq) >= 60),
s AS (SELECT sr, k, CASE WHEN ori = 'R' THEN {RC.format('seq')} ELSE seq END AS s FROM p JOIN u USING (unit))
SELECT sr AS id, string_agg(CASE WHEN k = 1 THEN s ELSE substr(s, 15) END, '' ORDER BY k) AS seq FROM s GROUP BY sr""")
def super_read_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of super-reads from their k-unitigs, which overlap by k - 1."""
    rows = seqs(spark, sf_dir).where("length(seq) >= 60")
    units = rows.select(F.col("id").alias("unit"), F.left("seq", F.lit(60)).alias("seq"))
    paths = rows.select(F.floor(F.col("id") / 5).alias("id"), F.col("id").alias("place"), F.col("id").alias("unit"), F.when(F.col("id") % 4 == 0, "R").otherwise("F").alias("ori"))
    return layouts.assembled_super_reads(paths, units, 15)


_REDUCED = "(SELECT p_partkey AS containee, p_partkey % 7 + 1000000 AS container, CASE WHEN p_size % 2 = 0 THEN 'F' ELSE 'R' END AS ori, p_size AS \"offset\" FROM part WHERE p_partkey % 3 = 0)"


@query(f"""SELECT l_orderkey * 8 + l_linenumber AS read, coalesce(container, l_partkey) AS sr, CAST(CASE WHEN ori = 'F' THEN l_linenumber + r."offset" WHEN ori = 'R' THEN r."offset" - l_linenumber ELSE l_linenumber END AS BIGINT) AS "offset",
CASE WHEN r.ori = 'R' THEN translate(CASE WHEN l_linestatus = 'F' THEN 'F' ELSE 'R' END, 'FR', 'RF') ELSE CASE WHEN l_linestatus = 'F' THEN 'F' ELSE 'R' END END AS ori FROM lineitem LEFT JOIN {_REDUCED} r ON containee = l_partkey""")
def placements_reduced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placements on contained super-reads, moved to their containers."""
    p, size = F.col("p_partkey"), F.col("p_size")
    reductions = table(spark, sf_dir, "part").where("p_partkey % 3 = 0").select(p.alias("containee"), (p % 7 + 1_000_000).alias("container"), F.when(size % 2 == 0, "F").otherwise("R").alias("ori"), size.alias("offset"))
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("read"), F.col("l_partkey").alias("sr"), F.col("l_linenumber").cast("long").alias("offset"), F.when(F.col("l_linestatus") == "F", "F").otherwise("R").alias("ori"))
    return layouts.reduced_placements(rows, reductions)


@query("WITH n AS (SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS k FROM customer) SELECT x.k AS a, y.k AS b FROM (SELECT DISTINCT c.c_name AS a, d.c_name AS b FROM orders JOIN customer c ON c.c_custkey = o_custkey JOIN customer d ON d.c_custkey = o_orderkey % 1000 + 1) JOIN n x ON x.c_name = a JOIN n y ON y.c_name = b")
def names_to_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in a table of pairs, as their places in the sorted list of all names."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name"))
    side = lambda k, n: c.select(F.col("c_custkey").alias(k), F.col("name").alias(n))
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("x"), (F.col("o_orderkey") % 1000 + 1).alias("y"))
    pairs = o.join(side("x", "a"), "x").join(side("y", "b"), "y").select("a", "b").distinct()
    return layouts.numbers_for_names(pairs, c, ["a", "b"])


@query(f"""WITH c AS (SELECT kmer, min(id) AS contig FROM {dna_sql('benchmark', k=10)} GROUP BY kmer HAVING count(DISTINCT id) = 1), v AS (SELECT r.id, contig, count(*) AS votes FROM {dna_sql(k=10)} r JOIN c USING (kmer) GROUP BY r.id, contig)
SELECT id, contig, votes FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY votes DESC, contig) AS k FROM v) WHERE k = 1 AND votes >= 3""")
def reads_to_contigs_by_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = kmer.enumerate_kmers(seqs(spark, sf_dir), 10, keep=("id",), clean=True)
    contigs = kmer.enumerate_kmers(seqs(spark, sf_dir, "benchmark"), 10, keep=("id",), clean=True).withColumnRenamed("id", "contig")
    return layouts.voted_contigs(reads, contigs, 3)


@query("SELECT source, id, row_number() OVER (ORDER BY key, source, id) - 1 AS place FROM (SELECT 'orders' AS source, o_orderkey AS id, o_totalprice AS key FROM orders UNION ALL SELECT 'customer', c_custkey, c_acctbal FROM customer)")
def merged_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sorted tables as one, in the order of a column."""
    rows = table(spark, sf_dir, "orders").select(F.lit("orders").alias("source"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("key"))
    rows = rows.unionByName(table(spark, sf_dir, "customer").select(F.lit("customer").alias("source"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("key")))
    return fasta.numbered(rows, ["key", "source", "id"]).select("source", "id", "place")


@query("SELECT bucket, o_orderkey AS id, row_number() OVER (PARTITION BY bucket ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) AS place FROM (SELECT o_orderkey, CAST(CAST('0x' || left(md5(CAST(o_orderkey AS VARCHAR)), 8) AS BIGINT) % 16 AS INTEGER) AS bucket FROM orders)")
def names_shuffled_in_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows grouped by a hash of their names, and in the order of the hashes inside."""
    from pyspark.sql import Window

    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    rows = rows.withColumn("bucket", layouts.hash_buckets(rows, "id", 16))
    w = Window.partitionBy("bucket").orderBy(F.md5(F.col("id").cast("string")), "id")
    return rows.select("bucket", "id", F.row_number().over(w).cast("long").alias("place"))


@query(f"""WITH RECURSIVE e AS (SELECT DISTINCT a, b FROM {EDGES}), q AS (SELECT c_custkey AS pair, c_custkey % 700 AS a, (c_custkey * 11) % 900 AS b FROM customer),
r(pair, goal, path) AS (SELECT pair, b, [a] FROM q UNION ALL SELECT r.pair, r.goal, list_append(r.path, e.b) FROM r JOIN e ON e.a = r.path[-1] WHERE len(r.path) < 4 AND NOT list_contains(r.path, e.b) AND (len(r.path) = 1 OR r.path[-1] <> r.goal)),
d AS (SELECT pair, path FROM r WHERE len(path) > 1 AND path[-1] = goal)
SELECT pair, count(*) AS n_paths, CASE WHEN count(*) = 1 THEN array_to_string(min(path), '_') END AS path FROM d GROUP BY pair""")
def mate_paths_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of reads between whose k-unitigs there are paths of at most three overlaps; the path, if it is the only one."""
    c = F.col("c_custkey")
    pairs = table(spark, sf_dir, "customer").select(c.alias("pair"), (c % 700).alias("a"), ((c * 11) % 900).alias("b"))
    out = layouts.bounded_paths(edges(spark, sf_dir), pairs, 3)
    return out.select("pair", "n_paths", F.array_join(F.col("path").cast("array<string>"), "_").alias("path"))


@query("""WITH m AS (SELECT c_mktsegment AS lib, CASE WHEN c_custkey % 7 <> 0 THEN c_custkey % 5 END AS c1, CASE WHEN c_custkey % 7 <> 0 THEN c_custkey % 2 END AS s1, CASE WHEN c_custkey % 11 <> 0 THEN c_custkey % 3 END AS c2, CASE WHEN c_custkey % 11 <> 0 THEN c_custkey % 4 END AS s2 FROM customer)
SELECT lib, count(*) FILTER (WHERE c1 = c2) AS same_contig, count(*) FILTER (WHERE c1 <> c2 AND s1 = s2) AS same_scaffold, count(*) FILTER (WHERE s1 <> s2) AS two_scaffolds, count(*) FILTER (WHERE (c1 IS NULL) <> (c2 IS NULL)) AS one_placed, count(*) FILTER (WHERE c1 IS NULL AND c2 IS NULL) AS none_placed FROM m GROUP BY lib""")
def library_fates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    on = lambda m, n: F.when(c % m != 0, c % n)
    return layouts.mate_fates(table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("lib"), on(7, 5).alias("c1"), on(7, 2).alias("s1"), on(11, 3).alias("c2"), on(11, 4).alias("s2")))


@query("""WITH w AS (SELECT l_suppkey AS a, l_partkey % 10 AS b, CAST(l_linenumber * 100 AS DOUBLE) AS gap, 1 / ((l_quantity + 50) * (l_quantity + 50)) AS w FROM lineitem), s AS (SELECT a, b, count(*) AS n, sum(w) AS w, sum(gap * w) AS wg, sum(gap * gap * w) AS wgg FROM w GROUP BY a, b)
SELECT a, b, n, round(wg / w, 6) AS gap, round(sqrt(1 / w), 6) AS sd, round(greatest(wgg - wg * wg / w, 0) / greatest(n - 1, 1), 4) AS chi2, greatest(wgg - wg * wg / w, 0) / greatest(n - 1, 1) < 6.63 AS merged FROM s""")
def link_estimates_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("a"), (F.col("l_partkey") % 10).alias("b"), (F.col("l_linenumber") * 100).cast("double").alias("gap"), (F.col("l_quantity") + 50).alias("sd"))
    return layouts.merged_estimates(rows).select("a", "b", "n", F.round("gap", 6).alias("gap"), F.round("sd", 6).alias("sd"), F.round("chi2", 4).alias("chi2"), "merged")


@query(f"""WITH z AS (SELECT range AS id, 2000 + range * 37 % 900 AS size FROM range(101)), l AS (SELECT qry, q.size, least(s_q, e_q) AS lo, greatest(s_q, e_q) AS hi FROM {ALIGNMENTS} JOIN z q ON q.id = qry JOIN z r ON r.id = ref WHERE r.size > q.size AND qry <> ref),
f AS (SELECT *, max(hi) OVER (PARTITION BY qry ORDER BY lo, hi DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM l),
n AS (SELECT qry, size, sum(hi - greatest(lo, coalesce(far, lo))) FILTER (WHERE far IS NULL OR hi > far) AS n FROM f GROUP BY qry, size) SELECT qry, n / size AS share FROM n WHERE n / size >= 0.6""")
def contigs_contained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contigs that alignments to longer ones cover: those to leave out."""
    sizes = spark.range(101).select("id", (2000 + F.col("id") * 37 % 900).alias("size"))
    return layouts.contained_contigs(aligned(spark, sf_dir), sizes, 0.6)


@query(f"SELECT id, left(seq, 30) AS one, {RC.format('right(seq, 30)')} AS two FROM {DOCS} WHERE length(seq) >= 60")
def end_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two ends of each read as mates that face each other."""
    rows = seqs(spark, sf_dir).where("length(seq) >= 60")
    return rows.select("id", F.left("seq", F.lit(30)).alias("one"), reverse_complement(F.right("seq", F.lit(30))).alias("two"))


@query("SELECT pair FROM (SELECT l_partkey AS sr, (l_orderkey * 8 + l_linenumber) // 2 AS pair FROM lineitem) GROUP BY pair HAVING count(*) = 2 AND count(DISTINCT sr) = 1")
def joined_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs both of whose mates are in one super-read."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("sr"), F.floor((F.col("l_orderkey") * 8 + F.col("l_linenumber")) / 2).alias("pair"))
    return rows.groupBy("pair").agg(F.count("*").alias("n"), F.min("sr").alias("a"), F.max("sr").alias("b")).where("n = 2 and a = b").select("pair")


_UNITS = "(SELECT o_custkey AS id, list(o_orderkey % 97 ORDER BY o_orderkey) AS units FROM orders GROUP BY o_custkey)"


@query(f"SELECT id, len(units) AS n FROM {_UNITS} WHERE NOT list_has_any(units, [3, 14, 15, 92])")
def super_reads_without_bad_unitigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Super-reads that go through none of the listed k-unitigs."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), (F.col("o_orderkey") % 97).alias("unit"))
    bad = o.where(F.col("unit").isin(3, 14, 15, 92)).select("id").distinct()
    return o.join(bad, "id", "left_anti").groupBy("id").agg(F.count("*").alias("n"))


@query(f"""WITH f AS (SELECT grp, lo, hi, max(hi) OVER (PARTITION BY grp ORDER BY lo, hi DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM {SHIP}),
g AS (SELECT *, sum(CASE WHEN far IS NULL OR NOT (hi <= far OR far - 8 >= lo) THEN 1 ELSE 0 END) OVER (PARTITION BY grp ORDER BY lo, hi DESC ROWS UNBOUNDED PRECEDING) AS i FROM f)
SELECT grp, min(lo) AS lo, max(hi) AS hi, count(*) AS n FROM g GROUP BY grp, i HAVING count(*) >= 2""")
def reference_contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contigs of reads that overlap on a reference by eight bases or more."""
    return interval.merge(ships(spark, sf_dir), ["grp"], least_overlap=8).where("n >= 2")


@query(f"""SELECT c.frg, p.scf, CASE WHEN p.ori = 'f' THEN p.bgn + c.bgn ELSE p.e - c.e END AS bgn FROM {CHILD} c JOIN {PARENT} p ON p.ctg = c.ctg WHERE p.ctg % 4 = 0""")
def surrogate_reads_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads of surrogate unitigs, placed in every contig that a surrogate is in."""
    child, parent = _places(spark, sf_dir)
    return overlap.projected(child, parent.where("ctg % 4 = 0"), ("frg", "ctg", "scf")).select("frg", "scf", "bgn")


@query(f"""WITH e AS (SELECT ref, unnest([s_r, e_r]) AS x FROM {ALIGNMENTS} WHERE idy >= 97), b AS (SELECT ref, x, CASE WHEN x - lag(x) OVER (PARTITION BY ref ORDER BY x) <= 15 THEN 0 ELSE 1 END AS b FROM e),
r AS (SELECT ref, x, sum(b) OVER (PARTITION BY ref ORDER BY x RANGE UNBOUNDED PRECEDING) AS run FROM b) SELECT ref, CAST(floor(avg(x)) AS BIGINT) AS point, count(*) AS n FROM r GROUP BY ref, run""")
def repeat_graph_glue_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places at which alignments end, near ones glued together."""
    rows = aligned(spark, sf_dir).where("idy >= 97").select("ref", F.explode(F.array("s_r", "e_r")).alias("x"))
    return layouts.glue_points(rows, "ref", "x", 15)


@query(f"""WITH g AS (SELECT DISTINCT grp, unnest(range(lo // 20, (hi - 1) // 20 + 1)) AS win FROM {SHIP} WHERE (lo + grp) % 5 = 0 AND hi > lo), b AS (SELECT grp, lo // 20 AS win, count(*) AS n FROM {SHIP} WHERE (lo + grp) % 5 = 1 GROUP BY ALL HAVING count(*) >= 2)
SELECT grp, win, n FROM b WHERE (grp, win) NOT IN (SELECT grp, win FROM g)""")
def unitig_split_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of unitigs with bad mates and no good ones."""
    s, kind = ships(spark, sf_dir), (F.col("lo") + F.col("grp")) % 5
    return layouts.inconsistent_windows(s.where((kind == 0) & (F.col("hi") > F.col("lo"))), s.where(kind == 1).select("grp", F.col("lo").alias("at")), "grp", 20, 2)


_PATCH = "CASE WHEN id % 3 <> 1 THEN left(seq, CAST(id % 9 AS BIGINT)) END"


@query(f"""WITH c AS (SELECT id % 50 AS scf, id, seq, {_PATCH} AS patch, lead(id) OVER (PARTITION BY id % 50 ORDER BY id) IS NULL AS last FROM {DOCS} WHERE seq <> '')
SELECT scf, md5(string_agg(seq || CASE WHEN last THEN '' ELSE coalesce(patch, repeat('N', 100)) END, '' ORDER BY id)) AS digest, CAST(count(*) FILTER (WHERE NOT last AND patch IS NOT NULL) AS INTEGER) AS n_closed FROM c GROUP BY scf""")
def scaffold_gaps_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaffolds with the sequences that were found for their gaps."""
    i = F.col("id")
    rows = seqs(spark, sf_dir).where("seq <> ''").select((i % 50).alias("scf"), i.alias("place"), "seq")
    patches = rows.where("place % 3 <> 1").select("scf", "place", F.left("seq", (F.col("place") % 9).cast("int")).alias("patch"))
    return layouts.closed_gaps(rows, patches).select("scf", F.md5("seq").alias("digest"), "n_closed")


_INSIDE = "(SELECT l_partkey % 100 AS a, l_suppkey AS b, CAST(l_quantity AS INTEGER) - 25 AS a_hang, l_discount AS erate FROM lineitem WHERE CAST(l_quantity AS INTEGER) - 25 <= 0 AND CAST(l_linenumber AS INTEGER) * 3 - 10 >= 0)"


@query(f"WITH k AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY erate, b, a_hang) AS k FROM {_INSIDE}) SELECT a AS iid, s_nationkey AS tig, s_suppkey * 50 - a_hang AS bgn FROM k JOIN supplier ON s_suppkey = b WHERE k = 1")
def contained_reads_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .overlap_queries import overlaps

    inside = overlaps(spark, sf_dir).where("a_hang <= 0 and b_hang >= 0")
    places = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("iid"), F.col("s_nationkey").alias("tig"), (F.col("s_suppkey") * 50).alias("bgn"))
    return layouts.placed_contains(inside, places)


@query("""WITH o AS (SELECT l_partkey % 100 AS a, l_suppkey AS b, l_discount AS erate FROM lineitem), b AS (SELECT * FROM o UNION ALL SELECT b, a, erate FROM o),
r0 AS (SELECT a AS iid, avg(erate) / 2 AS rate FROM b GROUP BY a), r1 AS (SELECT a AS iid, avg(greatest(erate - rate, 0)) AS rate FROM b JOIN r0 ON iid = b GROUP BY a), r2 AS (SELECT a AS iid, avg(greatest(erate - rate, 0)) AS rate FROM b JOIN r1 ON iid = b GROUP BY a)
SELECT iid, round(rate, 9) AS rate FROM r2""")
def read_error_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .overlap_queries import overlaps

    return layouts.read_error_rates(overlaps(spark, sf_dir), 2).withColumn("rate", F.round("rate", 9))
