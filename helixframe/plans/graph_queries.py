"""Mapping by chains of seeds, walks through graphs, and what is left of the pipelines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sequence import AMINO_ACIDS
from ..operators import fasta, graph, interval, kmer, layouts, overlap, scaffolding, sequential
from ..operators.graph import new_path
from ..sources import readers, writers
from . import pipelines
from .assembly_queries import CHAIN, EDGES, edges
from .kmer_queries import dna_sql, seqs
from .overlap_queries import BEST, SEEDS, best, seed_overlaps
from .record_queries import DOCS, SHIP, ships
from .registry import query, table

RC = "reverse(translate({0}, 'ACGT', 'TGCA'))"


def _seeds_sql(name: str) -> str:
    return f"(SELECT id, pos, least(kmer, {RC.format('kmer')}) AS m, kmer > {RC.format('kmer')} AS back FROM {dna_sql(name, k=9, both=False)} WHERE kmer <> {RC.format('kmer')})"


_ANCHORS = f"(WITH r AS (SELECT m FROM {_seeds_sql('benchmark')} GROUP BY m HAVING count(*) <= 12) SELECT x.id AS a, y.id AS b, x.back <> y.back AS back, x.pos AS a_pos, CASE WHEN x.back <> y.back THEN -y.pos ELSE y.pos END AS b_pos FROM {_seeds_sql('documents')} x JOIN r ON r.m = x.m JOIN {_seeds_sql('benchmark')} y ON y.m = x.m)"


def _seeds(spark, sf_dir, name: str) -> DataFrame:
    return kmer.codes(seqs(spark, sf_dir, name), 9, keep=("id",), positions=True, strands=True).withColumnRenamed("code", "minimizer")


@query(f"""WITH g AS (SELECT *, a_pos - lag(a_pos) OVER w AS da, b_pos - lag(b_pos) OVER w AS db FROM {_ANCHORS} WINDOW w AS (PARTITION BY a, b, back ORDER BY a_pos, b_pos)),
c AS (SELECT *, sum(CASE WHEN da > 0 AND db > 0 AND da <= 30 AND db <= 30 AND abs(da - db) <= 6 THEN 0 ELSE 1 END) OVER (PARTITION BY a, b, back ORDER BY a_pos, b_pos ROWS UNBOUNDED PRECEDING) AS chain FROM g)
SELECT a, b, back, count(*) AS n, CAST(min(a_pos) AS INTEGER) AS a_lo, CAST(max(a_pos) AS INTEGER) AS a_hi, CAST(min(b_pos) AS INTEGER) AS b_lo, CAST(max(b_pos) AS INTEGER) AS b_hi FROM c GROUP BY a, b, back, chain HAVING count(*) >= 3""")
def mapped_by_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mapped to items, on both strands, by chains of shared seeds."""
    rows = overlap.anchors(_seeds(spark, sf_dir, "documents"), _seeds(spark, sf_dir, "benchmark"), 12)
    return overlap.chained(rows, 30, 6, 3)


@query(f"""WITH o AS (SELECT a, b, diagonal, x.seq AS xs, y.seq AS ys, greatest(diagonal, 0) AS lo, least(length(x.seq), length(y.seq) + diagonal) - greatest(diagonal, 0) AS n FROM {SEEDS} JOIN {DOCS} x ON x.id = a JOIN {DOCS} y ON y.id = b),
p AS (SELECT a, b, diagonal, substr(xs, CAST(lo + 1 AS BIGINT), CAST(n AS BIGINT)) AS x, substr(ys, CAST(lo - diagonal + 1 AS BIGINT), CAST(n AS BIGINT)) AS y FROM o),
u AS (SELECT DISTINCT a, b, diagonal, substr(x, CAST(i AS BIGINT), 24) AS k FROM (SELECT *, unnest(range(1, length(x) - 22)) AS i FROM p WHERE length(x) >= 24)), v AS (SELECT DISTINCT a, b, diagonal, substr(y, CAST(i AS BIGINT), 24) AS k FROM (SELECT *, unnest(range(1, length(y) - 22)) AS i FROM p WHERE length(y) >= 24)),
bad AS (SELECT kmer FROM {dna_sql(k=24, both=False)} GROUP BY kmer HAVING count(*) > 6)
SELECT DISTINCT u.a, u.b, u.diagonal FROM u JOIN v ON v.a = u.a AND v.b = u.b AND v.diagonal = u.diagonal AND v.k = u.k WHERE u.k NOT IN (SELECT kmer FROM bad)""")
def overlaps_sharing_rare_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps whose reads share a k-mer, in the region that the overlap implies, that is not a bad one."""
    reads = graph.kept(seqs(spark, sf_dir).select("id", "seq"))
    counts = (graph.kept(kmer.count(reads, 24, both_strands=False, least=7, clean=True, part=part)) for part in overlap.slices(reads))
    bad = reduce(DataFrame.unionByName, counts)
    return overlap.sharing_rare_kmers(graph.kept(seed_overlaps(spark, sf_dir)), reads, 24, bad).select("a", "b", "diagonal")


@query(f"WITH k AS (SELECT id, pos, kmer FROM {dna_sql(k=11, both=False)}) SELECT o.a, o.b, o.diagonal, count(*) AS n FROM {SEEDS} o JOIN k x ON x.id = o.a JOIN k y ON y.id = o.b AND y.kmer = x.kmer WHERE abs(x.pos - y.pos - o.diagonal) <= 4 GROUP BY ALL")
def overlaps_refined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.refined(seed_overlaps(spark, sf_dir), seqs(spark, sf_dir).select("id", "seq"), 11, 4)


_JUNCTIONS = "(SELECT l_suppkey AS chrom, l_partkey % 200 AS lo, l_partkey % 200 + l_linenumber * 3 AS hi, l_orderkey * 8 + l_linenumber AS aln FROM lineitem)"


@query(f"SELECT aln, count(known.lo) > 0 AS known FROM {_JUNCTIONS} j LEFT JOIN (SELECT DISTINCT s_suppkey AS chrom, unnest([7, 30, 90, 150]) AS lo, unnest([10, 36, 99, 162]) AS hi FROM supplier) known ON known.chrom = j.chrom AND known.lo = j.lo AND known.hi = j.hi GROUP BY aln")
def junctions_annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments' junctions that an annotation has, too."""
    pairs = F.array(*(F.struct(F.lit(a).alias("lo"), F.lit(b).alias("hi")) for a, b in ((7, 10), (30, 36), (90, 99), (150, 162))))
    known = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("chrom"), F.inline(pairs)).distinct().withColumn("hit", F.lit(True))
    lo = F.col("l_partkey") % 200
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("chrom"), lo.alias("lo"), (lo + F.col("l_linenumber") * 3).alias("hi"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("aln"))
    return rows.join(known, ["chrom", "lo", "hi"], "left").groupBy("aln").agg(F.bool_or(F.coalesce("hit", F.lit(False))).alias("known"))


@query(f"""WITH RECURSIVE e AS (SELECT * FROM {CHAIN}), i AS (SELECT a, b FROM e WHERE a IN (SELECT a FROM e GROUP BY a HAVING count(*) = 1) AND b IN (SELECT b FROM e GROUP BY b HAVING count(*) = 1)), n AS (SELECT a AS node FROM e UNION SELECT b FROM e),
r(node, path, place, weight) AS (SELECT node, node, 0, CAST(0 AS BIGINT) FROM n WHERE node NOT IN (SELECT b FROM i) UNION ALL SELECT i.b, r.path, r.place + 1, r.weight + i.a % 13 FROM r JOIN i ON i.a = r.node)
SELECT path, path AS a, arg_max(node, place) AS b, CAST(max(place) AS BIGINT) AS n, max(weight) AS weight FROM r GROUP BY path HAVING max(place) > 0""")
def graph_path_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unbranching paths as edges, with the weights of what they go over."""
    a, size = F.col("p_partkey"), F.col("p_size")
    b = F.when(size % 11 == 0, -size).when(size % 9 == 0, a + 3).otherwise(a + 1)
    chain = table(spark, sf_dir, "part").select(a.alias("a"), b.alias("b")).distinct()
    return graph.path_edges(graph.unbranching_paths(chain), chain.withColumn("weight", F.col("a") % 13))


@query("SELECT a, b, id FROM (SELECT o_custkey % 300 AS a, o_orderkey % 40 AS b, o_orderkey AS id, row_number() OVER (PARTITION BY o_custkey % 300, o_orderkey % 40 ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k = 1")
def graph_bulges_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of parallel edges the best covered."""
    rows = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 300).alias("a"), (F.col("o_orderkey") % 40).alias("b"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("coverage"))
    return graph.parallel_edges_removed(rows).select("a", "b", "id")


_WALKS = "(SELECT lag(s) OVER w AS a, s AS m, lead(s) OVER w AS b FROM (SELECT l_orderkey, l_linenumber, l_suppkey % 12 AS s FROM lineitem) WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, s))"
_CONNECTIONS = f"(SELECT a, m, b, count(*) AS n FROM {_WALKS} WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY ALL)"


def _connections(spark, sf_dir) -> DataFrame:
    s = F.col("l_suppkey") % 12
    return graph.connections(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("walk"), F.struct("l_linenumber", s.alias("s")).alias("place"), s.alias("node")))


@query(f"SELECT a, m, b, n FROM {_CONNECTIONS} WHERE n < 20")
def graph_unsupported_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connections that too few reads go through."""
    return _connections(spark, sf_dir).where("n < 20")


@query(f"SELECT a, m, b, n FROM (SELECT *, max(n) OVER (PARTITION BY m, a) = n AND count(*) OVER (PARTITION BY m, a, n) = 1 AS x, max(n) OVER (PARTITION BY m, b) = n AND count(*) OVER (PARTITION BY m, b, n) = 1 AS y FROM {_CONNECTIONS}) WHERE x AND y AND n >= 5")
def graph_repeats_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ways in and out of repeat nodes that reads pair up."""
    return graph.resolved_repeats(_connections(spark, sf_dir), 5)


_DAG = "(SELECT p_partkey AS a, p_partkey + 1 AS b FROM part WHERE (p_partkey + 1) // 8 = p_partkey // 8 AND p_size % 4 <> 0 UNION SELECT p_partkey, p_partkey + 3 FROM part WHERE (p_partkey + 3) // 8 = p_partkey // 8 AND p_size % 3 <> 0)"


@query(f"""WITH RECURSIVE n AS (SELECT p_partkey AS node, CAST(p_size AS DOUBLE) AS w FROM part), r(node, first, weight) AS (SELECT node, node, w FROM n UNION ALL SELECT e.b, r.first, r.weight + n.w FROM r JOIN {_DAG} e ON e.a = r.node JOIN n ON n.node = e.b)
SELECT node, weight, first FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY weight DESC, first) AS k FROM r) WHERE k = 1""")
def overlap_graph_longest_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The heaviest path to each node of an overlap graph."""
    p, size = F.col("p_partkey"), F.col("p_size")
    part = table(spark, sf_dir, "part")
    step = lambda d, m: part.where((F.floor((p + d) / 8) == F.floor(p / 8)) & (size % m != 0)).select(p.alias("a"), (p + d).alias("b"))
    return graph.longest_paths(part.select(p.alias("node"), size.alias("weight")), step(1, 4).unionByName(step(3, 3)).hint("merge").join(part.select(p.alias("b")), "b", "left_semi").select("a", "b"))


@query(f"""WITH RECURSIVE m AS (SELECT x.a_iid AS a, x.b_iid AS b FROM {BEST} x JOIN {BEST} y ON y.a_iid = x.b_iid AND y.b_iid = x.a_iid WHERE x.a_iid < x.b_iid), e AS (SELECT DISTINCT a, b FROM m UNION SELECT b, a FROM m), i AS (SELECT DISTINCT l_partkey % 100 AS iid FROM lineitem),
r(node, x) AS (SELECT iid, iid FROM i UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.x) SELECT node AS iid, min(x) AS component FROM r GROUP BY node""")
def unitigs_from_best_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads with the unitig that their mutually best overlaps put them into."""
    pairs = overlap.mutual_best(best(spark, sf_dir))
    reads = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 100).alias("iid")).distinct()
    parts = graph.connected_components(pairs, "a_iid", "b_iid").withColumnRenamed("node", "iid")
    return reads.join(parts, "iid", "left").select("iid", F.coalesce("component", "iid").alias("component"))


@query(f"""WITH RECURSIVE e AS (SELECT DISTINCT a, b FROM {EDGES}), q AS (SELECT c_custkey AS pair, c_custkey % 700 AS a, (c_custkey * 17) % 900 AS b FROM customer),
r(pair, goal, node, n) AS (SELECT pair, b, a, 0 FROM q UNION SELECT r.pair, r.goal, e.b, r.n + 1 FROM r JOIN e ON e.a = r.node WHERE r.n < 3)
SELECT pair, CAST(min(n) AS INTEGER) AS hops FROM r WHERE node = goal AND n > 0 GROUP BY pair""")
def mates_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of which a mate is reached from the other over at most three overlaps, and the fewest it takes."""
    c = F.col("c_custkey")
    pairs = table(spark, sf_dir, "customer").select(c.alias("pair"), (c % 700).alias("a"), ((c * 17) % 900).alias("b"))
    return layouts.hops(edges(spark, sf_dir), pairs, 3)


@query("SELECT x.scf AS a, y.scf AS b, count(*) AS n, avg(gap) AS gap FROM (SELECT l_orderkey AS c1, l_partkey AS c2, l_quantity AS gap FROM lineitem) l JOIN (SELECT o_orderkey AS c, o_custkey % 60 AS scf FROM orders) x ON x.c = c1 JOIN (SELECT p_partkey AS c, p_size AS scf FROM part) y ON y.c = c2 WHERE x.scf < y.scf GROUP BY ALL HAVING count(*) >= 8")
def scaffold_links_bundled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between contigs as links between their scaffolds, of eight or more."""
    x = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 60).alias("a"))
    y = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").alias("b"))
    rows = table(spark, sf_dir, "lineitem").join(x, "l_orderkey").join(y, "l_partkey").where("a < b")
    return rows.groupBy("a", "b").agg(F.count("*").alias("n"), F.avg("l_quantity").alias("gap")).where("n >= 8")


@query("SELECT l_partkey AS ctg, min(scf) AS scf, max(n) AS n FROM (SELECT l_partkey, l_suppkey % 10 AS scf, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) >= 6) GROUP BY l_partkey HAVING count(*) = 1")
def contigs_placed_as_rocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contigs that enough links put into one scaffold, and into no other."""
    links = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("ctg"), (F.col("l_suppkey") % 10).alias("scf")).agg(F.count("*").alias("n")).where("n >= 6")
    return links.groupBy("ctg").agg(F.min("scf").alias("scf"), F.max("n").alias("n"), F.count("*").alias("c")).where("c = 1").drop("c")


@query(f"SELECT id, CASE WHEN instr(seq, 'GATAC') > 0 THEN left(seq, instr(seq, 'GATAC') - 1) ELSE seq END AS seq, instr(seq, 'GATAC') > 0 AS cut FROM {DOCS}")
def adapters_trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads up to where an adapter begins."""
    at = F.instr("seq", F.lit("GATAC"))
    return seqs(spark, sf_dir).select("id", F.when(at > 0, F.substr("seq", F.lit(1), at - 1)).otherwise(F.col("seq")).alias("seq"), (at > 0).alias("cut"))


_VOTES = f"""(WITH c AS (SELECT kmer, min(id) AS contig FROM {dna_sql('benchmark', k=10)} GROUP BY kmer HAVING count(DISTINCT id) = 1), n AS (SELECT id, length(seq) AS n FROM {DOCS}),
v AS (SELECT r.id, r.pos * 2 >= n.n AS half, contig, count(*) AS votes FROM {dna_sql(k=10)} r JOIN n ON n.id = r.id JOIN c ON c.kmer = r.kmer GROUP BY ALL)
SELECT id, half, contig FROM (SELECT *, row_number() OVER (PARTITION BY id, half ORDER BY votes DESC, contig) AS k FROM v) WHERE k = 1 AND votes >= 2)"""


@query(f"SELECT x.id, x.contig AS front, y.contig AS back FROM {_VOTES} x JOIN {_VOTES} y ON y.id = x.id WHERE NOT x.half AND y.half AND x.contig <> y.contig")
def chimeras_by_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads of which the halves' k-mers vote for different contigs."""
    reads = seqs(spark, sf_dir).withColumn("n", F.length("seq"))
    rows = kmer.enumerate_kmers(reads, 10, keep=("id", "n"), positions=True, clean=True)
    contigs = kmer.enumerate_kmers(seqs(spark, sf_dir, "benchmark"), 10, keep=("id",), clean=True).withColumnRenamed("id", "contig")
    half = lambda later, name: layouts.voted_contigs(rows.where((F.col("pos") * 2 >= F.col("n")) == later).select("id", "kmer"), contigs, 2).select("id", F.col("contig").alias(name))
    return half(False, "front").join(half(True, "back"), "id").where("front <> back")


@query(f"WITH p AS (SELECT x.id, x.a, y.a AS b FROM (SELECT id, seq AS a FROM {DOCS}) x JOIN (SELECT id, seq AS a FROM {DOCS}) y ON y.id = x.id + 1), i AS (SELECT id, a, b, unnest(range(1, least(length(a), length(b)) + 1)) AS i FROM p) SELECT id, any_value(a) || chr(10) || string_agg(CASE WHEN substr(a, CAST(i AS BIGINT), 1) = substr(b, CAST(i AS BIGINT), 1) THEN '|' ELSE ' ' END, '' ORDER BY i) || chr(10) || any_value(b) AS lines FROM i GROUP BY id")
def alignments_rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sequences above one another, with marks where they agree."""
    rows = seqs(spark, sf_dir).select("id", F.col("seq").alias("a"))
    pairs = rows.join(rows.select((F.col("id") - 1).alias("id"), F.col("a").alias("b")), "id").where("a <> '' and b <> ''")
    n = F.least(F.length("a"), F.length("b"))
    at = lambda c, i: F.substr(F.col(c), i, F.lit(1))
    marks = F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: F.when(at("a", i) == at("b", i), "|").otherwise(" ")), "")
    return pairs.select("id", F.concat("a", F.lit("\n"), marks, F.lit("\n"), "b").alias("lines"))


@query(f"SELECT CAST(id AS VARCHAR) AS qname, 4 AS flag, '*' AS tid, md5(seq) AS seq FROM {DOCS} WHERE seq <> ''")
def fastq_to_sam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads as alignment rows that are not mapped, written and read."""
    path = new_path(spark, "sam")
    rows = seqs(spark, sf_dir).where("seq <> ''").select(F.col("id").cast("string").alias("qname"), F.lit(4).alias("flag"), F.lit("*").alias("tid"), F.lit(-1).alias("pos"), F.lit(0).alias("mapq"), F.lit("*").alias("cigar"), F.lit("*").alias("mtid"), F.lit(-1).alias("mpos"), F.lit(0).alias("isize"), "seq", F.translate("seq", "ACGT", "IIII").alias("qual"))
    writers.sam(rows, path)
    return readers.sam(spark, path).select("qname", "flag", "tid", F.md5("seq").alias("seq"))


@query(f"""WITH f AS (SELECT grp, lo, hi, max(hi) OVER (PARTITION BY grp ORDER BY lo, hi DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM {SHIP}), g AS (SELECT *, sum(CASE WHEN far IS NULL OR lo > far THEN 1 ELSE 0 END) OVER (PARTITION BY grp ORDER BY lo, hi DESC ROWS UNBOUNDED PRECEDING) AS i FROM f),
m AS (SELECT grp, min(lo) AS lo, max(hi) AS hi FROM g GROUP BY grp, i), u AS (SELECT s_suppkey AS grp, s_suppkey * 20 + k AS utg, 1000 + 130 * k AS u_lo, 1100 + 130 * k + s_nationkey * 3 AS u_hi FROM supplier, unnest(range(12)) AS t(k))
SELECT u.utg, count(*) FILTER (WHERE m.lo <= u_lo AND m.hi >= u_hi) AS inside, count(m.lo) FILTER (WHERE NOT (m.lo <= u_lo AND m.hi >= u_hi)) AS partly FROM u LEFT JOIN m ON m.grp = u.grp AND m.lo < u_hi AND u_lo < m.hi GROUP BY u.utg""")
def unitigs_in_ideal_ones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unitigs' places on a reference against the contigs that the reads' alignments would make."""
    ideal = interval.merge(ships(spark, sf_dir), ["grp"])
    k = F.explode(F.sequence(F.lit(0), F.lit(11)))
    u = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("grp"), "s_nationkey", k.alias("k"))
    u = u.select("grp", (F.col("grp") * 20 + F.col("k")).alias("var"), (1000 + 130 * F.col("k")).alias("v_lo"), (1100 + 130 * F.col("k") + F.col("s_nationkey") * 3).alias("v_hi"))
    return layouts.variants_in_reads(u, ideal, ["grp"], 128).select(F.col("var").alias("utg"), F.col("complete").alias("inside"), F.col("partial").alias("partly"))


@query(f"""WITH c AS (SELECT c.id, count(*) FILTER (WHERE a.kmer IS NOT NULL AND b.kmer IS NULL) AS one, count(*) FILTER (WHERE b.kmer IS NOT NULL AND a.kmer IS NULL) AS two FROM {dna_sql(where="WHERE lang = 'en'")} c
LEFT JOIN (SELECT kmer FROM {dna_sql(where="WHERE lang = 'de'")} GROUP BY kmer HAVING count(*) > 1) a ON c.kmer = a.kmer LEFT JOIN (SELECT kmer FROM {dna_sql(where="WHERE lang = 'fr'")} GROUP BY kmer HAVING count(*) > 1) b ON c.kmer = b.kmer GROUP BY c.id)
SELECT id, CASE WHEN one > two THEN 'one' WHEN two > one THEN 'two' ELSE 'none' END AS parent FROM c""")
def trio_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads by the parent that more of their k-mers come from."""
    s = seqs(spark, sf_dir)
    of = lambda lang: s.where(F.col("lang") == lang).select("id", "seq")
    return pipelines.trio_binning(of("en"), of("de"), of("fr"), 8).select("id", "parent")


def _acids_sql(name: str) -> str:
    """(id, word): the words of five amino acids of a table's three frames, one for each fifteen letters."""
    id_col = {"documents": "doc_id", "benchmark": "item_id"}[name]
    at = lambda k: f"(instr('TCAG', substr(s, CAST(i + {k} AS BIGINT), 1)) - 1)"
    acids = " || ".join(f"substr('{AMINO_ACIDS}', 16 * {at(k)} + 4 * {at(k + 1)} + {at(k + 2)} + 1, 1)" for k in range(0, 15, 3))
    letters = f"(SELECT {id_col} AS id, regexp_replace(upper(text), '[^ACGT]', '', 'g') AS s FROM {name})"
    return f"(SELECT DISTINCT id, {acids} AS word FROM (SELECT id, s, unnest(range(1, length(s) - 13)) AS i FROM {letters} WHERE length(s) >= 15))"


@query(f"SELECT x.id AS a, y.id AS b, count(*) AS shared FROM {_acids_sql('documents')} x JOIN {_acids_sql('benchmark')} y ON y.word = x.word GROUP BY ALL")
def protein_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and an item that share words of five amino acids, in any of three frames."""
    words = lambda name: kmer.acid_words(seqs(spark, sf_dir, name), 5)
    return overlap.seed_pairs(words("documents"), words("benchmark"), "word", None)


@query(f"SELECT count(*) AS n, CAST(sum(length(seq)) AS BIGINT) AS total, min(length(seq)) AS least, max(length(seq)) AS most, avg(length(seq)) AS mean FROM {DOCS}")
def unitig_length_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = fasta.lengths(seqs(spark, sf_dir).select("id", "seq"))
    return fasta.size_stats(sizes, []).select("n", "total", "least", "most", "mean")


def _unitig_ctes(solid: str, k: int, p: str = "") -> str:
    """CTEs of the unbranching paths of solid k-mers, named with prefix p: r has linear ones, c cycles from their smallest node."""
    return f"""{p}s AS MATERIALIZED {solid}, {p}e AS (SELECT DISTINCT left(kmer, {k - 1}) AS a, right(kmer, {k - 1}) AS b FROM {p}s),
{p}i AS (SELECT a, b FROM {p}e WHERE a <> b AND a IN (SELECT a FROM {p}e GROUP BY a HAVING count(*) = 1) AND b IN (SELECT b FROM {p}e GROUP BY b HAVING count(*) = 1)), {p}n AS (SELECT a AS node FROM {p}e UNION SELECT b FROM {p}e),
{p}r(node, path, seq) AS (SELECT node, node, node FROM {p}n WHERE node NOT IN (SELECT b FROM {p}i) UNION ALL SELECT {p}i.b, {p}r.path, {p}r.seq || right({p}i.b, 1) FROM {p}r JOIN {p}i ON {p}i.a = {p}r.node),
{p}c(node, path, seq) AS (SELECT node, node, node FROM {p}n WHERE node NOT IN (SELECT node FROM {p}r) UNION ALL SELECT {p}i.b, {p}c.path, {p}c.seq || right({p}i.b, 1) FROM {p}c JOIN {p}i ON {p}i.a = {p}c.node WHERE {p}i.b > {p}c.path)"""


def _unitig_sql(p: str = "") -> str:
    return f"SELECT path, arg_max(seq, length(seq)) AS seq FROM {p}r GROUP BY path UNION ALL SELECT {p}c.path, {p}c.seq FROM {p}c JOIN {p}i ON {p}i.a = {p}c.node AND {p}i.b = {p}c.path"


def _solid_sql(k: int, least: int) -> str:
    return f"(SELECT kmer FROM {dna_sql(k=k, both=False)} GROUP BY kmer HAVING count(*) >= {least})"


_UNITIGS = f"WITH RECURSIVE {_unitig_ctes(_solid_sql(16, 3), 16)}"


@query(f"""WITH RECURSIVE {_unitig_ctes(_solid_sql(12, 4), 12, 'x')}, xu AS MATERIALIZED ({_unitig_sql('x')}),
{_unitig_ctes(f"(SELECT kmer FROM {_solid_sql(17, 4)} UNION SELECT substr(seq, CAST(i AS BIGINT), 17) FROM (SELECT seq, unnest(range(1, length(seq) - 15)) AS i FROM xu WHERE length(seq) >= 17))", 17, 'y')}, yu AS MATERIALIZED ({_unitig_sql('y')}),
{_unitig_ctes(f"(SELECT kmer FROM {_solid_sql(23, 4)} UNION SELECT substr(seq, CAST(i AS BIGINT), 23) FROM (SELECT seq, unnest(range(1, length(seq) - 21)) AS i FROM yu WHERE length(seq) >= 23))", 23, 'z')}
SELECT 23 AS k, seq FROM ({_unitig_sql('z')})""")
def multi_k_unitigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unitigs of 12-mers that feed those of 17-mers, and these those of 23-mers."""
    return pipelines.multi_k_unitigs(seqs(spark, sf_dir).select("id", "seq"), [12, 17, 23], 4)


@query(f"{_UNITIGS} SELECT path, arg_max(seq, length(seq)) AS seq FROM r GROUP BY path UNION ALL SELECT path, seq FROM c JOIN i ON i.a = c.node AND i.b = c.path")
def unitig_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k-unitigs: the sequences of the unbranching paths of solid k-mers."""
    return pipelines.unitigs(seqs(spark, sf_dir).select("id", "seq"), 16, 3)


@query(f"""{_UNITIGS}, p AS (SELECT node, path FROM r UNION ALL SELECT node, path FROM c WHERE path IN (SELECT path FROM c JOIN i ON i.a = c.node AND i.b = c.path)),
k AS (SELECT x.id, x.pos, p.path, lag(p.path) OVER (PARTITION BY x.id ORDER BY x.pos) AS before FROM {dna_sql(k=15, both=False)} x JOIN p ON p.node = x.kmer)
SELECT id, count(*) AS n, md5(string_agg(path, '_' ORDER BY pos)) AS name FROM k WHERE before IS NULL OR before <> path GROUP BY id""")
def super_read_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads as the k-unitigs that they run through."""
    return pipelines.super_read_names(seqs(spark, sf_dir).select("id", "seq"), 16, 3).withColumn("name", F.md5("name"))


@query(f"""WITH RECURSIVE p AS (SELECT a, b, back, list(b_pos ORDER BY a_pos, b_pos DESC) AS vs FROM {_ANCHORS} GROUP BY a, b, back HAVING count(*) >= 10),
t(a, b, back, i, d) AS (SELECT a, b, back, 0, CAST([] AS BIGINT[]) FROM p UNION ALL SELECT t.a, t.b, t.back, i + 1, list_append(d, 1 + coalesce(list_max(list_transform(range(1, i + 1), lambda j: CASE WHEN vs[j] < vs[i + 1] THEN d[j] ELSE 0 END)), 0)) FROM t JOIN p ON p.a = t.a AND p.b = t.b AND p.back = t.back WHERE i < len(vs))
SELECT t.a, t.b, t.back, CAST(len(vs) AS BIGINT) AS n, list_max(d) AS longest FROM t JOIN p ON p.a = t.a AND p.b = t.b AND p.back = t.back WHERE i = len(vs) AND 5 * list_max(d) >= 2 * len(vs)""")
def coarse_alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and an item with ten shared seeds or more, two fifths of which lie in one order."""
    rows = overlap.anchors(_seeds(spark, sf_dir, "documents"), _seeds(spark, sf_dir, "benchmark"), 12)
    by = ["a", "b", "back"]
    return sequential.longest_increasing(rows, by, "a_pos", "b_pos", least=10).where("5 * longest >= 2 * n")


_FORWARD = f"(SELECT a_iid AS a, b_iid AS b, length AS n FROM {BEST} WHERE \"end\" = '3p' AND a_iid < b_iid)"


@query(f"""WITH RECURSIVE e AS (SELECT a, b FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY n DESC, b) AS o, row_number() OVER (PARTITION BY b ORDER BY n DESC, a) AS i FROM {_FORWARD}) WHERE o = 1 AND i = 1),
r(node, path, place) AS (SELECT a, a, 0 FROM e WHERE a NOT IN (SELECT b FROM e) UNION ALL SELECT e.b, r.path, r.place + 1 FROM r JOIN e ON e.a = r.node) SELECT node, path, CAST(place AS BIGINT) AS place FROM r""")
def reads_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads put one after another by their best overlaps at the 3' end, each read once."""
    links = best(spark, sf_dir).where("`end` = '3p' and a_iid < b_iid").select(F.col("a_iid").alias("a"), F.col("b_iid").alias("b"), F.col("length").alias("n"))
    return layouts.merged_contigs(links)


@query()
def scaffolds_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contigs in order, on their strands and in their places, by links to the next one and the one after."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ctg"), (300 + 10 * F.col("p_size")).cast("long").alias("size"), F.col("p_size").cast("long").alias("gap"), (1 + F.col("p_size") % 9).cast("long").alias("weight"))
    of = lambda d, c: p.select((F.col("ctg") - d).alias("ctg"), F.col("size").alias(f"{c}_size"), F.col("gap").alias(f"{c}_gap"))
    one = p.hint("merge").join(of(1, "x"), "ctg")
    two = one.hint("merge").join(of(2, "y"), "ctg")
    # every fifth contig is turned round
    signed = lambda d: (F.col("ctg") + d) * F.when((F.col("ctg") + d) % 5 == 0, -1).otherwise(1)
    links = one.select(signed(0).alias("a"), signed(1).alias("b"), "gap", "weight").unionByName(two.select(signed(0).alias("a"), signed(2).alias("b"), (F.col("gap") + F.col("x_size") + F.col("x_gap")).alias("gap"), "weight"))
    return scaffolding.ordered(p.select("ctg", "size"), links)
