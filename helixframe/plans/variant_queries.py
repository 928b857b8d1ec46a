"""Calls, likelihoods, edits and consensus, over the letters of documents.

Reads are the documents' letters; read id lies on contig id % 50 from its first
place on, and the smallest id of a contig is its reference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import graph, kmer, targets, variants
from .assembly_queries import COLUMNS
from .kmer_queries import dna_sql, seqs
from .record_queries import DOCS
from .registry import query, table

_PLACED = f"(SELECT id % 50 AS tig, id, i AS pos, substr(seq, CAST(i AS BIGINT), 1) AS base, CAST(10 + (id * 7 + i) % 30 AS INTEGER) AS q FROM (SELECT id, seq, unnest(range(1, length(seq) + 1)) AS i FROM {DOCS}))"


def placed(spark, sf_dir) -> DataFrame:
    """(tig, id, pos from 1, base, q)."""
    rows = kmer.codes(seqs(spark, sf_dir), 1, both_strands=False, keep=("id",), positions=True)
    pos = (F.col("pos") + 1).cast("long")
    base = F.substr(F.lit("ACGT"), F.col("code").cast("int") + 1, F.lit(1))
    return rows.select((F.col("id") % 50).alias("tig"), "id", pos.alias("pos"), base.alias("base"), (10 + (F.col("id") * 7 + pos) % 30).cast("int").alias("q"))


_CALLED = f"(SELECT tig, pos, base, weight, depth FROM (SELECT tig, pos, base, sum(q) AS weight, sum(count(*)) OVER (PARTITION BY tig, pos) AS depth, row_number() OVER (PARTITION BY tig, pos ORDER BY sum(q) DESC, base) AS k FROM {_PLACED} GROUP BY tig, pos, base) WHERE k = 1)"


@query(f"SELECT tig, pos, base, CAST(weight AS BIGINT) AS weight, CAST(depth AS BIGINT) AS depth FROM {_CALLED}")
def base_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.base_calls(placed(spark, sf_dir), ["tig", "pos"])


@query(f"SELECT tig, string_agg(base, '' ORDER BY pos) AS seq FROM {_CALLED} GROUP BY tig")
def layout_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.consensus(placed(spark, sf_dir), "tig", "pos")


_ALT = f"(SELECT p.tig, p.pos, p.id, p.q, p.base <> r.base AS alt FROM {_PLACED} p JOIN (SELECT tig, pos, arg_min(base, id) AS base FROM {_PLACED} GROUP BY tig, pos) r ON r.tig = p.tig AND r.pos = p.pos)"


def alternatives(spark, sf_dir) -> DataFrame:
    rows = placed(spark, sf_dir)
    reference = rows.groupBy("tig", "pos").agg(F.min_by("base", "id").alias("ref"))
    return rows.join(reference, ["tig", "pos"]).select("tig", "pos", "id", "q", (F.col("base") != F.col("ref")).alias("alt"))


@query(f"""SELECT tig, pos, round(sum(CASE WHEN alt THEN log10(pow(10, -q / 10.0)) ELSE log10(1 - pow(10, -q / 10.0)) END), 6) AS l0, round(count(*) * log10(0.5), 6) AS l1,
round(sum(CASE WHEN alt THEN log10(1 - pow(10, -q / 10.0)) ELSE log10(pow(10, -q / 10.0)) END), 6) AS l2 FROM {_ALT} GROUP BY tig, pos""")
def genotype_likelihoods(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = variants.genotype_likelihoods(alternatives(spark, sf_dir), ["tig", "pos"])
    return out.select("tig", "pos", *(F.round(c, 6).alias(c) for c in ("l0", "l1", "l2")))


@query(f"""WITH r AS (SELECT *, rank() OVER (PARTITION BY tig, pos ORDER BY q) + (count(*) OVER (PARTITION BY tig, pos, q) - 1) / 2 AS r FROM {_ALT}),
s AS (SELECT tig, pos, count(*) FILTER (WHERE NOT alt) AS n_ref, count(*) FILTER (WHERE alt) AS n_alt, sum(r) FILTER (WHERE alt) AS sum FROM r GROUP BY tig, pos),
u AS (SELECT *, sum - n_alt * (n_alt + 1) / 2 AS u FROM s WHERE n_ref > 0 AND n_alt > 0)
SELECT tig, pos, n_ref, n_alt, u, round((u - CAST(n_ref AS DOUBLE) * n_alt / 2) / sqrt(CAST(n_ref AS DOUBLE) * n_alt * (n_ref + n_alt + 1) / 12), 9) AS z FROM u""")
def quality_rank_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Mann-Whitney test of base qualities between reads with and without the alternative."""
    out = variants.rank_sums(alternatives(spark, sf_dir), ["tig", "pos"], "q")
    return out.withColumn("z", F.round("z", 9))


_TABLES = "(SELECT o_custkey AS id, count(*) FILTER (WHERE o_orderstatus = 'O' AND o_orderkey % 2 = 0) AS a, count(*) FILTER (WHERE o_orderstatus = 'O' AND o_orderkey % 2 = 1) AS b, count(*) FILTER (WHERE o_orderstatus <> 'O' AND o_orderkey % 2 = 0) AS c, count(*) FILTER (WHERE o_orderstatus <> 'O' AND o_orderkey % 2 = 1) AS d FROM orders GROUP BY o_custkey)"


@query(f"""WITH t AS (SELECT *, a + b AS r, a + c AS s, a + b + c + d AS n FROM {_TABLES}), x AS (SELECT *, unnest(range(greatest(0, r + s - n), least(r, s) + 1)) AS x FROM t),
p AS (SELECT *, exp(lgamma(r + 1) - lgamma(x + 1) - lgamma(r - x + 1) + lgamma(n - r + 1) - lgamma(s - x + 1) - lgamma(n - r - s + x + 1) - lgamma(n + 1) + lgamma(s + 1) + lgamma(n - s + 1)) AS p FROM x),
o AS (SELECT *, max(CASE WHEN x = a THEN p END) OVER (PARTITION BY id) AS own FROM p)
SELECT id, a, b, c, d, round(least(1, sum(p) FILTER (WHERE p <= own * 1.0000001)), 8) AS two_sided FROM o GROUP BY ALL""")
def fisher_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    open_, even = F.col("o_orderstatus") == "O", F.col("o_orderkey") % 2 == 0
    of = {"a": open_ & even, "b": open_ & ~even, "c": ~open_ & even, "d": ~open_ & ~even}
    rows = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(*(F.count_if(c).alias(n) for n, c in of.items()))
    return variants.fisher(rows, "a", "b", "c", "d").withColumn("two_sided", F.round("two_sided", 8))


_SAMPLES = "(SELECT l_suppkey AS site, 1 / (1 + l_quantity) AS l0, 0.5 AS l1, l_quantity / 60 AS l2 FROM lineitem)"


@query(f"""WITH RECURSIVE s AS (SELECT site, sum(1) AS n FROM {_SAMPLES} GROUP BY site), f(site, k, f) AS (SELECT site, 0, CAST(0.5 AS DOUBLE) FROM s
UNION ALL SELECT site, k + 1, f2 FROM (SELECT f.site, f.k, sum((x.l1 * 2 * f * (1 - f) + 2 * x.l2 * f * f) / (x.l0 * (1 - f) * (1 - f) + x.l1 * 2 * f * (1 - f) + x.l2 * f * f)) / (2 * count(*)) AS f2 FROM f JOIN {_SAMPLES} x ON x.site = f.site WHERE f.k < 20 GROUP BY f.site, f.k))
SELECT site, round(f, 6) AS frequency FROM f WHERE k = 20""")
def allele_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_quantity")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("site"), (1 / (1 + q)).alias("l0"), F.lit(0.5).alias("l1"), (q / 60).alias("l2"))
    return variants.allele_frequencies(rows, "site", 20).withColumn("frequency", F.round("frequency", 6))


_GENOTYPES = "(SELECT l_suppkey AS sample, l_partkey % 60 AS site, l_partkey % 7 AS chrom, max(l_linenumber) % 3 AS g FROM lineitem GROUP BY 1, 2, 3)"


@query(f"""WITH s AS (SELECT chrom, site AS a, lead(site) OVER (PARTITION BY chrom ORDER BY site) AS b FROM (SELECT DISTINCT chrom, site FROM {_GENOTYPES}))
SELECT s.chrom, a, b, count(*) AS n, round(pow(corr(x.g, y.g), 2), 8) AS r2 FROM s JOIN {_GENOTYPES} x ON x.chrom = s.chrom AND x.site = a JOIN {_GENOTYPES} y ON y.chrom = s.chrom AND y.site = b AND y.sample = x.sample GROUP BY ALL""")
def linkage_of_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("sample"), (F.col("l_partkey") % 60).alias("site"), (F.col("l_partkey") % 7).alias("chrom")).agg((F.max("l_linenumber") % 3).alias("g"))
    return variants.linkage(rows, "chrom", "site", "sample", "g").withColumn("r2", F.round("r2", 8))


_FIXED = f"""(WITH f AS (SELECT d.id, pos, ref, alt FROM (SELECT id, seq FROM {DOCS}) d, unnest([{{pos: 11 + d.id % 5, n: 2, alt: 'TT'}}, {{pos: 12 + d.id % 5, n: 1, alt: 'G'}}, {{pos: 40, n: 3, alt: 'A'}}, {{pos: 60, n: 1, alt: 'CC,G'}}, {{pos: 70, n: 1, alt: 'GATTACA'}}]) AS t(x), LATERAL (SELECT x.pos AS pos, substr(d.seq, x.pos, x.n) AS ref, x.alt AS alt) WHERE length(d.seq) >= 80),
g AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos) AS k FROM f WHERE NOT contains(alt, ',') AND pos <> 12 + id % 5),
p AS (SELECT g.id, k, substr(seq, coalesce(lag(pos + length(ref)) OVER w, 1), pos - coalesce(lag(pos + length(ref)) OVER w, 1)) || alt AS piece, pos + length(ref) AS till FROM g JOIN {DOCS} s ON s.id = g.id WINDOW w AS (PARTITION BY g.id ORDER BY pos)),
j AS (SELECT id, string_agg(piece, '' ORDER BY k) AS made, max(till) AS till, count(*) AS n FROM p GROUP BY id)
SELECT d.id, CASE WHEN j.id IS NULL THEN seq ELSE made || substr(seq, till) END AS seq, CAST(coalesce(n, 0) AS INTEGER) AS n FROM {DOCS} d LEFT JOIN j ON j.id = d.id)"""


@query(f"SELECT id, md5(seq) AS digest, length(seq) AS size, n FROM {_FIXED}")
def fixes_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants written into contigs; of overlapping ones the first, and none with two alternatives."""
    contigs = seqs(spark, sf_dir).select("id", "seq")
    near = 11 + F.col("id") % 5
    one = lambda pos, n, alt: F.struct(pos.cast("int").alias("pos"), F.lit(n).alias("n"), F.lit(alt).alias("alt"))
    all_ = F.array(one(near, 2, "TT"), one(near + 1, 1, "G"), one(F.lit(40), 3, "A"), one(F.lit(60), 1, "CC,G"), one(F.lit(70), 1, "GATTACA"))
    fixes = contigs.where("length(seq) >= 80").select("id", "seq", F.explode(all_).alias("x")).select("id", "x.pos", F.substr("seq", F.col("x.pos"), F.col("x.n")).alias("ref"), "x.alt")
    return variants.applied(contigs, fixes).select("id", F.md5("seq").alias("digest"), F.length("seq").cast("long").alias("size"), "n")


_REFERENCE = f"(SELECT tig AS id, pos, arg_min(base, id) AS base FROM {_PLACED} GROUP BY tig, pos)"
_FIXES = f"""(WITH p AS MATERIALIZED {_PLACED}, r AS MATERIALIZED (SELECT tig AS id, pos, arg_min(base, id) AS base FROM p GROUP BY tig, pos), c AS MATERIALIZED (SELECT tig AS id, pos, base, count(*) AS n FROM p GROUP BY ALL),
v AS MATERIALIZED (SELECT c.id, c.pos, c.base, n, r.base AS ref FROM c JOIN r ON r.id = c.id AND r.pos = c.pos),
o AS (SELECT id, pos, n AS own FROM v WHERE base = ref), b AS (SELECT id, pos, ref, base, n, row_number() OVER (PARTITION BY id, pos ORDER BY n DESC, base) AS k FROM v WHERE base <> ref)
SELECT b.id, b.pos, b.ref, b.base AS alt FROM b LEFT JOIN o ON o.id = b.id AND o.pos = b.pos WHERE k = 1 AND n >= 3 AND n >= 2 * coalesce(own, 0))"""


def _votes(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    rows = placed(spark, sf_dir)
    # by numbers, which a hash aggregate holds; letters would be sorted
    reference = rows.groupBy(F.col("tig").alias("id"), "pos").agg(F.min_by(F.ascii("base"), "id").alias("c")).select("id", "pos", F.char("c").alias("base"))
    return rows.select(F.col("tig").alias("id"), "pos", "base"), reference


@query(f"SELECT * FROM {_FIXES}")
def fixes_by_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places at which reads vote down the reference's base."""
    return variants.voted_fixes(*_votes(spark, sf_dir), 3)


@query(f"WITH r AS (SELECT id, pos, base FROM {_REFERENCE}) SELECT r.id, string_agg(coalesce(f.alt, r.base), '' ORDER BY r.pos) AS seq FROM r LEFT JOIN {_FIXES} f ON f.id = r.id AND f.pos = r.pos GROUP BY r.id")
def polished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References with the fixes that their reads vote for."""
    from .pipelines import polish

    rows, reference = _votes(spark, sf_dir)
    return polish(rows, reference, 3)


_TRUTH = f"(SELECT id, i + 1 AS pos, base AS ref, CASE WHEN base = 'A' THEN 'G' ELSE 'A' END AS alt FROM (SELECT id, i, substr(seq, CAST(i + 1 AS BIGINT), 1) AS base, length(seq) AS size FROM (SELECT id, seq, unnest(range(length(seq))) AS i FROM {DOCS})) WHERE i >= 10 AND i < size - 10 AND CAST('0x' || left(md5('5/' || id || '/' || i), 8) AS BIGINT) / 4294967296.0 < 0.02)"


@query(f"SELECT id, CAST(pos AS INTEGER) AS pos, ref, alt FROM {_TRUTH}")
def errors_introduced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The truth of errors that are put into sequences."""
    return variants.with_errors(seqs(spark, sf_dir).select("id", "seq").where("seq <> ''"), 0.02, 5, 10)[1]


@query(f"SELECT d.id, md5(string_agg(coalesce(t.alt, d.base), '' ORDER BY d.pos)) AS digest FROM (SELECT id, pos, base FROM {_PLACED}) d LEFT JOIN {_TRUTH} t ON t.id = d.id AND t.pos = d.pos GROUP BY d.id")
def sequences_with_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = variants.with_errors(seqs(spark, sf_dir).select("id", "seq").where("seq <> ''"), 0.02, 5, 10)[0]
    return out.select("id", F.md5("seq").alias("digest"))


@query("SELECT doc_id AS id, length(replace(text, 'e', '')) AS n, length(replace(left(text, 10 + doc_id % 90), 'e', '')) AS unpadded_pos FROM documents")
def pads_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("padded"), (10 + F.col("doc_id") % 90).cast("int").alias("pos"))
    return variants.unpadded(rows, "e").select("id", F.length("seq").cast("long").alias("n"), F.col("unpadded_pos").cast("long").alias("unpadded_pos"))


_FIRST = f"(SELECT id, seq AS a FROM {DOCS})"


@query(f"""WITH p AS (SELECT x.id, x.a, y.a AS b FROM {_FIRST} x JOIN {_FIRST} y ON y.id = x.id + 1), i AS (SELECT id, unnest(range(1, least(length(a), length(b)) + 1)) AS i, a, b FROM p)
SELECT id, count(*) FILTER (WHERE substr(a, CAST(i AS BIGINT), 1) <> substr(b, CAST(i AS BIGINT), 1)) AS nm, levenshtein(any_value(a), any_value(b)) AS distance FROM i GROUP BY id""")
def mismatches_and_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mismatches in place, and the edit distance, of neighbouring reads."""
    rows = seqs(spark, sf_dir).select("id", F.col("seq").alias("a"))
    pairs = rows.join(rows.select((F.col("id") - 1).alias("id"), F.col("a").alias("b")), "id").where("a <> '' and b <> ''")
    return variants.with_distance(variants.mismatches(pairs)).select("id", F.col("nm").cast("long").alias("nm"), "distance")


_RUNS = f"""(WITH p AS (SELECT x.id, x.a, y.a AS b FROM {_FIRST} x JOIN {_FIRST} y ON y.id = x.id + 1), i AS (SELECT id, unnest(range(1, least(length(a), length(b)) + 1)) AS i, a, b FROM p),
d AS (SELECT id, i, substr(a, CAST(i AS BIGINT), 1) AS x, i - coalesce(lag(i) OVER (PARTITION BY id ORDER BY i), 0) - 1 AS run FROM i WHERE substr(a, CAST(i AS BIGINT), 1) <> substr(b, CAST(i AS BIGINT), 1)),
n AS (SELECT id, max(i) AS n FROM i GROUP BY id)
SELECT n.id, coalesce(string_agg(run || x, '' ORDER BY i), '') || (any_value(n.n) - coalesce(max(i), 0)) AS md FROM n LEFT JOIN d ON d.id = n.id GROUP BY n.id)"""


@query(f"SELECT id, md FROM {_RUNS}")
def md_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = seqs(spark, sf_dir).select("id", F.col("seq").alias("a"))
    pairs = rows.join(rows.select((F.col("id") - 1).alias("id"), F.col("a").alias("b")), "id").where("a <> '' and b <> ''")
    return variants.mismatches(pairs).select("id", "md")


_PROFILE = "(SELECT l_suppkey AS ctg, l_partkey % 500 AS pos, count(*) AS coverage, count(*) FILTER (WHERE l_discount > 0.08) AS mismatches, count(*) FILTER (WHERE l_tax > 0.07) AS deletions, count(*) FILTER (WHERE l_quantity > 48) AS inserts FROM lineitem GROUP BY 1, 2)"


@query(f"""WITH s AS (SELECT ctg, pos, pos - row_number() OVER (PARTITION BY ctg ORDER BY pos) AS run FROM {_PROFILE} WHERE (mismatches + deletions) / coverage <= 0.3 AND inserts / coverage <= 0.2)
SELECT ctg, min(pos) AS lo, max(pos) + 1 AS hi FROM s GROUP BY ctg, run HAVING count(*) >= 3""")
def bubbles_between_solid_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    when = lambda c: F.count_if(F.expr(c))
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("ctg"), (F.col("l_partkey") % 500).alias("pos")).agg(F.count("*").alias("coverage"), when("l_discount > 0.08").alias("mismatches"), when("l_tax > 0.07").alias("deletions"), when("l_quantity > 48").alias("inserts"))
    return variants.solid_islands(rows, "ctg", 0.3, 0.2, 3)


@query("""WITH a AS (SELECT l_orderkey * 8 + l_linenumber AS id, l_quantity * 4 + 10 AS score, l_quantity * l_linenumber / 2 AS second, l_quantity + 40 AS matches, l_quantity + 60 AS length, l_linenumber * 2 AS seeds, l_partkey % 20 AS repeats FROM lineitem),
u AS (SELECT *, score / (score + repeats) AS u FROM a)
SELECT id, CAST(least(60, greatest(0, floor(matches / length * least(least(1.0, 0.01 * score) * u, least(1.0, 0.1 * seeds)) * 40 * (1 - second / score * (second / score)) * ln(score)))) AS INTEGER) AS mapq, round(ln((seeds + repeats) / seeds) / 15, 9) AS divergence FROM u""")
def mapping_qualities(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, n = F.col("l_quantity"), F.col("l_linenumber")
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 8 + n).alias("id"), (q * 4 + 10).alias("score"), (q * n / 2).alias("second"), (q + 40).alias("matches"), (q + 60).alias("length"), (n * 2).alias("seeds"), (F.col("l_partkey") % 20).alias("repeats"))
    rows = variants.mapping_quality(rows).withColumns({"found": F.col("seeds"), "total": F.col("seeds") + F.col("repeats")})
    return variants.divergence(rows, 15).select("id", "mapq", F.round("divergence", 9).alias("divergence"))


_MATRIX = [(i * 2654435761) % 65521 for i in range(1, 21)]


@query(f"""WITH k AS (SELECT DISTINCT kmer FROM {dna_sql(k=10, both=False)}), c AS (SELECT kmer, list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split(kmer, ''), lambda b: CAST(instr('ACGT', b) - 1 AS BIGINT))), lambda h, d: h * 4 + d) AS code FROM k)
SELECT kmer, code, list_reduce(list_transform(range(20), lambda i: CASE WHEN (code >> CAST(i AS INTEGER)) & 1 = 1 THEN CAST({_MATRIX}[i + 1] AS BIGINT) ELSE CAST(0 AS BIGINT) END), lambda x, y: xor(x, y)) AS hash FROM c""")
def kmer_matrix_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kmer.enumerate_kmers(seqs(spark, sf_dir), 10, both_strands=False, clean=True).distinct()
    return rows.withColumn("code", variants.kmer_code(F.col("kmer"))).withColumn("hash", variants.gf2_hash(F.col("code"), _MATRIX))


@query(f"""WITH s AS (SELECT id, pos, lead(pos) OVER (PARTITION BY id, kmer ORDER BY pos) AS q FROM {dna_sql(k=12, both=False)}), r AS (SELECT id, pos AS p, q - pos AS d, pos - row_number() OVER (PARTITION BY id, q - pos ORDER BY pos) AS run FROM s WHERE q IS NOT NULL)
SELECT id, min(p) AS p, min(p) + d AS q, count(*) + 11 AS length FROM r GROUP BY id, d, run""")
def exact_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of 12 letters or more that a sequence has twice."""
    return variants.exact_repeats(seqs(spark, sf_dir).select("id", "seq"), 12).select("id", F.col("p").cast("long").alias("p"), F.col("q").cast("long").alias("q"), "length")


_FAMILY = "(SELECT o_orderkey AS id, -o_totalprice % 7 AS f0, -o_totalprice % 5 AS f1, -o_totalprice % 11 AS f2, -(o_custkey % 9) * 1.0 AS m0, -(o_custkey % 4) * 1.0 AS m1, -(o_custkey % 13) * 1.0 AS m2, -(o_orderkey % 8) * 1.0 AS c0, -(o_orderkey % 6) * 1.0 AS c1, -(o_orderkey % 3) * 1.0 AS c2 FROM orders)"
_CONSTRAINED = ", ".join(f"f{f} + m{m} + c{c}" for f, m, c in variants.FAMILIES)


@query(f"SELECT id, round(greatest({_CONSTRAINED}), 6) AS constrained, round(greatest(f0, f1, f2) + greatest(m0, m1, m2) + greatest(c0, c1, c2), 6) AS free FROM {_FAMILY}")
def trio_likelihoods(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, c, o = F.col("o_totalprice"), F.col("o_custkey"), F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(o.alias("id"), *((-p % n).alias(f"f{i}") for i, n in enumerate((7, 5, 11))), *((-(c % n) * 1.0).alias(f"m{i}") for i, n in enumerate((9, 4, 13))), *((-(o % n) * 1.0).alias(f"c{i}") for i, n in enumerate((8, 6, 3))))
    return variants.trio_likelihoods(rows).select("id", F.round("constrained", 6).alias("constrained"), F.round("free", 6).alias("free"))


_SITE = "(SELECT o_custkey AS site, o_orderkey AS s, 1 / (1 + o_orderkey % 5) AS l0, 0.4 AS l1, (1 + o_orderkey % 7) / 9 AS l2 FROM orders)"


@query(f"""WITH RECURSIVE s AS (SELECT site, l0, l1, l2, row_number() OVER (PARTITION BY site ORDER BY s) AS j FROM {_SITE}),
t(site, j, z) AS (SELECT DISTINCT site, CAST(0 AS BIGINT), [CAST(1 AS DOUBLE)] FROM s UNION ALL
  SELECT t.site, s.j, list_transform(range(2 * s.j + 1), lambda k: ((2 * s.j - k) * (2 * s.j - k - 1) * l0 * CASE WHEN k < 2 * s.j - 1 THEN z[k + 1] ELSE 0 END + 2 * k * (2 * s.j - k) * l1 * CASE WHEN k >= 1 AND k - 1 < 2 * s.j - 1 THEN z[k] ELSE 0 END + k * (k - 1) * l2 * CASE WHEN k >= 2 THEN z[k - 1] ELSE 0 END) / (2 * s.j * (2 * s.j - 1))) FROM t JOIN s ON s.site = t.site AND s.j = t.j + 1),
l AS (SELECT site, max(j) AS n, arg_max(z, j) AS z FROM t GROUP BY site),
w AS (SELECT site, n, list_transform(range(2 * n + 1), lambda k: z[k + 1] * CASE WHEN k = 0 THEN 1 - list_sum(list_transform(range(1, 2 * n + 1), lambda i: 0.001 / i)) ELSE 0.001 / k END) AS w FROM l)
SELECT site, CAST(n AS INTEGER) AS n, round(w[1] / list_sum(w), 6) AS p_none, round(list_sum(list_transform(range(2 * n + 1), lambda k: k * w[k + 1])) / list_sum(w), 6) AS expected FROM w""")
def allele_count_posteriors(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("site"), o.alias("s"), (1 / (1 + o % 5)).alias("l0"), F.lit(0.4).alias("l1"), ((1 + o % 7) / 9).alias("l2"))
    out = variants.allele_count_posteriors(rows, "site", "s")
    return out.select("site", "n", F.round("p_none", 6).alias("p_none"), F.round("expected", 6).alias("expected"))


@query()
def targets_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Covered stretches of contigs with their consensus; reads are the documents' letters, dealt over 50 contigs of 40,000 places, and entering a target costs as much as 350 empty places."""
    rows = seqs(spark, sf_dir).where("length(seq) > 0").select("id", F.posexplode(F.split("seq", "")).alias("i", "base"))
    begin = F.pmod(F.col("id") * 7919, F.lit(40_000))
    columns = rows.select((F.col("id") % 50).alias("id"), (begin + F.col("i")).cast("long").alias("pos"), "base", (10 + (F.col("id") * 7 + F.col("i")) % 30).cast("int").alias("q"))
    sites = graph.kept(targets.sites(columns))
    return targets.with_consensus(targets.targets(sites, enter=1400), sites)
