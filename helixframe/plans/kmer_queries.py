"""k-mer operators over the letters A, C, G and T of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sequence import dna, dna_with_gaps, gc_fraction, is_simple_repeat, poisson_term, quality_masked
from ..operators import kmer
from .registry import query, table

K = 8


def seqs(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """id, seq, lang (of documents). A table of fewer splits than cores, as one
    of a single row group is, has its rows dealt out before letters are taken
    from them; a larger one is not shuffled."""
    id_col = {"documents": "doc_id", "benchmark": "item_id", "pages": "page_id"}[name]
    text = {"pages": "html"}.get(name, "text")
    keep = ["lang"] if name == "documents" else []
    rows = table(spark, sf_dir, name).select(F.col(id_col).alias("id"), F.col(text).alias("text"), *keep)
    cores = max(8, spark.sparkContext.defaultParallelism)
    if rows._jdf.queryExecution().toRdd().getNumPartitions() < cores:
        rows = rows.repartition(cores, "id")
    return rows.select("id", dna(F.col("text")).alias("seq"), *keep)


def dna_sql(name: str = "documents", where: str = "", k: int = K, both: bool = True) -> str:
    """SQL for id, pos, kmer of a table."""
    id_col = {"documents": "doc_id", "benchmark": "item_id", "pages": "page_id"}[name]
    text = {"pages": "html"}.get(name, "text")
    lang = ", lang" if name == "documents" else ""
    m = f"substr(s, i, {k})"
    c = f"least({m}, reverse(translate({m}, 'ACGT', 'TGCA')))" if both else m
    return f"(SELECT id{lang}, i - 1 AS pos, {c} AS kmer FROM (SELECT id{lang}, s, unnest(range(1, length(s) - {k} + 2)) AS i FROM (SELECT {id_col} AS id{lang}, regexp_replace(upper({text}), '[^ACGT]', '', 'g') AS s FROM {name} {where}) WHERE length(s) >= {k}))"


COUNTS = f"(SELECT kmer, count(*) AS cnt FROM {dna_sql()} GROUP BY kmer)"


def of_lang(lang: str) -> str:
    return f"(SELECT kmer, count(*) AS cnt FROM {dna_sql(where=f'''WHERE lang = '{lang}' ''')} GROUP BY kmer)"


def counts(spark, sf_dir, lang: str | None = None, k: int = K) -> DataFrame:
    rows = seqs(spark, sf_dir)
    return kmer.count(rows if lang is None else rows.where(F.col("lang") == lang), k, clean=True)


@query(f"SELECT cnt AS bucket, count(*) AS n FROM {COUNTS.replace('count(*) AS cnt', 'least(count(*), 10001) AS cnt')} GROUP BY cnt")
def kmer_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmer.histogram(counts(spark, sf_dir))


@query("""WITH s AS (SELECT doc_id AS id, regexp_replace(upper(text), '[^ACGT]', 'N', 'g') AS s FROM documents),
m AS (SELECT id, substr(s, i, 3) AS kmer FROM (SELECT id, s, unnest(range(1, length(s) - 1)) AS i FROM s WHERE length(s) >= 3))
SELECT kmer, count(*) AS cnt FROM m WHERE NOT contains(kmer, 'N') GROUP BY kmer""")
def kmers_reset_at_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(dna_with_gaps(F.col("text")).alias("seq"))
    return kmer.count(rows, 3, both_strands=False)


QUALITY = "translate(reverse(s), 'ACGT', '&5?I')"
MASKED = f"(SELECT id, s, array_to_string(list_transform(range(1, length(s) + 1), lambda i: CASE WHEN ord(substr(q, i, 1)) - 33 < 10 THEN 'N' ELSE substr(s, i, 1) END), '') AS masked FROM (SELECT doc_id AS id, s, {QUALITY} AS q FROM (SELECT doc_id, regexp_replace(upper(text), '[^ACGT]', '', 'g') AS s FROM documents) WHERE length(s) >= 6))"


def masked_reads(spark, sf_dir) -> DataFrame:
    rows = seqs(spark, sf_dir).where(F.length("seq") >= 6)
    return rows.withColumn("masked", quality_masked(F.col("seq"), F.translate(F.reverse("seq"), "ACGT", "&5?I"), 10))


def _masked_kmers(column: str) -> str:
    return f"(SELECT id, substr(s, i, 6) AS k, substr(masked, i, 6) AS m FROM (SELECT id, s, masked, unnest(range(1, length(s) - 4)) AS i FROM {MASKED}))"


@query(f"SELECT least(m, reverse(translate(m, 'ACGT', 'TGCA'))) AS kmer, count(*) AS cnt FROM {_masked_kmers('m')} WHERE NOT contains(m, 'N') GROUP BY 1")
def kmers_quality_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmer.count(masked_reads(spark, sf_dir), 6, seq_col="masked")


@query(f"""SELECT kmer, least(127, CASE WHEN g > 0 THEN g ELSE n END) AS cnt, g > 0 AS hq FROM (
  SELECT least(k, reverse(translate(k, 'ACGT', 'TGCA'))) AS kmer, count(*) AS n, count(*) FILTER (WHERE NOT contains(m, 'N')) AS g FROM {_masked_kmers('k')} GROUP BY 1)""")
def kmer_quality_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmer.quality_counts(masked_reads(spark, sf_dir), 6, 10)


@query(f"""SELECT cnt, hq, count(*) AS n FROM (SELECT least(127, CASE WHEN g > 0 THEN g ELSE n END) AS cnt, g > 0 AS hq FROM (
  SELECT least(k, reverse(translate(k, 'ACGT', 'TGCA'))) AS kmer, count(*) AS n, count(*) FILTER (WHERE NOT contains(m, 'N')) AS g FROM {_masked_kmers('k')} GROUP BY 1)) GROUP BY cnt, hq""")
def kmer_quality_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmer_quality_database(spark, sf_dir).groupBy("cnt", "hq").agg(F.count("*").alias("n"))


@query(f"SELECT kmer, cnt FROM {COUNTS}")
def kmer_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(spark, sf_dir)


@query(f"SELECT f.kmer, coalesce(c.cnt, 0) AS cnt FROM (SELECT DISTINCT kmer FROM {dna_sql('benchmark', k=11)}) f LEFT JOIN (SELECT kmer, count(*) AS cnt FROM {dna_sql(k=11)} GROUP BY kmer) c ON f.kmer = c.kmer")
def kmer_count_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmer.count_listed(seqs(spark, sf_dir), seqs(spark, sf_dir, "benchmark"), 11)


@query(f"SELECT kmer, cnt FROM {COUNTS} WHERE cnt BETWEEN 5 AND 50")
def kmer_count_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmer.count(seqs(spark, sf_dir), K, least=5, most=50)


@query(f"SELECT kmer, cnt FROM {COUNTS} WHERE kmer IN (SELECT kmer FROM {dna_sql('pages')} GROUP BY kmer HAVING count(*) > 1)")
def kmer_count_prefiltered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmer.count_prefiltered(counts(spark, sf_dir), kmer.count(seqs(spark, sf_dir, "pages"), K))


@query(f"SELECT kmer, cnt - 1 AS cnt FROM {COUNTS} WHERE cnt > 1")
def kmer_count_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmer.count_one_pass(counts(spark, sf_dir))


@query(f"SELECT q.kmer, least(coalesce(c.cnt, 0), 2) AS seen FROM (SELECT DISTINCT kmer FROM {dna_sql('benchmark')}) q LEFT JOIN {of_lang('de')} c ON q.kmer = c.kmer")
def kmer_bloom_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmer.bloom_query(kmer.enumerate_kmers(seqs(spark, sf_dir, "benchmark"), K), counts(spark, sf_dir, "de"))


@query(f"""SELECT b.bucket, coalesce(n, 0) AS n FROM (SELECT unnest(range(5, 215, 10)) AS bucket) b LEFT JOIN (
  SELECT CASE WHEN cnt < 5 THEN 5 WHEN cnt > 205 THEN 5 + 20 * 10 ELSE 5 + (cnt - 5) // 10 * 10 END AS bucket, count(*) AS n FROM {COUNTS} GROUP BY 1) h ON b.bucket = h.bucket""")
def kmer_histogram_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmer.histogram(counts(spark, sf_dir), low=15, high=195, increment=10, full=True)


@query(f"SELECT count(*) FILTER (WHERE cnt = 1) AS n_unique, count(*) AS n_distinct, CAST(sum(cnt) AS BIGINT) AS n_total, max(cnt) AS max_count FROM {COUNTS} WHERE cnt <= 1000")
def kmer_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmer.stats(counts(spark, sf_dir), 0, 1000)


@query(f"SELECT q.id, q.pos, q.kmer, coalesce(c.cnt, 0) AS cnt FROM {dna_sql('benchmark')} q LEFT JOIN {of_lang('es')} c ON q.kmer = c.kmer")
def kmer_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = kmer.enumerate_kmers(seqs(spark, sf_dir, "benchmark"), K, keep=("id",), positions=True)
    return kmer.query(asked, counts(spark, sf_dir, "es")).select("id", "pos", "kmer", "cnt")


@query(f"SELECT kmer, CAST(sum(cnt) AS BIGINT) AS cnt FROM (SELECT * FROM {of_lang('de')} UNION ALL SELECT * FROM {of_lang('fr')} UNION ALL SELECT * FROM {of_lang('es')}) GROUP BY kmer HAVING sum(cnt) BETWEEN 2 AND 500")
def kmer_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmer.merge([counts(spark, sf_dir, x) for x in ("de", "fr", "es")], 2, 500)


@query("""WITH s AS (SELECT regexp_replace(regexp_replace(upper(text), '[^ACGT]', '', 'g'), 'A+', 'A', 'g') AS s FROM documents),
t AS (SELECT regexp_replace(regexp_replace(regexp_replace(s, 'C+', 'C', 'g'), 'G+', 'G', 'g'), 'T+', 'T', 'g') AS s FROM s),
m AS (SELECT i - 1 AS pos, substr(s, i, 6) AS kmer FROM (SELECT s, unnest(range(1, length(s) - 4)) AS i FROM t WHERE length(s) >= 6))
SELECT kmer, count(*) AS cnt, min(pos) AS first_pos, max(pos) AS last_pos FROM m GROUP BY kmer""")
def kmer_compressed_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmer.compressed_positions(seqs(spark, sf_dir), 6)


def _algebra(how: str, value: str, having: str):
    sql = f"SELECT kmer, CAST({value} AS BIGINT) AS cnt FROM (SELECT * FROM {of_lang('de')} UNION ALL SELECT * FROM {of_lang('fr')} UNION ALL SELECT * FROM {of_lang('es')}) GROUP BY kmer{having}"

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return kmer.combine([counts(spark, sf_dir, x) for x in ("de", "fr", "es")], how)

    run.__name__ = f"kmer_tables_{how}"
    query(sql)(run)


for _how, _value, _having in (
    ("min", "min(cnt)", " HAVING count(*) = 3"),
    ("max", "max(cnt)", " HAVING count(*) = 3"),
    ("min_exist", "min(cnt)", ""),
    ("max_exist", "max(cnt)", ""),
    ("add", "sum(cnt)", ""),
    ("and", "1", " HAVING count(*) = 3"),
    ("nand", "1", " HAVING count(*) < 3"),
    ("or", "1", ""),
    ("xor", "1", " HAVING count(*) % 2 = 1"),
):
    _algebra(_how, _value, _having)


def _difference(how: str, value: str):
    sql = f"SELECT kmer, CAST(v AS BIGINT) AS cnt FROM (SELECT coalesce(a.kmer, b.kmer) AS kmer, coalesce(a.cnt, 0) AS x, coalesce(b.cnt, 0) AS y, {value} AS v FROM {of_lang('de')} a FULL JOIN {of_lang('fr')} b ON a.kmer = b.kmer) WHERE v > 0"

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return kmer.difference(counts(spark, sf_dir, "de"), counts(spark, sf_dir, "fr"), how)

    run.__name__ = f"kmer_tables_{how}"
    query(sql)(run)


_X, _Y = "coalesce(a.cnt, 0)", "coalesce(b.cnt, 0)"
for _how, _value in (("sub", f"{_X} - {_Y}"), ("abs", f"abs({_X} - {_Y})"), ("divide", f"CASE WHEN {_X} > 0 AND {_Y} > 0 THEN 1000 * {_X} // nullif({_Y}, 0) ELSE 0 END")):
    _difference(_how, _value)


@query(f"SELECT 'le' AS how, kmer, cnt FROM {COUNTS} WHERE cnt <= 3 UNION ALL SELECT 'ge', kmer, cnt FROM {COUNTS} WHERE cnt >= 40 UNION ALL SELECT 'eq', kmer, cnt FROM {COUNTS} WHERE cnt = 7")
def kmer_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = counts(spark, sf_dir)
    le, ge, eq = (kmer.threshold(every, how, n).select(F.lit(how).alias("how"), "kmer", "cnt") for how, n in (("le", 3), ("ge", 40), ("eq", 7)))
    return le.unionByName(ge).unionByName(eq)


@query(f"""WITH h AS (SELECT cnt, count(*) AS n FROM {COUNTS} GROUP BY cnt),
r AS (SELECT cnt, n, lead(n) OVER (ORDER BY cnt) AS next_n, sum(n) OVER (ORDER BY cnt) AS d, sum(n * cnt) OVER (ORDER BY cnt) AS t FROM h),
v AS (SELECT min(cnt) FILTER (WHERE next_n >= n) AS valley FROM r)
SELECT (SELECT valley FROM v) AS valley,
  (SELECT cnt FROM r WHERE cnt >= (SELECT valley FROM v) ORDER BY n DESC, cnt LIMIT 1) AS peak,
  (SELECT greatest(5, least(250, min(cnt))) FROM r WHERE d >= 0.995 * (SELECT sum(n) FROM h) OR 3 * t >= 2 * (SELECT sum(n * cnt) FROM h)) AS max_count""")
def kmer_coverage_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmer.coverage_peak(kmer.spectrum(counts(spark, sf_dir)))


@query(f"SELECT id, pos, kmer FROM {dna_sql('benchmark')} WHERE kmer IN (SELECT kmer FROM {COUNTS} WHERE cnt >= 3)")
def kmer_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = kmer.enumerate_kmers(seqs(spark, sf_dir, "benchmark"), K, keep=("id",), positions=True)
    return asked.join(kmer.count(seqs(spark, sf_dir), K, least=3), "kmer", "left_semi").select("id", "pos", "kmer")


@query(f"SELECT q.id, count(*) FILTER (WHERE c.cnt IS NULL) AS n_missing, count(*) FILTER (WHERE c.cnt < 15) AS n_single, count(*) FILTER (WHERE c.cnt >= 15 AND c.cnt < 25) AS n_double, count(*) FILTER (WHERE c.cnt >= 25) AS n_repeat FROM {dna_sql('pages')} q LEFT JOIN {COUNTS} c ON q.kmer = c.kmer GROUP BY q.id")
def kmer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    # there are 4^8 / 2 k-mers or little more, on any input: their counts go to the pages
    contigs = kmer.codes(seqs(spark, sf_dir, "pages"), K, keep=("id",)).withColumnRenamed("code", "kmer")
    return kmer.profile(contigs, F.broadcast(kmer.count_codes(seqs(spark, sf_dir), K).withColumnRenamed("code", "kmer")), F.lit(10))


@query(f"""WITH r AS (SELECT DISTINCT id, kmer FROM {dna_sql(k=9)}), c AS (SELECT kmer, count(*) AS cnt FROM {dna_sql(k=9)} GROUP BY kmer HAVING count(*) >= 2),
j AS (SELECT r.id, r.kmer, c.cnt, row_number() OVER (PARTITION BY r.id ORDER BY c.cnt DESC) AS k, count(*) OVER (PARTITION BY r.id) AS n FROM r JOIN c ON r.kmer = c.kmer WHERE c.cnt <= 400),
l AS (SELECT id, min(cnt) AS lim FROM j WHERE k <= greatest(1, floor(n * 0.05)) GROUP BY id)
SELECT j.id, j.kmer, j.cnt FROM j JOIN l ON j.id = l.id WHERE j.cnt >= l.lim""")
def kmer_select_frequent(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a read's k-mers come together once; the counts, 4^9 / 2 or little more on any input, go to them
    reads = kmer.codes(seqs(spark, sf_dir), 9, keep=("id",)).withColumnRenamed("code", "kmer").repartition("id").distinct()
    counts_ = F.broadcast(kmer.count_codes(seqs(spark, sf_dir), 9, least=2).withColumnRenamed("code", "kmer").where("cnt <= 400"))
    return kmer.select_frequent(reads, counts_, 0.05, 400).withColumn("kmer", kmer.letters_of(F.col("kmer"), 9))


@query(f"SELECT 100.0 * coalesce(sum(cnt) FILTER (WHERE cnt >= 2), 0) / (count(*) FILTER (WHERE cnt >= 2) + 1) AS cutoff FROM {COUNTS}")
def kmer_repetitive_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmer.repetitive_cutoff(kmer.spectrum(counts(spark, sf_dir)), 2, 100)


@query(f"WITH h AS (SELECT cnt, sum(count(*)) OVER (ORDER BY cnt DESC) AS above FROM {COUNTS} GROUP BY cnt) SELECT greatest(2, (SELECT cnt FROM h ORDER BY abs(above - 20000), cnt DESC LIMIT 1)) AS least_count")
def kmer_least_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmer.least_count(kmer.spectrum(counts(spark, sf_dir)), 20_000)


MINIMIZERS = f"""(WITH m AS (SELECT id, pos, kmer AS f, least(kmer, reverse(translate(kmer, 'ACGT', 'TGCA'))) AS c FROM {dna_sql(k=7, both=False)}),
n AS (SELECT id, pos, c, row_number() OVER w AS r, min(c) OVER (PARTITION BY id ORDER BY pos ROWS 4 PRECEDING) AS least FROM m WHERE f <> reverse(translate(f, 'ACGT', 'TGCA')) WINDOW w AS (PARTITION BY id ORDER BY pos)),
x AS (SELECT *, max(CASE WHEN r >= 5 THEN least END) OVER (PARTITION BY id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS most FROM n)
SELECT id, pos, c AS minimizer FROM x WHERE c <= most)"""


@query(f"SELECT * FROM {MINIMIZERS}")
def kmer_minimizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmer.minimizers(seqs(spark, sf_dir), 7, 5)


@query(f"SELECT quantile_cont(cnt, 0.98) AS cutoff FROM (SELECT count(*) AS cnt FROM {MINIMIZERS} GROUP BY minimizer)")
def kmer_minimizer_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmer.frequent_cutoff(kmer.minimizers(seqs(spark, sf_dir), 7, 5), "minimizer", 0.02)


@query(f"SELECT count(*) AS genome_size FROM (SELECT kmer FROM {dna_sql(k=31)} GROUP BY kmer HAVING count(*) >= 2)")
def kmer_genome_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmer.count_codes(seqs(spark, sf_dir), 31, least=2).agg(F.count("*").alias("genome_size"))


@query(f"""SELECT c.id, count(*) FILTER (WHERE a.kmer IS NOT NULL AND b.kmer IS NULL) AS n_one, count(*) FILTER (WHERE b.kmer IS NOT NULL AND a.kmer IS NULL) AS n_two, count(*) FILTER (WHERE a.kmer IS NOT NULL AND b.kmer IS NOT NULL) AS n_both
FROM {dna_sql(where="WHERE lang = 'en'")} c LEFT JOIN (SELECT kmer FROM {of_lang('de')} WHERE cnt > 1) a ON c.kmer = a.kmer LEFT JOIN (SELECT kmer FROM {of_lang('fr')} WHERE cnt > 1) b ON c.kmer = b.kmer GROUP BY c.id""")
def kmer_trio(spark: SparkSession, sf_dir: str) -> DataFrame:
    child = kmer.enumerate_kmers(seqs(spark, sf_dir).where("lang = 'en'"), K, keep=("id",))
    return kmer.classify_parents(child, counts(spark, sf_dir, "de"), counts(spark, sf_dir, "fr"))


@query(f"SELECT kmer, cnt FROM (SELECT kmer, count(*) AS cnt FROM {dna_sql(k=6, both=False)} GROUP BY kmer) WHERE substr(kmer, 1, 5) = substr(kmer, 2, 5) OR substr(kmer, 1, 4) = substr(kmer, 3, 4) OR substr(kmer, 1, 3) = substr(kmer, 4, 3)")
def kmer_simple_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmer.count(seqs(spark, sf_dir), 6, both_strands=False).where(is_simple_repeat(F.col("kmer")))


def _links_sql(k: int) -> str:
    each = ", ".join(f"count(*) FILTER (WHERE {side} = '{b}') AS {name}_{b}" for name, side in (("in", "x"), ("out", "y")) for b in "ACGT")
    return f"SELECT kmer, count(*) AS cnt, {each} FROM (SELECT substr(s, i, {k}) AS kmer, CASE WHEN i > 1 THEN substr(s, i - 1, 1) END AS x, substr(s, i + {k}, 1) AS y FROM (SELECT s, unnest(range(1, length(s) - {k} + 2)) AS i FROM (SELECT regexp_replace(upper(text), '[^ACGT]', '', 'g') AS s FROM documents) WHERE length(s) >= {k})) GROUP BY kmer"


@query(_links_sql(7))
def kmer_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmer.links(seqs(spark, sf_dir), 7)


@query(f"SELECT kmer, cnt FROM ({_links_sql(7)}) WHERE cnt > 2 AND NOT (in_A + in_C + in_G + in_T = 0 AND out_A + out_C + out_G + out_T = 0)")
def kmer_low_coverage_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    any_link = " + ".join(f"{side}_{b}" for side in ("in", "out") for b in "ACGT")
    return kmer.links(seqs(spark, sf_dir), 7).where(f"cnt > 2 and {any_link} > 0").select("kmer", "cnt")


@query(f"SELECT kmer, count(*) AS cnt FROM {dna_sql(k=9)} WHERE pos % 5 = 0 GROUP BY kmer")
def kmer_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kmer.enumerate_kmers(seqs(spark, sf_dir), 9, keep=("id",), positions=True)
    return rows.where("pos % 5 = 0").groupBy("kmer").agg(F.count("*").alias("cnt"))


@query("SELECT doc_id AS id, length(s) AS size, length(regexp_replace(s, '[^GC]', '', 'g')) / nullif(length(s), 0) AS gc FROM (SELECT doc_id, regexp_replace(upper(text), '[^ACGT]', '', 'g') AS s FROM documents)")
def gc_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seqs(spark, sf_dir).select("id", F.length("seq").cast("long").alias("size"), gc_fraction(F.col("seq")).alias("gc"))


@query(f"""WITH q AS (SELECT least(k, reverse(translate(k, 'ACGT', 'TGCA'))) AS kmer, count(*) FILTER (WHERE NOT contains(m, 'N')) AS g FROM {_masked_kmers('k')} GROUP BY 1),
c AS (SELECT sum(least(g, 127)) / count(*) AS coverage FROM q WHERE g > 0),
t AS (SELECT coverage, n, exp(-coverage * 0.01 + n * ln(coverage * 0.01) - lgamma(n + 1)) AS term FROM c, (SELECT unnest(range(2, 1000)) AS n))
SELECT max(coverage) AS coverage, coalesce(min(n) FILTER (WHERE term < 0.000001) + 1, 0) AS cutoff FROM t""")
def poisson_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = kmer_quality_database(spark, sf_dir).where("hq").agg((F.sum("cnt") / F.count("*")).alias("coverage"))
    terms = good.select("coverage", F.explode(F.sequence(F.lit(2), F.lit(999))).alias("n"))
    terms = terms.withColumn("term", poisson_term(F.col("coverage") * 0.01, F.col("n")))
    return terms.agg(F.max("coverage").alias("coverage"), F.coalesce(F.min(F.when(F.col("term") < 1e-6, F.col("n"))) + 1, F.lit(0)).alias("cutoff"))
