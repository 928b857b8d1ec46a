"""Files and stores: each query writes its whole table in a format, to the
shared folder, and reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sequence import cigar_operations
from ..operators import stores
from ..operators.graph import new_path
from ..sources import readers, writers
from .kmer_queries import seqs
from .overlap_queries import ALIGNMENTS, CHILD, OVERLAPS, aligned, overlaps
from .record_queries import DAY, DOCS, READS, reads
from .registry import query, table


def reads_with_qualities(spark, sf_dir) -> DataFrame:
    rows = seqs(spark, sf_dir).where(F.length("seq") > 0)
    return rows.select(F.col("id").cast("string").alias("id"), "seq", F.translate(F.reverse("seq"), "ACGT", "&5?I").alias("qual"))


@query(f"SELECT CAST(id AS VARCHAR) AS id, length(seq) AS n, md5(seq) AS digest FROM {DOCS}")
def source_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "fasta")
    writers.fasta(seqs(spark, sf_dir).select("id", "seq"), path, 60)
    return readers.fasta(spark, path).select("id", F.length("seq").cast("long").alias("n"), F.md5("seq").alias("digest"))


@query(f"SELECT CAST(id AS VARCHAR) AS id, md5(seq) AS seq, md5(translate(reverse(seq), 'ACGT', '&5?I')) AS qual FROM {DOCS} WHERE length(seq) > 0")
def source_fastq(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "fastq")
    writers.fastq(reads_with_qualities(spark, sf_dir), path)
    return readers.fastq(spark, path).select("id", F.md5("seq").alias("seq"), F.md5("qual").alias("qual"))


@query(f"SELECT CAST(id AS VARCHAR) AS id, md5(seq) AS digest FROM {DOCS} WHERE length(seq) > 0")
def source_fastq_to_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = new_path(spark, "fastq"), new_path(spark, "fasta")
    writers.fastq(reads_with_qualities(spark, sf_dir), first)
    writers.fasta(readers.fastq(spark, first).select("id", "seq"), second)
    return readers.fasta(spark, second).select("id", F.md5("seq").alias("digest"))


def _sam(spark, sf_dir, name="sam") -> DataFrame:
    path = new_path(spark, name)
    rows = reads(spark, sf_dir).select("qname", "flag", F.concat(F.lit("t"), F.col("tid").cast("string")).alias("tid"), "pos", "mapq", F.concat(F.col("l_seq").cast("string"), F.lit("M")).alias("cigar"), F.concat(F.lit("t"), F.col("mtid").cast("string")).alias("mtid"), F.lit(0).alias("mpos"), F.lit(0).alias("isize"), F.expr("repeat('A', l_seq)").alias("seq"), F.expr("repeat('I', l_seq)").alias("qual"))
    writers.sam(rows, path)
    return readers.sam(spark, path)


@query(f"SELECT qname, flag, 't' || tid AS tid, pos, mapq, l_seq || 'M' AS cigar, 't' || mtid AS mtid, CAST(l_seq AS INTEGER) AS n FROM {READS}")
def source_sam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sam(spark, sf_dir).select("qname", "flag", "tid", "pos", "mapq", "cigar", "mtid", F.length("seq").alias("n"))


@query(f"SELECT 't' || tid AS tid, CAST(2 * count(*) AS BIGINT) AS n FROM {READS} GROUP BY tid")
def source_sam_concatenated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files of alignments as one."""
    return _sam(spark, sf_dir, "one").unionByName(_sam(spark, sf_dir, "two")).groupBy("tid").agg(F.count("*").alias("n"))


@query(f"SELECT 's' || l_suppkey AS chrom, CAST({DAY.format('l_shipdate')} AS BIGINT) AS bgn, CAST({DAY.format('l_shipdate')} + CAST(l_quantity AS INTEGER) AS BIGINT) AS \"end\" FROM lineitem")
def source_bed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "bed")
    lo = F.datediff(F.to_date("l_shipdate"), F.lit("1990-01-01").cast("date"))
    writers.bed(table(spark, sf_dir, "lineitem").select(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("chrom"), lo.alias("bgn"), (lo + F.col("l_quantity").cast("int")).alias("end")), path)
    return readers.bed(spark, path).select("chrom", "bgn", "end")


@query(f"SELECT 'q' || qry AS qname, 't' || ref AS tname, count(*) AS n, CAST(sum(abs(e_r - s_r)) AS BIGINT) AS bases, CAST(max(abs(e_q - s_q)) AS BIGINT) AS longest FROM {ALIGNMENTS} GROUP BY 1, 2")
def source_paf_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments read from a PAF file, by query and target."""
    path = new_path(spark, "paf")
    a = aligned(spark, sf_dir)
    n = F.col("e_r") - F.col("s_r")
    rows = a.select(F.concat(F.lit("q"), F.col("qry").cast("string")).alias("qname"), F.lit(100_000).alias("qlen"), F.least("s_q", "e_q").alias("qbgn"), F.greatest("s_q", "e_q").alias("qend"), F.when(F.col("s_q") <= F.col("e_q"), "+").otherwise("-").alias("strand"), F.concat(F.lit("t"), F.col("ref").cast("string")).alias("tname"), F.lit(100_000).alias("tlen"), F.col("s_r").alias("tbgn"), F.col("e_r").alias("tend"), n.alias("matches"), n.alias("length"), F.lit(60).alias("mapq"))
    writers.paf(rows, path)
    return readers.paf(spark, path).groupBy("qname", "tname").agg(F.count("*").alias("n"), F.sum(F.col("tend") - F.col("tbgn")).alias("bases"), F.max(F.col("qend") - F.col("qbgn")).alias("longest"))


@query(f'SELECT CAST(frg AS VARCHAR) AS child, CAST(ctg AS VARCHAR) AS parent, bgn, e AS "end", ori FROM {CHILD}')
def source_posmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .overlap_queries import _places

    path = new_path(spark, "posmap")
    child, _ = _places(spark, sf_dir)
    writers.posmap(child.select(F.col("frg").alias("child"), F.col("ctg").alias("parent"), "bgn", "end", "ori"), path)
    return readers.posmap(spark, path)


@query(f"SELECT 'r' || ref AS ref, 'q' || qry AS qry, s_r, e_r, s_q, e_q, CAST(aln % 5 AS BIGINT) AS errors, aln % 3 AS n_deltas, CASE WHEN aln % 3 = 0 THEN 0 ELSE (aln % 7 + 1) * (aln % 3) END AS sum_deltas FROM {ALIGNMENTS}")
def source_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "delta")
    deltas = F.expr("array_repeat(int(aln % 7 + 1), int(aln % 3))")
    rows = aligned(spark, sf_dir).select(F.concat(F.lit("r"), F.col("ref").cast("string")).alias("ref"), F.concat(F.lit("q"), F.col("qry").cast("string")).alias("qry"), F.lit(100_000).alias("ref_len"), F.lit(90_000).alias("qry_len"), "s_r", "e_r", "s_q", "e_q", (F.col("aln") % 5).alias("errors"), F.lit(0).alias("similarity_errors"), F.lit(0).alias("stops"), deltas.alias("deltas"))
    writers.delta(rows, path)
    out = readers.delta(spark, path)
    return out.select("ref", "qry", "s_r", "e_r", "s_q", "e_q", "errors", F.size("deltas").cast("long").alias("n_deltas"), F.aggregate("deltas", F.lit(0).cast("long"), lambda s, d: s + d).alias("sum_deltas"))


@query("SELECT 'c' || o_custkey AS chrom, o_orderkey AS pos, left(o_orderstatus, 1) AS ref, left(o_orderpriority, 1) AS alt, o_totalprice AS qual FROM orders")
def source_vcf(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "vcf")
    rows = table(spark, sf_dir, "orders").select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("chrom"), F.col("o_orderkey").alias("pos"), F.lit(None).cast("string").alias("id"), F.left("o_orderstatus", F.lit(1)).alias("ref"), F.left("o_orderpriority", F.lit(1)).alias("alt"), F.col("o_totalprice").alias("qual"), F.lit("PASS").alias("filter"), F.lit("DP=1").alias("info"))
    writers.vcf(rows, path)
    return readers.vcf(spark, path).select("chrom", "pos", "ref", "alt", "qual")


def _messages(spark, sf_dir) -> DataFrame:
    """FRG messages of documents and LKG messages of neighbouring ones, read from a file of both."""
    path = new_path(spark, "messages")
    rows = seqs(spark, sf_dir).select(F.col("id").alias("acc"), "seq", F.lit("A").alias("act"))
    writers.messages(rows, f"{path}/frg", ["act", "acc"], F.lit("FRG"), "seq")
    pairs = stores.mate_links(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.floor(F.col("doc_id") / 2).alias("pair")))
    writers.messages(pairs.select(F.lit("A").alias("act"), F.col("first").alias("fg1"), F.col("second").alias("fg2")), f"{path}/lkg", ["act", "fg1", "fg2"], F.lit("LKG"))
    return readers.messages(spark, f"{path}/*")


@query(f"SELECT 'FRG' AS tag, CAST(id AS VARCHAR) AS one, md5(seq) AS other FROM {DOCS} WHERE length(seq) > 0 UNION ALL SELECT 'LKG', CAST(min(doc_id) AS VARCHAR), CAST(max(doc_id) AS VARCHAR) FROM documents GROUP BY doc_id // 2 HAVING count(*) = 2")
def source_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads as FRG messages and their mates as LKG messages, written and parsed."""
    m = _messages(spark, sf_dir)
    frg = m.where("tag = 'FRG'").select("tag", readers.message_field(F.col("body"), "acc").alias("one"), F.md5(readers.message_text(F.col("body"), "seq")).alias("other")).where("other is not null")
    return frg.unionByName(m.where("tag = 'LKG'").select("tag", readers.message_field(F.col("body"), "fg1").alias("one"), readers.message_field(F.col("body"), "fg2").alias("other")))


@query(f"SELECT CAST(id AS VARCHAR) AS id, md5(seq) AS digest FROM {DOCS} WHERE length(seq) > 0")
def messages_to_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequences of the messages with one tag, as FASTA."""
    path = new_path(spark, "fasta")
    m = _messages(spark, sf_dir).where("tag = 'FRG'")
    rows = m.select(readers.message_field(F.col("body"), "acc").alias("id"), readers.message_text(F.col("body"), "seq").alias("seq")).where("seq is not null")
    writers.fasta(rows, path, 70)
    return readers.fasta(spark, path).select("id", F.md5("seq").alias("digest"))


@query("SELECT 'S' AS kind, 'p' || p_partkey AS a, p_name AS b FROM part UNION ALL SELECT 'L', 'p' || l_partkey, 'p' || l_suppkey FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)")
def source_gfa(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "gfa")
    name = lambda c: F.concat(F.lit("p"), F.col(c).cast("string"))
    segments = table(spark, sf_dir, "part").select(name("p_partkey").alias("id"), F.col("p_name").alias("seq"))
    links = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct().select(name("l_partkey").alias("a"), F.lit("F").alias("a_ori"), name("l_suppkey").alias("b"), F.lit("R").alias("b_ori"), F.lit(12).alias("overlap"))
    writers.gfa(segments, links, path)
    rows = readers.lines_by(spark, path)
    return rows.select("kind", F.col("fields")[0].alias("a"), F.when(F.col("kind") == "S", F.col("fields")[1]).otherwise(F.col("fields")[2]).alias("b"))


@query('SELECT DISTINCT \'"\' || o_custkey || \'" -> "\' || o_orderkey || \'";\' AS line FROM orders')
def source_dot(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "dot")
    writers.dot(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("a"), F.col("o_orderkey").alias("b")), path)
    return spark.read.text(path).select(F.col("value").alias("line")).distinct()


@query("SELECT p_type AS kmer, count(*) AS cnt FROM (SELECT replace(p_type, ' ', '_') AS p_type FROM part) GROUP BY 1 HAVING count(*) >= 5")
def source_kmer_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "dump")
    counts = table(spark, sf_dir, "part").groupBy(F.replace("p_type", F.lit(" "), F.lit("_")).alias("kmer")).agg(F.count("*").alias("cnt"))
    writers.kmer_dump(counts.where("cnt >= 5"), path)
    return readers.kmer_table(spark, path)


@query(f"SELECT a_iid, b_iid, a_hang, b_hang FROM {OVERLAPS} WHERE a_iid BETWEEN 20 AND 39")
def source_overlap_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of ids from a store of overlaps that is sorted by them."""
    path = new_path(spark, "overlaps")
    writers.overlap_store(overlaps(spark, sf_dir), path, 8)
    return spark.read.parquet(path).where("a_iid between 20 and 39").select("a_iid", "b_iid", "a_hang", "b_hang")


STORE = f"""(SELECT id, seq, translate(reverse(seq), 'ACGT', '&5?I') AS qual, CASE WHEN id % 7 = 0 THEN 2 ELSE 0 END AS bgn, CASE WHEN id % 5 = 0 THEN length(seq) // 2 ELSE length(seq) END AS e, id % 11 = 0 AS deleted FROM {DOCS})"""


def _store(spark, sf_dir) -> DataFrame:
    """A store of reads, a part appended, some trimmed and some deleted."""
    rows = seqs(spark, sf_dir).select("id", "seq", F.translate(F.reverse("seq"), "ACGT", "&5?I").alias("qual"), F.lit(0).alias("bgn"), F.length("seq").alias("end"), F.lit(False).alias("deleted"))
    store = stores.appended(rows.where("id % 3 <> 0"), rows, "id")
    ids = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    store = stores.edited(store, ids.where("id % 7 = 0").withColumn("bgn", F.lit(2)), "id")
    store = stores.edited(store, rows.where("id % 5 = 0").select("id", F.floor(F.col("end") / 2).cast("int").alias("end")), "id")
    return stores.edited(store, ids.where("id % 11 = 0").withColumn("deleted", F.lit(True)), "id")


@query(f"SELECT id, md5(seq) AS seq, CAST(bgn AS INTEGER) AS bgn, CAST(e AS INTEGER) AS \"end\", deleted FROM {STORE}")
def read_store_edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(spark, sf_dir).select("id", F.md5("seq").alias("seq"), "bgn", "end", "deleted")


@query(f"SELECT CAST(id AS VARCHAR) AS id, md5(substr(seq, bgn + 1, greatest(e - bgn, 0))) AS seq, md5(substr(qual, bgn + 1, greatest(e - bgn, 0))) AS qual FROM {STORE} WHERE NOT deleted AND e > bgn")
def read_store_dumped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reads that are left, cut to their clear ranges, as FASTQ."""
    path = new_path(spark, "fastq")
    writers.fastq(stores.dumped_fastq(_store(spark, sf_dir)).where("seq <> ''"), path)
    return readers.fastq(spark, path).select("id", F.md5("seq").alias("seq"), F.md5("qual").alias("qual"))


@query("WITH i AS (SELECT range AS id FROM range(500)) SELECT id, left(translate(md5('7/' || id || '/0') || md5('7/' || id || '/1') || md5('7/' || id || '/2') || md5('7/' || id || '/3'), '0123456789abcdef', 'ACGTACGTACGTACGT'), 100) AS seq FROM i")
def generated_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stores.generated(500, 100, 7, spark)


@query("SELECT l_orderkey * 8 + l_linenumber AS id, array_to_string(list_concat([-(CAST(l_quantity AS INTEGER) + 1), -1], list_transform(range(l_linenumber * 3), lambda x: 1)), ',') AS deltas FROM lineitem")
def cigar_to_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.sequence import delta_of

    s = lambda c: F.expr(f"cast({c} as string)")
    cigar = F.concat(s("l_linenumber"), F.lit("S"), s("int(l_quantity)"), F.lit("M2I"), s("l_linenumber * 3"), F.lit("D10M"))
    return table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), F.array_join(delta_of(cigar_operations(cigar)).cast("array<string>"), ",").alias("deltas"))


_DIGEST = "CAST('0x' || left(md5('11/' || o_orderkey), 8) AS BIGINT) / 4294967296.0"


@query(f"SELECT o_orderkey AS pair FROM orders WHERE {_DIGEST} < 0.25")
def mate_pairs_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stores.chosen_pairs(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pair")), "pair", 0.25, 11)


@query(f"SELECT id FROM (SELECT id, coalesce(sum(length(seq)) OVER (ORDER BY md5('3/' || id), id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM {DOCS}) WHERE before < 50000")
def reads_sampled_to_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = seqs(spark, sf_dir).select("id", F.length("seq").alias("n"))
    return stores.sampled_to_bases(rows, "id", "n", 50_000, 3).select("id")


@query("SELECT s_suppkey AS tig, max(version) AS version, max_by(value, version) AS value FROM (SELECT l_suppkey AS s_suppkey, l_orderkey * 8 + l_linenumber AS version, l_extendedprice AS value FROM lineitem) GROUP BY 1")
def tig_store_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a store with versions of tigs the last of each."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("tig"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("version"), F.col("l_extendedprice").alias("value"))
    return stores.latest(rows, ["tig"], "version")


@query("SELECT coalesce(CASE WHEN p_partkey IS NOT NULL THEN p_name END, CAST(l_partkey AS VARCHAR)) AS child, 's' || l_suppkey AS parent, count(*) AS n FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON p_partkey = l_partkey GROUP BY 1, 2")
def posmap_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in place of ids in a position table; ids without a name stay."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("child"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("parent"))
    names = table(spark, sf_dir, "part").where("p_size > 10").select(F.col("p_partkey").cast("string").alias("uid"), F.col("p_name").alias("name"))
    return stores.renamed(rows, names, ["child"]).groupBy("child", "parent").agg(F.count("*").alias("n"))


@query(f"SELECT 'CCO' AS tag, CAST(id AS VARCHAR) AS acc, CAST(length(seq) AS VARCHAR) AS value FROM {DOCS} UNION ALL SELECT 'SCF', 's' || id % 50, CAST(count(*) AS VARCHAR) FROM {DOCS} GROUP BY id % 50")
def assembly_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contigs and scaffolds as messages, written and parsed."""
    path = new_path(spark, "asm")
    contigs = seqs(spark, sf_dir).select(F.col("id").alias("acc"), F.length("seq").alias("len"))
    writers.messages(contigs, f"{path}/cco", ["acc", "len"], F.lit("CCO"))
    scaffolds = contigs.groupBy(F.concat(F.lit("s"), (F.col("acc") % 50).cast("string")).alias("acc")).agg(F.count("*").alias("noc"))
    writers.messages(scaffolds, f"{path}/scf", ["acc", "noc"], F.lit("SCF"))
    m = readers.messages(spark, f"{path}/*")
    of = lambda tag, field: m.where(F.col("tag") == tag).select("tag", readers.message_field(F.col("body"), "acc").alias("acc"), readers.message_field(F.col("body"), field).alias("value"))
    return of("CCO", "len").unionByName(of("SCF", "noc"))
