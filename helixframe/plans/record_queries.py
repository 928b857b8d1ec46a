"""Operators over records, intervals and alignment tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sequence import canonical, compressed, natural_key, reverse_complement, super_read_reversed, translated
from ..operators import alignments, fasta, interval
from .kmer_queries import seqs
from .registry import query, table

SEQ = "regexp_replace(upper(text), '[^ACGT]', '', 'g')"
DOCS = f"(SELECT doc_id AS id, lang, {SEQ} AS seq FROM documents)"


def docs(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("seq"), "lang", "source")


@query("SELECT doc_id AS id, source FROM documents WHERE regexp_matches(source, 'src1[0-9]?$') UNION ALL SELECT doc_id, source FROM documents WHERE NOT regexp_matches(source, 'src')")
def fasta_hgrep(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fasta.grep_headers(docs(spark, sf_dir), "src1[0-9]?$", "source")
    return found.unionByName(fasta.grep_headers(docs(spark, sf_dir), "src", "source", invert=True)).select("id", "source")


@query("SELECT id, line_no, line FROM (SELECT doc_id AS id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no FROM documents) WHERE regexp_matches(line, '^[A-M].*(tion|eau)')")
def fasta_dgrep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fasta.grep_lines(docs(spark, sf_dir), "^[A-M].*(tion|eau)").select("id", F.col("line_no").cast("long").alias("line_no"), "line")


@query("SELECT doc_id AS id, substr(text, 11, 40) AS seq FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def fasta_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("id"))
    return fasta.subrange(fasta.extract(docs(spark, sf_dir), names), 10, 50).select("id", "seq")


@query("SELECT doc_id AS id, length(text) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def fasta_extract_inverted(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    return fasta.extract(docs(spark, sf_dir), names, invert=True).select("id", F.length("seq").cast("long").alias("n"))


@query("SELECT 'head' AS part, doc_id AS id FROM (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 25) UNION ALL SELECT 'tail', doc_id FROM (SELECT doc_id FROM documents ORDER BY doc_id DESC LIMIT 25) UNION ALL SELECT 'rest', doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 150)")
def fasta_head_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir).select("id")
    parts = (("head", fasta.head(rows, 25)), ("tail", fasta.tail(rows, 25)), ("rest", fasta.tail(rows, -150)))
    out = [df.select(F.lit(name).alias("part"), "id") for name, df in parts]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("SELECT doc_id AS id, lower(replace(text, chr(10), '')) AS one, rtrim(regexp_replace(replace(text, chr(10), ''), '(.{60})', '\\1' || chr(10), 'g'), chr(10)) AS wrapped FROM documents")
def fasta_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("id", F.lower(fasta.one_line(F.col("seq"))).alias("one"), fasta.wrapped(F.col("seq"), 60).alias("wrapped"))


@query(f"SELECT id, reverse(translate(seq, 'ACGT', 'TGCA')) AS rc, least(seq, reverse(translate(seq, 'ACGT', 'TGCA'))) AS seq FROM {DOCS}")
def fasta_reverse_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seqs(spark, sf_dir).select("id", reverse_complement(F.col("seq")).alias("rc"), canonical(F.col("seq")).alias("seq"))


@query("SELECT doc_id AS id, CAST((row_number() OVER (ORDER BY doc_id) - 1) % 7 AS INTEGER) AS part FROM documents")
def fasta_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fasta.split_round_robin(docs(spark, sf_dir).select("id"), 7)


@query("SELECT doc_id AS id, length(text) AS size FROM documents")
def fasta_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fasta.lengths(docs(spark, sf_dir).where("seq is not null"))


N50 = """WITH r AS (SELECT n_chars AS s, sum(n_chars) OVER (ORDER BY n_chars DESC) AS c FROM documents), t AS (SELECT sum(n_chars) AS t FROM documents)
SELECT p AS percent, (SELECT max(s) FROM r, t WHERE {}) AS n_size FROM (SELECT unnest([10, 25, 50, 75, 90]) AS p)"""


@query(N50.format("c >= ceil(p * t / 100)"))
def stats_n50_ge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fasta.size_at(table(spark, sf_dir, "documents"), [10, 25, 50, 75, 90], "n_chars")


@query(N50.format("c > floor(p * t / 100)"))
def stats_n50_gt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fasta.size_at(table(spark, sf_dir, "documents"), [10, 25, 50, 75, 90], "n_chars", strict=True)


@query("SELECT lang, source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS total, avg(n_chars) AS mean, min(n_chars) AS least, max(n_chars) AS most, sum(n_chars * n_chars) / sum(n_chars) AS e_size FROM documents GROUP BY GROUPING SETS ((), (lang), (lang, source))")
def stats_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    none = F.lit(None).cast("string")
    every = fasta.size_stats(rows, [], "n_chars").select(none.alias("lang"), none.alias("source"), "*")
    by_lang = fasta.size_stats(rows, ["lang"], "n_chars").select("lang", none.alias("source"), "n", "total", "mean", "least", "most", "e_size")
    return every.unionByName(by_lang).unionByName(fasta.size_stats(rows, ["lang", "source"], "n_chars"))


GAPPED = "(SELECT doc_id AS id, regexp_replace(text, '[^ACGTEINORSUacgteinorsu]', 'N', 'g') AS seq FROM documents)"


def gapped(spark, sf_dir) -> DataFrame:
    """Texts with N for rarer letters: long runs of letters, short gaps."""
    return docs(spark, sf_dir).select("id", F.regexp_replace("seq", "[^ACGTEINORSUacgteinorsu]", "N").alias("seq"))


@query(f"""WITH r AS (SELECT id, regexp_extract_all(seq, 'N+|[^N]+') AS runs FROM {GAPPED}),
u AS (SELECT id, unnest(runs) AS run, unnest(range(1, len(runs) + 1)) AS k FROM r),
e AS (SELECT id, run, sum(length(run)) OVER (PARTITION BY id ORDER BY k) AS e FROM u)
SELECT id, CAST(e - length(run) AS BIGINT) AS begin, CAST(e AS BIGINT) AS "end" FROM e WHERE starts_with(run, 'N')""")
def fasta_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fasta.gaps(gapped(spark, sf_dir)).select("id", F.col("begin").cast("long").alias("begin"), F.col("end").cast("long").alias("end"))


@query(f"SELECT id, unnest(range(0, len(p))) AS piece, unnest(p) AS seq FROM (SELECT id, list_filter(regexp_split_to_array(seq, 'N+'), lambda x: x <> '') AS p FROM {GAPPED})")
def fasta_split_at_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fasta.pieces_between_gaps(gapped(spark, sf_dir)).select("id", F.col("piece").cast("long").alias("piece"), "seq")


@query(f"SELECT id, part, substr(seq, part * 270 + 1, 300) AS seq FROM (SELECT id, seq, unnest(range(0, greatest(1, CAST(ceil((length(seq) - 30) / 270.0) AS INTEGER)))) AS part FROM {DOCS})")
def fasta_split_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fasta.split_long(seqs(spark, sf_dir), 300, 30).select("id", F.col("part").cast("long").alias("part"), "seq")


@query(f"""WITH b AS (SELECT id, seq, substr(seq, length(seq), 1) AS z, unnest(range(1, length(seq) + 1)) AS k FROM {DOCS} WHERE length(seq) > 0),
r AS (SELECT id, seq, k, sum(CASE WHEN substr(seq, length(seq) - k + 1, 1) = z THEN 1 ELSE -1 END) OVER (PARTITION BY id ORDER BY k) AS score FROM b),
m AS (SELECT id, seq, max(score) AS best FROM r GROUP BY id, seq),
f AS (SELECT m.id, m.seq, m.best, min(r.k) AS k FROM m JOIN r ON m.id = r.id AND m.best = r.score GROUP BY ALL)
SELECT id, CASE WHEN best >= 2 THEN substr(seq, 1, length(seq) - k) ELSE seq END AS kept FROM f""")
def homopolymer_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fasta.homopolymer_trim(seqs(spark, sf_dir), 2)


QUALITIES = "(SELECT id, translate(reverse(seq), 'ACGT', '&5?I') AS qual FROM " + DOCS + ")"


@query(f"""WITH b AS (SELECT id, unnest(range(1, length(qual) + 1)) AS k, qual FROM {QUALITIES}),
s AS (SELECT id, k, sum(ord(substr(qual, k, 1)) - 33 - 25) OVER (PARTITION BY id ORDER BY k) AS s FROM b),
p AS (SELECT id, k, s, coalesce(min(s) OVER (PARTITION BY id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS low FROM s),
v AS (SELECT id, k, s, s - least(low, 0) AS gain, least(low, 0) AS base FROM p),
g AS (SELECT id, max(gain) AS best FROM v GROUP BY id),
e AS (SELECT v.id, min(v.k) AS e FROM v JOIN g ON v.id = g.id AND v.gain = g.best WHERE g.best > 0 GROUP BY v.id),
x AS (SELECT e.id, e.e, v.base FROM e JOIN v ON v.id = e.id AND v.k = e.e),
y AS (SELECT x.id, x.e, coalesce(max(s.k) FILTER (WHERE s.s = x.base AND s.k < x.e), 0) AS b0 FROM x JOIN s ON s.id = x.id GROUP BY x.id, x.e, x.base)
SELECT id, b0 AS begin, e AS "end" FROM y WHERE e - b0 >= 12""")
def quality_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = seqs(spark, sf_dir).select("id", F.translate(F.reverse("seq"), "ACGT", "&5?I").alias("qual"))
    return fasta.best_quality_segment(reads, 25, 12).select("id", F.col("begin").cast("long").alias("begin"), F.col("end").cast("long").alias("end"))


@query(f"SELECT (SELECT count(*) FROM documents) AS n_reads, (SELECT CAST(sum(length(seq)) AS BIGINT) FROM {DOCS}) AS n_bases, ord(min(substr(qual, k, 1))) AS least, ord(max(substr(qual, k, 1))) AS most, CASE WHEN least < 59 THEN 33 ELSE 64 END AS \"offset\" FROM (SELECT 1 AS one) LEFT JOIN (SELECT qual, unnest(range(1, length(qual) + 1)) AS k FROM {QUALITIES}) ON true")
def quality_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = seqs(spark, sf_dir).withColumn("qual", F.translate(F.reverse("seq"), "ACGT", "&5?I"))
    return fasta.analyze_quality(reads)


@query("SELECT 'pe' || CAST(p.pair * 2 + k AS VARCHAR) AS id, coalesce(substr(text, 1, 250), 'N') AS seq FROM (SELECT DISTINCT conv_id AS pair FROM conversations WHERE turn < 2) p CROSS JOIN (SELECT unnest([0, 1]) AS k) LEFT JOIN conversations c ON c.conv_id = p.pair AND c.turn = k")
def rename_and_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").where("turn < 2").select(F.col("conv_id").alias("pair"), F.col("turn").cast("int").alias("mate"), F.col("text").alias("seq"))
    return fasta.rename_pairs(rows)


@query(f"SELECT id, array_to_string(list_transform(range(0, length(seq) // 3), lambda i: substr('FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG', 16 * (instr('TCAG', substr(seq, CAST(3 * i + 1 AS BIGINT), 1)) - 1) + 4 * (instr('TCAG', substr(seq, CAST(3 * i + 2 AS BIGINT), 1)) - 1) + instr('TCAG', substr(seq, CAST(3 * i + 3 AS BIGINT), 1)), 1)), '') AS protein FROM {DOCS}")
def translate_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seqs(spark, sf_dir).select("id", translated(F.col("seq")).alias("protein"))


@query(f"SELECT id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(seq, 'A+', 'A', 'g'), 'C+', 'C', 'g'), 'G+', 'G', 'g'), 'T+', 'T', 'g') AS seq FROM {DOCS}")
def homopolymer_compress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seqs(spark, sf_dir).select("id", compressed(F.col("seq")).alias("seq"))


@query("SELECT doc_id AS id, source, row_number() OVER (ORDER BY lpad(substr(source, 4), 20, '0'), doc_id) AS place FROM documents")
def sort_natural(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir).select("id", "source")
    return fasta.numbered(rows, [natural_key(F.col("source")), F.col("id")]).withColumn("place", F.col("place") + 1)


# Intervals: line items of an order by ship day, customers' orders by day.

DAY = "date_diff('day', DATE '1990-01-01', CAST({} AS DATE))"
SHIP = f"(SELECT l_suppkey AS grp, {DAY.format('l_shipdate')} AS lo, {DAY.format('l_shipdate')} + CAST(l_quantity AS INTEGER) AS hi FROM lineitem)"


def ships(spark, sf_dir) -> DataFrame:
    day = F.datediff(F.to_date("l_shipdate"), F.lit("1990-01-01").cast("date"))
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("grp"), day.alias("lo"), (day + F.col("l_quantity").cast("int")).alias("hi"))


MERGED = f"""(WITH f AS (SELECT grp, lo, hi, max(hi) OVER (PARTITION BY grp ORDER BY lo, hi DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far, row_number() OVER (PARTITION BY grp ORDER BY lo, hi DESC) AS k FROM {SHIP}),
i AS (SELECT *, sum(CASE WHEN far IS NULL OR NOT (hi <= far OR far >= lo) THEN 1 ELSE 0 END) OVER (PARTITION BY grp ORDER BY k) AS island FROM f)
SELECT grp, min(lo) AS lo, max(hi) AS hi, count(*) AS n FROM i GROUP BY grp, island)"""


@query(f"SELECT * FROM {MERGED}")
def interval_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interval.merge(ships(spark, sf_dir), ["grp"])


@query(f"SELECT grp, hi AS lo, nx AS hi FROM (SELECT grp, hi, lead(lo) OVER (PARTITION BY grp ORDER BY lo) AS nx FROM {MERGED}) WHERE nx > hi")
def interval_invert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interval.invert(ships(spark, sf_dir), ["grp"])


DEPTH = f"""(WITH e AS (SELECT grp, lo AS x, 1 AS d FROM {SHIP} UNION ALL SELECT grp, hi, -1 FROM {SHIP}),
s AS (SELECT grp, x, sum(d) AS d FROM e GROUP BY grp, x),
r AS (SELECT grp, x AS lo, lead(x) OVER (PARTITION BY grp ORDER BY x) AS hi, sum(d) OVER (PARTITION BY grp ORDER BY x) AS depth FROM s)
SELECT grp, lo, hi, CAST(depth AS BIGINT) AS depth FROM r WHERE depth > 0)"""


@query(f"SELECT * FROM {DEPTH}")
def interval_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interval.depth(ships(spark, sf_dir), ["grp"])


@query(f"""WITH d AS (SELECT grp, depth, sum(hi - lo) AS n FROM {DEPTH} GROUP BY grp, depth)
SELECT grp, CAST(sum(n) AS BIGINT) AS covered, sum(n * depth) / sum(n) AS mean, max(depth) AS most, arg_max(depth, n * 1000000 - depth) AS mode FROM d GROUP BY grp""")
def interval_depth_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interval.depth_summary(interval.depth(ships(spark, sf_dir), ["grp"]), ["grp"])


@query(f"""WITH b AS (SELECT s_suppkey AS grp, 3000 + 7 * s_nationkey AS b_lo, 3030 + 9 * s_nationkey AS b_hi FROM supplier)
SELECT a.grp, a.lo AS a_lo, a.hi AS a_hi, b_lo, b_hi, least(a.hi, b_hi) - greatest(a.lo, b_lo) AS overlap FROM {SHIP} a JOIN b ON a.grp = b.grp AND a.lo < b_hi AND b_lo < a.hi WHERE a.hi > a.lo""")
def interval_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = ships(spark, sf_dir).select("grp", F.col("lo").alias("a_lo"), F.col("hi").alias("a_hi"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("grp"), (3000 + 7 * F.col("s_nationkey")).alias("b_lo"), (3030 + 9 * F.col("s_nationkey")).alias("b_hi"))
    return interval.overlaps(a, b, ["grp"], 64)


@query(f"""WITH b AS (SELECT s_suppkey AS grp, 3000 + 7 * s_nationkey AS b_lo, 3030 + 9 * s_nationkey AS b_hi FROM supplier)
SELECT b.grp, CAST(coalesce(sum(least(d.hi, b_hi) - greatest(d.lo, b_lo)) FILTER (WHERE d.lo < b_hi AND b_lo < d.hi), 0) AS BIGINT) AS n FROM b LEFT JOIN {SHIP} d ON b.grp = d.grp AND d.hi > d.lo GROUP BY b.grp""")
def bed_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("grp"), (3000 + 7 * F.col("s_nationkey")).alias("b_lo"), (3030 + 9 * F.col("s_nationkey")).alias("b_hi"))
    found = interval_overlaps(spark, sf_dir).groupBy("grp").agg(F.sum("overlap").alias("n"))
    return b.select("grp").join(found, "grp", "left").select("grp", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


@query(f"SELECT s_suppkey AS grp, CAST(coalesce(c, 0) AS BIGINT) AS covered, coalesce(c, 0) / (4000 + s_nationkey) AS share FROM supplier LEFT JOIN (SELECT grp, sum(hi - lo) AS c FROM {MERGED} GROUP BY grp) ON grp = s_suppkey")
def mapping_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("grp"), (4000 + F.col("s_nationkey")).alias("size"))
    return interval.covered_share(ships(spark, sf_dir), whole, ["grp"], "size")


# Alignment rows: line items as reads, orders as templates.

READS = """(SELECT 'r' || l_orderkey AS qname, l_orderkey * 8 + l_linenumber AS ordinal, CAST((1 + CASE WHEN l_tax < 0.05 THEN 2 ELSE 0 END + CASE WHEN l_discount = 0.02 THEN 4 ELSE 0 END + CASE WHEN l_discount = 0.05 THEN 8 ELSE 0 END + CASE WHEN l_linestatus = 'O' THEN 16 ELSE 0 END + CASE WHEN l_linenumber % 2 = 1 THEN 64 ELSE 128 END + CASE WHEN l_returnflag = 'R' AND l_quantity > 40 THEN 512 ELSE 0 END + CASE WHEN l_returnflag = 'A' AND l_quantity > 45 THEN 1024 ELSE 0 END) AS INTEGER) AS flag,
  CAST(l_suppkey % 25 AS INTEGER) AS tid, CAST(l_partkey % 1000 AS INTEGER) AS pos, CAST(l_quantity AS INTEGER) AS mapq, CAST(l_suppkey % 24 AS INTEGER) AS mtid, CAST(l_linenumber * 5 AS INTEGER) AS l_seq, l_extendedprice AS score, l_returnflag AS lib FROM lineitem)"""


def reads(spark, sf_dir) -> DataFrame:
    bit = lambda c, n, m=0: F.when(F.expr(c), n).otherwise(m)
    flag = 1 + bit("l_tax < 0.05", 2) + bit("l_discount = 0.02", 4) + bit("l_discount = 0.05", 8) + bit("l_linestatus = 'O'", 16) + bit("l_linenumber % 2 = 1", 64, 128) + bit("l_returnflag = 'R' and l_quantity > 40", 512) + bit("l_returnflag = 'A' and l_quantity > 45", 1024)
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("r"), F.col("l_orderkey").cast("string")).alias("qname"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ordinal"), flag.cast("int").alias("flag"), (F.col("l_suppkey") % 25).cast("int").alias("tid"), (F.col("l_partkey") % 1000).cast("int").alias("pos"),
        F.col("l_quantity").cast("int").alias("mapq"), (F.col("l_suppkey") % 24).cast("int").alias("mtid"), (F.col("l_linenumber") * 5).cast("int").alias("l_seq"), F.col("l_extendedprice").alias("score"), F.col("l_returnflag").alias("lib"),
    )


@query(f"SELECT qname, ordinal, flag FROM {READS} WHERE flag & 3 = 3 AND flag & 1540 = 0 AND mapq >= 10 AND l_seq >= 10")
def sam_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments.view(reads(spark, sf_dir), need=3, forbid=1540, least_mapq=10, least_length=10).select("qname", "ordinal", "flag")


@query("""WITH n AS (SELECT DISTINCT 'r' || l_orderkey AS qname FROM lineitem), h AS (SELECT qname, list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split(qname, ''), lambda c: CAST(ord(c) AS BIGINT))), lambda h, c: (h * 31 + c) & 4294967295) AS h FROM n)
SELECT qname FROM h WHERE ((h + 11) & 16777215) / 16777216.0 < 0.3""")
def sam_subsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = reads(spark, sf_dir).select("qname", "flag", "mapq", "l_seq").dropDuplicates(["qname"])
    return alignments.view(names, sample=0.3, seed=11).select("qname")


@query(f"""SELECT flag & 512 <> 0 AS failed, count(*) AS total, count(*) FILTER (WHERE flag & 1024 <> 0) AS duplicates, count(*) FILTER (WHERE flag & 4 = 0) AS mapped, count(*) FILTER (WHERE flag & 1 <> 0) AS paired,
count(*) FILTER (WHERE flag & 65 = 65) AS read1, count(*) FILTER (WHERE flag & 129 = 129) AS read2, count(*) FILTER (WHERE flag & 3 = 3 AND flag & 4 = 0) AS proper, count(*) FILTER (WHERE flag & 1 <> 0 AND flag & 12 = 0) AS both_mapped,
count(*) FILTER (WHERE flag & 9 = 9 AND flag & 4 = 0) AS singletons, count(*) FILTER (WHERE flag & 1 <> 0 AND flag & 12 = 0 AND mtid <> tid) AS other_tid, count(*) FILTER (WHERE flag & 1 <> 0 AND flag & 12 = 0 AND mtid <> tid AND mapq >= 5) AS other_tid_high FROM {READS} GROUP BY 1""")
def sam_flagstat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments.flagstat(reads(spark, sf_dir))


@query(f"SELECT tid, count(*) FILTER (WHERE flag & 4 = 0) AS n_mapped, count(*) FILTER (WHERE flag & 4 <> 0) AS n_unmapped FROM {READS} GROUP BY tid")
def sam_idxstats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments.idxstats(reads(spark, sf_dir))


@query(f"SELECT tid, CAST(p AS INTEGER) AS pos, count(*) AS depth FROM (SELECT tid, unnest(range(pos, pos + l_seq)) AS p FROM {READS} WHERE mapq >= 20) GROUP BY tid, p")
def sam_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments.depth(reads(spark, sf_dir), 20)


@query(f"SELECT ordinal, lib, tid, pos FROM (SELECT *, row_number() OVER (PARTITION BY lib, tid, pos ORDER BY score DESC, ordinal) AS k FROM {READS}) WHERE k = 1")
def sam_remove_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments.remove_duplicates(reads(spark, sf_dir), ["lib", "tid", "pos"], "score", "ordinal").select("ordinal", "lib", "tid", "pos")


@query(f"""WITH k AS (SELECT *, row_number() OVER w AS k, lead(tid) OVER w AS nt, lead(pos) OVER w AS ap, lag(tid) OVER w AS bt, lag(pos) OVER w AS bp FROM {READS} WINDOW w AS (PARTITION BY qname ORDER BY ordinal, tid, pos, mapq))
SELECT qname, ordinal, CASE WHEN k = 1 THEN nt ELSE bt END AS mtid, CASE WHEN k = 1 THEN ap ELSE bp END AS mpos FROM k WHERE k <= 2""")
def sam_fix_mates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments.fix_mates(reads(spark, sf_dir), order=("ordinal", "tid", "pos", "mapq")).select("qname", "ordinal", "mtid", "mpos")


@query("WITH n AS (SELECT o_orderkey AS k, o_orderkey % 97 || 'F_' || o_custkey % 89 || 'R_' || o_orderkey % 7 || 'F' AS name, o_orderkey % 7 || 'R_' || o_custkey % 89 || 'F_' || o_orderkey % 97 || 'R' AS back FROM orders) SELECT k, name, back FROM n")
def super_read_reverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = lambda c: F.col(c).cast("string")
    rows = table(spark, sf_dir, "orders").withColumns({"a": F.col("o_orderkey") % 97, "b": F.col("o_custkey") % 89, "c": F.col("o_orderkey") % 7})
    rows = rows.select(F.col("o_orderkey").alias("k"), F.concat(s("a"), F.lit("F_"), s("b"), F.lit("R_"), s("c"), F.lit("F")).alias("name"))
    return rows.withColumn("back", super_read_reversed(F.col("name")))
