"""Writers of the same formats: rows to lines, lines by Spark's text sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _lines(rows: DataFrame, line: Column, path: str) -> None:
    rows.select(line.alias("value")).write.text(path)


def fasta(records: DataFrame, path: str, width: int = 0, id_col: str = "id", seq_col: str = "seq") -> None:
    seq = F.col(seq_col)
    if width:
        seq = F.regexp_replace(F.regexp_replace(seq, f"(.{{{width}}})", "$1\n"), "\n$", "")
    _lines(records, F.concat(F.lit(">"), F.col(id_col).cast("string"), F.lit("\n"), seq), path)


def fastq(reads: DataFrame, path: str) -> None:
    _lines(reads, F.concat(F.lit("@"), F.col("id").cast("string"), F.lit("\n"), "seq", F.lit("\n+\n"), "qual"), path)


def tabbed(rows: DataFrame, path: str, columns: list[str]) -> None:
    """Columns parted by tabs; null as `*`."""
    _lines(rows, F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit("*")) for c in columns)), path)


def sam(rows: DataFrame, path: str) -> None:
    """Rows of readers.sam; pos becomes one-based again."""
    rows = rows.withColumn("pos", F.col("pos") + 1).withColumn("mpos", F.col("mpos") + 1)
    tabbed(rows, path, ["qname", "flag", "tid", "pos", "mapq", "cigar", "mtid", "mpos", "isize", "seq", "qual"])


def bed(rows: DataFrame, path: str) -> None:
    tabbed(rows, path, ["chrom", "bgn", "end"])


def paf(rows: DataFrame, path: str) -> None:
    tabbed(rows, path, ["qname", "qlen", "qbgn", "qend", "strand", "tname", "tlen", "tbgn", "tend", "matches", "length", "mapq"])


def posmap(rows: DataFrame, path: str) -> None:
    tabbed(rows, path, ["child", "parent", "bgn", "end", "ori"])


def gfa(segments: DataFrame, links: DataFrame, path: str) -> None:
    """S lines of segments (id, seq) and L lines of links (a, a_ori, b, b_ori, overlap)."""
    s = segments.select(F.concat_ws("\t", F.lit("S"), F.col("id").cast("string"), "seq").alias("value"))
    sign = lambda c: F.when(F.col(c) == "F", "+").otherwise("-")
    of = links.select(F.concat_ws("\t", F.lit("L"), F.col("a").cast("string"), sign("a_ori"), F.col("b").cast("string"), sign("b_ori"), F.concat(F.col("overlap").cast("string"), F.lit("M"))).alias("value"))
    s.unionByName(of).write.text(path)


def dot(edges: DataFrame, path: str) -> None:
    """The edge lines of a graph description, a file for each partition."""
    _lines(edges, F.concat(F.lit('"'), F.col("a").cast("string"), F.lit('" -> "'), F.col("b").cast("string"), F.lit('";')), path)


def kmer_dump(counts: DataFrame, path: str, as_fasta: bool = False) -> None:
    line = F.concat(F.lit(">"), F.col("cnt").cast("string"), F.lit("\n"), F.col("kmer")) if as_fasta else F.concat_ws(" ", "kmer", F.col("cnt").cast("string"))
    _lines(counts, line, path)


def overlap_store(overlaps: DataFrame, path: str, partitions: int) -> None:
    """Overlaps as Parquet, in ranges of a_iid and sorted, so that reads of an id range prune by statistics."""
    overlaps.repartitionByRange(partitions, "a_iid").sortWithinPartitions("a_iid", "b_iid").write.mode("overwrite").parquet(path)


def delta(alignments: DataFrame, path: str) -> None:
    """Delta lines of alignments as readers.delta gives them, a header line for each pair of sequences."""
    s = lambda c: F.col(c).cast("string")
    ends = F.concat_ws(" ", *map(s, ("s_r", "e_r", "s_q", "e_q", "errors", "similarity_errors", "stops")))
    body = F.concat_ws("\n", ends, F.transform("deltas", lambda d: d.cast("string")), F.lit("0"))
    by = alignments.groupBy("ref", "qry", "ref_len", "qry_len").agg(F.array_sort(F.collect_list(F.struct("s_r", "e_r", "s_q", "e_q", body.alias("body")))).alias("a"))
    head = F.concat(F.lit(">"), F.concat_ws(" ", *map(s, ("ref", "qry", "ref_len", "qry_len"))))
    _lines(by, F.concat_ws("\n", head, F.transform("a", lambda a: a["body"])), path)


def vcf(rows: DataFrame, path: str) -> None:
    """Rows of readers.vcf without samples."""
    rows = rows.withColumn("qual", F.col("qual").cast("string"))
    columns = ["chrom", "pos", "id", "ref", "alt", "qual", "filter", "info"]
    _lines(rows, F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in columns)), path)


def messages(rows: DataFrame, path: str, fields: list[str], tag: Column, long: str | None = None) -> None:
    """A message `{TAG ... }` for each row: a line `name:value` for each field;
    the field long goes over lines of its own, ended by a line with a dot."""
    lines = [F.concat(F.lit("{"), tag), *(F.concat(F.lit(f"{c}:"), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in fields)]
    if long:
        lines += [F.lit(f"{long}:"), F.coalesce(long, F.lit("")), F.lit(".")]
    _lines(rows, F.concat_ws("\n", *lines, F.lit("}")), path)
