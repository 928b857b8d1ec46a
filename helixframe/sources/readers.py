"""Readers of sequence, alignment and interval files. All are scans by Spark's
own text source, so they read from any file system that it reads."""

from __future__ import annotations

import struct
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """(id, descr, seq). Records are cut at line ends before `>`, so files are
    read in splits; text before a file's first header makes no record if it
    ends in an empty line before it."""
    rows = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("value")).where("trim(value) <> ''")
    head = F.regexp_extract("value", "^([^\r\n]*)", 1)
    body = F.regexp_replace(F.substr("value", F.length(head) + 1), r"\s", "")
    return rows.select(F.regexp_extract(head, r"^(\S*)", 1).alias("id"), F.trim(F.regexp_replace(head, r"^\S*", "")).alias("descr"), body.alias("seq"))


def fastq(spark: SparkSession, path: str) -> DataFrame:
    """(id, seq, qual) of four-line records. A file is one task's, as its lines have to be counted."""
    lines = F.split(F.regexp_replace("value", "\r?\n$", ""), "\r?\n")
    rows = spark.read.text(path, wholetext=True).where("value <> ''").select(lines.alias("l"))
    at = lambda i, k: F.element_at("l", i * 4 + k)
    record = lambda i: F.struct(F.regexp_extract(at(i, 1), r"^@?(\S*)", 1).alias("id"), at(i, 2).alias("seq"), at(i, 4).alias("qual"))
    n = F.floor(F.size("l") / 4).cast("int")
    return rows.where(n > 0).select(F.inline(F.transform(F.sequence(F.lit(0), n - 1), record)))


def quality_offset(reads: DataFrame, qual: str = "qual") -> DataFrame:
    """One row: 33 or 64, by the smallest quality letter."""
    least = F.min(F.array_min(F.transform(F.split(qual, ""), F.ascii)))
    return reads.where(F.length(qual) > 0).agg(F.when(least < 64, 33).otherwise(64).alias("offset"))


def _fields(spark: SparkSession, path: str, names: list[tuple[str, str]], skip: str | None = None, rest: str | None = None, sep: str = "\t") -> DataFrame:
    rows = spark.read.text(path).where("value <> ''")
    rows = rows if skip is None else rows.where(~F.col("value").rlike(skip))
    f = F.split("value", sep)
    columns: list[Column] = [F.try_element_at(f, F.lit(i + 1)).try_cast(kind).alias(name) for i, (name, kind) in enumerate(names)]
    if rest:
        columns.append(F.slice(f, F.lit(len(names) + 1), F.greatest(F.size(f) - len(names), F.lit(0))).alias(rest))
    return rows.select(*columns)


def sam(spark: SparkSession, path: str) -> DataFrame:
    """SAM rows with pos from 0; tags as a map from name to value."""
    names = [("qname", "string"), ("flag", "int"), ("tid", "string"), ("pos", "int"), ("mapq", "int"), ("cigar", "string"), ("mtid", "string"), ("mpos", "int"), ("isize", "int"), ("seq", "string"), ("qual", "string")]
    rows = _fields(spark, path, names, skip="^@", rest="tags").withColumn("pos", F.col("pos") - 1).withColumn("mpos", F.col("mpos") - 1)
    tag = lambda t: F.struct(F.substring(t, 1, 2), F.regexp_replace(t, "^..:.:", ""))
    return rows.withColumn("tags", F.map_from_entries(F.transform("tags", tag))).withColumn("mtid", F.when(F.col("mtid") == "=", F.col("tid")).otherwise(F.col("mtid")))


def sam_header(spark: SparkSession, path: str) -> DataFrame:
    """(tid, size) of the @SQ lines."""
    rows = spark.read.text(path).where("value like '@SQ%'")
    return rows.select(F.regexp_extract("value", r"\tSN:([^\t]*)", 1).alias("tid"), F.regexp_extract("value", r"\tLN:(\d+)", 1).cast("long").alias("size"))


def bed(spark: SparkSession, path: str) -> DataFrame:
    return _fields(spark, path, [("chrom", "string"), ("bgn", "long"), ("end", "long"), ("name", "string")], skip="^(#|track|browser)")


def paf(spark: SparkSession, path: str) -> DataFrame:
    names = [("qname", "string"), ("qlen", "long"), ("qbgn", "long"), ("qend", "long"), ("strand", "string"), ("tname", "string"), ("tlen", "long"), ("tbgn", "long"), ("tend", "long"), ("matches", "long"), ("length", "long"), ("mapq", "int")]
    return _fields(spark, path, names, rest="tags")


def posmap(spark: SparkSession, path: str) -> DataFrame:
    return _fields(spark, path, [("child", "string"), ("parent", "string"), ("bgn", "long"), ("end", "long"), ("ori", "string")], sep=r"\s+")


def vcf(spark: SparkSession, path: str) -> DataFrame:
    return _fields(spark, path, [("chrom", "string"), ("pos", "long"), ("id", "string"), ("ref", "string"), ("alt", "string"), ("qual", "double"), ("filter", "string"), ("info", "string")], skip="^#", rest="samples")


def kmer_table(spark: SparkSession, path: str) -> DataFrame:
    """(kmer, cnt) of a dump in columns."""
    return _fields(spark, path, [("kmer", "string"), ("cnt", "long")], sep=r"\s+")


def delta(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of delta files: names and lengths of both sequences, the
    ends (from 1), errors and the signed distances between indels. A file is
    cut at its header lines; what stands under one is one row's."""
    rows = spark.read.option("lineSep", "\n>").text(path).where("value rlike '^>?[^\\n]+\\n'").select(F.regexp_replace("value", "^>", "").alias("v"))
    lines = F.split(F.regexp_replace("v", "\n$", ""), "\n")
    head = F.split(F.element_at(lines, 1), " ")
    rows = rows.where(F.size(head) == 4).select(head.alias("h"), F.slice(lines, F.lit(2), F.size(lines) - 1).alias("l"))
    zero = F.struct(F.array().cast("array<struct<head:string,deltas:array<int>>>").alias("done"), F.lit(None).cast("string").alias("head"), F.array().cast("array<int>").alias("deltas"))

    def step(s: Column, line: Column) -> Column:
        begins, ends = line.contains(" "), line == "0"
        done = F.when(ends, F.array_append(s["done"], F.struct(s["head"].alias("head"), s["deltas"].alias("deltas")))).otherwise(s["done"])
        deltas = F.when(begins | ends, F.array().cast("array<int>")).otherwise(F.array_append(s["deltas"], line.try_cast("int")))
        return F.struct(done.alias("done"), F.when(begins, line).otherwise(s["head"]).alias("head"), deltas.alias("deltas"))

    each = rows.select("h", F.explode(F.aggregate("l", zero, step, lambda s: s["done"])).alias("a"))
    f = F.split("a.head", " ")
    n = lambda i: F.element_at(f, i).cast("long")
    h = lambda i: F.element_at("h", i)
    return each.select(h(1).alias("ref"), h(2).alias("qry"), h(3).cast("long").alias("ref_len"), h(4).cast("long").alias("qry_len"), *(n(i + 1).alias(c) for i, c in enumerate(("s_r", "e_r", "s_q", "e_q", "errors", "similarity_errors", "stops"))), F.col("a.deltas").alias("deltas"))


def messages(spark: SparkSession, path: str) -> DataFrame:
    """(tag, body) of a stream of messages `{TAG ... }`, whose closing braces stand on lines of their own."""
    rows = spark.read.option("lineSep", "\n}\n").text(path).where(F.col("value").rlike(r"^\{[A-Z]{3}"))
    return rows.select(F.substring("value", 2, 3).alias("tag"), F.regexp_replace(F.substr("value", F.lit(6)), r"\n?\}\n?$", "").alias("body"))


def message_field(body: Column, name: str) -> Column:
    """The value of a line `name:value`; null if there is none."""
    return F.nullif(F.regexp_extract(body, f"(?m)^{name}:(.*)$", 1), F.lit(""))


def message_text(body: Column, name: str) -> Column:
    """The lines under `name:` up to the line with a dot, as one; null if there is none."""
    return F.nullif(F.regexp_replace(F.regexp_extract(body, f"(?s)(?:^|\\n){name}:\\n(.*?)\\n\\.(?:\\n|$)", 1), "\n", ""), F.lit(""))


def lines_by(spark: SparkSession, path: str) -> DataFrame:
    """(kind, fields) of a graph file whose lines begin with a letter for their kind."""
    f = F.split("value", "\t")
    return spark.read.text(path).where("value <> ''").select(F.element_at(f, 1).alias("kind"), F.slice(f, F.lit(2), F.greatest(F.size(f) - 1, F.lit(0))).alias("fields"))


BAM = "qname string, flag int, tid string, pos int, mapq int, cigar string, mtid string, mpos int, isize int, seq string, qual string, tags map<string,string>"


def bam(spark: SparkSession, path: str) -> DataFrame:
    """The rows of BAM files, with the columns of sam(). A file is one task's:
    its blocks are compressed one by one, but records run over their ends.
    Truncated or broken files are an error."""

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for row in _bam_records(_unzipped(content.as_py())):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield _bam_batch(rows)
                        rows = []
                if rows:
                    yield _bam_batch(rows)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, BAM)


def _unzipped(data: bytes) -> bytes:
    out = []
    while data:
        member = zlib.decompressobj(31)
        out.append(member.decompress(data))
        if not member.eof:
            raise ValueError("BAM file ends inside a block")
        data = member.unused_data
    return b"".join(out)


def _bam_batch(rows: list[tuple]) -> pa.RecordBatch:
    text, number = pa.string(), pa.int32()
    kinds = [text, number, text, number, number, text, text, number, number, text, text, pa.map_(text, text)]
    names = [f.split()[0] for f in BAM.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


#: Fixed values of the format: letters of 4-bit bases, operations, and the sizes of tag values.
BASES, OPERATIONS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
TAG_TYPES = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}


def _bam_tags(data: bytes) -> list[tuple[str, str]]:
    out, at = [], 0
    while at < len(data):
        name, kind = data[at : at + 2].decode(), chr(data[at + 2])
        at += 3
        if kind in "ZH":
            end = data.index(b"\0", at)
            value, at = data[at:end].decode(), end + 1
        elif kind == "A":
            value, at = chr(data[at]), at + 1
        elif kind == "B":
            each, n = TAG_TYPES[chr(data[at])], struct.unpack_from("<i", data, at + 1)[0]
            value = ",".join(f"{x:g}" for x in struct.unpack_from(f"<{n}{each}", data, at + 5))
            value, at = f"{chr(data[at])},{value}", at + 5 + n * struct.calcsize(each)
        else:
            value = f"{struct.unpack_from('<' + TAG_TYPES[kind], data, at)[0]:g}" if kind == "f" else str(struct.unpack_from("<" + TAG_TYPES[kind], data, at)[0])
            at += struct.calcsize(TAG_TYPES[kind])
        out.append((name, value))
    return out


def _bam_records(data: bytes):
    if data[:4] != b"BAM\1":
        raise ValueError("not a BAM file")
    at = 8 + struct.unpack_from("<i", data, 4)[0]
    n_refs, at = struct.unpack_from("<i", data, at)[0], at + 4
    refs = []
    for _ in range(n_refs):
        n = struct.unpack_from("<i", data, at)[0]
        refs.append(data[at + 4 : at + 3 + n].decode())
        at += 8 + n
    name = lambda i: "*" if i < 0 else refs[i]
    while at < len(data):
        size, tid, pos, l_name, mapq, _, n_ops, flag, n, mtid, mpos, isize = struct.unpack_from("<iiiBBHHHiiii", data, at)
        record, begin = data[at + 4 : at + 4 + size], 32
        if len(record) < size:
            raise ValueError("BAM file ends inside a record")
        at += 4 + size
        qname, begin = record[begin : begin + l_name - 1].decode(), begin + l_name
        cigar = "".join(f"{op >> 4}{OPERATIONS[op & 15]}" for op in struct.unpack_from(f"<{n_ops}I", record, begin)) or "*"
        begin += 4 * n_ops
        packed, begin = record[begin : begin + (n + 1) // 2], begin + (n + 1) // 2
        seq = "".join(BASES[b >> 4] + BASES[b & 15] for b in packed)[:n] or "*"
        quals, begin = record[begin : begin + n], begin + n
        qual = "*" if not quals or quals[0] == 255 else bytes(q + 33 for q in quals).decode()
        yield qname, flag, name(tid), pos, mapq, cigar, name(mtid), mpos, isize, seq, qual, _bam_tags(record[begin:])
