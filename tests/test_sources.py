import gzip
import random
import struct

import pytest
from helixframe.sources import readers, writers


def put(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_fasta(spark, tmp_path):
    path = put(tmp_path, "a.fa", ">r1 some words\nACGT\nAC\n\n>r2\n\n>r3 x>y\r\nGG\r\nTT\r\n")
    got = {r.id: (r.descr, r.seq) for r in readers.fasta(spark, path).collect()}
    assert got == {"r1": ("some words", "ACGTAC"), "r2": ("", ""), "r3": ("x>y", "GGTT")}
    zipped = tmp_path / "b.fa.gz"
    zipped.write_bytes(gzip.compress(b">z\nAC\nGT\n"))
    assert [tuple(r) for r in readers.fasta(spark, str(zipped)).collect()] == [("z", "", "ACGT")]


def test_fasta_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", "ACGTACGTAC"), ("b", ""), ("c", "A" * 95)], "id string, seq string")
    for width in (0, 10):
        path = str(tmp_path / f"out{width}")
        writers.fasta(df, path, width)
        assert {(r.id, r.seq) for r in readers.fasta(spark, path).collect()} == {(r.id, r.seq) for r in df.collect()}


def test_fastq(spark, tmp_path):
    df = spark.createDataFrame([("a", "ACGT", "II@+"), ("b", "A", "@")], "id string, seq string, qual string")
    path = str(tmp_path / "fq")
    writers.fastq(df.coalesce(1), path)
    assert sorted(map(tuple, readers.fastq(spark, path).collect())) == sorted(map(tuple, df.collect()))
    assert readers.quality_offset(df).first().offset == 33
    assert readers.fastq(spark, put(tmp_path, "empty.fq", "")).count() == 0


def test_sam(spark, tmp_path):
    path = put(tmp_path, "a.sam", "@HD\tVN:1\n@SQ\tSN:chr1\tLN:500\nr1\t99\tchr1\t10\t60\t4M\t=\t50\t44\tACGT\tIIII\tNM:i:1\tRG:Z:x\n")
    row = readers.sam(spark, path).first()
    assert (row.qname, row.flag, row.pos, row.mpos, row.mtid, row.tags) == ("r1", 99, 9, 49, "chr1", {"NM": "1", "RG": "x"})
    assert tuple(readers.sam_header(spark, path).first()) == ("chr1", 500)
    out = str(tmp_path / "sam")
    writers.sam(readers.sam(spark, path), out)
    again = readers.sam(spark, out).first()
    assert (again.pos, again.cigar, again.seq) == (9, "4M", "ACGT")


def test_interval_files(spark, tmp_path):
    bed = readers.bed(spark, put(tmp_path, "a.bed", "# c\nchr1\t5\t9\tn\nchr2\t0\t1\n")).collect()
    assert [tuple(r) for r in bed] == [("chr1", 5, 9, "n"), ("chr2", 0, 1, None)]
    paf = readers.paf(spark, put(tmp_path, "a.paf", "q\t100\t1\t50\t+\tt\t200\t2\t51\t40\t49\t60\tcg:Z:49M\n")).first()
    assert (paf.qname, paf.tend, paf.mapq, paf.tags) == ("q", 51, 60, ["cg:Z:49M"])
    pm = readers.posmap(spark, put(tmp_path, "a.posmap", "f1 c1 0 10 f\nf2\tc1\t5\t20\tr\n")).collect()
    assert [tuple(r) for r in pm] == [("f1", "c1", 0, 10, "f"), ("f2", "c1", 5, 20, "r")]
    assert readers.vcf(spark, put(tmp_path, "a.vcf", "##x\n#CHROM\nc\t3\t.\tA\tG\t9.5\tPASS\tDP=3\tGT\t0/1\n")).first().alt == "G"
    assert readers.kmer_table(spark, put(tmp_path, "k.txt", "ACG 4\nTTT 1\n")).count() == 2


def test_delta(spark, tmp_path):
    text = "/ref /qry\nNUCMER\n>r1 q1 500 400\n1 100 5 102 3 3 0\n10\n-4\n0\n200 300 300 200 0 0 0\n0\n>r2 q1 50 400\n1 20 1 20 1 1 0\n0\n"
    rows = readers.delta(spark, put(tmp_path, "a.delta", text)).orderBy("ref", "s_r").collect()
    assert [(r.ref, r.ref_len, r.s_r, r.e_q, r.deltas) for r in rows] == [("r1", 500, 1, 102, [10, -4]), ("r1", 500, 200, 200, []), ("r2", 50, 1, 20, [])]


def test_optional_fields_are_unbounded(spark, tmp_path):
    n = 1_000_003
    row = "q\t100\t1\t50\t+\tt\t200\t2\t51\t40\t49\t60\t" + "\t".join(["x"] * n) + "\n"
    paf = readers.paf(spark, put(tmp_path, "long.paf", row))
    assert paf.selectExpr("size(tags)").first()[0] == n
    assert readers.paf(spark, put(tmp_path, "bare.paf", "q\t1\n")).first().tags == []


def test_delta_of_many_lines(spark, tmp_path):
    """More lines under one header than any constant: what is sliced off is looked for in the plan, as folding so many is slow."""
    text = ">r1 q1 500 400\n" + "1 100 5 102 3 3 0\n10\n0\n" * 40
    df = readers.delta(spark, put(tmp_path, "many.delta", text))
    assert df.count() == 40
    assert "1000000" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_messages(spark, tmp_path):
    rows = readers.messages(spark, put(tmp_path, "a.frg", "{FRG\nacc:f1\nseq:\nACGT\n.\n}\n{LKG\nfrg:f1\n}\n")).collect()
    assert [r.tag for r in rows] == ["FRG", "LKG"]
    df = readers.messages(spark, str(tmp_path / "a.frg"))
    assert df.select(readers.message_field(df.body, "acc")).first()[0] == "f1"


def test_graph_files(spark, tmp_path):
    seg = spark.createDataFrame([(1, "ACG"), (2, "CGT")], "id long, seq string")
    links = spark.createDataFrame([(1, "F", 2, "R", 2)], "a long, a_ori string, b long, b_ori string, overlap int")
    writers.gfa(seg, links, str(tmp_path / "gfa"))
    assert {r.value for r in spark.read.text(str(tmp_path / "gfa")).collect()} == {"S\t1\tACG", "S\t2\tCGT", "L\t1\t+\t2\t-\t2M"}
    writers.dot(links, str(tmp_path / "dot"))
    writers.kmer_dump(spark.createDataFrame([("AC", 3)], "kmer string, cnt long"), str(tmp_path / "k"))
    assert readers.kmer_table(spark, str(tmp_path / "k")).first().cnt == 3
    o = spark.createDataFrame([(3, 1), (1, 2), (1, 1)], "a_iid long, b_iid long")
    writers.overlap_store(o, str(tmp_path / "store"), 2)
    assert spark.read.parquet(str(tmp_path / "store")).count() == 3


def packed_bam(refs, rows):
    """A BAM file of rows (qname, flag, ref number, pos, mapq, operations, mate's ref number and pos, isize, seq, qual, tags as bytes), in blocks of 100 bytes."""
    out = b"BAM\1" + struct.pack("<i", 4) + b"@HD\n" + struct.pack("<i", len(refs))
    for r in refs:
        out += struct.pack("<i", len(r) + 1) + r.encode() + b"\0" + struct.pack("<i", 1000)
    for qname, flag, tid, pos, mapq, ops, mtid, mpos, isize, seq, qual, tags in rows:
        codes = ["=ACMGRSVTWYHKDBN".index(c) for c in seq] + [0]
        body = struct.pack("<iiBBHHHiiii", tid, pos, len(qname) + 1, mapq, 0, len(ops), flag, len(seq), mtid, mpos, isize) + qname.encode() + b"\0"
        body += b"".join(struct.pack("<I", n << 4 | "MIDNSHP=X".index(o)) for n, o in ops)
        body += bytes(codes[i] << 4 | codes[i + 1] for i in range(0, len(seq), 2)) + (bytes(ord(c) - 33 for c in qual) if qual else b"\xff" * len(seq)) + tags
        out += struct.pack("<i", len(body)) + body
    return b"".join(gzip.compress(out[i : i + 100]) for i in range(0, len(out), 100))


def test_bam(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"r{i}", i % 4096, i % 2, 7 * i, i % 60, [(2, "S"), (n - 2, "M"), (1, "D")] if n > 2 else [], -1 if i % 3 else 0, i, -i, "".join(rng.choices("ACGTN", k=n)), "I" * n if i % 2 else "", b"NMc\x05" + b"XXZabc\0" + b"XBBS" + struct.pack("<iHH", 2, 7, 65535) if i % 5 else b"") for i in range(300) for n in [rng.randrange(0, 40)]]
    (tmp_path / "bam").mkdir()
    (tmp_path / "bam" / "a.bam").write_bytes(packed_bam(["chr1", "chr2"], rows))
    (tmp_path / "bam" / "empty.bam").write_bytes(packed_bam(["chr1"], []))
    got = {r.qname: r for r in readers.bam(spark, str(tmp_path / "bam")).collect()}
    assert len(got) == 300
    for q, flag, tid, pos, mapq, ops, mtid, mpos, isize, seq, qual, tags in rows:
        r = got[q]
        assert (r.flag, r.tid, r.pos, r.mapq, r.cigar) == (flag, f"chr{tid + 1}", pos, mapq, "".join(f"{n}{o}" for n, o in ops) or "*")
        assert (r.mtid, r.mpos, r.isize, r.seq, r.qual) == ("*" if mtid < 0 else "chr1", mpos, isize, seq or "*", qual or "*")
        assert r.tags == ({"NM": "5", "XX": "abc", "XB": "S,7,65535"} if tags else {})
    (tmp_path / "cut.bam").write_bytes(packed_bam(["chr1"], rows)[:-40])
    with pytest.raises(Exception, match="BAM"):
        readers.bam(spark, str(tmp_path / "cut.bam")).collect()
