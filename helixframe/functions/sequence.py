"""Column functions over sequences; all are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The standard genetic code, codons in the order of bases T, C, A, G.
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def dna(text: Column) -> Column:
    """The letters A, C, G and T of a text, upper-case; the others are left out."""
    return F.regexp_replace(F.upper(text), "[^ACGT]+", "")


def dna_with_gaps(text: Column) -> Column:
    """A text with everything but A, C, G and T as N."""
    return F.regexp_replace(F.upper(text), "[^ACGT]", "N")


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def canonical(seq: Column) -> Column:
    """The smaller of a sequence and its reverse complement; byte order is the order A < C < G < T."""
    return F.least(seq, reverse_complement(seq))


def window(seq: Column, begin: Column, k: int) -> Column:
    """k letters from begin (from 1) of a sequence of single-byte letters:
    taken from its bytes, where a place is found without counting characters."""
    return F.substr(seq.cast("binary"), begin, F.lit(k)).cast("string")


def kmers(seq: Column, k: int) -> Column:
    """Array of all windows of k letters, in order; empty if seq is shorter."""
    n = F.octet_length(seq) - k + 1
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: window(seq, i, k))).otherwise(F.array().cast("array<string>"))


def is_valid(kmer: Column) -> Column:
    return kmer.rlike("^[ACGT]+$")


def compressed(seq: Column) -> Column:
    """Runs of one letter as one letter."""
    return F.regexp_replace(seq, r"(.)\1+", "$1")


def quality_masked(seq: Column, qual: Column, least: int, offset: int = 33) -> Column:
    """seq with N where the quality is below least."""
    base = F.split(seq, "")
    return F.array_join(F.zip_with(base, F.split(qual, ""), lambda b, q: F.when(F.ascii(q) - offset < least, "N").otherwise(b)), "")


def gc_fraction(seq: Column) -> Column:
    """Share of G and C; null for an empty sequence."""
    return F.length(F.regexp_replace(seq, "[^GC]", "")) / F.nullif(F.length(seq), F.lit(0))


def translated(seq: Column, frame: int = 0) -> Column:
    """Amino acids of a reading frame (0 to 2); X for codons with other letters."""
    n = F.floor((F.length(seq) - frame) / 3).cast("int")
    at = lambda codon, i: F.instr(F.lit("TCAG"), F.substr(codon, F.lit(i), F.lit(1))) - 1

    def acid(i: Column) -> Column:
        codon = F.substr(seq, i * 3 + 1 + frame, F.lit(3))
        index = at(codon, 1) * 16 + at(codon, 2) * 4 + at(codon, 3) + 1
        return F.when(is_valid(codon), F.substr(F.lit(AMINO_ACIDS), index.cast("int"), F.lit(1))).otherwise("X")

    return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), acid), "")).otherwise("")


def is_simple_repeat(seq: Column, most_unit: int = 3) -> Column:
    """Whether a sequence is nothing but a unit of at most most_unit letters over and over."""
    return F.when(F.length(seq) > most_unit, seq.rlike(f"^(.{{1,{most_unit}}}?)\\1+$")).otherwise(False)


def poisson_term(mean: Column, n: Column) -> Column:
    """exp(-mean) * mean^n / n!, by logarithms; Stirling's series stands in for n! beyond 1000."""
    log_factorial = F.when(n < 1000, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double")) + F.aggregate(F.when(n > 20, F.sequence(F.lit(21), n.cast("int"))).otherwise(F.array().cast("array<int>")), F.lit(0.0), lambda s, x: s + F.log(x.cast("double")))).otherwise(n * F.log(n.cast("double")) - n + 0.5 * F.log(2 * F.pi() * n))
    return F.exp(-mean + n * F.log(mean) - log_factorial)


def x31(name: Column) -> Column:
    """The 32-bit hash h * 31 + c over a name's bytes."""
    return F.aggregate(F.transform(F.split(name, ""), F.ascii), F.lit(0).cast("long"), lambda h, c: (h * 31 + c).bitwiseAND(F.lit((1 << 32) - 1)))


def natural_key(name: Column) -> Column:
    """A key that sorts names with their digit runs as numbers (of up to 20 digits)."""
    parts = F.regexp_extract_all(name, F.lit(r"(\d+|\D+)"), 1)
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"^\d"), F.lpad(F.regexp_replace(p, "^0+(?=.)", ""), 20, "0")).otherwise(p)), "")


def overlap_kind(a_hang: Column, b_hang: Column) -> Column:
    """contained (a in b), contains (b in a), 3p (a's end dovetails) or 5p (a's begin does)."""
    return F.when((a_hang >= 0) & (b_hang <= 0), "contains").when((a_hang <= 0) & (b_hang >= 0), "contained").when(a_hang > 0, "3p").otherwise("5p")


def super_read_reversed(name: Column) -> Column:
    """A super-read's name (unitigs with F or R, joined by _) read from the other strand."""
    return F.array_join(F.reverse(F.transform(F.split(name, "_"), lambda u: F.translate(u, "FR", "RF"))), "_")


def cigar_operations(cigar: Column) -> Column:
    """Array of (length, op)."""
    return F.transform(F.regexp_extract_all(cigar, F.lit(r"(\d+[MIDNSHP=X])"), 1), lambda o: F.struct(F.regexp_extract(o, r"^\d+", 0).cast("int").alias("length"), F.substr(o, F.length(o)).alias("op")))


def reference_span(cigar: Column) -> Column:
    """Reference bases that a cigar covers."""
    return F.aggregate(F.filter(cigar_operations(cigar), lambda o: o["op"].isin("M", "D", "N", "=", "X")), F.lit(0), lambda s, o: s + o["length"])


def delta_of(operations: Column) -> Column:
    """The signed distances between indels of an alignment, as delta files have
    them: a base that only the reference has counts positive, one that only
    the query has negative; clipped bases are not counted."""
    zero = F.struct(F.lit(0).alias("run"), F.array().cast("array<int>").alias("out"))

    def step(s: Column, o: Column) -> Column:
        sign = F.when(o["op"] == "D", 1).otherwise(-1)
        first = F.array(sign * (s["run"] + 1))
        indel = o["op"].isin("I", "D")
        same = o["op"].isin("M", "=", "X")
        out = F.when(indel, F.concat(s["out"], first, F.array_repeat(sign, o["length"] - 1))).otherwise(s["out"])
        return F.struct(F.when(indel, 0).when(same, s["run"] + o["length"]).otherwise(s["run"]).alias("run"), out.alias("out"))

    return F.aggregate(operations, zero, step, lambda s: s["out"])
