"""k-mer tables: (kmer, cnt). Keys are grouped by a partial and a final hash
aggregate; nothing collects the k-mers of a group."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import AMINO_ACIDS, canonical, compressed, is_valid, kmers, window


def enumerate_kmers(seqs: DataFrame, k: int, seq_col: str = "seq", both_strands: bool = True, keep: tuple[str, ...] = (), positions: bool = False, clean: bool = False) -> DataFrame:
    """keep..., [pos from 0,] kmer: every window of k letters; windows with other letters than A, C, G and T are passed over. With clean there are none, and they are not looked for."""
    # numbers are exploded, not strings: the windows are then cut in generated
    # code. A short sequence has no numbers; a filter on its length would be
    # pushed below the exchange and take the letters out twice
    n = F.octet_length("__seq") - k + 1
    rows = seqs.select(*keep, F.col(seq_col).alias("__seq"))
    rows = rows.select(*keep, "__seq", F.explode(F.when(n > 0, F.sequence(F.lit(1), n))).alias("__i"))
    rows = rows.select(*keep, *([(F.col("__i") - 1).alias("pos")] if positions else []), window(F.col("__seq"), F.col("__i"), k).alias("kmer"))
    rows = rows if clean else rows.where(is_valid(F.col("kmer")))
    return rows.withColumn("kmer", canonical(F.col("kmer"))) if both_strands else rows


#: Letters of which the windows are worked out at once.
LETTERS = 1 << 19


def _codes(letters: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of k <= 31 letters: their numbers in base four, those of their reverse complements, and whether they are of A, C, G and T alone."""
    base = np.full(256, 4, np.uint8)
    base[[65, 67, 71, 84]] = range(4)
    b = base[letters]
    n = max(0, len(b) - k + 1)
    # windows of 1, 2, 4... letters from two of half the length; k is put together from them
    part, part_other, width = (b & 3).astype(np.int64), 3 - (b & 3).astype(np.int64), 1
    own, other, done = np.zeros(n, np.int64), np.zeros(n, np.int64), 0
    while done < k:
        if k & width:
            own = own << 2 * width | part[done : done + n]
            other |= part_other[done : done + n] << 2 * done
            done += width
        if done < k:
            part, part_other = part[:-width] << 2 * width | part[width:], part_other[width:] << 2 * width | part_other[:-width]
            width *= 2
    bad = np.concatenate([[0], np.cumsum(b == 4)])
    return own, other, bad[k : k + n] == bad[:n]


def _pieces(texts: list[str | None], k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(letters, row, pos): texts put together until they have LETTERS letters, with the row and
    place in it of each letter. A longer text is cut, and the k - 1 letters before a cut come twice."""
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def joined() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        letters = np.frombuffer(b"\n".join(x for _, _, x in held), np.uint8)
        lengths = np.array([len(x) + 1 for _, _, x in held])
        begins = np.cumsum(lengths) - lengths
        row = np.repeat([r for r, _, _ in held], lengths)[: len(letters)]
        return letters, row, np.arange(len(letters)) - np.repeat(begins - [p for _, p, _ in held], lengths)[: len(letters)]

    for r, text in enumerate(texts):
        raw = (text or "").encode()
        for at in range(0, len(raw) - k + 1, LETTERS):
            held.append((r, at, raw[at : at + LETTERS + k - 1]))
            size += len(held[-1][2])
            if size >= LETTERS:
                yield joined()
                held, size = [], 0
    if held:
        yield joined()


def of_part(code: np.ndarray, part: tuple[int, int]) -> np.ndarray:
    """Whether codes belong to part (k, n): the k-th of n parts of about equal size."""
    mixed = code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
    return mixed % np.uint64(part[1]) == part[0]


def codes(seqs: DataFrame, k: int, seq_col: str = "seq", both_strands: bool = True, keep: tuple[str, ...] = (), positions: bool = False, strands: bool = False, part: tuple[int, int] | None = None) -> DataFrame:
    """keep..., [pos from 0,] code[, back]: the windows of enumerate_kmers(), for k <= 31, as numbers in base
    four, which have the order of the k-mers; letters_of() spells them. With strands the
    smaller strand's, and whether that is the other one; windows that are their own reverse complement are left out. part: see of_part()."""
    kinds = [f"{c} {seqs.schema[c].dataType.simpleString()}" for c in keep]
    names = [*keep, *(["pos"] if positions else []), "code", *(["back"] if strands else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for letters, row, pos in _pieces(batch.column(len(keep)).to_pylist(), k):
                own, other, good = _codes(letters, k)
                at = np.flatnonzero(good & (own != other) if strands else good)
                code = (np.minimum(own, other) if both_strands or strands else own)[at]
                if part is not None:
                    mine = of_part(code, part)
                    at, code = at[mine], code[mine]
                rows = pa.array(row[at])
                out = [batch.column(c).take(rows) for c in range(len(keep))]
                out += [pa.array(pos[at].astype(np.int32))] if positions else []
                out += [pa.array(code)] + ([pa.array(own[at] > other[at])] if strands else [])
                yield pa.RecordBatch.from_arrays(out, names)

    kind = ", ".join([*kinds, *(["pos int"] if positions else []), "code long", *(["back boolean"] if strands else [])])
    return seqs.select(*keep, F.col(seq_col).alias("__seq")).mapInArrow(run, kind)


def count_codes(seqs: DataFrame, k: int, seq_col: str = "seq", both_strands: bool = True, least: int = 1, part: tuple[int, int] | None = None) -> DataFrame:
    """(code, cnt): the k-mers of codes() with their counts of least or more, of a part if one is named. Equal ones are put together where they are, before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for letters, _, _ in _pieces(batch.column(0).to_pylist(), k):
                own, other, good = _codes(letters, k)
                code = (np.minimum(own, other) if both_strands else own)[good]
                code, n = np.unique(code if part is None else code[of_part(code, part)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n.astype(np.int64))], ["code", "cnt"])

    out = seqs.select(F.col(seq_col).alias("__seq")).mapInArrow(run, "code long, cnt long").groupBy("code").agg(F.sum("cnt").alias("cnt"))
    return out.where(F.col("cnt") >= least) if least > 1 else out


def acid_words(seqs: DataFrame, n: int, id_col: str = "id", seq_col: str = "seq") -> DataFrame:
    """(id, word): the words of n <= 10 amino acids of sequences' three frames, that
    is, of every 3 n letters A, C, G and T, as numbers; equal ones of a row once (more often if it is cut)."""
    acids = np.frombuffer(AMINO_ACIDS.encode(), np.uint8).astype(np.int64)
    tcag = np.array([2, 1, 3, 0])  # of A, C, G and T in the order of the genetic code
    of_codon = acids[16 * tcag[np.arange(64) >> 4] + 4 * tcag[np.arange(64) >> 2 & 3] + tcag[np.arange(64) & 3]] - 42  # from *, below 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for letters, row, _ in _pieces(batch.column(1).to_pylist(), 3 * n):
                acid = of_codon[_codes(letters, 3)[0]]
                bad = np.concatenate([[0], np.cumsum(~np.isin(letters, np.frombuffer(b"ACGT", np.uint8)))])
                m = max(0, len(letters) - 3 * n + 1)
                word = np.zeros(m, np.int64)
                for j in range(n):
                    word = word << 6 | acid[3 * j : 3 * j + m]
                at = np.flatnonzero(bad[3 * n :][:m] == bad[:m])
                order = at[np.lexsort((word[at], row[at]))]
                new = np.append(True, (word[order[1:]] != word[order[:-1]]) | (row[order[1:]] != row[order[:-1]]))[: len(order)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row[order[new]])), pa.array(word[order[new]])], ["id", "word"])

    kind = seqs.schema[id_col].dataType.simpleString()
    return seqs.select(id_col, seq_col).mapInArrow(run, f"id {kind}, word long")


def letters_of(code: Column, k: int) -> Column:
    """The k-mer that a number of codes() stands for."""
    return F.translate(F.lpad(F.conv(code.cast("string"), 10, 4), k, "0"), "0123", "ACGT")


def count(seqs: DataFrame, k: int, seq_col: str = "seq", both_strands: bool = True, least: int = 1, most: int | None = None, clean: bool = False, part: tuple[int, int] | None = None) -> DataFrame:
    """(kmer, cnt), of counts from least to most; part (k <= 31): see of_part()."""
    if k <= 31:
        out = count_codes(seqs, k, seq_col, both_strands, least, part)
        out = out if most is None else out.where(F.col("cnt") <= most)
        return out.select(letters_of(F.col("code"), k).alias("kmer"), "cnt")
    out = enumerate_kmers(seqs, k, seq_col, both_strands, clean=clean).groupBy("kmer").agg(F.count("*").alias("cnt"))
    out = out.where(F.col("cnt") >= least) if least > 1 else out
    return out if most is None else out.where(F.col("cnt") <= most)


def count_listed(seqs: DataFrame, listed: DataFrame, k: int, seq_col: str = "seq") -> DataFrame:
    """Counts of the k-mers of listed's sequences only; those that don't occur have 0."""
    wanted = enumerate_kmers(listed, k, seq_col).select("kmer").distinct()
    return wanted.join(count(seqs, k, seq_col), "kmer", "left").select("kmer", F.coalesce("cnt", F.lit(0)).alias("cnt"))


def count_one_pass(counts: DataFrame) -> DataFrame:
    """What counting behind a Bloom filter gives: the first occurrence is lost."""
    return counts.where("cnt > 1").select("kmer", (F.col("cnt") - 1).alias("cnt"))


def count_prefiltered(counts: DataFrame, seen: DataFrame) -> DataFrame:
    """Counts of the k-mers that a Bloom counter over other reads has seen twice or more."""
    return counts.join(seen.where("cnt > 1").select("kmer"), "kmer", "left_semi")


def bloom_query(queries: DataFrame, counts: DataFrame) -> DataFrame:
    """0, 1 or 2 (twice or more) for each queried k-mer."""
    return queries.select("kmer").distinct().join(counts, "kmer", "left").select("kmer", F.least(F.coalesce("cnt", F.lit(0)), F.lit(2)).alias("seen"))


def query(queries: DataFrame, counts: DataFrame) -> DataFrame:
    """The count of each queried k-mer, 0 if it is absent."""
    return queries.join(counts, "kmer", "left").withColumn("cnt", F.coalesce("cnt", F.lit(0)))


def histogram(counts: DataFrame, low: int = 1, high: int = 10_000, increment: int = 1, full: bool = False) -> DataFrame:
    """(bucket, n): bucket 0 of the scheme takes what is below its base, the last what is above high + increment."""
    base = 0 if increment >= low else low - increment
    ceil = high + increment
    buckets = (ceil + increment - base) // increment
    v = F.col("cnt")
    index = F.when(v < base, 0).when(v > ceil, buckets - 1).otherwise(F.floor((v - base) / increment))
    out = counts.groupBy((base + index * increment).cast("long").alias("bucket")).agg(F.count("*").alias("n"))
    if not full:
        return out
    every = counts.sparkSession.range(base, base + buckets * increment, increment).withColumnRenamed("id", "bucket")
    return every.join(out, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


def stats(counts: DataFrame, low: int = 0, high: int = 1 << 62) -> DataFrame:
    """One row: k-mers of count one, distinct ones, all, the largest count; of counts from low to high."""
    c = F.col("cnt")
    return counts.where(c.between(low, high)).agg(F.count_if(c == 1).alias("n_unique"), F.count("*").alias("n_distinct"), F.coalesce(F.sum(c), F.lit(0)).alias("n_total"), F.coalesce(F.max(c), F.lit(0)).alias("max_count"))


def merge(tables: list[DataFrame], least: int = 1, most: int | None = None) -> DataFrame:
    out = reduce(DataFrame.unionByName, (t.select("kmer", "cnt") for t in tables)).groupBy("kmer").agg(F.sum("cnt").alias("cnt")).where(F.col("cnt") >= least)
    return out if most is None else out.where(F.col("cnt") <= most)


def quality_counts(reads: DataFrame, k: int, quality: int, bits: int = 7, seq_col: str = "seq", masked_col: str = "masked") -> DataFrame:
    """(kmer, cnt, hq). masked_col has N where the quality is too low. A k-mer
    that has ever been read in high quality counts its high-quality reads
    only; counts end at 2^bits - 1."""
    both = F.arrays_zip(kmers(F.col(seq_col), k).alias("kmer"), F.transform(kmers(F.col(masked_col), k), is_valid).alias("hq"))
    rows = reads.select(F.explode(both).alias("x")).select(F.col("x.kmer").alias("kmer"), F.col("x.hq").alias("hq")).where(is_valid(F.col("kmer"))).withColumn("kmer", canonical(F.col("kmer")))
    good = F.count_if("hq")
    return rows.groupBy("kmer").agg(F.least(F.lit((1 << bits) - 1), F.when(good > 0, good).otherwise(F.count("*"))).alias("cnt"), (good > 0).alias("hq"))


def _tagged(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, (t.select("kmer", "cnt", F.lit(i).alias("t")) for i, t in enumerate(tables)))


def combine(tables: list[DataFrame], how: str) -> DataFrame:
    """Set algebra of k-mer tables (each k-mer once in a table).

    min and max need the k-mer in every table, min_exist and max_exist in any,
    add sums up; and, nand, or, xor go by the number of tables that have it,
    and give count 1."""
    n = len(tables)
    value = {"min": F.min("cnt"), "max": F.max("cnt"), "min_exist": F.min("cnt"), "max_exist": F.max("cnt"), "add": F.sum("cnt")}.get(how, F.lit(1).cast("long"))
    keep = {"min": F.col("n") == n, "max": F.col("n") == n, "and": F.col("n") == n, "nand": F.col("n") < n, "xor": F.col("n") % 2 == 1}.get(how, F.lit(True))
    return _tagged(tables).groupBy("kmer").agg(value.alias("cnt"), F.count("*").alias("n")).where(keep).select("kmer", "cnt")


def difference(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """sub: a - b where positive. abs: |a - b| where not zero. divide: floor(1000 a / b) of k-mers in both, where not zero."""
    both = a.select("kmer", F.col("cnt").alias("x")).join(b.select("kmer", F.col("cnt").alias("y")), "kmer", "full")
    x, y = F.coalesce("x", F.lit(0)), F.coalesce("y", F.lit(0))
    value = {"sub": x - y, "abs": F.abs(x - y), "divide": F.when((x > 0) & (y > 0), F.floor(1000 * x / F.nullif(y, F.lit(0))))}[how]
    return both.select("kmer", value.cast("long").alias("cnt")).where("cnt > 0")


def threshold(counts: DataFrame, how: str, n: int) -> DataFrame:
    c = F.col("cnt")
    return counts.where({"le": c <= n, "ge": c >= n, "eq": c == n}[how])


def compressed_positions(seqs: DataFrame, k: int, seq_col: str = "seq") -> DataFrame:
    """(kmer, cnt, first_pos, last_pos) of homopolymer-compressed sequences."""
    rows = enumerate_kmers(seqs.select(compressed(F.col(seq_col)).alias("seq")), k, both_strands=False, positions=True)
    return rows.groupBy("kmer").agg(F.count("*").alias("cnt"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"))


def spectrum(counts: DataFrame) -> DataFrame:
    """(cnt, n): how many k-mers have each count."""
    return counts.groupBy("cnt").agg(F.count("*").alias("n"))


def coverage_peak(spectrum_: DataFrame, floor: int = 5, cap: int = 250) -> DataFrame:
    """(valley, peak, max_count): the first rise after the fall of rare counts,
    the tallest bin from there, and the count below which 99.5 % of the
    distinct k-mers or two thirds of all lie, from floor * 1 to cap. The
    spectrum has a row per distinct count: it is small, so its windows are not partitioned."""
    w = Window.orderBy("cnt")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = spectrum_.withColumn("next_n", F.lead("n").over(w)).withColumn("distinct", F.sum("n").over(run)).withColumn("total", F.sum(F.col("n") * F.col("cnt")).over(run))
    valley = rows.where("next_n >= n").agg(F.min("cnt").alias("valley"))
    rows = rows.crossJoin(F.broadcast(valley)).crossJoin(F.broadcast(spectrum_.agg(F.sum("n").alias("d"), F.sum(F.col("n") * F.col("cnt")).alias("t"))))
    return rows.agg(
        F.first("valley").alias("valley"),
        F.max_by("cnt", F.when(F.col("cnt") >= F.col("valley"), F.struct("n", -F.col("cnt")))).alias("peak"),
        F.greatest(F.lit(floor), F.least(F.lit(cap), F.min(F.when((F.col("distinct") >= 0.995 * F.col("d")) | (3 * F.col("total") >= 2 * F.col("t")), F.col("cnt"))))).alias("max_count"),
    )


def repetitive_cutoff(spectrum_: DataFrame, least: int = 2, rate: int = 100) -> DataFrame:
    """One row: rate times the mean frequency of distinct k-mers with frequency least or more (with one more in the divisor)."""
    some = F.col("cnt") >= least
    return spectrum_.agg((rate * F.coalesce(F.sum(F.when(some, F.col("cnt") * F.col("n"))), F.lit(0)) / (F.coalesce(F.sum(F.when(some, F.col("n"))), F.lit(0)) + 1)).alias("cutoff"))


def least_count(spectrum_: DataFrame, genome_size: int) -> DataFrame:
    """One row: the count from which on the number of distinct k-mers is closest to genome_size, 2 at least."""
    w = Window.orderBy(F.desc("cnt")).rowsBetween(Window.unboundedPreceding, 0)
    rows = spectrum_.withColumn("above", F.sum("n").over(w))
    return rows.agg(F.greatest(F.lit(2), F.min_by("cnt", F.struct(F.abs(F.col("above") - genome_size), -F.col("cnt")))).alias("least_count"))


def _least_of(values: np.ndarray, w: int) -> np.ndarray:
    """The least of each w neighbours, by doubling."""
    done, least = 1, values
    while done < w:
        step = min(done, w - done)
        least = np.minimum(least[: len(least) - step], least[step:])
        done += step
    return least


def minimizers(seqs: DataFrame, k: int, w: int, id_col: str = "id", seq_col: str = "seq") -> DataFrame:
    """(id, pos, minimizer): in each window of w k-mers (k <= 31) the smallest
    canonical k-mers, ties kept; k-mers that are their own reverse complement
    or have other letters than A, C, G and T are skipped. The hash is the
    k-mer's own order, so that any engine can check it. Windows are of one
    sequence, so a row is handled where it is, on whole arrays of numbers."""
    letters = np.frombuffer(b"ACGT", np.uint8)

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                raw = np.frombuffer((batch.column(1)[at].as_py() or "").encode(), np.uint8)
                own, other, good = _codes(raw, k)
                pos = np.flatnonzero(good & (own != other))
                code = np.minimum(own, other)[pos]
                if len(pos) < w:
                    continue
                least = _least_of(code, w)
                # the largest of the minima of the full windows that a k-mer is in
                most = -_least_of(-np.concatenate([np.full(w - 1, -1), least, np.full(w - 1, -1)]), w)
                chosen = np.flatnonzero(code <= most)
                for lo in range(0, len(chosen), 100_000):
                    some = chosen[lo : lo + 100_000]
                    text = letters[code[some, None] >> np.arange(2 * k - 2, -1, -2) & 3].tobytes().decode()
                    ids = pa.repeat(batch.column(0)[at], len(some))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(pos[some].astype(np.int32)), pa.array([text[i : i + k] for i in range(0, len(text), k)])], ["id", "pos", "minimizer"])

    kind = seqs.schema[id_col].dataType.simpleString()
    return seqs.select(F.col(id_col).alias("id"), F.col(seq_col).alias("seq")).mapInArrow(run, f"id {kind}, pos int, minimizer string").withColumnRenamed("id", id_col)


def frequent_cutoff(index: DataFrame, key: str, fraction: float) -> DataFrame:
    """One row: the occurrence count that only the fraction of most frequent keys exceed."""
    return index.groupBy(key).agg(F.count("*").alias("cnt")).agg(F.percentile("cnt", 1 - fraction).alias("cutoff"))


def links(seqs: DataFrame, k: int, seq_col: str = "seq") -> DataFrame:
    """(kmer, cnt, and how often each letter stands before and after it): the edges of a de Bruijn graph."""
    at = F.posexplode(kmers(F.col(seq_col), k)).alias("pos", "kmer")
    rows = seqs.select(seq_col, at).where(is_valid(F.col("kmer")))
    before = F.when(F.col("pos") > 0, F.substr(F.col(seq_col), F.col("pos"), F.lit(1)))
    after = F.substr(F.col(seq_col), F.col("pos") + k + 1, F.lit(1))
    each = [F.count_if(c == b).alias(f"{side}_{b}") for side, c in (("in", F.col("before")), ("out", F.col("after"))) for b in "ACGT"]
    return rows.select("kmer", before.alias("before"), after.alias("after")).groupBy("kmer").agg(F.count("*").alias("cnt"), *each)


def classify_parents(child: DataFrame, one: DataFrame, two: DataFrame, id_col: str = "id") -> DataFrame:
    """Per read of child (id, kmer): k-mers that only the first, only the second, or both parents have more than once."""
    rows = child.join(one.where("cnt > 1").select("kmer", F.lit(True).alias("a")), "kmer", "left").join(two.where("cnt > 1").select("kmer", F.lit(True).alias("b")), "kmer", "left")
    a, b = F.col("a").isNotNull(), F.col("b").isNotNull()
    return rows.groupBy(id_col).agg(F.count_if(a & ~b).alias("n_one"), F.count_if(b & ~a).alias("n_two"), F.count_if(a & b).alias("n_both"))


def select_frequent(reads: DataFrame, counts: DataFrame, share: float, most: float, id_col: str = "id") -> DataFrame:
    """Of each read (id, kmer) the k-mers with frequencies in its top share and
    not above most: a threshold of frequency, so that ties stay."""
    rows = reads.join(counts, "kmer").where(F.col("cnt") <= most)
    w = Window.partitionBy(id_col).orderBy(F.desc("cnt"))
    rows = rows.withColumn("rank", F.row_number().over(w)).withColumn("n", F.count("*").over(Window.partitionBy(id_col)))
    limit = F.min(F.when(F.col("rank") <= F.greatest(F.lit(1), F.floor(F.col("n") * share)), F.col("cnt"))).over(Window.partitionBy(id_col))
    return rows.withColumn("limit", limit).where("cnt >= limit").select(id_col, "kmer", "cnt")


def profile(contig_kmers: DataFrame, counts: DataFrame, peak: Column, id_col: str = "id") -> DataFrame:
    """Per contig: k-mers read in single copy (below one and a half peaks), in double copy, and more often."""
    c = F.coalesce("cnt", F.lit(0))
    rows = contig_kmers.join(counts, "kmer", "left")
    return rows.groupBy(id_col).agg(F.count_if(c == 0).alias("n_missing"), F.count_if((c > 0) & (c < 1.5 * peak)).alias("n_single"), F.count_if((c >= 1.5 * peak) & (c < 2.5 * peak)).alias("n_double"), F.count_if(c >= 2.5 * peak).alias("n_repeat"))
