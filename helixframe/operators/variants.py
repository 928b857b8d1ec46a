"""Columns of aligned bases: calls, likelihoods, tests, edits and consensus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..functions.sequence import kmers
from . import interval


def base_calls(columns: DataFrame, by: list[str]) -> DataFrame:
    """by..., base, weight, depth: the base with the largest sum of qualities of
    each place, the first letter of equals, and how many bases there are. columns: by..., base, q."""
    of = columns.groupBy(*by, "base").agg(F.sum("q").alias("weight"), F.count("*").alias("n"))
    best = of.groupBy(*by).agg(F.max(F.struct("weight", (-F.ascii("base")).alias("c"))).alias("x"), F.sum("n").alias("depth"))
    return best.select(*by, F.char(-F.col("x.c")).alias("base"), F.col("x.weight").alias("weight"), "depth")


def consensus(columns: DataFrame, by: str, pos: str) -> DataFrame:
    """(by, seq): the called bases of each layout in order."""
    called = base_calls(columns, [by, pos])
    return called.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(pos, "base"))).alias("x")).select(by, F.array_join(F.transform("x", lambda c: c["base"]), "").alias("seq"))


def genotype_likelihoods(columns: DataFrame, by: list[str]) -> DataFrame:
    """by..., l0, l1, l2: log10 likelihoods of no, one and two alternative alleles,
    from independent errors. columns: by..., alt (whether the base is the alternative), q (phred)."""
    e = F.pow(F.lit(10.0), -F.col("q") / 10)
    right, wrong = F.log10(1 - e), F.log10(e)
    like = lambda hit: F.sum(F.when(hit, right).otherwise(wrong))
    return columns.groupBy(*by).agg(like(~F.col("alt")).alias("l0"), F.sum(F.log10(F.lit(0.5)) + e * 0).alias("l1"), like(F.col("alt")).alias("l2"))


def rank_sums(columns: DataFrame, by: list[str], value: str) -> DataFrame:
    """by..., n_ref, n_alt, u, z: the Mann-Whitney test of whether value is
    distributed alike in reads with and without the alternative (column alt);
    equal values share their mean rank, and z has the normal approximation without a tie correction."""
    w = Window.partitionBy(*by).orderBy(value)
    ranked = columns.withColumn("r", F.rank().over(w)).withColumn("t", F.count("*").over(Window.partitionBy(*by, value)))
    mean = F.col("r") + (F.col("t") - 1) / 2
    out = ranked.groupBy(*by).agg(F.count_if(~F.col("alt")).alias("n_ref"), F.count_if("alt").alias("n_alt"), F.sum(F.when(F.col("alt"), mean)).alias("sum")).where("n_ref > 0 and n_alt > 0")
    u = F.col("sum") - F.col("n_alt") * (F.col("n_alt") + 1) / 2
    n, m = F.col("n_ref").cast("double"), F.col("n_alt").cast("double")
    return out.select(*by, "n_ref", "n_alt", u.alias("u"), ((u - n * m / 2) / F.sqrt(n * m * (n + m + 1) / 12)).alias("z"))


def fisher(tables: DataFrame, a: str, b: str, c: str, d: str) -> DataFrame:
    """tables with two_sided: the p value of the exact test of each 2 x 2 table."""
    from .sequential import fisher_exact

    @F.pandas_udf("double")
    def p(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([fisher_exact(*map(int, x))[2] for x in zip(a, b, c, d, strict=True)])

    return tables.withColumn("two_sided", p(a, b, c, d))


def allele_frequencies(samples: DataFrame, by: str, rounds: int = 50) -> DataFrame:
    """(by, frequency): the alternative allele's frequency at each site that fits
    the samples' genotype likelihoods (l0, l1, l2; not logarithms) best, by
    rounds of expectation maximisation under Hardy-Weinberg proportions from 0.5 on."""
    rows = F.collect_list(F.struct("l0", "l1", "l2"))

    def step(f: Column) -> Column:
        def share(s: Column) -> Column:
            w0, w1, w2 = s["l0"] * (1 - f) * (1 - f), s["l1"] * 2 * f * (1 - f), s["l2"] * f * f
            return (w1 + 2 * w2) / (w0 + w1 + w2)

        return F.aggregate(F.transform("x", share), F.lit(0.0), lambda s, v: s + v) / (2 * F.size("x"))

    of = samples.groupBy(by).agg(rows.alias("x"))
    return of.select(by, F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.lit(0.5), lambda f, _: step(f)).alias("frequency"))


def linkage(genotypes: DataFrame, by: str, site: str, sample: str, value: str) -> DataFrame:
    """(by, a, b, n, r2): the squared correlation of the genotypes (0 to 2) of neighbouring sites over the samples that have both; NaN where a site does not vary among them."""
    w = Window.partitionBy(by).orderBy(site)
    near = genotypes.select(by, site).distinct().withColumn("b", F.lead(site).over(w)).where("b is not null").withColumnRenamed(site, "a")
    of = lambda c: genotypes.select(by, F.col(site).alias(c), F.col(sample).alias("__s"), F.col(value).alias(f"{c}_g"))
    both = near.join(of("a"), [by, "a"]).join(of("b"), [by, "b", "__s"])
    spread = F.var_pop("a_g") * F.var_pop("b_g")
    # not corr(): under ANSI rules it fails for a site that does not vary
    return both.groupBy(by, "a", "b").agg(F.count("*").alias("n"), F.coalesce(F.try_divide(F.pow(F.covar_pop("a_g", "b_g"), 2), spread), F.lit(float("nan"))).alias("r2"))


def applied(contigs: DataFrame, fixes: DataFrame) -> DataFrame:
    """(id, seq, n): contigs (id, seq) with fixes (id, pos from 1, ref, alt) made
    where the contig has ref (in any case) at pos. Of fixes that overlap the
    first stands, of those at one place the smallest alt; several alternatives (with a comma) are passed over."""
    ok = fixes.where(~F.contains("alt", F.lit(","))).join(contigs, "id").where(F.upper(F.substr("seq", F.col("pos"), F.length("ref"))) == F.upper("ref"))
    w = Window.partitionBy("id").orderBy("pos", "alt", "ref")
    far = F.max(F.col("pos") + F.length("ref")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    ok = ok.withColumn("far", far).where(F.col("far").isNull() | (F.col("pos") >= F.col("far")))
    by = ok.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "ref", "alt"))).alias("x"))
    rows = contigs.join(by, "id", "left")
    end = lambda c: c["pos"] + F.length(c["ref"])
    begin = lambda i: F.when(i > 0, end(F.get("x", i - 1))).otherwise(1)
    kept = F.transform("x", lambda c, i: F.concat(F.substr("seq", begin(i), c["pos"] - begin(i)), c["alt"]))
    rest = F.substr("seq", end(F.element_at("x", -1)), F.length("seq"))
    made = F.concat(F.array_join(kept, ""), rest)
    return rows.select("id", F.when(F.col("x").isNull(), F.col("seq")).otherwise(made).alias("seq"), F.coalesce(F.size("x"), F.lit(0)).alias("n"))


def voted_fixes(columns: DataFrame, reference: DataFrame, least: int, ratio: int = 2) -> DataFrame:
    """(id, pos, ref, alt): places (id, pos from 1) at which a base other than the
    reference's has least votes or more, and ratio times those of the
    reference's base or more; the one with most votes, the first letter of equals."""
    votes = columns.groupBy("id", "pos", "base").agg(F.count("*").alias("n")).join(reference.select("id", "pos", F.col("base").alias("ref")), ["id", "pos"])
    own = votes.where("base = ref").select("id", "pos", F.col("n").alias("own"))
    best = votes.where("base <> ref").groupBy("id", "pos", "ref").agg(F.max(F.struct("n", (-F.ascii("base")).alias("c"))).alias("x"))
    rows = best.join(own, ["id", "pos"], "left").select("id", "pos", "ref", F.char(-F.col("x.c")).alias("alt"), F.col("x.n").alias("n"), F.coalesce("own", F.lit(0)).alias("own"))
    return rows.where((F.col("n") >= least) & (F.col("n") >= ratio * F.col("own"))).select("id", "pos", "ref", "alt")


def with_errors(contigs: DataFrame, rate: float, seed: int, margin: int) -> tuple[DataFrame, DataFrame]:
    """Contigs (id, seq) with substitutions at about rate of their places, chosen
    by digests of seed, id and place, margin letters from the ends on, and the
    truth (id, pos from 1, ref, alt): G for an A, else A; N stays."""
    at = contigs.select("id", F.posexplode(F.split("seq", "")).alias("i", "ref"), F.length("seq").alias("size"))
    digest = F.conv(F.substring(F.md5(F.concat_ws("/", F.lit(str(seed)), F.col("id").cast("string"), F.col("i").cast("string"))), 1, 8), 16, 10).cast("double") / float(1 << 32)
    truth = at.where((F.col("i") >= margin) & (F.col("i") < F.col("size") - margin) & (F.upper("ref") != "N") & (digest < rate))
    truth = truth.select("id", (F.col("i") + 1).alias("pos"), "ref", F.when(F.upper("ref") == "A", "G").otherwise("A").alias("alt"))
    return applied(contigs, truth).select("id", "seq"), truth


def unpadded(rows: DataFrame, pad: str = "*") -> DataFrame:
    """rows (padded, pos from 0) with the sequence without pads, and the place in it of what stands at pos."""
    bare = lambda c: F.replace(c, F.lit(pad), F.lit(""))
    return rows.withColumn("seq", bare(F.col("padded"))).withColumn("unpadded_pos", F.length(bare(F.left("padded", F.col("pos")))))


def mismatches(pairs: DataFrame, a: str = "a", b: str = "b", most: int = 1000) -> DataFrame:
    """pairs with nm, the number of places at which two strings differ (over the
    shorter one; null is empty), and md: runs of equal places as numbers with the letters of a between."""
    codes = lambda s: np.frombuffer((s or "").encode("utf-32-le"), np.uint32)

    def walked(x: str | None, y: str | None) -> tuple[int, str]:
        one, two = codes(x), codes(y)
        n = min(len(one), len(two))
        at = np.flatnonzero(one[:n] != two[:n])
        runs = np.diff(at, prepend=-1, append=n) - 1
        letters = [x[i] for i in at.tolist()]
        return len(at), "".join([f"{r}{c}" for r, c in zip(runs.tolist(), [*letters, ""], strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, most):
                batch = whole.slice(at, most)
                nm, md = zip(*map(walked, batch.column(a).to_pylist(), batch.column(b).to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nm, pa.int32()), pa.array(md, pa.string())], [*batch.schema.names, "nm", "md"])

    return pairs.mapInArrow(run, StructType([*pairs.schema.fields, StructField("nm", IntegerType()), StructField("md", StringType())]))


def edit_distance(a: str, b: str) -> int:
    """Levenshtein's distance, a column of the matrix at once: the differences
    between its neighbours are the bits of two numbers (Myers 1999, Hyyro 2003)."""
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    if not a:
        return len(b)
    places: dict[str, int] = {}
    for c in set(a):
        places[c] = int("".join(["1" if x == c else "0" for x in reversed(a)]), 2)
    m = len(a)
    mask, last = (1 << m) - 1, m - 1
    up, down, score = mask, 0, m
    for c in b:
        eq = places.get(c, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        right_up = down | (mask & ~(diagonal | up))
        right_down = up & diagonal
        score += (right_up >> last & 1) - (right_down >> last & 1)
        right_up = (right_up << 1 | 1) & mask
        right_down = right_down << 1 & mask
        up = right_down | (mask & ~(diagonal | right_up))
        down = right_up & diagonal
    return score


def with_distance(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """pairs with distance, the edit distance of two strings (null if one is)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column(a).to_pylist(), batch.column(b).to_pylist(), strict=True)
            found = [None if x is None or y is None else edit_distance(x, y) for x, y in both]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], [*batch.schema.names, "distance"])

    return pairs.mapInArrow(run, StructType([*pairs.schema.fields, StructField("distance", LongType())]))


def solid_islands(profile: DataFrame, by: str, most_mismatch: float, most_insert: float, length: int) -> DataFrame:
    """(by, lo, hi): runs of at least length places of a profile (by, pos,
    coverage, mismatches, deletions, inserts) that are solid: covered, and with
    few mismatches or deletions and few inserts a read. Bubbles are cut there."""
    ok = (F.col("coverage") > 0) & ((F.col("mismatches") + F.col("deletions")) / F.col("coverage") <= most_mismatch) & (F.col("inserts") / F.col("coverage") <= most_insert)
    rows = profile.where(ok).select(by, F.col("pos").alias("lo"), (F.col("pos") + 1).alias("hi"))
    return interval.merge(rows, [by]).where(F.col("hi") - F.col("lo") >= length).select(by, "lo", "hi")


def mapping_quality(rows: DataFrame) -> DataFrame:
    """rows (score, second, matches, length, seeds, repeats) with mapq, from 0 to
    60: identity and how far the second best score stays behind, scaled by the
    score, less for few seeds and for few places that are not repeats."""
    unique = F.col("score") / (F.col("score") + F.col("repeats"))
    by_score = F.least(F.lit(1.0), 0.01 * F.col("score")) * unique
    pen = F.least(by_score, F.least(F.lit(1.0), 0.1 * F.col("seeds")))
    x = F.col("second") / F.col("score")
    q = F.floor(F.col("matches") / F.col("length") * pen * 40 * (1 - x * x) * F.log(F.col("score").cast("double")))
    return rows.withColumn("mapq", F.least(F.lit(60), F.greatest(F.lit(0), q)).cast("int"))


def divergence(rows: DataFrame, k: int) -> DataFrame:
    """rows (found, total: seeds of a query inside an alignment that match, and all of them) with divergence: ln(total / found) / k."""
    return rows.withColumn("divergence", F.log(F.col("total") / F.col("found")) / k)


def gf2_hash(code: Column, columns: list[int]) -> Column:
    """The product of a bit matrix, given by its columns, and a number's bits: the columns of its set bits added without carry."""
    own = [F.when(F.shiftright(code, i).bitwiseAND(F.lit(1)) == 1, F.lit(c)).otherwise(F.lit(0)) for i, c in enumerate(columns)]
    out = own[0]
    for c in own[1:]:
        out = out.bitwiseXOR(c)
    return out.cast("long")


def kmer_code(kmer: Column) -> Column:
    """A k-mer of at most 31 letters as a number, two bits a letter."""
    digits = F.conv(F.translate(kmer, "ACGT", "0123"), 4, 10)
    return digits.cast("long")


def exact_repeats(records: DataFrame, k: int, id_col: str = "id", seq_col: str = "seq") -> DataFrame:
    """(id, p, q, length): stretches of k letters or more that a sequence has at
    p and again at q > p, as long as they go on both ways. Pairs of places of
    one k-mer are joined with its next place only, so that a frequent k-mer
    makes as many rows as it has places: repeats that are in between are found from there."""
    at = records.select(F.col(id_col).alias("id"), F.posexplode(kmers(F.col(seq_col), k)).alias("p", "kmer"))
    near = at.withColumn("q", F.lead("p").over(Window.partitionBy("id", "kmer").orderBy("p"))).where("q is not null")
    w = Window.partitionBy("id", F.col("q") - F.col("p")).orderBy("p")
    runs = near.withColumn("run", F.col("p") - F.row_number().over(w))
    return runs.groupBy("id", (F.col("q") - F.col("p")).alias("d"), "run").agg(F.min("p").alias("p"), F.count("*").alias("n")).select("id", "p", (F.col("p") + F.col("d")).alias("q"), (F.col("n") + k - 1).alias("length"))



#: Genotypes (father, mother, child; alternative alleles) that a family can have.
FAMILIES = [(f, m, c) for f in range(3) for m in range(3) for c in range(3) if c in {a + b for a in {0: (0,), 1: (0, 1), 2: (1,)}[f] for b in {0: (0,), 1: (0, 1), 2: (1,)}[m]}]


def trio_likelihoods(rows: DataFrame) -> DataFrame:
    """rows with constrained and free: the largest log10 likelihood of genotypes
    that a family can have, and of any. rows have f0..f2, m0..m2 and c0..c2, the
    log10 likelihoods of father, mother and child."""
    of = lambda who, g: F.col(f"{who}{g}")
    constrained = F.greatest(*(of("f", f) + of("m", m) + of("c", c) for f, m, c in FAMILIES))
    free = sum((F.greatest(*(of(who, g) for g in range(3))) for who in "mc"), F.greatest(*(of("f", g) for g in range(3))))
    return rows.withColumns({"constrained": constrained, "free": free})


def allele_count_posteriors(samples: DataFrame, by: str, order: str) -> DataFrame:
    """(by, n, p_none, expected): from the genotype likelihoods (l0, l1, l2; not
    logarithms) of a site's samples the posterior of the number of alternative
    alleles among them, with a prior of 1 / k for k > 0 and the rest for none
    (of a rate of 0.001): the probability of none and the mean.

    Samples are added one by one: likelihoods of k alleles among j samples
    follow from those among j - 1."""
    each = F.array_sort(F.collect_list(F.struct(order, "l0", "l1", "l2")))

    def add(z: Column, s: Column) -> Column:
        j = (F.size(z) + 1) / 2  # the samples with this one
        at = lambda k: F.when((k >= 0) & (k < F.size(z)), F.get(z, k)).otherwise(0.0)

        def term(k: Column) -> Column:
            own = (2 * j - k) * (2 * j - k - 1) * s["l0"] * at(k) + 2 * k * (2 * j - k) * s["l1"] * at(k - 1) + k * (k - 1) * s["l2"] * at(k - 2)
            return own / (2 * j * (2 * j - 1))

        return F.transform(F.sequence(F.lit(0), F.size(z) + 1), term)

    sites = samples.groupBy(by).agg(each.alias("x"))
    sites = sites.select(by, F.size("x").alias("n"), F.aggregate("x", F.array(F.lit(1.0)), add).alias("z"))
    rate = 0.001
    total = F.aggregate(F.sequence(F.lit(1), 2 * F.col("n")), F.lit(0.0), lambda s, k: s + rate / k)
    weighted = F.transform("z", lambda z, k: z * F.when(k == 0, 1 - total).otherwise(rate / k))
    sites = sites.select(by, "n", weighted.alias("w"))
    add_up = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v)
    return sites.select(by, "n", (F.col("w")[0] / add_up(F.col("w"))).alias("p_none"), (add_up(F.transform("w", lambda w, k: w * k)) / add_up(F.col("w"))).alias("expected"))
