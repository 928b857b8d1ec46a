"""Properties, and comparisons with plain Python."""

import random
from collections import Counter

import pytest
from helixframe.functions import sequence as S
from helixframe.operators import alignment_sets, alignments, fasta, graph, interval, kmer, overlap
from helixframe.plans import pipelines
from pyspark.sql import functions as F


def reads(spark, n=40, seed=1, length=60):
    rng = random.Random(seed)
    return spark.createDataFrame([(i, "".join(rng.choices("ACGT", k=rng.randrange(0, length)))) for i in range(n)] + [(n, None), (n + 1, "acgtNNACGT")], "id long, seq string")


def value(spark, text, f):
    return spark.createDataFrame([(text,)], "s string").select(f(F.col("s"))).first()[0]


def test_reverse_complement_twice(spark):
    for r in reads(spark).select("seq", S.reverse_complement(S.reverse_complement(F.col("seq"))).alias("again")).collect():
        assert r.again == r.seq


@pytest.mark.parametrize("k", [1, 3, 5])
def test_counts(spark, k):
    comp = str.maketrans("ACGT", "TGCA")
    want = Counter()
    for r in reads(spark).collect():
        for i in range(len(r.seq or "") - k + 1):
            m = r.seq[i : i + k]
            if set(m) <= set("ACGT"):
                want[min(m, m[::-1].translate(comp))] += 1
    assert {r.kmer: r.cnt for r in kmer.count(reads(spark), k).collect()} == want


def test_merge_of_parts_is_the_whole(spark):
    df = reads(spark)
    parts = [kmer.count(df.where(F.col("id") % 3 == i), 4) for i in range(3)]
    assert sorted(map(tuple, kmer.merge(parts).collect())) == sorted(map(tuple, kmer.count(df, 4).collect()))


def test_one_pass_is_one_less(spark):
    counts = kmer.count(reads(spark), 3)
    assert {r.kmer: r.cnt + 1 for r in kmer.count_one_pass(counts).collect()} == {r.kmer: r.cnt for r in counts.collect() if r.cnt > 1}


def test_algebra_of_a_table_with_itself(spark):
    t = kmer.count(reads(spark), 3)
    rows = sorted(map(tuple, t.collect()))
    for how in ("min", "max", "min_exist", "max_exist"):
        assert sorted(map(tuple, kmer.combine([t, t], how).collect())) == rows
    assert kmer.difference(t, t, "sub").count() == 0
    assert {r.cnt for r in kmer.difference(t, t, "divide").collect()} == {1000}


def test_minimizers(spark):
    comp = str.maketrans("ACGT", "TGCA")
    df = reads(spark, length=200).where("seq is not null")
    want = set()
    for r in df.collect():
        at = [(i, r.seq[i : i + 5]) for i in range(len(r.seq) - 4)]
        at = [(i, min(m, m[::-1].translate(comp))) for i, m in at if set(m) <= set("ACGT") and m != m[::-1].translate(comp)]
        for j in range(len(at) - 3):
            window = at[j : j + 4]
            least = min(m for _, m in window)
            want |= {(r.id, i, m) for i, m in window if m == least}
    assert {tuple(r) for r in kmer.minimizers(df, 5, 4).collect()} == want


def test_codons_and_repeats(spark):
    assert value(spark, "ATGGCCTAAN", S.translated) == "MA*"
    assert value(spark, "ACACAC", S.is_simple_repeat) is True
    assert value(spark, "ACACAG", S.is_simple_repeat) is False
    assert value(spark, "10M2I3D4S", S.reference_span) == 13
    assert value(spark, "1F_22R_3F", S.super_read_reversed) == "3R_22F_1R"


def test_poisson(spark):
    import math

    df = spark.createDataFrame([(3.5, 2), (3.5, 40), (20.0, 25)], "m double, n int")
    for r in df.select("m", "n", S.poisson_term(F.col("m"), F.col("n")).alias("p")).collect():
        assert abs(r.p / math.exp(-r.m + r.n * math.log(r.m) - math.lgamma(r.n + 1)) - 1) < 1e-9


def test_n50(spark):
    """Sizes 100, 80, 50, 30, 20, 20: half of 300 is reached with the second."""
    sizes = spark.createDataFrame([(x,) for x in (20, 100, 30, 80, 20, 50)], "size long")
    assert {r.percent: r.n_size for r in fasta.size_at(sizes, [10, 50, 60, 61, 99]).collect()} == {10: 100, 50: 80, 60: 80, 61: 50, 99: 20}
    assert {r.percent: r.n_size for r in fasta.size_at(sizes, [60], strict=True).collect()} == {60: 50}
    assert fasta.size_at(sizes, [90], total=1000).first().n_size is None
    assert abs(fasta.size_stats(sizes, []).first().e_size - (20**2 * 2 + 100**2 + 30**2 + 80**2 + 50**2) / 300) < 1e-9


def test_head_and_tail(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "id long")
    ids = lambda d: sorted(r.id for r in d.collect())
    assert ids(fasta.head(df, 3)) == [0, 1, 2] and ids(fasta.head(df, -3)) == list(range(7))
    assert ids(fasta.tail(df, 3)) == [7, 8, 9] and ids(fasta.tail(df, -3)) == list(range(3, 10))


def naive_merge(rows):
    out = []
    for lo, hi in sorted(rows):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [tuple(x) for x in out]


def test_intervals(spark):
    rng = random.Random(2)
    rows = [(g, lo, lo + rng.randrange(1, 30)) for g in range(3) for lo in (rng.randrange(300) for _ in range(25))]
    df = spark.createDataFrame(rows, "g long, lo long, hi long")
    for g in range(3):
        own = [(lo, hi) for x, lo, hi in rows if x == g]
        assert sorted((r.lo, r.hi) for r in interval.merge(df, ["g"]).where(F.col("g") == g).collect()) == naive_merge(own)
        depth = Counter(p for lo, hi in own for p in range(lo, hi))
        got = Counter()
        for r in interval.depth(df, ["g"]).where(F.col("g") == g).collect():
            got.update({p: r.depth for p in range(r.lo, r.hi)})
        assert got == depth
    a = df.select("g", F.col("lo").alias("a_lo"), F.col("hi").alias("a_hi"))
    b = df.select("g", F.col("lo").alias("b_lo"), F.col("hi").alias("b_hi"))
    want = sum(1 for x in rows for y in rows if x[0] == y[0] and x[1] < y[2] and y[1] < x[2])
    for width in (7, 1000):
        assert interval.overlaps(a, b, ["g"], width).count() == want


def test_quality_segment_and_trim(spark):
    rng = random.Random(5)
    rows = [(i, "".join(chr(33 + rng.randrange(0, 41)) for _ in range(rng.randrange(1, 40)))) for i in range(40)]
    got = {r.id: (r.begin, r.end) for r in fasta.best_quality_segment(spark.createDataFrame(rows, "id long, qual string"), 20, 1).collect()}
    for i, q in rows:
        v = [ord(c) - 53 for c in q]
        best = max((sum(v[a:b]), -b, b - a) for a in range(len(v)) for b in range(a + 1, len(v) + 1))[0]
        assert (i in got) == (best > 0)
        if i in got:
            assert sum(v[got[i][0] : got[i][1]]) == best


def test_subsample_is_by_template(spark):
    df = spark.createDataFrame([(f"run7:lane3:tile{i // 2 * 7919}", 0, 60, 50) for i in range(400)], "qname string, flag int, mapq int, l_seq int")
    kept = Counter(r.qname for r in alignments.view(df, sample=0.4, seed=3).collect())
    assert set(kept.values()) == {2} and 40 < len(kept) < 120
    h = 0
    for c in "r17":
        h = (h * 31 + ord(c)) % 2**32
    assert value(spark, "r17", S.x31) == h


def test_best_chain_is_best(spark):
    rng = random.Random(7)
    rows = []
    for i in range(60):
        s, n = rng.randrange(1, 300), rng.randrange(5, 60)
        rows.append((i, i % 4, 0, s, s + n, 1, n, float(rng.choice([90, 95, 100]))))
    df = spark.createDataFrame(rows, "aln long, ref long, qry long, s_r long, e_r long, s_q long, e_q long, idy double")
    got = {r.aln for r in alignment_sets.best_chain(df, "ref", most_overlap=0).collect()}
    for ref in range(4):
        own = sorted((r[3], r[4], int((r[4] - r[3] + 1) * (r[7] / 100) ** 2)) for r in rows if r[1] == ref)
        best = [0] * len(own)
        for i, (s, _, v) in enumerate(own):
            best[i] = v + max((best[j] for j in range(i) if own[j][1] < s), default=0)
        assert sum(int((r[4] - r[3] + 1) * (r[7] / 100) ** 2) for r in rows if r[1] == ref and r[0] in got) == max(best)
    both = alignment_sets.one_to_one(df).select("aln").collect()
    either = {r.aln for r in alignment_sets.many_to_many(df).select("aln").collect()}
    assert {r.aln for r in both} <= either


def test_unique_share(spark):
    rng = random.Random(3)
    rows = [(i, i % 3, s, s + rng.randrange(5, 80)) for i in range(1, 60) for s in [rng.randrange(500)]]
    df = spark.createDataFrame(rows, "aln long, ref long, s_r long, e_r long")
    depth = Counter((r[1], p) for r in rows for p in range(r[2], r[3] + 1))
    for r in alignment_sets.unique_share(df, "ref", "s_r", "e_r", "aln").collect():
        _, ref, lo, hi = next(x for x in rows if x[0] == r.aln)
        assert abs(r.share - 100 * sum(depth[ref, p] == 1 for p in range(lo, hi + 1)) / (hi - lo + 1)) < 1e-9


def test_clusters(spark):
    m = [(1, 1, 100, 50, 40), (1, 1, 160, 112, 40), (1, 1, 400, 350, 70), (1, 1, 165, 300, 30), (1, 2, 1, 1, 66)]
    got = sorted((r.ref, r.qry, r.n, r.total) for r in alignment_sets.clusters(spark.createDataFrame(m, "ref long, qry long, r long, q long, length long")).collect())
    assert got == [(1, 1, 1, 70), (1, 1, 2, 80), (1, 2, 1, 66)]


def test_paths_and_cycles(spark):
    e = [(1, 2), (2, 3), (3, 4), (3, 5), (5, 6), (10, 11), (11, 12), (12, 10), (20, 20)]
    got = {r.node: (r.path, r.place) for r in graph.unbranching_paths(spark.createDataFrame(e, "a long, b long")).collect()}
    assert [got[i] for i in (1, 2, 3)] == [(1, 0), (1, 1), (1, 2)]
    assert got[4] == (4, 0) and got[5] == (5, 0) and got[6] == (5, 1)
    assert [got[i] for i in (10, 11, 12)] == [(10, 0), (10, 1), (10, 2)] and got[20] == (20, 0)


def test_components_of_a_long_path(spark):
    e = [(i, i + 1) for i in range(300)] + [(1000, 1001)]
    got = graph.connected_components(spark.createDataFrame(e, "a long, b long")).collect()
    assert Counter(r.component for r in got) == {0: 301, 1000: 2}


def test_unitigs_rebuild_a_sequence(spark):
    rng = random.Random(11)
    genome = "".join(rng.choices("ACGT", k=300))
    pieces = [(i, genome[i : i + 50]) for i in range(0, 251, 2)]
    got = pipelines.unitigs(spark.createDataFrame(pieces, "id long, seq string"), 21, 1).collect()
    assert [r.seq for r in got] == [genome]


def test_match_runs(spark):
    rng = random.Random(4)
    t = "".join(rng.choices("ACGT", k=200))
    q = "".join(rng.choices("ACGT", k=30)) + t[50:110] + "".join(rng.choices("ACGT", k=30))
    mk = lambda s: spark.createDataFrame([(1, s)], "id long, seq string")
    best = max(overlap.match_runs(mk(q), mk(t), 12).collect(), key=lambda r: r.length)
    assert best.length >= 60 and q[best.q_begin : best.q_begin + best.length] == t[best.t_begin : best.t_begin + best.length]


def test_projection_and_back(spark):
    rng = random.Random(6)
    parent = [(c, c % 3, c * 1000, c * 1000 + 500, rng.choice("fr")) for c in range(9)]
    child = [(i, i % 9, b, b + 20, rng.choice("fr")) for i in range(40) for b in [rng.randrange(400)]]
    p = spark.createDataFrame(parent, "ctg long, scf long, bgn long, end long, ori string")
    c = spark.createDataFrame(child, "frg long, ctg long, bgn long, end long, ori string")
    back = overlap.demoted(overlap.projected(c, p, ("frg", "ctg", "scf")), p, ("frg", "ctg", "scf"))
    assert sorted(map(tuple, back.collect())) == sorted(r[:4] for r in child)


def test_trio(spark):
    one, two = "".join(random.Random(1).choices("ACGT", k=400)), "".join(random.Random(2).choices("ACGT", k=400))
    mk = lambda s: spark.createDataFrame([(1, s), (2, s)], "id long, seq string")
    child = spark.createDataFrame([(1, one[50:150]), (2, two[50:150]), (3, "AC")], "id long, seq string")
    assert {r.id: r.parent for r in pipelines.trio_binning(child, mk(one), mk(two), 15).collect()} == {1: "one", 2: "two"}


def test_report(spark):
    rows = {r.name: r.value for r in pipelines.assembly_report(spark.createDataFrame([(1, "A" * 10), (2, "A" * 30)], "id long, seq string")).collect()}
    assert rows["N50"] == 30 and rows["S"] == 40 and rows["C"] == 2 and rows["E"] == 25


def test_match_runs_without_a_cap(spark):
    """A passage in more than 50 targets matches in each of them, whole."""
    passage = "".join(random.Random(3).choices("ACGT", k=40))
    targets = spark.createDataFrame([(i, "T" * (i % 5) + passage) for i in range(60)], "id long, seq string")
    queries = spark.createDataFrame([(0, passage)], "id long, seq string")
    rows = overlap.match_runs(queries, targets, 12, None).where("length >= 40").collect()
    assert {r.t for r in rows} == set(range(60)) and all(r.q_begin == 0 and r.t_begin == r.t % 5 for r in rows)
    assert overlap.match_runs(queries, targets, 12, 50).count() == 0
