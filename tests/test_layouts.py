"""Layouts, stores, walks and variants against plain Python."""

import random

import pytest
from helixframe.operators import fasta, graph, kmer, layouts, overlap, sequential, stores, variants
from pyspark.sql import functions as F

COMP = str.maketrans("ACGT", "TGCA")


def letters(rng, n, alphabet="ACGT"):
    return "".join(rng.choices(alphabet, k=n))


@pytest.mark.parametrize("k,w", [(3, 4), (7, 5), (31, 3), (5, 1)])
def test_minimizers(spark, k, w):
    rng = random.Random(k)
    reads = [(i, letters(rng, rng.randrange(0, 120), "ACGTN" if i % 4 == 0 else "ACGT")) for i in range(30)] + [(99, None)]
    want = set()
    for i, s in reads:
        at = []
        for p in range(len(s or "") - k + 1):
            m = s[p : p + k]
            back = m[::-1].translate(COMP)
            if set(m) <= set("ACGT") and m != back:
                at.append((p, min(m, back)))
        for j in range(len(at) - w + 1):
            least = min(m for _, m in at[j : j + w])
            want |= {(i, p, m) for p, m in at[j : j + w] if m == least}
    got = kmer.minimizers(spark.createDataFrame(reads, "id long, seq string"), k, w).collect()
    assert len(got) == len(set(map(tuple, got))) and set(map(tuple, got)) == want


def test_low_complexity_against_all_stretches():
    rng = random.Random(2)
    for _ in range(60):
        seq = "".join(rng.choice([letters(rng, 12), "A" * rng.randrange(1, 14), "CA" * rng.randrange(1, 8), "N"]) for _ in range(5))
        window, threshold = 16, 12.0
        t = [seq[i : i + 3] if set(seq[i : i + 3]) <= set("ACGT") else None for i in range(len(seq) - 2)]
        score = {}
        for a in range(len(t)):
            for b in range(a + 1, min(len(t), a + window - 2)):
                if None in t[a : b + 1]:
                    break
                score[a, b] = 10 * sum(t[x] == t[y] for y in range(a, b + 1) for x in range(a, y)) / (b - a)
        covered = set()
        for (a, b), s in score.items():
            if s > threshold and all(score[x, y] <= s for x in range(a, b) for y in range(x + 1, b + 1)):
                covered |= set(range(a, b + 3))
        assert {i for lo, hi in sequential.low_complexity(seq, window, threshold) for i in range(lo, hi)} == covered


def test_numbered(spark):
    rows = spark.createDataFrame([(i * 7 % 101, "x") for i in range(101)], "id long, v string").repartition(5)
    got = fasta.numbered(rows, ["id"]).collect()
    assert all(r.place == r.id for r in got) and len(got) == 101
    assert fasta.numbered(rows.limit(0), ["id"]).count() == 0


def test_store(spark):
    store = spark.createDataFrame([(1, "ACGT", 0), (2, "GG", 1)], "id long, seq string, n int")
    more = spark.createDataFrame([(2, "TT", 5), (3, "CC", 6), (3, "AA", 7)], "id long, seq string, n int")
    grown = stores.appended(store, more, "id")
    assert {tuple(r) for r in grown.collect()} == {(1, "ACGT", 0), (2, "GG", 1), (3, "AA", 7)}
    edits = spark.createDataFrame([(1, None, 9), (3, "T", None), (8, "X", 1)], "id long, seq string, n int")
    assert {tuple(r) for r in stores.edited(grown, edits, "id").collect()} == {(1, "ACGT", 9), (2, "GG", 1), (3, "T", 7)}
    assert stores.edited(grown.limit(0), edits, "id").count() == 0


def test_sampled_to_bases(spark):
    reads = spark.createDataFrame([(i, 10 + i % 7) for i in range(200)], "id long, n int").repartition(6)
    kept = stores.sampled_to_bases(reads, "id", "n", 500, 1).collect()
    total = sum(r.n for r in kept)
    assert 500 <= total < 517
    assert {r.id for r in kept} == {r.id for r in stores.sampled_to_bases(reads.repartition(2), "id", "n", 500, 1).collect()}


def test_broken_and_trimmed(spark):
    contigs = spark.createDataFrame([("a", "ACGTNACGTACGT"), ("b", "AC"), ("c", "")], "id string, seq string")
    breaks = spark.createDataFrame([("a", 3), ("a", 9), ("a", 9), ("a", 50), ("a", 0), ("b", 1), ("z", 1)], "id string, at int")
    got = sorted(map(tuple, layouts.broken(contigs, breaks, 2).collect()))
    assert got == [("a", 0, "ACGTNACGT"), ("a", 9, "ACGT"), ("b", 0, "A"), ("b", 1, "C"), ("c", 0, "")]
    trims = spark.createDataFrame([("a", 2, 3), ("b", 5, 0)], "id string, front int, back int")
    assert sorted(map(tuple, layouts.trimmed(contigs, trims, 1).collect())) == [("a", "GTNACGTA")]


def test_fixes(spark):
    rng = random.Random(8)
    contigs = [(i, letters(rng, 60)) for i in range(20)]
    fixes, want = [], {}
    for i, s in contigs:
        places = sorted(rng.sample(range(0, 55), rng.randrange(0, 6)))
        out, far = s, 0
        made = []
        for p in places:
            ref, alt = s[p : p + rng.randrange(1, 4)], letters(rng, rng.randrange(0, 4))
            fixes.append((i, p + 1, ref.lower() if p % 2 else ref, alt))
            if p >= far:
                made.append((p, ref, alt))
                far = p + len(ref)
        for p, ref, alt in reversed(made):
            out = out[:p] + alt + out[p + len(ref) :]
        want[i] = (out, len(made))
    fixes += [(0, 1, "N", "A"), (0, 1, contigs[0][1][0], "A,C"), (77, 1, "A", "C")]
    got = variants.applied(spark.createDataFrame(contigs, "id long, seq string"), spark.createDataFrame(fixes, "id long, pos int, ref string, alt string"))
    assert {r.id: (r.seq, r.n) for r in got.collect()} == want


def test_kept_in_order(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(90)]
    kept = []
    for v in range(60):
        if not any((u, v) in edges or (v, u) in edges for u in kept):
            kept.append(v)
    got = graph.kept_in_order(spark.range(60).withColumnRenamed("id", "node"), spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(r.node for r in got if r.kept) == kept and len(got) == 60


def test_longest_paths(spark):
    rng = random.Random(4)
    weight = [rng.randrange(1, 9) for _ in range(40)]
    edges = sorted({(a, b) for a, b in ((rng.randrange(40), rng.randrange(40)) for _ in range(70)) if a < b})
    best = {}
    for v in range(40):
        best[v] = max([(weight[v], -v), *((best[a][0] + weight[v], best[a][1]) for a, b in edges if b == v)])
    nodes = spark.createDataFrame(list(enumerate(weight)), "node long, weight long")
    got = graph.longest_paths(nodes, spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: (r.weight, -r["first"]) for r in got} == {v: (float(w), f) for v, (w, f) in best.items()}


def test_chains_on_both_strands(spark):
    rng = random.Random(6)
    genome = letters(rng, 400)
    reads = [(0, genome[50:200]), (1, genome[100:300][::-1].translate(COMP)), (2, letters(rng, 150))]

    def seeds(rows):
        m = kmer.enumerate_kmers(spark.createDataFrame(rows, "id long, seq string"), 13, both_strands=False, keep=("id",), positions=True)
        rc = F.reverse(F.translate("kmer", "ACGT", "TGCA"))
        return m.select("id", "pos", F.least("kmer", rc).alias("minimizer"), (F.col("kmer") > rc).alias("back"))

    got = overlap.chained(overlap.anchors(seeds(reads), seeds([(7, genome)]), 10), 20, 5, 20).collect()
    assert {(r.a, r.back) for r in got} == {(0, False), (1, True)}
    one = next(r for r in got if r.a == 1)
    assert (one.a_lo, one.a_hi, -one.b_hi, -one.b_lo) == (0, 187, 100, 287)


def test_primary_and_increasing(spark):
    rows = [(1, 0, 100, 9.0, 1), (1, 40, 140, 8.0, 2), (1, 120, 160, 7.0, 3), (1, 500, 510, 1.0, 4), (2, 0, 10, 1.0, 5)]
    got = sequential.primary_alignments(spark.createDataFrame(rows, "q long, lo long, hi long, score double, k long"), "q", "lo", "hi", "score", "k").collect()
    assert {r.k for r in got if r.primary} == {1, 3, 4, 5}
    values = [(1, i, v) for i, v in enumerate([3, 1, 2, 2, 5, 4, 6])] + [(2, 0, 1)]
    got = sequential.longest_increasing(spark.createDataFrame(values, "g long, i long, v long"), ["g"], "i", "v").collect()
    assert {r.g: (r.n, r.longest) for r in got} == {1: (7, 4), 2: (1, 1)}


def test_bounded_paths(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (1, 3), (3, 4), (4, 1), (2, 5)], "a long, b long")
    pairs = spark.createDataFrame([(10, 1, 3), (11, 1, 5), (12, 5, 1), (13, 3, 1)], "pair long, a long, b long")
    got = {r.pair: (r.n_paths, r.path) for r in layouts.bounded_paths(edges, pairs, 3).collect()}
    assert got == {10: (2, None), 11: (1, [1, 2, 5]), 13: (1, [3, 4, 1])}


def test_allele_frequency_agrees_with_the_loop(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    table = rng.random((30, 3)) + 0.01
    rows = spark.createDataFrame([(1, *map(float, r)) for r in table], "site long, l0 double, l1 double, l2 double")
    assert abs(variants.allele_frequencies(rows, "site").first().frequency - sequential.allele_frequency(table)) < 1e-6


def test_clusters_of_matches(spark):
    from helixframe.operators import alignment_sets

    rng = random.Random(9)
    rows = sorted({(rng.randrange(2), 0, rng.randrange(400), rng.randrange(400), rng.randrange(10, 40)) for _ in range(120)})
    want = set()
    for ref in (0, 1):
        own = sorted((r, q, n) for g, _, r, q, n in rows if g == ref)
        group = list(range(len(own)))
        for i, (r, q, n) in enumerate(own):
            for j in range(i + 1, len(own)):
                apart = own[j][0] - (r + n)
                if apart <= 30 and abs((own[j][1] - own[j][0]) - (q - r)) <= max(5, int(0.12 * apart)) and group[i] != group[j]:
                    a, b = group[i], group[j]
                    group = [a if g == b else g for g in group]
        for g in set(group):
            some = [m for m, of in zip(own, group, strict=True) if of == g]
            if sum(n for *_, n in some) >= 40:
                want.add((ref, len(some), sum(n for *_, n in some), min(r for r, _, _ in some), max(r + n for r, _, n in some)))
    got = alignment_sets.clusters(spark.createDataFrame(rows, "ref long, qry long, r long, q long, length long"), most_gap=30, least=40).collect()
    assert {(r.ref, r.n, r.total, r.s_r, r.e_r) for r in got} == want
