"""Inputs with hot keys and dense groups, on which work has to grow with the rows and not with their pairs."""

import itertools
import random
import time

import numpy as np
from pyspark.sql import functions as F

from helixframe.operators import alignment_sets, banded, chaining, fasta, layouts, overlap, sequential, stores


def test_spanning_mates_of_one_pair(spark):
    contigs = spark.range(2000).select(F.col("id").alias("ctg"), F.floor(F.col("id") / 2).alias("scf"), F.col("id").alias("bgn"), F.lit("f").alias("ori"))
    mate = F.when(F.col("id") % 2 == 0, "F").otherwise("R")
    reads = spark.range(120_000).select(F.lit(1).alias("pair"), mate.alias("mate"), (F.col("id") % 2000).alias("ctg"), F.when(F.col("id") % 2 == 0, "f").otherwise("r").alias("ori"))
    t = time.time()
    assert layouts.spanning_mates(contigs, reads).count() == 1000
    assert time.time() - t < 60


def test_super_reads_with_one_first_unit(spark):
    many = spark.range(60_000).select("id", F.array(F.lit(1), F.lit(2)).alias("units"))
    longer = spark.range(60_000, 120_000).select("id", F.array(F.lit(1), F.lit(3), F.lit(1), F.col("id")).alias("units"))
    longest = spark.range(7, 9).select((-F.col("id")).alias("id"), F.array(F.lit(9), F.lit(1), F.lit(2)).alias("units"))
    t = time.time()
    got = overlap.super_read_contained(many.unionByName(longer).unionByName(longest))
    assert [tuple(r) for r in got.groupBy("within").count().collect()] == [(-8, 60_000)]
    assert time.time() - t < 60


def test_super_reads_as_by_hand(spark, monkeypatch):
    monkeypatch.setattr(overlap, "MEET", 2)
    rng = random.Random(5)
    names = {k: [rng.randrange(3) for _ in range(rng.randrange(0, 8))] for k in range(120)}
    inside = lambda s, x: any(x[k : k + len(s)] == s for k in range(len(x) - len(s) + 1))
    want = {k: min(found) for k, s in names.items() if s and (found := [m for m, x in names.items() if len(s) < len(x) and inside(s, x)])}
    got = overlap.super_read_contained(spark.createDataFrame(list(names.items()), "id long, units array<long>"))
    assert {r.id: r.within for r in got.collect()} == want


def test_paths_and_hops_in_dense_graphs(spark):
    n = 150
    edges = spark.range(n).select(F.col("id").alias("a")).crossJoin(spark.range(n).select(F.col("id").alias("b"))).where("a <> b")
    pairs = spark.range(40_000).select(F.col("id").alias("pair"), (F.col("id") % 7).alias("a"), (F.col("id") % 7 + 1).alias("b"))
    t = time.time()
    got = layouts.bounded_paths(edges, pairs, 3).groupBy("n_paths").count().collect()
    assert [tuple(r) for r in got] == [(1 + (n - 2) + (n - 2) * (n - 3), 40_000)]
    assert [tuple(r) for r in layouts.hops(edges, pairs, 3).groupBy("hops").count().collect()] == [(1, 40_000)]
    assert time.time() - t < 90


def test_paths_and_hops_as_by_hand(spark):
    rng = random.Random(3)
    edges = sorted({(rng.randrange(12), rng.randrange(12)) for _ in range(34)})
    pairs = [(k, rng.randrange(12), rng.randrange(12)) for k in range(150)]
    paths, hops = {}, {}
    for pair, a, b in pairs:
        ways = [(a, *inner, b) for m in range(3) for inner in itertools.permutations(sorted(set(range(12)) - {a, b}), m) if a != b]
        found = [way for way in ways if all(e in edges for e in itertools.pairwise(way))]
        if found:
            paths[pair] = (len(found), list(found[0]) if len(found) == 1 else None)
        at = {a}
        for n in (1, 2, 3):
            at = {y for x, y in edges if x in at}
            if b in at:
                hops.setdefault(pair, n)
    e, p = spark.createDataFrame(edges, "a long, b long"), spark.createDataFrame(pairs, "pair long, a long, b long")
    assert {r.pair: (r.n_paths, r.path) for r in layouts.bounded_paths(e, p, 3).collect()} == paths
    assert {r.pair: r.hops for r in layouts.hops(e, p, 3).collect()} == hops


def test_chains_by_ends_are_chains_by_one(spark):
    rng = np.random.default_rng(1)
    for n, width in ((300, 40), (400, 3), (200, 1000)):
        lo = rng.integers(0, 500, n)
        hi = lo + rng.integers(0, width, n)
        at = np.lexsort((hi, lo))
        lo, hi, w = lo[at], hi[at], rng.choice([0.81, 0.9, 1.0], n)
        score, before = alignment_sets._chained_by_one(lo, hi, w, 100.0)
        by_ends = alignment_sets._chained_by_ends(lo, hi, w, np.unique(hi))
        assert by_ends[0].tolist() == score and by_ends[1].tolist() == before


def test_best_chain_of_a_dense_sequence(spark):
    i = F.col("id")
    lo = i * 7 % 5000
    rows = spark.range(300_000).select(i.alias("aln"), F.lit(1).alias("ref"), lo.alias("s_r"), (lo + 100 + i % 300).alias("e_r"), (F.lit(90.0) + i % 11).alias("idy"))
    t = time.time()
    assert alignment_sets.best_chain(rows, "ref").count() > 10
    assert time.time() - t < 60


def test_homopolymer_trim_of_a_long_read(spark):
    long_ = "ACG" * 1_000_000 + "TTTTT"
    t = time.time()
    got = dict(fasta.homopolymer_trim(spark.createDataFrame([(1, long_), (2, ""), (3, "A"), (4, "GATTCTTT"), (5, None)], "id long, seq string"), 2).collect())
    assert got == {1: "ACG" * 1_000_000, 3: "A", 4: "GA"}
    assert time.time() - t < 30


def test_longest_increasing_of_many_small_groups(spark):
    rows = spark.range(240_000).select(F.floor(F.col("id") / 3).alias("g"), F.col("id").alias("i"), (F.col("id") * 7 % 3).alias("v"))
    t = time.time()
    got = sequential.longest_increasing(rows, ["g"], "i", "v").groupBy("n", "longest").count().collect()
    assert [tuple(r) for r in got] == [(3, 3, 80_000)]
    assert sequential.longest_increasing(rows.where("i <> 4"), ["g"], "i", "v", least=3).count() == 79_999
    assert time.time() - t < 30


def test_overlaps_of_repetitive_reads(spark):
    letters = "ACGGT" * 1200
    reads = spark.range(60).select("id", F.lit(letters).alias("seq"))
    pairs = spark.range(60).select(F.col("id").alias("a"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(59).cast("long"))).alias("b")).where("a < b").withColumn("diagonal", F.lit(5).cast("int"))
    t = time.time()
    got = overlap.refined(pairs, reads, 11, 4).groupBy("n").count().collect()
    assert [tuple(r) for r in got] == [(5985, 1770)]
    none = reads.limit(0).select(F.col("seq").alias("kmer"))
    assert overlap.sharing_rare_kmers(pairs, reads, 24, none).count() == 1770
    assert overlap.sharing_rare_kmers(pairs, reads, 24, spark.createDataFrame([((letters * 2)[i : i + 24],) for i in range(5)], "kmer string")).count() == 0
    assert time.time() - t < 60


def test_overlaps_as_by_hand(spark):
    rng = random.Random(8)
    reads = {k: "".join(rng.choice("ACGTN" if k == 0 else "ACGT") for _ in range(rng.randrange(3, 40))) for k in range(14)}
    reads |= {k + 14: x[3:] + "GA" for k, x in reads.items()}
    pairs = [(a, b, rng.randrange(-4, 6)) for a in reads for b in reads if a < b]
    k, drift, bad = 4, 2, {"ACGT", *(x[:4] for x in reads.values())}
    count, share = {}, set()
    for a, b, d in pairs:
        x, y = reads[a], reads[b]
        clean = lambda s: {i: s[i : i + k] for i in range(len(s) - k + 1) if "N" not in s[i : i + k]}
        if n := sum(p == q and abs(i - j - d) <= drift for i, p in clean(x).items() for j, q in clean(y).items()):
            count[a, b, d] = n
        lo, hi = max(d, 0), min(len(x), len(y) + d)
        if hi > lo and (set(clean(x[lo:hi]).values()) & set(clean(y[lo - d : hi - d]).values())) - bad:
            share.add((a, b, d))
    df, of = spark.createDataFrame(pairs, "a long, b long, diagonal int"), spark.createDataFrame(list(reads.items()), "id long, seq string")
    assert {(r.a, r.b, r.diagonal): r.n for r in overlap.refined(df, of, k, drift).collect()} == count
    got = overlap.sharing_rare_kmers(df, of, k, spark.createDataFrame([(x,) for x in bad], "kmer string"))
    assert {tuple(r) for r in got.collect()} == share


def test_blocks_of_chains_are_as_one_by_one(spark):
    rng = np.random.default_rng(4)
    sizes = rng.integers(1, 40, 300)
    own = [set(x.tolist()) for x in chaining.side_by_side(sizes)]
    assert sorted(k for x in own for k in x) == list(range(300))
    for n in (1, 7, 30):
        a = np.sort(rng.integers(0, 60, (20, n)), 1)
        b = rng.integers(0, 60, (20, n))
        score, before = chaining.scored(a, b, 5, 30)
        for row, (first, last, count, value) in enumerate(zip(*chaining.best_of(score, before), strict=True)):
            assert (first, last, count, value) == next(chaining.taken(score[row], before[row]))


def test_bands_wider_than_a_pair(spark):
    rng = random.Random(2)
    pairs = [tuple("".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 30))).encode() for _ in "ab") for _ in range(60)]
    for zdrop in (None, 20):
        assert banded.align(pairs, 200, zdrop=zdrop) == banded.align(pairs, 31, zdrop=zdrop)
    t = time.time()
    banded.align(pairs * 300, 2000)
    assert time.time() - t < 30


def test_latest_of_equal_versions_is_always_the_same(spark):
    rows = [(k, 5, (k * 7 + j) % 11) for k in range(20) for j in range(11)]
    for order in (rows, rows[::-1]):
        got = stores.latest(spark.createDataFrame(order, "tig long, version long, value long"), ["tig"], "version").collect()
        assert sorted(tuple(r) for r in got) == [(k, 5, 0) for k in range(20)]


def test_settled_nodes_leave_the_doubling_of_paths(spark, monkeypatch):
    from helixframe.operators import graph

    long_ = [(k, k + 1) for k in range(600)]
    short = [(10_000 + 3 * k + i, 10_000 + 3 * k + i + 1) for k in range(3000) for i in range(2)]
    ring = [(50_000 + k, 50_000 + (k + 1) % 37) for k in range(37)]
    sizes, kept = [], graph.kept

    def counted(df):
        out = kept(df)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(graph, "kept", counted)
    got = graph.unbranching_paths(spark.createDataFrame([*long_, *short, *ring], "a long, b long"))
    want = {k: (0, k) for k in range(601)} | {10_000 + 3 * k + i: (10_000 + 3 * k, i) for k in range(3000) for i in range(3)} | {50_000 + k: (50_000, k) for k in range(37)}
    assert {r.node: (r.path, r.place) for r in got.collect()} == want
    assert sum(sizes) < 5 * len(want)  # twelve rounds of all nodes before


def test_primary_alignments_in_few_places(spark):
    rng = random.Random(4)
    rows = [(k, k % 3, lo, lo + rng.choice([0, 5, 9]), float(rng.randrange(4))) for k in range(900) if (lo := rng.randrange(20)) >= 0]
    got = sequential.primary_alignments(spark.createDataFrame(rows, "aln long, qry long, lo long, hi long, idy double"), "qry", "lo", "hi", "idy", "aln")
    want, mine = {}, {}
    for aln, qry, lo, hi, _ in sorted(rows, key=lambda r: (-r[4], r[0])):
        want[aln] = not any(min(h, hi) - max(l_, lo) >= 0.5 * min(h - l_, hi - lo) for l_, h in mine.get(qry, []))
        if want[aln]:
            mine.setdefault(qry, []).append((lo, hi))
    assert {r.aln: r.primary for r in got.collect()} == want
    # the program gets the first of each place alone
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan[plan.index("FlatMapGroupsInPandas") :]


def test_longest_paths_send_no_table_through_the_driver(spark, monkeypatch):
    from helixframe.operators import graph

    plans, kept = [], graph.kept

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df)

    monkeypatch.setattr(graph, "kept", seen)
    nodes = spark.range(400).select(F.col("id").alias("node"), F.lit(1).alias("weight"))
    edges = spark.range(400).where("id % 8 < 7").select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = graph.longest_paths(nodes, edges)
    assert {r.node: (r.weight, r.first) for r in got.collect()} == {k: (k % 8 + 1, k - k % 8) for k in range(400)}
    assert not any("Broadcast" in p for p in plans)


def test_matches_that_stand_alone_are_left_out_before_runs_are_counted(spark):
    import __spark_entry__ as entry

    got = entry.queries()["collinear_matches_merged"](spark, "/root/testdata/sf0.001")
    assert got.where("n < 2").isEmpty()
    assert "lead(goes_on" in got._jdf.queryExecution().analyzed().toString()


def test_end_overlaps_as_by_hand(spark, monkeypatch):
    for name, most in (("FIRST", 5), ("SECOND", 7), ("LIST", 3)):
        monkeypatch.setattr(overlap, name, most)
    rng = random.Random(21)
    # two letters: many share an end, and some ends are their own complements; others are too short
    reads = {k * 7 - 40: "".join(rng.choices("AT" if k % 3 else "ACGT", k=rng.randrange(2, 9))) for k in range(90)}
    turned = {(k, o): s if o == "F" else s[::-1].translate(str.maketrans("ACGT", "TGCA")) for k, s in reads.items() if len(s) >= 3 for o in "FR"}
    want = sorted((*x, *y) for x, s in turned.items() for y, t in turned.items() if x[0] != y[0] and s[-3:] == t[:3])
    df = spark.createDataFrame([*reads.items(), (9999, None)], "id long, seq string")
    got = overlap.end_overlaps(df, 4)
    assert got.columns == ["a", "a_ori", "b", "b_ori"] and sorted(map(tuple, got.collect())) == want and len(want) > 1000
    assert overlap.end_overlaps(df.limit(0), 4).count() == 0


def test_end_overlaps_of_one_end(spark, tmp_path):
    """All reads begin and end alike: their pairs are dealt out, and take few bytes where they are written."""
    n = 2000
    df = spark.range(n).select((F.xxhash64("id") % 10**9).alias("id"), F.lit("AACCGTTTTAACCGT").alias("seq"))
    assert df.distinct().count() == n
    path = str(tmp_path / "pairs")
    overlap.end_overlaps(df, 7).write.parquet(path)
    rows = spark.read.parquet(path)
    assert rows.count() == 2 * n * (n - 1)
    each = rows.groupBy("a", "a_ori").agg(F.countDistinct("b").alias("n"), F.min(F.col("a_ori") == F.col("b_ori")).alias("same")).where("same").groupBy("n").count()
    assert [tuple(r) for r in each.collect()] == [(n - 1, 2 * n)]
    assert sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet")) < rows.count() / 5
