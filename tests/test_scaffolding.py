import random

from pyspark.sql import functions as F

from helixframe.operators import scaffolding
from helixframe.plans import pipelines


def test_planted_scaffolds(spark):
    """Contigs cut from known scaffolds, with links to the next two, weak wrong links, and a repeat in between, come back in order, on their strands and in their places."""
    rng = random.Random(7)
    contigs, links, truth, n = [], [], {}, 1
    for scaffold in range(5):
        at, own = 0, []
        for _ in range(rng.randrange(3, 9)):
            size, turned = rng.randrange(200, 900), rng.random() < 0.5
            contigs.append((n, size))
            own.append((-n if turned else n, at, size))
            at += size + rng.randrange(5, 80)
            n += 1
        for k, (x, b, s) in enumerate(own):
            for y, c, _ in own[k + 1 : k + 3]:
                gap, weight = c - b - s, rng.randrange(5, 12)
                links.append((x, y, gap + rng.choice([-2, 0, 2]), weight) if rng.random() < 0.5 else (-y, -x, gap, weight))
        truth[scaffold] = own
    links += [(1, n - 1, 40, 1), (3, -8, 10, 2), (5, 5, 3, 9), (7, 10**6, 1, 50)]
    contigs.append((n, 100))
    got = scaffolding.ordered(spark.createDataFrame(contigs, "ctg int, size int"), spark.createDataFrame(links, "a int, b int, gap int, weight int")).collect()
    assert sorted(r.ctg for r in got) == [c for c, _ in contigs]
    by = {}
    for r in sorted(got, key=lambda r: (r.scaffold, r.place)):
        by.setdefault(r.scaffold, []).append(r)
    assert len(by) == 6 and [(r.place, r.ori, r.bgn, r.end) for r in by[n]] == [(0, "f", 0, 100)]
    for own in truth.values():
        smallest = min(own, key=lambda x: abs(x[0]))
        rows = by[abs(smallest[0])]
        signed = [r.ctg if r.ori == "f" else -r.ctg for r in rows]
        want = [x for x, _, _ in own] if smallest[0] > 0 else [-x for x, _, _ in own][::-1]
        assert signed == want and [r.place for r in rows] == list(range(len(own)))
        end = own[-1][1] + own[-1][2]
        for r, (_, b, s) in zip(rows, own if smallest[0] > 0 else own[::-1], strict=True):
            assert abs(r.bgn - (b if smallest[0] > 0 else end - b - s)) <= 2 * len(own) and r.end - r.bgn == s


def test_ring_and_nothing(spark):
    contigs = spark.createDataFrame([(k, 10) for k in range(1, 5)], "ctg int, size int")
    ring = spark.createDataFrame([(1, 2, 1, 5), (2, 3, 1, 5), (3, 4, 1, 5), (4, 1, 1, 5)], "a int, b int, gap int, weight int")
    got = sorted((r.place, r.ctg, r.ori, r.bgn) for r in scaffolding.ordered(contigs, ring).collect())
    assert got == [(0, 1, "f", 0), (1, 2, "f", 11), (2, 3, "f", 22), (3, 4, "f", 33)]
    assert scaffolding.ordered(contigs, ring.limit(0)).where("place = 0 and scaffold = ctg").count() == 4
    assert scaffolding.ordered(contigs.limit(0), ring).count() == 0


def test_growing_k(spark):
    """Thin coverage, which breaks unitigs of the larger k, is bridged by those of the smaller one; a repeat between the two lengths, which breaks the smaller, is told apart by the larger."""
    rng = random.Random(4)
    say = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    repeat = say(14)
    genome = say(150) + repeat + say(150) + repeat + say(150)
    reads = [genome[i : i + 45] for i in range(0, len(genome) - 44, 3) if not 15 < i < 120] + [genome[i : i + 25] for i in range(0, 165)]
    df = spark.createDataFrame([(k, r) for k, r in enumerate(reads)], "id int, seq string")
    longest = lambda rows: rows.agg(F.max(F.length("seq"))).first()[0]
    grown = pipelines.multi_k_unitigs(df, [11, 21, 31], 2)
    assert grown.select("k").distinct().first()[0] in (21, 31)
    assert longest(grown) > max(longest(pipelines.unitigs(df, k, 2)) for k in (11, 31))
    assert all(r.seq in genome for r in grown.collect())
    assert pipelines.multi_k_unitigs(df.limit(0), [11, 21]).count() == 0


def test_links_within_a_scaffold_are_left_behind(spark, monkeypatch):
    sizes, kept = [], scaffolding.kept

    def counted(df):
        out = kept(df)
        sizes.extend([out.count()] if "a_was" in out.columns else [])
        return out

    monkeypatch.setattr(scaffolding, "kept", counted)
    contigs = spark.createDataFrame([(k, 100) for k in range(1, 9)], "ctg long, size long")
    links = spark.createDataFrame([(k, k + 1, 10, 5) for k in range(1, 8)], "a long, b long, gap long, weight long")
    got = scaffolding.ordered(contigs, links).collect()
    assert sorted((r.ctg, r.scaffold, r.place, r.bgn) for r in got) == [(k, 1, k - 1, 110.0 * (k - 1)) for k in range(1, 9)]
    assert sizes == [7, 0]  # none is lifted again once it lies within


def test_no_table_of_a_round_goes_through_the_driver(spark, monkeypatch):
    """Joins are by shuffle, however few bytes a round's tables take in files."""
    from helixframe.operators import graph

    plans = []
    own = graph.kept

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return own(df)

    monkeypatch.setattr(graph, "kept", seen)
    monkeypatch.setattr(scaffolding, "kept", seen)
    contigs = spark.range(1, 9).select(F.col("id").alias("ctg"), F.lit(100).alias("size"))
    links = spark.range(1, 8).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"), F.lit(10.0).alias("gap"), F.lit(5).alias("weight"))
    got = scaffolding.ordered(contigs, links)
    assert [(r.ctg, r.place) for r in got.orderBy("ctg").collect()] == [(k + 1, k) for k in range(8)]
    assert len(plans) > 8 and not [p for p in plans if "Broadcast" in p]
