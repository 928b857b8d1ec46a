import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.operators import banded, chaining

RNG = random.Random(8)


def letters(n, rng=RNG):
    return "".join(rng.choice("ACGT") for _ in range(n))


def mutated(s, share, rng=RNG):
    out = []
    for c in s:
        x = rng.random()
        if x < share:
            out.append(rng.choice("ACGT"))
        elif x < 1.5 * share:
            continue
        elif x < 2 * share:
            out += [c, rng.choice("ACGT")]
        else:
            out.append(c)
    return "".join(out)


def brute_score(a, b, s=banded.Scores()):
    """Three tables, cell by cell."""
    n, m = len(a), len(b)
    t = np.full((3, n + 1, m + 1), -(10**9))
    t[0, 0, 0] = 0
    for i in range(n + 1):
        for j in range(m + 1):
            if i and j:
                t[0, i, j] = t[:, i - 1, j - 1].max() + (s.match if a[i - 1] == b[j - 1] else s.mismatch)
            if i:
                t[1, i, j] = max(t[:, i - 1, j].max() + s.gap_open + s.gap_extend, t[1, i - 1, j] + s.gap_extend)
            if j:
                t[2, i, j] = max(t[:, i, j - 1].max() + s.gap_open + s.gap_extend, t[2, i, j - 1] + s.gap_extend)
    return t.max(0)


def score_of(a, b, cigar, s=banded.Scores()):
    i = j = total = 0
    for n, op in __import__("re").findall(r"(\d+)([MID])", cigar):
        n = int(n)
        if op == "M":
            total += sum(s.match if x == y else s.mismatch for x, y in zip(a[i : i + n], b[j : j + n], strict=True))
        else:
            total += s.gap_open + n * s.gap_extend
        i, j = i + n * (op != "D"), j + n * (op != "I")
    return total, i, j


def pairs():
    out = [("", ""), ("A", ""), ("", "AC"), ("A", "C"), ("ACGT", "ACGT"), ("A" * 30, "A" * 3)]
    for n in (3, 17, 60):
        for share in (0.02, 0.2, 0.6):
            a = letters(n)
            out += [(a, mutated(a, share)), (a, letters(n)), (a, a[n // 3 :] + letters(4))]
    return out


def test_global_alignments():
    every = pairs()
    for band in (None, 70):
        found = banded.align([(a.encode(), b.encode()) for a, b in every], band)
        for (a, b), f in zip(every, found, strict=True):
            assert f.score == brute_score(a, b)[-1, -1], (a, b)
            assert score_of(a, b, f.cigar) == (f.score, len(a), len(b))


def test_other_scores():
    s = banded.Scores(1, -1, 0, -1)
    for a, b in pairs():
        assert banded.align([(a.encode(), b.encode())], scores=s)[0].score == brute_score(a, b, s)[-1, -1]


def test_long_pair_in_a_band():
    a = letters(10_000)
    b = mutated(a, 0.03)
    found = banded.align([(a.encode(), b.encode())], 150)[0]
    total, i, j = score_of(a, b, found.cigar)
    assert (total, i, j) == (found.score, len(a), len(b)) and found.score > 15_000


def test_open_ends():
    for seed in range(8):
        rng = random.Random(seed)
        head = letters(80, rng)
        a, b = head + letters(200, rng), mutated(head, 0.02, rng) + letters(200, rng)
        found = banded.align([(a.encode(), b.encode())], zdrop=10**6)[0]
        table = brute_score(a, b)
        assert found.score == table.max() and table[found.a_end, found.b_end] == found.score
        assert score_of(a, b, found.cigar) == (found.score, found.a_end, found.b_end)
        cut = banded.align([(a.encode(), b.encode())], 40, zdrop=30)[0]
        assert 60 <= cut.a_end <= 110 and cut.score > 80


def test_aligned_table(spark):
    every = pairs()
    rows = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(every)] + [(99, None, "ACG")], "k long, a string, b string")
    got = {r.k: r for r in banded.cigar_columns(banded.aligned(rows)).collect()}
    assert got[99].score == -10 and got[99].cigar == "3D" and got[99].in_gaps == 3
    assert got[4].columns == 4 and got[4].in_gaps == 0 and all(got[k].score == brute_score(a, b)[-1, -1] for k, (a, b) in enumerate(every))


def brute_chains(points, k, jump, least):
    points = sorted(points)
    score, before = [], []
    for i, (x, y) in enumerate(points):
        best, at = k, -1
        for j in range(i - 1, -1, -1):
            da, db = x - points[j][0], y - points[j][1]
            if 0 < da < jump and 0 < db < jump:
                drift = abs(da - db)
                value = score[j] + min(da, db, k) - int(drift * (2 if drift > 100 else 0.5))
                if value > best:
                    best, at = value, j
        score.append(best)
        before.append(at)
    used, out = set(), []
    for last in sorted(range(len(points)), key=lambda i: (-score[i], i)):
        if last in used:
            continue
        at, own = last, []
        while at >= 0 and at not in used:
            used.add(at)
            own.append(at)
            at = before[at]
        if len(own) >= least:
            out.append((len(own), score[last] - (score[at] if at >= 0 else 0), points[own[-1]][0], points[last][0] + k, points[own[-1]][1], points[last][1] + k))
    return out


def test_chains(spark):
    rng = random.Random(2)
    rows = []
    for pair in range(40):
        n = rng.choice([1, 4, 8, 30, 150])
        at = [0, 0]
        for _ in range(n):
            step = rng.choice([1, 3, 40, 400, 2500])
            at = [at[0] + step, at[1] + max(0, step + rng.choice([0, 0, 0, 2, -2, 150]))]
            rows.append((pair % 7, pair, False, *at))
            if rng.random() < 0.2:
                rows.append((pair % 7, pair, False, at[0], rng.randrange(5000)))
    rows = sorted(set(rows))
    got = sorted((r.a, r.b, r.n, r.score, r.a_lo, r.a_hi, r.b_lo, r.b_hi) for r in chaining.chains(spark.createDataFrame(rows, "a long, b long, back boolean, a_pos int, b_pos int").repartition(5), 9, 500, 3).collect())
    want = []
    for a, b in {r[:2] for r in rows}:
        want += [(a, b, *c) for c in brute_chains([r[3:] for r in rows if r[:2] == (a, b)], 9, 500, 3)]
    assert got == sorted(want) and len(got) > 40


@pytest.mark.parametrize("split", [2, 100_000])
def test_overlap_with_gaps(spark, split):
    """An overlap on the other strand, with letters left out and put in, and with a seed that is everywhere, is one chain."""
    from helixframe.functions.sequence import canonical, reverse_complement
    from helixframe.operators import kmer

    x = letters(400) + "ACACACACACACACACAC" + letters(300)
    y = x[:150] + x[160:500] + "GATTACA" + x[500:]
    other = y[::-1].translate(str.maketrans("ACGT", "TGCA"))
    reads = spark.createDataFrame([(1, x), (2, other + letters(50)), (3, letters(500) + "ACACACACACACAC")], "id long, seq string")
    rows = kmer.enumerate_kmers(reads, 9, both_strands=False, keep=("id",), positions=True, clean=True)
    seeds = rows.select("id", "pos", canonical(F.col("kmer")).alias("minimizer"), (F.col("kmer") > reverse_complement(F.col("kmer"))).alias("back"))
    found = chaining.chains(chaining.anchors(seeds.where("id = 1"), seeds.where("id > 1"), split), 9, 500, 20, only_best=True).collect()
    assert len(found) == 1
    r = found[0]
    assert (r.b, r.back, r.a_lo, r.a_hi, r.b_lo, r.b_hi) == (2, True, 0, len(x), 0, len(y))


@pytest.mark.parametrize("sent, few", [(chaining.SENT, False), (0, False), (chaining.SENT, True)])
def test_chains_where_sequences_are(spark, monkeypatch, sent, few):
    """The best chains of pairs, with what is cut out of them, are those of shuffled anchors, however little is worked through at once."""
    from helixframe.operators import kmer

    monkeypatch.setattr(chaining, "SENT", sent)
    at_once = chaining.AtOnce(200, 50, 40, 30) if few else chaining.AtOnce()
    rng = random.Random(4)
    items = [(k, "AC" * 20 if k == 3 else letters(rng.choice([6, 40, 90]), rng)) for k in range(12)] + [(5, letters(60, rng))]
    turned = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    reads = []
    for k in range(60):
        parts = [(turned if rng.random() < 0.5 else str)(mutated(rng.choice(items)[1], 0.03, rng)) for _ in range(3)]
        reads.append((k % 50, ("N" if k % 7 else "").join([letters(300, rng), *parts, "AC" * 30])))
    left, right = (spark.createDataFrame(x, "id long, seq string") for x in ([*reads, (90, None), (91, "")], items))
    seeds = lambda rows: kmer.codes(rows, 7, both_strands=False, keep=("id",), positions=True, strands=True).withColumnRenamed("code", "minimizer")
    names = ["a", "b", "back", "n", "score", "a_lo", "a_hi", "b_lo", "b_hi"]
    rows = lambda df: sorted(tuple(r) for r in df.select(names).distinct().collect())
    want = chaining.chains(chaining.anchors(seeds(left), seeds(right)), 7, 100, 4, only_best=True)
    got = chaining.best_between(left, right, 7, 100, 4, lambda a, b, back, a_lo, a_hi, b_lo, b_hi: (a[a_lo:a_hi], b[b_lo:b_hi]), at_once)
    assert rows(got) == rows(want) == rows(chaining.best_between(left, right, 7, 100, 4)) and want.count() > 60
    texts = lambda rows: {k: {s for i, s in rows if i == k and s and len(s) >= 7} for k, _ in rows}
    a_of, b_of = texts(reads), texts(items)
    # an id that comes twice gives what is cut out of each of its sequences
    assert {(r.a, r.b, r.back, r.x, r.y) for r in got.collect()} == {(r.a, r.b, r.back, s[r.a_lo : r.a_hi], t[r.b_lo : r.b_hi]) for r in want.collect() for s in a_of[r.a] for t in b_of[r.b]}


def test_short_alignments_are_those_in_a_moving_band(monkeypatch):
    rng = random.Random(6)
    pairs = []
    for _ in range(300):
        a = letters(rng.choice([0, 1, 5, 40, 90]), rng)
        pairs.append((a.encode(), rng.choice([letters(rng.randrange(80), rng), mutated(a, 0.2, rng), mutated(a, 0.1, rng) + letters(30, rng)]).encode()))
    for band, zdrop in ((None, None), (200, None), (40, 20), (None, 30)):
        want = []
        for a, b in pairs:
            need = max(len(a), len(b)) + 1
            want += banded._block([a], [b], need if band is None else min(need, band), banded.Scores(), zdrop)
        assert banded.align(pairs, band, zdrop=zdrop) == want
    sizes = []
    square = banded._square
    monkeypatch.setattr(banded, "_square", lambda a, *rest: sizes.append(len(a)) or square(a, *rest))
    assert len(banded.align(pairs * 50, 200)) == len(pairs) * 50
    assert sum(sizes) == len(set(pairs))


def test_few_bytes_with_much_work_are_dealt_out(spark):
    """Groups of few bytes, which Spark would put into one task, are worked on in as many as there are."""
    groups = spark.range(400).groupBy((F.col("id") % 40).alias("k")).agg(F.collect_list("id").alias("all"))
    tasks = chaining.dealt(groups).select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks == 4
