"""k-mers as numbers: against windows cut by hand, in pieces of any size."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helixframe.operators import kmer

OTHER = str.maketrans("ACGT", "TGCA")


def texts(rng, n=40):
    return [(i, None if i == 7 else "".join(rng.choices("ACGTN\n", [9, 9, 9, 9, 1, 1], k=rng.choice([0, 1, 4, 30, 200])))) for i in range(n)]


def by_hand(rows, k):
    for i, s in rows:
        for p in range(len(s or "") - k + 1):
            w = s[p : p + k]
            if set(w) <= set("ACGT"):
                yield i, p, w


@pytest.mark.parametrize("k", [1, 2, 5, 12, 17, 23, 31])
def test_codes_as_by_hand(spark, k):
    rows = texts(random.Random(k))
    df = spark.createDataFrame(rows, "id long, seq string")
    want = sorted(by_hand(rows, k))
    got = kmer.codes(df, k, both_strands=False, keep=("id",), positions=True).withColumn("kmer", kmer.letters_of(F.col("code"), k))
    assert sorted((r.id, r.pos, r.kmer) for r in got.collect()) == want
    least = lambda w: min(w, w[::-1].translate(OTHER))
    assert {r.kmer: r.cnt for r in kmer.count(df, k).collect()} == Counter(least(w) for _, _, w in want)
    signed = kmer.codes(df, k, keep=("id",), positions=True, strands=True).withColumn("kmer", kmer.letters_of(F.col("code"), k))
    assert sorted((r.id, r.pos, r.kmer, r.back) for r in signed.collect()) == [(i, p, least(w), w != least(w)) for i, p, w in want if w != w[::-1].translate(OTHER)]


def test_long_texts_are_cut(monkeypatch):
    monkeypatch.setattr(kmer, "LETTERS", 7)
    rows = texts(random.Random(1))
    got = []
    for letters, row, pos in kmer._pieces([s for _, s in rows], 4):
        assert len(letters) < 100  # a text of 200 letters is not held as one
        own, _, good = kmer._codes(letters, 4)
        got += [(int(row[i]), int(pos[i]), "".join("ACGT"[own[i] >> 2 * j & 3] for j in (3, 2, 1, 0))) for i in range(len(own)) if good[i]]
    assert sorted(got) == sorted(by_hand(rows, 4))


def test_many_texts_of_one_kmer(spark):
    df = spark.range(20_000).select(F.repeat(F.lit("A"), 80).alias("seq"))
    assert [tuple(r) for r in kmer.count_codes(df, 31).collect()] == [(0, 20_000 * 50)]


def test_acid_words_as_by_hand(spark):
    from helixframe.functions.sequence import AMINO_ACIDS

    rows = [(i, s and s.replace("\n", "")) for i, s in texts(random.Random(3))]
    acid = lambda c: AMINO_ACIDS["TCAG".index(c[0]) * 16 + "TCAG".index(c[1]) * 4 + "TCAG".index(c[2])]
    want = {(i, "".join(acid(w[j : j + 3]) for j in range(0, 6, 3))) for i, _, w in by_hand(rows, 6)}
    spelt = lambda w: chr((w >> 6) + 42) + chr((w & 63) + 42)
    got = [(r.id, spelt(r.word)) for r in kmer.acid_words(spark.createDataFrame(rows, "id long, seq string"), 2).collect()]
    assert sorted(got) == sorted(want)  # each once


def test_seeds_meet_once(spark):
    """No join: the places of a k-mer are one list, of most places at most, and a k-mer of thousands makes no row."""
    from helixframe.operators import overlap

    rng = random.Random(9)
    base = ["".join(rng.choices("ACGT", k=60)) for _ in range(4)]
    rows = [(i, "A" * 30 + base[i % 4][i % 7 :]) for i in range(24)]
    got = overlap.seed_overlaps(spark.createDataFrame(rows, "id long, seq string"), 14, 8, 2)
    want = {}
    places = {}
    for i, p, w in by_hand(rows, 14):
        places.setdefault(w, []).append((i, p))
    for at in places.values():
        if 2 <= len(at) <= 8:
            for a, x in at:
                for b, y in at:
                    if a < b:
                        d = want.setdefault((a, b), Counter())
                        d[x - y] += 1
    best = {ab: max(d.items(), key=lambda t: (t[1], -t[0])) for ab, d in want.items()}
    assert {(r.a, r.b): (r.diagonal, r.seeds) for r in got.collect()} == {ab: t for ab, t in best.items() if t[1] >= 2}
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_mismatches_of_long_strings(spark):
    import time

    from helixframe.operators import variants

    rng = random.Random(2)
    rows = [(k, "".join(rng.choices("ACGTé", k=n)), "".join(rng.choices("ACGTé", k=n + 5))) for k, n in enumerate([0, 1, 50, 150_000])] + [(9, None, "A"), (10, "GG", "GG")]
    t = time.time()
    got = {r.id: (r.nm, r.md) for r in variants.mismatches(spark.createDataFrame(rows, "id long, a string, b string")).collect()}
    assert time.time() - t < 40  # the list of runs was copied at each mismatch before
    for k, a, b in rows:
        md, run = [], 0
        for x, y in zip(a or "", b or "", strict=False):
            md, run = (md, run + 1) if x == y else ([*md, f"{run}{x}"] if len(md) < 200 else (md.append(f"{run}{x}"), md)[1], 0)
        assert got[k] == (len(md), "".join(md) + str(run))


@pytest.mark.parametrize("name", ["kmer_profile", "kmer_select_frequent", "mapped_by_chains", "protein_matches", "polished"])
def test_few_counts_are_sent_and_letters_are_numbers(spark, name):
    """The larger side of each join stays where it is, and the letters' strings are not shuffled window by window."""
    import __spark_entry__ as entry

    plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan
    assert name == "polished" or "strategy=broadcast" in plan


def test_edit_distance_as_by_hand():
    import time

    from helixframe.operators.variants import edit_distance

    rng = random.Random(8)
    for _ in range(300):
        a, b = ("".join(rng.choices("ACGé", k=rng.randrange(20))) for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, above = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(above[j] + 1, row[j - 1] + 1, above[j - 1] + (x != y)))
        assert edit_distance(a, b) == row[-1], (a, b)
    t = time.time()
    edit_distance("".join(rng.choices("ACGT", k=20_000)), "".join(rng.choices("ACGT", k=20_000)))
    assert time.time() - t < 5  # 400 million cells
