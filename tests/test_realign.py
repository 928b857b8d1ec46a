import math
import random

import numpy as np
import pytest

from helixframe.operators import realign

RNG = random.Random(4)


def letters(n):
    return "".join(RNG.choice("ACGT") for _ in range(n))


def brute(ref, read, qual, band):
    """(place, inserted, quality) of each letter by dictionaries of states and scaled sums, one cell after another."""
    n, size = len(read), len(ref)
    stop = 1 / (2 * n + 2)
    d, e = 0.001, 0.1
    go = {("M", "M"): (1 - 2 * d) * (1 - stop), ("M", "I"): d * (1 - stop), ("M", "D"): d * (1 - stop), ("I", "M"): (1 - e) * (1 - stop), ("I", "I"): e * (1 - stop), ("D", "M"): 1 - e, ("D", "D"): e}

    def emit(i, k):
        p = 10 ** (-qual[i - 1] / 10)
        return 1.0 if read[i - 1] not in "ACGT" or ref[k - 1] not in "ACGT" else 1 - p if read[i - 1] == ref[k - 1] else p * 0.33333333333

    span = lambda i: range(max(1, i - band), min(size, i + band) + 1)
    f = {}
    for k in span(1):
        f[1, k, "M"], f[1, k, "I"] = emit(1, k) * (1 - d) / size, 0.25 * d / size
    for i in range(2, n + 1):
        for k in span(i):
            f[i, k, "M"] = emit(i, k) * sum(go[s, "M"] * f.get((i - 1, k - 1, s), 0) for s in "MID")
            f[i, k, "I"] = 0.25 * sum(go[s, "I"] * f.get((i - 1, k, s), 0) for s in "MI")
            f[i, k, "D"] = sum(go[s, "D"] * f.get((i, k - 1, s), 0) for s in "MD")
    b = {}
    for k in span(n):
        b[n, k, "M"] = b[n, k, "I"] = stop
    for i in range(n - 1, 0, -1):
        for k in reversed(span(i)):
            match = emit(i + 1, k + 1) * b.get((i + 1, k + 1, "M"), 0) if k < size else 0
            insert = 0.25 * b.get((i + 1, k, "I"), 0)
            delete = b.get((i, k + 1, "D"), 0)
            b[i, k, "M"] = match * go["M", "M"] + insert * go["M", "I"] + go["M", "D"] * delete
            b[i, k, "I"] = match * go["I", "M"] + insert * go["I", "I"]
            b[i, k, "D"] = (match * go["D", "M"] + go["D", "D"] * delete) if i > 1 else 0
    out = []
    for i in range(1, n + 1):
        z = {(k, s): f.get((i, k, s), 0) * b.get((i, k, s), 0) for k in span(i) for s in "MI"}
        (k, s), top = max(z.items(), key=lambda x: x[1])
        out.append((k - 1, s == "I", min(99, int(-4.343 * math.log(max(1e-30, 1 - top / sum(z.values()))) + 0.499))))
    return out


@pytest.mark.parametrize("n, band", [(1, 7), (5, 7), (40, 7), (90, 12)])
def test_posterior_against_brute_force(n, band):
    refs, reads, quals = [], [], []
    for k in range(12):
        ref = letters(n + k % 5)
        read = list(ref[: n])
        for _ in range(k % 4):
            read[RNG.randrange(len(read))] = RNG.choice("ACGTN")
        if k % 3 == 0 and n > 10:
            del read[n // 2 : n // 2 + 2]
        if k % 3 == 1 and n > 10:
            read[n // 3 : n // 3] = list("GG")
        refs.append(ref)
        reads.append("".join(read))
        quals.append([RNG.randrange(5, 40) for _ in read])
    code = lambda s: realign.CODES[np.frombuffer(s.encode(), np.uint8)]
    found = realign.posterior([code(r) for r in refs], [code(r) for r in reads], quals, band)
    for ref, read, qual, (place, inserted, sure) in zip(refs, reads, quals, found, strict=True):
        want = brute(ref, read, qual, band)
        assert [(p, i) for p, i, _ in want] == list(zip(place.tolist(), inserted.tolist(), strict=True))
        assert max(abs(a - b) for a, (_, _, b) in zip(sure.tolist(), want, strict=True)) <= 1


def test_misaligned_end_is_capped():
    """A read whose last letters were matched past a deletion: their qualities fall, the others stay."""
    ref = letters(60)
    read = ref[10:40] + ref[43:47]
    qual = np.full(len(read), 30)
    out = realign.realigned([(read, qual, ref, 10, f"{len(read)}M"), (ref[5:45], np.full(40, 30), ref, 5, "40M"), (read, qual, ref, 10, "30M3D4M")])
    assert out[0][:25].min() >= 25 and out[0][-3:].max() < 15
    assert out[1][5:35].min() == 30
    assert out[2][:25].min() >= 25


def test_table(spark):
    ref = letters(80)
    rows = [(1, ref[10:50], [30] * 40, ref, 10, "40M"), (2, None, None, ref, 0, None), (3, ref[:20], [20] * 20, ref, 5, "5S15M"), (4, ref[:20], [20] * 20, ref, 0, "10M5N10M"), (5, letters(20), [40] * 20, ref, 70, "20M"), (6, "", [], ref, 3, "*")]
    df = spark.createDataFrame(rows, "k int, read string, qual array<int>, ref string, pos int, cigar string")
    got = {r.k: r for r in realign.base_alignment_qualities(df, drop=("ref",)).collect()}
    assert "ref" not in got[1] and len(got[1].baq) == 40 and got[1].cap == 40
    assert got[2].baq == [] and got[6].baq == [] and got[4].baq == [20] * 20
    assert got[3].baq[:5] == [20] * 5 and got[3].cap == 28
    assert len(got[5].baq) == 20 and max(got[5].baq) <= 40


def test_mapping_quality_cap():
    ref = "ACGT" * 10
    q = np.full(20, 30)
    assert realign.mapping_quality_cap(ref[:20], q, ref, 0, "20M") == 40
    one = "C" + ref[1:20]
    t = 30 - 4.343 * math.log(20)
    assert realign.mapping_quality_cap(one, q, ref, 0, "20M") == int(math.sqrt((40 - t) / 40) * 40 + 0.499)
    assert realign.mapping_quality_cap("C" * 20, q, ref, 0, "20M") == -1


def test_rows_of_the_band_are_slices(monkeypatch):
    """Nothing is gathered letter by letter, and unknown letters and places beyond the reference are as before."""
    monkeypatch.setattr(realign.np, "take_along_axis", None)
    read, ref = "ACGTTGCANACGTACGT", "ACGTTGCAGACNTACGT"
    got = realign.realigned([(read, np.full(17, 30), ref, 0, "17M"), (read[:9], np.full(9, 30), ref[:6], 0, "6M3S")])
    assert [len(x) for x in got] == [17, 9] and got[0].max() <= 30 and got[0][:7].min() > 0
