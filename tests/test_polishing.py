import itertools
import random

import numpy as np

from helixframe.operators import polishing

M = polishing.model()
CODE = {c: k for k, c in enumerate("ACGT")}


def brute_score(a, b, fixed=None):
    """The best score of candidate a and branch b, cell by cell; at place fixed of a nothing is added before its letter."""
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            ways = [0] if not i and not j else []
            if j and not (fixed is not None and i == fixed + 1):
                ways.append(t[i][j - 1] + M.insertion[CODE[b[j - 1]]])
            if i:
                ways.append(t[i - 1][j] + M.deletion[CODE[a[i - 1]]])
                if j:
                    ways.append(t[i - 1][j - 1] + M.substitution[CODE[a[i - 1]], CODE[b[j - 1]]])
            t[i][j] = max(ways) if ways else -(10**15)
    return t[-1][-1]


def brute_step(a, branches):
    """The first best change, every one of them scored by itself; the rest of the branch may be added after a changed letter, which the next one begins with."""
    total = lambda s: sum(brute_score(s, b) for b in branches)
    now = total(a)
    found = (now, a)
    for p in range(len(a)):
        found = max(found, (total(a[:p] + a[p + 1 :]), a[:p] + a[p + 1 :]), key=lambda x: x[0])
    return now, found[1]


def code(s):
    return np.array([CODE[c] for c in s], np.int64)


def noisy(s, rng, share):
    out = []
    for c in s:
        x = rng.random()
        if x < share / 3:
            out.append(rng.choice("ACGT"))
        elif x < 2 * share / 3:
            out += [c, rng.choice("ACGT")]
        elif x > share:
            out.append(c)
    return "".join(out)


def test_scores_against_brute_force():
    rng = random.Random(1)
    for _ in range(20):
        a = "".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 12)))
        branches = ["".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 12))) for _ in range(4)]
        now, new = polishing._Bubble([code(b) for b in branches], M).step(code(a))
        want, shorter = brute_step(a, branches)
        assert now == want
        if shorter != a:
            assert "".join("ACGT"[x] for x in new) == shorter


def test_no_change_is_left():
    """Where the climb ends no single change of a letter makes the branches likelier by more than the change itself is credited with."""
    rng = random.Random(2)
    for _ in range(5):
        truth = "".join(rng.choice("ACGT") for _ in range(14))
        branches = [noisy(truth, rng, 0.15) for _ in range(6)]
        bubble = polishing._Bubble([code(b) for b in branches], M)
        end, _ = bubble.climb(code(noisy(truth, rng, 0.4)))
        now = bubble.step(end)[0]
        text = "".join("ACGT"[x] for x in end)
        every = [text[:p] + text[p + 1 :] for p in range(len(text))]
        assert all(sum(brute_score(s, b) for b in branches) <= now for s in every)
        for p, x in itertools.product(range(len(text)), "ACGT"):
            s = text[:p] + x + text[p + 1 :]
            assert x == text[p] or sum(brute_score(s, b, fixed=p) for b in branches) <= now


def test_planted_errors_are_mended(spark):
    rng = random.Random(3)
    rows, truth = [], {}
    for k in range(12):
        truth[k] = "".join(rng.choice("ACGT") for _ in range(20)) + "A" * (4 + k % 3) + "".join(rng.choice("CGT") for _ in range(25))
        branches = [noisy(truth[k], rng, 0.06) for _ in range(9 + k)]
        rows.append((k, noisy(truth[k], rng, 0.2), branches))
    rows += [(90, None, ["ACGT"] * 3), (91, "ACGT", None), (92, "ACGT", [None, ""]), (93, "AC-GT", ["ACGT"])]
    got = {r.k: r for r in polishing.polished(spark.createDataFrame(rows, "k int, candidate string, branches array<string>").repartition(2)).collect()}
    assert sum(got[k].polished == truth[k] for k in truth) >= 11
    assert got[90].polished == "ACGT" and got[91].polished == "ACGT" and got[92].polished == "" and got[93].polished == "ACGT"


def test_runs():
    rng = random.Random(5)
    truth = "GATC" + "T" * 7 + "GGAC"
    branches = ["GATC" + "T" * (7 + rng.choice([0, 0, 0, 1, -1, -1])) + "GGAC" for _ in range(15)]
    assert polishing.polish("GATC" + "T" * 9 + "GGAC", branches, M)[0] == truth


def test_read_model():
    m = polishing.read_model(["mat\tA\t0.5", "mis\tA->C\t0.25", "del\tG\t0.125", "ins\tT\t0.0625", ""])
    assert (m.substitution[0, 0], m.substitution[0, 1], m.deletion[2], m.insertion[3]) == tuple(round(-np.log(2) * k * (1 << 17)) for k in (1, 2, 3, 4))
