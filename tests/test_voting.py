import random
import re
from collections import Counter

import pytest

from helixframe.operators import banded, voting
from tests.test_mapping import letters, mutated

RNG = random.Random(31)


def brute_columns(rows, run=9, ends=3, sides=9):
    """Column by column, a counter for each letter."""
    out = {}
    for read, pos, part, other, cigar in rows:
        i = j = 0
        cols = []  # (letter, vote or None)
        for n, op in re.findall(r"(\d+)([MID])", cigar or ""):
            for _ in range(int(n)):
                if op == "M":
                    cols.append((i, None if part[i] == other[j] else other[j]))
                elif op == "I":
                    cols.append((i, "gone"))
                else:
                    cols.append((i - 1, "after_" + other[j]))
                i, j = i + (op != "D"), j + (op != "I")
        bad = [k for k, c in enumerate(cols) if c[1]]
        of = lambda p: out.setdefault((read, pos + p), Counter())
        edges = [-1, *bad, len(cols)]
        for lo, hi in zip(edges, edges[1:], strict=False):
            size = hi - lo - 1
            if size < run:
                continue
            for k in range(lo + 1, hi):
                near = (lo >= 0 and k - lo <= ends) or (hi < len(cols) and hi - k <= ends)
                of(cols[k][0])["own" if near else "confirmed"] += 1
                last = hi - 1 if hi == len(cols) else hi - ends - 1
                if not near and k < last:
                    of(cols[k][0])["whole"] += 1
        for x, k in enumerate(bad):
            before, after = k - edges[x] - 1, edges[x + 2] - k - 1
            row = x > 0 and before == 0 and cols[k][1].startswith("after") and cols[bad[x - 1]][1].startswith("after")
            if before + after >= sides and not row and cols[k][1][-1] in "ACGTe" and pos + cols[k][0] >= 0:
                of(cols[k][0])[cols[k][1]] += 1
    return {k: v for k, v in out.items() if any(v[c] for c in voting.CHANGES + voting.INSERTS)}


def brute_fixes(table):
    out = {}
    for key, v in table.items():
        change, new = None, ""
        for kinds, against in ((["gone", "A", "C", "G", "T", "own"], "confirmed"), (voting.INSERTS, "whole")):
            total, top = sum(v[k] for k in kinds), max(kinds, key=lambda k: v[k])
            most = max(v[k] for k in kinds if k != "own")
            ok = total > 1 and 2 * v[top] > total and top != "own" and sum(v[k] >= 3 for k in kinds) < 2
            if ok and (v[against] == 0 or (v[against] == 1 and most > 6)):
                if against == "whole":
                    new = top[-1]
                else:
                    change = "" if top == "gone" else top
        if change is not None or new:
            out[key] = (change, new)
    return out


def brute_applied(read, seq, fixes, begin=0):
    out = ""
    for p, c in enumerate(seq):
        change, new = fixes.get((read, begin + p), (None, ""))
        out += (c if change is None else change) + new
    return out


def overlapping(n_reads=6, depth=8, size=200):
    rows, reads, truth = [], {}, {}
    for read in range(n_reads):
        truth[read] = letters(size, RNG)
        reads[read] = mutated(truth[read], 0.02, RNG)
        for _ in range(depth):
            lo = RNG.randrange(0, 60)
            part = reads[read][lo : lo + RNG.randrange(80, 140)]
            other = mutated(truth[read][lo : lo + len(part)], 0.01, RNG)
            rows.append((read, lo, part, other, banded.align([(part.encode(), other.encode())])[0].cigar))
    return rows, reads, truth


SCHEMA = "id long, pos long, part string, other string, cigar string"


def test_votes_and_corrections_equal_brute_force(spark):
    rows, reads, _ = overlapping()
    a = letters(40, RNG)
    # no columns, letters that do not vote, letters lacking in a row and before the first, a column of two kinds
    rows += [(50, 0, "", "", ""), (50, 0, None, None, None), (51, 0, a, a[:20] + "N" + a[21:], "40M"), (52, 0, a, "GT" + a[:20] + "CA" + a[20:], "2D20M2D20M")]
    rows += [(53, 5, a, a[:20] + c + a[21:], "40M") for c in "ACGT" for _ in range(3)] + [(54, 0, a, a[:20] + a[21:], "20M1I19M")] * 2
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {(r["id"], r["pos"]): Counter({k: r[k] for k in voting.KINDS if r[k]}) for r in voting.columns(df).collect()}
    want = brute_columns([r for r in rows if r[2] is not None])
    assert got == {k: Counter({c: n for c, n in v.items() if n}) for k, v in want.items()}
    fixes = voting.corrections(voting.columns(df))
    expected = brute_fixes(want)
    assert {(r["id"], r["pos"]): (r["change"], r["inserted"]) for r in fixes.collect()} == expected
    assert expected[(54, 20)] == ("", "") and (53, 25) not in expected and len(expected) > 15
    seqs = spark.createDataFrame([*reads.items(), (51, a), (54, a), (None, a), (60, None), (61, "")], "id long, seq string")
    out = {r["id"]: r["corrected"] for r in voting.applied(seqs, fixes).collect()}
    assert out == {k: None if s is None else brute_applied(k, s, expected) for k, s in [*reads.items(), (51, a), (54, a), (None, a), (60, None), (61, "")]}
    parts = spark.createDataFrame([(r, b, s[b : b + 70]) for r, s in reads.items() for b in (0, 31, 90)], "id long, lo int, seq string")
    for r in voting.applied(parts, fixes, begin="lo", out="mended").collect():
        assert r["mended"] == brute_applied(r["id"], r["seq"], expected, r["lo"])


def test_planted_errors_are_mended_and_right_letters_stay(spark):
    truth = letters(300, RNG)
    other = "ACGT".replace
    wrong = {40: other(truth[40], "")[0], 120: "", 200: truth[200] + other(truth[200], "")[1]}
    read = "".join(wrong.get(i, c) for i, c in enumerate(truth))
    rows = []
    for lo in (0, 10, 20, 30):
        part, true = read[lo : lo + 260], truth[lo : lo + 260]
        rows.append((1, lo, part, true, banded.align([(part.encode(), true.encode())])[0].cigar))
    fixes = voting.corrections(voting.columns(spark.createDataFrame(rows, SCHEMA)))
    seqs = spark.createDataFrame([(1, read), (2, read)], "id long, seq string")
    out = {r["id"]: r["corrected"] for r in voting.applied(seqs, fixes).collect()}
    assert out == {1: truth, 2: read}


def test_one_confirmation_is_outweighed_by_seven_votes(spark):
    a = letters(60, RNG)
    new = "ACGT".replace(a[30], "")[0]
    b = a[:30] + new + a[31:]
    for against, expected in ((6, []), (7, [(30, new)])):
        rows = [(1, 0, a, b, "60M")] * against + [(1, 0, a, a, "60M")]
        got = voting.corrections(voting.columns(spark.createDataFrame(rows, SCHEMA))).collect()
        assert [(r["pos"], r["change"]) for r in got] == expected


def test_empty_and_refused(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert voting.corrections(voting.columns(empty)).count() == 0
    with pytest.raises(ValueError):
        voting.columns(empty, run=5, ends=3)


def test_equal_alignments_vote_as_each_of_them(spark):
    """Alignments that come more than once, and those of equal letters, have the votes that they have one by one."""
    rng = random.Random(12)
    rows = []
    for _ in range(60):
        part = "".join(rng.choice("ACGT") for _ in range(rng.choice([3, 9, 25])))
        other = part if rng.random() < 0.5 else part[:12] + rng.choice(["", "A", "TT"]) + part[13:]
        rows += [(rng.randrange(4), rng.randrange(5), part, other, banded.align([(part.encode(), other.encode())])[0].cigar)] * rng.choice([1, 3])
    want: dict = {}
    for read, pos, part, other, cigar in rows:
        for at, kind, n in zip(*(x.tolist() for x in voting.votes(part.encode(), other.encode(), cigar)), strict=True):
            one = want.setdefault((read, pos + at), dict.fromkeys(voting.KINDS, 0))
            one[voting.KINDS[kind]] += n
    for read in range(4):
        total = dict.fromkeys(voting.STRETCHES, 0)
        for _, at in sorted(key for key in want if key[0] == read):
            for c in voting.STRETCHES:
                total[c] += want[read, at][c]
                want[read, at][c] = total[c]
    want = {key: v for key, v in want.items() if any(v[c] for c in voting.CHANGES + voting.INSERTS)}
    got = voting.columns(spark.createDataFrame(rows, "id long, pos long, part string, other string, cigar string"))
    assert {(r.id, r.pos): {c: r[c] for c in voting.KINDS} for r in got.collect()} == want and len(want) > 10
    texts = spark.createDataFrame(rows, "id long, pos long, part string, other string, cigar string").select("part", "other", "cigar", voting.n_differences("part", "other", "cigar").alias("n"))
    assert all(r.n == len(voting.differences(r.part.encode(), r.other.encode(), r.cigar)[0]) for r in texts.collect())
