import itertools
import random

import pytest

from helixframe.operators import targets

RNG = random.Random(10)


def brute_force(classes, enter, scores):
    """The best of all sequences of states; a path begins in either state without a price."""
    best = None
    for path in itertools.product((0, 1), repeat=len(classes)):
        for first in (0, 1):
            total = sum(scores[c] for c, s in zip(classes, path, strict=True) if s)
            total -= enter * sum(b > a for a, b in itertools.pairwise((first, *path)))
            # of equal paths the one that is longer in a target
            if best is None or (total, sum(path)) > best[0]:
                best = (total, sum(path)), path
    path = [0, *best[1][1:], 0]
    cuts = [i for i in range(1, len(path)) if path[i] != path[i - 1]]
    return list(zip(cuts[::2], cuts[1::2], strict=True))


@pytest.mark.parametrize("enter", [0, 3, 5, 11, 50])
def test_targets_equal_brute_force(spark, enter):
    cases = {k: [RNG.choice((0, 0, 1, 2)) for _ in range(RNG.randrange(1, 12))] for k in range(40)}
    cases |= {100: [2], 101: [0, 0, 2, 2], 102: [2] * 5 + [0] * 5 + [2] * 2, 103: [0] * 9 + [2]}
    rows = [(k, i, "A" if c == 1 else "C", 0 if c == 1 else 9) for k, x in cases.items() for i, c in enumerate(x) if c]
    found = targets.targets(spark.createDataFrame(rows, "id long, pos long, base string, qual int").repartition(3), enter, -2, 1, 3)
    got = {}
    for r in found.collect():
        got.setdefault(r["id"], []).append((r["lo"], r["hi"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, x in cases.items() if any(x) and (v := brute_force(x, enter, (-2, 1, 3)))}


def test_consensus_of_targets(spark):
    bases = [(1, 2, "C", 20), (1, 2, "G", 30), (1, 2, "G", 12), (1, 3, "A", 20), (1, 3, "C", 20), (1, 6, "T", 99), (1, 40, "C", 13), (1, 41, "N", 30), (None, 5, "A", 30), (1, None, "A", 30), (1, 0, "T", 40)]
    sites = targets.sites(spark.createDataFrame(bases, "id long, pos long, base string, q int"))
    assert sorted(map(tuple, sites.collect())) == [(1, 0, "T", 40), (1, 2, "G", 10), (1, 3, "A", 0), (1, 6, "T", 63), (1, 40, "C", 13)]
    out = targets.with_consensus(targets.targets(sites, 20, -1, 1, 6), sites).collect()
    assert [tuple(r) for r in out] == [(1, 1, 7, "NGNNNT", "!+!!!`")]


def test_empty_and_refused(spark):
    sites = targets.sites(spark.createDataFrame([], "id long, pos long, base string, q int"))
    assert targets.with_consensus(targets.targets(sites), sites).count() == 0
    with pytest.raises(ValueError):
        targets.targets(sites, empty=0)
