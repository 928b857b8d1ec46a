import hashlib
import math
import random

import numpy as np
import pytest

from helixframe.llm import lloyd

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error int, x string"


def brute(rows):
    """(vec_id, code, error, label_error, sha) by plain Python."""
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    vectors = [[math.floor(1024 * x) for x in v] for _, v, _ in kept]
    width = -(-len(vectors[0]) // 4) * 4
    vectors = [v + [0] * (width - len(v)) for v in vectors]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:256]
    step = width // 4
    parts = [[v[p * step : (p + 1) * step] for v in vectors] for p in range(4)]
    books = [[list(parts[p][k]) for k in order] for p in range(4)]

    def nearest(p):
        out = []
        for x in parts[p]:
            out.append(min((sum((a - b) ** 2 for a, b in zip(x, entry, strict=True)), z) for z, entry in enumerate(books[p])))
        return out

    for _ in range(4):
        for p in range(4):
            near = nearest(p)
            for z in range(len(books[p])):
                own = [x for x, (_, y) in zip(parts[p], near, strict=True) if y == z]
                if own:
                    books[p][z] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    near = [nearest(p) for p in range(4)]
    sha = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    error = [sum(near[p][k][0] for p in range(4)) for k in range(len(kept))]
    total = {}
    for (_, _, label), e in zip(kept, error, strict=True):
        total[label] = total.get(label, 0) + e
    return sorted(((i, "".join(f"{near[p][k][1]:02x}" for p in range(4)), error[k], total[label], sha) for k, (i, _, label) in enumerate(kept)), key=str)


def result(spark, rows):
    df = spark.createDataFrame([(i, v, label, "a", 1, "b") for i, v, label in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, lloyd.vector_codes(df).collect()), key=str)


def vectors(n, width, seed=0, spread=0.05):
    rng = random.Random(seed)
    middles = [[rng.uniform(-1, 1) for _ in range(width)] for _ in range(6)]
    return [(i, np.float32([c + rng.gauss(0, spread) for c in rng.choice(middles)]).tolist(), rng.choice([1, 2, None])) for i in range(n)]


@pytest.mark.parametrize("n, width", [(700, 8), (300, 64), (40, 4), (30, 6)])
def test_against_brute_force(spark, n, width):
    rows = vectors(n, width)
    assert result(spark, rows) == brute(rows)


def test_odd_rows(spark):
    """Ties, copies under one id, null ids, and rows that have to go."""
    rng = random.Random(5)
    grid = [(i, [float(rng.randrange(-1, 2)) / 1024 for _ in range(8)], i % 3) for i in range(600)]
    rows = grid + grid[:20] + [(None, grid[0][1], None), (7, None, 1), (8, [1.0, None] * 4, 1), (9, [math.nan] * 8, 1), (10, [math.inf] * 8, 2), (11, [-math.inf] * 8, 2)]
    assert result(spark, rows) == brute(rows)
    assert len(result(spark, [*rows, (10**6, [0.5] * 9, 1)])) == len(brute(rows))


def test_nothing_to_code(spark):
    assert result(spark, []) == []
    assert result(spark, [(1, None, 2)]) == []
    assert [r[1] for r in result(spark, [(1, [], 2), (2, [], 2)])] == ["00000000"] * 2


def test_large_components(spark):
    rows = [(i, np.float32([x * 60_000 for x in v]).tolist(), label) for i, v, label in vectors(60, 8, spread=0.01) if max(map(abs, v)) < 1]
    assert result(spark, rows) == brute(rows)
    with pytest.raises(Exception, match="no room for exact squares"):
        result(spark, [(1, [1e30] * 8, 1)])


def test_whole_subtrees(monkeypatch):
    """Apart clusters are assigned by their trees' upper nodes, and every entry as by comparing all."""
    rng = np.random.default_rng(1)
    middles = rng.integers(-100_000, 100_000, (20, 5))
    points = middles[rng.integers(0, 20, 3000)] + rng.integers(-50, 50, (3000, 5))
    tree = lloyd.unpacked(lloyd.packed(lloyd.built(points)))
    parts = list(lloyd.filtered(tree, middles))
    assert any(which is None and (tree.end[at] - tree.start[at]).max() > lloyd.LEAF for _, at, which in parts)
    nearest, error = lloyd.assigned(tree, middles)
    every = ((points[:, None] - middles[None]) ** 2).sum(2)
    assert nearest.tolist() == every.argmin(1).tolist() and error.tolist() == every.min(1).tolist()
    counts, sums = lloyd.totals(tree, middles)
    assert counts.tolist() == np.bincount(nearest, minlength=20).tolist() and sums.sum(0).tolist() == points.sum(0).tolist()
