import random
import re

import numpy as np
import pytest
import xxhash
from helixframe.llm import simhash

from .helpers import documents, empty, texts, words


def brute_fingerprint(text):
    ws = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not ws:
        return 0
    shingles = [b" ".join(ws[i : i + 4]) for i in range(len(ws) - 3)] or [b" ".join(ws)]
    hs = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def brute_classes(rows):
    """rows of (id, fingerprint); the smallest id of each row's component."""
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 4 and group[i] != group[j]:
                a, b = group[i], group[j]
                group = [a if g == b else g for g in group]
    return [min((r[0] for r, g in zip(rows, group, strict=True) if g == own and r[0] is not None), default=None) for own in group]


def test_against_brute_force(spark):
    rng = random.Random(3)
    base = words(rng, 400, 5000).split()
    near = [" ".join([*base[:k], "edited", *base[k + 1 :]]) for k in range(0, 400, 25)]
    docs = documents(spark, texts() + near)
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.collect()]
    want = sorted((i if i is not None else -1, f"{f:016x}", c) for (i, f), c in zip(rows, brute_classes(rows), strict=True))
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == want
    assert any(i != c for i, _, c in got)


def test_empty_table(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("code", range(len(simhash.CODES)))
def test_codes_cover(code):
    """Every pair within 4 bits shares the home of either among the other's anchors."""
    rng = np.random.default_rng(code)
    x = rng.integers(0, 1 << 63, 300, dtype=np.uint64) << np.uint64(1)
    y = x.copy()
    for _ in range(4):
        y ^= np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64)
    blocks = simhash.CODES[code]
    _, home = simhash.anchors(x, blocks, 0)
    index, anchor = simhash.anchors(y, blocks, 4)
    sent = set(zip(index.tolist(), anchor.tolist(), strict=True))
    assert all((i, h) in sent for i, h in enumerate(home.tolist()))
    assert len(home) == len(x)


def test_hot_anchor_is_split(spark):
    """A chain of fingerprints around one home, over many units, stays one component."""
    rng = np.random.default_rng(5)
    fps = {0}
    while len(fps) < 3000:
        bits = rng.integers(0, 64, rng.integers(1, 4))
        fps.add(int(np.bitwise_or.reduce(np.uint64(1) << bits.astype(np.uint64)).view(np.int64)))
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    edges = simhash.links(df, 4, most_home=100)
    roots = simhash.components(edges)
    assert roots.count() == len(fps)
    assert roots.select("root").distinct().count() == 1
    assert edges.count() < 200_000


@pytest.mark.parametrize("code", simhash.CODES)
@pytest.mark.parametrize("copies", [10_000, 150])
def test_every_code_links_alike(spark, monkeypatch, code, copies):
    rng = random.Random(17)
    fps = [rng.getrandbits(64) for _ in range(40)]
    for fp in fps[:25]:
        for bits in (1, 4, 5):
            near = fp
            for b in rng.sample(range(64), bits):
                near ^= 1 << b
            fps.append(near)
    fps = sorted({*fps, 0, 1})
    monkeypatch.setattr(simhash, "chosen_code", lambda n, t: code)
    monkeypatch.setattr(simhash, "MOST_COPIES", copies)
    signed = [fp - (1 << 64) if fp >> 63 else fp for fp in fps]
    edges = simhash.links(spark.createDataFrame([(fp,) for fp in signed], "fp long").repartition(2), 4).collect()
    group = {fp: fp for fp in fps}

    def find(x):
        return x if group[x] == x else find(group[x])

    for r in edges:
        a, b = r.a % (1 << 64), r.b % (1 << 64)
        group[find(a)] = find(b)
    want = brute_classes(list(zip(fps, fps, strict=True)))
    classes = {}
    for fp, c in zip(fps, want, strict=True):
        classes.setdefault(find(fp), set()).add(c)
    assert all(len(c) == 1 for c in classes.values()) and len(classes) == len(set(want))
