import random

import numpy as np
import pyarrow as pa
import pytest

from helixframe.llm import hyperminhash as hmh

from .helpers import documents, empty, texts, words
from .test_jaccard import edited


def brute_set(text, n=2):
    ws = (text or "").encode().lower().split()
    return {b" ".join(ws[i : i + n]) for i in range(len(ws) - n + 1)} or ({b" ".join(ws)} if ws else set())


def brute(rows):
    """(id, size, component, kept) of rows (id, text), by all pairs."""
    sets = [brute_set(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x and y and group[i] != group[j] and 100 * len(x & y) >= 80 * len(x | y):
                a, b = group[i], group[j]
                group = [a if g == b else g for g in group]
    out = []
    for (own, _), s, g in zip(rows, sets, group, strict=True):
        ids = [i for (i, _), h, t in zip(rows, group, sets, strict=True) if h == g and t and i is not None]
        least = min(ids, default=None) if s else own
        out.append((own, len(s), least, own == least))
    return sorted(out, key=str)


def result(docs):
    return sorted(map(tuple, hmh.near_duplicates(docs).collect()), key=str)


def chains():
    """Chains whose ends are not alike, small sets at the threshold, and one common text with words exchanged all over."""
    rng = random.Random(3)
    out = []
    for k in range(6):
        base = words(rng, 60 + 50 * k, 3000).split()
        for _ in range(9):
            out.append(" ".join(base))
            base = [*base[len(base) // 20 :], *words(rng, len(base) // 20, 3000).split()]
    for n in range(2, 14):
        base = [f"s{n}x{i}" for i in range(n)]
        out += [" ".join(base), " ".join([*base, "more"]), " ".join(base[1:])]
    base = words(rng, 150, 3000).split()
    for _ in range(60):
        out.append(" ".join(w if rng.random() > 0.05 else words(rng, 1, 3000) for w in base))
    return out


def test_against_brute_force(spark):
    docs = documents(spark, texts() + edited() + chains())
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(docs) == brute(rows)


def test_blocks_of_a_band(spark, monkeypatch):
    """Bands of many members are compared in blocks, with the same result."""
    monkeypatch.setattr(hmh, "MOST_MEMBERS", 7)
    docs = documents(spark, chains())
    assert result(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_later_steps_alone(spark, monkeypatch):
    """Without a first comparison on sight, the bands' tasks find every link."""
    monkeypatch.setattr(hmh, "LIKELY", hmh.BANDS + 1)
    docs = documents(spark, chains())
    assert result(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_empty_table(spark):
    assert result(empty(spark)) == []


def test_registers():
    least = np.array([(1 << 55) | (0b1010101010 << 45), 1 << 3, (1 << 56) - 1, 7], np.uint64)
    zeros, mantissa = hmh.registers(least) >> 10, hmh.registers(least) & 1023
    assert zeros.tolist() == [0, 52, 0, 53]
    assert mantissa[0] == 0b1010101010 and mantissa[2] == 1023


@pytest.mark.parametrize("n", [5, 60, 300, 4000])
def test_estimates(n):
    """Equal registers follow the similarity, and accidents are taken off."""
    rng = np.random.default_rng(n)
    errors, apart = [], []
    for _ in range(60):
        x = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64) * np.uint64(2)
        a, b = x[:n], np.concatenate([x[: n * 4 // 5], x[n : n + n // 5]])
        common = n * 4 // 5 / (len(a) + len(b) - n * 4 // 5)
        for y, want, out in ((b, common, errors), (x[n:], 0.0, apart)):
            s = hmh.sketches([hmh.distinct(a), hmh.distinct(y)])
            out.append(float(hmh.estimated((s[0] == s[1]).sum(), n, len(y))) - want)
    assert abs(np.mean(errors)) < 0.02 and abs(np.mean(apart)) < 0.002
    assert np.abs(errors).max() < hmh.MARGIN


def test_shingles_do_not_cross_texts():
    got = list(hmh.shingles(pa.array(["A b", "b c", "a B", None, "", "x", "X"]), 2))
    assert got[0].tolist() == got[2].tolist() != got[1].tolist()
    assert [len(g) for g in got] == [1, 1, 1, 0, 0, 1, 1] and got[5].tolist() == got[6].tolist()
