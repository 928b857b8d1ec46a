import random

import corpus_pipeline
from helixframe.llm import jaccard, simhash

from .helpers import documents, empty, texts, words


def brute_set(text):
    ws = (text or "").encode().lower().split()
    return {b" ".join(ws[i : i + 5]) for i in range(len(ws) - 4)} or {b" ".join(ws)}


def brute_classes(rows):
    group = list(range(len(rows)))
    sets = [brute_set(t) for _, t in rows]
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if group[i] != group[j] and len(x & y) >= 0.8 * len(x | y):
                a, b = group[i], group[j]
                group = [a if g == b else g for g in group]
    return [min((r[0] for r, g in zip(rows, group, strict=True) if g == own and r[0] is not None), default=None) for own in group]


def edited():
    """Texts with one to four words of 100 exchanged, and chains whose ends are not alike."""
    rng = random.Random(6)
    out = []
    for k in range(30):
        base = words(rng, 100, 5000).split()
        out.append(" ".join(base))
        for n in range(k % 4 + 1):
            base[20 * n + 10] = f"edit{k}x{n}"
            out.append(" ".join(base))
        if k % 3 == 0:
            for n in range(8):
                base = [*base[5:], *words(rng, 5, 5000).split()]
                out.append(" ".join(base))
    return out


def test_against_brute_force(spark):
    docs = documents(spark, texts() + edited())
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or 0)
    want = sorted(((i, c) for (i, _), c in zip(rows, brute_classes(rows), strict=True)), key=key)
    got = sorted(map(tuple, jaccard.near_duplicates(docs).collect()), key=key)
    assert got == want


def test_stage_drops_what_four_bits_miss(spark):
    base = words(random.Random(9), 100, 5000).split()
    other = " ".join("edit" if i in (20, 60) else w for i, w in enumerate(base))
    assert (simhash.fingerprint_of(" ".join(base).encode()) ^ simhash.fingerprint_of(other.encode())).bit_count() > 4
    kept = corpus_pipeline.near_dedup(spark, documents(spark, [" ".join(base), other, "quite another text"]), "")
    assert {r.doc_id for r in kept.where("doc_id is not null").collect()} == {0, 2}


def test_empty_table(spark):
    assert jaccard.near_duplicates(empty(spark)).count() == 0
