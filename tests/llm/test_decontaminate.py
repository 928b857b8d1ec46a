import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from helixframe.llm import decontaminate

from .helpers import documents, empty


def tokens(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))


def brute(text, items, window=10):
    ws = tokens(text)
    hit, own = [False] * len(ws), set()
    for i, t in items:
        item = tokens(t)
        n = min(window, len(item))
        windows = {tuple(item[k : k + n]) for k in range(len(item) - n + 1)} if n else set()
        for k in range(len(ws) - n + 1) if n else ():
            if tuple(ws[k : k + n]) in windows:
                hit[k : k + n] = [True] * n
                own.add(i)
    return len(ws), sum(hit), own


def tables(spark):
    rng = random.Random(9)
    say = lambda n, v: " ".join(rng.choice(["word", "Other", "thing", "élan", "42"]) + str(rng.randrange(v)) for _ in range(n))
    items = [(k, say(rng.randrange(10, 40), 200)) for k in range(20)]
    items += [(100, "just four words here"), (101, "single"), (102, ""), (103, None), (3, items[3][1]), (None, say(12, 200)), (104, "a b " * 30), (105, items[0][1])]
    docs = []
    for k in range(60):
        parts = [say(rng.randrange(0, 60), 200)]
        if k % 2:
            i = rng.choice([x[1] for x in items if x[1]])
            ws = i.split()
            lo = rng.randrange(len(ws))
            parts += [" ".join(ws[lo : lo + rng.randrange(4, 40)]).upper() if "é" not in i else i, say(rng.randrange(0, 20), 200)]
        docs.append(" ;\n".join(parts))
    docs += [None, "", "...", "b a " * 40, "single", items[5][1] + " " + items[5][1], say(20_000, 900) + " " + items[6][1]]
    return documents(spark, docs), items


def items_table(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, n_words string").repartition(2)


@pytest.mark.parametrize("block", [16 << 20, 300])
def test_against_brute_force(spark, block):
    docs, items = tables(spark)
    got = decontaminate.contamination(docs, items_table(spark, items), block_bytes=block).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    for r in docs.collect():
        n, hit, own = brute(r.text, items)
        ws = tokens(r.text)
        assert any((x.n_words, x.n_hit, {m.item_id for m in x.matches}) == (n, hit, {None if i is None else str(i) for i in own}) for x in by[r.doc_id])
        for m in (m for x in by[r.doc_id] if x.n_words == n for m in x.matches):
            assert any(tokens(t)[m.item_word : m.item_word + m.n_words] == ws[m.doc_word : m.doc_word + m.n_words] for i, t in items if (None if i is None else str(i)) == m.item_id)
    assert any(r.n_hit for r in got)


def test_digests(spark):
    docs, items = tables(spark)
    got = decontaminate.contamination_digests(docs, items_table(spark, items)).collect()
    want = []
    for r in docs.collect():
        n, hit, own = brute(r.text, items)
        ids = sorted(str(i) for i in own if i is not None)
        want.append((r.doc_id, n, hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), hit > 0))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_suffix_array():
    rng = np.random.default_rng(3)
    for n, top in ((0, 2), (1, 2), (300, 2), (300, 40), (50, 1)):
        values = rng.integers(0, top, n).astype(np.uint64)
        order = decontaminate.suffix_array(values, 10)
        keys = [tuple(values[i : i + 10].tolist()) for i in order]
        assert keys == sorted(keys) and sorted(order) == list(range(n))


def test_empty_tables(spark):
    docs, items = tables(spark)
    assert decontaminate.contamination_digests(empty(spark), items_table(spark, items)).count() == 0
    assert {r.n_hit for r in decontaminate.contamination_digests(docs, items_table(spark, items).limit(0)).collect()} == {0}


def test_repetitive_texts(spark):
    """One word a million times, and an item of it, take the memory of what is found."""
    import resource

    items = decontaminate.items_of(["a", "b"], pa.array(["w " * 5000, "v w " * 300]), 10)
    values = np.concatenate([np.full(1_000_000, items.hashes[0]), np.zeros(11, np.uint64)])
    order = decontaminate.suffix_array(values[:-10], 10)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    n, most, hit = 0, 0, np.zeros(len(values) + 1, np.int64)
    for _, _, place, length in decontaminate.matches(values, order, items, 10):
        n, most = n + len(place), max(most, int(length.max()))
        np.add.at(hit, place, 1)
        np.add.at(hit, place + length, -1)
    assert n == 999_991 + 4990 and most == 5000 and (np.cumsum(hit)[:1_000_000] > 0).all()
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_000_000  # kB
    docs = spark.createDataFrame([(1, "w " * 20_000), (2, "v w " * 200)], "doc_id long, text string")
    got = {r.doc_id: r for r in decontaminate.contamination(docs, spark.createDataFrame([(1, "w " * 400), (2, "w v " * 40)], "item_id long, text string")).collect()}
    assert (got[1].n_hit, got[2].n_hit) == (20_000, 400)
    assert max(m.n_words for m in got[1].matches) == 400
