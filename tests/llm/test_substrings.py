import random
import re

import numpy as np
import pytest
from helixframe.llm import substrings

from .helpers import documents, empty, texts


def brute_gone(rows, n):
    """rows of (id, text), in the order of precedence; for each whether its words go."""
    seen, out = set(), []
    for _, text in rows:
        parts = (text or "").encode().split()
        gone = [False] * len(parts)
        for i in range(len(parts) - n + 1):
            window = tuple(parts[i : i + n])
            if window in seen:
                gone[i : i + n] = [True] * n
            seen.add(window)
        out.append(gone)
    return out


def brute(rows, n):
    """The kept words of each row."""
    return [[p.decode() for p, g in zip((t or "").encode().split(), gone, strict=True) if not g] for (_, t), gone in zip(rows, brute_gone(rows, n), strict=True)]


def brute_cut(text, gone):
    """text without the words that go and the white space after each."""
    raw = text.encode()
    starts = [m.start() for m in re.finditer(rb"[^\x20\x09-\x0d]+", raw)] + [len(raw)]
    kept = [raw[a:b] for a, b, g in zip(starts, starts[1:], gone, strict=False) if not g]
    return (raw[: starts[0]] + b"".join(kept)).decode()


@pytest.mark.parametrize("n", [5, 20])
def test_against_brute_force(spark, n):
    values = texts()
    docs = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in substrings.remove_repeats(docs, n).collect()}
    for (i, text), kept in zip(enumerate(values), brute(list(enumerate(values)), n), strict=True):
        assert got[i].kept == " ".join(kept)
        assert got[i].n_words == len((text or "").encode().split())
        assert got[i].n_removed == got[i].n_words - len(kept) == sum(s.end - s.first for s in got[i].spans)
    assert any(r.n_removed for r in got.values())


@pytest.mark.parametrize("plan", [(1, substrings.Sketch(16, 16)), (30, substrings.Sketch(12, 9)), (9, substrings.Sketch(3, 2)), (2, substrings.Sketch(24, 10))])
def test_chunks_and_sketches_change_nothing(spark, monkeypatch, plan):
    """Down to a sketch of 8 cells, all of which are counted twice."""
    rng = random.Random(len(plan))
    values = [" ".join(rng.choices("abcdef", k=60)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string").repartition(4)
    monkeypatch.setattr(substrings, "planned", lambda size: plan)
    got = {r.doc_id: r.kept for r in substrings.remove_repeats(docs, 3).collect()}
    for i, kept in enumerate(brute(list(enumerate(values)), 3)):
        assert got[i] == " ".join(kept)


@pytest.mark.parametrize("size", [0, 10**5, 5 * 10**8, 3 * 10**10, 10**14])
def test_sketch_grows_with_the_text(size):
    """Two cells or more for each six bytes, at any size; what one task holds stays bounded."""
    chunks, sketch = substrings.planned(size)
    assert 2**sketch.bits >= size / 3
    assert sketch.part_bits <= 26 and size <= chunks << 26


@pytest.mark.parametrize("bits", [2, 9, 22])
def test_packed_cells(bits):
    rng = np.random.default_rng(bits)
    for n in (1, 7, 5000):
        cells = np.sort(rng.integers(0, 1 << bits, n, dtype=np.uint64))
        assert (substrings.unpacked(substrings.packed(cells, bits)) == cells.astype(np.int64)).all()


def test_one_exchange_of_the_texts(spark, tmp_path):
    documents(spark).write.parquet(str(tmp_path / "docs"))
    out = substrings.remove_repeats(spark.read.parquet(str(tmp_path / "docs")))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") >= 2


def test_text_is_cut_in_place(spark):
    a = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, a, "x"), (2, f"  Begin\n\nhere {a}\n\tand  end", "y"), (3, "  kept\tas it is ", "z")], "doc_id long, text string, more string")
    got = {r.doc_id: (r.kept, r.more) for r in substrings.remove_repeats(docs, 20, spaced=False, keep=("more",)).collect()}
    assert got == {1: (a, "x"), 2: ("  Begin\n\nhere and  end", "y"), 3: ("  kept\tas it is ", "z")}


def test_rows_that_repeat_and_nulls(spark):
    docs = documents(spark)
    rows = substrings.remove_repeats(docs).collect()
    assert len(rows) == docs.count()
    source = docs.collect()
    twice = [i for i in {r.doc_id for r in source} if i is not None and sum(x.doc_id == i for x in source) == 2]
    for i in twice:
        assert len({(r.n_removed, r.kept) for r in rows if r.doc_id == i}) == 1
    null = [r for r in rows if r.doc_id is None]
    assert len(null) == 2 and all(r.n_removed == 0 for r in null)
    assert substrings.remove_repeats(empty(spark)).count() == 0


def test_short_texts_alone(spark):
    docs = spark.createDataFrame([(i, "a b c d e f") for i in range(30)], "doc_id long, text string")
    assert {(r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(docs, 7).collect()} == {(6, 0, "a b c d e f")}
