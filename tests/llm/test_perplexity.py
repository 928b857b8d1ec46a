import math
import random
from collections import Counter

import numpy as np
import pytest
from helixframe.llm import perplexity
from pyspark.sql import functions as F

from .helpers import documents, empty
from .test_language import SYLLABLES


def normal(text):
    line = " ".join((text or "").split())
    return "    " + line if line else ""


def brute_model(texts):
    """Interpolated modified Kneser-Ney of order five, by dictionaries."""
    levels = [None] * 5 + [Counter()]
    for t in map(normal, texts):
        levels[5].update(t[i : i + 5] for i in range(len(t) - 4))
    for n in (4, 3, 2, 1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])
    d, contexts = [None], [None]
    for n in (1, 2, 3, 4, 5):
        of = Counter(levels[n].values())
        d.append([0, *perplexity.discounts(*(of[k] for k in (1, 2, 3, 4)))])
        contexts.append({})
        for g, c in levels[n].items():
            contexts[n].setdefault(g[:-1], []).append(c)

    def p(g):
        n = len(g)
        if not n:
            return 1 / (len(levels[1]) + 1)
        counts = contexts[n].get(g[:-1])
        if not counts:
            return p(g[1:])
        c = levels[n].get(g, 0)
        return (c - d[n][min(c, 3)] + sum(d[n][min(x, 3)] for x in counts) * p(g[1:])) / sum(counts)

    return p


def brute_perplexity(text, p):
    t = normal(text)
    logs = [math.log(p(t[i : i + 5])) for i in range(len(t) - 4)]
    return math.exp(-sum(logs) / len(logs)) if logs else None


def sayings(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choices(["the ", "cat ", "sat 12 ", "on, ", "mats. ", "中文 ", "Été\n\n"], k=rng.randrange(1, 30))) for _ in range(n)]


def test_probabilities_against_brute_force(spark):
    trusted, others = sayings(2, 50), [*sayings(3, 20), "dog & \U0001f600 xx", "zzzzzz", "a", ""]
    rows = [(t, 1) for t in trusted] + [(t, 0) for t in others]
    grams = perplexity.counted(spark.createDataFrame(rows, "text string, trusted int").repartition(3))
    have = {r.g: r.n for r in grams.collect()}
    assert have == {g: sum(normal(t)[i : i + 5] == g for t in trusted for i in range(len(normal(t)) - 4)) for g in have}
    p = brute_model(trusted)
    got = {r.g: r.p for r in perplexity.probabilities(grams).collect()}
    assert set(got) == set(have) and any(n == 0 for n in have.values())
    for g, x in got.items():
        assert abs(x - p(g)) < 1e-12
    for context in list({g[:-1] for g in have})[:30]:
        letters = {g[-1] for t in trusted for g in normal(t)}
        unknown = p(context + "\u1234")
        assert abs(sum(p(context + c) for c in letters) + unknown - 1) < 1e-9


@pytest.mark.parametrize("block,chunk,shard", [(perplexity.BLOCK, perplexity.CHUNK, perplexity.SHARD), (50, 300, 100)])
def test_whole_query_against_brute_force(spark, monkeypatch, block, chunk, shard):
    for name, value in (("BLOCK", block), ("CHUNK", chunk), ("SHARD", shard)):
        monkeypatch.setattr(perplexity, name, value)
    docs, labels = quality_tables(spark)
    rows, said = docs.collect(), {}
    for r in labels.collect():
        said.setdefault(r.doc_id, []).append((r.quality, r.toxic))
    trusted = {i for i, x in said.items() if i is not None and min((q for q, _ in x if q is not None), default=0) == 1 and max((t for _, t in x if t is not None), default=1) == 0}
    aside = {r.doc_id for r in docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(8)) == 0).collect()}
    p = brute_model([r.text for r in rows if r.doc_id in trusted - aside])
    score = {(r.doc_id, r.lang): brute_perplexity(r.text, p) for r in rows}
    held = [(r.lang, score[r.doc_id, r.lang]) for r in rows if r.doc_id in trusted & aside and score[r.doc_id, r.lang] is not None]

    def limit(lang, q):
        values = sorted(x for of, x in held if of == lang) or sorted(x for _, x in held)
        return values[max(0, math.ceil(q * len(values)) - 1)]

    got = perplexity.classify(docs, labels, quantile=0.9).collect()
    assert len(got) == len(rows)
    for r in got:
        want = score[r.doc_id, r.lang]
        assert (r.perplexity is None) == (want is None) and (want is None or abs(r.perplexity / want - 1) < 1e-5)
        assert abs(r.threshold / limit(r.lang, 0.9) - 1) < 1e-5
        assert r.keep == (want is not None and r.perplexity <= r.threshold)
    assert not all(r.keep for r in got if r.perplexity is not None)


def quality_tables(spark, n=600):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        lang = sorted(SYLLABLES)[i % 3]
        text = " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(rng.randrange(30, 80)))
        junk = i % 20 == 7
        if junk:
            text = "".join(rng.choices("#%&*qxz{}~9", k=300))
        rows.append((i, text, lang))
        if i % 2:
            labels.append((i, int(not junk), 0))
    rows += [(10_000, None, "xa"), (10_001, " \n", None), (10_002, rows[0][1], None), (0, rows[0][1], "xa"), (None, rows[4][1], "yb")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3), spark.createDataFrame(labels + [(1, 1, 0), (None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")


def test_junk_goes_and_clean_stays(spark):
    docs, labels = quality_tables(spark, 3000)  # some 60 held-out texts a language
    rows = perplexity.classify(docs, labels).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows}
    junk = [i for i in range(3000) if i % 20 == 7]
    assert not any(by[i].keep for i in junk)
    assert np.mean([by[i].keep for i in range(3000) if i not in junk]) > 0.93
    assert by[10_000].perplexity is None and not by[10_000].keep and not by[10_001].keep and by[10_002].keep


def test_many_trusted_ids_are_joined_by_shuffle(spark, monkeypatch):
    docs, labels = quality_tables(spark)
    want = sorted(map(str, perplexity.classify(docs, labels).collect()))
    monkeypatch.setattr(perplexity, "MOST_SENT", 0)
    assert sorted(map(str, perplexity.classify(docs, labels).collect())) == want


def test_further_columns_and_odd_texts(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    rows = perplexity.classify(docs.withColumnsRenamed({"fingerprint": "trusted", "id": "g", "kept": "n", "shard": "perplexity", "score": "threshold", "n_hit": "of"}), labels).collect()
    assert len(rows) == docs.count()
    blank = {r.doc_id for r in docs.collect() if not (r.text or "").split()}
    assert all((r.perplexity is None) == (r.doc_id in blank) for r in rows if r.doc_id is not None)


def test_empty_tables(spark):
    docs, labels = quality_tables(spark)
    assert perplexity.classify(empty(spark), labels).count() == 0
    kept = perplexity.classify(docs, labels.limit(0)).collect()
    assert all(r.keep == (r.perplexity is not None) for r in kept)
