import random
import zlib

import numpy as np
import pandas as pd
from helixframe.llm import language

from .helpers import documents, empty

SYLLABLES = {"xa": ["ka", "to", "mi", "ru", "ne"], "yb": ["sch", "ung", "ver", "eit", "ach"], "zc": ["eau", "oux", "ré", "que", "lle"]}


def corpus(n=240):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        lang = sorted(SYLLABLES)[i % 3]
        rows.append((i, " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(rng.randrange(3, 80))), lang))
    return rows + [(900, None, "xa"), (901, "", "xa"), (902, " 12 + 3 !", "yb"), (903, "KATOMI runeka", None), (904, rows[1][1], "yb"), (None, rows[2][1], "zc"), (0, rows[0][1], "xa"), (905, "ka to mi " * 40_000, "xa")]


def brute_vector(text):
    one, two, three = language.letter_vectors()
    table = language.symbols()
    clean = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    clean = " " + " ".join(clean.split()) + " "
    s = [int(table[ord(c)]) for c in clean]
    out = np.zeros(language.DIMENSIONS)
    for a, b, c in zip(s, s[1:], s[2:], strict=False):
        if b:
            out += one[a] * two[b].astype(int) * three[c]
    return out


def test_against_brute_force_and_held_out(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = pd.DataFrame([r.asDict() for r in language.identify(docs).collect()])
    assert len(got) == len(rows)
    model = {}
    for i, t, lang in rows:
        if lang and t is not None and i is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            model[lang] = model.get(lang, 0) + brute_vector(t)
    by = {(r.doc_id if r.doc_id == r.doc_id else None): r for r in got.itertuples()}
    for i, t, _ in rows:
        r = by[i]
        assert r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2)
        if not t or not any(c.isalpha() for c in t):
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        v = brute_vector(t) if len(t) < 10_000 else None
        if v is not None:
            cosines = {x: m @ v / np.linalg.norm(m) / np.linalg.norm(v) for x, m in model.items()}
            assert r.lang_pred == max(sorted(cosines), key=cosines.get)
            assert abs(r.score - max(0, max(cosines.values()))) < 1e-6
    truth = dict((i, x) for i, _, x in rows if x and i is not None and i < 900)
    held = got[got.held_out & got.doc_id.isin(truth)]
    assert (held.lang_pred == held.doc_id.map(truth)).mean() > 0.95


def test_nothing_to_learn_and_empty(spark):
    docs = documents(spark).withColumn("lang", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(docs).collect()} == {"und"}
    assert language.identify(empty(spark)).count() == 0
    assert language.identify(documents(spark)).count() == documents(spark).count()
