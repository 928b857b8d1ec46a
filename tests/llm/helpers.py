"""Small tables with what operators have to bear: nulls, empty and long texts,
ties, repeated rows, and further columns whose names clash with results."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fingerprint int, id string, kept string, shard string, score string, n_hit string"


def words(rng, n, vocabulary=60):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def texts(seed=1, n=40):
    rng = random.Random(seed)
    out = [words(rng, rng.randrange(1, 120)) for _ in range(n)]
    out += [out[0], out[0], out[1] + " end", out[2].upper(), out[3].replace(" ", "\t\n"), "", " \n\t", "x", "one two three", words(rng, 30_000, 5000), None, None]
    shared = words(rng, 45, 10_000)
    out += [words(rng, 20) + " " + shared + " " + words(rng, 10), shared, shared + " " + shared]
    out += ["a b c été 中文 \U0001f600 \x1c\x85 d", "A-1, b_2; C3!"]
    return out


def documents(spark, values=None):
    values = texts() if values is None else values
    langs = ["en", "de", None]
    rows = [(i, t, langs[i % 3], f"s{i % 4}" if i % 5 else None, None if t is None else len(t), i, "x", "y", "z", "q", "r") for i, t in enumerate(values)]
    if rows:
        rows += [rows[0], rows[-1], (None, rows[0][1], *rows[0][2:]), (None, None, *rows[1][2:])]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)
