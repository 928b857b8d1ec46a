"""run() against a brute-force pipeline on a small corpus."""

import hashlib
import random

import corpus_pipeline
import numpy as np
import pytest
from helixframe.llm.queries import default_tokenizer

from .helpers import words
from .test_decontaminate import brute as hits
from .test_jaccard import brute_classes
from .test_substrings import brute_cut, brute_gone

tokenizers = pytest.importorskip("tokenizers")


def corpus():
    rng = random.Random(12)
    docs = [(i, " ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=3)) + "\n" + words(rng, rng.randrange(30, 200), 3000), ["en", "de"][i % 2], "s", 0) for i in range(60)]
    long = words(rng, 600, 9000)
    passage = words(rng, 60, 9000)
    item = words(rng, 25, 9000)
    more = [docs[3][1], long, long.replace(" ", "  ", 1), long + " tail", None, "", "123 456", passage + " " + words(rng, 40, 9000), words(rng, 40, 9000) + " " + passage, words(rng, 20, 9000) + " " + item]
    return docs + [(100 + i, t, "en", "s", 0) for i, t in enumerate(more)], [(0, item), (1, words(rng, 30, 9000))]


def test_stages(spark, tmp_path):
    docs, items = corpus()
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "substring_dedup", "decontamination", "byte_bpe"]
    got = sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect()))

    left = [(i, t) for i, t, *_ in docs if t and any(c.isalpha() for c in t)]
    classes = brute_classes(left)
    left = [x for x, c in zip(left, classes, strict=True) if x[0] == c]
    assert len(left) < len(docs) - 4
    want, changed = [], 0
    theirs = tokenizers.Tokenizer.from_file(default_tokenizer())
    for (i, text), gone in zip(left, brute_gone(left, 20), strict=True):
        text = brute_cut(text, gone)
        changed += any(gone)
        if not all(gone) and not hits(text, items)[1]:
            ids = theirs.encode(text, add_special_tokens=False).ids
            want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert changed and len(want) < len(left)
    assert got == sorted(want)


def test_further_columns_with_clashing_names(spark, tmp_path):
    docs, items = corpus()
    names = ("first", "id", "fp", "sid", "key", "lang_pred", "kept", "n_hit", "component_id", "chunk", "__text")
    df = spark.createDataFrame([(*r, *("z" for _ in names)) for r in docs], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES:
        wide = sorted(map(tuple, stage(spark, df, str(tmp_path)).collect()), key=str)
        assert wide == sorted(map(tuple, stage(spark, df.select(*corpus_pipeline.COLUMNS), str(tmp_path)).collect()), key=str)


def test_columns_of_stages(spark, tmp_path):
    docs, items = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, str(tmp_path))
        assert out.columns == df.columns and [f.dataType for f in out.schema] == [f.dataType for f in df.schema], name
        assert stage(spark, df.limit(0), str(tmp_path)).count() == 0
