import zlib
from collections import Counter

import numpy as np
import pytest
from helixframe.llm import sharding
from helixframe.llm.queries import op4_uniform_shards

from .helpers import documents, empty


def test_matrix_adds_up():
    counts = [0, 17, 3, 1000, 1, 0, 250]
    sizes = sharding.piece_sizes(sum(counts), 5, 3).ravel()
    rows = np.array([sharding.matrix_row(counts, sizes, p, 7) for p in range(len(counts))])
    assert (rows >= 0).all()
    assert rows.sum(1).tolist() == counts
    assert rows.sum(0).tolist() == sizes.tolist()


def test_matrix_law():
    """Cells have the mean and variance of hypergeometric counts."""
    counts, sizes = [30, 50, 20], np.array([60, 40])
    draws = np.array([[sharding.matrix_row(counts, sizes, p, s)[0] for p in range(3)] for s in range(3000)])
    for p, n in enumerate(counts):
        mean = n * 0.6
        variance = n * 0.6 * 0.4 * (100 - n) / 99
        assert abs(draws[:, p].mean() - mean) < 0.3
        assert abs(draws[:, p].var() / variance - 1) < 0.15


def test_sizes_slots_and_content(spark, tmp_path):
    path = str(tmp_path / "docs")
    documents(spark).write.parquet(path)
    docs = spark.read.parquet(path)
    got = sharding.uniform_shards(docs.select("doc_id", "text", "shard"), 8, pieces=3).collect()
    by = Counter(r.shard for r in got)
    assert max(by.values()) - min(by.values()) <= 1 and set(by) == set(range(8))
    for s in by:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(by[s]))
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r.doc_id, r.text) for r in docs.collect())


def test_every_place_is_as_likely(spark, tmp_path):
    path = str(tmp_path / "ids")
    spark.range(40, numPartitions=3).write.parquet(path)
    ids = spark.read.parquet(path)
    seen = np.zeros((40, 40))
    for seed in range(60):
        for r in sharding.uniform_shards(ids, 4, seed=seed, pieces=2).collect():
            seen[r.id, r.shard * 10 + r.slot] += 1
    statistic = ((seen - 1.5) ** 2 / 1.5).sum()
    assert abs(statistic - 1600) < 6 * (2 * 1600) ** 0.5


def test_digests(spark, tmp_path):
    documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    for r, text in ((r, t) for r in op4_uniform_shards(spark, str(tmp_path)).collect() for t in [None]):
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < 8
    want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in spark.read.parquet(str(tmp_path / "documents.parquet")).collect())
    assert want == Counter((r.doc_id, r.size, r.text_crc32) for r in op4_uniform_shards(spark, str(tmp_path)).collect())


def test_empty_table(spark):
    assert sharding.uniform_shards(empty(spark), 8).count() == 0


@pytest.mark.parametrize("total", [10**9, 10**12])
def test_matrix_beyond_numpys_counts(total):
    counts = [total // 3, 5, 0, total - total // 3 - 5]
    sizes = sharding.piece_sizes(total, 4, 2).ravel()
    rows = np.array([sharding.matrix_row(counts, sizes, p, 3) for p in range(len(counts))])
    assert (rows >= 0).all() and rows.sum(1).tolist() == counts and rows.sum(0).tolist() == sizes.tolist()
    mean = counts[0] / 8
    assert (abs(rows[0] - mean) < 8 * mean**0.5).all() and len(set(rows[0].tolist())) > 4


@pytest.mark.parametrize("good,bad,n", [(30, 50, 20), (3, 900, 100), (500, 4, 300), (10, 10, 0), (7, 0, 3)])
def test_inversion_has_the_law(monkeypatch, good, bad, n):
    want = np.random.default_rng(1).hypergeometric(good, bad, n, 4000)
    monkeypatch.setattr(sharding, "LARGE", 0)
    rng = np.random.default_rng(2)
    got = np.array([sharding.hypergeometric(rng, good, bad, n) for _ in range(4000)])
    assert abs(got.mean() - want.mean()) <= 0.15 + 0.02 * want.std() and abs(got.std() - want.std()) < 0.12
    assert max(0, n - bad) <= got.min() and got.max() <= min(n, good)


def test_columns_of_any_name(spark, tmp_path):
    rows = [(i, "a", "b", "c", "d") for i in range(20)]
    spark.createDataFrame(rows, "id long, __key string, Key string, piece string, slot string").write.parquet(str(tmp_path / "t"))
    out = sharding.uniform_shards(spark.read.parquet(str(tmp_path / "t")), 2)
    assert out.columns == ["id", "__key", "Key", "piece", "shard", "slot"]
    assert {(r["__key"], r.Key, r.piece) for r in out.collect()} == {("a", "b", "c")}
