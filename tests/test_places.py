"""Places along an order, of tables that take several range partitions."""

import pytest
from pyspark.sql import functions as F

from helixframe.operators import fasta, stores

N = 600_000


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("wide") / "rows")
    spark.range(N).select(F.pmod(F.col("id") * 7919, F.lit(N)).alias("id"), F.repeat(F.sha2(F.col("id").cast("string"), 512), 4).alias("seq")).repartition(9).write.parquet(path)
    return spark.read.parquet(path)


def test_places_are_exact(spark, wide):
    got = fasta.numbered(wide, ["id"]).select("id", "place", F.length("seq").alias("n"))
    assert got.where("id <> place or n <> 512").count() == 0
    assert got.agg(F.countDistinct("place"), F.max("place")).first() == (N, N - 1)


def test_parts_are_even(spark, wide):
    got = {r.part: r["count"] for r in fasta.split_round_robin(wide, 4).groupBy("part").count().collect()}
    assert got == dict.fromkeys(range(4), N // 4)


def test_sample_is_exact(spark, wide):
    got = stores.sampled_to_bases(wide.withColumn("n", F.length("seq")), "id", "n", 400_000 * 512, 7)
    assert got.select("id").distinct().count() == 400_000


def test_seeds_in_slices_are_seeds_at_once(spark, monkeypatch):
    """Reads whose k-mers are worked through part by part have the same overlaps and counts, and what was shuffled for a kept table is removed."""
    import glob
    import random

    from helixframe.operators import graph, kmer, overlap

    rng = random.Random(3)
    genome = "".join(rng.choice("ACGT") for _ in range(3000))
    reads = spark.createDataFrame([(k, genome[(at := rng.randrange(2800)) : at + 200]) for k in range(80)], "id long, seq string")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    want, counts = rows(overlap.seed_overlaps(reads, 14, 8, 2)), rows(kmer.count(reads, 14, both_strands=False, least=3))
    monkeypatch.setattr(overlap, "SLICE", 4000)
    parts = overlap.slices(reads)
    assert len(parts) == 4 and rows(overlap.seed_overlaps(reads, 14, 8, 2)) == want and len(want) > 80
    assert sorted(r for part in parts for r in rows(kmer.count(reads, 14, both_strands=False, least=3, part=part))) == counts
    files = lambda: {f for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs() for f in glob.glob(f"{d.getPath()}/**/shuffle_*", recursive=True)}
    before = files()
    out = graph.kept(reads.repartition(3, "id"))
    assert not [f for f in files() - before if f.endswith(".data")]
    assert out.count() == 80
