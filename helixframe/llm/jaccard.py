"""Near-duplicates by the Jaccard similarity of word shingles.

Candidates come from SimHash by anchor-point covering, as in simhash.py, and,
for what its threshold cannot reach (at a similarity of 0.8 some ten of 64 bits
differ), from bands of HyperMinHash registers, as in hyperminhash.py, whose
steps also confirm every link on the whole sets of shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from .hyperminhash import BATCH, SEED, U64, distinct, similar, sketches
from .shared import batches_of, written


def _sets(rows: DataFrame, words: int) -> DataFrame:
    """(id, tid, sid, n, fp, sketch): sid stands for the set of shingles, n is its size, fp the SimHash of the text."""

    def run(batches):
        for batch in batches:
            every = [simhash.shingle_hashes(x.as_py(), words) for x in batch.column(2).cast(pa.large_binary())]
            sets = [distinct(h) for h in every]
            ids = (np.fromiter(x, U64, len(sets)).view(np.int64) for x in ((xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets), map(simhash.fingerprint, every)))
            sketch = pa.array([x.tobytes() for x in sketches(sets)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(next(ids)), pa.array(list(map(len, sets)), pa.int32()), pa.array(next(ids)), sketch], ["id", "tid", "sid", "n", "fp", "sketch"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, tid long, sid long, n int, fp long, sketch binary")


def _whole(rows: DataFrame, words: int) -> DataFrame:
    """(sid, hashes) of rows (sid, text)."""

    def run(batches):
        for batch in batches:
            sets = [distinct(simhash.shingle_hashes(x.as_py(), words)).tobytes() for x in batch.column(1).cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["sid", "hashes"])

    return rows.mapInArrow(run, "sid long, hashes binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, t: int = 4) -> DataFrame:
    """(id_col, component_id) for every row of docs.

    Texts link whose sets of word shingles have percent per cent or more of
    their union in common; component_id is the smallest id reachable over links,
    null if all are null. Equal sets meet first, in an aggregate. Null and blank
    texts are one set, which is like no other. Other columns are not read; an
    empty table gives an empty result. Equal 64-bit hashes are taken as equal
    texts, sets and shingles; for percent below 80 more pairs are missed, as the
    bands are made for 80."""
    with batches_of(docs.sparkSession, BATCH):
        rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).select("id", F.xxhash64("text").alias("tid"), "text")
        each = written(_sets(rows, words), "sets")
        of_set = each.groupBy("sid").agg(F.min("id").alias("first"), F.min("tid").alias("tid"), F.first("n").alias("n"), F.min("fp").alias("fp"), F.first("sketch").alias("sketch"))
        of_set = written(of_set, "distinct")
        some = of_set.where("n > 0")

        # SimHash: a star for each fingerprint, and a link between two for each link of theirs
        head = some.groupBy("fp").agg(F.min("sid").alias("head"))
        star = some.select("sid", "fp").join(head, "fp").where("sid <> head").select(F.col("head").alias("a"), F.col("sid").alias("b"))
        near = simhash.links(head.select("fp"), t)
        of = lambda c: head.select(F.col("fp").alias(c), F.col("head").alias(f"{c}2"))
        near = near.join(of("a"), "a").join(of("b"), "b").select(F.col("a2").alias("a"), F.col("b2").alias("b"))

        def sets_of(wanted: DataFrame) -> DataFrame:
            known = wanted.join(some.select("sid", "tid"), "sid")
            return _whole(rows.select("tid", "text").join(known, "tid").dropDuplicates(["sid"]).select("sid", "text"), words)

        roots = similar(some, sets_of, percent, star.unionByName(near))
    of = of_set.join(roots.withColumnRenamed("node", "sid"), "sid", "left").select("sid", "first", F.coalesce("root", "sid").alias("root"))
    smallest = of.groupBy("root").agg(F.min("first").alias("component_id"))
    of = of.join(smallest, "root").select("sid", "component_id")
    return each.select("id", "sid").join(of, "sid").select(F.col("id").alias(id_col), "component_id")
