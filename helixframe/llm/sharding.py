"""A uniform shuffle into shards of exact sizes, by a hypergeometric
communication matrix.

How many rows of each input partition go to each piece of each shard is drawn
first, from the multivariate hypergeometric law that a uniform permutation of
all rows would give. The matrix is never held as a whole: it is drawn by
halving the range of partitions, each node of that tree from its own seed, so
that a task draws its own row again whenever it needs it, the same each time.
A task then deals its rows out by a local permutation; the exchange sends every
piece to one task; a sort by random keys permutes it again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import long_rows

#: From this many on numpy draws no hypergeometric counts.
LARGE = 1_000_000_000


def piece_sizes(total: int, shards: int, pieces: int) -> np.ndarray:
    """Rows of every piece of every shard: shard sizes differ by one at most, and so do a shard's pieces."""
    each = np.array([total // shards + (s < total % shards) for s in range(shards)], np.int64)
    return np.stack([each // pieces + (p < each % pieces) for p in range(pieces)], 1)


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of n drawn from good and bad are good, for any counts.

    Beyond numpy's limit by inversion: the law's ratios are multiplied up from
    its mode as far as 14 standard deviations and 60 steps to either side, past
    which less than 1e-36 of it is left; the sums are taken in 64-bit floats."""
    total = good + bad
    if total < LARGE:
        return int(rng.hypergeometric(good, bad, n))
    least, most = max(0, n - bad), min(n, good)
    mode = min(most, max(least, (n + 1) * (good + 1) // (total + 2)))
    far = int(14 * (n * (good / total) * (bad / total) * ((total - n) / (total - 1))) ** 0.5) + 60
    up = np.arange(mode, min(most, mode + far), dtype=np.float64)
    down = np.arange(mode, max(least, mode - far), -1, dtype=np.float64)
    rise = np.log(good - up) + np.log(n - up) - np.log(up + 1) - np.log((bad - n) + up + 1)
    fall = np.log(down) + np.log((bad - n) + down) - np.log(good - down + 1) - np.log(n - down + 1)
    weight = np.exp(np.concatenate([np.cumsum(fall)[::-1], [0], np.cumsum(rise)]))
    weight = np.cumsum(weight)
    return mode - len(down) + int(np.searchsorted(weight, rng.random() * weight[-1], "right"))


def dealt_counts(rng: np.random.Generator, left: np.ndarray, n: int) -> np.ndarray:
    """How many of n rows go to each piece, of which left are free in each."""
    total = int(left.sum())
    if total < LARGE:
        return rng.multivariate_hypergeometric(left, n, method="marginals")
    out = np.zeros(len(left), np.int64)
    for k, own in enumerate(left.tolist()):
        total -= own
        out[k] = hypergeometric(rng, own, total, n)
        n -= int(out[k])
    return out


def matrix_row(counts: list[int], sizes: np.ndarray, partition: int, seed: int) -> np.ndarray:
    """Row of the communication matrix: how many of partition's rows go to each piece."""
    before = np.concatenate([[0], np.cumsum(np.asarray(counts, np.int64))])
    left = sizes.astype(np.int64)
    lo, hi = 0, len(counts)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, 1, lo, hi])
        first = dealt_counts(rng, left, int(before[mid] - before[lo]))
        if partition < mid:
            hi, left = mid, first
        else:
            lo, left = mid, left - first
    return left


def _unused(name: str, columns: list[str]) -> str:
    """name, with as many underscores before it as make it differ from all columns, in whatever case."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name = f"_{name}"
    return name


def uniform_shards(rows: DataFrame, shards: int = 8, seed: int = 20240229, pieces: int | None = None, shard_col: str = "shard", slot_col: str = "slot") -> DataFrame:
    """rows with shard_col (0..shards-1) and slot_col (from 0, without gaps in
    a shard): a uniformly random permutation of all rows, cut into shards
    whose sizes differ by one at most.

    rows must give every partition the same rows in the same order each time
    it is computed, as a scan of files does; a partition whose count differs
    between the two passes is an error and never a wrong result. Values are
    not looked at, so nulls, long texts and repeated rows are rows like any
    other; an empty table stays empty. A column of rows named like one of the
    new ones is replaced; all others stay, whatever they are called."""
    spark = rows.sparkSession
    rows = long_rows(rows).drop(shard_col, slot_col)
    counted = rows.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    counts = [0] * (1 + max((r["p"] for r in counted), default=0))
    for r in counted:
        counts[r["p"]] = r["count"]
    total = sum(counts)
    piece_col, key_col, row_col = (_unused(name, rows.columns) for name in ("piece", "key", "row"))
    pieces = pieces or max(1, -(-max(len(counts), int(spark.conf.get("spark.sql.shuffle.partitions"))) // shards))
    sizes = piece_sizes(total, shards, pieces).ravel()
    out = T.StructType([*rows.schema.fields, T.StructField(piece_col, T.IntegerType()), T.StructField(key_col, T.LongType())])

    def deal(batches):
        from pyspark import TaskContext

        p = TaskContext.get().partitionId()
        n = counts[p] if p < len(counts) else 0
        rng = np.random.default_rng([seed, 2, p])
        piece = rng.permutation(np.repeat(np.arange(len(sizes), dtype=np.int32), matrix_row(counts, sizes, p, seed))) if n else np.zeros(0, np.int32)
        at = 0
        for batch in batches:
            mine = piece[at : at + batch.num_rows]
            at += batch.num_rows
            if len(mine) < batch.num_rows:
                raise RuntimeError(f"partition {p} had {n} rows when counted and has more now")
            key = rng.integers(-(1 << 63), (1 << 63) - 1, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(mine), pa.array(key)], names=[*batch.schema.names, piece_col, key_col])
        if at != n:
            raise RuntimeError(f"partition {p} had {n} rows when counted and has {at} now")

    dealt = rows.mapInArrow(deal, out).repartitionById(len(sizes), F.col(piece_col))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    # Rows of a shard's earlier pieces: of a shard of size n its pieces have n div pieces rows, the first n mod pieces one more.
    shard, piece = F.floor(F.col(piece_col) / pieces), F.col(piece_col) % pieces
    size = F.lit(total // shards) + F.when(shard < total % shards, 1).otherwise(0)
    first = piece * F.floor(size / pieces) + F.least(piece, size % pieces)
    keep = [F.col(f"`{c}`") for c in rows.columns]
    return dealt.sortWithinPartitions(key_col).withColumn(row_col, place).select(*keep, shard.cast("int").alias(shard_col), (first + F.col(row_col)).cast("long").alias(slot_col))
