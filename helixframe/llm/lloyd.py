"""Vector codes by product quantization, its codebooks fitted by the filtering
form of Lloyd's algorithm.

Every partition builds, for each part position of up to CHUNK vectors, a
kd-tree with the bounding box, the sum and the count of each node, and writes
them once. A round sends the codebooks to the trees. A node is reached with the
entries that can still be nearest for some point of its box: an entry goes if
even the corner of the box that lies farthest in its direction is no nearer to
it than to the entry nearest to the box's middle. A node that is left with one
entry gives its whole subtree to it by the cached sum and count; a leaf
compares its points with what is left. Sums and counts of entries are added up
by Spark, and 256 entries a part go back to the driver.

All arithmetic is on integers: products are of 64-bit floats where those hold
all sums exactly, and of 64-bit integers elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import batches_of, written

PARTS, ENTRIES, SCALE, ROUNDS = 4, 256, 1024, 4
#: Numbers of a chunk of vectors, points of a leaf at most.
CHUNK, LEAF = 1 << 18, 16
#: Components beyond this leave no room for exact squares.
MOST = 1 << 26
#: Rows in an Arrow batch: of vectors, and of chunks.
BATCH, TREES = 2000, 4


class Tree(NamedTuple):
    """Points in the order of the leaves; node i has children 2i+1 and 2i+2, and the points from start to end."""

    points: np.ndarray
    order: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray
    start: np.ndarray
    end: np.ndarray


def spans(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the nodes of a tree over n points: each level halves the one above."""
    starts, ends = [np.array([0])], [np.array([n])]
    while (ends[-1] - starts[-1]).max() > LEAF:
        middle = (starts[-1] + ends[-1]) // 2
        starts, ends = [*starts, np.stack([starts[-1], middle], 1).ravel()], [*ends, np.stack([middle, ends[-1]], 1).ravel()]
    return np.concatenate(starts), np.concatenate(ends)


def built(points: np.ndarray) -> Tree:
    """The kd-tree of integer points: a node is cut at the median of its widest side."""
    start, end = spans(len(points))
    order = np.arange(len(points))
    low, high, sums = (np.zeros((len(start), points.shape[1]), np.int64) for _ in range(3))
    for node, (lo, hi) in enumerate(zip(start.tolist(), end.tolist(), strict=True)):
        own = points[order[lo:hi]]
        if not len(own):
            continue
        low[node], high[node], sums[node] = own.min(0), own.max(0), own.sum(0)
        if 2 * node + 1 < len(start):
            side = int((high[node] - low[node]).argmax()) if own.shape[1] else 0
            if own.shape[1]:
                order[lo:hi] = order[lo:hi][np.argpartition(own[:, side], int(end[2 * node + 1]) - lo) if hi - lo > 1 else slice(None)]
    return Tree(points[order], order, low, high, sums, start, end)


def packed(tree: Tree) -> bytes:
    n, d = tree.points.shape
    head = np.array([n, d], "<i8").tobytes()
    return head + tree.points.astype("<i4").tobytes() + tree.order.astype("<i4").tobytes() + tree.low.astype("<i4").tobytes() + tree.high.astype("<i4").tobytes() + tree.sums.astype("<i8").tobytes()


def unpacked(blob: bytes) -> Tree:
    n, d = np.frombuffer(blob, "<i8", 2).tolist()
    start, end = spans(n)
    at, out = 16, []
    for kind, shape in (("<i4", (n, d)), ("<i4", (n,)), ("<i4", (len(start), d)), ("<i4", (len(start), d)), ("<i8", (len(start), d))):
        size = int(np.prod(shape))
        out.append(np.frombuffer(blob, kind, size, at).astype(np.int64).reshape(shape))
        at += size * int(kind[2])
    return Tree(*out, start, end)


def _numbers(codebook: np.ndarray, tree: Tree) -> type:
    most = max((int(np.abs(x).max()) for x in (codebook, tree.low, tree.high) if x.size), default=0)
    return np.float64 if 8 * most * most * max(1, codebook.shape[1]) < 1 << 53 else np.int64


def filtered(tree: Tree, codebook: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray | None]]:
    """What each entry gets: (entry, nodes, None) of whole subtrees, (-1, points, entries) of points of leaves."""
    kind = _numbers(codebook, tree)
    entries = codebook.astype(kind)
    norms = (entries * entries).sum(1)
    index = np.arange(len(entries))
    nodes = np.array([0])
    left = np.ones((1, len(entries)), bool)
    while len(nodes):
        filled = tree.end[nodes] > tree.start[nodes]
        nodes, left = nodes[filled], left[filled]
        if not len(nodes):
            return
        middle = (tree.low[nodes] + tree.high[nodes]).astype(kind)  # twice the middle
        wide = (tree.high[nodes] - tree.low[nodes]).astype(kind)
        away = norms[None, :] - middle @ entries.T
        nearest = np.where(left, away, away.max() + 1).argmin(1)
        for z in np.unique(nearest).tolist():
            own = np.flatnonzero(nearest == z)
            # twice the most by which any point of the box can be nearer to an entry than to z, but for the norms
            gain = norms[z] - norms[None, :] + middle[own] @ (entries - entries[z]).T + wide[own] @ np.abs(entries - entries[z]).T
            left[own] &= (gain > 0) | ((gain == 0) & (index[None, :] < z))
            left[own, z] = True
        alone = left.sum(1) == 1
        for z in np.unique(nearest[alone]).tolist():
            yield z, nodes[alone & (nearest == z)], None
        leaf = ~alone & (2 * nodes + 1 >= len(tree.start))
        for z in np.unique(nearest[leaf]).tolist():
            own = leaf & (nearest == z)
            some = np.flatnonzero(left[own].any(0))
            at = np.concatenate([np.arange(a, b) for a, b in zip(tree.start[nodes[own]].tolist(), tree.end[nodes[own]].tolist(), strict=True)])
            # entries that a box has lost are no nearer for its points, so one list serves all boxes around z
            yield -1, at, some[(norms[some][None, :] - 2 * (tree.points[at].astype(kind) @ entries[some].T)).argmin(1)]
        on = ~alone & ~leaf
        nodes, left = np.stack([2 * nodes[on] + 1, 2 * nodes[on] + 2], 1).ravel(), np.repeat(left[on], 2, axis=0)


def totals(tree: Tree, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts and sums of the points nearest to each entry."""
    counts, sums = np.zeros(len(codebook), np.int64), np.zeros(codebook.shape, np.int64)
    for entry, at, which in filtered(tree, codebook):
        if which is None:
            counts[entry] += (tree.end[at] - tree.start[at]).sum()
            sums[entry] += tree.sums[at].sum(0)
        else:
            counts += np.bincount(which, minlength=len(codebook))
            np.add.at(sums, which, tree.points[at])
    return counts, sums


def assigned(tree: Tree, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each point and the squared distance, in the order in which the points came."""
    nearest = np.zeros(len(tree.points), np.int64)
    for entry, at, which in filtered(tree, codebook):
        if which is None:
            for a, b in zip(tree.start[at].tolist(), tree.end[at].tolist(), strict=True):
                nearest[a:b] = entry
        else:
            nearest[at] = which
    error = ((tree.points - codebook[nearest]) ** 2).sum(1) if len(codebook) else np.zeros(len(tree.points), np.int64)
    out = np.zeros((2, len(nearest)), np.int64)
    out[:, tree.order] = nearest, error
    return out[0], out[1]


def _integers(column: pa.Array, width: int) -> np.ndarray:
    """floor(1024 x) of every component, a row for each vector, with zeros up to a multiple of PARTS."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.floor(flat * SCALE).reshape(len(column), width)
    if whole.size and np.abs(whole).max() > MOST:
        raise ValueError(f"a component beyond {MOST // SCALE} in size leaves no room for exact squares")
    out = np.zeros((len(column), -(-width // PARTS) * PARTS), np.int64)
    out[:, :width] = whole
    return out


def grown(vectors: DataFrame, width: int) -> DataFrame:
    """Rows (ids, labels, trees) of chunks of vectors (vec_id, label, x): each has PARTS trees."""

    def chunk(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        values = _integers(rows.column(2), width)
        step = values.shape[1] // PARTS
        trees = [packed(built(values[:, k * step : (k + 1) * step])) for k in range(PARTS)]
        many = pa.array([0, rows.num_rows], pa.int32())
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(many, rows.column(0)), pa.ListArray.from_arrays(many, rows.column(1)), pa.array([trees], pa.list_(pa.binary()))], ["ids", "labels", "trees"])

    def run(batches):
        held, n, most = [], 0, max(ENTRIES, CHUNK // max(1, width))
        for batch in batches:
            for lo in range(0, batch.num_rows, most):
                held.append(batch.slice(lo, most))
                n += held[-1].num_rows
                if n >= most:
                    yield chunk(held)
                    held, n = [], 0
        if n:
            yield chunk(held)

    kinds = [vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label")]
    return vectors.select("vec_id", "label", "x").mapInArrow(run, f"ids array<{kinds[0]}>, labels array<{kinds[1]}>, trees array<binary>")


def improved(trees: DataFrame, codebooks: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round over all trees."""

    def run(batches):
        counts = [np.zeros(len(x), np.int64) for x in codebooks]
        sums = [np.zeros(x.shape, np.int64) for x in codebooks]
        for batch in batches:
            for row in batch.column(0):
                for k, blob in enumerate(row):
                    c, s = totals(unpacked(blob.as_buffer()), codebooks[k])
                    counts[k] += c
                    sums[k] += s
        used = [(k, z) for k in range(PARTS) for z in np.flatnonzero(counts[k]).tolist()]
        if used:
            yield pa.RecordBatch.from_arrays([pa.array([u[0] for u in used], pa.int32()), pa.array([u[1] for u in used], pa.int32()), pa.array([int(counts[k][z]) for k, z in used], pa.int64()), pa.array([sums[k][z].tolist() for k, z in used], pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    step = codebooks[0].shape[1]
    each = trees.select("trees").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    new = [x.copy() for x in codebooks]
    for row in each.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.get("sums", F.lit(i))) for i in range(step))).alias("sums")).collect():  # ENTRIES a part at most
        if step:
            new[row.part][row.entry] = np.array(row.sums, np.int64) // row.n
    return new


def coded(trees: DataFrame, codebooks: list[np.ndarray]) -> DataFrame:
    """(vec_id, label, code, error) of all vectors in trees."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                both = [assigned(unpacked(blob.as_buffer()), codebooks[k]) for k, blob in enumerate(batch.column(2)[row])]
                codes = np.stack([x[0] for x in both], 1).astype(np.uint8)
                text = pa.array([x.tobytes().hex() for x in codes])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, 1).flatten(), batch.column(1).slice(row, 1).flatten(), text, pa.array(sum(x[1] for x in both))], ["vec_id", "label", "code", "error"])

    kinds = [trees.schema[c].dataType.elementType.simpleString() for c in ("ids", "labels")]
    return trees.select("ids", "labels", "trees").mapInArrow(run, f"vec_id {kinds[0]}, label {kinds[1]}, code string, error long")


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id_col, code, error, label_error, codebooks_sha256) of every row with a vector.

    Rows drop out whose vector is null or has a null or non-finite component,
    and so do, with nothing to compare them by, vectors of another length than
    that of the smallest id; zeros fill a length up to a multiple of four.
    The codebooks begin with the vectors of the 256 smallest ids (ties by the
    vectors; null ids last; fewer rows: fewer entries). Repeated rows stay
    repeated, null labels are one label, other columns are not read, and a
    table without a vector gives an empty result. A component beyond 2^16 in
    size is an error: its squares would not be exact."""
    spark = vectors.sparkSession
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("x")).where(F.col("x").isNotNull() & ~bad)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").select("x").limit(ENTRIES).collect()
    width = len(first[0].x) if first else 0
    rows = rows.where(F.size("x") == width)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").select("x").limit(ENTRIES).collect() if any(len(r.x) != width for r in first) else first
    start = _integers(pa.array([r.x for r in first], pa.list_(pa.float64())), width)
    step = start.shape[1] // PARTS
    codebooks = [start[:, k * step : (k + 1) * step] for k in range(PARTS)]

    with batches_of(spark, BATCH):
        trees = written(grown(rows, width), "trees")
    with batches_of(spark, TREES):
        for _ in range(ROUNDS):
            codebooks = improved(trees, codebooks)
        each = written(coded(trees, codebooks), "codes")
    digest = hashlib.sha256(",".join(str(v) for book in codebooks for v in book.ravel().tolist()).encode()).hexdigest()
    by_label = each.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    out = each.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return out.select(F.col("vec_id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _round(k: int) -> str:
    """The codebooks after one more round, in SQL."""
    return f"""
near{k} AS MATERIALIZED (
  SELECT vec_id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT p.vec_id, p.part, c.entry, sum((p.v - c.v) * (p.v - c.v))::BIGINT AS d
    FROM parts p JOIN book{k} c ON p.part = c.part AND p.pos = c.pos GROUP BY ALL) GROUP BY ALL),
book{k + 1} AS MATERIALIZED (
  SELECT c.part, c.entry, c.pos, coalesce(m.v, c.v) AS v FROM book{k} c LEFT JOIN (
    SELECT part, entry, pos, floor(sum(v)::DOUBLE / count(*))::BIGINT AS v FROM near{k} JOIN parts USING (vec_id, part) GROUP BY ALL) m
  USING (part, entry, pos))"""


#: Needs ids without repetition.
SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)))),
parts AS MATERIALIZED (
  SELECT vec_id, (i - 1) // (len(x) // 4) AS part, (i - 1) % (len(x) // 4) AS pos, x[i] AS v
  FROM (SELECT vec_id, x, unnest(range(1, len(x) + 1)) AS i FROM kept)),
book0 AS MATERIALIZED (
  SELECT part, entry, pos, v FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < 256) USING (vec_id)),
{",".join(_round(k) for k in range(ROUNDS))},
last AS MATERIALIZED (
  SELECT vec_id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT p.vec_id, p.part, c.entry, sum((p.v - c.v) * (p.v - c.v))::BIGINT AS d
    FROM parts p JOIN book{ROUNDS} c ON p.part = c.part AND p.pos = c.pos GROUP BY ALL) GROUP BY ALL),
codes AS (
  SELECT vec_id, string_agg(printf('%02x', entry::INTEGER), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM last GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, pos)) FROM book{ROUNDS}) AS codebooks_sha256
FROM codes JOIN kept USING (vec_id)
"""
