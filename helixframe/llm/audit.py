"""How filters of texts interact, over every order in which they can be applied.

A document is a mask, one bit for each filter that it fails, and all that an
order of filters does to a part of the table follows from the part's counts by
mask. The orders are visited by adjacent transpositions, so that one differs
from the next in two neighbouring steps: only these are computed anew, from the
cells of the mask table. What a filter removes is added up along the walk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import long_rows, written

FILTERS = "ABCDE"
#: Of each cell of the mask table: documents, good ones, toxic ones.
KINDS = ("n", "good", "toxic")
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def transpositions(n: int) -> Iterator[tuple[list[int], int | None]]:
    """All orders of n things, each with the place of the two neighbours that were swapped to reach it."""
    order = list(range(n))
    toward = [-1] * n
    yield list(order), None
    while True:
        free = [x for x in order if 0 <= (to := order.index(x) + toward[x]) < n and order[to] < x]
        if not free:
            return
        x = max(free)  # the largest thing that has a smaller one before it
        at = order.index(x)
        to = at + toward[x]
        order[at], order[to] = order[to], order[at]
        for y in range(x + 1, n):
            toward[y] = -toward[y]
        yield list(order), min(at, to)


def step_counts(cells: np.ndarray, before: int, own: int) -> np.ndarray:
    """COUNTS of filter own after the filters of the set before; cells: parts x masks x KINDS."""
    masks = np.arange(cells.shape[1])
    bit = 1 << own
    fails, gone = (masks & bit) > 0, (masks & before) > 0
    lost = cells[:, fails & ~gone].sum(1)
    n = cells[:, :, 0]
    return np.stack([n[:, ~fails & ~gone].sum(1), lost[:, 0], n[:, fails & gone].sum(1), n[:, bit], lost[:, 1], lost[:, 2]], 1)


def walked(cells: np.ndarray, filters: int) -> tuple[list[list[int]], np.ndarray, np.ndarray]:
    """All orders; COUNTS as orders x parts x steps x counts; what each filter removes over all orders, parts x filters."""
    orders, every = [], []
    shapley = np.zeros((len(cells), filters), np.int64)
    now = np.zeros((len(cells), filters, len(COUNTS)), np.int64)
    for order, swapped in transpositions(filters):
        for step in range(filters) if swapped is None else (swapped, swapped + 1):
            now[:, step] = step_counts(cells, sum(1 << x for x in order[:step]), order[step])
        shapley[:, order] += now[:, :, 1]
        orders.append(order)
        every.append(now.copy())
    return orders, np.stack(every), shapley


def interactions(cells: DataFrame, filters: str = FILTERS) -> DataFrame:
    """A row for each part, order and step from rows (part, cells): cells is an array of (mask, n, good, toxic), one or none for each mask."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            table = np.zeros((batch.num_rows, 1 << len(filters), len(KINDS)), np.int64)
            flat = batch.column(1).flatten()
            row = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(batch.column(1).offsets)))
            mask = flat.field("mask").to_numpy(zero_copy_only=False)
            for k, name in enumerate(KINDS):
                np.add.at(table[:, :, k], (row, mask), flat.field(name).to_numpy(zero_copy_only=False))
            orders, every, shapley = walked(table, len(filters))
            for order, counts in zip(orders, every, strict=True):
                steps = np.tile(np.arange(1, len(filters) + 1, dtype=np.int32), batch.num_rows)
                name = pa.array(["".join(filters[x] for x in order)] * len(steps))
                part = batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), len(filters))))
                values = counts.reshape(-1, len(COUNTS))
                yield pa.RecordBatch.from_arrays([part, name, pa.array(steps), *(pa.array(values[:, k].copy()) for k in range(len(COUNTS))), pa.array(shapley[:, order].ravel())], ["part", "filter_order", "step", *COUNTS, "shapley"])

    return long_rows(cells).select("part", "cells").mapInArrow(run, f"part string, filter_order string, step int, {', '.join(f'{c} long' for c in COUNTS)}, shapley long")


def text_failures(text: Column) -> list[Column]:
    """Failures of filters A to D."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    return [
        n < 200,
        100 * F.size(F.array_distinct(words)) < 50 * n,
        100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 2 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, filter_order, step, COUNTS, shapley): one row for each part of docs, order of the filters A to E and step.

    A null text is empty, and a null part the empty string. Filter E fails a
    document if a smaller id has the same text anywhere in docs (texts meet by
    their SHA-256); one without an id never fails it and fails no other.
    Repeated rows count as often as they occur. A document is good or toxic if
    any row of labels with its id has quality or toxic 1; labels of unknown or
    null ids are not used. Other columns are not read; an empty table gives an
    empty result."""
    text = F.coalesce(text_col, F.lit(""))
    bits = [F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(text_failures(text))]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask + bit
    # texts stay where they are: what moves from here on is their digests
    each = docs.select(F.col(id_col).alias("id"), F.coalesce(part_col, F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), mask.alias("mask"))
    each = written(each, "masks")
    first = each.groupBy("digest").agg(F.min("id").alias("id")).where("id is not null").withColumn("first", F.lit(True))
    named = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(F.max(F.expr("quality <=> 1")).alias("good"), F.max(F.expr("toxic <=> 1")).alias("toxic"))
    copy = F.col("first").isNull() & F.col("id").isNotNull()
    known = each.join(first, ["digest", "id"], "left").join(named, "id", "left").withColumn("mask", F.col("mask") + F.when(copy, 1 << 4).otherwise(0))
    count = lambda c: F.count(F.when(F.col(c), 1)).alias(c)
    cells = known.groupBy("part", "mask").agg(F.count("*").alias("n"), count("good"), count("toxic"))
    return interactions(cells.groupBy("part").agg(F.collect_list(F.struct("mask", *KINDS)).alias("cells")))  # 32 cells a part at most


#: Needs ids without repetition or null.
SQL = """
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
fails AS MATERIALIZED (
  SELECT part, list_value(
      len(w) < 200,
      100 * len(list_distinct(w)) < 50 * len(w),
      100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 2 * length(text),
      regexp_matches(text, '[#$%&*|]'),
      doc_id > min(doc_id) OVER (PARTITION BY text)) AS f,
    coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic
  FROM words LEFT JOIN labels USING (doc_id)),
cells AS MATERIALIZED (SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM fails GROUP BY ALL),
filters AS (SELECT unnest([1, 2, 3, 4, 5]) AS k),
orders AS (
  SELECT [a.k, b.k, c.k, d.k, e.k] AS o FROM filters a, filters b, filters c, filters d, filters e
  WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
steps AS (SELECT o, s AS step, o[s] AS own, o[:s - 1] AS before FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS s)),
counts AS (
  SELECT part, o, step, own,
    sum(n) FILTER (NOT gone AND NOT f[own]) AS kept, sum(n) FILTER (NOT gone AND f[own]) AS removed, sum(n) FILTER (gone AND f[own]) AS redundant,
    sum(n) FILTER (f[own] AND len(list_filter(f, lambda x: x)) = 1) AS unique_fails,
    sum(good) FILTER (NOT gone AND f[own]) AS good_lost, sum(toxic) FILTER (NOT gone AND f[own]) AS toxic_lost
  FROM (SELECT *, len(list_filter(before, lambda k: f[k])) > 0 AS gone FROM cells, steps) GROUP BY ALL)
SELECT part, array_to_string(list_transform(o, lambda k: 'ABCDE'[k]), '') AS filter_order, step::INTEGER AS step,
  coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
  coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
FROM counts
"""
