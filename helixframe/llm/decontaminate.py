"""Benchmark decontamination with suffix arrays of the training text.

Every task builds suffix arrays over the words of its documents, a few MB of
text at a time (a shard), and looks up every suffix of every benchmark item in
each by binary search. A suffix that is found is extended to the longest
verbatim match at each place where it stands.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import long_rows
from .vectors import U64, alnum_words, blocks, mixed, powers, text_bytes, word_hashes, words

#: Matches that are worked on at a time; the base of the hashes of stretches.
SLICE, BASE = 1 << 20, 0x9FB21C651E98DF25
MATCH = "struct<item_id:string,item_word:int,doc_word:int,n_words:int>"


class Items(NamedTuple):
    """Benchmark items: ids, the hashes of their words one after another and
    the sums of their polynomials, where each item begins, and the suffixes
    that are looked up (item, first word, words that have to match)."""

    ids: list[str | None]
    hashes: np.ndarray
    sums: np.ndarray
    begins: np.ndarray
    item: np.ndarray
    at: np.ndarray
    least: np.ndarray


def items_of(ids: list[str | None], texts: pa.Array, window: int) -> Items:
    data, offsets = text_bytes(texts)
    starts, ends, item = words(data, offsets, alnum_words())
    hashes = np.maximum(word_hashes(data, starts, ends, lower=True), U64(1))
    begins = np.searchsorted(item, np.arange(len(ids) + 1))
    count = np.diff(begins)
    least = np.minimum(count, window)
    n = np.where(count > 0, count - least + 1, 0)
    which = np.repeat(np.arange(len(ids)), n)
    at = begins[which] + np.arange(n.sum()) - np.repeat(n.cumsum() - n, n)
    return Items(ids, hashes, polynomials(hashes), begins, which, at, least[which])


def suffix_array(values: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of values in the order of their first depth values, by prefix
    doubling: each round sorts only those that still tie."""
    n = len(values)
    order = np.argsort(values, kind="stable")
    new = np.empty(n, bool)
    new[:1] = True
    new[1:] = values[order[1:]] != values[order[:-1]]
    rank = np.empty(n + depth, np.int64)
    rank[n:] = -1
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    step = 1
    while step < depth:
        single = new & np.append(new[1:], True)
        place = np.flatnonzero(~single)
        if not len(place):
            break
        tied = order[place]
        key = rank[tied] * (n + 2) + rank[tied + step] + 1
        by = np.argsort(key, kind="stable")
        tied, key = tied[by], key[by]
        order[place] = tied
        fresh = np.ones(len(place), bool)
        fresh[1:] = key[1:] != key[:-1]
        new[place] = fresh
        rank[tied] = place[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        step *= 2
    return order


def found(values: np.ndarray, order: np.ndarray, items: Items, window: int) -> tuple[np.ndarray, np.ndarray]:
    """By binary search, for each suffix of items the range of order whose suffixes begin with its first `least` words. values are padded with window zeros."""
    n = len(order)
    first = values[order]
    lo0 = np.searchsorted(first, items.hashes[items.at], "left")
    hi0 = np.searchsorted(first, items.hashes[items.at], "right")
    low, high = lo0.copy(), hi0.copy()
    live = np.flatnonzero(hi0 > lo0)
    if not len(live) or not n:
        return low, low
    query = items.hashes[np.minimum(items.at[live][:, None] + np.arange(window), len(items.hashes) - 1)]
    asked = np.arange(window) < items.least[live][:, None]
    for upper, bound in ((False, low), (True, high)):
        lo, hi = lo0[live], hi0[live]
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            here = values[order[np.minimum(mid, n - 1)][:, None] + np.arange(window)]
            differ = (here != query) & asked
            k = differ.argmax(1)
            row = np.arange(len(k))
            some = differ[row, k]
            go = np.where(some, here[row, k] < query[row, k], upper)
            lo = np.where(open_ & go, mid + 1, lo)
            hi = np.where(open_ & ~go, mid, hi)
        bound[live] = lo
    return low, high


def matches(values: np.ndarray, order: np.ndarray, items: Items, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Longest matches of item suffixes, SLICE at a time: item, word in the
    item, place in values, words. Those that go on to the left are left out, as
    the suffix one word longer has them: the words before the suffixes of a
    range come in runs, and a run of the item's own word is passed over as one,
    so that what is looked at is at most twice what is found."""
    low, high = found(values, order, items, window)
    if not len(order):
        return
    before = np.where(order > 0, values[order - 1], U64(0))
    starts = np.flatnonzero(np.append(True, before[1:] != before[:-1]))
    ends = np.append(starts[1:], len(order))
    some = np.flatnonzero(high > low)
    first = np.searchsorted(starts, low[some], "right") - 1
    many = np.searchsorted(starts, high[some] - 1, "right") - first
    sums = polynomials(values)
    for lo, hi in slices(many):
        row, run = spread(many[lo:hi], first[lo:hi])
        row = some[lo:hi][row]
        own = items.at[row] > items.begins[items.item[row]]
        fresh = ~own | (before[starts[run]] != items.hashes[items.at[row] - 1])
        row, run = row[fresh], run[fresh]
        a, b = np.maximum(starts[run], low[row]), np.minimum(ends[run], high[row])
        for x, y in slices(b - a):
            which, at = spread((b - a)[x:y], a[x:y])
            yield extended(values, sums, order[at], items, row[x:y][which])


def slices(counts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows with SLICE of counts in all, or one row."""
    total = np.cumsum(counts)
    lo = 0
    while lo < len(counts):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + SLICE, "right")))
        yield lo, hi
        lo = hi


def spread(counts: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row its number, counts times, and the numbers from begins on."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, begins[row] + np.arange(len(row)) - np.repeat(counts.cumsum() - counts, counts)


def polynomials(values: np.ndarray) -> np.ndarray:
    """Sums over the values before each place, of which differences tell stretches of values apart."""
    sums = np.zeros(len(values) + 1, U64)
    with np.errstate(over="ignore"):
        np.cumsum(mixed(values, 5) * powers(BASE, len(values) + 1)[0][: len(values)], out=sums[1:])
    return sums


def extended(values: np.ndarray, sums: np.ndarray, place: np.ndarray, items: Items, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Matches of items' suffixes at places with the words that they have in common, by bisection over hashes of stretches."""
    at, length = items.at[row], items.least[row].copy()
    most = np.minimum(items.begins[items.item[row] + 1] - at, len(values) - place)
    down = powers(BASE, max(len(values), len(items.hashes)) + 1)[1]
    same = lambda k, n: (sums[place[k] + n] - sums[place[k]]) * down[place[k]] == (items.sums[at[k] + n] - items.sums[at[k]]) * down[at[k]]
    with np.errstate(over="ignore"):
        # most matches end at once
        live = np.flatnonzero(length < most)
        live = live[values[place[live] + length[live]] == items.hashes[at[live] + length[live]]]
        low, high = length[live] + 1, most[live]
        while len(open_ := np.flatnonzero(low < high)):
            mid = (low[open_] + high[open_] + 1) // 2
            ok = same(live[open_], mid)
            low[open_] = np.where(ok, mid, low[open_])
            high[open_] = np.where(ok, high[open_], mid - 1)
    length[live] = low
    return items.item[row], at - items.begins[items.item[row]], place, length


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = 16 << 20, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id_col, n_words, n_hit, matches, keep...) for every row of docs.

    A match is a longest verbatim run of at least `window` words that a
    document shares with an item (or a whole item that is shorter): item_id,
    first word in the item, first word in the document, words. n_hit counts
    the document's words inside matches. Null texts have no words, items
    without words match nothing; an item whose id is null hits words under a
    null item_id; equal item ids count as one item, repeated rows of docs stay
    repeated and their ids are not looked at. A column of docs with a name of
    the result's is not read, nor is any other column.

    The items are sent to the tasks in blocks of at most block_bytes of text
    (or of one item); the tasks take one block at a time, so neither the
    driver nor a task holds more of the benchmark than that."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-2 * total // block_bytes)) if total > block_bytes else 1
    sent = []
    for k in range(n_blocks):
        rows = (items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == k) if n_blocks > 1 else items).collect()
        sent.append(spark.sparkContext.broadcast(items_of([r["item"] for r in rows], pa.array([r["text"] for r in rows], pa.large_string()), window)))

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            data, offsets = text_bytes(column)
            for lo, hi in blocks(offsets):
                part, cuts = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                starts, ends, doc = words(part, cuts, alnum_words())
                hashes = np.maximum(word_hashes(part, starts, ends, lower=True), U64(1))
                n_docs = hi - lo
                begins = np.searchsorted(doc, np.arange(n_docs + 1))
                # a zero between documents, so that no match goes over an end
                values = np.zeros(len(hashes) + n_docs + window, U64)
                values[np.arange(len(hashes)) + doc] = hashes
                order = suffix_array(values[: len(values) - window], window)
                hit = np.zeros(len(values) + 1, np.int64)
                first = begins[:-1] + np.arange(n_docs)
                rows, names = [], []
                for block in sent:
                    some = block.value
                    for item, word, place, length in matches(values, order, some, window):
                        np.add.at(hit, place, 1)
                        np.add.at(hit, place + length, -1)
                        whose = np.searchsorted(first, place, "right") - 1
                        rows.append(np.stack([whose, word, place - first[whose], length]).astype(np.int32))
                        names.append(pa.array(some.ids, pa.string()).take(pa.array(item)))
                    if len(sent) > 1:
                        del block._value
                covered = (np.cumsum(hit)[: len(values)] > 0)[np.arange(len(hashes)) + doc]
                n_hit = np.bincount(doc[covered], minlength=n_docs)
                whose, word, place, length = np.concatenate(rows, 1) if rows else np.zeros((4, 0), np.int32)
                by = np.argsort(whose, kind="stable")
                name = pa.concat_arrays(names).take(pa.array(by)) if names else pa.array([], pa.string())
                found_ = pa.StructArray.from_arrays([name, *(pa.array(x[by]) for x in (word, place, length))], ["item_id", "item_word", "doc_word", "n_words"])
                ends_ = pa.array(np.searchsorted(whose[by], np.arange(n_docs + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, n_docs), pa.array(np.diff(begins)), pa.array(n_hit.astype(np.int64)), pa.ListArray.from_arrays(ends_, found_), *(c.slice(lo, n_docs) for c in batch.columns[2:])],
                    ["id", "n_words", "n_hit", "matches", *batch.schema.names[2:]],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = long_rows(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *(F.col(c).alias(f"k{k}") for k, c in enumerate(keep)))
    fields = "".join(f", {f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[2:])
    out = rows.mapInArrow(run, f"id {kind}, n_words long, n_hit long, matches array<{MATCH}>{fields}")
    return out.select(F.col("id").alias(id_col), "n_words", "n_hit", "matches", *(F.col(f"k{k}").alias(c) for k, c in enumerate(keep)))


def contamination_digests(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    ids = F.array_sort(F.array_distinct(F.filter(F.transform("matches", lambda m: m["item_id"]), lambda x: x.isNotNull())))
    return contamination(docs, benchmark).select("doc_id", "n_words", "n_hit", F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


SQL = r"""
WITH said AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 10) AS n FROM items WHERE len(w) > 0),
asked AS (
  SELECT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
sizes AS (SELECT DISTINCT n FROM asked),
heard AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM said, sizes)),
hits AS (SELECT h.doc_id, h.i, h.n, a.item_id FROM heard h JOIN asked a ON h.n = a.n AND h.win = a.win),
hit_words AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS at FROM hits),
n_hits AS (SELECT doc_id, count(*) AS n_hit FROM hit_words GROUP BY doc_id),
n_items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM said s LEFT JOIN n_hits h ON s.doc_id = h.doc_id LEFT JOIN n_items i ON s.doc_id = i.doc_id
"""
