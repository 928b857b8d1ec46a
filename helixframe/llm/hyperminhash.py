"""Near-duplicates by HyperMinHash.

A set's hashes are dealt into 256 buckets by their first byte. Of the least
hash of a bucket the register keeps the count of leading zeros (6 bits) and the
MANTISSA bits after the leading one; an empty bucket takes the register of the
first filled one in a fixed random order of its own (optimal densification), so
that a register of two sets is equal with a probability of their Jaccard
similarity, plus what the short register adds by accident.

Sets that agree in all registers of one of BANDS bands are candidates: a pair of
similarity 0.8 shares no band with probability 2.5e-7. The whole sketch then
gives an estimate of the similarity from which accidental agreement is
subtracted, and what falls MARGIN below the threshold is dropped (six standard
deviations of the estimate). What is left is confirmed on the whole sets.

No step makes a row for each pair. A band's sets are first compared with one of
them; then sketches of sets in one band and not yet in one component meet in a
task, which asks for a spanning forest of likely links; and last the sets that
still have a candidate in another component are sent to the first band that the
two share, and compared there. What leaves a task is a forest. A band of many
sets is worked through block by block, a pair of blocks in a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import batches_of, written
from .vectors import U64, blocks, mixed, space_words, text_bytes, window_hashes, word_hashes, words

SEED = 42
BUCKETS, MANTISSA = 256, 10
BANDS, ROWS = 50, 6
MARGIN = 0.18
#: Bands that two sets share before they are compared on sight; the later steps find what this passes over.
LIKELY = 8
#: Members of a band, or of those to compare with one set, in one task, and bytes that their sets have together; a single set may have more.
MOST_MEMBERS, MOST_BYTES = 4096, 16 << 20
#: Texts or sets in an Arrow batch.
BATCH = 1000


def distinct(hashes: np.ndarray) -> np.ndarray:
    hashes = np.sort(hashes)
    return hashes[np.append(True, hashes[1:] != hashes[:-1])] if len(hashes) else hashes


def shingles(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """For each text the 64-bit hashes of its n-word shingles, repeats included; a text of fewer words has one, a null or blank text none."""
    data, offsets = text_bytes(column)
    for lo, hi in blocks(offsets):
        part, cuts = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        starts, ends, doc = words(part, cuts, space_words())
        each = word_hashes(part, starts, ends, lower=True)
        first = np.searchsorted(doc, np.arange(hi - lo + 1))
        windows = window_hashes(each, n, 3)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= n:
                yield windows[a : b - n + 1]
            elif b > a:
                yield window_hashes(each[a:b], b - a, 3)
            else:
                yield np.zeros(0, U64)


@cache
def probes() -> np.ndarray:
    """For each bucket the order in which it looks for a filled one."""
    return np.random.default_rng(SEED).permuted(np.tile(np.arange(BUCKETS, dtype=np.uint8), (BUCKETS, 1)), axis=1)


@cache
def bands() -> tuple[np.ndarray, np.ndarray]:
    """The registers of each band and an odd factor for each."""
    rng = np.random.default_rng(SEED + 1)
    order = np.concatenate([rng.permutation(BUCKETS) for _ in range(-(-BANDS * ROWS // BUCKETS))])
    return order[: BANDS * ROWS].reshape(BANDS, ROWS), rng.integers(0, 1 << 63, (BANDS, ROWS), dtype=U64) << U64(1) | U64(1)


def registers(least: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of the 53 bits after a hash's first byte and before its last three bits."""
    bits = (least & U64((1 << 56) - 1)) >> U64(3)
    zeros = 53 - np.frexp(bits.astype(np.float64))[1].astype(np.int64)
    mantissa = ((bits << zeros.astype(U64)) >> U64(52 - MANTISSA)) & U64((1 << MANTISSA) - 1)
    return (zeros.astype(np.uint16) << np.uint16(MANTISSA)) | mantissa.astype(np.uint16)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A row of registers for each set of ascending hashes; zeros for an empty one."""
    out = np.zeros((len(sets), BUCKETS), np.uint16)
    filled = np.zeros((len(sets), BUCKETS), bool)
    for row, s in enumerate(sets):
        if len(s):
            bucket = (s >> U64(56)).astype(np.int64)
            first = np.flatnonzero(np.diff(bucket, prepend=-1))
            out[row, bucket[first]] = registers(s[first])
            filled[row, bucket[first]] = True
    row, bucket = np.nonzero(~filled & filled.any(1)[:, None])
    order = probes()
    for k in range(BUCKETS):
        if not len(row):
            break
        source = order[bucket, k]
        ok = filled[row, source]
        out[row[ok], bucket[ok]] = out[row[ok], source[ok]]
        row, bucket = row[~ok], bucket[~ok]
    return out


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """A key for each band of each row of registers."""
    which, factor = bands()
    with np.errstate(over="ignore"):
        return mixed(((sketch[:, which].astype(U64) + U64(1)) * factor).sum(2, dtype=U64), 7)


@cache
def _accident(n_step: int, m_step: int) -> float:
    n, m = (2.0 ** (k / 8) for k in (n_step, m_step))
    i, j = np.arange(54)[:, None], np.arange(1 << MANTISSA)[None, :]
    high = 2.0 ** (-i - 1) * (1 + (j + 1) / (1 << MANTISSA)) / BUCKETS
    low = 2.0 ** (-i - 1) * (1 + j / (1 << MANTISSA)) / BUCKETS

    def chance(k):  # that a filled bucket has this register
        return (np.exp(k * np.log1p(-low)) - np.exp(k * np.log1p(-high))) / -np.expm1(k * np.log1p(-1 / BUCKETS))

    return float((chance(n) * chance(m)).sum())


def accident(n: int, m: int) -> float:
    """The probability that a register of two disjoint sets of n and m members is equal, by a grid of eight sizes an octave."""
    return _accident(*(round(8 * np.log2(max(1, x))) for x in (n, m)))


def estimated(equal: np.ndarray, n: np.ndarray, m: int) -> np.ndarray:
    """Jaccard similarities by the number of equal registers, with accidental ones taken off."""
    chance = np.array([accident(int(x), m) for x in np.asarray(n)]) if np.ndim(n) else accident(int(n), m)
    return (equal / BUCKETS - chance) / (1 - chance)


def hashed_sets(rows: DataFrame, n: int) -> DataFrame:
    """(id, tid, sid, n, sketch) of rows (id, tid, text): sid stands for the set of shingles, n is its size."""

    def run(batches):
        for batch in batches:
            sets = [distinct(h) for h in shingles(batch.column(2), n)]
            sid = np.fromiter((xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets), U64, len(sets))
            sketch = pa.array([x.tobytes() for x in sketches(sets)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sid.view(np.int64)), pa.array(list(map(len, sets)), pa.int32()), sketch], ["id", "tid", "sid", "n", "sketch"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, tid long, sid long, n int, sketch binary")


def whole_sets(rows: DataFrame, n: int) -> DataFrame:
    """(sid, hashes) of rows (sid, text): the set's ascending hashes as bytes."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([distinct(h).tobytes() for h in shingles(batch.column(1), n)], pa.binary())], ["sid", "hashes"])

    return rows.mapInArrow(run, "sid long, hashes binary")


def banded(of_set: DataFrame) -> DataFrame:
    """(key, sid) for each band of rows (sid, sketch)."""

    def run(batches):
        for batch in batches:
            sketch = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, BUCKETS)
            sid = np.repeat(batch.column(0).to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(band_keys(sketch).ravel().view(np.int64)), pa.array(sid)], ["key", "sid"])

    return of_set.select("sid", "sketch").mapInArrow(run, "key long, sid long")


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Do two sets of ascending hashes have so many per cent of their union in common."""
    if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def linked_pairs(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The edges (a, b) that hold on the whole sets (sid, hashes).

    A set b goes to its a once, and a's set is sent along once for each unit of MOST_MEMBERS edges."""
    size = edges.groupBy("a").agg(F.count("*").alias("c"))
    unit = F.pmod(F.xxhash64("b"), F.ceil(F.col("c") / MOST_MEMBERS)).cast("int")
    edges = edges.join(size, "a").select("a", "b", unit.alias("unit"))
    rows = edges.select("a", "unit", F.lit(1).alias("rank"), F.col("b").alias("sid")).unionByName(edges.select("a", "unit", F.lit(0).alias("rank"), F.col("a").alias("sid")).distinct())

    def run(batches):
        mine = np.zeros(0, U64)
        for batch in batches:
            a, b = [], []
            for own, rank, sid, blob in zip(*(batch.column(c).to_pylist() for c in ("a", "rank", "sid")), batch.column("hashes"), strict=True):
                theirs = np.frombuffer(blob.as_buffer(), U64)
                if rank == 0:
                    mine = theirs
                elif _alike(mine, theirs, percent):
                    a.append(own)
                    b.append(sid)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    sent = rows.join(sets, "sid").select("a", "unit", "rank", "sid", "hashes")
    return sent.repartition("a", "unit").sortWithinPartitions("a", "unit", "rank").mapInArrow(run, "a long, b long")


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.Table]]:
    """The rows of each unit (columns key, i, j), of batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, i, j = (batch.column(c).to_numpy() for c in range(3))
        new = (np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            own = int(key[lo]), int(i[lo]), int(j[lo])
            if own != last and held:
                yield last, pa.Table.from_batches(held)
                held = []
            last = own
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield last, pa.Table.from_batches(held)


class _Unit:
    """Members of a band whose sketches are compared: a pair counts if its components differ, if sizes and estimate allow the similarity, and if the two share no earlier band."""

    def __init__(self, key: int, i: int, j: int, rows: pa.Table, percent: int) -> None:
        self.sid, self.root, self.n, self.part = (rows[c].to_numpy().copy() for c in ("sid", "root", "n", "part"))
        self.sketch = np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint16).reshape(-1, BUCKETS)
        self.two_parts, self.percent = i != j, percent
        self.band = int(np.flatnonzero(band_keys(self.sketch[:1])[0].view(np.int64) == key)[0])

    def partners(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Earlier members that may link with member k, and the estimates."""
        ok = (self.root[:k] != self.root[k]) & (np.minimum(self.n[:k], self.n[k]) * 100 >= self.percent * np.maximum(self.n[:k], self.n[k]))
        if self.two_parts:
            ok &= self.part[:k] != self.part[k]
        at = np.flatnonzero(ok)
        equal = self.sketch[at] == self.sketch[k]
        # the chance of accidents by the larger size is near enough: sizes differ by a fourth at most
        guess = estimated(equal.sum(1), self.n[k], int(self.n[k]))
        near = guess >= self.percent / 100 - MARGIN
        at, equal, guess = at[near], equal[near], guess[near]
        if len(at) and self.band:
            new = ~equal[:, bands()[0][: self.band]].all(2).any(1)
            at, guess = at[new], guess[new]
        return at, guess


def _forest(percent: int) -> Callable:
    """Of each unit the likeliest links (a, b), as many as join what may be linked."""

    def run(batches):
        for (key, i, j), rows in _units(batches):
            if rows.num_rows < 2:
                continue
            unit = _Unit(key, i, j, rows, percent)
            best: dict[tuple[int, int], tuple[float, int, int]] = {}
            names = unit.root.tolist()
            for k in range(1, len(names)):
                at, guess = unit.partners(k)
                order = np.lexsort((guess, unit.root[at]))
                at, guess = at[order], guess[order]
                last = np.flatnonzero(np.diff(unit.root[at], append=unit.root[k]) != 0)  # of each component the likeliest
                for other, value in zip(at[last].tolist(), guess[last].tolist(), strict=True):
                    pair = min(names[other], names[k]), max(names[other], names[k])
                    best[pair] = max(best.get(pair, (-1.0, 0, 0)), (value, other, k))
            joined = {name: name for name in names}

            def find(x: int, joined: dict[int, int] = joined) -> int:
                while joined[x] != x:
                    joined[x] = x = joined[joined[x]]
                return x

            a, b = [], []
            for (p, q), (_, other, k) in sorted(best.items(), key=lambda x: x[1], reverse=True):
                p, q = find(p), find(q)
                if p != q:
                    joined[p] = q
                    a.append(other)
                    b.append(k)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(unit.sid[a]), pa.array(unit.sid[b])], ["a", "b"])

    return run


def _may_link(percent: int) -> Callable:
    """(key, i, j, sid, root, part) of the members of a unit that may have a partner in another component."""

    def run(batches):
        for (key, i, j), rows in _units(batches):
            if rows.num_rows < 2:
                continue
            unit = _Unit(key, i, j, rows, percent)
            some = np.zeros(rows.num_rows, bool)
            for k in range(1, rows.num_rows):
                at, _ = unit.partners(k)
                if len(at):
                    some[k] = True
                    some[at] = True
            if some.any():
                yield from rows.select(["key", "i", "j", "sid", "root", "part"]).filter(pa.array(some)).combine_chunks().to_batches()

    return run


def _linked(percent: int) -> Callable:
    """Links (a, b) between sets of a unit that join all that are alike: no more than a forest over the components that came in."""

    def run(batches):
        for (_, i, j), rows in _units(batches):
            sid, root, part = (rows[c].to_numpy().copy() for c in ("sid", "root", "part"))
            sets = [np.frombuffer(x.as_buffer(), U64) for x in rows["hashes"]]
            short = sketches(sets)
            n = np.array(list(map(len, sets)))
            for k in range(1, len(sid)):
                ok = (root[:k] != root[k]) & (np.minimum(n[:k], n[k]) * 100 >= percent * np.maximum(n[:k], n[k]))
                if i != j:
                    ok &= part[:k] != part[k]
                at = np.flatnonzero(ok)
                guess = estimated((short[at] == short[k]).sum(1), n[k], int(n[k]))
                for other in at[np.argsort(-guess, kind="stable")][: int((guess >= percent / 100 - MARGIN).sum())].tolist():
                    if root[other] != root[k] and _alike(sets[other], sets[k], percent):
                        yield pa.RecordBatch.from_arrays([pa.array(sid[[other]]), pa.array(sid[[k]])], ["a", "b"])
                        root[root == root[other]] = root[k]

    return run


def similar(of_set: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int, more: DataFrame | None = None) -> DataFrame:
    """(node, root) for every set of of_set (sid, n, sketch) that is linked with another.

    sets_of gives the whole sets (sid, hashes) of a table of sid. more: further pairs (a, b) to compare."""
    every = banded(of_set)
    keys = every.groupBy("key").agg(F.count("*").alias("c"), F.min("sid").alias("rep")).where("c > 1")
    shared = written(every.join(keys.select("key", "rep"), "key"), "bands")
    likely = shared.where("sid <> rep").groupBy("sid", "rep").agg(F.count("*").alias("c")).where(F.col("c") >= LIKELY)
    stars = likely.groupBy("sid").agg(F.max(F.struct("c", "rep")).alias("best")).select(F.col("best.rep").alias("a"), F.col("sid").alias("b"))
    pairs = stars if more is None else stars.unionByName(more)
    pairs = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "pairs")

    wanted = shared.select("sid").unionByName(pairs.select(F.col("a").alias("sid"))).unionByName(pairs.select(F.col("b").alias("sid"))).distinct()
    sets = written(sets_of(wanted), "whole")
    links = written(linked_pairs(pairs, sets, percent), "links")
    roots = components(links)

    members = shared.join(of_set.select("sid", "n"), "sid").select("key", "sid", "n")
    sketch = of_set.select("sid", "sketch")
    links = links.unionByName(written(linked_pairs(_dealt(_apart(members, roots), sketch).mapInArrow(_forest(percent), "a long, b long").distinct(), sets, percent), "links"))
    roots = components(links)

    left = _dealt(_apart(members, roots), sketch).mapInArrow(_may_link(percent), "key long, i int, j int, sid long, root long, part int")
    left = written(left, "apart")
    last = _dealt(left, sets).mapInArrow(_linked(percent), "a long, b long")
    return components(links.unionByName(last))


def _apart(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members (key, sid, n) of bands that are in more than one component, each to the units (i, j) of its band in which its part meets the others, i <= j."""
    rows = members.join(roots.withColumnRenamed("node", "sid"), "sid", "left").select("key", "sid", "n", F.coalesce("root", "sid").alias("root"))
    several = rows.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("c"), F.sum("n").alias("size")).where("lo <> hi")
    parts = F.greatest(F.ceil(F.col("c") / MOST_MEMBERS), F.ceil(F.col("size") * 8 / MOST_BYTES)).cast("int")
    rows = rows.join(several.select("key", parts.alias("parts")), "key")
    part = F.pmod(F.xxhash64("sid", "key"), F.col("parts")).cast("int")
    unit = F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: F.struct(F.least(x, "part").alias("i"), F.greatest(x, "part").alias("j"))))
    return rows.withColumn("part", part).withColumn("unit", unit).select("key", "unit.i", "unit.j", "sid", "root", "n", "part")


def _dealt(rows: DataFrame, payload: DataFrame) -> DataFrame:
    """rows with the column that payload has for their sid, each unit together."""
    return rows.join(payload, "sid").select(*rows.columns, *payload.columns[1:]).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 2, percent: int = 80) -> DataFrame:
    """(id_col, n_shingles, component_id, kept) for every row of docs.

    Texts link whose sets of word shingles (of lower-cased words; fewer words
    than a shingle has: the whole sequence) have percent per cent or more of
    their union in common; component_id is the smallest id reachable over
    links, and kept says whether it is the row's own. Null and blank texts have
    no shingles and link with nothing. A row without an id takes the smallest
    id of its class, or null, and is kept if that is null. Repeated rows stay
    repeated and are linked; other columns are not read; an empty table gives
    an empty result. Equal 64-bit hashes are taken as equal shingles, sets and
    texts; for percent below 80 more pairs are missed, as the bands are made
    for 80."""
    with batches_of(docs.sparkSession, BATCH):
        rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("tid"), F.col(text_col).alias("text"))
        each = written(hashed_sets(rows, words), "sets")
        of_set = each.where("n > 0").groupBy("sid").agg(F.min("id").alias("first"), F.min("tid").alias("tid"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
        of_set = written(of_set, "distinct")

        def sets_of(wanted: DataFrame) -> DataFrame:
            known = wanted.join(of_set.select("sid", "tid"), "sid")
            return whole_sets(rows.select("tid", "text").join(known, "tid").dropDuplicates(["sid"]).select("sid", "text"), words)

        roots = similar(of_set, sets_of, percent)
    of = of_set.join(roots.withColumnRenamed("node", "sid"), "sid", "left").select("sid", "first", F.coalesce("root", "sid").alias("root"))
    smallest = of.groupBy("root").agg(F.min("first").alias("component_id"))
    of = of.join(smallest, "root").select("sid", "component_id")
    out = each.select("id", "n", "sid").join(of, "sid", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
