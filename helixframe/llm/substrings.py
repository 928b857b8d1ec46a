"""Exact substring dedup with a count-min prefilter.

Texts are dealt into chunks once, and every pass sees the same chunks. Pass one
counts hashed windows in count-min sketches: a chunk sends the cells that it
counts to the parts of the sketch that hold them, each part adds up what all
chunks have sent and sends back one bit for each cell: was it counted twice. A
cell only ever overestimates, so a window of which one cell was counted once
occurs once. Pass two sends on only windows that the sketch takes to be
repeated and groups those exactly (by 96 bits of two independent hashes); no
repeated window is lost, whatever the sketch's size. Pass three cuts.

The sketch grows with the input, two cells or more for each window, and no task
holds more than one part of it: chunks and parts grow with the square root of
the input, within bounds, and their number does the rest.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import long_rows, memory_returned
from .vectors import U64, blocks, mixed, space_words, text_bytes, window_hashes, word_hashes, words

#: Rows of the sketch.
DEPTH = 2
#: Least and most bytes of text in a chunk; binary logarithms of the cells in a part.
CHUNK, PART_BITS = (8 << 20, 64 << 20), (22, 26)


class Sketch(NamedTuple):
    """Binary logarithms of the cells of a row of the sketch and of a part of it."""

    bits: int
    part_bits: int


def planned(size: int) -> tuple[int, Sketch]:
    """Chunks and sketch for size bytes of text."""
    bits = max(16, (size // 3 + 2).bit_length())  # a word and the space after it have some six bytes
    least, most = PART_BITS
    chunk = min(CHUNK[1], max(CHUNK[0], 50 * int(size**0.5)))
    return -(-size // chunk), Sketch(bits, min(bits, max(least, min(most, bits // 2 + 5))))


def _windows(texts: pa.ChunkedArray, n: int):
    """Of blocks of texts: first row, window hashes, their rows and first words, and a function for another 32 bits of hash of some of the windows."""
    data, offsets = text_bytes(texts.cast(pa.large_string()).combine_chunks())
    for lo, hi in blocks(offsets):
        part, cuts = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        starts, ends, doc = words(part, cuts, space_words())
        if len(starts) < n:
            continue
        whole = np.flatnonzero(doc[: len(doc) - n + 1] == doc[n - 1 :])
        if not len(whole):
            continue
        first = np.searchsorted(doc, np.arange(hi - lo))

        def second(some: np.ndarray, part=part, starts=starts, ends=ends, whole=whole) -> np.ndarray:
            other = window_hashes(word_hashes(part, starts, ends, lower=False, salt=1), n, 2)
            return (other[whole[some]] >> U64(32)).astype(np.uint32)

        hashes = window_hashes(word_hashes(part, starts, ends, lower=False), n, 1)[whole]
        yield lo, hashes, doc[whole], (whole - first[doc[whole]]).astype(np.uint32), second


def _cells(h: np.ndarray, row: int, sketch: Sketch) -> np.ndarray:
    return mixed(h, 100 + row) >> U64(64 - sketch.bits)


def packed(cells: np.ndarray, bits: int) -> bytes:
    """Ascending numbers below 2^bits: their low bits as they are, the high ones as a bitmap in which number i of high part x is bit x + i."""
    n = len(cells)
    size = lambda low: n * low // 8 + ((1 << max(0, bits - low)) + n) // 8
    low = min((8, 16), key=size)
    high = np.zeros((1 << max(0, bits - low)) + n, bool)
    high[(cells >> U64(low)).astype(np.int64) + np.arange(n)] = True
    return bytes([low]) + np.uint32(n).tobytes() + (cells & U64((1 << low) - 1)).astype(f"<u{low // 8}").tobytes() + np.packbits(high).tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    low, n = blob[0], int(np.frombuffer(blob, "<u4", 1, 1)[0])
    lows = np.frombuffer(blob, f"<u{low // 8}", n, 5)
    high = np.flatnonzero(np.unpackbits(np.frombuffer(blob, np.uint8, -1, 5 + n * low // 8))) - np.arange(n)
    return high << low | lows


def _sketch(n: int, sketch: Sketch) -> Callable:
    """A chunk's cells, of each only two, by row << 40 | part."""

    def run(key, texts):
        memory_returned()
        have = [w[1] for w in _windows(texts["text"], n)]
        parts, blobs = [], []
        for row in range(DEPTH if have else 0):
            cells = np.sort(_cells(np.concatenate(have), row, sketch))
            if len(cells) > 2:  # a third count changes nothing
                cells = cells[np.append([True, True], cells[2:] != cells[:-2])]
            part = (cells >> U64(sketch.part_bits)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
            mask = U64((1 << sketch.part_bits) - 1)
            parts += (row << 40 | part[cuts]).tolist()
            blobs += [packed(cells[lo:hi] & mask, sketch.part_bits) for lo, hi in zip(cuts, [*cuts[1:], len(cells)], strict=True)]
        return pa.table({"chunk": pa.array([key[0].as_py()] * len(parts), pa.int32()), "part": pa.array(parts, pa.int64()), "cells": pa.array(blobs, pa.binary())})

    return run


def _merge(sketch: Sketch) -> Callable:
    """Of a part of the sketch: to every chunk a bit for each different cell that it sent, set if the cell's count is two or more."""

    def run(key, rows):
        counts = np.zeros(1 << sketch.part_bits, np.uint8)
        every = []
        for blob in rows["cells"]:
            cells = unpacked(blob.as_py())
            again = np.append(False, cells[1:] == cells[:-1])
            own = cells[~again]
            counts[own] = np.minimum(counts[own], 2) + 1
            counts[cells[again]] = 2
            every.append(own.astype(np.uint32))
        marks = [np.packbits(counts[own] >= 2).tobytes() for own in every]
        return pa.table({"chunk": rows["chunk"], "part": rows["part"], "marks": pa.array(marks, pa.binary())})

    return run


def _marked(h: np.ndarray, row: int, sketch: Sketch, parts: np.ndarray, marks: list[bytes], of: np.ndarray) -> np.ndarray:
    """Which of the windows of have cells in a row that were counted twice; h are all the chunk's windows."""
    cells = _cells(h, row, sketch)
    cells = cells[order := np.argsort(cells)]
    first = np.append(True, cells[1:] != cells[:-1])
    part = (cells[first] >> U64(sketch.part_bits)).astype(np.int64)
    cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
    at = np.searchsorted(parts, row << 40 | part[cuts[:-1]])
    bits = [np.unpackbits(np.frombuffer(marks[k], np.uint8), count=hi - lo) for k, lo, hi in zip(at.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    twice = np.empty(len(h), bool)
    twice[order] = np.concatenate(bits)[np.cumsum(first) - 1]
    return twice[of]


SENT = "shard int, doc_ids array<long>, text_hashes array<long>, counts array<int>, h1 binary, h2 binary, at binary"
SENT_NAMES = [f.split()[0] for f in SENT.split(", ")]
SENT_KINDS = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary()]


def _candidates(n: int, sketch: Sketch, shards: int) -> Callable:
    """Windows taken to be repeated, once for each chunk, by the shard of their
    hashes; those that the chunk itself has earlier are settled and go by their
    chunk as shard -1 - chunk."""

    def flush(chunk, ids, texts, parts):
        h1, h2, doc, at = (np.concatenate(x) for x in zip(*parts, strict=True))
        # numbers in the order of the ids and texts; equal rows have equal numbers
        by = np.lexsort((texts, ids))
        new = np.append(True, (ids[by[1:]] != ids[by[:-1]]) | (texts[by[1:]] != texts[by[:-1]]))
        number = np.empty(len(ids), np.int64)
        number[by] = np.cumsum(new) - 1
        ids, texts = ids[by[new]], texts[by[new]]
        place = number[doc] << 32 | at
        order = np.lexsort((place, h2, h1))
        h1, h2, place = h1[order], h2[order], place[order]
        first = np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))
        least = place[first][np.cumsum(first) - 1]
        later = place[place != least]
        h1, h2, place = h1[first], h2[first], place[first]
        shard = (h1 % U64(shards)).astype(np.int64)
        order = np.lexsort((place, shard))
        yield from rows(shard[order], place[order], h1[order], h2[order], ids, texts)
        if len(later):
            later = np.sort(later)
            none = np.zeros(len(later), U64)
            yield from rows(np.full(len(later), -1 - chunk), later, none, none.astype(np.uint32), ids, texts, bare=True)

    def rows(shard, place, h1, h2, ids, texts, bare=False):
        cuts = np.flatnonzero(np.diff(shard, prepend=shard[0] - 1))
        for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(shard)], strict=True):
            doc = place[lo:hi] >> 32
            begin = np.flatnonzero(np.diff(doc, prepend=-1))
            counts = np.diff(np.append(begin, len(doc))).astype(np.int32)
            arrays = [[int(shard[lo])], [ids[doc[begin]]], [texts[doc[begin]]], [counts], [b"" if bare else h1[lo:hi].tobytes()], [b"" if bare else h2[lo:hi].tobytes()], [(place[lo:hi] & 0xFFFFFFFF).astype("<u4").tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(a, k) for a, k in zip(arrays, SENT_KINDS, strict=True)], SENT_NAMES)

    def run(key, texts, marks):
        memory_returned()
        every = list(_windows(texts["text"], n))
        parts = []
        if every:
            order = np.argsort(marks["part"].to_numpy(), kind="stable")
            of_part, blobs = marks["part"].to_numpy()[order], [marks["marks"][int(k)].as_py() for k in order]
            h = np.concatenate([w[1] for w in every])
            maybe = np.arange(len(h))
            for row in range(DEPTH):
                maybe = maybe[_marked(h, row, sketch, of_part, blobs, maybe)]
            begin = 0
            for lo, hashes, doc, at, second in every:
                own = maybe[np.searchsorted(maybe, begin) : np.searchsorted(maybe, begin + len(hashes))] - begin
                begin += len(hashes)
                if len(own):
                    parts.append((hashes[own], second(own), lo + doc[own], at[own]))
        if not parts:
            return pa.table([pa.array([], k) for k in SENT_KINDS], SENT_NAMES)
        ids, text_hashes = (texts[c].to_numpy() for c in ("id", "text_hash"))
        return pa.Table.from_batches(list(flush(key[0].as_py(), ids, text_hashes, parts)))

    return run


FOUND = "chunk int, ids array<long>, text_hashes array<long>, counts array<int>, at binary"


def _grouped(chunks: int):
    """In each shard: all but the first occurrence of every window, a row for each chunk of documents."""
    names = [f.split()[0] for f in FOUND.split(", ")]
    kinds = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]

    def row(*values):
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

    def run(batches):
        ids, texts, counts, h1, h2, ats = [], [], [], [], [], []
        for batch in batches:
            for r in batch.to_pylist():
                if r["shard"] < 0:
                    yield row(-1 - r["shard"], r["doc_ids"], r["text_hashes"], r["counts"], r["at"])
                    continue
                for have, new in ((ids, np.array(r["doc_ids"], np.int64)), (texts, np.array(r["text_hashes"], np.int64)), (counts, np.array(r["counts"], np.int64)), (h1, np.frombuffer(r["h1"], U64)), (h2, np.frombuffer(r["h2"], np.uint32)), (ats, np.frombuffer(r["at"], "<u4"))):
                    have.append(new)
        memory_returned()
        if not ids:
            return
        ids, texts, counts, h1, h2, at = (np.concatenate(x) for x in (ids, texts, counts, h1, h2, ats))
        by = np.lexsort((texts, ids))
        new = np.append(True, (ids[by[1:]] != ids[by[:-1]]) | (texts[by[1:]] != texts[by[:-1]]))
        number = np.empty(len(ids), np.int64)
        number[by] = np.cumsum(new) - 1
        ids, texts = ids[by[new]], texts[by[new]]
        place = np.repeat(number, counts) << 32 | at
        order = np.lexsort((place, h2, h1))
        h1, h2, place = h1[order], h2[order], place[order]
        first = np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))
        later = place[place != place[first][np.cumsum(first) - 1]]
        if not len(later):
            return
        chunk = ((texts ^ ids) % chunks)[later >> 32]
        order = np.lexsort((later, chunk))
        later, chunk = later[order], chunk[order]
        cuts = np.flatnonzero(np.diff(chunk, prepend=-1))
        for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(chunk)], strict=True):
            doc = later[lo:hi] >> 32
            begin = np.flatnonzero(np.diff(doc, prepend=-1))
            yield row(int(chunk[lo]), ids[doc[begin]], texts[doc[begin]], np.diff(np.append(begin, len(doc))), (later[lo:hi] & 0xFFFFFFFF).astype("<u4").tobytes())

    return run


def _cut(n: int, spaced: bool):
    """A chunk's documents without what was found in them."""

    def kept_of(text: str | None, ats: list[np.ndarray]):
        raw = (text or "").encode()
        parts = raw.split()
        if not ats:
            return len(parts), 0, [], (b" ".join(parts) if spaced else raw).decode()
        change = np.zeros(len(parts) + 1, np.int64)
        every = np.unique(np.concatenate(ats))
        change[every] += 1
        change[every + n] -= 1
        gone = np.cumsum(change)[:-1] > 0
        edge = np.flatnonzero(np.diff(gone, prepend=False, append=False)).reshape(-1, 2)
        if spaced:
            kept = b" ".join([p for p, g in zip(parts, gone.tolist(), strict=True) if not g])
        else:
            starts, _, _ = words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), space_words())
            places, pieces, at = np.append(starts, len(raw)), [], 0
            for lo, hi in edge.tolist():
                pieces.append(raw[at : places[lo]])
                at = places[hi]
            kept = b"".join([*pieces, raw[at:]])
        return len(parts), int(gone.sum()), [{"first": a, "end": b} for a, b in edge.tolist()], kept.decode()

    def run(key, texts, later):
        memory_returned()
        found: dict[tuple[int, int], list[np.ndarray]] = {}
        for r in later.to_pylist():
            at = np.frombuffer(r["at"], "<u4")
            cuts = np.concatenate([[0], np.cumsum(r["counts"])]).tolist()
            for i, h, lo, hi in zip(r["ids"], r["text_hashes"], cuts[:-1], cuts[1:], strict=True):
                found.setdefault((i, h), []).append(at[lo:hi])
        docs = zip(texts["id"].to_pylist(), texts["text_hash"].to_pylist(), texts["text"], strict=True)
        rows = [kept_of(text.as_py(), found.get((i, h), [])) for i, h, text in docs]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])), pa.string()]
        made = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds]
        return pa.table([texts["id"], *made, *texts.columns[4:]], ["id", "n_words", "n_removed", "spans", "kept", *texts.column_names[4:]])

    return run


def remove_repeats(docs: DataFrame, n: int = 20, id_col: str = "doc_id", text_col: str = "text", spaced: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id_col, n_words, n_removed, spans, kept, keep...) for every row of docs.

    A word goes if a window of n consecutive words that covers it also starts
    earlier: in a row with a smaller id, or earlier in the same text. Windows
    are judged on the input. spans are the removed runs (first word, end);
    kept joins the other words by one space, or with spaced=False is the text
    as it was without the removed runs and the white space after each.

    Ids are whole numbers. A null id goes before all others. Rows with equal
    ids and different texts go by a hash of the text; rows with equal ids and
    texts are one document seen twice, and none of them goes for the other's
    sake. Null texts have no words and are kept as empty. No other column is
    read. Texts are shuffled once, into chunks of some megabytes or one text.
    The result is lazy, but for a first look at how much text there is."""
    spark = docs.sparkSession
    texts = long_rows(docs).select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"), F.col(text_col).alias("text"), *(F.col(c).alias(f"k{k}") for k, c in enumerate(keep)))
    fields = "".join(f", {f.name} {f.dataType.simpleString()}" for f in texts.schema.fields[3:])
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, sketch = planned(size)
    chunks = shards = max(chunks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    chunk = F.pmod(F.col("text_hash").bitwiseXOR(F.col("id")), F.lit(chunks)).cast("int")
    # all passes read all columns of this, so that they share its one exchange
    texts = texts.select(chunk.alias("chunk"), *texts.columns).repartition(chunks, "chunk")
    cells = texts.groupBy("chunk").applyInArrow(_sketch(n, sketch), "chunk int, part long, cells binary")
    marks = cells.groupBy("part").applyInArrow(_merge(sketch), "chunk int, part long, marks binary")
    found = texts.groupBy("chunk").cogroup(marks.groupBy("chunk")).applyInArrow(_candidates(n, sketch, shards), SENT)
    to = F.when(F.col("shard") < 0, F.pmod(-1 - F.col("shard"), F.lit(shards))).otherwise(F.col("shard"))
    later = found.repartitionById(shards, to.cast("int")).mapInArrow(_grouped(chunks), FOUND)
    cut = texts.groupBy("chunk").cogroup(later.groupBy("chunk")).applyInArrow(_cut(n, spaced), f"id long, n_words long, n_removed long, spans array<struct<first:int,end:int>>, kept string{fields}")
    kind = docs.schema[id_col].dataType
    return cut.select(F.when(F.col("id") != -(1 << 63), F.col("id")).cast(kind).alias(id_col), "n_words", "n_removed", "spans", "kept", *(F.col(f"k{k}").alias(c) for k, c in enumerate(keep)))


SQL = r"""
WITH said AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 19], ' ')) AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM said WHERE len(w) >= 20)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS k FROM windows) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM said),
kept AS (SELECT e.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY e.i) AS kept FROM each e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id)
SELECT s.doc_id, CAST(len(s.w) AS BIGINT) AS n_words, CAST(len(s.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM said s LEFT JOIN kept k ON s.doc_id = k.doc_id
"""
