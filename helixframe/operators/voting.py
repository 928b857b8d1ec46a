"""Correction of reads by the votes of what overlaps them: alignments are read
as runs of equal letters and differences, votes become a table of columns, and
columns with a clear majority give corrections."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

#: Letters of a run that confirms, of its ends that do not, and of the runs on both sides of a difference that votes.
RUN, ENDS, SIDES = 9, 3, 9
#: Votes of a haplotype, and votes that outweigh one confirmation.
HAPLOTYPE, SURE = 3, 6
#: Kinds of votes: of stretches, which count from where they begin to where they end, and of single letters.
STRETCHES = ["confirmed", "whole", "own"]
CHANGES, INSERTS = ["gone", "A", "C", "G", "T"], ["after_A", "after_C", "after_G", "after_T"]
KINDS = STRETCHES + CHANGES + INSERTS
CODE = {ord(c): k for k, c in enumerate("ACGT")}


def differences(part: bytes, other: bytes, cigar: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(columns, letters, votes) of the columns of an alignment in which part
    and other differ: the column, the letter of part that it is about (for a
    letter that part lacks the one before it), and the kind of vote (-1: a letter other than A, C, G and T)."""
    ops = np.array([0] + [int(n) for n in re.findall(r"\d+", cigar)]), "M" + "".join(re.findall(r"[MID]", cigar))
    op = np.repeat(np.frombuffer(ops[1].encode(), np.uint8), ops[0])
    lacks, extra = op == ord("D"), op == ord("I")
    at, there = np.cumsum(~lacks) - 1, np.cumsum(~extra) - 1
    x, y = np.frombuffer(part + b"\0", np.uint8), np.frombuffer(other + b"\0", np.uint8)
    differs = lacks | extra | (x[at] != y[there])
    where = np.flatnonzero(differs)
    letter = np.array([CODE.get(int(c), -1) for c in y[there[where]]], np.int64)
    vote = np.where(letter < 0, -1, letter + np.where(lacks[where], KINDS.index("after_A"), KINDS.index("A")))
    return where, at[where], np.where(extra[where], KINDS.index("gone"), vote)


def votes(part: bytes, other: bytes, cigar: str, run: int = RUN, ends: int = ENDS, sides: int = SIDES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters, kinds, numbers) of an alignment's votes; a stretch is +1 where it begins and -1 behind its end."""
    where, letter, vote = differences(part, other, cigar)
    columns = sum(int(n) for n in re.findall(r"\d+", cigar))
    equal = np.diff(np.concatenate([[-1], where, [columns]])) - 1
    first = np.concatenate([[0], letter + 1])
    low, high = np.full(len(equal), ends), np.full(len(equal), ends)
    low[0] = high[-1] = 0
    sure = equal >= run
    lo, hi, a, b = first[sure], (first + equal)[sure], (first + low)[sure], (first + equal - high)[sure]
    of = lambda name: np.full(len(lo), KINDS.index(name))
    begins = [(a, of("confirmed")), (a, of("whole")), (lo, of("own")), (b, of("own"))]
    stops = [(b, of("confirmed")), (np.maximum(b - 1, a), of("whole")), (a, of("own")), (hi, of("own"))]
    lacks = vote >= KINDS.index("after_A")
    # of letters that part lacks in a row the first votes
    again = np.zeros(len(vote), bool)
    again[1:] = lacks[1:] & lacks[:-1] & (equal[1:-1] == 0)
    cast = (equal[:-1] + equal[1:] >= sides) & ~again & (vote >= 0)
    parts = begins + stops + [(letter[cast], vote[cast])]
    number = np.concatenate([np.full(sum(len(p) for p, _ in rows), n) for rows, n in ((begins, 1), (stops, -1), (parts[-1:], 1))])
    return np.concatenate([p for p, _ in parts]), np.concatenate([k for _, k in parts]), number


def agreed(n: int, run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """votes() of n letters that are equal."""
    if n < run:
        return tuple(np.zeros((3, 0), np.int64))
    confirmed, whole = (KINDS.index(name) for name in ("confirmed", "whole"))
    return np.array([0, n, 0, n - 1]), np.array([confirmed, confirmed, whole, whole]), np.array([1, -1, 1, -1])


def columns(rows: DataFrame, run: int = RUN, ends: int = ENDS, sides: int = SIDES) -> DataFrame:
    """(id, pos, confirmed, whole, own, gone, A, C, G, T, after_A, ...): the
    votes of all letters of which any alignment would change something.

    rows: id, pos (where part begins in its read), part, other, cigar (I: a
    letter of part alone). A run of equal letters, if not shorter than run,
    confirms its letters, and that nothing is missing behind any but the last;
    up to ends letters of the run next to a difference only get a vote for the
    letter that is there (own). A difference votes if the runs at its sides have sides letters together; of letters
    that part lacks one after the other the first votes, and one that is missing
    before a read's first letter does not. Other letters than A, C, G, T do
    not vote. Null sequences and CIGARs are empty.

    Stretches are sent as begins and ends, summed by letter before the shuffle,
    so that neither depth nor a read that everything overlaps grows a group
    beyond its read's letters."""
    if run < 2 * ends or ends < 0:
        raise ValueError("a run is at least as long as its two ends")

    def cast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, places, parts, others, cigars = (batch.column(c) for c in range(5))
            if not batch.num_rows:
                continue
            # equal alignments are read once, those of equal letters not at all
            each: dict[tuple, int] = {}
            which = np.array([each.setdefault(row, len(each)) for row in zip(parts.to_pylist(), others.to_pylist(), cigars.to_pylist(), strict=True)])
            found = [agreed(len(p), run) if p and p == o and c == f"{len(p)}M" else votes((p or "").encode(), (o or "").encode(), c or "", run, ends, sides) for p, o, c in each]
            sizes = np.array([len(f[0]) for f in found])
            begins = np.cumsum(sizes) - sizes
            of = np.repeat(np.arange(len(which)), sizes[which])
            at = np.arange(len(of)) + (begins[which] - (np.cumsum(sizes[which]) - sizes[which]))[of]
            pos, kind, n = (np.concatenate([f[c] for f in found])[at] for c in range(3))
            pos = pos + places.to_numpy(zero_copy_only=False).astype(np.int64)[of]
            # votes of a batch for one letter are put together
            read = ids.dictionary_encode("encode")
            row = read.indices.to_numpy(zero_copy_only=False)[of]
            order = np.lexsort((kind, pos, row))
            order = order[pos[order] >= 0]
            if not len(order):
                continue
            row, pos, kind, n = row[order], pos[order], kind[order], n[order]
            begin = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (pos[1:] != pos[:-1]) | (kind[1:] != kind[:-1])))
            n = np.add.reduceat(n, begin)
            begin, n = begin[n != 0], n[n != 0]
            yield pa.RecordBatch.from_arrays([read.dictionary.take(pa.array(row[begin])), pa.array(pos[begin], pa.int64()), pa.array(kind[begin], pa.int64()), pa.array(n, pa.int64())], ["id", "pos", "kind", "n"])

    rows = rows.where("pos IS NOT NULL").select("id", F.col("pos").cast("long").alias("pos"), "part", "other", "cigar")
    cast_ = rows.mapInArrow(cast, f"id {rows.schema['id'].dataType.simpleString()}, pos long, kind long, n long")
    sums = cast_.groupBy("id", "pos").agg(*(F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(name) for k, name in enumerate(KINDS)))
    w = Window.partitionBy("id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    out = sums.select("id", "pos", *(F.sum(c).over(w).alias(c) for c in STRETCHES), *CHANGES, *INSERTS)
    return out.where(" + ".join(CHANGES + INSERTS) + " > 0")


def corrections(table: DataFrame, haplotypes: bool = True) -> DataFrame:
    """(id, pos, change, inserted) of a table of columns: the letter that
    takes the place of the one at pos (empty: none; null: it stays), and a letter to come behind it (or none: empty).

    More than half of two or more votes decide, if nothing confirms the letter
    (or one alignment does, and more than SURE votes are against it). With
    haplotypes a column in which two kinds have HAPLOTYPE votes stays as it is."""

    def decided(kinds: list[str], values: list[str], own: list[str], against: str):
        every = kinds + own
        total = sum((F.col(c) for c in every[1:]), F.col(every[0]))
        alike = sum(((F.col(c) >= HAPLOTYPE).cast("int") for c in every), F.lit(0))
        most = F.greatest(*kinds)
        ok = (total > 1) & ((F.col(against) == 0) | ((F.col(against) == 1) & (most > SURE)))
        ok = ok & (alike < 2) if haplotypes else ok
        return F.when(ok, F.coalesce(*(F.when(2 * F.col(k) > total, F.lit(v)) for k, v in zip(kinds, values, strict=True))))

    change = decided(CHANGES, ["", *"ACGT"], ["own"], "confirmed")
    inserted = decided(INSERTS, list("ACGT"), [], "whole")
    return table.select("id", "pos", change.alias("change"), F.coalesce(inserted, F.lit("")).alias("inserted")).where("change IS NOT NULL OR inserted <> ''")


def applied(rows: DataFrame, fixes: DataFrame, id_col: str = "id", seq: str = "seq", begin: str | None = None, out: str = "corrected") -> DataFrame:
    """rows with seq corrected, in column out. begin: the column with the place
    of seq in its read, if it is a part of it. Rows without corrections or with a null id keep theirs."""
    of = fixes.groupBy(F.col("id").alias("_of")).agg(F.array_sort(F.collect_list(F.struct("pos", "change", "inserted"))).alias("_all"))
    start = F.lit(0) if begin is None else F.col(begin)
    inside = F.filter("_all", lambda c: (c["pos"] >= start) & (c["pos"] < start + F.length(seq)))
    found = rows.join(of, F.col(id_col) == F.col("_of"), "left").withColumn("_own", inside)

    def piece(c, i):
        before = F.when(i > 0, F.get("_own", i - 1)["pos"] - start).otherwise(F.lit(-1)).cast("int")
        at = (c["pos"] - start).cast("int")
        return F.concat(F.substr(F.col(seq), before + 2, at - before - 1), F.coalesce(c["change"], F.substr(F.col(seq), at + 1, F.lit(1))), c["inserted"])

    last = (F.element_at("_own", -1)["pos"] - start).cast("int")
    whole = F.concat(F.array_join(F.transform("_own", piece), ""), F.substr(F.col(seq), last + 2))
    return found.withColumn(out, F.when(F.size("_own") > 0, whole).otherwise(F.col(seq))).drop("_of", "_all", "_own")


@F.pandas_udf(LongType())
def n_differences(part: pd.Series, other: pd.Series, cigar: pd.Series) -> pd.Series:
    """Columns of an alignment in which part and other differ."""
    rows = list(zip(part, other, cigar, strict=True))
    n = {(p, o, c): 0 if p == o and c == f"{len(p)}M" else len(differences(p.encode(), o.encode(), c)[0]) for p, o, c in dict.fromkeys(rows)}
    return pd.Series([n[row] for row in rows], dtype="int64")
