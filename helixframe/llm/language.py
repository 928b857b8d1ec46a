"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram is bound as the
product of its letters' vectors, those of the first and the second rotated by
two and by one place; a text bundles (adds up) its trigrams, a language the
trigrams of all its training texts. The prediction is the language whose
prototype has the largest cosine with the text's vector.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import long_rows

#: Size of the vectors; letters are hashed to so many symbols, 0 stands for what is no letter.
DIMENSIONS, SYMBOLS = 512, 128
BLOCK = 1 << 20


@cache
def symbols() -> np.ndarray:
    """The symbol of every code point: letters share SYMBOLS - 1 of them by their numbers, so that those of an alphabet differ and a few of different ones do not; 0 for all else."""
    table = np.zeros(0x110000, np.uint8)
    letters = np.array([c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()])
    table[letters] = 1 + letters % (SYMBOLS - 1)
    return table


@cache
def letter_vectors() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every symbol, rotated for the first, second and third place."""
    v = np.random.default_rng(7).integers(0, 2, (SYMBOLS, DIMENSIONS)).astype(np.int8) * 2 - 1
    return np.roll(v, 2, 1).copy(), np.roll(v, 1, 1).copy(), v


def bundle(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of the trigrams' vectors; exact for fewer than 2^24 trigrams."""
    one, two, three = letter_vectors()
    out = np.zeros(DIMENSIONS)
    for lo in range(0, len(codes), 4096):
        c = codes[lo : lo + 4096]
        bound = one[c >> 14] * two[(c >> 7) & 127] * three[c & 127]
        n = counts[lo : lo + 4096]
        out += n.astype(np.float32) @ bound.astype(np.float32) if n.sum() < 1 << 24 else n.astype(np.float64) @ bound.astype(np.float64)
    return out


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text numbers, trigram codes and counts, by text and code. Runs of other
    characters count as one space, as do the ends of a text."""
    lower = [f" {x.lower()} " for x in texts]
    sizes = np.fromiter(map(len, lower), np.int64, len(lower))
    points = np.frombuffer("".join(lower).encode("utf-32-le", "replace"), np.uint32)
    s = symbols()[points]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 0) | (s[:-1] != 0)
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    keep[first] = True
    doc = np.repeat(np.arange(len(texts)), sizes)[keep]
    s = s[keep].astype(np.int64)
    if len(s) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = (doc[2:] == doc[:-2]) & (s[1:-1] != 0)
    key = (doc[2:] << 21 | s[:-2] << 14 | s[1:-1] << 7 | s[2:])[same]
    key, counts = np.unique(key, return_counts=True)
    return key >> 21, key & ((1 << 21) - 1), counts


def _chunks(texts: list[str]):
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size < BLOCK):
            size += len(texts[hi])
            hi += 1
        yield lo, texts[lo:hi]
        lo = hi


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """A prototype for each language of docs, from all of its texts.

    Trigrams are counted in every partition first; a partition sends one
    vector of DIMENSIONS whole numbers for each language, and those are added
    up, so a language with most rows is no special case. What the driver gets
    is one vector for each language. Rows without text or language teach
    nothing."""

    def run(batches):
        have: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lo, texts in _chunks(batch.column(1).to_pylist()):
                doc, code, count = trigrams(texts)
                lang = np.array(langs[lo : lo + len(texts)])[doc]
                for x in np.unique(lang).tolist():
                    old = have.get(x, (np.zeros(0, np.int64),) * 2)
                    codes, index = np.unique(np.concatenate([old[0], code[lang == x]]), return_inverse=True)
                    have[x] = codes, np.bincount(index, np.concatenate([old[1], count[lang == x]])).astype(np.int64)
        for x, (codes, counts) in have.items():
            vector = np.rint(bundle(codes, counts)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([x] * DIMENSIONS), pa.array(np.arange(DIMENSIONS)), pa.array(vector)], ["lang", "at", "sum"])

    rows = long_rows(docs).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    sums = rows.mapInArrow(run, "lang string, at long, sum long").groupBy("lang", "at").agg(F.sum("sum").alias("sum"))
    out: dict[str, np.ndarray] = {}
    for r in sums.collect():
        out.setdefault(r["lang"], np.zeros(DIMENSIONS))[r["at"]] = r["sum"]
    return out


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id_col, keep..., lang_pred, score) of every row; score is the best
    cosine, from 0 to 1. Ties go to the first language by name. A text that is
    null or has no letter is `und` with score 0, as is any text if nothing was
    learned. Repeated rows stay repeated."""
    langs = sorted(prototypes)
    model = np.stack([prototypes[x] / max(np.linalg.norm(prototypes[x]), 1e-9) for x in langs]) if langs else np.zeros((0, DIMENSIONS))

    def run(batches):
        for batch in batches:
            texts = [x or "" for x in batch.column("__text" if own else text_col).to_pylist()]
            names: list[str] = []
            scores: list[float] = []
            for _, part in _chunks(texts):
                doc, code, count = trigrams(part)
                cuts = np.searchsorted(doc, np.arange(len(part) + 1))
                for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                    best, score = "und", 0.0
                    if hi > lo and len(langs):
                        v = bundle(code[lo:hi], count[lo:hi])
                        cosines = model @ v / max(np.linalg.norm(v), 1e-9)
                        at = int(np.argmax(cosines))
                        best, score = langs[at], float(min(1.0, max(0.0, cosines[at])))
                    names.append(best)
                    scores.append(score)
            n = batch.num_columns - own
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*batch.schema.names[:n], "lang_pred", "score"])

    own = text_col not in keep
    kept = long_rows(docs).select(F.col(id_col), *keep, *([F.col(text_col).alias("__text")] if own else []))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[: len(keep) + 1])
    return kept.mapInArrow(run, f"{fields}, lang_pred string, score double")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id_col, held_out, lang_pred, score): learned from the rows of docs that
    are not held out and have an id, predicted for all of them from text alone."""
    marked = docs.select(F.col(id_col), F.col(text_col), F.col(lang_col), held_out(id_col).alias("held_out"))
    model = train(marked.where(f"not held_out and `{id_col}` is not null"), text_col, lang_col)
    return predict(marked, model, id_col, text_col, ("held_out",))
