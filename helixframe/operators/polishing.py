"""Polishing of bubbles: a candidate sequence is changed letter by letter for
as long as its branches, the reads over it, become likelier; after that the
lengths of its runs of one letter are set to the likeliest ones.

All changes of one kind are scored at once, from the tables of the best scores
up to and from each place, in arrays of branches x candidate x branch. A bubble is one row."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

LETTERS = "ACGT"
#: Whole numbers to a natural logarithm; branches of the first pass, which bubbles of more than twice as many have; steps for each letter at most; the longest run; the least probability of a run.
UNIT, FIRST, MOST_STEPS, MOST_RUN, LEAST_RUN = 1 << 17, 5, 10, 20, 0.001
LOW = -(1 << 60)
CODES = np.full(256, 4, np.int64)
for _code, _letter in enumerate(LETTERS):
    CODES[ord(_letter)] = CODES[ord(_letter.lower())] = _code


class Model(NamedTuple):
    """Scores: substitution[x, y] of reading y for x, deletion[x] of reading nothing for it, insertion[y] of reading y for nothing; run[n, m] of reading m letters of a run of n."""

    substitution: np.ndarray
    deletion: np.ndarray
    insertion: np.ndarray
    run: np.ndarray


def scores(p: np.ndarray) -> np.ndarray:
    return np.round(np.log(p) * UNIT).astype(np.int64)


def model(right: float = 0.9, wrong: float = 0.01, lost: float = 0.05, added: float = 0.03, run_kept: float = 0.8) -> Model:
    """A model of equal letters: probabilities of a right letter, of each wrong
    one, of a lost one, of each added one, and of a run's length as it is; each
    letter more or less halves the rest."""
    n = np.arange(MOST_RUN + 1)
    away = np.abs(n[:, None] - n[None, :])
    run = np.where(away == 0, run_kept, (1 - run_kept) / 2.0 ** (away + 1))
    return Model(scores(np.where(np.eye(4, dtype=bool), right, wrong)), scores(np.full(4, lost)), scores(np.full(4, added)), scores(np.maximum(run, LEAST_RUN)))


def read_model(lines: list[str], runs: np.ndarray | None = None) -> Model:
    """A model from lines of tab-separated fields: mat X p, mis X->Y p, del X p, ins Y p."""
    out = model()
    for fields in (line.split("\t") for line in lines if line.strip()):
        if fields[0] in ("mat", "mis", "del", "ins"):
            value = round(math.log(float(fields[2])) * UNIT)
            x, y = (CODES[ord(c)] for c in (fields[1][0], fields[1][-1]))
            {"mat": out.substitution, "mis": out.substitution, "del": out.deletion, "ins": out.insertion}[fields[0]][(x, y) if fields[0] in ("mat", "mis") else x] = value
    return out if runs is None else out._replace(run=scores(np.maximum(runs, LEAST_RUN)))


def table(candidate: np.ndarray, branches: np.ndarray, m: Model) -> np.ndarray:
    """The best scores of every beginning of the candidate with every beginning of each branch (codes, padded)."""
    out = np.empty((len(branches), len(candidate) + 1, branches.shape[1] + 1), np.int64)
    added = np.zeros((len(branches), branches.shape[1] + 1), np.int64)
    np.cumsum(m.insertion[branches], 1, out=added[:, 1:])
    out[:, 0] = added
    for i, x in enumerate(candidate.tolist(), 1):
        row = out[:, i - 1] + m.deletion[x]
        row[:, 1:] = np.maximum(row[:, 1:], out[:, i - 1, :-1] + m.substitution[x][branches])
        out[:, i] = np.maximum.accumulate(row - added, 1) + added
    return out


class _Bubble:
    def __init__(self, branches: list[np.ndarray], m: Model) -> None:
        self.m, self.n = m, np.array(list(map(len, branches)))
        self.there = np.zeros((len(branches), int(self.n.max(initial=0))), np.int64)
        self.back = self.there.copy()
        for k, b in enumerate(branches):
            self.there[k, : len(b)], self.back[k, : len(b)] = b, b[::-1]
        # a branch's end is where its beginning read backwards is
        self.turn = np.maximum(self.n[:, None] - np.arange(self.there.shape[1] + 1), 0)
        self.out = np.arange(self.there.shape[1] + 1) > self.n[:, None]

    def tables(self, candidate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best scores up to each place, and from each place on."""
        up = table(candidate, self.there, self.m)
        down = np.take_along_axis(table(candidate[::-1], self.back, self.m)[:, ::-1], self.turn[:, None, :], 2)
        down[np.broadcast_to(self.out[:, None, :], down.shape)] = LOW
        return up, down

    def step(self, candidate: np.ndarray) -> tuple[int, np.ndarray]:
        """The score of the candidate, and the best change of it: of one letter
        less, else of one more, else of another one. Changed letters are not
        read as longer than themselves, so that a change is worth what it says at least."""
        up, down = self.tables(candidate)
        now = int(up[np.arange(len(up)), -1, self.n].sum())
        if not len(candidate) and not self.there.shape[1]:
            return now, candidate
        worth = (up[:, :-1] + down[:, 1:]).max(2, initial=LOW).sum(0) if len(candidate) else np.zeros(0, np.int64)
        if len(worth) and worth.max() > now:
            return now, np.delete(candidate, worth.argmax())
        best = {}
        for kind, rest in (("more", down), ("other", down[:, 1:])):
            every = []
            for x in range(4):
                new = up[:, : rest.shape[1]] + self.m.deletion[x]
                new[:, :, 1:] = np.maximum(new[:, :, 1:], up[:, : rest.shape[1], :-1] + self.m.substitution[x][self.there][:, None, :])
                every.append((new + rest).max(2, initial=LOW).sum(0))
            best[kind] = np.stack(every, 1)
        if best["more"].max() > now:
            at, x = divmod(int(best["more"].argmax()), 4)
            return now, np.insert(candidate, at, x)
        other = best["other"]
        if other.size:
            other[np.arange(len(candidate)), candidate] = LOW
            if other.max() > now:
                at, x = divmod(int(other.argmax()), 4)
                return now, np.append(np.append(candidate[:at], x), candidate[at + 1 :])
        return now, candidate

    def climb(self, candidate: np.ndarray) -> tuple[np.ndarray, int]:
        most = MOST_STEPS * max(len(candidate), self.there.shape[1]) + 1
        for n in range(most + 1):
            _, new = self.step(candidate)
            if new is candidate:
                return candidate, n
            candidate = new
        return candidate, most

    def runs(self, candidate: np.ndarray) -> np.ndarray:
        """The candidate with its runs of one letter as long as the branches make likeliest."""
        if not len(candidate) or not len(self.n):
            return candidate
        up, down = self.tables(candidate)
        cuts = np.flatnonzero(np.diff(candidate, prepend=-1))
        out = []
        for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(candidate)], strict=True):
            x = int(candidate[lo])
            # where a best alignment comes to the run, as late as can be, and leaves it, as early as can be
            total = up[:, -1][np.arange(len(up)), self.n]
            width = up.shape[2]
            begin = width - 1 - ((up[:, lo] + down[:, lo]) == total[:, None])[:, ::-1].argmax(1)
            end = np.maximum(begin, ((up[:, hi] + down[:, hi]) == total[:, None]).argmax(1))
            # letters of the run that stand just beyond belong to it
            seen = np.zeros(len(up), np.int64)
            for k, (p, q) in enumerate(zip(begin.tolist(), end.tolist(), strict=True)):
                b = self.there[k, : self.n[k]]
                while p > 0 and b[p - 1] == x:
                    p -= 1
                while q < len(b) and b[q] == x:
                    q += 1
                seen[k] = int((b[p:q] == x).sum())
            worth = self.m.run[:, np.minimum(seen, MOST_RUN)].sum(1)
            worth[0] = LOW
            old = min(hi - lo, MOST_RUN)
            new = int(worth.argmax()) if worth.max() > worth[old] else hi - lo
            out.append(np.full(new, x))
        return np.concatenate(out)


def polish(candidate: str, branches: list[str], m: Model) -> tuple[str, int, int]:
    """The polished candidate, its score and the changes of letters that led there.

    A bubble of many branches is polished with the five of middle length first.
    Letters other than A, C, G and T are left out; empty branches count."""
    code = lambda s: (c := CODES[np.frombuffer((s or "").encode("latin-1", "replace"), np.uint8)])[c < 4]
    now, every, steps = code(candidate), sorted((code(b) for b in branches), key=lambda b: (len(b), b.tolist())), 0
    if not every:
        return "".join(LETTERS[x] for x in now), 0, 0
    if len(every) > 2 * FIRST:
        lo = len(every) // 2 - FIRST // 2
        now, steps = _Bubble(every[lo : lo + FIRST], m).climb(now)
    bubble = _Bubble(every, m)
    now, more = bubble.climb(now)
    now = bubble.runs(now)
    return "".join(LETTERS[x] for x in now), bubble.step(now)[0], steps + more


def polished(bubbles: DataFrame, m: Model | None = None, candidate: str = "candidate", branches: str = "branches") -> DataFrame:
    """bubbles with polished, score (natural logarithm) and changes."""
    own = m or model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [polish(c, [b or "" for b in x or []], own) for c, x in zip(batch.column(candidate).to_pylist(), batch.column(branches).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([d[0] for d in done], pa.string()), pa.array([d[1] / UNIT for d in done], pa.float64()), pa.array([d[2] for d in done], pa.int32())], [*batch.schema.names, "polished", "score", "changes"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in bubbles.schema)
    return bubbles.mapInArrow(run, f"{fields}, polished string, score double, changes int")
