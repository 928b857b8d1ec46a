"""Byte-level BPE encoding by a pair occurrence index, and decoding.

The distinct pieces of a batch are laid out as one row of linked symbols. An
index holds, for each pair that a merge rule names, the positions where it
stands; the active ranks wait in a heap. The lowest rank is taken, all its
occurrences in all pieces are merged from left to right, and the lists of the
pairs that arise beside them are extended.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import long_rows, memory_returned

#: How byte-level BPE cuts a text into pieces; \s there means Unicode's White_Space.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Pieces and words that a worker remembers (about 200 bytes each); either memory starts anew beyond that.
MOST_PIECES, MOST_WORDS = 400_000, 200_000


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


def refused(data: dict) -> None:
    """Raises ValueError for settings of a tokenizer file that would change the ids or the decoded text and that are not done here."""
    model, before = data["model"], data.get("pre_tokenizer") or {}
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
    odd += ["model type"] * (model.get("type", "BPE") != "BPE")
    odd += ["normalizer"] * bool(data.get("normalizer"))
    odd += ["pre_tokenizer"] * (before.get("type") != "ByteLevel" or bool(before.get("add_prefix_space")) or not before.get("use_regex", True))
    odd += ["decoder"] * ((data.get("decoder") or {}).get("type") != "ByteLevel")
    odd += [f"{k} of {t['content']}" for t in data.get("added_tokens") or () for k in ("single_word", "lstrip", "rstrip") if t.get(k)]
    if odd:
        raise ValueError(f"tokenizer settings that are not implemented: {', '.join(odd)}")


class Bpe:
    """The rules of a byte-level BPE tokenizer file, and what a worker has encoded with them."""

    def __init__(self, file: str) -> None:
        data = json.loads(file)
        model, letters = data["model"], byte_letters()
        vocab = model["vocab"]
        self.byte_ids = [0] * 256
        for letter, b in letters.items():
            self.byte_ids[b] = vocab[letter]
        self.ranks: dict[int, int] = {}
        self.rules: list[tuple[int, int, int]] = []
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks[vocab[a] << 32 | vocab[b]] = rank
            self.rules.append((vocab[a], vocab[b], vocab[a + b]))
        self.pairs = np.array(sorted(self.ranks) or [-2], np.int64)
        self.pair_ranks = np.array([self.ranks.get(k, -1) for k in self.pairs.tolist()], np.int64)
        made: dict[int, int] = {}
        for rank, (*_, new) in enumerate(self.rules):
            made[new] = rank
        #: Whether every rule comes after the rules that make its symbols, so that no merge wakes a lower rank.
        self.ascending = all(rank > max(made.get(a, -1), made.get(b, -1)) for rank, (a, b, _) in enumerate(self.rules))
        self.added = {t["content"]: t["id"] for t in data.get("added_tokens") or ()}
        self.bytes_of = [b""] * (1 + max([*vocab.values(), *self.added.values()]))
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(letters[c] for c in token)
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        self.split = regex.compile(PIECES)
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.pieces: dict[str, bytes] = {}
        self.first: dict[str, bytes | None] = {}
        self.later: dict[str, bytes | None] = {}

    def merge(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, packed as little-endian uint32."""
        spelled = [p.encode() for p in pieces]
        sizes = np.fromiter(map(len, spelled), np.int64, len(spelled))
        ends = np.cumsum(sizes)
        symbol = np.array(self.byte_ids, np.int64)[np.frombuffer(b"".join(spelled), np.uint8)]
        n = len(symbol)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        some = sizes > 0
        after[ends[some] - 1] = -1
        before[(ends - sizes)[some]] = -1
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enlist(places: np.ndarray) -> int:
            """Adds places whose symbol and the next are a rule's pair; gives the least rank."""
            pair = symbol[places] << 32 | symbol[after[places]]
            near = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            known = np.flatnonzero(self.pairs[near] == pair)
            if not len(known):
                return len(self.rules)
            rank, places = self.pair_ranks[near[known]], places[known]
            order = np.argsort(rank, kind="stable")
            rank, places = rank[order], places[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            lo = 0
            for hi, r in zip([*cuts.tolist(), len(rank)], rank[[0, *cuts.tolist()]].tolist(), strict=True):
                if r in index:
                    index[r].append(places[lo:hi])
                else:
                    index[r] = [places[lo:hi]]
                    heapq.heappush(heap, r)
                lo = hi
            return int(rank[0])

        if n:
            enlist(np.flatnonzero(after >= 0))
        while heap:
            rank = heapq.heappop(heap)
            lists = index.pop(rank, None)
            if lists is None:
                continue
            a, b, new = self.rules[rank]
            places = np.unique(np.concatenate(lists)) if len(lists) > 1 else lists[0]
            nxt = after[places]
            holds = (symbol[places] == a) & (nxt >= 0) & (symbol[nxt] == b)
            if not holds.all():
                places, nxt = places[holds], nxt[holds]
            if self.ascending and a == b and len(places) > 1:  # in a run of equal symbols every second pair, from the left
                begins = np.append(True, places[1:] != nxt[:-1])
                number = np.arange(len(places))
                even = (number - np.maximum.accumulate(np.where(begins, number, 0))) % 2 == 0
                places, nxt = places[even], nxt[even]
            while len(places):
                # where a rule may wake a lower rank, a piece's next pair has to wait for it
                now = slice(None) if self.ascending else np.append(True, self.piece_of(ends, places[1:]) != self.piece_of(ends, places[:-1]))
                p, q = places[now], nxt[now]
                far = after[q]
                symbol[p], symbol[q], after[p] = new, -1, far
                linked = far >= 0
                before[far[linked]] = p[linked]
                near = before[p]
                least = enlist(np.concatenate([p[linked], near[near >= 0]]))
                if self.ascending:
                    break
                rest = np.setdiff1d(places, p)
                if least < rank and len(rest):
                    index.setdefault(rank, []).append(rest)
                    heapq.heappush(heap, rank)
                    break
                places, nxt = rest, after[rest]
                holds = (symbol[places] == a) & (nxt >= 0) & (symbol[nxt] == b)
                places, nxt = places[holds], nxt[holds]
        alive = symbol >= 0
        kept = np.concatenate([[0], np.cumsum(alive)])
        packed = symbol[alive].astype("<u4").tobytes()
        return [packed[4 * s : 4 * e] for s, e in zip(kept[ends - sizes].tolist(), kept[ends].tolist(), strict=True)]

    @staticmethod
    def piece_of(ends: np.ndarray, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(ends, places, "right")

    def learn(self, pieces: set[str]) -> None:
        if len(self.pieces) > MOST_PIECES:  # frequent pieces are in every batch, and stay
            self.pieces = {p: self.pieces[p] for p in pieces if p in self.pieces}
        new = [p for p in pieces if p not in self.pieces]
        self.pieces.update(zip(new, self.merge(new), strict=True))

    def learn_words(self, first: set[str], later: set[str]) -> None:
        """What words come to: those that begin a line, and those after one
        space. None for those that touch more white space; they aren't cut alike everywhere."""
        if len(self.first) + len(self.later) > MOST_WORDS:
            self.first = {w: self.first[w] for w in first if w in self.first}
            self.later = {w: self.later[w] for w in later if w in self.later}
        cut = []
        for known, found, lead in ((self.first, first, ""), (self.later, later, " ")):
            for w in found:
                if w not in known:
                    cut.append((known, w, None if not w or w[0].isspace() or w[-1].isspace() else self.split.findall(lead + w)))
        self.learn({p for *_, pieces in cut if pieces for p in pieces})
        get = self.pieces.__getitem__
        for known, w, pieces in cut:
            known[w] = b"".join(map(get, pieces)) if pieces else None

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of every text, packed as little-endian uint32."""
        parts: list[tuple[str, ...]] = []
        for text in texts:
            if self.cut is None or not self.cut.search(text):
                parts.append((text,))
                continue
            at, own = 0, []
            for m in self.cut.finditer(text):
                own += [text[at : m.start()], m.group()]
                at = m.end()
            parts.append((*own, text[at:]))
        lines = {p: [line.split(" ") for line in p.split("\n")] for own in parts for p in own[::2] if p}
        self.learn_words({line[0] for own in lines.values() for line in own}, {w for own in lines.values() for line in own for w in line[1:]})
        newline = self.pieces.get("\n") or self.merge(["\n"])[0]
        first, later = self.first.__getitem__, self.later.__getitem__
        out: dict[str, bytes] = {"": b""}
        odd = []
        for part, own in lines.items():
            try:
                out[part] = newline.join([b"".join([first(line[0]), *map(later, line[1:])]) for line in own])
            except TypeError:
                odd.append(part)
        if odd:
            cut = [self.split.findall(p) for p in odd]
            self.learn(set(chain.from_iterable(cut)))
            get = self.pieces.__getitem__
            out.update((p, b"".join(map(get, pieces))) for p, pieces in zip(odd, cut, strict=True))
        mark = {t: i.to_bytes(4, "little") for t, i in self.added.items()}
        return [b"".join(mark[p] if k % 2 else out[p] for k, p in enumerate(own)) for own in parts]

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@cache
def loaded(file: str) -> Bpe:
    return Bpe(file)


def _batches(texts: list[str], size: int = 1 << 22):
    lo = 0
    while lo < len(texts):
        hi, n = lo, 0
        while hi < len(texts) and (hi == lo or n < size):
            n += len(texts[hi])
            hi += 1
        yield texts[lo:hi]
        lo = hi


def encoded(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids) for every row: the token ids as one binary of
    little-endian unsigned 32-bit integers, without special tokens added.

    tokenizer is the path of a tokenizer file on the driver; its text, of a
    fixed size, goes to the tasks. Null and empty texts have no ids. Strings
    of added tokens inside a text become those tokens. Ids are not looked at,
    so null and repeated ones are kept. Files with settings that are not done
    here are refused."""
    return _mapped(docs, tokenizer, id_col, text_col, lambda bpe, packed: [pa.array(packed, pa.binary())], "ids binary", ["ids"])


def encode_and_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256) for every row: of the
    encoded text and of the text decoded again from its ids. See encoded()."""

    def digests(bpe, packed):
        sha = lambda b: hashlib.sha256(b).hexdigest()
        return [pa.array([len(x) // 4 for x in packed], pa.int64()), pa.array(list(map(sha, packed)), pa.string()), pa.array([sha(bpe.decode(x).encode()) for x in packed], pa.string())]

    return _mapped(docs, tokenizer, id_col, text_col, digests, "n_tokens long, ids_sha256 string, decoded_sha256 string", ["n_tokens", "ids_sha256", "decoded_sha256"])


def _mapped(docs, tokenizer, id_col, text_col, made, fields, names):
    with open(tokenizer, encoding="utf-8") as f:
        file = f.read()
    refused(json.loads(file))
    rules = docs.sparkSession.sparkContext.broadcast(file)

    def run(batches):
        bpe = loaded(rules.value)
        for batch in batches:
            at = 0
            for texts in _batches([x or "" for x in batch.column(1).to_pylist()]):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), *made(bpe, bpe.encode(texts))], ["id", *names])
                at += len(texts)
        loaded.cache_clear()  # a worker outlives the task: the tables, 100 MB and more, would stay
        del bpe
        memory_returned()

    kind = docs.schema[id_col].dataType.simpleString()
    return long_rows(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, {fields}").withColumnRenamed("id", id_col)
