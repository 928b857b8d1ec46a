"""Quality by an interpolated modified Kneser-Ney model of trusted text.

The model is over characters, as they are: ORDER-grams of code points, with no
classes and no bound on the alphabet, so it has something to say of words that
it has never seen. It grows with the corpus: every n-gram of every document is
in it, with the count that trusted text has of it.

1. Each task counts the n-grams of its documents; the counts are added up by
   n-gram. What trusted text does not have counts zero.
2. Continuation counts of the lower orders follow from the n-grams that trusted
   text has, order by order, and so do the sums for each context. Joins of
   these tables by n-gram, context and suffix give every n-gram's probability.
3. Documents are dealt into chunks. A chunk asks the shards of the table of
   probabilities for its different n-grams, each once; what comes back meets the
   chunk's texts again and is added up for each document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import long_rows, memory_returned, written
from .vectors import U64, mixed

ORDER = 5
#: Characters handled at a time; bytes of text in a chunk; n-grams in a shard.
BLOCK, CHUNK, SHARD = 1 << 20, 32 << 20, 1 << 18
#: N-grams that all chunks together may ask of one shard (ten bytes each, with the answer).
MOST_ASKED = 1 << 25
#: Different n-grams that a task gathers before it sends them on.
MOST_KNOWN = 1 << 20
#: Trusted ids that are sent to all tasks (8 bytes each); more are joined by shuffle.
MOST_SENT = 1 << 22


def normal(text: str | None) -> str:
    """text with runs of white space as one space, none at its ends, and ORDER - 1 spaces before it; empty if nothing is left."""
    line = " ".join((text or "").split())
    return " " * (ORDER - 1) + line if line else ""


def _blocks(texts: list[str | None]):
    """Of about BLOCK characters of texts each: the first text's number, the characters, the hashes of their n-grams, where those begin, and how many each text has."""
    lo, n = 0, len(texts)
    while lo < n:
        lines, size, hi = [], 0, lo
        while hi < n and (hi == lo or size < BLOCK):
            lines.append(normal(texts[hi]))
            size += len(lines[-1])
            hi += 1
        line = "".join(lines)
        lengths = np.fromiter(map(len, lines), np.int64, len(lines))
        counts = np.maximum(lengths - (ORDER - 1), 0)
        begin = np.repeat(np.cumsum(lengths) - lengths - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        yield lo, line, gram_hashes(line)[begin], begin, counts
        lo = hi


def gram_hashes(line: str) -> np.ndarray:
    """A hash of the ORDER characters from each place on: a polynomial of their code points, mixed."""
    points = np.frombuffer(line.encode("utf-32-le"), np.uint32).astype(U64)
    if len(points) < ORDER:
        return np.zeros(0, U64)
    n = len(points) - ORDER + 1
    out = points[:n] + U64(1)
    with np.errstate(over="ignore"):
        for k in range(1, ORDER):
            out *= U64(0xD1342543DE82EF95)
            out += points[k : n + k] + U64(1)
        return mixed(out)


def _ranked(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different hashes in order, where each first is in the sorted order of all, and that order."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(hashes) else order
    return ordered[first], first, order


def _distinct(hashes: np.ndarray) -> np.ndarray:
    hashes = np.sort(hashes)
    return hashes[np.append(True, hashes[1:] != hashes[:-1])] if len(hashes) else hashes


def counted(texts: DataFrame) -> DataFrame:
    """(g string, n long): every n-gram of texts (text, trusted), and how often it occurs in trusted ones. A task adds up its own first."""

    def run(batches):
        known, n, grams = np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, object)
        for batch in batches:
            trusted = np.asarray(batch.column(1).to_pylist(), np.int64)
            for lo, line, hashes, begin, counts in _blocks(batch.column(0).to_pylist()):
                if not len(hashes):
                    continue
                h, first, order = _ranked(hashes)
                own = np.add.reduceat(np.repeat(trusted[lo : lo + len(counts)], counts)[order], first)
                at = np.searchsorted(known, h)
                old = known[np.minimum(at, len(known) - 1)] == h if len(known) else np.zeros(len(h), bool)
                n[at[old]] += own[old]
                new = ~old
                fresh = np.empty(int(new.sum()), object)
                fresh[:] = [line[i : i + ORDER] for i in begin[order[first[new]]].tolist()]
                known, n, grams = (np.insert(x, at[new], y) for x, y in ((known, h[new]), (n, own[new]), (grams, fresh)))
                if len(known) > MOST_KNOWN:
                    yield from rows(n, grams)
                    known, n, grams = known[:0], n[:0], grams[:0]
        yield from rows(n, grams)

    def rows(n, g):
        for lo in range(0, len(g), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(g[lo : lo + 100_000], pa.string()), pa.array(n[lo : lo + 100_000])], ["g", "n"])

    return long_rows(texts).select("text", "trusted").mapInArrow(run, "g string, n long").groupBy("g").agg(F.sum("n").alias("n"))


def discounts(once: float, twice: float, thrice: float, four: float) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more; 0.5 where too few counts are known."""
    if min(once, twice, thrice, four) <= 0:
        return [0.5, 0.5, 0.5]
    y = once / (once + 2 * twice)
    return [min(max(d, 0.05), most) for d, most in ((1 - 2 * y * twice / once, 0.95), (2 - 3 * y * thrice / twice, 1.9), (3 - 4 * y * four / thrice, 2.9))]


def probabilities(grams: DataFrame) -> DataFrame:
    """(g, p): the interpolated probability of the last character of every
    n-gram of grams (g, n) after its first ORDER - 1, from the counts n > 0.

    A context without counts leaves the word to the next lower order; below
    order one all characters that are known, and one that is not, are as likely."""
    orders = {ORDER: grams.where("n > 0")}
    for k in range(ORDER - 1, 0, -1):
        orders[k] = written(orders[k + 1].groupBy(F.right("g", F.lit(k)).alias("g")).agg(F.count("*").alias("n")), f"order{k}")
    needed = {ORDER: grams.select("g")}
    for k in range(ORDER - 1, 0, -1):
        needed[k] = needed[k + 1].select(F.right("g", F.lit(k)).alias("g")).distinct()
    out = None
    for k in range(1, ORDER + 1):
        counts = orders[k]
        stats = counts.agg(*(F.count_if(F.col("n") == c) for c in (1, 2, 3, 4)), F.count("*")).first()
        d = discounts(*map(float, stats[:4]))
        cut = lambda n, d=d: F.when(n == 1, d[0]).when(n == 2, d[1]).when(n >= 3, d[2]).otherwise(0.0)
        of = counts.groupBy(F.left("g", F.lit(k - 1)).alias("context")).agg(F.sum("n").alias("total"), F.sum(cut(F.col("n"))).alias("free"))
        rows = needed[k].join(counts, "g", "left").withColumn("context", F.left("g", F.lit(k - 1)))
        rows = rows.join(F.broadcast(of) if k == 1 else of, "context", "left")  # order one has one context
        if out is None:
            rows = rows.withColumn("lower", F.lit(1.0 / (stats[4] + 1)))
        else:
            rows = rows.withColumn("suffix", F.right("g", F.lit(k - 1))).join(out.select(F.col("g").alias("suffix"), F.col("p").alias("lower")), "suffix")
        own = (F.coalesce("n", F.lit(0)) - cut(F.coalesce("n", F.lit(0)))) / F.col("total") + F.col("free") / F.col("total") * F.col("lower")
        out = written(rows.select("g", F.when(F.col("total").isNotNull(), own).otherwise(F.col("lower")).alias("p")), f"p{k}")
    return out


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Ranges of hashes, of equal size."""
    return ((hashes >> U64(32)) * U64(shards) >> U64(32)).astype(np.int32)


def packed(hashes: np.ndarray) -> bytes:
    """Ascending hashes, some at least: 48 low bits as they are, the high 16 as a bitmap in which that of number i, less the first's, is bit x + i."""
    high = (hashes >> U64(48)).astype(np.int64)
    bits = np.zeros(int(high[-1] - high[0]) + len(hashes), bool)
    bits[high - high[0] + np.arange(len(hashes))] = True
    low = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    return np.array([high[0], len(hashes)], "<u4").tobytes() + low.tobytes() + np.packbits(bits).tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    first, n = np.frombuffer(blob, "<u4", 2).tolist()
    out = np.zeros((n, 8), np.uint8)
    out[:, :6] = np.frombuffer(blob, np.uint8, 6 * n, 8).reshape(n, 6)
    high = np.flatnonzero(np.unpackbits(np.frombuffer(blob, np.uint8, -1, 8 + 6 * n))) - np.arange(n) + first
    return out.view("<u8").ravel() | high.astype(U64) << U64(48)


def _asked(shards: int):
    """A chunk's different n-grams, by shard."""

    def run(key, texts):
        memory_returned()
        parts = [_distinct(b[2]) for b in _blocks(texts["text"].to_pylist())]
        h = _distinct(np.concatenate(parts)) if parts else np.zeros(0, U64)
        shard = shard_of(h, shards)
        cuts = [*np.flatnonzero(np.diff(shard, prepend=-1)).tolist(), len(h)]
        blobs = [packed(h[lo:hi]) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.table({"chunk": pa.array([key[0].as_py()] * len(blobs), pa.int32()), "shard": pa.array(shard[cuts[:-1]]), "hashes": pa.array(blobs, pa.binary())})

    return run


def _answered(key, known, asked):
    """For the n-grams that each chunk asks for the logarithms of their probabilities, in the same order."""
    h, p = known["hash"].to_numpy().view(U64), known["p"].to_numpy()
    order = np.argsort(h)
    h, logs = h[order], np.log(p[order]).astype(np.float32)
    found = [logs[np.searchsorted(h, unpacked(x.as_py()))].tobytes() for x in asked["hashes"]]
    return pa.table({"chunk": asked["chunk"], "shard": asked["shard"], "logs": pa.array(found, pa.binary())})


def _hashed(batches):
    for batch in batches:
        h = gram_hashes("".join(batch.column(0).to_pylist()))[::ORDER]
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), batch.column(1)], ["hash", "p"])


def _summed(key, texts, answers):
    """Every text of a chunk with its n-grams' number and perplexity."""
    memory_returned()
    blocks = []  # of each its different n-grams, for each of its places which of them is there, and the texts' counts
    for _, _, hashes, _, counts in _blocks(texts["text"].to_pylist()):
        h, first, order = _ranked(hashes)
        which = np.empty(len(hashes), np.int32)
        which[order] = np.repeat(np.arange(len(h), dtype=np.int32), np.diff(np.append(first, len(hashes))))
        blocks.append((h, which, counts))
    h = _distinct(np.concatenate([b[0] for b in blocks])) if blocks else np.zeros(0, U64)
    order = np.argsort(answers["shard"].to_numpy())  # shards are ranges, so their answers are in the order of the hashes
    logs = np.frombuffer(b"".join(answers["logs"][int(k)].as_py() for k in order), np.float32)
    n, sums = [], []
    for own, which, counts in blocks:
        total = np.concatenate([[0], np.cumsum(logs[np.searchsorted(h, own)][which], dtype=np.float64)])
        ends = np.cumsum(counts)
        n.append(counts)
        sums.append(total[ends] - total[ends - counts])
    n, sums = (np.concatenate(x) if x else np.zeros(0) for x in (n, sums))
    value = np.exp(-sums / np.maximum(n, 1))
    return pa.table([texts["id"], *texts.columns[3:], pa.array(n.astype(np.int64)), pa.array(value, pa.float64(), mask=n == 0)], ["id", *texts.column_names[3:], "n_symbols", "perplexity"])



def perplexities(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id_col, keep..., n_symbols, perplexity) of every row; null for texts
    that are null or blank. known (g, p) has every n-gram of the texts; equal
    64-bit hashes are taken as equal n-grams. Texts are shuffled once."""
    spark = docs.sparkSession
    rows = long_rows(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *(F.col(c).alias(f"k{k}") for k, c in enumerate(keep)))
    size, grams = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0, known.count()
    # few chunks ask for less in all; but no core should wait for want of one
    chunks = max(-(-size // CHUNK), min(spark.sparkContext.defaultParallelism, size >> 20), 1)
    # a shard is asked by every chunk: their number grows with what all chunks may ask, so that a group stays bounded
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-grams // SHARD), -(-chunks * min(grams, CHUNK) // MOST_ASKED))
    chunk = F.pmod(F.xxhash64("id", "text"), F.lit(chunks)).cast("int")
    extra = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema.fields[2:])
    texts = rows.select(chunk.alias("chunk"), *rows.columns).repartition(chunks, "chunk")
    table = known.select("g", "p").mapInArrow(_hashed, "hash long, p double")
    table = table.select(F.shiftright(F.shiftrightunsigned("hash", 32) * shards, 32).cast("int").alias("shard"), "hash", "p")
    asked = texts.groupBy("chunk").applyInArrow(_asked(shards), "chunk int, shard int, hashes binary")
    answers = table.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(_answered, "chunk int, shard int, logs binary")
    out = texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_summed, f"id {rows.schema['id'].dataType.simpleString()}, {extra}n_symbols long, perplexity double")
    return out.select(F.col("id").alias(id_col), *(F.col(f"k{k}").alias(c) for k, c in enumerate(keep)), "n_symbols", "perplexity")


def classify(docs: DataFrame, labels: DataFrame, quantile: float = 0.99) -> DataFrame:
    """(doc_id, lang, n_symbols, perplexity, threshold, keep) of every row of docs.

    Trusted are the documents that labels calls good (quality 1 in all of
    their rows) and not toxic (in none). Seven eighths of them, by a hash of
    doc_id, train the model; the others set each language's threshold, a
    quantile of their perplexity. Languages without such documents, and null,
    take the quantile over all languages; if nothing is trusted all is kept
    that has text. keep is false for null and blank texts.
    Null ids are never trusted. Repeated rows stay repeated; other columns are
    not read."""
    trusted = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t")).where("q = 1 and t = 0").select("doc_id")
    trusted = written(trusted, "trusted")
    few = trusted.limit(MOST_SENT + 1).count() <= MOST_SENT
    side = (F.broadcast(trusted) if few else trusted.hint("merge")).withColumn("trusted", F.lit(1))
    aside = F.pmod(F.xxhash64("doc_id"), F.lit(8)) == 0
    own = docs.select("doc_id", "text").join(side, "doc_id", "left").select("text", F.when(~aside, F.coalesce("trusted", F.lit(0))).otherwise(0).alias("trusted"))
    grams = written(counted(own), "grams")
    known = probabilities(grams)
    scored = written(perplexities(docs, known, keep=("lang",)), "perplexities")
    judged = scored.where(aside & F.col("perplexity").isNotNull()).join(F.broadcast(trusted) if few else trusted.hint("merge"), "doc_id", "left_semi")
    limit = F.percentile_approx("perplexity", quantile, 10_000)
    of = judged.where("lang is not null").groupBy(F.col("lang").alias("of")).agg(limit.alias("own"))
    every = judged.agg(limit).first()[0]
    out = scored.join(of, F.col("lang") == F.col("of"), "left").withColumn("threshold", F.coalesce("own", F.lit(every).cast("double")))
    return out.select("doc_id", "lang", "n_symbols", "perplexity", "threshold", (F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))).alias("keep"))
