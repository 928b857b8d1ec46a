"""Read stores and messages: tables with versions, trims and flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import kept


def appended(store: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """store with the rows whose key it does not have; of repeated new keys the first row by all columns."""
    new = rows.join(store.select(key).distinct(), key, "left_anti")
    w = Window.partitionBy(key).orderBy(*[c for c in rows.columns if c != key])
    return store.unionByName(new.withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k"))


def edited(store: DataFrame, edits: DataFrame, key: str) -> DataFrame:
    """store with the values of edits (key and some of its columns) where they
    are not null; keys that the store does not have are passed over. One edit a key."""
    changed = [c for c in edits.columns if c != key]
    of = edits.select(key, *(F.col(c).alias(f"__{c}") for c in changed))
    out = store.join(of, key, "left")
    return out.select(*(F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in changed else F.col(c) for c in store.columns))


def clear_part(seq: Column, bgn: Column, end: Column) -> Column:
    """The letters from bgn (from 0) to end."""
    return F.substr(seq, bgn + 1, F.greatest(end - bgn, F.lit(0)))


def dumped_fastq(store: DataFrame) -> DataFrame:
    """(id, seq, qual) of the reads of a store (id, seq, qual, bgn, end, deleted) that are not deleted, cut to their clear range."""
    rows = store.where(~F.col("deleted"))
    return rows.select("id", *(clear_part(F.col(c), F.col("bgn"), F.col("end")).alias(c) for c in ("seq", "qual")))


def latest(versions: DataFrame, key: list[str], version: str) -> DataFrame:
    """Of a table of versions the last row of each key; of equal versions the first by the other columns."""
    w = Window.partitionBy(*key).orderBy(F.desc(version), *[c for c in versions.columns if c not in (*key, version)])
    return versions.withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k")


def renamed(rows: DataFrame, names: DataFrame, columns: list[str]) -> DataFrame:
    """rows with the names (uid, name) in place of uids in columns; a uid without a name stays."""
    for c in columns:
        rows = rows.join(names.select(F.col("uid").alias(c), F.col("name").alias("__name")), c, "left").withColumn(c, F.coalesce("__name", F.col(c))).drop("__name")
    return rows


def mate_links(mates: DataFrame, name: str = "id", pair: str = "pair") -> DataFrame:
    """(first, second) of the pairs of which both mates are there."""
    both = mates.groupBy(pair).agg(F.min(name).alias("first"), F.max(name).alias("second"), F.count("*").alias("n"))
    return both.where("n = 2").select(pair, "first", "second")


def generated(n: int, length: int, seed: int, spark) -> DataFrame:
    """(id, seq): n sequences of length letters, each made of the MD5 digests of seed, id and a running number, two bits a digit; the same on any engine."""
    digests = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(-(-length // 32) - 1)), lambda i: F.md5(F.concat_ws("/", F.lit(str(seed)), F.col("id").cast("string"), i.cast("string")))), "")
    return spark.range(n).select("id", F.translate(F.left(digests, F.lit(length)), "0123456789abcdef", "ACGTACGTACGTACGT").alias("seq"))


def chosen_pairs(pairs: DataFrame, key: str, ratio: float, seed: int) -> DataFrame:
    """About ratio of the pairs: those whose digest of seed and key, as a share of all, is below it. Mates share the key, so they stay together."""
    digest = F.conv(F.substring(F.md5(F.concat_ws("/", F.lit(str(seed)), F.col(key).cast("string"))), 1, 8), 16, 10).cast("double") / float(1 << 32)
    return pairs.where(digest < ratio)


def sampled_to_bases(reads: DataFrame, key: str, size: str, bases: int, seed: int) -> DataFrame:
    """Reads in the order of their digests until they have so many bases: the
    one that reaches them is the last. Running sums come from sums of range
    partitions, so that no task sees all rows; the dealt rows are written
    first, for rows and sums have to be of the same ranges."""
    digest = F.md5(F.concat_ws("/", F.lit(str(seed)), F.col(key).cast("string")))
    by = reads.withColumn("__d", digest).repartitionByRange("__d", key).sortWithinPartitions("__d", key)
    by = kept(by.withColumn("__p", F.spark_partition_id()))
    sums = by.groupBy("__p").agg(F.sum(size).alias("s"))
    before = sums.select("__p", F.coalesce(F.sum("s").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    own = F.coalesce(F.sum(size).over(Window.partitionBy("__p").orderBy("__d", key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return by.join(F.broadcast(before), "__p").withColumn("__own", own).where(F.col("__before") + F.col("__own") < bases).drop("__p", "__d", "__before", "__own")
