"""k-mer counts of a stream of records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.kmer import enumerate_kmers


def running_counts(records: DataFrame, k: int, seq_col: str = "seq") -> DataFrame:
    """(kmer, cnt) over all records so far; for output mode complete or update. The state is one row for each k-mer."""
    return enumerate_kmers(records, k, seq_col).groupBy("kmer").agg(F.count("*").alias("cnt"))


def windowed_counts(events: DataFrame, time: str, by: str, width: str, late: str) -> DataFrame:
    """(window_start, by, n) of events in windows of time; what comes later than `late` is left out, and a window is given out once it is over."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), by, "n")
