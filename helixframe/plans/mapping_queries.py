"""Mapping of documents' letters to benchmark items: chains of seeds, alignments, base alignment qualities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.sequence import canonical, reverse_complement
from ..operators import banded, chaining, graph, polishing, realign, voting
from .kmer_queries import dna_sql, seqs
from .registry import query

#: Letters of a seed; between two of a chain less than so many letters.
K, JUMP = 11, 200
RC = "reverse(translate({0}, 'ACGT', 'TGCA'))"


def _seeds_sql(name: str, k: int) -> str:
    return f"(SELECT id, pos, least(kmer, {RC.format('kmer')}) AS m, kmer > {RC.format('kmer')} AS back FROM {dna_sql(name, k=k, both=False)})"


def _chains_sql(name: str, k: int, jump: int, least: int) -> str:
    """The best chain of each document, row of a table and strand: a fold over lists of scores and of the anchors before."""
    anchors = f"(SELECT x.id AS a, y.id AS b, x.back <> y.back AS back, x.pos AS x, CASE WHEN x.back <> y.back THEN -y.pos ELSE y.pos END AS y FROM {_seeds_sql('documents', k)} x JOIN {_seeds_sql(name, k)} y ON y.m = x.m)"
    fits = f"xs[i + 1] - xs[j] > 0 AND xs[i + 1] - xs[j] < {jump} AND ys[i + 1] - ys[j] > 0 AND ys[i + 1] - ys[j] < {jump}"
    drift = "abs(xs[i + 1] - xs[j] - ys[i + 1] + ys[j])"
    cost = f"CASE WHEN {drift} > 100 THEN 2 * {drift} ELSE {drift} // 2 END"
    return f"""(WITH RECURSIVE p AS (SELECT a, b, back, list(x ORDER BY x, y) AS xs, list(y ORDER BY x, y) AS ys FROM {anchors} GROUP BY ALL HAVING count(*) >= {least}),
t(a, b, back, i, sc, bf) AS (SELECT a, b, back, 0, CAST([] AS BIGINT[]), CAST([] AS BIGINT[]) FROM p UNION ALL
  SELECT a, b, back, i + 1, list_append(sc, CASE WHEN m > {k} THEN m ELSE {k} END), list_append(bf, CASE WHEN m > {k} THEN len(c) + 1 - list_position(list_reverse(c), m) ELSE 0 END) FROM (
    SELECT *, coalesce(list_max(c), -1) AS m FROM (SELECT t.a, t.b, t.back, i, sc, bf,
      list_transform(range(1, i + 1), lambda j: CASE WHEN {fits} THEN sc[j] + least(xs[i + 1] - xs[j], ys[i + 1] - ys[j], {k}) - {cost} ELSE -1 END) AS c
      FROM t JOIN p ON p.a = t.a AND p.b = t.b AND p.back = t.back WHERE i < len(xs)))),
f AS (SELECT t.a, t.b, t.back, sc, bf, xs, ys, list_position(sc, list_max(sc)) AS last FROM t JOIN p ON p.a = t.a AND p.b = t.b AND p.back = t.back WHERE i = len(xs)),
w(a, b, back, x, n) AS (SELECT a, b, back, last, 1 FROM f UNION ALL SELECT w.a, w.b, w.back, bf[x], n + 1 FROM w JOIN f ON f.a = w.a AND f.b = w.b AND f.back = w.back WHERE bf[x] > 0),
g AS (SELECT a, b, back, arg_max(x, n) AS first, CAST(max(n) AS BIGINT) AS n FROM w GROUP BY a, b, back)
SELECT f.a, f.b, f.back, n, sc[last] AS score, xs[first] AS a_lo, xs[last] + {k} AS a_hi, CASE WHEN f.back THEN -ys[last] ELSE ys[first] END AS b_lo, CASE WHEN f.back THEN {k} - ys[first] ELSE ys[last] + {k} END AS b_hi
FROM f JOIN g ON g.a = f.a AND g.b = f.b AND g.back = f.back WHERE n >= {least})"""


def chains(spark, sf_dir, cut: chaining.Cut | None = None) -> DataFrame:
    return chaining.best_between(seqs(spark, sf_dir), seqs(spark, sf_dir, "benchmark"), K, JUMP, 5, cut)


@query(f"SELECT *, round(ln(1 / least(1.0, n / greatest(a_hi - a_lo, b_hi - b_lo))) / {K}, 9) AS divergence FROM {_chains_sql('benchmark', K, JUMP, 5)}")
def overlaps_by_chain_dp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best chain of seeds of each document, item and strand, by a dynamic program with gap costs; no seed is passed over."""
    d = chaining.divergence(F.col("n"), F.col("a_hi") - F.col("a_lo"), F.col("b_hi") - F.col("b_lo"), K)
    return chains(spark, sf_dir).withColumn("divergence", F.round(d, 9))


TURNED = str.maketrans("ACGT", "TGCA")


def stretches(spark, sf_dir) -> DataFrame:
    """(a, b, back, a_lo, b_lo, b_hi, x, y): the chained stretches of documents and items, an item's turned to the document's strand."""

    def cut(a: str, b: str, back: bool, a_lo: int, a_hi: int, b_lo: int, b_hi: int) -> tuple[str, str]:
        y = b[b_lo:b_hi]
        return a[a_lo:a_hi], y[::-1].translate(TURNED) if back else y

    return chains(spark, sf_dir, cut).select("a", "b", "back", "a_lo", "b_lo", "b_hi", "x", "y")


@query()
def chains_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chained stretches aligned letter by letter, with affine gaps in a band: score, CIGAR, columns, and the share of them without gaps."""
    rows = banded.cigar_columns(banded.aligned(stretches(spark, sf_dir), "x", "y", band=200))
    return rows.select("a", "b", "back", "score", "cigar", "columns", "in_gaps")


@query()
def chains_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the alignment goes on from where a chain of the forward strand begins, until the score drops by 50."""

    def cut(a: str, b: str, back: bool, a_lo: int, a_hi: int, b_lo: int, b_hi: int) -> tuple[str, str]:
        # no alignment is longer than the item and a gap of the band
        return a[a_lo : a_lo + len(b) + 64], b[b_lo:]

    rest = chains(spark, sf_dir, cut).where("not back").select("a", "b", "a_lo", "b_lo", "x", "y")
    out = banded.aligned(rest, "x", "y", band=64, zdrop=50)
    return out.select("a", "b", "a_lo", "b_lo", "score", (F.col("a_lo") + F.col("a_end")).alias("a_hi"), (F.col("b_lo") + F.col("b_end")).alias("b_hi"), "cigar")


@query()
def base_alignment_qualities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aligned stretches with qualities capped by how sure the letters' places are: letters, their qualities' sum before and after, how many are lower, and the cap of the mapping quality."""
    rows = banded.aligned(stretches(spark, sf_dir), "x", "y", band=200)
    qual = F.transform(F.sequence(F.lit(1), F.length("x")), lambda i: (10 + (F.col("a") * 7 + i) % 30).cast("int"))
    out = realign.base_alignment_qualities(rows.select("a", "b", "back", "x", qual.alias("qual"), "y", F.lit(0).alias("pos"), "cigar"), "x", "qual", "y", drop=("x", "y", "pos", "cigar"))
    total = lambda c: F.aggregate(c, F.lit(0), lambda s, v: s + v)
    lower = F.size(F.filter(F.zip_with("qual", "baq", lambda p, q: q < p), lambda x: x))
    return out.select("a", "b", "back", F.size("baq").alias("n"), total("qual").alias("before"), total("baq").alias("after"), lower.alias("n_lower"), "cap")


#: A bubble's branches, as many as the polisher takes.
MOST_BRANCHES = 50


@query()
def bubbles_polished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stretches of items that documents are chained to, polished by those documents: a row for each bubble, of the branches the first by document."""
    rows = stretches(spark, sf_dir).withColumn("k", F.row_number().over(Window.partitionBy("b", "back", "b_lo", "b_hi").orderBy("a", "a_lo"))).where(F.col("k") <= MOST_BRANCHES)
    bubbles = rows.groupBy("b", "back", "b_lo", "b_hi").agg(F.first("y").alias("candidate"), F.transform(F.array_sort(F.collect_list(F.struct("a", "a_lo", "x"))), lambda s: s["x"]).alias("branches"))
    # few bytes, and much work on each
    out = polishing.polished(chaining.dealt(bubbles))
    return out.select("b", "back", "b_lo", "b_hi", F.size("branches").alias("depth"), "candidate", "polished", F.round("score", 6).alias("score"), "changes")


def overlapped(spark, sf_dir) -> DataFrame:
    """(id, pos, part, other, cigar, of, back): the chained stretches aligned, from the side of the document (id: its number) and from that of the item (below zero: its number taken from -1), each on its own strand."""
    forward = lambda c: F.when(F.col("back"), reverse_complement(F.col(c))).otherwise(F.col(c))
    side = lambda *cols: F.struct(*(c.alias(name) for c, name in zip(cols, ("id", "pos", "part", "other", "of"), strict=True)))
    document, item = F.col("a"), -1 - F.col("b")
    sides = F.array(side(document, F.col("a_lo"), F.col("x"), F.col("y"), item), side(item, F.col("b_lo"), forward("y"), forward("x"), document))
    both = stretches(spark, sf_dir).select(F.inline(sides), "back").select("id", "pos", "part", "other", "of", "back")
    return graph.kept(banded.aligned(both, "part", "other", band=200))


def by_votes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The columns in which an alignment would change something, and the corrections."""
    table = graph.kept(voting.columns(rows))
    return table, voting.corrections(table)


@query()
def corrections_by_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Letters of documents and items with votes for a change, the votes, and what they decide: the new letter (empty: none; null: unchanged) and a letter to insert behind it."""
    table, fixes = by_votes(overlapped(spark, sf_dir))
    return table.join(fixes, ["id", "pos"], "left")


@query()
def overlaps_of_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments made again with both sides corrected: columns that differ before and after."""
    rows = overlapped(spark, sf_dir)
    _, fixes = by_votes(rows)
    fixes = graph.kept(fixes)
    mended = voting.applied(rows, fixes, seq="part", begin="pos", out="mended").select("id", "pos", "of", "back", "part", "other", F.col("cigar").alias("old"), "mended")
    one = mended.where("id >= 0").select("id", "of", "back", "pos", "part", "other", "old", "mended")
    two = mended.where("id < 0").select(F.col("of").alias("id"), F.col("id").alias("of"), "back", F.when(F.col("back"), reverse_complement(F.col("mended"))).otherwise(F.col("mended")).alias("mended_other"))
    both = one.join(two, ["id", "of", "back"])
    # where nothing was corrected the alignment is the old one
    changed = (F.col("mended") != F.col("part")) | (F.col("mended_other") != F.col("other"))
    new = lambda c: F.when(F.col("changed"), F.col(c)).otherwise("")
    both = both.withColumn("changed", changed).withColumns({"x": new("mended"), "y": new("mended_other")})
    again = banded.aligned(chaining.dealt(both, "id", "of"), "x", "y", band=200)
    again = again.withColumns({"before": voting.n_differences("part", "other", "old"), "after": voting.n_differences("x", "y", "cigar")})
    return again.select("id", "of", "back", "before", F.when(F.col("changed"), F.col("after")).otherwise(F.col("before")).alias("after"))
