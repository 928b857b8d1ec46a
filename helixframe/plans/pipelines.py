"""Compositions of operators that users call as one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import canonical
from ..operators import alignment_sets, fasta, graph, kmer, overlap, variants


def genome_size(reads: DataFrame, k: int = 31) -> int:
    """Distinct k-mers that are read twice or more."""
    return kmer.count(reads, k, least=2).count()


def unitigs(reads: DataFrame, k: int, least: int = 2) -> DataFrame:
    """(path, seq): the sequences of the maximal unbranching paths of the
    graph whose edges are the k-mers (of one strand) counted least times or
    more and whose nodes are their ends of k - 1 letters. Here and below k is 31 at most, as k-mers are numbers."""
    out = unitigs_of(kmer.count_codes(reads, k, both_strands=False, least=least), k)
    return out.select(kmer.letters_of(F.col("path"), k - 1).alias("path"), "seq")


def _node_paths(solid: DataFrame, k: int) -> DataFrame:
    """(node, path, place) of the k-mers of solid (code, each once)."""
    return graph.unbranching_paths(solid.select(F.shiftright("code", 2).alias("a"), F.col("code").bitwiseAND(F.lit((1 << 2 * k - 2) - 1)).alias("b")))


def unitigs_of(solid: DataFrame, k: int) -> DataFrame:
    """(path, seq) of the k-mers of solid (code, each once); path is a number, too."""
    letters = F.array_sort(F.collect_list(F.when(F.col("place") > 0, F.struct("place", F.col("node").bitwiseAND(F.lit(3)).cast("byte").alias("letter")))))
    whole = _node_paths(solid, k).groupBy("path").agg(letters.alias("x"))
    rest = F.translate(F.array_join(F.transform("x", lambda n: n["letter"].cast("string")), ""), "0123", "ACGT")
    return whole.select("path", F.concat(kmer.letters_of(F.col("path"), k - 1), rest).alias("seq"))


def multi_k_unitigs(reads: DataFrame, sizes: list[int], least: int = 2) -> DataFrame:
    """(k, seq): unitigs of growing k. The graph of each k has the k-mers that
    reads (seq) have least times or more and all those of the contigs of the k
    before: where coverage is too low for the larger k, the smaller one's
    contigs bridge it, and repeats between the two lengths are told apart.

    It ends early, with the k reached, once no contig has k letters, or when a
    larger k gives the same sequences as the one before. Each round's contigs
    are written, so that a lost executor costs one round."""
    contigs, at = None, 0
    for k in sizes:
        solid = kmer.count_codes(reads, k, both_strands=False, least=least).select("code")
        if contigs is not None:
            carried = contigs.where(F.length("seq") >= k)
            if carried.isEmpty():
                break
            solid = solid.unionByName(kmer.codes(carried, k, both_strands=False)).distinct()
        new = graph.kept(unitigs_of(solid, k).select(F.lit(k).alias("k"), "seq"))
        done = contigs is not None and new.select("seq").exceptAll(contigs.select("seq")).isEmpty()
        contigs, at = new, k
        if done:
            break
    return contigs


def trio_binning(child: DataFrame, one: DataFrame, two: DataFrame, k: int) -> DataFrame:
    """Per read of child (id, seq) which parent's own k-mers it has more of."""
    reads = kmer.enumerate_kmers(child, k, keep=("id",))
    n = kmer.classify_parents(reads, kmer.count(one, k), kmer.count(two, k))
    return n.withColumn("parent", F.when(F.col("n_one") > F.col("n_two"), "one").when(F.col("n_two") > F.col("n_one"), "two").otherwise("none"))


def dnadiff(alignments: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The one-to-one alignments, their summary, and the breaks between them."""
    best = alignment_sets.one_to_one(alignments)
    return best, alignment_sets.difference_report(best), alignment_sets.structural_breaks(best)


def assembly_report(contigs: DataFrame) -> DataFrame:
    """N10 to N90 and the E-size of contigs (id, seq)."""
    sizes = fasta.lengths(contigs)
    n = fasta.size_at(sizes, [10, 25, 50, 75, 90]).select(F.concat(F.lit("N"), F.col("percent").cast("string")).alias("name"), F.col("n_size").cast("double").alias("value"))
    s = fasta.size_stats(sizes, []).select(F.explode(F.map_from_arrays(F.array(F.lit("S"), F.lit("A"), F.lit("E"), F.lit("C")), F.array(F.col("total").cast("double"), "mean", "e_size", F.col("n").cast("double")))).alias("name", "value"))
    return n.unionByName(s)


def unique_mega_reads(reads: DataFrame) -> DataFrame:
    """Reads that differ from one another on either strand: the canonical ones, once each."""
    return reads.select(canonical(F.col("seq")).alias("seq")).dropDuplicates(["seq"])


def overlap_graph(reads: DataFrame, overlaps: DataFrame, lengths: DataFrame, least: int) -> DataFrame:
    """Components of the graph of mutual best dovetails; reads: iid."""
    best = overlap.best_per_end(overlap.with_lengths(overlaps, lengths, least))
    pairs = overlap.mutual_best(best)
    parts = graph.connected_components(pairs, "a_iid", "b_iid")
    return reads.select("iid").join(parts.withColumnRenamed("node", "iid"), "iid", "left").select("iid", F.coalesce("component", "iid").alias("component"))


def polish(reads: DataFrame, reference: DataFrame, least: int) -> DataFrame:
    """(id, seq): sequences from columns (id, pos from 1, base), with the fixes
    that the aligned bases of reads (id, pos, base) vote for."""
    letters = F.array_sort(F.collect_list(F.struct("pos", "base")))
    contigs = reference.groupBy("id").agg(F.array_join(F.transform(letters, lambda c: c["base"]), "").alias("seq"))
    return variants.applied(contigs, variants.voted_fixes(reads, reference, least)).select("id", "seq")


def super_read_names(reads: DataFrame, k: int, least: int) -> DataFrame:
    """(id, n, name): for each read (id, seq) the k-unitigs that its k-mers run
    through, in order and each once a run, joined by _; a unitig goes by its first k - 1 letters."""
    paths = _node_paths(kmer.count_codes(reads, k, both_strands=False, least=least), k).select(F.col("node").alias("code"), "path")
    at = kmer.codes(reads, k - 1, both_strands=False, keep=("id",), positions=True).join(paths, "code")
    before = F.lag("path").over(Window.partitionBy("id").orderBy("pos"))
    runs = at.withColumn("before", before).where("before is null or before <> path")
    units = F.array_sort(F.collect_list(F.struct("pos", kmer.letters_of(F.col("path"), k - 1).alias("path"))))
    return runs.groupBy("id").agg(F.count("*").alias("n"), F.array_join(F.transform(units, lambda u: u["path"]), "_").alias("name"))
