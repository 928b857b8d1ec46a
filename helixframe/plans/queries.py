"""All registered queries of the reference's operators."""

from . import assembly_queries, graph_queries, kmer_queries, layout_queries, mapping_queries, more_queries, overlap_queries, record_queries, source_queries, variant_queries  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
