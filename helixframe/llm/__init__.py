"""Training-data operators: near-dedup, media, WARC, sharding, language ID,
quality scoring, BPE, substring dedup, chat formatting and decontamination.

Nothing else in the package imports this subpackage.
"""
