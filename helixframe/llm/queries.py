"""The registered queries opN_<name> and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .gif import media_digests

    return media_digests(table(spark, sf_dir, "documents"))


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import revisit_table

    return revisit_table(table(spark, sf_dir, "pages"))


def op4_uniform_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import uniform_shards

    text = F.coalesce("text", F.lit(""))
    return uniform_shards(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import identify

    return identify(table(spark, sf_dir, "documents"))


def op6_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .perplexity import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    from .bpe import encode_and_decode

    return encode_and_decode(table(spark, sf_dir, "documents"), tokenizer or default_tokenizer())


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substrings import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import chat

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.chat_digests(rows.unionByName(chat.tricky(spark)))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contamination_digests

    return contamination_digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_hyperminhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .hyperminhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lloyd import vector_codes

    return vector_codes(table(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .audit import filter_audit

    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup,
        op2_gif_media,
        op3_warc_revisits,
        op4_uniform_shards,
        op5_language_id,
        op6_kneser_ney_quality,
        op7_byte_bpe,
        op8_substring_dedup,
        op9_chat_format,
        op10_decontaminate,
        op11_hyperminhash_near_dedup,
        op12_vector_codes,
        op13_filter_audit,
    )
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import audit, chat, decontaminate, lloyd, substrings, warc

    return {"op3_warc_revisits": warc.SQL, "op9_chat_format": chat.SQL, "op8_substring_dedup": substrings.SQL, "op10_decontaminate": decontaminate.SQL, "op12_vector_codes": lloyd.SQL, "op13_filter_audit": audit.SQL}
