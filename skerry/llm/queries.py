"""The registered queries of this sub-package, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import materialize
from ..session import table
from . import langid, lines, minhash, mixing, packing, quality, rules, sharding, suffixes, tiff
from .common import words
from .oracles import ORACLES  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def put(f):
        QUERIES[name] = f
        return f

    return put


@query("op4_ring_sharding")
def op4_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of 16 and its slot there; law `rows`."""
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    out = sharding.shard(docs, "doc_id", shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "home")


@query("op9_llr_quality_rules")
def op9_llr_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and log-likelihood ratio of every document; trusted: labelled quality 1, not toxic."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ratios = rules.fit(docs, rules.trusted_sample(table(spark, sf_dir, "labels"), most=20_000))
    return rules.quality_rules(docs, ratios).drop("text")


def word_tokenizer() -> str:
    """The vocabulary file that the packing query reads."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op8_best_fit_packing")
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces of 4096 tokens at most, packed."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), word_tokenizer(), capacity=4096)


@query("op6_flow_mixing")
def op6_flow_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"))
    out = mixing.mix_documents(materialize(docs, "sizes"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


@query("op3_rule_ensemble_quality")
def op3_rule_ensemble_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; learnt from at most 4000 labelled rows that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), max_rows=4000)
    return quality.classify(docs, model).select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


@query("op7_byte_cnn_language")
def op7_byte_cnn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learnt from at most 400 documents a language that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    net = langid.fit(docs, per_lang=400)
    return langid.identify(docs.select("doc_id", "text", langid.held_out().alias("held_out")), net)


@query("op2_tiff_media")
def op2_tiff_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as a TIFF, read back and described."""
    return tiff.archive(table(spark, sf_dir, "documents"))


@query("op1_fast_sketch_near_dedup")
def op1_fast_sketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document; sets of 2-word shingles, similarity 0.8."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), words=2, percent=80)


@query("op5_segment_line_dedup")
def op5_segment_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its repeated lines removed, as digests; from 32 bytes on near repeats too: 2 edits of letters, or of a word in 16."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = lines.dedup_lines(docs, edits=2, min_bytes=32, rate=16, short=True)
    kept = F.coalesce("text", F.lit(""))
    return out.select("doc_id", "n_lines", "n_removed", F.octet_length(kept).cast("long").alias("kept_bytes"), F.sha2(kept.cast("binary"), 256).alias("kept_sha256"))


@query("op10_suffix_merge_dedup")
def op10_suffix_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes that repeat an earlier 100-byte string, as digests."""
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))
