"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.  Null and empty texts pass every
stage that has no reason to drop them; an empty table stays empty.  Rows that
share an id are documents of their own (see ``numbered``).  As its ``docs`` are
written, a stage first deletes the scratch tables of the stage before it.
"""

from __future__ import annotations

import gc
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skerry.llm import lines, minhash, mixing, packing, quality
from skerry.llm.common import numbered, words
from skerry.llm.queries import word_tokenizer
from skerry.scratch import materialize, release, written
from skerry.session import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Scratch tables that the last stage's result reads.
_left: list[str] = []


def _stage(f: Callable) -> Callable:
    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        gc.collect()  # frames in cycles hold plans in the driver's JVM
        release(spark, _left, unless_read_by=docs)
        before = written()
        out = f(spark, docs, sf_dir)
        _left[:] = [x for x in written() if x not in before]
        return out

    return run_stage


@_stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores at 0.7 or more; the others go."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), max_rows=4000)
    return quality.classify(docs, model, cut=0.7).filter("predicted = 1").select(COLUMNS)


@_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that (nearly) repeat an earlier one.

    Of repeated lines that hold a word the first occurrence stays.  Lines of 32
    bytes or more also repeat nearly:
    within two edits of letters, or one of words for each 16.  A document
    that loses every word this way goes; one that had none before stays.
    """
    out = lines.dedup_lines(docs, edits=2, min_bytes=32, rate=16, short=True)
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    return out.filter(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


@_stage
def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked at 0.8 over 5-word shingles."""
    rows, _ = numbered(docs, "doc_id", "text")
    found = minhash.near_duplicates(rows.select("__row", "text"), words=5, percent=80, id_col="__row").filter("not kept").select("__row")
    return rows.join(found, "__row", "left_anti").select(COLUMNS)


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix reads them: not at all, once or twice (then as two rows)."""
    rows, _ = numbered(docs, "doc_id", "text")
    sizes = materialize(rows.select("__row", "source", F.size(words(F.col("text"))).cast("long").alias("size")), "sizes")
    mixed = mixing.mix_documents(sizes, key="__row").filter("copies > 0").groupBy(F.col("__row").alias("__id")).agg(F.max("copies").alias("copies"))
    return rows.join(mixed, F.col("__row").eqNullSafe(F.col("__id"))).select(*COLUMNS, F.explode(F.sequence(F.lit(1), "copies"))).select(COLUMNS)


@_stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of 4096 tokens at most, and their places in packed sequences."""
    return packing.pack_documents(docs, word_tokenizer(), capacity=4096)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", minhash_near_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Edit joins, sketches and a tokenizer have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name, drop=(docs,))
    return docs
