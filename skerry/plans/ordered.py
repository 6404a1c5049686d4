"""Ranks, pages and running sums over all rows, without a task that holds them all.

The registered SQL of these queries numbers rows by one global window and stays
the oracle; the plans here cut the order into cells (see ``operators.ranking``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ranking import rank_in_cells, value_cell
from ..session import table
from ..sources.manifests import with_row_index
from .registry import scalable
from .roles import DET, DET_ROWS

#: Rows of a block of the trailing mean.
BLOCK = 65_536


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_row_index(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])


def _role(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in ("lineitem", "orders") if "{" + t + "}" in text})


@scalable("src03_single_row_by_position")
def src03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).filter("row_index = 17").select("o_orderkey")


@scalable("srt05_offset_page_by_row_index")
def srt05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).filter("row_index >= 40 and row_index < 60").select("row_index", "o_orderkey")


@scalable("srt06_clamped_page")
def srt06(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey")
    last = min(99_999, math.ceil(parts.count() / 25) - 1)
    return with_row_index(parts, ["p_partkey"]).filter(F.floor(F.col("row_index") / 25) == last).select("p_partkey")


@scalable("srt07_systematic_sample")
def srt07(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    n = orders.count()
    step = lambda i: F.floor(i * 50 / F.lit(n))
    return orders.filter((F.col("row_index") == 0) | (step(F.col("row_index")) != step(F.col("row_index") - 1))).select("o_orderkey")


@scalable("str08_row_offset_shards")
def str08(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    n = orders.count()
    return orders.groupBy(F.floor((F.col("row_index") * 4 + 3) / F.lit(n)).cast("long").alias("shard")).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_id"))


@scalable("pip20_negatives_to_target_share")
def pip20(spark: SparkSession, sf_dir: str) -> DataFrame:
    positive = _role(spark, sf_dir, f"WITH {DET} SELECT count(*) FROM det WHERE conf >= 0.5").first()[0]
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P' or o_orderstatus is null")
    empty = orders.join(table(spark, sf_dir, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").select(F.col("o_orderkey").alias("image_id"))
    return with_row_index(empty, ["image_id"]).filter(F.col("row_index") < math.floor(0.1 * positive / 0.9)).select("image_id")


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))


def _before(df: DataFrame, cell: Column, order: list[Column | str]) -> DataFrame:
    """Adds ``before``, the sum of ``n`` over the rows that come first."""
    return rank_in_cells(df.withColumn("__all", F.lit(0)).withColumn("__cell", cell), ["__all"], "__cell", order, "before", weight="n").drop("__all", "__cell")


def _hash_order(text: Column) -> tuple[Column, Column]:
    """The md5 of a text and a cell that follows its order."""
    h = F.md5(text)
    return h, F.conv(F.substring(h, 1, 2), 16, 10).cast("int")


@scalable("srt12_group_split_to_fraction")
def srt12(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = table(spark, sf_dir, "orders").count()
    h, cell = _hash_order(F.col("o_custkey").cast("string"))
    val = F.col("before") < 0.2 * F.lit(total)
    return _before(_groups(spark, sf_dir), cell, [h, "o_custkey"]).select("o_custkey", F.when(val, "val").otherwise("train").alias("split"))


@scalable("srt13_group_reservation")
def srt13(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = _groups(spark, sf_dir)
    cell = (1000 - F.least("n", F.lit(1000))) * 64 + value_cell(groups, "o_custkey", 64)
    return _before(groups, cell, [F.desc("n"), "o_custkey"]).filter("before < 100").select("o_custkey", "n")


@scalable("pip21_reserve_whole_groups")
def pip21(spark: SparkSession, sf_dir: str) -> DataFrame:
    h, cell = _hash_order(F.concat(F.lit("reserve"), F.col("o_custkey").cast("string")))
    return _before(_groups(spark, sf_dir), cell, [h, "o_custkey"]).filter("before < 60").select(F.col("o_custkey").alias("grp"), F.col("n").alias("ids"))


@scalable("win19_round_robin_interleave")
def win19(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _role(spark, sf_dir, f"WITH {DET_ROWS} SELECT DISTINCT drive, image_id FROM det_rows")
    d = rank_in_cells(d.withColumn("__cell", value_cell(d, "image_id", 64)), ["drive"], "__cell", ["image_id"], "i").drop("__cell")
    d = d.withColumn("block", F.floor(F.col("i") / 256).cast("long")).drop("i")
    turns = with_row_index(d.select("block", "drive").distinct(), ["block", "drive"]).select("block", "drive", (F.col("row_index") + 1).alias("turn"))
    return d.join(turns, ["block", "drive"]).select("drive", "image_id", "block", "turn")


@scalable("srt02_locality_order")
def srt02(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _role(spark, sf_dir, f"WITH {DET} SELECT drive, cell, image_id, det_idx FROM det")
    ranked = rank_in_cells(d.withColumn("__cell", value_cell(d, "image_id", 64)), ["drive", "cell"], "__cell", ["image_id", "det_idx"], "pos")
    return ranked.select("image_id", "det_idx", (F.col("pos") + 1).alias("pos"))


@scalable("win17_trailing_boxes_per_image")
def win17(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of a status's images; a block also gets the 99 images before it."""
    n = _role(spark, sf_dir, f"WITH {DET} SELECT image_id, count(*) AS n_det FROM det GROUP BY 1")
    images = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image_id"), F.when(F.col("o_orderstatus") == "P", 3).otherwise(0).alias("status")).join(n, "image_id", "left")
    ranked = rank_in_cells(images.withColumn("__cell", value_cell(images, "image_id", 64)), ["status"], "__cell", ["image_id"], "pos").drop("__cell")
    block = F.floor(F.col("pos") / BLOCK)
    after = F.floor((F.col("pos") + 99) / BLOCK)
    copies = ranked.withColumn("own", block).withColumn("block", F.explode(F.array_distinct(F.array(block, after))))
    mean = F.avg(F.coalesce("n_det", F.lit(0))).over(Window.partitionBy("status", "block").orderBy("pos").rowsBetween(-99, 0))
    return copies.withColumn("trailing", F.round(mean, 6)).filter("own = block").select("image_id", "trailing")
