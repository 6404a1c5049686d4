"""Parquet, CSV, JSON and text scans that tolerate what a grown lake holds."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The manifest's columns and types, in file order.
MANIFEST = "image_id STRING, captured_at STRING, sequence STRING, is_pano BOOLEAN, camera_type STRING, computed_compass_angle DOUBLE, height BIGINT, width BIGINT, make STRING, model STRING, thumb_256_url STRING, thumb_1024_url STRING, thumb_2048_url STRING, thumb_original_url STRING, computed_geometry STRING, creator STRING, detections STRING"
GRID = "sw_lon DOUBLE, sw_lat DOUBLE, ne_lon DOUBLE, ne_lat DOUBLE, region STRING"


def schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def coerce(df: DataFrame, want: T.StructType) -> DataFrame:
    """``df`` with exactly the columns of ``want``: absent ones null, nested ones as JSON, bad values null."""
    have = {f.name: f for f in df.schema.fields}

    def one(f: T.StructField) -> Column:
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        kind = have[f.name].dataType
        if isinstance(f.dataType, T.StringType) and isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
            return F.to_json(f.name).alias(f.name)
        return F.col(f.name).try_cast(f.dataType).alias(f.name)

    return df.select(*[one(f) for f in want.fields])


def read_manifests(spark: SparkSession, paths: Sequence[str], ddl: str = MANIFEST) -> tuple[DataFrame, list[tuple[str, str]]]:
    """All readable files as one frame of ``ddl``, and ``(path, error)`` of the others.

    Files are read one by one, as an all-null column is stored without a type and
    no merged schema fits it; the union is one plan.  For files that share one
    schema use ``spark.read.schema(...)`` on the whole list.
    """
    want, parts, bad = schema(ddl), [], []
    for path in paths:
        try:
            one = spark.read.parquet(path)
            parts.append(coerce(one, want))
        except Exception as e:
            bad.append((path, str(e).split("\n")[0][:200]))
    if not parts:
        return spark.createDataFrame([], want), bad
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, bad


def read_store(spark: SparkSession, root: str, ddl: str, suffix: str = "*.parquet") -> DataFrame:
    """A hive-partitioned store by an explicit schema; columns that old files lack are null, an empty store has no rows."""
    try:
        return spark.read.schema(schema(ddl)).option("basePath", root).option("pathGlobFilter", suffix).option("recursiveFileLookup", "false").parquet(root)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER" in str(e):
            return spark.createDataFrame([], schema(ddl))
        raise


def rows_by_file(df: DataFrame) -> DataFrame:
    """Row count of each file behind a scan."""
    return df.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n_rows"))


def with_row_index(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds a gapless ``row_index`` in a declared order."""
    from ..operators.ranking import rank_in_cells, value_cell

    keyed = df.withColumn("__all", F.lit(0)).withColumn("__cell", value_cell(df, order[0], 64))
    return rank_in_cells(keyed, ["__all"], "__cell", order, "row_index").drop("__all", "__cell")


def read_grid(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema(GRID)).option("header", True).csv(path)


def read_jsonl(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """JSON lines; blank, torn, malformed and non-object lines are dropped."""
    lines = spark.read.text(path).filter(F.col("value").rlike(r"^\s*\{"))
    parsed = lines.select(F.from_json("value", f"{ddl}, __bad STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}).alias("x"))
    return parsed.filter("x is not null and x.__bad is null").select("x.*").drop("__bad")


def read_json_map(spark: SparkSession, path: str, value_ddl: str = "STRING") -> DataFrame:
    """One JSON object per file as ``(key, value)`` rows."""
    return spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", f"MAP<STRING, {value_ddl}>")).alias("key", "value"))


def read_documents(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """JSON documents of several lines, one a file; what is no document is dropped."""
    want = schema(f"{ddl}, __bad STRING")
    df = spark.read.schema(want).option("multiLine", True).option("columnNameOfCorruptRecord", "__bad").option("recursiveFileLookup", True).json(path)
    return df.filter("__bad is null").drop("__bad")


def read_or_else(read: Callable[[], DataFrame], other: Callable[[], DataFrame], tries: int = 5, wait: float = 1.0) -> tuple[DataFrame, bool]:
    """What ``read`` returns, tried up to ``tries`` times, ``wait`` seconds apart; else ``other``, and whether it stands in."""
    for k in range(tries):
        try:
            return read(), False
        except AnalysisException:
            time.sleep(wait if k + 1 < tries else 0)
    return other(), True


def digit_stems(files: DataFrame) -> DataFrame:
    """A listing with ``id``: the stem where it is all digits, else null."""
    return files.withColumn("id", F.when(F.col("stem").rlike("^[0-9]+$"), F.col("stem").try_cast("bigint")))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Distinct trimmed lines without blanks and ``#`` comments."""
    line = F.trim(F.regexp_replace("value", "#.*$", ""))
    return spark.read.text(path).select(line.alias("line")).filter("line <> ''").distinct()


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Ids in raw JSON lines, by pattern and without parsing them."""
    return spark.read.text(path).select(F.regexp_extract("value", r'"image_id"\s*:\s*"?([^",}]+)"?', 1).alias("image_id")).filter("image_id <> ''")


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Files below ``path`` as ``(path, size, modified, stem)``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1).alias("stem"))


def read_yolo(spark: SparkSession, path: str) -> DataFrame:
    """Label lines ``class cx cy w h`` as corner boxes; other lines are dropped."""
    p = F.split(F.trim("value"), r"\s+")
    num = lambda k: F.get(p, F.lit(k)).try_cast("double")
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), num(0).cast("int").alias("label"), *[num(k + 1).alias(c) for k, c in enumerate(("cx", "cy", "w", "h"))]).dropna()
    return rows.select("file", "label", (F.col("cx") - F.col("w") / 2).alias("x1"), (F.col("cy") - F.col("h") / 2).alias("y1"), (F.col("cx") + F.col("w") / 2).alias("x2"), (F.col("cy") + F.col("h") / 2).alias("y2"))


def read_curve(spark: SparkSession, path: str) -> DataFrame:
    """A training CSV with padded headers; cells that are no numbers become null."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(*[F.trim(F.col(f"`{c}`")).try_cast("double").alias(c.strip()) for c in raw.columns])
