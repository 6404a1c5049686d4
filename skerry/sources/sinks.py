"""Writers: staged, verified, partitioned, and merging."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import keep_first


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_chunked(df: DataFrame, path: str, rows_per_file: int = 100_000, mode: str = "overwrite") -> None:
    """zstd Parquet parts of at most ``rows_per_file`` rows."""
    df.write.mode(mode).option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(path)


def write_row_groups(df: DataFrame, path: str, rows_per_group: int = 2_000_000, files: int | None = None) -> None:
    """zstd Parquet whose row groups hold at most ``rows_per_group`` rows, so that a reader's memory is bounded."""
    parts = df if files is None else df.repartition(files)
    parts.write.mode("overwrite").option("compression", "zstd").option("parquet.block.row.count.limit", rows_per_group).parquet(path)


def row_groups(spark: SparkSession, path: str) -> DataFrame:
    """``(path, row_group, n_rows)`` by the footers of Parquet files; a file without a readable footer gives null numbers.

    A task reads a file whole (files up to 2 GB), files without rows give none.
    """
    import io

    import pyarrow as pa
    import pyarrow.parquet as pq

    def run(batches):
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1)):
                try:
                    meta = pq.read_metadata(io.BytesIO(content.as_py()))
                    n = [meta.row_group(k).num_rows for k in range(meta.num_row_groups)]
                except pa.ArrowInvalid:
                    yield pa.RecordBatch.from_pydict({"path": [name], "row_group": pa.array([None], pa.int32()), "n_rows": pa.array([None], pa.int64())})
                    continue
                yield pa.RecordBatch.from_pydict({"path": [name] * len(n), "row_group": pa.array(range(len(n)), pa.int32()), "n_rows": pa.array(n, pa.int64())})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)
    return files.select("path", "content").mapInArrow(run, "path string, row_group int, n_rows long")


def write_sorted(df: DataFrame, path: str, keys: Sequence[str], partitions: int) -> None:
    """Range-partitioned parts, sorted by key inside, so that readers can skip row groups."""
    df.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys).write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_by_parent(df: DataFrame, path: str, column: str, kind: str = "parquet") -> None:
    """One folder a value of ``column``."""
    df.write.mode("overwrite").partitionBy(column).format(kind).option("header", True).save(path)


def swap_verified(df: DataFrame, path: str, expect_rows: int | None = None) -> int:
    """Writes a new version beside the others, counts what was written, and only then makes it the table.

    Returns the rows.  A count other than expected leaves ``path`` as it was.
    Versions are folders of ``path``; the one with the largest number that has a
    mark beside it is the table.  A mark is made in one step after its version is
    whole, so a crash at any time leaves the version before.
    """
    spark = df.sparkSession
    fs, root = _fs(spark, path)
    now = _version(spark, path)
    stage = f"{path}/v{now + 1:09d}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(stage)
    n = spark.read.parquet(stage).count()
    if expect_rows is not None and n != expect_rows:
        fs.delete(_fs(spark, stage)[1], True)
        raise ValueError(f"{n} rows were written, {expect_rows} expected; {path} is unchanged")
    fs.create(_fs(spark, f"{stage}.done")[1], False).close()
    for kind in fs.listStatus(root):  # older versions, marks first
        name = kind.getPath().getName()
        if name.endswith(".done") and int(name[1:10]) <= now:
            fs.delete(kind.getPath(), False)
            fs.delete(_fs(spark, f"{path}/{name.removesuffix('.done')}")[1], True)
    return n


def _marks(spark: SparkSession, path: str) -> list[str]:
    fs, root = _fs(spark, path)
    names = [x.getPath().getName() for x in fs.listStatus(root)] if fs.exists(root) else []
    return sorted(x.removesuffix(".done") for x in names if x.endswith(".done"))


def _version(spark: SparkSession, path: str) -> int:
    marks = _marks(spark, path)
    return int(marks[-1][1:10]) if marks else 0


def read_swapped(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``swap_verified`` made last, whatever an interrupted one left beside it."""
    return spark.read.parquet(f"{path}/{_marks(spark, path)[-1]}")


def merge_archive(df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str]) -> int:
    """Adds rows to an archive and keeps the first of each key, old rows before new ones."""
    spark = df.sparkSession
    new = df.withColumn("__age", F.lit(1))
    both = read_swapped(spark, path).withColumn("__age", F.lit(0)).unionByName(new, allowMissingColumns=True) if _marks(spark, path) else new
    return swap_verified(keep_first(both, keys, ["__age", *order]).drop("__age"), path)


def with_total(df: DataFrame, label: str, sums: Sequence[str], name: str = "GLOBAL TOTAL") -> DataFrame:
    """A report and its total row."""
    total = df.agg(*[F.sum(c).cast(df.schema[c].dataType).alias(c) for c in sums]).withColumn(label, F.lit(name))
    return df.unionByName(total, allowMissingColumns=True)


def export_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_events(df: DataFrame, path: str, author: str = "by") -> None:
    """Appends ledger events; every event must name its author."""
    if author not in df.columns:
        raise ValueError(f"events need a column {author}")
    df.withColumn(author, F.when(F.length(author) > 0, F.col(author)).otherwise(F.raise_error(F.lit("an event without an author")))).write.mode("append").json(path)


def split_by_contract(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep every rule, and the others with the names of what they break."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]))
    tagged = df.withColumn("broken", broken)
    return tagged.filter(F.size("broken") == 0).drop("broken"), tagged.filter(F.size("broken") > 0)
