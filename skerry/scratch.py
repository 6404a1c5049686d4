"""Intermediate tables that survive the loss of any executor.

``materialize`` writes a frame as Parquet into the shared folder that the
session names in ``spark.checkpoint.dir`` and reads it back: lineage is cut,
the next stage sees real file sizes, and a lost executor costs nothing but the
tasks it was running.  ``discard`` deletes such a table as soon as its successor
is written, ``release`` all that are left.  Only where the setting is unset and
the master is local (tests, a laptop) is a local folder made and stored in the
session; on a cluster an unset folder is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"
#: Lets an execution delete its own exchange files at its end; set once a session, so threads don't disturb each other.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session; made and remembered where unset on a local master."""
    at = spark.conf.get(_KEY, None)
    if not at:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError(f"{_KEY} has to name a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="skerry-")
        spark.conf.set(_KEY, at)
    return at.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that ``release`` deletes."""
    path = f"{shared_dir(spark)}/skerry/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialize(df: DataFrame, name: str = "t", drop: tuple[DataFrame, ...] = ()) -> DataFrame:
    """Write ``df`` once into the shared folder and return a scan of it; then ``discard`` the frames of ``drop``.

    What was shuffled for it is deleted with the write, so disk holds the table
    and not both.
    """
    spark = df.sparkSession
    if spark.conf.get(_CLEAN, "false") != "true":
        spark.conf.set(_CLEAN, "true")
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    discard(*drop)
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the tables behind frames that ``materialize`` returned; others are left alone."""
    for df in frames:
        path = getattr(df, "_scratch", None)
        if path in _written:
            _written.remove(path)
            _delete(df.sparkSession, path)


def written() -> list[str]:
    """Paths of the tables that ``materialize`` wrote in this process and that weren't deleted."""
    return list(_written)


def release(spark: SparkSession, paths: list[str] | None = None, unless_read_by: DataFrame | None = None) -> None:
    """Delete tables that ``materialize`` wrote in this process: all, or those of ``paths``; not what a frame reads."""
    paths = [x for x in _written if paths is None or x in paths]
    used = {x.rsplit("/", 2)[-2] for x in unless_read_by.inputFiles()} if paths and unless_read_by is not None else ()
    for path in paths:
        if path.rsplit("/", 1)[-1] not in used:
            _written.remove(path)
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
