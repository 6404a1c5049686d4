"""Session defaults; a cluster's own settings always win."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str = "*", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    base = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.driver.host": "127.0.0.1",
    } | conf
    spark = SparkSession.builder.master(f"local[{cpus}]").appName("skerry").config(map=base).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables below ``sf_dir``, read through Spark only."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
