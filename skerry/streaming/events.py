"""Structured Streaming over event files: windows, ledger state, part intake."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.dedup import latest


def read_events(spark: SparkSession, path: str, schema, files_per_trigger: int = 16) -> DataFrame:
    """New Parquet files as they come."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def tumbling(events: DataFrame, width: str, ts: str = "ts", key: str = "event_type", late: str = "1 hour") -> DataFrame:
    return events.withWatermark(ts, late).groupBy(F.window(ts, width), key).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sliding(events: DataFrame, width: str, step: str, ts: str = "ts", key: str = "event_type", late: str = "1 hour") -> DataFrame:
    return events.withWatermark(ts, late).groupBy(F.window(ts, width, step), key).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(events: DataFrame, gap: str, ts: str = "ts", key: str = "user_id", late: str = "1 hour") -> DataFrame:
    return events.withWatermark(ts, late).groupBy(F.session_window(ts, gap), key).agg(F.count("*").alias("n"))


def ledger_state(events: DataFrame, key: str = "key") -> DataFrame:
    """Latest verdict a key with retraction, as a stateful operator in update mode.

    ``events``: key string, verdict string (null retracts), ord long.  A change is
    put out as ``(key, verdict, ord)``; a retraction as a null verdict, and its
    state is removed.
    """

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        verdict, at = state.get if state.exists else (None, -1)
        for b in batches:
            row = b.loc[b["ord"].idxmax()]
            if row["ord"] > at:
                verdict, at = (None if pd.isna(row["verdict"]) else row["verdict"]), int(row["ord"])
        if verdict is None:
            if state.exists:
                state.remove()
        else:
            state.update((verdict, at))
        yield pd.DataFrame({"key": [k[0]], "verdict": [verdict], "ord": [at]})

    return events.groupBy(key).applyInPandasWithState(step, "key string, verdict string, ord long", "verdict string, ord long", "update", GroupStateTimeout.NoTimeout)


def upsert_latest(path: str, keys: list[str], order: list[str]):
    """A ``foreachBatch`` body that keeps the latest row of each key in the table at ``path`` (see ``read_swapped``).

    Replaying a batch gives the same table, so a restart is harmless.
    """
    from ..sources.sinks import _marks, read_swapped, swap_verified

    def body(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        both = read_swapped(spark, path).unionByName(batch) if _marks(spark, path) else batch
        swap_verified(latest(both, keys, order), path)

    return body


def changed_parts(listing: DataFrame, ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parts to read again, as ``(path, size, modified)`` differs from the ledger, and parts that are gone."""
    keys = ["path", "size", "modified"]
    return listing.join(ledger, keys, "left_anti"), ledger.join(listing, "path", "left_anti")


def refresh_by_source(table: DataFrame, fresh: DataFrame, gone: DataFrame, source: str = "src") -> DataFrame:
    """Rows of changed sources replaced, rows of vanished ones dropped."""
    stale = fresh.select(source).union(gone.select(F.col("path").alias(source))).distinct()
    return table.join(stale, source, "left_anti").unionByName(fresh)


def prune_online(catalog: DataFrame, listing: DataFrame, online: DataFrame) -> DataFrame:
    """Catalog rows that are listed, or whose drive is offline and so unknown."""
    here = catalog.join(online.select("drive"), "drive", "left_semi")
    return here.join(listing.select("path"), "path", "left_semi").unionByName(catalog.join(online.select("drive"), "drive", "left_anti"))


def signature(df: DataFrame, columns: list[str]) -> str:
    """A digest of a table's rows that does not depend on their order; equal inputs need no rebuild."""
    per = F.xxhash64(*columns)
    row = df.agg(F.count("*"), F.sum(per.cast("decimal(38,0)")), F.bit_xor(per)).first()
    import hashlib

    return hashlib.sha256(repr(tuple(row)).encode()).hexdigest()


def replay(df: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Runs a streaming frame over all that is there now and returns its result, from the shared folder.

    A complete result replaces the one of the batch before; updates are added up,
    a batch that runs again replacing its own.
    """
    from ..scratch import new_path

    spark, path = df.sparkSession, new_path(df.sparkSession, name)

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(path if mode == "complete" else f"{path}/batch={number}")

    q = df.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", new_path(spark, f"{name}-state")).trigger(availableNow=True).start()
    q.awaitTermination()
    spark.createDataFrame([], df.schema).write.mode("append").parquet(path if mode == "complete" else f"{path}/batch=-1")
    return spark.read.schema(df.schema).parquet(path)
