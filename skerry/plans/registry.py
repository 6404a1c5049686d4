"""Where plans register themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Registers a plan, and the SQL that must give the same rows."""

    def put(plan: Plan) -> Plan:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = plan
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return put


def scalable(name: str) -> Callable[[Plan], Plan]:
    """Another plan for a registered query; its SQL stays the oracle."""

    def put(plan: Plan) -> Plan:
        if name not in ORACLES:
            raise ValueError(f"query {name} has no SQL yet")
        QUERIES[name] = plan
        return plan

    return put


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def sql(name: str, text: str, duck: str | None = None) -> None:
    """Registers a plan written in SQL; ``{table}`` names a table of the scale factor.

    ``duck`` is the oracle's own wording, where the dialects or types differ.
    """
    used = [t for t in TABLES if "{" + t + "}" in text]

    def plan(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})

    oracle = duck or text
    for t in TABLES:
        oracle = oracle.replace("{" + t + "}", t)
    query(name, oracle)(plan)
