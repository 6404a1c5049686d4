"""What the operators of this sub-package share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize

#: ASCII white space, as the word pattern ``[^\\x20\\x09-\\x0D]+`` leaves out.
SPACE = "[\\x20\\x09-\\x0D]+"


def words(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def numbered(df: DataFrame, id_col: str, text: str) -> tuple[DataFrame, bool]:
    """``df`` with ``__row``, a number of its own for each row in the order of the ids, and whether ids repeat.

    Ids that don't repeat are their own numbers (their type has to be a whole
    number; a null id has none).  Where ids repeat, rows are sorted by id and a
    hash of the text and numbered in that order; null ids stay without a number.  Rows that agree in both are interchangeable.
    """
    if df.schema[id_col].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError(f"{id_col} has to be a whole number")
    ids = F.col(id_col).cast("long")
    again = df.filter(F.col(id_col).isNotNull()).groupBy(id_col).count().filter("count > 1")
    if again.isEmpty():
        return df.withColumn("__row", ids), False
    fixed = materialize(df.withColumn("__mid", F.monotonically_increasing_id()), "rows")
    order = [ids, F.xxhash64(text), F.col("__mid")]
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = fixed.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    return materialize(ranked.withColumn("__row", F.when(F.col(id_col).isNotNull(), F.monotonically_increasing_id())).drop("__mid"), "numbered", drop=(fixed,)), True


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def literal_rows(spark, rows: Sequence[Sequence], fields: str) -> DataFrame:
    """A small driver-made table as a JVM-side relation, without Python tasks.

    ``fields`` is a DDL list of number columns.  Only for tables whose size is
    bounded by a parameter, never by the data.
    """
    names = [x.split()[0] for x in fields.split(",")]
    text = "[" + ",".join("{" + ",".join(f'"{k}":{v}' for k, v in zip(names, r, strict=True)) + "}" for r in rows) + "]"
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{', '.join(':'.join(x.split()) for x in fields.split(','))}>>")))


def literal_array(values: Sequence[float], kind: str) -> Column:
    """A bounded number array as one foldable literal."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")
