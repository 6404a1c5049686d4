"""Gapless ranks without a single-task window.

A plain ``row_number() OVER (PARTITION BY key)`` sends a key that holds a third
of the rows to one task.  Here each key is cut into cells that are monotone in
the order; cells are counted (a map-side combined aggregate), the counts of a
key are summed up to each cell, and rows are ranked only inside their cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_cell(cells: int, *cols: str | Column) -> Column:
    """An even cell number in ``[0, cells)`` that only depends on ``cols``."""
    return F.pmod(F.xxhash64(*cols), F.lit(cells)).cast("int")


def value_cell(df: DataFrame, column: str, cells: int) -> Column:
    """A cell number that follows the order of a column of whole numbers or text; nulls share the first.

    Numbers are cut at ``cells`` even quantiles (bounds of which come from sketches),
    text at its first two bytes.
    """
    kind = df.schema[column].dataType.typeName()
    if kind == "string":
        byte = lambda k: F.coalesce(F.ascii(F.substring(F.hex(column), 2 * k + 1, 1)) * 128 + F.ascii(F.substring(F.hex(column), 2 * k + 2, 1)), F.lit(0))
        return (F.coalesce(byte(0), F.lit(0)) * 32_768 + byte(1)).cast("int")
    bounds = df.stat.approxQuantile(column, [k / cells for k in range(1, cells)], 0.01)
    cell = F.lit(0)
    for b in sorted(set(bounds)):
        cell = cell + F.coalesce(F.col(column) > b, F.lit(False)).cast("int")
    return cell


def rank_in_cells(df: DataFrame, keys: Sequence[str], cell: str, order: Sequence[str | Column], out: str, weight: str | None = None) -> DataFrame:
    """Adds ``out``: the 0-based place of a row among the rows of its key.

    Rows are ordered by ``cell`` and then ``order``.  With ``weight``, ``out``
    is the sum of the weights before the row instead.  Null keys form a key of
    their own; ties in ``order`` are broken arbitrarily, so give a total order
    unless tied rows are interchangeable.  Reads ``df`` twice: materialize it
    first if it is expensive.
    """
    unit = F.lit(1) if weight is None else F.col(weight)
    names = [*keys, cell]
    counts = df.groupBy(*names).agg(F.sum(unit).cast("long").alias("__n"))
    before = Window.partitionBy(*keys).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(names)], F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    on = None
    for i, k in enumerate(names):
        on = F.col(k).eqNullSafe(F.col(f"__k{i}")) if on is None else on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    inside = Window.partitionBy(*names).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum(unit).over(inside), F.lit(0))
    return df.withColumn("__within", within).join(starts, on).withColumn(out, (F.col("__start") + F.col("__within")).cast("long")).drop("__within", "__start", *[f"__k{i}" for i in range(len(names))])
