"""Names, cells and ledger words as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CELL = r"^(.+)_(-?\d+(?:\.\d+)?)_(-?\d+(?:\.\d+)?)_(-?\d+(?:\.\d+)?)_(-?\d+(?:\.\d+)?)$"


def sanitise(name: Column) -> Column:
    """A safe name: ``&`` becomes ``and``, each sign but ``-`` and ``.`` a ``_``, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.replace(name, F.lit("&"), F.lit("and")), r"(?U)[^\w.-]", "_"), "^_+|_+$", "")


def parse_cell(name: Column) -> Column:
    """``region_w_s_e_n`` as a struct; null where the name has another form."""
    part = lambda k: F.nullif(F.regexp_extract(name, CELL, k), F.lit(""))
    fields = F.struct(part(1).alias("region"), *[part(k + 2).try_cast("double").alias(c) for k, c in enumerate(("sw_lon", "sw_lat", "ne_lon", "ne_lat"))])
    return F.when(name.rlike(CELL), fields)


def parent_region(cell: Column) -> Column:
    """All but the last four parts of a cell name."""
    return F.nullif(F.regexp_extract(cell, r"^(.*)(_[^_]+){4}$", 1), F.lit(""))


def wrap_to_signed(v: Column) -> Column:
    """An unsigned 64-bit number (as a decimal) read as signed; null if out of range."""
    d = v.cast("decimal(38,0)")
    half, full = F.lit(str(1 << 63)).cast("decimal(38,0)"), F.lit(str(1 << 64)).cast("decimal(38,0)")
    return F.when((d >= half) & (d < full), (d - full).cast("long")).when((d >= 0) & (d < half), d.cast("long"))


def last_answer(reply: Column) -> Column:
    """The last yes or no of a reply in lower case, else null."""
    found = F.regexp_extract_all(F.lower(reply), F.lit(r"\b(yes|no)\b"), 1)
    return F.try_element_at(found, F.lit(-1))
