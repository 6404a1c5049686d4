"""Statistics as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Z95 = 1.959963984540054


def wilson(hits: Column, n: Column, z: float = Z95) -> tuple[Column, Column]:
    """The Wilson interval of ``hits`` of ``n``, clamped to [0, 1]; null where n is 0."""
    n = F.nullif(n.cast("double"), F.lit(0.0))
    p = hits / n
    centre = (p + z * z / (2 * n)) / (1 + z * z / n)
    half = z / (1 + z * z / n) * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return F.greatest(F.lit(0.0), centre - half), F.least(F.lit(1.0), centre + half)


def wald_band(hits: Column, n: Column, population: Column, z: float = Z95) -> tuple[Column, Column]:
    """A rate's normal band, scaled up to a population."""
    n = F.nullif(n.cast("double"), F.lit(0.0))
    p = hits / n
    half = z * F.sqrt(p * (1 - p) / n)
    return population * F.greatest(F.lit(0.0), p - half), population * F.least(F.lit(1.0), p + half)


def log_factorial(n: Column) -> Column:
    return F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0.0), lambda acc, k: acc + F.log(k.cast("double")))


def binomial_two_sided(hits: Column, n: Column) -> Column:
    """Exact two-sided p-value of ``hits`` of ``n`` fair coin flips; 1 where n is 0."""
    low = F.least(hits, n - hits)
    tail = F.aggregate(F.sequence(F.lit(0), low), F.lit(0.0), lambda acc, k: acc + F.exp(log_factorial(n) - log_factorial(k) - log_factorial(n - k) - n * F.log(F.lit(2.0))))
    return F.least(F.lit(1.0), 2 * tail)


def band(score: Column, width: float = 0.1, top: int = 9) -> Column:
    """Half-open score band; the epsilon keeps 0.3 in band 3."""
    return F.least(F.lit(top), F.floor((score + 1e-9) / width)).cast("int")


def round_scaled(x: Column, digits: int) -> Column:
    """``x`` rounded half away from zero at its double's own product with a power of ten.

    ``F.round`` rounds the shortest decimal that names the double; where that is a
    tie, the two may differ by one last digit, and with it a cell.
    """
    return F.round(x.cast("double") * float(10**digits)) / float(10**digits)
