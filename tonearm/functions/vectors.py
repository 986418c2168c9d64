"""Array-column vector maths that stays inside whole-stage codegen (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(v) -> Column:
    return _c(v).cast("array<double>")


def dot(a, b) -> Column:
    """Dot product in double precision of two equal-length numeric arrays."""
    prods = F.zip_with(as_double(a), as_double(b), lambda x, y: x * y)
    return F.aggregate(prods, F.lit(0.0), lambda acc, x: acc + x)


def norm(v) -> Column:
    return F.sqrt(dot(v, v))


def unit(v) -> Column:
    """Unit vector; a zero vector stays zero (cosine 0 against everything)."""
    n = F.nullif(norm(v), F.lit(0.0))
    return F.transform(as_double(v), lambda x: F.coalesce(x / n, F.lit(0.0)))
