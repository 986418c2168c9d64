"""Joins to a lookup table when a key may own a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.session import materialize

# A key is hot above this many rows, if it also holds more than 1 / HOT_KEYS of all rows.
HOT_ROWS, HOT_KEYS = 100_000, 10_000
# Rows are first counted in so many cells of the key's hash: a key of a cell that is not hot is not hot.
HASH_CELLS = 1 << 14


def hot_keys(df: DataFrame, key: str, hot_rows: int | None = None) -> DataFrame | None:
    """The measured heavy hitters of ``key`` (at most HOT_KEYS rows: each holds more than that share), or None."""
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    named = df.where(F.col(key).isNotNull()).select(key, F.pmod(F.xxhash64(key), F.lit(HASH_CELLS)).cast("int").alias("_cell"))
    cells = named.groupBy("_cell").agg(F.count("*").alias("_n"))
    total, most = cells.agg(F.sum("_n"), F.max("_n")).first()
    least = max(hot_rows, (total or 0) // HOT_KEYS)
    if not most or most <= least:
        return None
    full = F.broadcast(cells.where(F.col("_n") > least).select("_cell"))  # fewer than HOT_KEYS
    counts = named.join(full, "_cell", "left_semi").groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > least)
    hot = materialize(counts.select(key), "hot-keys")
    return None if hot.isEmpty() else hot


def hot_key_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner",
                 hot_rows: int | None = None, counted: DataFrame | None = None) -> DataFrame:
    """``left.join(right, key, how)`` (inner or left) whose hot keys never meet in one task.

    The rows of measured heavy hitters stay where they are and meet a broadcast of the
    few rows that ``right`` (a lookup table, few rows per key) holds for them; rows with
    a null key, which match nothing, stay where they are too; only the rest is shuffled.
    Rows are counted in ``counted``, if given: a frame at hand with at least the rows of
    ``left``, where counting ``left`` would run a join.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how is inner or left, not {how!r}")
    hot = hot_keys(left if counted is None else counted, key, hot_rows)
    named = left.where(F.col(key).isNotNull())
    if hot is None:
        out = named.join(right, key, how)
    else:
        hot = F.broadcast(hot)
        few = F.broadcast(right.join(hot, key, "left_semi"))
        out = named.join(hot, key, "left_anti").join(right, key, how).unionByName(
            named.join(hot, key, "left_semi").join(few, key, how))
    if how == "left":
        out = out.unionByName(left.where(F.col(key).isNull()), allowMissingColumns=True)
    return out
