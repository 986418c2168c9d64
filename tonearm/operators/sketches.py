"""A1 / A11 with mergeable sketches: approximate distinct counts stored per slice and merged later.

A slice (a day, a partition, a load) is sketched once from its raw rows; any union of
slices is then counted from the stored sketches alone.  Plays and rows are exact sums;
distinct users and artists are HyperLogLog estimates, whose relative error has a
standard deviation of at most 1.04 / sqrt(2 ** lg_k) and which are near exact while
small.  A sketch has at most about 2 ** lg_k bytes, whatever the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LG_K = 14
#: Standard deviations that count as within the bound.
SIGMAS = 3.0


def error_bound(lg_k: int = LG_K, sigmas: float = SIGMAS) -> float:
    """Relative error that an estimate keeps to."""
    return sigmas * 1.04 / 2 ** (lg_k / 2)


def within_bound(estimate: Column, exact: Column, lg_k: int = LG_K) -> Column:
    """Whether an estimate is as near to the exact count as the sketch promises."""
    return F.abs(estimate - exact) <= F.ceil(exact * F.lit(error_bound(lg_k)))


def listener_sketches(plays: DataFrame, slice_col: str, lg_k: int = LG_K) -> DataFrame:
    """slice, artist_name, play_count, listeners (a sketch of the users); partial aggregation, no distinct."""
    return plays.groupBy(slice_col, "artist_name").agg(
        F.sum("play_count").alias("play_count"), F.hll_sketch_agg("user_id", lg_k).alias("listeners"))


def table_sketches(plays: DataFrame, slice_col: str, user_col: str = "user_id", item_col: str = "artist_name",
                   lg_k: int = LG_K) -> DataFrame:
    """slice, n_rows, users, artists (sketches); nulls are not counted."""
    return plays.groupBy(slice_col).agg(
        F.count("*").alias("n_rows"), F.hll_sketch_agg(user_col, lg_k).alias("users"),
        F.hll_sketch_agg(item_col, lg_k).alias("artists"))


def write_sketches(sketches: DataFrame, path: str, slice_col: str) -> None:
    """Store sketches, a folder per slice; writing a slice again replaces that slice only."""
    (sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(slice_col).parquet(path))


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merged_listeners(sketches: DataFrame) -> DataFrame:
    """A11 from stored sketches: artist_name, play_count, listener_estimate over all slices given."""
    return sketches.groupBy("artist_name").agg(
        F.sum("play_count").alias("play_count"),
        F.hll_sketch_estimate(F.hll_union_agg("listeners")).alias("listener_estimate"))


def merged_counts(sketches: DataFrame) -> DataFrame:
    """A1 from stored sketches: one row n_rows, user_estimate, artist_estimate over all slices given."""
    return sketches.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("users")), F.lit(0)).alias("user_estimate"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("artists")), F.lit(0)).alias("artist_estimate"))
