"""U3 distinct keys, U4 dense ids, U5/U6 seeded sampling, J1/J2 id lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonearm.operators.hotjoin import hot_key_join
from tonearm.session import checkpoint_dir


def distinct_keys(df: DataFrame, col: str) -> DataFrame:
    """U3."""
    return df.select(col).distinct()


def dense_index(keys: DataFrame, order: list[Column], idx_col: str) -> DataFrame:
    """U4 core: 0-based dense index following ``order`` without a one-task window.

    The keys are range-partitioned and sorted (``orderBy``), checkpointed so that
    partition membership is fixed, and numbered locally; per-partition row
    counts (one row per partition: a proven bound) are prefix-summed and
    broadcast back as offsets.
    """
    checkpoint_dir(keys.sparkSession)
    srt = keys.orderBy(*order).checkpoint()
    tagged = srt.withColumn("_pid", F.spark_partition_id()).withColumn(
        "_mid", F.monotonically_increasing_id())
    sizes = tagged.groupBy("_pid").agg(F.count("*").alias("_cnt"))
    offsets = sizes.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(idx_col, (F.col("_off") + local).cast("int"))
            .drop("_pid", "_mid", "_off"))


def user_index(df: DataFrame, user_col: str = "user_id") -> DataFrame:
    """Users numbered in sorted order (the reference's dedup output is key-sorted)."""
    return dense_index(distinct_keys(df, user_col), [F.asc(user_col)], "user_idx")


def artist_index(df: DataFrame, item_col: str = "artist_name", user_col: str = "user_id") -> DataFrame:
    """Artists numbered by first appearance in (user, raw name) order."""
    raw = F.col("raw_name") if "raw_name" in df.columns else F.col(item_col)
    firsts = df.groupBy(item_col).agg(F.min(F.struct(F.col(user_col).alias("u"), raw.alias("r"))).alias("_k"))
    out = dense_index(firsts, [F.asc("_k"), F.asc(item_col)], "artist_idx")
    return out.drop("_k")


def attach_indices(df: DataFrame, users: DataFrame, artists: DataFrame, how: str = "left") -> DataFrame:
    """Id -> index lookups (null when unmatched with ``how='left'``); a hot user or artist is spread."""
    return hot_key_join(hot_key_join(df, users, "user_id", how), artists, "artist_name", how, counted=df)


def attach_names(df: DataFrame, artists: DataFrame, idx_col: str = "artist_idx") -> DataFrame:
    """Index -> name; indices outside the map vanish (inner join)."""
    return hot_key_join(df, artists.withColumnRenamed("artist_idx", idx_col), idx_col)


def _seeded_key(col: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(col).cast("string"), F.lit(f":{seed}")))


def sample_users(df: DataFrame, n: int, seed: int = 42, user_col: str = "user_id") -> DataFrame:
    """N distinct users without replacement, seeded (top-n by a hash key)."""
    return (df.select(user_col).distinct().withColumn("_k", _seeded_key(user_col, seed))
            .orderBy("_k", user_col).limit(n).drop("_k"))


def random_user(df: DataFrame, seed: int = 42, user_col: str = "user_id") -> DataFrame:
    """One user picked uniformly by a seeded hash (a single partial aggregate)."""
    return df.select(F.min_by(F.col(user_col), F.struct(_seeded_key(user_col, seed), F.col(user_col)))
                     .alias(user_col))
