"""A1 counts, A2 null counts, A3 duplicates, A5 group sizes, A6 confidence stats, A10 retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sides(df: DataFrame, is_a: Column, user_col: str, item_col: str, written: bool = False) -> DataFrame:
    """One row: rows, distinct users and items of all rows, of those where ``is_a`` holds and of the others.

    Rows are counted per (user, item) first; both distinct counts then run over that
    smaller, shared table, so no row is expanded once per distinct count.  Rows of a
    ``written`` table are counted per user and per item straight from it: reading a column
    twice is cheaper than a shuffle of all pairs, of which few repeat.
    """
    if written:
        g = df.withColumns({"a": is_a.cast("long"), "b": (~is_a).cast("long")})
    else:
        g = df.groupBy(user_col, item_col).agg(F.count_if(is_a).alias("a"), F.count_if(~is_a).alias("b"))

    def per(key: str, name: str) -> DataFrame:
        k = g.groupBy(key).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        named = F.col(key).isNotNull()
        cols = [F.count_if(named).alias(name), F.count_if(named & (F.col("a") > 0)).alias(f"{name}_a"),
                F.count_if(named & (F.col("b") > 0)).alias(f"{name}_b")]
        return k.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("rows_a"), F.coalesce(F.sum("b"), F.lit(0)).alias("rows_b"),
                     *cols)

    both = per(user_col, "users").unionByName(per(item_col, "items"), allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def table_counts(df: DataFrame, user_col: str = "user_id", item_col: str = "artist_name") -> DataFrame:
    """A1: rows and exact distinct users / artists (nulls not counted)."""
    s = sides(df, F.lit(True), user_col, item_col)
    return s.select(F.col("rows_a").alias("n_rows"), F.col("users").alias("n_users"), F.col("items").alias("n_artists"))


def null_counts(df: DataFrame) -> DataFrame:
    """A2: nulls per column, one row."""
    return df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(f"null_{c}") for c in df.columns])


def duplicate_count(df: DataFrame, keys=("user_id", "artist_name")) -> DataFrame:
    """A3: rows beyond the first of each key (null keys compare equal, as in pandas)."""
    groups = df.groupBy(*keys).agg((F.count("*") - 1).alias("more"))
    return groups.agg(F.coalesce(F.sum("more"), F.lit(0)).alias("n_duplicates"))


def group_sizes(df: DataFrame, key: str) -> DataFrame:
    """A5: rows per key (rows, not distinct partners)."""
    return df.groupBy(key).agg(F.count("*").alias("n_rows"))


def confidence_stats(df: DataFrame, col: str = "confidence") -> DataFrame:
    """A6."""
    return df.agg(F.min(col).alias("min_confidence"), F.max(col).alias("max_confidence"),
                  F.avg(col).alias("mean_confidence"))


def retention(before: DataFrame, after: DataFrame, user_col: str = "user_id",
              item_col: str = "artist_name", written: bool = False) -> DataFrame:
    """A10: share of rows, users and artists kept; ``written`` if both frames are read from written tables."""
    cols = [user_col, item_col]
    both = (before.select(*cols).withColumn("_after", F.lit(False))
            .unionByName(after.select(*cols).withColumn("_after", F.lit(True))))
    s = sides(both, F.col("_after"), user_col, item_col, written)
    out = s.select(F.col("rows_b").alias("n_rows"), F.col("users_b").alias("n_users"), F.col("items_b").alias("n_artists"),
                   F.col("rows_a").alias("n_rows_after"), F.col("users_a").alias("n_users_after"),
                   F.col("items_a").alias("n_artists_after"))
    return out.select("*", *[F.try_divide(F.col(f"{c}_after") * 100.0, F.col(c)).alias(f"pct_{c[2:]}_kept")
                             for c in ("n_rows", "n_users", "n_artists")])


def split_shares(flagged: DataFrame) -> DataFrame:
    """A10 for the split (a written table): train / test row counts and percentages."""
    s = sides(flagged, F.col("is_test"), "user_id", "artist_name", written=True)
    out = s.select((F.col("rows_a") + F.col("rows_b")).alias("n_rows"), F.col("users").alias("n_users"),
                   F.col("items").alias("n_artists"), F.col("rows_b").alias("train_rows"), F.col("rows_a").alias("test_rows"),
                   F.col("users_b").alias("train_users"), F.col("users_a").alias("test_users"))
    return out.select("*", F.try_divide(F.col("train_rows") * 100.0, F.col("n_rows")).alias("pct_train"),
                      F.try_divide(F.col("test_rows") * 100.0, F.col("n_rows")).alias("pct_test"))
