"""P1 null handling, A4 dedup aggregate, P2 name cleaning, P3 implicit feedback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.functions.names import clean_name


def drop_missing_names(df: DataFrame) -> DataFrame:
    """Rows without an artist name go; rows without an mbid stay."""
    return df.where(F.col("artist_name").isNotNull())


def _by_pair(df: DataFrame, *aggregates) -> DataFrame:
    """One row per (user, raw artist name), in ranges of (name, user).

    The rows are dealt by ranges instead of hashes of the pair: a name's rows lie side by side, so that they are sent
    and written as repeats, and what later counts rows per artist sends a row or two per name, not one per play.  A hot
    name is cut between users.
    """
    keys = ["artist_name", "user_id"]
    out = df.repartitionByRange(*keys).groupBy(*keys).agg(*aggregates)
    return out.select("user_id", *[c for c in out.columns if c != "user_id"])


def group_plays(df: DataFrame, order_col: str | None = None) -> DataFrame:
    """A4 over *all* rows, nulls included, with the row count ``n`` per group.

    One partial aggregation of the raw scan that serves both the dedup (filter
    out null users / names) and the raw-scan statistics (:func:`grouped_profile`),
    so the raw data is read once.
    """
    mbid = F.col("artist_mbid")
    if order_col and order_col in df.columns:
        first_mbid = F.min_by(mbid, F.when(mbid.isNotNull(), F.col(order_col)))
    else:
        first_mbid = F.min(mbid)
    return _by_pair(df, first_mbid.alias("artist_mbid"), F.sum("play_count").alias("play_count"), F.count("*").alias("n"))


def dedup_from_groups(groups: DataFrame) -> DataFrame:
    """P1 + A4 from :func:`group_plays` output."""
    return (groups.where(F.col("user_id").isNotNull() & F.col("artist_name").isNotNull())
            .select("user_id", "artist_name", "artist_mbid", "play_count"))


def grouped_profile(groups: DataFrame) -> DataFrame:
    """A1-A3 of the raw scan computed from :func:`group_plays` output.

    Distinct users and names are counted from one row per key each, so no group is
    expanded once per distinct count.
    """
    named = F.col("artist_name").isNotNull()
    users = groups.groupBy("user_id").agg(
        F.sum("n").alias("n"), F.sum(F.when(~named, F.col("n")).otherwise(0)).alias("missing"),
        F.sum(F.when(named, F.col("n") - 1).otherwise(0)).alias("more"))
    users = users.agg(F.sum("n").alias("n_rows"), F.count("user_id").alias("n_users"),
                      F.coalesce(F.sum("missing"), F.lit(0)).alias("n_missing_names"),
                      F.coalesce(F.sum("more"), F.lit(0)).alias("n_duplicates"))
    names = groups.select("artist_name").distinct().agg(F.count("artist_name").alias("n_artists"))
    both = users.unionByName(names, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("n_rows", "n_users", "n_artists", "n_missing_names", "n_duplicates")])


def dedup_plays(df: DataFrame, order_col: str | None = None) -> DataFrame:
    """A4: one row per (user, raw artist name): first non-null mbid, summed plays.

    "First" means smallest ``order_col`` among rows with an mbid (file order
    when the scan recorded one); without an order column the smallest mbid is
    taken, which is the same whenever a name has a single mbid.  Groups with a
    null user are dropped, as the reference's group-by does.  Rows are dealt by ranges of
    name and user, so a hot user or artist does not overload one task.
    """
    mbid = F.col("artist_mbid")
    if order_col and order_col in df.columns:
        first_mbid = F.min_by(mbid, F.when(mbid.isNotNull(), F.col(order_col)))
    else:
        first_mbid = F.min(mbid)
    return _by_pair(df.where(F.col("user_id").isNotNull()), first_mbid.alias("artist_mbid"), F.sum("play_count").alias("play_count"))


def clean_names(df: DataFrame, rededup: bool = False) -> DataFrame:
    """P2 applied to ``artist_name``; the pre-clean spelling is kept as ``raw_name``.

    Cleaning after the dedup (reference order) can leave several rows per
    (user, cleaned name).  ``rededup=True`` merges them again.
    """
    out = df.withColumn("raw_name", F.col("artist_name")).withColumn(
        "artist_name", clean_name("artist_name"))
    if rededup:
        out = (out.groupBy("user_id", "artist_name")
               .agg(F.min_by("artist_mbid", F.when(F.col("artist_mbid").isNotNull(), F.col("raw_name")))
                    .alias("artist_mbid"),
                    F.sum("play_count").alias("play_count"),
                    F.min("raw_name").alias("raw_name")))
    return out


def implicit_feedback(df: DataFrame, alpha: float = 40.0) -> DataFrame:
    """confidence = 1 + alpha * plays, preference = 1."""
    if float(alpha).is_integer():
        conf = F.lit(1) + F.lit(int(alpha)) * F.col("play_count")
    else:
        conf = F.lit(1.0) + F.lit(float(alpha)) * F.col("play_count")
    return df.withColumn("confidence", conf).withColumn("preference", F.lit(1))


def prepare(df: DataFrame, order_col: str | None = None, rededup: bool = False) -> DataFrame:
    """P1 -> A4 -> P2 in the reference order."""
    return clean_names(dedup_plays(drop_missing_names(df), order_col), rededup=rededup)
