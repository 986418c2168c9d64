"""A11 artist stats, T1 top charts, M6 charts with ranks, P12 display columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonearm.functions import names


def artist_stats(train: DataFrame) -> DataFrame:
    """Total plays and distinct listeners per artist.

    Spark plans the distinct count as two partial aggregations keyed first by
    (artist, user) and then by artist, so a very popular artist is combined
    map-side instead of landing whole in one task.
    """
    return train.groupBy("artist_name").agg(
        F.sum("play_count").alias("play_count"),
        F.countDistinct("user_id").alias("listener_count"))


def top_charts(train: DataFrame, k: int = 20) -> DataFrame:
    """M6 = A11 -> T1 (top k by plays, name breaks ties) -> W2 (rank 1..k).

    ``orderBy().limit(k)`` becomes TakeOrderedAndProject (per-partition top k,
    then a k-row merge); the rank window then runs over k rows only.
    """
    top = artist_stats(train).orderBy(F.desc("play_count"), F.asc("artist_name")).limit(k)
    w = Window.orderBy(F.desc("play_count"), F.asc("artist_name"))
    return top.select(F.row_number().over(w).alias("rank"), "artist_name", "play_count",
                      "listener_count")


def chart_display(charts: DataFrame) -> DataFrame:
    """Title-cased name, thousands separators and medals."""
    return charts.select(
        "rank",
        names.medal("rank").alias("badge"),
        names.title_name("artist_name").alias("artist"),
        names.thousands("play_count").alias("plays"),
        names.thousands("listener_count").alias("listeners"),
    )
