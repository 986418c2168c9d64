"""The single-key forms, which raise ValueError where the batch forms return no row.

Each answers one user, mood or artist with the batch operator; the checks read at most
one row each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonearm.functions.names import query_key
from tonearm.operators import mood as mood_op
from tonearm.operators import score
from tonearm.session import materialize


def _one(spark: SparkSession, col: str, value: str) -> DataFrame:
    return spark.createDataFrame([(value,)], f"{col} string")


def _need(rows: DataFrame, message: str) -> None:
    if rows.limit(1).isEmpty():
        raise ValueError(message)


def recommend_for_user(user_id: str, user_factors: DataFrame, item_factors: DataFrame, train: DataFrame,
                       k: int = 10) -> DataFrame:
    """M3 for one user; unknown users and users without factors are errors."""
    _need(train.where(F.col("user_id") == user_id), f"User ID '{user_id}' not found in the data")
    _need(user_factors.where(F.col("user_id") == user_id), f"User ID '{user_id}' has no factors")
    return score.recommend_unseen(_one(train.sparkSession, "user_id", user_id), user_factors, item_factors, train, k)


def recommend_for_mood(mood: str, moods: DataFrame, artists: DataFrame, train: DataFrame, user_factors: DataFrame,
                       item_factors: DataFrame, k: int = 10, n_users: int = 50) -> DataFrame:
    """M4 for one mood; an unknown mood, no seed artist in the data and no listener of any seed are errors."""
    asked = moods.where(F.col("mood") == query_key(F.lit(mood)))
    _need(asked, f"Mood '{mood}' not found")
    _need(mood_op.found_seeds(asked, artists), f"No seed artists found in the data for mood '{mood}'")
    listeners = materialize(mood_op.mood_listeners(asked, artists, train, user_factors, n_users), "mood-listeners")
    _need(listeners, f"No users found who listen to seed artists of mood '{mood}'")
    requests = asked.select("mood").withColumn("k", F.lit(int(k)))
    return mood_op.mood_recommendations(requests, asked, artists, train, user_factors, item_factors, n_users)


def similar_to(artist: str, item_factors: DataFrame, k: int = 10) -> DataFrame:
    """M5 for one artist name (lower-cased, stripped); an unknown one is an error."""
    _need(item_factors.where(F.col("artist_name") == query_key(F.lit(artist))), f"Artist '{artist}' not found in the data")
    return score.similar_items(_one(item_factors.sparkSession, "query", artist), item_factors, k)


def mood_seeds(mood: str, moods: DataFrame) -> DataFrame:
    """(mood, pos, seed) of one mood; an unknown one is an error."""
    asked = moods.where(F.col("mood") == query_key(F.lit(mood)))
    _need(asked, f"Mood '{mood}' not found")
    return asked.select("mood", F.posexplode("seed_artists").alias("pos", "seed"))
