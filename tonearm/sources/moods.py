"""S14 mood dimension (D7) and twin-profile dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonearm.functions.names import query_key

# --- fixed values: they must equal the reference's mood profiles -------------
# mood key, display name, description, seed artists (in this order)
MOOD_PROFILES = [
    ("heartbreak", "Heartbreak 💔", "For when you need to feel it all...",
     ["radiohead", "bon iver", "elliott smith", "the smiths", "jeff buckley"]),
    ("love", "Romance ❤️", "Perfect for those in love",
     ["arctic monkeys", "the xx", "vampire weekend", "beach house", "mazzy star"]),
    ("feelgood", "Feel Good 😊", "Uplifting and positive vibes",
     ["the beatles", "coldplay", "phoenix", "mgmt", "vampire weekend"]),
    ("rage", "Rage 🔥", "Let it all out",
     ["rage against the machine", "system of a down", "metallica", "slipknot", "tool"]),
    ("motivation", "Motivation 💪", "Get pumped up",
     ["queen", "imagine dragons", "foo fighters", "linkin park", "muse"]),
    ("party", "Party 🎉", "Dance the night away",
     ["daft punk", "calvin harris", "david guetta", "avicii", "deadmau5"]),
    ("chill", "Chill 😌", "Relax and unwind",
     ["bonobo", "tycho", "zero 7", "air", "thievery corporation"]),
    ("latenight", "Late Night 🌙", "For those midnight hours",
     ["the weeknd", "massive attack", "portishead", "fka twigs", "james blake"]),
    ("rock", "Rock Out 🎸", "Classic rock energy",
     ["led zeppelin", "pink floyd", "the rolling stones", "ac/dc", "the who"]),
    ("classical", "Classical 🎩", "Timeless elegance",
     ["ludovico einaudi", "yiruma", "ólafur arnalds", "max richter", "nils frahm"]),
    ("jazz", "Jazz 🎷", "Smooth and sophisticated",
     ["miles davis", "john coltrane", "billie holiday", "ella fitzgerald", "chet baker"]),
    ("focus", "Focus 📚", "Concentration music",
     ["ludovico einaudi", "max richter", "ólafur arnalds", "nils frahm", "explosions in the sky"]),
]

# profile name, description, top artists, mood
TWIN_PROFILES = [
    ("Rock Enthusiast", "Classic rock lover", ["The Beatles", "Pink Floyd", "Led Zeppelin"], "rock"),
    ("Indie Explorer", "Alternative and indie vibes", ["Radiohead", "Arctic Monkeys", "Muse"], "feelgood"),
    ("Party Animal", "Electronic and dance music", ["Daft Punk", "Calvin Harris", "Avicii"], "party"),
    ("Chill Vibes", "Relaxing and mellow", ["Bon Iver", "The xx", "Beach House"], "chill"),
    ("Heartbreak Hotel", "Emotional and deep", ["Radiohead", "Elliott Smith", "The Smiths"], "heartbreak"),
    ("Motivation Machine", "Get pumped up", ["Queen", "Imagine Dragons", "Muse"], "motivation"),
    ("Jazz Connoisseur", "Smooth jazz lover", ["Miles Davis", "John Coltrane", "Billie Holiday"], "jazz"),
    ("Classical Soul", "Timeless elegance", ["Ludovico Einaudi", "Max Richter", "Yiruma"], "classical"),
    ("Late Night Owl", "Midnight melodies", ["The Weeknd", "Massive Attack", "FKA Twigs"], "latenight"),
    ("Love Struck", "Romantic tunes", ["Arctic Monkeys", "The xx", "Vampire Weekend"], "love"),
]
# ------------------------------------------------------------------------------

MOOD_SCHEMA = T.StructType([
    T.StructField("mood", T.StringType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
    T.StructField("seed_artists", T.ArrayType(T.StringType()), True),
])

PROFILE_SCHEMA = T.StructType([
    T.StructField("profile", T.StringType(), False),
    T.StructField("description", T.StringType(), True),
    T.StructField("top_artists", T.ArrayType(T.StringType()), True),
    T.StructField("mood", T.StringType(), False),
])


def mood_profiles(spark: SparkSession) -> DataFrame:
    """All moods (a 12-row dimension)."""
    return spark.createDataFrame(MOOD_PROFILES, MOOD_SCHEMA)


def twin_profiles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TWIN_PROFILES, PROFILE_SCHEMA)


def mood_info(moods: DataFrame, mood: str) -> DataFrame:
    """One mood by key (lower-cased); empty when unknown."""
    return moods.where(F.col("mood") == query_key(F.lit(mood)))


def mood_seeds(moods: DataFrame, mood: str | None = None) -> DataFrame:
    """(mood, pos, seed) rows; an unknown mood gives no rows (the reference's [])."""
    m = moods if mood is None else mood_info(moods, mood)
    return m.select("mood", F.posexplode("seed_artists").alias("pos", "seed"))
