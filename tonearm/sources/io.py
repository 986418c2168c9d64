"""S2-S9 readers and writers for processed data (parquet by default, CSV/JSON where the reference used them)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTERACTION_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("artist_name", T.StringType()),
    T.StructField("artist_mbid", T.StringType()),
    T.StructField("play_count", T.LongType()),
    T.StructField("confidence", T.LongType()),
    T.StructField("preference", T.IntegerType()),
])

MATRIX_SCHEMA = T.StructType([
    T.StructField("user_idx", T.IntegerType()),
    T.StructField("artist_idx", T.IntegerType()),
    T.StructField("value", T.DoubleType()),
])

_CSV_TEXT = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_interactions(flagged: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Train and test in one table partitioned by ``split`` (reads prune the other half)."""
    cols = [f.name for f in INTERACTION_SCHEMA.fields]
    out = flagged.select(*cols, F.when(F.col("is_test"), "test").otherwise("train").alias("split"))
    w = out.write.mode("overwrite").partitionBy("split")
    if fmt == "csv":
        w.options(header="true", **_CSV_TEXT).csv(path)
    else:
        w.parquet(path)


def read_interactions(spark: SparkSession, path: str, split: str | None = None, fmt: str = "parquet") -> DataFrame:
    """One split (pruned at planning time) or both."""
    if fmt == "csv":
        schema = T.StructType(INTERACTION_SCHEMA.fields + [T.StructField("split", T.StringType())])
        df = spark.read.options(header="true", **_CSV_TEXT).schema(schema).csv(path)
    else:
        df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split)


def write_id_map(ids: DataFrame, path: str) -> None:
    """One JSON line per id (not one giant object)."""
    ids.write.mode("overwrite").json(path)


def read_id_map(spark: SparkSession, path: str, key: str, idx: str) -> DataFrame:
    """S3: the id map; the inverse map is the same table joined on the other column."""
    schema = T.StructType([T.StructField(key, T.StringType()), T.StructField(idx, T.IntegerType())])
    return spark.read.schema(schema).json(path)


def write_matrix(matrix: DataFrame, path: str) -> None:
    """Long (user_idx, artist_idx, value) triples."""
    matrix.write.mode("overwrite").parquet(path)


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """S4."""
    return spark.read.schema(MATRIX_SCHEMA).parquet(path)


def write_stats(stats: DataFrame, path: str) -> None:
    """The one-row stats frame as JSON."""
    stats.coalesce(1).write.mode("overwrite").json(path)


def read_stats(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
