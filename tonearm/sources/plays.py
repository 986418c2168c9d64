"""The raw play-count scan, from a headerless TSV or derived from tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLAYS_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType(), True),
    T.StructField("artist_mbid", T.StringType(), True),
    T.StructField("artist_name", T.StringType(), True),
    T.StructField("play_count", T.LongType(), True),
])

# Tokens pandas' CSV reader turns into missing values by default; applied only
# when ``pandas_na=True`` (an artist literally called "NA" is then dropped).
PANDAS_NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                    "nan", "null"]


def read_plays_tsv(spark: SparkSession, path: str, pandas_na: bool = False, with_order: bool = True,
                   malformed: str = "fail") -> DataFrame:
    """Scan the raw TSV with an explicit schema.

    Quotes are not special (``quote=""``): an artist such as ``"weird al`` is
    kept intact instead of swallowing the next field.  ``_row`` records the file
    order (file splits are deterministic, so it is stable across retries) and is
    what "first non-null mbid" refers to in :func:`dedup_plays`.  A line with a malformed
    field or the wrong number of fields is an error (``malformed="fail"``) or is kept with
    its text in ``_malformed`` (``"keep"``), so that nothing turns into nulls unseen.
    """
    schema = PLAYS_SCHEMA if malformed == "fail" else T.StructType(
        [*PLAYS_SCHEMA.fields, T.StructField("_malformed", T.StringType())])
    df = (spark.read.option("sep", "\t").option("header", "false").option("quote", "")
          .option("mode", "FAILFAST" if malformed == "fail" else "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_malformed").schema(schema).csv(path))
    if pandas_na:
        for c in ("user_id", "artist_mbid", "artist_name"):
            df = df.withColumn(c, F.when(F.col(c).isin(PANDAS_NA_TOKENS), None).otherwise(F.col(c)))
    if with_order:
        df = df.withColumn("_row", F.monotonically_increasing_id())
    return df


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plays_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plays fixture: one play row per lineitem (see FIXTURES.md).

    Two spellings of each part name (plain and shouted with punctuation) both
    clean to ``<p_name> no<partkey>``; some names and mbids are null on purpose.
    """
    li = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_name")
    # lineitem x orders is fact-to-fact: at scale neither side fits a broadcast,
    # so it is planned as the sort-merge join it has to be (it also spreads the
    # single-file test tables over all cores).  part is left to AQE.
    j = li.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).join(
        part, F.col("l_partkey") == F.col("p_partkey"))
    pk = F.col("l_partkey").cast("string")
    name = (F.when((F.col("l_partkey") % 97 == 0) & (F.col("l_linenumber") == 1), F.lit(None))
            .when(F.col("l_linenumber") % 2 == 0,
                  F.concat(F.lit(" "), F.upper("p_name"), F.lit(" / No."), pk, F.lit("! ")))
            .otherwise(F.concat(F.col("p_name"), F.lit("  no"), pk)))
    return j.select(
        F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("user_id"),
        F.when(F.col("l_partkey") % 7 == 0, F.lit(None))
         .otherwise(F.concat(F.lit("mb-"), pk)).alias("artist_mbid"),
        name.alias("artist_name"),
        F.col("l_quantity").cast("bigint").alias("play_count"),
    )
