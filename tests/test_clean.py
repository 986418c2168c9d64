from pyspark.sql import functions as F

from tonearm.operators import clean
from tonearm.sources.plays import PLAYS_SCHEMA


def test_clean_golden(spark):
    names = ["AC/DC", " Ólafur  Arnalds　", "Guns N' Roses", "! foo", "!!!", "x²", "Jay-Z", "a\tb"]
    df = spark.createDataFrame([(n,) for n in names], "artist_name string")
    from tonearm.functions.names import clean_name
    got = [r[0] for r in df.select(clean_name("artist_name")).collect()]
    assert got == ["acdc", "ólafur arnalds", "guns n' roses", " foo", "", "x²", "jay-z", "a b"]


def test_dedup_golden(spark):
    rows = [("a", None, "x", 1), ("a", "z", "x", 2), ("b", "y", "x", 3), (None, "q", "x", 5)]
    df = spark.createDataFrame(rows, PLAYS_SCHEMA)
    got = sorted(tuple(r) for r in clean.dedup_plays(df).select("user_id", "artist_name", "artist_mbid",
                                                                "play_count").collect())
    assert got == [("a", "x", "z", 3), ("b", "x", "y", 3)]


def test_dedup_first_in_file_order(spark):
    rows = [("a", "m2", "x", 1, 0), ("a", "m1", "x", 2, 1)]
    df = spark.createDataFrame(rows, "user_id string, artist_mbid string, artist_name string, play_count long, _row long")
    assert clean.dedup_plays(df, "_row").first()["artist_mbid"] == "m2"


def test_confidence_golden(spark):
    df = spark.createDataFrame([("u", "a", 3)], "user_id string, artist_name string, play_count long")
    r = clean.implicit_feedback(df, 40).first()
    assert (r["confidence"], r["preference"]) == (121, 1)


def test_missing_names_dropped_mbid_kept(spark):
    df = spark.createDataFrame([("u", None, None, 1), ("u", None, "x", 2)], PLAYS_SCHEMA)
    out = clean.drop_missing_names(df).collect()
    assert len(out) == 1 and out[0]["artist_mbid"] is None


def test_tsv_scan_keeps_quotes_and_na(spark, tmp_path):
    from tonearm.sources.plays import read_plays_tsv

    p = tmp_path / "plays.tsv"
    p.write_text('u1\t\t"weird al\t3\nu2\tmb\tNA\t4\n', encoding="utf-8")
    rows = read_plays_tsv(spark, str(p)).orderBy("user_id").collect()
    assert rows[0]["artist_name"] == '"weird al' and rows[0]["artist_mbid"] is None
    assert rows[1]["artist_name"] == "NA"
    na = read_plays_tsv(spark, str(p), pandas_na=True).orderBy("user_id").collect()
    assert na[1]["artist_name"] is None


def test_rows_of_a_name_lie_together_and_a_hot_name_is_cut(spark):
    """Deduplicated rows: an artist is in one or two partitions, so counts per artist send little; a hot one is in several."""
    n = F.col("id")
    name = F.when(n % 2 == 0, "hot").otherwise(F.concat(F.lit("a"), (n % 101).cast("string")))
    plays = spark.range(0, 24_000, 1, 6).select(F.concat(F.lit("u"), (n % 6007).cast("string")).alias("user_id"), name.alias("artist_name"),
                                                F.lit(None).cast("string").alias("artist_mbid"), F.lit(2).cast("long").alias("play_count"))
    keep = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for rows in (clean.dedup_plays(plays), clean.group_plays(plays)):
            places = rows.groupBy("artist_name", F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()
            cold, hot = [r for r in places if r.artist_name != "hot"], [r.n for r in places if r.artist_name == "hot"]
            assert len(cold) <= 101 + 8 and len(hot) >= 3 and max(hot) < 0.5 * sum(hot)
            want = plays.groupBy("user_id", "artist_name").agg(F.sum("play_count").alias("s")).count()
            assert rows.count() == want and rows.agg(F.sum("play_count")).first()[0] == 48_000
            assert rows.columns[:4] == ["user_id", "artist_name", "artist_mbid", "play_count"]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep)
