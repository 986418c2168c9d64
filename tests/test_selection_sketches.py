"""W1 by selection: same flags as a full sort, small written levels, no sort of the full rows; sketches."""

import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tonearm.operators import sketches, split

SCHEMA = "user_id string, artist_name string, play_count long, artist_mbid string"


def _plain(df, share):
    h = F.md5(F.concat_ws(":", "user_id", "artist_name", F.lit("42")))
    w = Window.partitionBy("user_id").orderBy(h, "play_count", F.asc_nulls_last("artist_mbid"))
    n = F.count("*").over(Window.partitionBy("user_id"))
    return df.withColumn("is_test", F.row_number().over(w) <= F.greatest(F.lit(1), F.floor(n * F.lit(share))))


@pytest.mark.parametrize("digits, hot_rows, share", [(1, 10, 0.2), (3, 5, 0.2), (3, 5, 1.0), (4, 100_000, 0.0)])
def test_selection_equals_a_full_sort(spark, digits, hot_rows, share):
    """A user with a third of all rows, users of one row, one artist many times (equal hashes)."""
    rng = random.Random(3)
    rows = [("hot" if i % 3 == 0 else f"u{rng.randrange(60)}", f"a{rng.randrange(500)}", rng.randrange(1, 4), None)
            for i in range(2400)]
    rows += [("one", "a", 1, None)] + [("same", "a", 1 + i % 2, None) for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = split.holdout_flag(df, share, digits=digits, hot_rows=hot_rows)
    assert got.columns == [*df.columns, "is_test"]
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, _plain(df, share).collect()))
    assert split.holdout_flag(df.where("false")).count() == 0


def test_the_boundary_cell_shrinks_with_each_digit(spark):
    df = spark.range(40_000).select(F.lit("hot").alias("user_id"), F.md5(F.col("id").cast("string")).alias("_h"))
    sizes = [split.holdout_cuts(df, 0.2, "user_id", digits, 10)[0].first() for digits in (1, 2, 3)]
    assert [len(r["_p"]) for r in sizes] == [1, 2, 3]
    assert sizes[0]["_cell"] < 3_000 and sizes[1]["_cell"] < 250 and sizes[2]["_cell"] < 40
    assert all(1 <= r["_need"] <= r["_cell"] and r["_rows"] == 40_000 for r in sizes)


def test_the_full_rows_are_not_sorted(spark):
    df = spark.createDataFrame([(f"u{i % 50}", f"a{i}", 1, None) for i in range(1000)], SCHEMA)
    plan = split.holdout_flag(df)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("- Sort [") == 1
    below = plan[plan.index("- Sort ["):]  # the one sort is the boundary cell's: it lies above the filter on the cell
    assert "ShuffledHashJoin" in below
    assert " = _p#" in below[:below.index("ShuffledHashJoin")] + below[below.index("ShuffledHashJoin"):].splitlines()[0]


def _plays(spark, n=60_000):
    return spark.range(n).select(F.concat(F.lit("u"), F.col("id") % 20_011).alias("user_id"),
                                 F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), F.col("id") % 97))
                                 .alias("artist_name"), F.lit(2).cast("long").alias("play_count"),
                                 (F.col("id") % 5).alias("day"))


def test_sketches_of_slices_merge_to_the_whole(spark, tmp_path):
    df, path = _plays(spark), str(tmp_path / "listeners")
    for day in range(5):  # one load after the other, each reading its own raw rows only
        sketches.write_sketches(sketches.listener_sketches(df.where(F.col("day") == day), "day"), path, "day")
    sketches.write_sketches(sketches.listener_sketches(df.where("day = 2"), "day"), path, "day")  # loaded again
    stored = sketches.read_sketches(spark, path)
    got = {r.artist_name: r for r in sketches.merged_listeners(stored).collect()}
    want = df.groupBy("artist_name").agg(F.sum("play_count").alias("p"), F.countDistinct("user_id").alias("n")).collect()
    assert set(got) == {r.artist_name for r in want}
    for r in want:
        assert got[r.artist_name].play_count == r.p
        assert abs(got[r.artist_name].listener_estimate - r.n) <= max(1, sketches.error_bound() * r.n)
    two = sketches.merged_listeners(stored.where("day in (0, 1)")).where("artist_name = 'hot'").first()
    exact = df.where("day in (0, 1) AND artist_name = 'hot'").select("user_id").distinct().count()
    assert abs(two.listener_estimate - exact) <= sketches.error_bound() * exact


def test_table_sketches_merge_and_take_nothing(spark):
    df = _plays(spark)
    r = sketches.merged_counts(sketches.table_sketches(df, "day")).first()
    assert r.n_rows == 60_000 and abs(r.user_estimate - 20_011) <= sketches.error_bound() * 20_011
    assert abs(r.artist_estimate - 98) <= 1
    assert tuple(sketches.merged_counts(sketches.table_sketches(df.where("false"), "day")).first()) == (0, 0, 0)
    nulls = df.withColumn("user_id", F.lit(None).cast("string"))
    assert sketches.merged_counts(sketches.table_sketches(nulls, "day")).first().user_estimate == 0


def test_a_wide_error_is_outside_the_bound(spark):
    row = spark.range(1).select(sketches.within_bound(F.lit(10_000), F.lit(10_100)).alias("near"),
                                sketches.within_bound(F.lit(10_000), F.lit(11_000)).alias("far")).first()
    assert (row.near, row.far) == (True, False)
