"""Approximate neighbours, raising lookups, result tables and late rows of long streams."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from small_tables import SF_SMALL

from tonearm.operators import clean, lookups, score, similar
from tonearm.operators import mood as mood_op
from tonearm.plans import catalog
from tonearm.plans import fixtures as fx
from tonearm.streaming import monitor


@pytest.fixture(scope="module")
def clustered(spark):
    """1,600 vectors around 80 centres, one of them crowded (a third of all)."""
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(80, 16))
    of = np.where(np.arange(1600) % 3 == 0, 0, rng.integers(0, 80, 1600))
    v = centres[of] + 0.25 * rng.normal(size=(1600, 16))
    v[5] = 0
    return spark.createDataFrame([(f"a{i:04d}", r.tolist()) for i, r in enumerate(v)],
                                 "artist_name string, features array<double>")


def test_approximate_neighbours_reach_the_recall(spark, clustered, monkeypatch):
    """Against every exact neighbour, not the judged ones alone; with fewer products than all pairs."""
    monkeypatch.setattr(similar, "BUCKET_ROWS", 40)
    monkeypatch.setattr(similar, "JUDGED", 200)
    monkeypatch.setattr(score, "ITEM_BLOCK", 100)
    monkeypatch.setattr(score, "QUERY_BLOCK", 50)
    queries = clustered.select(F.upper("artist_name").alias("query"))
    rows, report = similar.similar_items_approx(queries, clustered, 10)
    exact = score.similar_items(queries, clustered, 10)
    key = ["query", "similar_artist"]
    hit = rows.join(exact.select(*key, F.col("similarity").alias("s")), key)
    r = report.first()
    assert hit.count() / exact.count() >= 0.9 and 0.9 <= r.recall <= 1 and 100 < r.n_judged < 320
    assert r.share < 0.8 and r.bits == 5
    assert hit.where(F.abs(F.col("similarity") - F.col("s")) > 1e-9).isEmpty()
    assert rows.where("similar_artist = artist_name").isEmpty()
    assert rows.groupBy("query", "rank").count().where("count > 1").isEmpty()


def test_approximate_neighbours_of_few_rows(spark, clustered):
    """Unknown queries drop out; a small catalog is exact; an empty one gives no rows."""
    queries = spark.createDataFrame([(" A0001 ",), ("nobody",), ("a0005",)], "query string")
    few = clustered.limit(30)
    rows, report = similar.similar_items_approx(queries, few, 3)
    want = score.similar_items(queries, few, 3).collect()
    assert {(r.query, r.similar_artist) for r in rows.collect() if r.query != "a0005"} == {
        (r.query, r.similar_artist) for r in want if r.query != "a0005"}
    assert report.first().n_items == 30
    rows, report = similar.similar_items_approx(queries, few.limit(0), 3)
    assert rows.isEmpty() and report.first().n_judged == 0


def test_lookups_raise_on_unknown_keys(spark):
    moods, artists, train = fx.moods(spark, SF_SMALL), fx.artists(spark, SF_SMALL), fx.train(spark, SF_SMALL)
    uf, itf = fx.user_factors(spark, SF_SMALL), fx.item_factors(spark, SF_SMALL)
    with pytest.raises(ValueError, match="not found"):
        lookups.recommend_for_user("nobody", uf, itf, train)
    known = train.join(uf, "user_id", "left_semi").first().user_id
    with pytest.raises(ValueError, match="no factors"):
        lookups.recommend_for_user(known, uf.where(F.col("user_id") != known), itf, train)
    got = lookups.recommend_for_user(known, uf, itf, train, 4).collect()
    assert [r["rank"] for r in sorted(got, key=lambda r: r["rank"])] == [1, 2, 3, 4]

    args = (moods, artists, train, uf, itf)
    mood = mood_op.found_seeds(moods, artists).first().mood
    with pytest.raises(ValueError, match="Mood 'blues' not found"):
        lookups.recommend_for_mood("blues", *args)
    mute = moods.withColumn("seed_artists", F.array(F.lit("nobody at all")))
    with pytest.raises(ValueError, match="No seed artists"):
        lookups.recommend_for_mood(mood, mute, *args[1:])
    with pytest.raises(ValueError, match="No users"):
        lookups.recommend_for_mood(mood, moods, artists, train, uf.limit(0), itf)
    assert lookups.recommend_for_mood(f" {mood.title()} ", *args, k=3).count() == 3
    with pytest.raises(ValueError, match="not found"):
        lookups.similar_to("nobody at all", itf)
    assert lookups.similar_to(f" {itf.first().artist_name.upper()} ", itf, 5).count() == 5
    with pytest.raises(ValueError, match="not found"):
        lookups.mood_seeds("blues", moods)
    assert lookups.mood_seeds(mood.upper(), moods).count() > 0


def test_grouped_profile_counts(spark):
    rows = [("u", "a", 1, None), ("u", "a", 2, None), ("v", None, 1, None), (None, "b", 1, None), ("v", "a", 1, None)]
    plays = spark.createDataFrame(rows, "user_id string, artist_name string, play_count long, artist_mbid string")
    got = clean.grouped_profile(clean.group_plays(plays)).first()
    assert (got.n_rows, got.n_users, got.n_artists, got.n_missing_names, got.n_duplicates) == (5, 2, 2, 1, 1)
    empty = clean.grouped_profile(clean.group_plays(plays.limit(0))).first()
    assert (empty.n_users, empty.n_artists, empty.n_duplicates) == (0, 0, 0)


def test_result_table_stops_growing_and_repeats_change_nothing(spark, tmp_path, monkeypatch):
    """Each key keeps one version besides a few batches of updates; a repeated batch gives the same table."""
    monkeypatch.setattr(monitor, "COMPACT_EVERY", 4)
    table = monitor.ResultTable(spark, str(tmp_path / "t"), ["k"])
    now = lambda: sorted(map(tuple, monitor.newest_of(table.read(), ["k"]).collect()))
    want, sizes = {}, []
    for i in range(14):
        rows = [(f"k{j}", i * 10 + j) for j in range(5) if (i + j) % 2]
        want.update({k: (k, v, i) for k, v in rows})
        batch = spark.createDataFrame(rows, "k string, v long").coalesce(1)
        for _ in range(2 if i in (3, 4, 8, 13) else 1):  # a restart repeats a batch, also one that compacted
            table.update(batch, i)
            assert now() == sorted(want.values())
        sizes.append(table.read().count())
    assert max(sizes) <= 5 + 5 * 3 and len(table._ids("data")) <= 5 and len(table._ids("snapshots")) == 1
    # a snapshot whose writer did not finish is not read
    p, fs = monitor._files(spark, f"{tmp_path}/t/snapshots/upto=99")
    fs.mkdirs(p)
    assert now() == sorted(want.values())


def _small_files(spark, path, minutes):
    """One file per entry of ``minutes``, in this order of arrival."""
    for i, m in enumerate(minutes):
        ts = F.lit(f"2024-01-01 {m // 60:02d}:{m % 60:02d}:30").cast("timestamp_ntz")
        spark.range(1).select(ts.alias("ts"), F.lit(i).alias("n")).coalesce(1).write.mode("append").parquet(path)
    return spark.read.parquet(path).schema


def test_late_rows_of_a_long_stream_are_all_counted(spark, tmp_path, monkeypatch):
    """112 micro-batches whose late rows come early: more than a query's progress reports remember."""
    monkeypatch.setattr(monitor, "COMPACT_EVERY", 20)
    keep = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        # minute 100 sets the watermark to 90; the five rows of minute 5 come after it
        minutes = [100, 101, 5, 5, 5, 102, 5, 5] + list(range(103, 207))
        schema = _small_files(spark, f"{tmp_path}/in", minutes)
        stream = monitor.event_stream(spark, f"{tmp_path}/in", schema, watermark="10 minutes", max_files=1)
        path, dropped = monitor.run_stream(monitor.per_minute(stream), ["window_start", "window_end"], "long")
        assert dropped == 5
        late = monitor.late_rows(spark, path).collect()
        assert sum(r.dropped for r in late) == 5 and len(late) == 5
        kept = monitor.latest(spark, path, ["window_start", "window_end"]).agg(F.sum("requests")).first()[0]
        assert kept == len(minutes) - 5
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", keep)


def test_streamed_top_moods_are_ranked_in_the_table(spark, tmp_path):
    """Complete mode: after each batch the table itself holds the top 5 of all rows so far."""
    moods = [["rock", "rock", "jazz"], ["jazz", "jazz", "pop", "folk"], ["a", "b", "pop", "pop", "pop"]]
    seen = []
    real = monitor.ResultTable.replace

    def watched(self, batch, batch_id):
        real(self, batch, batch_id)
        seen.append([(r.mood, r.requests) for r in self.read().orderBy(F.desc("requests"), "mood").collect()])

    for rows in moods:
        (spark.createDataFrame([(m,) for m in rows], "mood string").withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
         .coalesce(1).write.mode("append").parquet(f"{tmp_path}/in"))
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    stream = monitor.event_stream(spark, f"{tmp_path}/in", schema, max_files=1)
    monitor.ResultTable.replace = watched
    try:
        path, _ = monitor.run_stream(monitor.top_moods(monitor.mood_counts(stream)), ["mood"], "moods", "complete")
    finally:
        monitor.ResultTable.replace = real
    want, count = [], {}
    for rows in moods:
        for m in rows:
            count[m] = count.get(m, 0) + 1
        want.append(sorted(count.items(), key=lambda x: (-x[1], x[0]))[:5])
    assert seen == want
    assert sorted(map(tuple, monitor.latest(spark, path, None).collect())) == sorted(want[-1])


def test_streamed_queries_use_the_table(spark):
    b = catalog.Q["r9_top_moods"](spark, SF_SMALL).collect()
    assert sorted(catalog.Q["r9_top_moods_stream"](spark, SF_SMALL).collect()) == sorted(b)


def test_vectors_without_structure_are_not_copied_to_all_buckets(spark, monkeypatch):
    """Where the buckets would hold all pairs, every query is scored in the exact blocks, once, and none is copied."""
    monkeypatch.setattr(similar, "BUCKET_ROWS", 20)
    rng = np.random.default_rng(8)
    items = spark.createDataFrame([(f"a{i:03d}", r.tolist()) for i, r in enumerate(rng.normal(size=(400, 48)))],
                                  "artist_name string, features array<double>")
    queries = items.select(F.col("artist_name").alias("query"))
    copied, real = [], similar._placed

    def watched(rows, bits, visits, dims):
        out = real(rows, bits, visits, dims)
        if "h" in rows.columns and visits > 1:
            copied.append(out.count())
        return out

    monkeypatch.setattr(similar, "_placed", watched)
    rows, report = similar.similar_items_approx(queries, items, 10)
    got = {(r.query, r.similar_artist, r["rank"]) for r in rows.collect()}
    assert got == {(r.query, r.similar_artist, r["rank"]) for r in score.similar_items(queries, items, 10).collect()}
    r = report.first()
    assert r.recall == 1 and r.share == 1 and r.n_judged == 400
    assert max(copied, default=0) <= 400 * (1 << r.bits) * similar.MAX_SHARE


def test_bucket_queries_carry_all_the_kernel_reads(spark, clustered):
    """Neighbours inside the visited buckets: every bucket visited, the rows are the exact ones."""
    items = clustered.limit(120).select(F.col("artist_name").alias("key"), F.xxhash64("artist_name").alias("h"), "features")
    items = items.where(F.aggregate("features", F.lit(0.0), lambda a, x: a + x * x) > 0).cache()
    kind = items.schema["key"].dataType
    got = {(r._q, r.similar_artist, r["rank"]) for r in similar._neighbours(items, items, kind, 2, 4, 3, [16]).collect()}
    keys, x = zip(*((r.key, r.features) for r in items.collect()))
    s = np.array(x) @ np.array(x).T
    np.fill_diagonal(s, -np.inf)
    assert got == {(keys[i], keys[j], n) for i in range(len(keys)) for n, j in enumerate(np.argsort(-s[i])[:3], 1)}
