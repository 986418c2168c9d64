"""Grid dealing, block pruning, hot-key joins: spread and exactness where keys or norms are skewed."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tonearm.operators import ids, kcore, matrix, score
from tonearm.operators.hotjoin import hot_key_join, hot_keys


@pytest.fixture
def plain_shuffles(spark):
    """No adaptive re-planning and no size-based broadcast."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def _table(spark, name, m):
    return spark.createDataFrame([(f"{name}{i:04d}", r.tolist()) for i, r in enumerate(m)],
                                 f"{'user_id' if name == 'u' else 'artist_name'} string, features array<double>")


def test_one_item_block_and_many_query_blocks_keep_every_task_busy(spark, plain_shuffles, monkeypatch):
    """The pairs are partitioned by both numbers, so one item block still fills the partitions."""
    monkeypatch.setattr(score, "QUERY_BLOCK", 8)
    rng = np.random.default_rng(4)
    users, items = _table(spark, "u", rng.normal(size=(600, 3))), _table(spark, "a", rng.normal(size=(50, 3)))
    job = score._Scoring(users.withColumn("k", F.lit(3)), items, "user_id", "artist_name", "k", None, "features", False)
    assert job.n_item_blocks == 1 and job.n_query_blocks == 75
    pairs = job.all_pairs()
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(query_group" in plan and "item_block" in plan.split("hashpartitioning(query_group")[1][:40]
    busy = pairs.select(F.spark_partition_id().alias("p"), F.size("queries").alias("n")).groupBy("p").agg(F.sum("n")).collect()
    assert len(busy) >= 6 and max(r[1] for r in busy) <= 600 / 2
    assert sum(r[1] for r in busy) == 600  # every query meets the one item block once


def test_grid_of_many_blocks_pairs_each_once(spark, plain_shuffles, monkeypatch):
    monkeypatch.setattr(score, "QUERY_BLOCK", 10)
    monkeypatch.setattr(score, "ITEM_BLOCK", 7)
    rng = np.random.default_rng(4)
    users, items = _table(spark, "u", rng.normal(size=(200, 3))), _table(spark, "a", rng.normal(size=(60, 3)))
    job = score._Scoring(users.withColumn("k", F.lit(3)), items, "user_id", "artist_name", "k", None, "features", False)
    pairs = job.all_pairs().select("query_block", "item_block").collect()
    assert len(pairs) == len(set(pairs)) == len({p[0] for p in pairs}) * len({p[1] for p in pairs})


@pytest.mark.parametrize("flat", [False, True])
def test_pruning_keeps_the_result_and_skips_products(spark, monkeypatch, flat):
    """Norms that fall off: the same rows as unpruned, and far fewer products; equal norms: nothing is lost."""
    monkeypatch.setattr(score, "QUERY_BLOCK", 16)
    monkeypatch.setattr(score, "ITEM_BLOCK", 20)
    rng = np.random.default_rng(6)
    v = rng.normal(size=(400, 5))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    if not flat:
        v *= 0.98 ** np.arange(400)[:, None]
    v[50:60] = v[49]  # ties
    v[399] = 0
    u = np.vstack([rng.normal(size=(90, 5)), np.zeros((2, 5))])
    users, items = _table(spark, "u", u), _table(spark, "a", v)
    seen = spark.createDataFrame([(f"u{i:04d}", f"a{j:04d}") for i in range(92) for j in rng.choice(120, 25, replace=False)]
                                 + [("u0003", f"a{j:04d}") for j in range(397)], "user_id string, artist_name string")
    asked = users.withColumn("k", F.when(F.col("user_id") == "u0005", 0).otherwise(F.col("user_id").substr(5, 1).cast("int") + 1))
    get = lambda prune: sorted(tuple(r) for r in score.top_items(
        asked, items, "user_id", "artist_name", "k", seen=seen, prune=prune).collect())
    with_, without = get(True), get(False)
    assert [r[:2] + r[3:] for r in with_] == [r[:2] + r[3:] for r in without]
    assert np.allclose([r[2] for r in with_], [r[2] for r in without])
    gone = {tuple(r) for r in seen.collect()}
    for i in (0, 3, 7, 91):
        k = (i % 10) + 1
        want = sorted((-float(u[i] @ v[j]), f"a{j:04d}") for j in range(400) if (f"u{i:04d}", f"a{j:04d}") not in gone)[:k]
        assert [r[1] for r in sorted((r for r in with_ if r[0] == f"u{i:04d}"), key=lambda r: r[3])] == [w[1] for w in want]
    work = score.pruned_work(asked, items, "user_id", "artist_name", "k", seen=seen).first()
    assert work.n_all_products == 92 * 400
    if not flat:
        assert work.n_products < 0.5 * work.n_all_products


def test_score_sums_are_those_of_the_unseen_items(spark, monkeypatch):
    monkeypatch.setattr(score, "QUERY_BLOCK", 4)
    monkeypatch.setattr(score, "ITEM_BLOCK", 6)
    rng = np.random.default_rng(2)
    u, v = rng.normal(size=(9, 4)), rng.normal(size=(20, 4))
    users, items = _table(spark, "u", u), _table(spark, "a", v)
    gone = {(f"u{i:04d}", f"a{j:04d}") for i in range(9) for j in range(20) if (i * j) % 3 == 1 or i == 8}
    seen = spark.createDataFrame(sorted(gone), "user_id string, artist_name string")
    got = {r.user_id: r for r in score.score_sums(users, items, "user_id", "artist_name", seen=seen).collect()}
    assert "u0008" not in got  # it has seen everything
    for i in range(8):
        s = [u[i] @ v[j] for j in range(20) if (f"u{i:04d}", f"a{j:04d}") not in gone]
        r = got[f"u{i:04d}"]
        assert r.n_items == len(s) and np.allclose([r.score_sum, r.best_score, r.worst_score], [sum(s), max(s), min(s)])


def _plays(spark, n=20_000):
    k = F.col("id") % 10
    return spark.range(n).select(
        F.when(k == 9, F.lit(None)).otherwise(F.concat(F.lit("u"), (F.col("id") % 997).cast("string"))).alias("user_id"),
        F.when(k < 5, F.lit("hot")).otherwise(F.concat(F.lit("a"), (F.col("id") % 701).cast("string"))).alias("artist_name"),
        (F.col("id") % 5 + 1).alias("play_count"))


def test_hot_artist_is_spread_over_the_partitions(spark, plain_shuffles, monkeypatch):
    """An artist with half of all rows: the lookup's partitions hold like numbers of rows, and no row is lost."""
    monkeypatch.setattr("tonearm.operators.hotjoin.HOT_ROWS", 2_000)
    plays = _plays(spark)
    artists = plays.select("artist_name").distinct().where("artist_name != 'a7'").withColumn("artist_idx", F.hash("artist_name"))
    assert [r[0] for r in hot_keys(plays, "artist_name").collect()] == ["hot"]
    for how in ("inner", "left"):
        out = hot_key_join(plays, artists, "artist_name", how)
        rows = lambda df: sorted(map(str, df.select("user_id", "artist_name", "play_count", "artist_idx").collect()))
        assert rows(out) == rows(plays.join(artists, "artist_name", how))
        sizes = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert max(sizes) < 20_000 / 6  # half of the rows, 10,000, were one task's before
    plain = plays.join(artists, "artist_name")
    assert max(r[0] for r in plain.groupBy(F.spark_partition_id()).count().select("count").collect()) > 10_000


def test_lookups_with_a_hot_artist_and_null_users(spark, plain_shuffles, monkeypatch):
    """J1, J2 and P4 give what the plain joins give."""
    monkeypatch.setattr("tonearm.operators.hotjoin.HOT_ROWS", 1_000)
    plays = _plays(spark, 6_000).withColumn("confidence", F.col("play_count") * 40 + 1)
    users = plays.select("user_id").where("user_id IS NOT NULL AND user_id != 'u3'").distinct().withColumn("user_idx", F.hash("user_id"))
    artists = plays.select("artist_name").distinct().withColumn("artist_idx", F.hash("artist_name"))
    cols = ["user_id", "artist_name", "play_count", "user_idx", "artist_idx"]
    rows = lambda df: sorted(map(str, df.select(*cols).collect()))
    assert rows(ids.attach_indices(plays, users, artists)) == rows(
        plays.join(users, "user_id", "left").join(artists, "artist_name", "left"))
    inner = plays.join(users, "user_id").join(artists, "artist_name")
    assert rows(matrix.indexed_interactions(plays, users, artists)) == rows(inner)
    names = ids.attach_names(inner.select("artist_idx"), artists)
    assert names.groupBy("artist_name").count().where("artist_name = 'hot'").first()["count"] == inner.where(
        "artist_name = 'hot'").count()


def test_hot_keys_needs_a_large_share(spark):
    """No key is hot below the row bound; an empty table and a bad join type are told apart."""
    plays = _plays(spark, 500)
    assert hot_keys(plays, "artist_name") is None
    assert hot_keys(plays.limit(0), "artist_name") is None
    with pytest.raises(ValueError):
        hot_key_join(plays, plays, "artist_name", "outer")


def _peel_plainly(rows, mu, ma):
    """Rounds of the k-core over a list of (user, item) rows: the survivors and the row counts."""
    history = [len(rows)]
    while True:
        for side, least in ((0, mu), (1, ma)):
            n = {}
            for r in rows:
                n[r[side]] = n.get(r[side], 0) + 1
            rows = [r for r in rows if n[r[side]] >= least]
        history.append(len(rows))
        if history[-1] == history[-2]:
            return sorted(rows), history


@pytest.mark.parametrize("share", [0.0, 0.05, 1.0])
def test_frontier_rounds_are_those_of_rewriting(spark, share):
    """Repeated pairs and hubs: the same survivors and the same row counts per round, however soon the frontier starts."""
    rng = random.Random(11)
    rows = [("hub" if rng.random() < 0.1 else f"u{int(rng.paretovariate(0.8)) % 90}", f"a{int(rng.paretovariate(0.6)) % 120}")
            for _ in range(900)]
    df = spark.createDataFrame(rows, "user_id string, artist_name string")
    out, history = kcore.kcore_filter(df, 6, 4, rewrite_share=share)
    want, counts = _peel_plainly(rows, 6, 4)
    assert sorted(map(tuple, out.collect())) == want and [h["rows"] for h in history] == counts


def test_frontier_on_a_long_path_writes_little(spark, monkeypatch):
    """A path of 130 nodes beside a core of 8,000 rows: exact after over 30 rounds, and no round writes the pairs again."""
    written = []
    real = kcore.materialize

    def watched(df, name, *a):
        out = real(df, name, *a)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(kcore, "materialize", watched)
    keep = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")  # many small rounds
    path = [(f"p{i // 2}", f"q{(i + 1) // 2}") for i in range(129)]  # p0-q0, p0-q1, p1-q1, ...
    core = [(f"u{i % 100}", f"a{i % 80}") for i in range(8_000)]
    df = spark.createDataFrame(path + core, "user_id string, artist_name string")
    try:
        out, history = kcore.kcore_filter(df, 2, 2)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", keep)
    want, counts = _peel_plainly(path + core, 2, 2)
    assert sorted(map(tuple, out.collect())) == want and [h["rows"] for h in history] == counts
    assert len(history) > 30
    rounds = [n for name, n in written if name in ("kcore-gone", "kcore-lost")]
    assert len(rounds) > 100 and max(rounds) <= 2
    assert sum(name.startswith("kcore-") and name[6:].isdigit() for name, _ in written) == 2  # start and one round


@pytest.mark.parametrize("few", [0, 500_000])
def test_core_selection_shuffles_no_rows(spark, plain_shuffles, monkeypatch, few):
    """The core is the written rows without the removed nodes: no exchange, null keys and repeated pairs included."""
    monkeypatch.setattr(kcore, "MAX_BROADCAST_NODES", few)
    rng = random.Random(3)
    rows = [(f"u{int(rng.paretovariate(0.9)) % 70}", f"a{int(rng.paretovariate(0.7)) % 90}") for _ in range(700)]
    rows += [(None, "a1"), ("u1", None), (None, None)] * 4
    out, history = kcore.kcore_filter(spark.createDataFrame(rows, "user_id string, artist_name string"), 6, 4)
    want, counts = _peel_plainly([r for r in rows if None not in r], 6, 4)
    assert sorted(map(tuple, out.collect())) == want and [h["rows"] for h in history][1:] == counts[1:]
    assert len(want) < history[0]["rows"] == len(rows)
    if few:
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_hot_keys_counts_only_crowded_cells(spark, monkeypatch):
    """Keys that share a crowded cell of the hash are told apart; without a crowded cell no key is counted."""
    monkeypatch.setattr("tonearm.operators.hotjoin.HASH_CELLS", 2)
    plays = _plays(spark)
    assert [r[0] for r in hot_keys(plays, "artist_name", 2_000).collect()] == ["hot"]
    assert hot_keys(plays.where("artist_name != 'hot'"), "artist_name", 2_000) is None  # crowded cells, no hot key
    monkeypatch.undo()
    seen = []
    monkeypatch.setattr("tonearm.operators.hotjoin.materialize", lambda df, name: seen.append(name))
    assert hot_keys(plays.where("artist_name != 'hot'"), "artist_name", 2_000) is None and not seen
