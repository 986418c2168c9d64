"""One user owning a third of all rows: results stay exact and whole."""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tonearm.operators import kcore, score, split


def _skewed(n=3000, hot_share=1 / 3, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        u = "hot" if rng.random() < hot_share else f"u{rng.integers(0, 200)}"
        rows.append((u, f"a{rng.integers(0, 300)}", int(rng.integers(1, 9)), None))
    return rows


SCHEMA = "user_id string, artist_name string, play_count long, artist_mbid string"


def test_split_exact_with_hot_user(spark):
    rows = _skewed()
    df = spark.createDataFrame(rows, SCHEMA)
    got = split.holdout_flag(df, digits=2, hot_rows=100).groupBy("user_id").agg(F.count_if("is_test").alias("t"),
                                                                  F.count("*").alias("n"))
    got = {r.user_id: (r.t, r.n) for r in got.collect()}
    pdf = pd.DataFrame(rows, columns=["user_id", "artist_name", "play_count", "artist_mbid"])
    want = pdf.groupby("user_id").size()
    for u, n in want.items():
        assert got[u] == (max(1, int(n * 0.2)), n)
    # the hot user's test rows are exactly its first rows in md5 order
    hot = pdf[pdf.user_id == "hot"].copy()
    hot["h"] = [hashlib.md5(f"hot:{a}:42".encode()).hexdigest() for a in hot.artist_name]
    hot = hot.sort_values(["h", "play_count"]).head(max(1, int(len(hot) * 0.2)))
    flagged = split.holdout_flag(df, digits=2, hot_rows=100).where("user_id = 'hot' AND is_test")
    assert sorted(r.artist_name for r in flagged.collect()) == sorted(hot.artist_name)


def test_kcore_keeps_hot_user_whole(spark):
    rows = _skewed()
    df = spark.createDataFrame(rows, SCHEMA)
    out, _ = kcore.kcore_filter(df, 5, 3)
    n_hot = sum(1 for r in rows if r[0] == "hot")
    kept = out.where("user_id = 'hot'").count()
    assert 0 < kept <= n_hot and out.groupBy("artist_name").count().agg(F.min("count")).first()[0] >= 3


def test_unseen_topk_for_hot_user(spark):
    rng = np.random.default_rng(1)
    items = [f"a{j:03d}" for j in range(300)]
    v = rng.normal(size=(300, 4))
    u = rng.normal(size=4)
    seen = set(rng.choice(items, size=280, replace=False))  # the hot user has seen almost everything
    uf = spark.createDataFrame([("hot", u.tolist())], "user_id string, features array<double>")
    itf = spark.createDataFrame([(items[j], v[j].tolist()) for j in range(300)],
                                "artist_name string, features array<double>")
    train = spark.createDataFrame([("hot", a) for a in sorted(seen)], "user_id string, artist_name string")
    got = [(r.artist_name, r["rank"]) for r in
           score.recommend_unseen(uf.select("user_id"), uf, itf, train, 10).orderBy("rank").collect()]
    s = v @ u
    want = sorted(((-s[j], items[j]) for j in range(300) if items[j] not in seen))[:10]
    assert got == [(name, i + 1) for i, (_, name) in enumerate(want)]


def test_matrix_and_mood_requests_exact_with_hot_artist(spark):
    """One artist with half of all rows, one mood with nearly all requests: whole and exact."""
    from tonearm.operators import matrix, requests

    rng = np.random.default_rng(9)
    rows = [(f"u{i % 150}", "hot" if i % 2 else f"a{rng.integers(0, 40)}", 1 + i % 3) for i in range(3000)]
    df = spark.createDataFrame(rows, "user_id string, artist_name string, play_count long")
    inter = df.withColumn("confidence", 1 + 40 * F.col("play_count"))
    users = df.select("user_id").distinct().withColumn("user_idx", F.expr("cast(substring(user_id, 2) as int)"))
    artists = df.select("artist_name").distinct().withColumn("artist_idx", F.hash("artist_name"))
    m = matrix.play_matrix(matrix.indexed_interactions(inter, users, artists))
    want = pd.DataFrame(rows, columns=["u", "a", "p"]).groupby(["u", "a"]).p.sum()
    assert m.count() == len(want) and m.agg(F.sum("plays")).first()[0] == want.sum()

    uf = users.select("user_id", F.array(F.rand(1), F.rand(2)).alias("features"))
    itf = artists.select("artist_name", F.array(F.rand(3), F.rand(4)).alias("features"))
    uf.cache().count(), itf.cache().count()
    moods = spark.createDataFrame([("rock", "Rock", "", ["hot", "a1"]), ("mute", "Mute", "", ["nobody"])],
                                  "mood string, name string, description string, seed_artists array<string>")
    reqs = [(i, "mood", "rock" if i % 50 else "mute", None, 3 if i % 7 else None) for i in range(2000)]
    reqs += [(2000, "mood", "", None, 3), (2001, "mood", "blues", None, 3), (2002, "user", None, "nobody", 3),
             (2003, "user", None, None, 3), (2004, "random", None, None, 51), (2005, "random", None, None, 2)]
    req = spark.createDataFrame(reqs, "request_id long, type string, mood string, user_id string, k int")
    out = requests.dispatch(req, moods, artists.select("artist_name"), df, uf, itf, n_users=20).collect()
    by = {}
    for r in out:
        by.setdefault(r.request_id, []).append(r)
    assert set(by) == {r[0] for r in reqs}
    assert all(len(by[i]) == (reqs[i][4] or 10) and by[i][0].seed_artists == ["hot", "a1"]
               for i in range(2000) if i % 50)
    errors = {i: by[i][0].error for i in (50, 2000, 2001, 2002, 2003, 2004)}
    assert errors == {50: "no seed artist in the data", 2000: "mood is required for mood requests",
                      2001: "unknown mood", 2002: "unknown user", 2003: "user_id is required for user requests",
                      2004: "k must be between 1 and 50"}
    assert len(by[2005]) == 2 and by[2005][0].error is None
