import numpy as np
from pyspark.sql import functions as F

from tonearm.operators import metrics, score


def _factors(spark, n_users=30, n_items=40, dim=6, seed=3):
    rng = np.random.default_rng(seed)
    u = rng.normal(size=(n_users, dim)).astype(np.float32)
    v = rng.normal(size=(n_items, dim)).astype(np.float32)
    v[5] = 0.0  # a zero vector
    uf = spark.createDataFrame([(f"u{i}", u[i].tolist()) for i in range(n_users)], "user_id string, features array<float>")
    itf = spark.createDataFrame([(f"a{j:02d}", v[j].tolist()) for j in range(n_items)],
                                "artist_name string, features array<float>")
    return u, v, uf, itf


def test_recommend_unseen_matches_bruteforce(spark, monkeypatch):
    u, v, uf, itf = _factors(spark)
    rng = np.random.default_rng(0)
    seen = {(f"u{i}", f"a{j:02d}") for i in range(30) for j in rng.choice(40, size=rng.integers(0, 30), replace=False)}
    train = spark.createDataFrame(sorted(seen), "user_id string, artist_name string")
    users = uf.select("user_id")
    for queries, items in ((1024, 4096), (7, 9)):  # one block of each, then many
        monkeypatch.setattr(score, "QUERY_BLOCK", queries)
        monkeypatch.setattr(score, "ITEM_BLOCK", items)
        got = {(r.user_id, r.rank): (r.artist_name, round(r.score, 9)) for r in
               score.recommend_unseen(users, uf, itf, train, 5).collect()}
        for i in range(30):
            s = u[i].astype(np.float64) @ v.astype(np.float64).T
            cand = [(-s[j], f"a{j:02d}") for j in range(40) if (f"u{i}", f"a{j:02d}") not in seen]
            for r, (neg, name) in enumerate(sorted(cand)[:5], start=1):
                assert got[(f"u{i}", r)] == (name, round(-neg, 9))


def test_similar_excludes_self_and_handles_zero(spark):
    _, v, _, itf = _factors(spark)
    q = spark.createDataFrame([(" A01 ",), ("a05",), ("nobody",)], "query string")
    out = score.similar_items(q, itf, 3).collect()
    assert {r.query for r in out} == {" A01 ", "a05"}
    assert all(r.similar_artist != r.artist_name for r in out)
    assert all(r.similarity == 0.0 for r in out if r.query == "a05")
    assert [r.query for r in score.unmatched_queries(q, itf).collect()] == ["nobody"]
    ranks = sorted(r["rank"] for r in out if r.query == " A01 ")
    assert ranks == [1, 2, 3]


def test_metrics_golden(spark):
    recs = spark.createDataFrame([("u", f"i{r}", float(10 - r), r) for r in range(1, 11)],
                                 "user_id string, artist_name string, score double, rank int")
    test = spark.createDataFrame([("u", "i1"), ("u", "i3")], "user_id string, artist_name string")
    m = metrics.ranking_metrics(recs, test, 10).first()
    assert abs(m["precision_at_10"] - 1.0) < 1e-12
    assert abs(m["map_at_10"] - 0.833333) < 1e-6
    assert abs(m["ndcg_at_10"] - 0.919721) < 1e-6


def test_metrics_user_without_hits_counts(spark):
    recs = spark.createDataFrame([("u", "i1", 1.0, 1), ("v", "x", 1.0, 1)],
                                 "user_id string, artist_name string, score double, rank int")
    test = spark.createDataFrame([("u", "i1"), ("v", "y")], "user_id string, artist_name string")
    m = metrics.ranking_metrics(recs, test, 10).first()
    assert m["precision_at_10"] == 0.5 and m["map_at_10"] == 0.5 and m["n_test_users"] == 2


def test_rewritten_catalog_gives_new_results(spark, tmp_path):
    path = str(tmp_path / "items")
    users = spark.createDataFrame([("u", [1.0])], "user_id string, features array<double>")
    train = spark.createDataFrame([], "user_id string, artist_name string")

    def top(rows):
        spark.createDataFrame(rows, "artist_name string, features array<double>").write.mode("overwrite").parquet(path)
        items = spark.read.parquet(path)
        return [r.artist_name for r in score.recommend_unseen(users, users, items, train, 2).orderBy("rank").collect()]

    assert top([("a", [1.0]), ("b", [0.5])]) == ["a", "b"]
    assert top([("a", [0.1]), ("b", [9.0])]) == ["b", "a"]


def test_ties_go_by_name_and_blocks_keep_k(spark, monkeypatch):
    monkeypatch.setattr(score, "ITEM_BLOCK", 10)
    users = spark.createDataFrame([("u", [0.0]), ("v", [1.0])], "user_id string, features array<double>")
    items = spark.createDataFrame([(f"a{i:02d}", [1.0]) for i in range(50)], "artist_name string, features array<double>")
    train = spark.createDataFrame([("v", "a00"), ("v", "unknown")], "user_id string, artist_name string")
    got = score.recommend_unseen(users, users, items, train, 3).orderBy("user_id", "rank").collect()
    assert [(r.user_id, r.artist_name) for r in got] == [
        ("u", "a00"), ("u", "a01"), ("u", "a02"), ("v", "a01"), ("v", "a02"), ("v", "a03")]


def test_merge_keeps_a_local_top_k(spark):
    users = spark.createDataFrame([("u", [1.0])], "user_id string, features array<double>")
    items = spark.createDataFrame([("a", [1.0])], "artist_name string, features array<double>")
    out = score.recommend_unseen(users, users, items, spark.createDataFrame([], "user_id string, artist_name string"), 1)
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_a_block_gives_only_what_reaches_the_score_found(spark):
    """Rows of a further block below the k-th score of the first block are not sent on; ties with it are; at most k leave."""
    import pyarrow as pa
    items = pa.array([{"key": f"i{j}", "h": j, "features": [float(j)]} for j in range(6)],
                     pa.struct([("key", pa.string()), ("h", pa.int64()), ("features", pa.list_(pa.float32()))]))
    kind = pa.struct([("key", pa.string()), ("k", pa.int64()), ("seen", pa.list_(pa.int64())), ("last", pa.int32()),
                      ("beat", pa.float64()), ("features", pa.list_(pa.float32()))])
    asked = [("none", 9.0, []), ("tie", 4.0, [5]), ("many", 1.0, []), ("open", -np.inf, [])]
    queries = pa.array([{"key": n, "k": 3, "seen": s, "last": 9, "beat": b, "features": [1.0]} for n, b, s in asked], kind)
    batch = pa.RecordBatch.from_arrays([pa.array([queries.to_pylist()], pa.list_(kind)), pa.array([items.to_pylist()], pa.list_(items.type)),
                                        pa.array([1], pa.int32())], names=["queries", "items", "item_block"])
    out = list(score._pair_kernel(score._best("user_id", "artist_name"))(iter([batch])))
    rows = [tuple(r.values()) for b in out for r in b.to_pylist()]
    top = [("i5", 5.0), ("i4", 4.0), ("i3", 3.0)]
    assert rows == [("tie", "i4", 4.0), *[("many", *t) for t in top], *[("open", *t) for t in top]]
