import time

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from small_tables import SF_SMALL
from tonearm.operators import als, score
from tonearm.plans import catalog, fixtures as fx
from tonearm.streaming import monitor


def test_stream_equals_batch(spark):
    for name in ("r6_requests_per_minute", "r5_gauges_last", "r11_traffic_stats"):
        b = {tuple(r) for r in catalog.Q[name](spark, SF_SMALL).collect()}
        s = {tuple(r) for r in catalog.Q[name + "_stream"](spark, SF_SMALL).collect()}
        assert b == s, name


def test_als_normal_equations(spark):
    """MLlib implicit ALS: user factors solve (Y'Y + Y'(C-I)Y + lambda*n_u I) x = Y'C p."""
    rng = np.random.default_rng(0)
    cells = [(u, i, float(rng.integers(1, 5))) for u in range(20) for i in range(15) if rng.random() < 0.4]
    m = spark.createDataFrame(cells, "user_idx int, artist_idx int, plays double")
    lam, alpha = 0.1, 2.0
    model, _ = als.fit_als(m, factors=3, iterations=15, regularization=lam, alpha=alpha, blocks=1)
    U = {r.id: np.array(r.features, dtype=np.float64) for r in model.userFactors.collect()}
    V = {r.id: np.array(r.features, dtype=np.float64) for r in model.itemFactors.collect()}
    Y = np.stack([V[i] for i in sorted(V)])
    idx = {i: k for k, i in enumerate(sorted(V))}
    u0 = [c for c in cells if c[0] == 0]
    A = Y.T @ Y + lam * len(u0) * np.eye(3)
    b = np.zeros(3)
    for _, i, r in u0:
        y = Y[idx[i]]
        A += alpha * r * np.outer(y, y)
        b += (1 + alpha * r) * y
    assert np.abs(A @ U[0] - b).max() < 1e-3


def test_trained_recs_exclude_train(spark):
    pre = catalog._pre(spark, SF_SMALL)
    model, _ = als.fit_als(pre["matrix"], factors=4, iterations=3, blocks=2)
    uf, itf = als.named_factors(model, pre["user_map"], pre["artist_map"])
    recs = score.recommend_unseen(pre["train"].select("user_id").distinct(), uf, itf, pre["train"], 5)
    assert recs.join(pre["train"], ["user_id", "artist_name"]).count() == 0
    per_user = recs.groupBy("user_id").agg(F.collect_list("rank").alias("r")).collect()
    assert all(sorted(r.r) == list(range(1, len(r.r) + 1)) for r in per_user)


def test_weight_of_three_plays(spark):
    m = spark.createDataFrame([(0, 0, 121.0, 3.0)], "user_idx int, artist_idx int, value double, plays double")
    for double, want in ((False, 121.0), (True, 4840.0)):
        data, alpha = als.als_input(m, 40.0, double)
        assert 1 + alpha * data.first()["rating"] == want


def _events_folder(spark, path, parts=3):
    """The events dealt row by row over several files, so that each holds all times."""
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    rows = ev.orderBy("ts", "event_id").coalesce(1).withColumn("n", F.monotonically_increasing_id())
    for i in range(parts):
        rows.where(F.col("n") % parts == i).drop("n").coalesce(1).write.mode("append").parquet(f"{path}/events.parquet")
    return ev


@pytest.mark.parametrize("name", sorted(catalog.R_SPEC))
def test_stream_over_interleaved_files_equals_batch(spark, tmp_path, name):
    fn, keys, post, rounded = catalog.R_SPEC[name]
    ev = _events_folder(spark, tmp_path)
    stream = monitor.event_stream(spark, f"{tmp_path}/events.parquet", ev.schema, max_files=1)
    path, dropped = monitor.run_stream(fn(fx.request_log(spark, str(tmp_path), stream)), keys, name)
    out = monitor.latest(spark, path, keys)
    assert dropped == 0 and spark.read.parquet(path).select("_batch").distinct().count() == 3
    out = out.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in catalog._TS_COLS else F.col(c)
                       for c in out.columns])
    got = catalog._finish(out, post, rounded)
    want = catalog.Q[name](spark, SF_SMALL)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_late_rows_are_counted(spark, tmp_path):
    ev = _events_folder(spark, tmp_path)
    stream = monitor.event_stream(spark, f"{tmp_path}/events.parquet", ev.schema, watermark="10 minutes", max_files=1)
    path, dropped = monitor.run_stream(monitor.per_minute(fx.request_log(spark, str(tmp_path), stream)),
                                       ["window_start", "window_end"], "late")
    kept = monitor.latest(spark, path, ["window_start", "window_end"]).agg(F.sum("requests")).first()[0]
    assert dropped > 0 and kept < ev.count()


def test_stream_without_files_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        monitor.event_stream(spark, f"{tmp_path}/none.parquet", spark.range(1).schema)


def test_errors_sliding_uses_its_window(spark):
    ts = spark.createDataFrame([("2024-01-01 00:00:30", True)], "t string, is_error boolean")
    log = ts.select(F.col("t").cast("timestamp").alias("ts"), "is_error")
    assert monitor.errors_sliding(log, "2 minutes", "2 minutes").first()["errors_per_minute"] == 0.5


def test_a_larger_fit_uses_more_blocks(spark, monkeypatch):
    """The number of blocks, and so of tasks, follows the cells; a small matrix keeps four blocks and its factors."""
    assert [als.blocks_for(n) for n in (0, 48_000, 200_001, 480_000, 2_870_000, 5_000_000, 10 ** 9)] == [4, 4, 6, 12, 12, 20, 24]
    rng = np.random.default_rng(1)
    cells = [(u, i, float(rng.integers(1, 5))) for u in range(60) for i in range(50) if rng.random() < 0.3]
    m = spark.createDataFrame(cells, "user_idx int, artist_idx int, plays double")
    fit = lambda **kw: als.fit_als(m, factors=3, iterations=2, **kw)[0]
    rows = lambda model: sorted((r.id, *r.features) for r in model.userFactors.collect())
    assert rows(fit()) == rows(fit(blocks=4))
    monkeypatch.setattr(als, "FEW_CELLS", len(cells) // 7)
    assert fit().userFactors.rdd.getNumPartitions() == als.blocks_for(len(cells)) >= 7


def test_factors_solve_their_equations_in_any_number_of_blocks(spark, monkeypatch):
    """Rows with fewer and with more cells than the rank, cells of no and of negative rating, several parts a block."""
    rng = np.random.default_rng(2)
    cells = [(u, i, float(rng.integers(-1, 5))) for u in range(30) for i in range(25) if rng.random() < (0.1 if u % 2 else 0.7)]
    m = spark.createDataFrame(cells, "user_idx int, artist_idx int, plays double")
    lam, alpha, rank = 0.1, 2.0, 6

    def fit(blocks):
        model, _ = als.fit_als(m, factors=rank, iterations=3, regularization=lam, alpha=alpha, blocks=blocks)
        return [{r.id: np.array(r.features, np.float64) for r in f.collect()} for f in (model.userFactors, model.itemFactors)]
    (users, items), others = fit(1), [fit(3)]
    monkeypatch.setattr(als, "PART_CELLS", 40)
    others.append(fit(2))
    for other in others:
        for a, b in zip((users, items), other):
            assert a.keys() == b.keys() and max(np.abs(a[k] - b[k]).max() for k in a) < 1e-4
    y = np.stack(list(items.values()))
    seen = set()
    for u, x in users.items():
        mine = [(i, r) for v, i, r in cells if v == u]
        seen.add(sum(r != 0 for _, r in mine) > rank)
        a = y.T @ y + lam * sum(r > 0 for _, r in mine) * np.eye(rank)
        a += sum(alpha * abs(r) * np.outer(items[i], items[i]) for i, r in mine)
        b = sum(((1 + alpha * r) * items[i] for i, r in mine if r > 0), np.zeros(rank))
        assert np.abs(a @ x - b).max() < 1e-3
    assert seen == {True, False}


def test_a_large_fit_sends_vectors_to_few_parts_and_keeps_one_half_step_on_disk(spark, monkeypatch):
    """Rows of 24 cells in 24 million: a part per block.  Where the mail is large, past shuffle files go after each half step."""
    import glob
    assert als.blocks_for(28_800_000) * als.PART_CELLS >= 28_800_000
    rng = np.random.default_rng(4)
    cells = [(u, i, 1.0) for u in range(200) for i in rng.choice(150, 20, replace=False).tolist()]
    m = spark.createDataFrame(cells, "user_idx int, artist_idx int, plays double")
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}
    before, kept, released, real = files(), [], [], als.release_shuffles

    def watched(session):
        released.append(len(kept))
        real(session)
        for _ in range(50):  # deleted by another thread
            if not files() - before:
                break
            time.sleep(0.1)
        kept.append(len(files() - before))

    monkeypatch.setattr(als, "release_shuffles", watched)
    monkeypatch.setattr(als, "MAIL_BYTES", 0)
    als.fit_als(m, factors=4, iterations=3, blocks=3)
    assert len(released) == 1 + 6 and max(kept) == 0
