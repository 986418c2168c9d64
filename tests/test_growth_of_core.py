"""What the core, the split and the ranking read and send, so that it grows with their input."""

import __spark_entry__ as entry
from pyspark.sql import functions as F

from small_tables import SF_SMALL
from tonearm.operators import kcore, profile, score, split
from tonearm.plans import fixtures as fx


def _watch(monkeypatch, module):
    names, real = [], module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, name, *a, **k: (names.append(name), real(df, name, *a, **k))[1])
    return names


def test_core_counts_each_side_once(spark, monkeypatch):
    names = _watch(monkeypatch, kcore)
    rows = [(f"u{i % 40}", f"a{i % 30}") for i in range(2400)] + [(f"x{i}", "rare") for i in range(2)]
    out, history = kcore.kcore_filter(spark.createDataFrame(rows, "user_id string, artist_name string"), 2, 2)
    assert out.count() == 2400 and [h["rows"] for h in history] == [2402, 2400, 2400]
    assert names.count("kcore-degrees") == 1 and "kcore-pairs" not in names  # the frontier goes on from the round's counts


def test_retention_reads_written_rows_without_pair_counts(spark):
    plan = entry.queries()["a10_retention"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "SortMergeJoin" not in plan
    exchanges = [x for x in plan.splitlines() if "hashpartitioning" in x]
    assert exchanges and not any("user_id" in x and "artist_name" in x for x in exchanges)


def test_written_sides_equal_pairwise_sides(spark):
    rows = [("u1", "a", True), ("u1", "a", False), ("u1", None, True), (None, "b", False), ("u2", "a", False), ("u2", "a", False)]
    df = spark.createDataFrame(rows, "user_id string, artist_name string, t boolean")
    one, two = (profile.sides(df, F.col("t"), "user_id", "artist_name", w).first() for w in (False, True))
    assert one == two and one["rows_a"] == 2 and one["rows_b"] == 4
    none = profile.sides(df.where("false"), F.col("t"), "user_id", "artist_name", True).first()
    assert none["rows_a"] == 0 and none["users"] == 0


def test_split_sends_no_feedback_columns(spark, monkeypatch):
    sent, real = [], split.holdout_flag
    monkeypatch.setattr(split, "holdout_flag", lambda df, *a, **k: (sent.append(df.columns), real(df, *a, **k))[1])
    monkeypatch.setattr(fx, "_cache", {})
    out = fx.flagged(spark, SF_SMALL)
    assert "confidence" not in sent[0] and "preference" not in sent[0]
    assert out.columns == [*fx.interactions(spark, SF_SMALL).columns, "is_test"]


def test_blocks_are_sent_once_per_group_of_the_other_side(spark, monkeypatch):
    """20 query and 20 item blocks on a grid of 24 cells: each is sent about 5 times, not once per block, and cells stay bounded."""
    for name, value in (("QUERY_BLOCK", 10), ("ITEM_BLOCK", 10)):
        monkeypatch.setattr(score, name, value)
    g_q, g_i = score.grid(20, 20, 24)
    assert g_q * g_i >= 24 and max(g_q, g_i) <= 6
    assert score.grid(50, 1, 24) == (24, 1) and score.grid(1, 50, 24) == (1, 24) and score.grid(2, 3, 24) == (2, 3)
    monkeypatch.setattr(score, "CELL_ROWS", 20)
    assert min(score.grid(20, 20, 24)) == 10
    monkeypatch.undo()
    monkeypatch.setattr(score, "ITEM_BLOCK", 16)
    sent, real = [], score.deal
    vector = F.array(*[F.rand(i) - 0.5 for i in range(4)])
    users = spark.range(400).select(F.concat(F.lit("u"), "id").alias("user_id"), vector.alias("features"), F.lit(3).alias("k"))
    items = spark.range(640).select(F.concat(F.lit("a"), "id").alias("artist_name"), vector.alias("features"))
    monkeypatch.setattr(score, "deal", lambda *a, **k: (sent.append(a), real(*a, **k))[1])
    left = score.top_items(users, items, "user_id", "artist_name", "k", prune=False)
    assert left.count() == 1200
    g_q, g_i = score.grid(*sent[0][2:4], 24)
    assert g_i < sent[0][3] == 40
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(query_group" in plan


def test_later_item_blocks_send_only_what_reaches_the_scores_before_them():
    """A cell's item blocks meet a query block one after the other: together they give little more than k rows a query."""
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(5)
    kind = pa.struct([("key", pa.string()), ("k", pa.int64()), ("seen", pa.list_(pa.int64())), ("last", pa.int32()),
                      ("beat", pa.float64()), ("features", pa.list_(pa.float64()))])
    item = pa.struct([("key", pa.string()), ("h", pa.int64()), ("features", pa.list_(pa.float64()))])
    u, v = rng.normal(size=(30, 3)), rng.normal(size=(400, 3))
    k = [i % 4 for i in range(30)]
    asked = [{"key": f"u{i}", "k": k[i], "seen": [i], "last": 9 if i % 5 else 1, "beat": -np.inf, "features": u[i].tolist()} for i in range(30)]
    blocks = [[{"key": f"a{j:03d}", "h": j, "features": v[j].tolist()} for j in range(b * 40, b * 40 + 40)] for b in range(10)]
    batch = pa.RecordBatch.from_arrays([pa.array([3] * 10), pa.array([asked] * 10, pa.list_(kind)), pa.array(blocks, pa.list_(item)),
                                        pa.array(range(10), pa.int32())], names=["query_block", "queries", "items", "item_block"])
    kernel = score._pair_kernel(score._best("user_id", "artist_name"))
    rows = [tuple(r.values()) for b in kernel(iter([batch])) for r in b.to_pylist()]
    alone = [tuple(r.values()) for i in range(10) for b in kernel(iter([batch.slice(i, 1)])) for r in b.to_pylist()]
    top = lambda found, i: sorted((-s, a) for q, a, s in found if q == f"u{i}")[:k[i]]
    for i in range(30):
        reach = 400 if i % 5 else 80
        want = sorted((-float(u[i] @ v[j]), f"a{j:03d}") for j in range(reach) if j != i)[:k[i]]
        assert [a for _, a in top(rows, i)] == [a for _, a in want] == [a for _, a in top(alone, i)]
    assert len(rows) < 0.6 * len(alone)
