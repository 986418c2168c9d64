import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from small_tables import SF_SMALL

FAST = ["p2_clean_names", "k1_kcore_filter", "w1_holdout_split", "u4_artist_index", "m6_top_charts",
        "m3_user_recs", "m5_similar_artists", "m4_mood_recs", "m2_evaluate_ranking", "m15_dispatch_requests",
        "r7_latency_sliding", "r7_latency_sliding_stream", "m12_run_summary"]


def _norm(v):
    if isinstance(v, float):
        return f"{round(v, 6):.6f}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["mood", "k", "rank", "artist_name", "score"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", FAST)
def test_oracle_sf0001(spark, name):
    con = duckdb.connect()
    for t in ["part", "orders", "lineitem", "events", "embeddings", "customer"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = entry.queries()[name](spark, SF_SMALL)
    cur = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _bag(df.columns, [tuple(r) for r in df.collect()]) == _bag(dcols, cur.fetchall())
