import random

import pandas as pd
from pyspark.sql import functions as F

from tonearm.operators import ids, kcore, split


def _rows(sizes):
    return [(f"u{u}", f"a{i}", 1 + i % 3, None) for u, n in enumerate(sizes) for i in range(n)]


SCHEMA = "user_id string, artist_name string, play_count long, artist_mbid string"


def test_split_golden_counts(spark):
    df = spark.createDataFrame(_rows([1, 4, 5, 10, 15]), SCHEMA)
    got = dict(split.holdout_flag(df).groupBy("user_id").agg(F.count_if("is_test").alias("t")).collect())
    assert got == {"u0": 1, "u1": 1, "u2": 1, "u3": 2, "u4": 3}


def test_split_salted_equals_plain_window(spark):
    random.seed(1)
    rows = [(f"u{random.randint(0, 3)}", f"a{random.randint(0, 400)}", random.randint(1, 5), None)
            for _ in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    from collections import Counter
    cols = ("user_id", "artist_name", "play_count", "is_test")
    a = Counter(tuple(r) for r in split.holdout_flag(df, digits=1, hot_rows=10).select(*cols).collect())
    b = Counter(tuple(r) for r in split.holdout_flag(df, digits=4).select(*cols).collect())
    assert a == b
    pdf = pd.DataFrame(rows, columns=["user_id", "artist_name", "play_count", "artist_mbid"])
    import hashlib
    pdf["h"] = [hashlib.md5(f"{u}:{a}:42".encode()).hexdigest() for u, a in zip(pdf.user_id, pdf.artist_name)]
    pdf = pdf.sort_values(["user_id", "h", "play_count"])
    pdf["rn"] = pdf.groupby("user_id").cumcount() + 1
    pdf["n"] = pdf.groupby("user_id")["h"].transform("size")
    pdf["is_test"] = pdf.rn <= (pdf.n * 0.2).astype(int).clip(lower=1)
    assert sum(pdf.is_test) == sum(n for r, n in a.items() if r[3])
    want = Counter(zip(pdf.user_id, pdf.artist_name, pdf.play_count, pdf.is_test))
    assert want == a


def test_split_partitions_rows(spark):
    df = spark.createDataFrame(_rows([7, 9, 23]), SCHEMA)
    f = split.holdout_flag(df)
    assert split.train_part(f).count() + split.test_part(f).count() == df.count()
    assert split.train_part(f).join(split.test_part(f), ["user_id", "artist_name"]).count() == 0


def _kcore_pandas(pdf, mu, ma):
    while True:
        before = len(pdf)
        uc = pdf.groupby("user_id").size()
        pdf = pdf[pdf.user_id.isin(uc[uc >= mu].index)]
        ac = pdf.groupby("artist_name").size()
        pdf = pdf[pdf.artist_name.isin(ac[ac >= ma].index)]
        if len(pdf) == before:
            return pdf


def test_kcore_matches_bruteforce_and_holds(spark):
    random.seed(7)
    rows = [(f"u{random.randint(0, 80)}", f"a{random.randint(0, 60)}", 1, None) for _ in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    out, hist = kcore.kcore_filter(df, 5, 3)
    want = _kcore_pandas(pd.DataFrame(rows, columns=["user_id", "artist_name", "play_count", "artist_mbid"]), 5, 3)
    assert out.count() == len(want) == hist[-1]["rows"]
    assert out.groupBy("user_id").count().agg(F.min("count")).first()[0] >= 5
    assert out.groupBy("artist_name").count().agg(F.min("count")).first()[0] >= 3
    assert kcore.kcore_round(out, 5, 3).count() == out.count()  # fixpoint


def test_dense_index_is_dense_and_ordered(spark):
    df = spark.createDataFrame([(f"k{i:05d}",) for i in range(2000)], "user_id string").repartition(13)
    out = ids.user_index(df).orderBy("user_idx").collect()
    assert [r["user_idx"] for r in out] == list(range(2000))
    assert [r["user_id"] for r in out] == sorted(r["user_id"] for r in out)


def test_artist_index_first_appearance(spark):
    rows = [("u2", "b", "B"), ("u1", "c", "c"), ("u1", "a", "z"), ("u3", "a", "a")]
    df = spark.createDataFrame(rows, "user_id string, artist_name string, raw_name string")
    got = {r["artist_name"]: r["artist_idx"] for r in ids.artist_index(df).collect()}
    assert got == {"c": 0, "a": 1, "b": 2}


def test_kcore_runs_until_stable(spark):
    """A path of users and artists loses one pair at each end per round: over 50 rounds."""
    n = 104
    rows = [(f"u{i:03d}", f"a{i + d:03d}", 1, None) for i in range(n) for d in (0, 1)]
    out, history = kcore.kcore_filter(spark.createDataFrame(rows, SCHEMA), 2, 2)
    assert out.count() == 0 and len(history) > 52
