"""Prefix trie, whitening and substring dedup against plain versions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from llm_tables import clashing
from pyspark.sql import functions as F

from tonearm.llm import prefixtrie, substrings, whitening
from tonearm.llm.common import lookup

EMPTY = hashlib.sha256(b"").hexdigest()


@pytest.fixture
def small_batches(spark):
    """Three rows per Arrow batch, so equal things meet across batches."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    yield
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_lookup_spreads_hot_and_null_keys(spark):
    """Six tenths of the rows have one key (which the right side lacks), one tenth none: no task gets them."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        n = F.col("id") % 10
        left = spark.range(40_000).select(
            F.when(n < 3, F.lit(7)).when(n < 6, F.lit(9)).when(n == 6, None).otherwise(F.col("id")).alias("k"), "id")
        right = spark.range(0, 40_000, 3).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        out = lookup(left, right, "k", ["v"])
        sizes = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert sum(sizes) == 40_000 and max(sizes) < 2 * 40_000 / 8
        want = left.join(right, "k", "left").select("id", "v")
        assert sorted(map(str, out.select("id", "v").collect())) == sorted(map(str, want.collect()))
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


# ---------------------------------------------------------------- prefix trie
TURNS = "conv_id long, turn long, role string, text string"


def plain_trie(rows):
    convs = {}
    for c, turn, role, text in rows:
        role, text = role or "", text or ""
        convs.setdefault(c, []).append((turn is not None, turn or 0, role, hashlib.sha256(text.encode()).hexdigest(), text))
    convs = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in convs.items()}
    built = {}
    for c, ts in convs.items():
        h = zlib.crc32(str(c).encode()) % 6 if c is not None else 0
        base = convs.get(c - int(np.fmod(c, 100)), []) if c is not None else []
        built[c] = tuple(base[:h] + ts[h:])
    nodes = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(ts[:d], []).append(c)
    low = lambda p: min((c for c in nodes[p] if c is not None), default=None)
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[:len(p)] == p]
        kids = [q for q in below if len(q) == len(p) + 1]
        leaves = [q for q in below if not any(len(r) == len(q) + 1 and r[:len(q)] == q for r in below)]
        ends = sorted(c for c in members if built[c] == p and c is not None)
        out.append((low(p), len(p), low(p[:-1]) if p else None, len(members), len(kids), len(leaves),
                    sum((len(nodes[q]) - 1) * len(q[-1][1]) for q in below if q),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def trie_of(df):
    return sorted((tuple(r) for r in prefixtrie.prefix_trie(prefixtrie.rebuilt(df)).collect()), key=str)


@pytest.mark.parametrize("seed,shards", [(1, 8), (2, 30), (3, 1)])
def test_trie_equals_the_plain_one(spark, small_batches, seed, shards):
    """Random conversations over few turns, so that paths are shared, across few and many shards."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-40, 400), 70):
        start = ["hi"] if rng.random() < 0.5 else []  # a hot first turn
        for t, text in enumerate(start + [rng.choice(["a", "bb", "ccc", "é🙂"]) for _ in range(rng.randrange(5))]):
            rows.append((c, t, rng.choice(["user", "user", "assistant"]) if t else "user", text))
    keep = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(shards))
    try:
        assert trie_of(spark.createDataFrame(rows, TURNS)) == plain_trie(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", keep)


def test_trie_of_odd_rows(spark):
    """Null ids, turns, roles and texts, tied turns, repeated rows, clashing columns, a long conversation."""
    rows = [(None, 0, "user", "x"), (None, 1, None, None), (5, None, "user", "x"), (5, 0, "b", "t"), (5, 0, "a", "t"),
            (5, 0, "a", "s"), (6, 0, "user", "x"), (6, 0, "user", "x"), (7, 3, None, ""), (0, 0, "user", "x" * 70_000),
            (0, 1, "", "y"), (900, 0, "q", "z")] + [(11, i, "user", f"t{i % 3}") for i in range(700)]
    df = clashing(spark.createDataFrame(rows, TURNS))
    assert trie_of(df) == plain_trie(rows)
    assert trie_of(df.limit(0)) == []


def test_trie_without_turns_is_the_root(spark):
    """Conversation 130 loses its only turn to an absent head and is a member of the root alone."""
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 3)
    rows = [(c, 0, "user", "gone")]
    assert trie_of(spark.createDataFrame(rows, TURNS)) == plain_trie(rows)
    assert plain_trie(rows)[0][:5] == (c, 0, None, 1, 0)


def test_parentheses_find_their_close():
    rng = np.random.default_rng(5)
    for _ in range(100):
        depth = [0]
        for _ in range(rng.integers(0, 80)):
            depth.append(int(rng.integers(1, depth[-1] + 2)))
        shape = prefixtrie.Parentheses(np.array(depth))
        size = (shape.find_close() - shape.open + 1) // 2
        for i, d in enumerate(depth):
            end = next((j for j in range(i + 1, len(depth)) if depth[j] <= d), len(depth))
            assert size[i] == end - i


# ---------------------------------------------------------------- whitening
VECTORS = "vec_id long, embedding array<float>, label int"


def plain_whitening(rows, counts=False):
    x = {i: [int(np.floor(np.float64(np.float32(c)) * 256)) for c in v] for i, v in rows}
    fit = list(x.values()) if counts else [list(t) for t in {tuple(v) for v in x.values()}]
    n, m = len(fit), np.array(fit, float)
    sums = [sum(v[k] for v in fit) for k in range(len(fit[0]))]
    values, axes = np.linalg.eigh(np.cov(m.T, bias=True))
    values, axes = values[::-1], axes.T[::-1]
    return {i: (n, sum((n * a - s) ** 2 for a, s in zip(v, sums)),
                (np.array(v) - np.array(sums) / n) @ axes[:4].T / np.sqrt(values[:4]), values[:4] / values.sum())
            for i, v in x.items()}


@pytest.mark.parametrize("weights", ["one", "count"])
def test_whitening_equals_numpy(spark, small_batches, monkeypatch, weights):
    """Copies weigh one or their count; partial sums are added up in several rounds."""
    monkeypatch.setattr(whitening, "FAN_IN", 3)
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 6)) * [5, 3, 2, 1, 0.5, 0.2] + 10
    rows = [(i, base[i % 40 if i < 60 else 7].tolist(), 0) for i in range(160)]  # vector 7 is hot
    df = clashing(spark.createDataFrame(rows, VECTORS).repartition(12))
    got = whitening.whitened_components(df, weights=weights).collect()
    want = plain_whitening([(i, v) for i, v, _ in rows], weights == "count")
    assert len(got) == 160 * 4 and {r.component for r in got} == {1, 2, 3, 4}
    z = {(r.vec_id, r.component): r for r in got}
    for k in range(4):
        sign = np.sign(z[0, k + 1].whitened * want[0][2][k])
        for i in range(160):
            r, (n, far, w, share) = z[i, k + 1], want[i]
            assert (r.n, r.deviation) == (n, far)
            assert r.whitened == pytest.approx(sign * w[k], abs=1e-9) and r.explained == pytest.approx(share[k])
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (2, None, 1), (3, [1.0, None], 1), (4, [nan, 1.0], 0),
            (5, [inf, 1.0], 0), (None, [3.0, -2.0], None), (6, [], 0), (7, [4.0], 0), (8, [0.0, 0.001], 0)]
    df = clashing(spark.createDataFrame(rows, VECTORS))
    got = whitening.whitened_components(df).collect()
    assert sorted((r.vec_id or -1, r.component, r.n) for r in got) == [
        (-1, 1, 3), (-1, 2, 3), (1, 1, 3), (1, 1, 3), (1, 2, 3), (1, 2, 3), (7, 1, 1), (8, 1, 3), (8, 2, 3)]
    alone = next(r for r in got if r.vec_id == 7)  # the only vector of its size has no extent
    assert (alone.deviation, alone.whitened, alone.explained) == (0, 0.0, 0.0)
    assert whitening.whitened_components(df.limit(0)).collect() == []


def test_whitening_of_huge_entries(spark):
    """Entries beyond a long's range saturate; deviations beyond a long are null there, exact as decimals below 38 digits."""
    rows = [(1, [1e30, 1.0], 0), (2, [-1e30, 1.0], 0), (3, [1e15, 2.0], 0), (4, [0.0, -3.0], 0)]
    df = spark.createDataFrame(rows, VECTORS)
    got = {r.vec_id: r for r in whitening.whiten(df).collect()}
    assert got[1].x == [2 ** 63 - 1, 256] and got[2].x == [-2 ** 63, 256]
    xs = [got[i].x for i in (1, 2, 3, 4)]
    sums = [sum(x[k] for x in xs) for k in (0, 1)]
    for i in (3, 4):
        assert int(got[i].deviation or 0) in (0, sum((4 * a - s) ** 2 for a, s in zip(got[i].x, sums)))
    assert all(r.deviation is None for r in whitening.whitened_components(df).collect() if r.vec_id in (1, 2))


# ---------------------------------------------------------------- substring dedup
DOCS = "doc_id long, text string"


def plain_substrings(rows, length):
    docs = [(i, t, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    docs.sort(key=lambda d: d[0])
    seen, out = set(), []
    for i, _, words in docs:
        gone = [False] * len(words)
        for s in range(len(words) - length + 1):
            w = tuple(words[s:s + length])
            if w in seen:
                gone[s:s + length] = [True] * length
            seen.add(w)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def removed(df, **options):
    return sorted(tuple(r) for r in substrings.repeat_digests(df, **options).collect())


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_substrings_equal_the_plain_version(spark, small_batches, seed):
    """Passages shared within and across documents, few words, periodic and constant texts."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") * rng.randrange(1, 3)
    passages = [[word() for _ in range(rng.choice([19, 20, 21, 30, 60]))] for _ in range(6)]
    rows = []
    for i in range(40):
        words = []
        for _ in range(rng.randrange(6)):
            p = rng.choice(passages)
            a = rng.randrange(3)
            words += [word() for _ in range(rng.randrange(4))] + p[a:len(p) - rng.randrange(3)]
        if i % 7 == 0:
            words += ["ab"] * rng.randrange(15, 70) + ["x", "y", "z"] * rng.randrange(12)
        rows.append((i * 3, rng.choice([" ", "\n\t "]).join(words)))
    rows += [(1000 + i, rows[i][1]) for i in range(8)]  # copies
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    assert removed(df) == plain_substrings(rows, 20)


def test_substrings_of_other_lengths(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(60))) for i in range(12)]
    got = substrings.remove_repeats(spark.createDataFrame(rows, DOCS), length=6, gram=3, digest=True).collect()
    want = plain_substrings(rows, 6)
    assert sorted((r.doc_id, r.n_words, sum(s.end - s.start for s in r.repeats), r.kept) for r in got) == want


def test_substrings_of_odd_rows(spark, odd_docs, no_docs):
    """Equal rows count as one document that is first; the others lose every word if they have a window."""
    got = removed(odd_docs.filter("doc_id IS NOT NULL"))
    text = {r.doc_id: r.text for r in odd_docs.collect()}
    assert [r[0] for r in got] == [1, 1, 2, 3, 4, 5, 6, 7, 8, 9]
    assert all(r[2] == 0 for r in got if r[0] != 5)  # all others are under 20 words
    assert [r for r in got if r[0] == 5] == plain_substrings([(5, text[5])], 20)
    assert removed(no_docs) == []
    long = " ".join(f"w{i}" for i in range(25))
    rows = [(1, long)] * 300 + [(None, long), (None, "a " + long), (1, "b " + long)]
    got = substrings.remove_repeats(clashing(spark.createDataFrame(rows, DOCS))).collect()
    assert sorted(len(r.kept.split()) for r in got if r.doc_id == 1) in ([0] * 299 + [1, 25], [0] * 300 + [26])
    assert sorted(r.kept for r in got if r.doc_id is None) == ["", "a"]


def test_substring_spans_and_kept_text(spark):
    a, b = [f"a{i}" for i in range(30)], [f"b{i}" for i in range(10)]
    rows = [(1, " ".join(b + a)), (2, " ".join(a + b + a))]
    got = {r.doc_id: r for r in substrings.remove_repeats(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[1].repeats == [] and got[1].kept == rows[0][1]
    # the second copy repeats, and so does "b... a..." of document 1: everything but nothing in between
    assert [(s.start, s.end) for s in got[2].repeats] == [(0, 70)] and got[2].kept == ""


def test_equal_windows_have_equal_anchors():
    """The seed of a window depends on its own words only, and every window has one."""
    rng = np.random.default_rng(8)
    words = rng.integers(0, 4, 400).astype(np.uint64)
    text, anchor, _, first, n = substrings.seeds([words[:250], words[250:]], 20, 8)
    owner = {(t, w): (a, f) for t, a, f, m in zip(text, anchor, first, n) for w in range(f, f + m)}
    assert len(owner) == 231 + 131
    by_words = {}
    for (t, w), (a, _) in owner.items():
        by_words.setdefault(tuple([words[:250], words[250:]][t][w:w + 20]), set()).add(a)
    assert all(len(v) == 1 for v in by_words.values())
