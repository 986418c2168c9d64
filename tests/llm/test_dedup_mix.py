"""SimHash, components and mixing against plain versions."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from llm_tables import SF
from tonearm.llm import components, mix, simhash
from tonearm.llm.common import positions, table


def plain_fingerprint(text, k=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(max(len(words) - k + 1, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def union_find(nodes, edges):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def plain_components(fps):
    vals = np.array(sorted(set(fps)), np.uint64)
    near = np.argwhere(np.bitwise_count(vals[:, None] ^ vals) <= 3)
    return union_find(range(len(vals)), [(a, b) for a, b in near if a < b]), {int(v): i for i, v in enumerate(vals)}


def test_simhash_equals_brute_force(spark):
    docs = table(spark, SF, "documents")
    got = {r.doc_id: r for r in simhash.simhash_components(docs).collect()}
    rows = docs.select("doc_id", "text").collect()
    fp = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    comp, at = plain_components(fp.values())
    low = defaultdict(lambda: 1 << 62)
    for d, f in fp.items():
        low[comp[at[f]]] = min(low[comp[at[f]]], d)
    assert len(got) == len(rows)
    for d, f in fp.items():
        assert got[d].fingerprint == f"{f:016x}" and got[d].component_id == low[comp[at[f]]]


def test_simhash_odd_rows(spark, odd_docs, no_docs):
    out = simhash.simhash_components(odd_docs).collect()
    assert len(out) == odd_docs.count()
    by = defaultdict(list)
    for r in out:
        by[r.doc_id].append(r)
    # null, empty and blank texts have fingerprint zero and one class
    assert {r.fingerprint for d in (2, 3, 4) for r in by[d]} == {"0" * 16} and by[4][0].component_id == 2
    assert by[8][0].component_id == 1 and len(by[1]) == 2
    assert simhash.simhash_components(no_docs).count() == 0
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == ["1", "2", "5", "6", "7", "9", "None"]
    assert simhash.keep_one(no_docs).count() == 0


def test_every_link_within_three_bits_is_found(spark):
    """Random fingerprints with planted neighbours at 0 to 5 bits, compared with all pairs."""
    rng = random.Random(4)
    vals = {rng.getrandbits(64) for _ in range(400)}
    for v in sorted(vals)[:200]:
        for bits in range(1, 6):
            w = v
            for b in rng.sample(range(64), bits):
                w ^= 1 << b
            vals.add(w)
    vals = np.array(sorted(vals), np.uint64)
    df = spark.createDataFrame([(int(v),) for v in vals.view(np.int64)], "fp long")
    found = [(np.int64(r.u).view(np.uint64), np.int64(r.v).view(np.uint64)) for r in simhash.links(df, 3).collect()]
    assert all(int(a ^ b).bit_count() <= 3 for a, b in found)
    near = np.argwhere(np.bitwise_count(vals[:, None] ^ vals) <= 3)
    assert {(int(vals[a]), int(vals[b])) for a, b in near if a < b} == {
        (int(min(a, b)), int(max(a, b))) for a, b in found}


def test_a_hot_cell_is_dealt_over_many_squares(spark, monkeypatch):
    """600 fingerprints of one cell and 200 of its neighbours: bounded squares, all links, each pair of tiles once."""
    monkeypatch.setattr(simhash, "TILE", 8)
    monkeypatch.setattr(simhash, "GROUP", 4)
    monkeypatch.setattr(simhash, "SLOT", 16)
    rng = random.Random(9)
    word = lambda ones: sum(1 << b for b in rng.sample(range(16), ones))
    vals = {sum(word(1) << 16 * i for i in range(4)) for _ in range(600)}
    vals |= {sum(word(1 + (i == k)) << 16 * i for i in range(4)) for k in range(4) for _ in range(50)}
    vals = np.array(sorted(vals), np.uint64)
    df = spark.createDataFrame([(int(v),) for v in vals.view(np.int64)], "fp long")
    pairs = simhash.tile_pairs(df, 3).cache()
    squares = pairs.groupBy("p0", "p1", "p2", "p3", "group", "slot").agg(
        F.countDistinct("a").alias("a"), F.countDistinct("b").alias("b")).collect()
    hot = [r for r in squares if (r.p0, r.p1, r.p2, r.p3) == (1, 1, 1, 1)]
    assert len(hot) > 30 and max(r.b for r in squares) <= 8 and max(r.a for r in squares) <= 3 * 16
    assert pairs.count() == pairs.select("a", "b").distinct().count()
    found = {(min(r.u, r.v), max(r.u, r.v)) for r in simhash.links(df, 3).collect()}
    near = np.argwhere(np.bitwise_count(vals[:, None] ^ vals) <= 3)
    signed = vals.view(np.int64)
    assert found == {tuple(sorted((int(signed[a]), int(signed[b])))) for a, b in near if a < b}


def test_dense_group_keeps_a_spanning_forest(spark, monkeypatch):
    base = 0x0123456789ABCDEF
    vals = [base] + [base ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(i)]  # all within 4, linked by base
    df = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in vals], "fp long")
    comp = components.connected_components(simhash.links(df, 2))
    assert comp.count() == len(vals) and comp.select("component").distinct().count() == 1


def test_spanning_forest_keeps_components():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 300, 400), rng.integers(0, 300, 400)
    u, v = components.spanning_forest(a, b)
    nodes = set(a.tolist()) | set(b.tolist())
    assert len(u) < len(nodes)
    assert union_find(nodes, zip(a.tolist(), b.tolist())) == union_find(nodes, zip(u.tolist(), v.tolist()))


@pytest.mark.parametrize("shape", ["path", "star", "random", "odd"])
def test_components(spark, shape):
    rng = random.Random(2)
    edges = {"path": [(i, i + 1) for i in range(300)], "star": [(0, i) for i in range(1, 1500)],
             "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(300)],
             "odd": [(1, 1), (None, 2), (3, None), (4, 5), (5, 4), (4, 5)]}[shape]
    got = components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    want = union_find({x for e in real for x in e}, real)
    groups = lambda m: sorted(sorted(k for k in m if m[k] == c) for c in set(m.values()))
    assert groups({r.node: r.component for r in got}) == groups(want) and len(got) == len(want)


def test_components_of_nothing(spark):
    assert components.connected_components(spark.createDataFrame([], "u string, v string")).collect() == []


def test_positions(spark):
    df = spark.createDataFrame([(i * 7 % 101,) for i in range(101)], "x long")
    assert [r.x for r in positions(df, [F.col("x").desc()], "t").orderBy("pos").collect()] == list(range(100, -1, -1))


def plain_targets(sizes, weights=(1, 2, 3)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    out, left = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in out]
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return out | share
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]


@pytest.mark.parametrize("case", ["table", "small", "odd"])
def test_mix_counts(spark, odd_docs, case):
    if case == "table":
        docs = table(spark, SF, "documents")
    elif case == "small":  # one source with most rows, tiny ones that fill up at three epochs
        rows = [(i, "w " * (1 + i % 9), "en", ["a", "b", "c", "hot"][min(i % 40, 3)], 0) for i in range(600)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    else:
        docs = odd_docs
    got = mix.mix_counts(docs).collect()
    src = Counter()
    sizes = Counter()
    for r in docs.select("source", mix.word_count(F.col("text")).alias("n")).collect():
        sizes[r.source] += r.n
        src[r.source] += 1
    want = plain_targets(dict(sizes))
    assert len(got) == docs.count() and all(r.taken <= 3 * r["size"] for r in got)
    taken = Counter()
    per = defaultdict(set)
    for r in got:
        taken[round(r.target, 6), r.source_size] += r.taken
        per[r.source_size].add(round(r.target, 6))
    assert sorted(round(t, 6) for t in set(want.values())) == sorted({t for s in per.values() for t in s})
    full = Counter()
    for s, t in want.items():
        full[round(t, 6), sizes[s]] += round(t)
    for key, n in full.items():
        assert abs(taken[key] - n) <= 1 * sum(1 for s, t in want.items() if (round(t, 6), sizes[s]) == key)
    assert sorted(map(str, got)) == sorted(map(str, mix.mix_counts(docs).collect()))


def test_mixed_documents_hold_the_taken_words(spark, odd_docs, no_docs):
    docs = table(spark, SF, "documents")
    out = mix.mixed_documents(docs)
    assert out.columns == docs.columns
    taken = {r.doc_id: r.taken for r in mix.mix_counts(docs).collect() if r.taken}
    got = Counter()
    for r in out.select("doc_id", mix.word_count(F.col("text")).alias("n")).collect():
        got[r.doc_id] += r.n
    assert got == taken
    assert mix.mixed_documents(odd_docs).columns == odd_docs.columns and mix.mixed_documents(no_docs).count() == 0
    assert mix.mix_counts(no_docs).count() == 0


def test_mix_of_wordless_sources(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, " ", "b")], "doc_id long, text string, source string")
    assert [(r["size"], r.target, r.taken) for r in mix.mix_counts(docs).collect()] == [(0, 0.0, 0)] * 2


def test_equal_documents_have_keys_of_their_own(spark, monkeypatch):
    """A third of all rows equal, another lot without id and text: no hot key, whole counts, reruns agree."""
    monkeypatch.setattr(mix, "COPIES", 50)
    rows = [(i, f"a{i} b c", "web") for i in range(2000)] + [(7, "same old words", "web")] * 1500 + [(None, None, None)] * 500
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    keyed = df.select(F.struct("doc_id", "text").alias("row"), mix.word_count(F.col("text")).alias("size"), "source",
                      F.xxhash64("doc_id", "text").alias("h"))
    assert mix._keys_of_copies(keyed).groupBy("h").count().agg(F.max("count")).first()[0] == 1
    assert mix._keys_of_copies(keyed).groupBy("row").count().where("row.doc_id = 7 AND row.text LIKE 'same%'").first()["count"] == 1500
    got = sorted(map(str, mix.mix_counts(df).collect()))
    assert len(got) == 4000 and got == sorted(map(str, mix.mix_counts(df.repartition(3)).collect()))
    assert sum(r.taken for r in mix.mix_counts(df).collect()) == 3 * 3500
    assert mix.mixed_documents(df).where("source = 'web'").count() >= 3500
