"""Embedding near-duplicates by an inverted multi-index.

Unit vectors are cut in halves and each half has its own codebook, so a vector lies in
a cell of the product grid.  A query visits cells by multi-sequence traversal, nearest
first, until their distance exceeds the nearest cell's by ``reach``; the reach is set
on a sample so that the target share of links falls within it.  Every visited
candidate is verified by cosine in double precision.

Equal vectors are one node with a count.  A pair is found if either node visits the
other's cell.  It counts once, so link counts add up: from the node with the smaller
number, or from the other one if the smaller does not visit its cell; blocks of a cell return counts and a
spanning forest of their links, never the links themselves.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonearm.llm.common import lookup, ship
from tonearm.llm.components import connected_components, spanning_forest
from tonearm.session import materialize

#: The codebooks and the reach are fitted on about so many vectors, picked by hash.
SAMPLE = 20_000
#: Sampled vectors whose links are looked for by brute force to set the reach, or to measure the recall.
JUDGED = 2_000
ROWS_PER_CELL, MAX_CODES, ROUNDS = 64, 1024, 8
#: Vectors per block of a cell; bounds the rows and the memory of one comparison.
BLOCK = 2048
TARGET_RECALL = 0.995


def unit_rows(rows: list) -> np.ndarray:
    x = np.array(rows, np.float64)
    x /= np.abs(x).max(1, keepdims=True)  # first, as squares could overflow
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1), 0)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        near = _distances(x, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=k)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


@dataclass(frozen=True)
class Codebooks:
    """Codes of the first and second half, by dimension; a dimension without codes is one cell."""

    books: dict[int, tuple[np.ndarray, np.ndarray]]
    reach: float

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.books.get(x.shape[1], (np.zeros((1, x.shape[1] // 2)), np.zeros((1, x.shape[1] - x.shape[1] // 2))))
        return _distances(x[:, : a.shape[1]], a), _distances(x[:, a.shape[1]:], b)

    def reaches(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether each vector of ``x`` visits the cell of the vector of ``y`` in the same row."""
        (d1, d2), (e1, e2), at = self.halves(x), self.halves(y), np.arange(len(x))
        best = d1.min(1) + d2.min(1)
        return d1[at, e1.argmin(1)] + d2[at, e2.argmin(1)] <= best + self.reach

    def visits(self, first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, int]]:
        """Multi-sequence traversal of one vector's cells, nearest first, within the reach."""
        i_of, j_of = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
        p, q = first.tolist(), second.tolist()
        best = p[i_of[0]] + q[j_of[0]]
        heap, seen = [(best, 0, 0)], {(0, 0)}
        while heap:
            d, i, j = heapq.heappop(heap)
            if d > best + self.reach:
                return
            yield i_of[i], j_of[j]
            for a, b in ((i + 1, j), (i, j + 1)):
                if a < len(i_of) and b < len(j_of) and (a, b) not in seen:
                    seen.add((a, b))
                    heapq.heappush(heap, (p[i_of[a]] + q[j_of[b]], a, b))


def _neighbours(x: np.ndarray, part: slice, threshold: float, rng: np.random.Generator) -> np.ndarray:
    """A unit vector for each of ``x`` at cosine ``threshold``, or as near to it as a difference
    within the dimensions ``part`` allows, in a random direction."""
    y = x.copy()
    own = x[:, part]
    if not own.shape[1]:
        return y
    size = np.maximum((own * own).sum(1, keepdims=True), 1e-300)
    away = rng.standard_normal(own.shape)
    away -= (away * own).sum(1, keepdims=True) / size * own
    away /= np.maximum(np.sqrt((away * away).sum(1, keepdims=True)), 1e-300)
    # Turning the part by an angle keeps its length: 1 - size * (1 - cos angle) = threshold.
    cos = np.clip(1 - (1 - threshold) / size, -1, 1)
    y[:, part] = cos * own + np.sqrt((1 - cos * cos) * size) * away
    return y


def fit(vectors: list, labels: list, total: int, threshold: float, recall: float = TARGET_RECALL) -> Codebooks:
    """Codebooks for ``total`` vectors from a sample, and the reach for ``recall``.

    The reach covers the target share of the sample's own links (a vector is no link of
    itself) and, as these may be few or all very close, the same share of made neighbours
    at exactly the threshold, in each of three shapes: the difference lies anywhere, in
    the first half only, or in the second half only.  A link is within the reach if
    either vector visits the other's cell.
    """
    rng = np.random.default_rng(17)
    k = int(np.clip(np.sqrt(total / ROWS_PER_CELL), 1, MAX_CODES))
    books, reach = {}, 0.0
    for dim in sorted({len(v) for v in vectors}):
        x = unit_rows([v for v in vectors if len(v) == dim])
        lab = np.array([y for v, y in zip(vectors, labels) if len(v) == dim])
        half = dim // 2
        books[dim] = tuple(_kmeans(part, min(k, len(part)), rng) for part in (x[:, :half], x[:, half:]))
        index = Codebooks(books, 0.0)
        d1, d2 = index.halves(x)
        c1, c2 = d1.argmin(1), d2.argmin(1)
        best = d1.min(1) + d2.min(1)
        over: list[np.ndarray] = []
        for i in range(min(JUDGED, len(x))):
            near = np.flatnonzero((x @ x[i] >= threshold) & (lab == lab[i]))
            near = near[near != i]
            there = d1[i, c1[near]] + d2[i, c2[near]] - best[i]
            over.append(np.minimum(there, d1[near, c1[i]] + d2[near, c2[i]] - best[near]))
        few = x[: min(JUDGED, len(x))]
        at = np.arange(len(few))
        reach = max(reach, np.quantile(np.concatenate([*over, [0.0]]), recall))
        for part in (slice(None), slice(0, half), slice(half, None)):
            e1, e2 = index.halves(_neighbours(few, part, threshold, rng))
            m1, m2 = e1.argmin(1), e2.argmin(1)
            there = d1[at, m1] + d2[at, m2] - best[at]
            back = e1[at, c1[at]] + e2[at, c2[at]] - e1.min(1) - e2.min(1)
            reach = max(reach, np.quantile(np.minimum(there, back), recall))
    return Codebooks(books, float(reach) + 1e-9)


def _cells(shared):
    """Rows of a node: its own cell (probe false) and every cell it visits (probe true)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Codebooks = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column("embedding").to_pylist()
            labels = batch.column("label").to_pylist()
            take, probe, cells = [], [], []
            for dim in sorted({len(v) for v in vectors}):
                rows = [i for i, v in enumerate(vectors) if len(v) == dim]
                d1, d2 = index.halves(unit_rows([vectors[i] for i in rows]))
                for i, p, q in zip(rows, d1, d2):
                    for n, (a, b) in enumerate(index.visits(p, q)):
                        for kind in ((False, True) if n == 0 else (True,)):
                            take.append(i)
                            probe.append(kind)
                            cells.append(f"{labels[i]}/{dim}/{a}/{b}")
            rows = pa.Table.from_batches([batch.select(["rid", "n", "embedding"])]).take(pa.array(take, pa.int64()))
            out = rows.append_column("probe", pa.array(probe, pa.bool_())).append_column("cell", pa.array(cells))
            yield from out.combine_chunks().to_batches()
    return run


def _verify(threshold: float, shared):
    def side(block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = block.values
        return (rows.field("rid").to_numpy(), rows.field("n").to_numpy(),
                unit_rows(rows.field("embedding").to_pylist()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(batch.column("probes"), batch.column("held")):
                (a, an, x), (b, bn, y) = side(left), side(right)
                i, j = np.nonzero((x @ y.T >= threshold) & (a[:, None] != b))
                once = a[i] < b[j]
                late = np.flatnonzero(~once)
                for at in range(0, len(late), BLOCK):
                    part = late[at:at + BLOCK]
                    once[part] = ~shared.value.reaches(y[j[part]], x[i[part]])
                i, j = i[once], j[once]
                if not len(i):
                    continue
                ids, back = np.unique(np.concatenate([a[i], b[j]]), return_inverse=True)
                n = np.bincount(back, weights=np.concatenate([bn[j], an[i]]).astype(np.float64)).astype(np.int64)
                u, v = spanning_forest(a[i], b[j])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([ids, u])),
                     pa.concat_arrays([pa.nulls(len(ids), pa.int64()), pa.array(v)]),
                     pa.concat_arrays([pa.array(n), pa.nulls(len(u), pa.int64())])], names=["u", "v", "n"])
    return run


def _good() -> Column:
    """Whether a row can link at all."""
    emb = F.col("embedding")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    return (F.col("label").isNotNull() & emb.isNotNull() & (F.size(emb) > 0) & F.forall(emb, finite)
            & F.exists(emb, lambda v: v != 0))


def near_duplicates(embeddings: DataFrame, threshold: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, embedding, label).

    Vectors link when their labels are equal and not null and their cosine is at least
    ``threshold``; vectors that are null, empty, zero or hold null or non-finite values
    link with nothing, nor do vectors of different dimension.  n_links counts rows, so
    repeated rows link with each other; component_id is the smallest vec_id reachable
    (a null vec_id is never the smallest; it is null if all are); an empty table gives
    no rows; extra columns are not read.
    """
    spark = embeddings.sparkSession
    ship(spark)
    emb = F.col("embedding")
    kind = embeddings.schema["embedding"].dataType.elementType
    good = _good()
    key = F.concat(F.hex(F.xxhash64("label", emb)), F.lit("."), F.hex(F.xxhash64(emb, F.lit("b"), "label")))
    rows = embeddings.select(F.col("vec_id").cast("long"), F.when(good, key).alias("k"), "label", "embedding")
    light = materialize(rows.select("vec_id", "k"), "imi-rows")
    nodes = rows.filter(F.col("k").isNotNull()).groupBy("k").agg(
        F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"),
        F.first("embedding").alias("embedding"))
    nodes = materialize(nodes.withColumn("rid", F.monotonically_increasing_id()), "imi-nodes")
    total = nodes.count()

    unit = F.shiftrightunsigned(F.xxhash64("k"), 11).cast("double") * 2.0 ** -53
    sample = (nodes.filter(unit < min(1.0, SAMPLE / max(total, 1))).select("embedding", "label")
              .limit(2 * SAMPLE).collect())
    index = fit([r["embedding"] for r in sample], [r["label"] for r in sample], total, threshold)
    shared = spark.sparkContext.broadcast(index)
    schema = T.StructType([T.StructField("rid", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("embedding", T.ArrayType(kind)), T.StructField("probe", T.BooleanType()),
                           T.StructField("cell", T.StringType())])
    placed = materialize(nodes.mapInArrow(_cells(shared), schema), "imi-cells")

    # Cells of more than a block are cut into blocks; the others are one block each.
    held = (~F.col("probe")).cast("int")
    big = (placed.groupBy("cell").agg(F.sum(held).alias("h"), F.sum(1 - held).alias("p"))
           .filter((F.col("h") > BLOCK) | (F.col("p") > BLOCK))
           .select("cell", F.ceil(F.col("h") / BLOCK).cast("int").alias("h"), F.ceil(F.col("p") / BLOCK).cast("int").alias("p")))
    cut = lookup(placed, big, "cell", ["h", "p"])
    cut = cut.withColumn("h", F.greatest(F.coalesce("h", F.lit(1)), F.lit(1)))
    cut = cut.withColumn("p", F.greatest(F.coalesce("p", F.lit(1)), F.lit(1)))
    spread = F.xxhash64("rid")
    vectors = F.collect_list(F.struct("rid", "n", "embedding"))
    held_blocks = (cut.filter(~F.col("probe")).withColumn("block", F.pmod(spread, F.col("h").cast("long")))
                   .groupBy("cell", "block").agg(vectors.alias("held")))
    probe_blocks = (cut.filter("probe").withColumn("part", F.pmod(spread, F.col("p").cast("long")))
                    .groupBy("cell", "part", "h").agg(vectors.alias("probes"))
                    .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("h").cast("long") - 1))))
    pairs = probe_blocks.join(held_blocks, ["cell", "block"]).select("probes", "held")
    found = materialize(pairs.mapInArrow(_verify(threshold, shared), "u long, v long, n long"), "imi-links")

    counts = found.filter("v IS NULL").groupBy(F.col("u").alias("rid")).agg(F.sum("n").alias("others"))
    classes = connected_components(found.filter("v IS NOT NULL").select("u", "v")).withColumnRenamed("node", "rid")
    known = (nodes.select("rid", "k", "low", "n").join(counts, "rid", "left").join(classes, "rid", "left")
             .select("k", "low", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                     F.coalesce("component", "rid").alias("component")))
    known = materialize(known, "imi-known")
    least = known.groupBy("component").agg(F.min("low").alias("component_id"))
    known = lookup(known, least, "component", ["component_id"])
    known = materialize(known.select("k", "n_links", "component_id"), "imi-classes")
    out = lookup(light, known, "k", ["n_links", "component_id"])
    component = F.when(F.col("k").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def _judge(shared, threshold: float):
    """Links of the judged vectors among a task's rows: (id of the judged vector, rows linked)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judged = shared.value  # (label, dimension) -> keys, unit vectors
        counts: dict[str, int] = {}
        for batch in batches:
            groups: dict[tuple, list] = {}
            for v, label in zip(batch.column("embedding").to_pylist(), batch.column("label").to_pylist()):
                if (label, len(v)) in judged:
                    groups.setdefault((label, len(v)), []).append(v)
            for group, vectors in groups.items():
                keys, x = judged[group]
                for at in range(0, len(vectors), BLOCK):
                    hits = (x @ unit_rows(vectors[at:at + BLOCK]).T >= threshold).sum(1)
                    for k in np.flatnonzero(hits):
                        counts[keys[k]] = counts.get(keys[k], 0) + int(hits[k])
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                         names=["k", "n"])
    return run


def measured_recall(embeddings: DataFrame, found: DataFrame, threshold: float = 0.93, judged: int = JUDGED) -> DataFrame:
    """One row (judged, links, found, recall): links of about ``judged`` vectors against all rows.

    ``found`` is what :func:`near_duplicates` returned for ``embeddings``, whose vec_ids must
    be unique.  The judged vectors, picked by hash, are a bounded broadcast; every row is
    compared with those of its label.  Without links the recall is null.
    """
    ship(embeddings.sparkSession)
    rows = embeddings.filter(_good()).select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    total = rows.count()
    unit = F.shiftrightunsigned(F.xxhash64(F.lit("judge"), "vec_id"), 11).cast("double") * 2.0 ** -53
    picked = rows.filter(unit < min(1.0, judged / max(total, 1))).limit(2 * judged).collect()
    groups: dict[tuple, list] = {}
    for r in picked:
        groups.setdefault((r["label"], len(r["embedding"])), []).append(r)
    shared = embeddings.sparkSession.sparkContext.broadcast(
        {g: ([str(r["vec_id"]) for r in rs], unit_rows([r["embedding"] for r in rs])) for g, rs in groups.items()})
    exact = (rows.select("label", "embedding").mapInArrow(_judge(shared, threshold), "k string, n long")
             .groupBy(F.col("k").cast("long").alias("vec_id")).agg((F.sum("n") - 1).alias("links")))
    both = exact.join(found.select("vec_id", "n_links"), "vec_id")
    out = both.agg(F.count(F.lit(1)).alias("judged"), F.coalesce(F.sum("links"), F.lit(0)).alias("links"),
                   F.coalesce(F.sum("n_links"), F.lit(0)).alias("found"))
    return out.withColumn("recall", F.try_divide("found", "links"))
