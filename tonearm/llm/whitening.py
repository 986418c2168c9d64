"""Embedding whitening from a weighted multiplicity covariance.

Equal vectors are grouped, so each distinct vector is multiplied and whitened once; the
fit weighs it by its count or by one.  Tasks return partial sums (exact integers) and
partial centred products (numpy GEMM in double precision), which are added up in rounds
of FAN_IN, so no task and not the driver ever holds more than FAN_IN of them, however
many partitions there are.  Only the dimension-by-dimension matrix reaches the driver,
for its eigenvectors.  The whitened distinct vectors are joined back to the rows on the
vector itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonearm.llm.common import lookup, ship
from tonearm.session import materialize

#: Entries are cut to whole multiples of 1 / SCALE.
SCALE = 256
COMPONENTS = 4
#: Partial sums that one task adds up.
FAN_IN = 32
#: Numbers of a batch that are multiplied at once.
STRIP = 1 << 20
#: Sums of vectors and squares stay in 64-bit integers below this bound, else Python's integers are used.
SAFE = 1 << 62


def _by_size(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(size, row numbers, vectors as a matrix, weights) per vector size, in strips."""
    lists = batch.column(column)
    flat, start = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    start = start - start[0]
    sizes, weights = np.diff(start), batch.column("w").to_numpy()
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        step = max(1, STRIP // max(size, 1))
        for at in range(0, len(rows), step):
            part = rows[at:at + step]
            yield size, part, flat[start[part][:, None] + np.arange(size)], weights[part]


def _exact_sums(column: str) -> Callable:
    """Partial weights and weighted integer sums per vector size, as decimal strings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list[int]] = {}
        for batch in batches:
            for size, _, x, w in _by_size(batch, column):
                most = int(np.abs(x.astype(np.float64)).max(initial=0)) + 1
                wide = x.astype(object) if most * int(w.sum()) >= SAFE else x
                sums = (wide * w[:, None]).sum(0) if size else np.zeros(0, np.int64)
                new = [int(w.sum()), *map(int, sums)]
                total[size] = [a + b for a, b in zip(total[size], new)] if size in total else new
        yield _rows(list(total), [[str(v) for v in s] for s in total.values()], pa.string())
    return run


def _add_exact(size: int, parts: list) -> list:
    return [str(sum(map(int, column))) for column in zip(*parts)]


def _float_sums(column: str) -> Callable:
    """Partial weights and weighted sums per vector size, in double precision."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, _, x, w in _by_size(batch, column):
                total[size] = total.get(size, 0) + np.concatenate([[w.sum()], w @ x])
        yield _rows(list(total), [s.tolist() for s in total.values()], pa.float64())
    return run


def _products(column: str, means) -> Callable:
    """Partial weighted products of the centred vectors, flattened, per vector size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, _, x, w in _by_size(batch, column):
                centred = x.astype(np.float64) - means.value[size]
                total[size] = total.get(size, 0) + (centred * w[:, None]).T @ centred
        yield _rows(list(total), [s.ravel().tolist() for s in total.values()], pa.float64())
    return run


def _add_float(size: int, parts: list) -> list:
    return np.sum([np.asarray(p) for p in parts], axis=0).tolist()


def _rows(sizes: list, sums: list, kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(sizes, pa.int32()), pa.array(sums, pa.list_(kind))],
                                      names=["size", "sums"])


def _added(rows: DataFrame, partial: Callable, add: Callable, kind: str, name: str) -> dict[int, list]:
    """The partial results of ``rows`` added up per vector size, in rounds of FAN_IN rows a task."""
    schema = f"size int, sums array<{kind}>"
    parts = materialize(rows.mapInArrow(partial, schema).filter(F.size("sums") > 0), name)
    while (most := parts.groupBy("size").count().agg(F.max("count")).first()[0] or 0) > FAN_IN:
        def merge(key: tuple, group: pa.Table) -> pa.Table:
            size = key[0].as_py()
            total = add(size, group.column("sums").to_pylist())
            return pa.table({"size": pa.array([size], pa.int32()),
                             "sums": pa.array([total], group.schema.field("sums").type)})
        slot = F.pmod(F.monotonically_increasing_id().bitwiseXOR(F.shiftright(F.monotonically_increasing_id(), 33)),
                      F.lit(-(-most // FAN_IN)).cast("long"))
        parts = materialize(parts.withColumn("slot", slot).groupBy("size", "slot").applyInArrow(merge, schema), name)
    out: dict[int, list] = {}
    for r in parts.collect():  # at most FAN_IN rows per vector size
        out.setdefault(r["size"], []).append(list(r["sums"]))
    return {size: add(size, group) for size, group in out.items()}


@dataclass(frozen=True)
class Whitener:
    """What whitens the vectors of one size."""

    n: int
    sums: list[int]
    axes: np.ndarray = field(repr=False)      # a row per component, unit length
    scale: np.ndarray = field(repr=False)     # square roots of the eigenvalues; 0 for a component without extent
    explained: np.ndarray = field(repr=False)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        mean = np.array([s / self.n for s in self.sums])
        z = (x.astype(np.float64) - mean) @ self.axes.T
        return np.divide(z, self.scale, out=np.zeros_like(z), where=self.scale > 0)

    def deviations(self, x: np.ndarray) -> list[int]:
        most = (int(np.abs(x.astype(np.float64)).max(initial=0)) + 1) * self.n + max(map(abs, self.sums), default=0)
        whole = x if most * most * max(len(self.sums), 1) < SAFE else x.astype(object)
        far = self.n * whole - np.array(self.sums, dtype=whole.dtype)
        return [int(v) for v in (far * far).sum(1)] if len(self.sums) else [0] * len(x)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Whitener]:
    """A whitener per vector size from distinct integer vectors (x array<long>, w long)."""
    spark = vectors.sparkSession
    exact = _added(vectors, _exact_sums("x"), _add_exact, "string", "whitening-sums")
    counts = {size: [int(v) for v in sums] for size, sums in exact.items()}
    means = {size: np.array([s / v[0] for s in v[1:]]) for size, v in counts.items()}
    shared = spark.sparkContext.broadcast(means)  # one vector per size
    products = _added(vectors, _products("x", shared), _add_float, "double", "whitening-products")
    out = {}
    for size, (n, *sums) in counts.items():
        v = np.array(products.get(size, [])).reshape(size, size) / n
        values, axes = np.linalg.eigh((v + v.T) / 2)
        values, axes = values[::-1][:components], axes.T[::-1][:components]
        trace = float(np.trace(v))
        # Rounding leaves tiny eigenvalues where the vectors have no extent.
        values = np.where(values > size * np.finfo(float).eps * max(trace, 0.0), values, 0.0)
        lead = np.abs(axes).argmax(1) if size else np.zeros(0, int)
        axes = axes * np.where(axes[np.arange(len(axes)), lead] < 0, -1.0, 1.0)[:, None] if size else axes
        out[size] = Whitener(n, sums, axes, np.sqrt(values), values / trace if trace > 0 else np.zeros(len(values)))
    return out


def _whiten(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z: list = [None] * batch.num_rows
            far: list = [None] * batch.num_rows
            n: list = [None] * batch.num_rows
            for size, rows, x, _ in _by_size(batch, "x"):
                model: Whitener = shared.value[size]
                for i, row, d in zip(rows.tolist(), model.whiten(x).tolist(), model.deviations(x)):
                    z[i], far[i], n[i] = row, str(d), model.n
            yield pa.RecordBatch.from_arrays(
                [batch.column("x"), batch.column("w"), batch.column("n"), pa.array(n, pa.int64()),
                 pa.array(far, pa.string()), pa.array(z, pa.list_(pa.float64()))],
                names=["x", "w", "n", "fit_n", "deviation", "z"])
    return run


def identity_error(whitened: DataFrame, models: dict[int, Whitener]) -> float:
    """Largest absolute entry of the whitened vectors' own covariance minus the identity.

    Measured on (z, w); components without extent are left out; 0.0 where none has any.
    """
    spark = whitened.sparkSession
    worst = 0.0
    for dim, model in models.items():
        own, size = whitened.filter(F.size("x") == dim).select("z", "w"), len(model.scale)
        live = np.flatnonzero(model.scale > 0)
        if not len(live):
            continue
        n, *sums = _added(own, _float_sums("z"), _add_float, "double", "whitening-check-sums")[size]
        means = spark.sparkContext.broadcast({size: np.array(sums) / n})
        cov = np.array(_added(own, _products("z", means), _add_float, "double", "whitening-check")[size])
        cov = cov.reshape(size, size)[np.ix_(live, live)] / n
        worst = max(worst, float(np.abs(cov - np.eye(len(live))).max()))
    return worst


def whiten(embeddings: DataFrame, components: int = COMPONENTS, weights: str = "one",
           scale: int = SCALE) -> DataFrame:
    """(vec_id, x, n, deviation, whitened, explained, identity_error) per usable row.

    x = floor(scale * entry) as long (saturated at the ends of its range); ``weights``
    is "one" (each distinct vector once) or "count" (as often as it occurs); n is the
    sum of weights and S the weighted sum.  deviation (decimal(38,0); null beyond 38
    digits) is the sum over dimensions of (n x - S)^2; whitened and explained are arrays
    by component, at most ``components`` and the dimension; components without extent
    (one distinct vector, constant dimensions) are 0.0 in both.

    Rows whose vector is null or holds null or non-finite entries are dropped; vectors
    of different size are fitted apart; an empty vector has no component; repeated rows
    and null vec_ids are rows of their own; an empty table gives no rows; extra columns
    are not read.
    """
    if weights not in ("one", "count"):
        raise ValueError(f"weights is 'one' or 'count', not {weights!r}")
    spark = embeddings.sparkSession
    ship(spark)
    emb = F.col("embedding")
    good = emb.isNotNull() & F.forall(emb, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    cut = F.transform(emb, lambda v: F.floor(v.cast("double") * F.lit(float(scale))).cast("long"))
    rows = embeddings.filter(good).select("vec_id", cut.alias("x"))
    distinct = rows.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    distinct = materialize(distinct.withColumn("w", F.lit(1).cast("long") if weights == "one" else F.col("n")),
                           "whitening-vectors")
    models = fit(distinct.select("x", "w"), components)
    shared = spark.sparkContext.broadcast(models)  # a matrix of components x size per vector size
    schema = T.StructType([T.StructField("x", T.ArrayType(T.LongType())), T.StructField("w", T.LongType()),
                           T.StructField("n", T.LongType()), T.StructField("fit_n", T.LongType()),
                           T.StructField("deviation", T.StringType()), T.StructField("z", T.ArrayType(T.DoubleType()))])
    done = materialize(distinct.mapInArrow(_whiten(shared), schema), "whitening-done")
    error = identity_error(done, models)
    out = lookup(rows, done, "x", ["fit_n", "deviation", "z"], seen=done, counted=True)
    shares = F.lit(None).cast("array<double>")
    for size, m in models.items():  # one array of at most ``components`` numbers per vector size
        value = F.array(*[F.lit(float(e)) for e in m.explained]) if len(m.explained) else F.array().cast("array<double>")
        shares = F.when(F.size("x") == size, value).otherwise(shares)
    return out.select("vec_id", "x", F.col("fit_n").alias("n"), F.expr("try_cast(deviation AS decimal(38,0))").alias("deviation"),
                      F.col("z").alias("whitened"), shares.alias("explained"), F.lit(error).alias("identity_error"))


def whitened_components(embeddings: DataFrame, components: int = COMPONENTS, weights: str = "one") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row per component.

    deviation is a long, null where it does not fit one.
    """
    rows = whiten(embeddings, components, weights)
    rows = rows.select("vec_id", "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"), "explained",
                       "identity_error", F.posexplode("whitened").alias("c", "whitened"))
    return rows.select("vec_id", (F.col("c") + 1).alias("component"), "n", "deviation", "whitened",
                       F.element_at("explained", F.col("c") + 1).alias("explained"), "identity_error")
