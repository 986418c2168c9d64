"""M5's approximate option: cosine neighbours from random-projection buckets, with measured recall.

Unit vectors get, in each of TABLES tables, a bucket: the signs of their products with
random directions.  A query visits its own bucket and then those that differ in its
least certain signs.  How many buckets it visits is found on a sample of the run's own
queries, whose exact neighbours are known: the number doubles until the sample's recall
reaches the target.  Buckets are cut into blocks and pairs of blocks are scored like
those of the exact join, so no pair list is emitted and a crowded bucket is many units of
work.

A query is copied to every bucket it visits, with its vector.  Where the target needs
buckets that hold about as many products as all pairs do (vectors without structure),
those copies only cost: every query is then scored exactly, in the blocks of the exact
join, whose memory does not grow with the visits.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonearm.functions.names import query_key
from tonearm.operators import score
from tonearm.session import materialize

TABLES, MAX_BITS = 4, 16
#: Items that a bucket holds on average, and buckets of a table: the copies of a query are bounded by them.
BUCKET_ROWS, MAX_BUCKETS = 512, 64
#: Share of all products above which the visited buckets do not pay.
MAX_SHARE = 0.8
#: Queries whose exact neighbours set the number of visited buckets, at most about so many, picked by hash.
JUDGED = 500
TARGET_RECALL = 0.95
#: Copies of a crowded bucket's items that its query blocks are dealt over.
COPIES = 8
SEED = 11


def _planes(dim: int, bits: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((TABLES, bits, dim))


def _buckets(bits: int, visits: int) -> Callable:
    """Rows (key, features) with a row per visited bucket: column ``cell``."""
    # Self-contained (numpy / pyarrow only): Python workers need not import this package.
    tables, planes_of = TABLES, _planes
    planes: dict[int, np.ndarray] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("features")
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            take, cells = [], []
            for t in range(tables):
                margin = x @ planes[x.shape[1]][t].T
                own = (margin > 0) @ (1 << np.arange(bits))
                # The cheapest sets of signs to flip, among the least certain ones.
                loose = min(bits, max(visits - 1, 1).bit_length() + 2)
                by = np.argsort(np.abs(margin), axis=1)[:, :loose]
                sets = (np.arange(1 << loose)[:, None] >> np.arange(loose)) & 1
                cost = np.take_along_axis(np.abs(margin), by, 1) @ sets.T
                near = np.argsort(cost, axis=1, kind="stable")[:, :visits]
                flips = (1 << by) @ sets.T
                visited = own[:, None] ^ np.take_along_axis(flips, near, 1)
                take.append(np.repeat(np.arange(len(x)), visited.shape[1]))
                cells.append((t << bits) + visited.ravel())
            rows = pa.array(np.concatenate(take))
            yield pa.RecordBatch.from_arrays([*[c.take(rows) for c in batch.columns], pa.array(np.concatenate(cells))],
                                             names=[*batch.schema.names, "cell"])

    def with_planes(dims: list[int]) -> Callable:
        planes.update({d: planes_of(d, bits) for d in dims})
        return run
    return with_planes


def _placed(rows: DataFrame, bits: int, visits: int, dims: list[int]) -> DataFrame:
    schema = T.StructType([*rows.schema.fields, T.StructField("cell", T.LongType())])
    return rows.mapInArrow(_buckets(bits, visits)(dims), schema)


def _parts(rows: DataFrame, size: int, name: str) -> DataFrame:
    """(cell, parts): the blocks of about ``size`` rows that each bucket is cut into (at most TABLES x 2^MAX_BITS rows)."""
    return rows.groupBy("cell").agg(F.ceil(F.count("*") / size).cast("int").alias(name))


def _neighbours(queries: DataFrame, items: DataFrame, key_type: T.DataType, bits: int, visits: int, k: int,
                dims: list[int]) -> DataFrame:
    """(_q, similar_artist, score, rank) among the items that share a visited bucket."""
    held = materialize(_placed(items, bits, 1, dims), "similar-buckets")
    asked = materialize(_placed(queries, bits, visits, dims), "similar-visits")
    sizes = materialize(_parts(held, score.ITEM_BLOCK, "n_items").join(_parts(asked, score.QUERY_BLOCK, "n_queries"), "cell"),
                        "similar-sizes")
    slot = lambda n: F.pmod(F.xxhash64("key"), F.col(n).cast("long")).cast("int")
    copies = F.least("n_queries", F.lit(COPIES))
    item_blocks = (held.join(F.broadcast(sizes), "cell").groupBy("cell", slot("n_items").alias("item_block"), copies.alias("copies"))
                   .agg(F.collect_list(F.struct("key", "h", "features")).alias("items"))
                   .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies"))
    # No score has been found yet, and every block of a visited bucket is scored.
    asked = (asked.withColumn("k", F.lit(k).cast("long")).withColumn("seen", F.array("h"))
             .withColumn("last", F.lit(score.EVERY_BLOCK)).withColumn("beat", F.lit(float("-inf"))))
    query_blocks = (asked.join(F.broadcast(sizes), "cell")
                    .groupBy("cell", "n_items", copies.alias("copies"), slot("n_queries").alias("query_block"))
                    .agg(F.collect_list(F.struct(*score.QUERY_FIELDS)).alias("queries"))
                    .withColumn("item_block", F.explode(F.sequence(F.lit(0), F.col("n_items") - 1)))
                    .withColumn("copy", F.pmod("query_block", "copies")))
    pairs = query_blocks.join(item_blocks, ["cell", "item_block", "copy"]).select("queries", "item_block", "items")
    schema = T.StructType([T.StructField("_q", key_type), T.StructField("similar_artist", key_type),
                           T.StructField("score", T.DoubleType())])
    found = pairs.mapInArrow(score._pair_kernel(score._best("_q", "similar_artist")), schema)
    # A pair may be found in several tables.
    found = found.groupBy("_q", "similar_artist").agg(F.max("score").alias("score"))
    return score.rank_within(found, ["_q"], k, key_col="similar_artist")


def _products(queries: DataFrame, sizes: DataFrame, bits: int, visits: int, dims: list[int]) -> int:
    """The query-item products that the visited buckets hold."""
    work = _placed(queries.select("key", "features"), bits, visits, dims).groupBy("cell").agg(F.count("*").alias("m"))
    return work.join(sizes, "cell").agg(F.sum(F.col("n") * F.col("m"))).first()[0] or 0


def similar_items_approx(queries: DataFrame, item_factors: DataFrame, k: int = 10, item_col: str = "artist_name",
                         query_col: str = "query", clean: bool = False,
                         target: float = TARGET_RECALL) -> tuple[DataFrame, DataFrame]:
    """Approximate :func:`score.similar_items`, and how good it is.

    Returns the same rows (query, item, similar_artist, similarity, rank; similarities
    are exact, some neighbours may be missing) and one row (n_items, n_judged, k, bits,
    visits, recall, share): recall of these rows over the judged queries' exact neighbours,
    and the share of all query-item products that was computed (1: every query was scored
    exactly, as the buckets would have held about as much).
    """
    spark = item_factors.sparkSession
    unit = score.unit_items(item_factors.where(F.col("features").isNotNull()), item_col)
    key_type = item_factors.schema[item_col].dataType
    n_items = unit.count()
    dims = [r[0] for r in unit.select(F.size("features")).distinct().collect()]  # the factor numbers: one
    rows = max(BUCKET_ROWS, n_items / MAX_BUCKETS)
    bits = int(np.clip(round(math.log2(max(n_items, 1) / rows + 1)), 1, MAX_BITS))
    items = unit.select(F.col(item_col).alias("key"), F.xxhash64(item_col).alias("h"), "features")
    asked = queries.select(F.col(query_col), query_key(query_col, clean).alias("_q")).distinct()
    wanted = materialize(items.join(asked.select(F.col("_q").alias("key")).distinct(), "key", "left_semi"), "similar-queries")
    n_queries = wanted.count()
    unit_of = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "key"), 11).cast("double") * 2.0 ** -53
    judged = materialize(wanted.where(unit_of < min(1.0, JUDGED / max(n_queries, 1))), "similar-judged")
    n_judged = judged.count()
    def exactly(rows: DataFrame) -> DataFrame:
        return score.top_items(
            rows.select(F.col("key").alias("_q"), "features", F.lit(k).alias("_k")),
            items.select(F.col("key").alias("similar_artist"), "features"), "_q", "similar_artist", "_k",
            seen=rows.select(F.col("key").alias("_q"), F.col("key").alias("similar_artist")), prune=False)

    exact = materialize(exactly(judged), "similar-exact")
    truth = exact.count()
    hits = lambda got: got.join(exact, ["_q", "similar_artist"], "left_semi").count() / truth if truth else 1.0
    sizes = materialize(_placed(items, bits, 1, dims).groupBy("cell").agg(F.count("*").alias("n")), "similar-cells")
    visits, pays = 1, True
    while n_judged:
        pays = _products(judged, sizes, bits, visits, dims) < MAX_SHARE * n_judged * n_items
        if not pays or visits >= 1 << bits or hits(_neighbours(judged, items, key_type, bits, visits, k, dims)) >= target:
            break
        visits *= 2
    if pays:
        found = _neighbours(wanted, items, key_type, bits, visits, k, dims)
        products = _products(wanted, sizes, bits, visits, dims)
    else:
        found, products = exactly(wanted), n_items * n_queries
    found = materialize(found, "similar-found")
    recall = hits(found) if n_judged else 0.0
    report = spark.createDataFrame(
        [(n_items, n_judged, k, bits, visits, recall, products / (n_items * n_queries) if n_items and n_queries else None)],
        "n_items long, n_judged long, k int, bits int, visits int, recall double, share double")
    rows = asked.join(found, "_q").select(query_col, F.col("_q").alias(item_col), "similar_artist",
                                          F.col("score").alias("similarity"), "rank")
    return rows, report
