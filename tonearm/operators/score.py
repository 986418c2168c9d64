"""Top-k scoring against an item-factor catalog: J4-J6, W4, T2, M3, M5, M7, M8.

Scoring every query against every item is a block join: items and queries are cut
into blocks of bounded size, the blocks of each side are put in groups, and the pairs of
groups are the cells of a grid, so the work spreads however few item blocks there are and
a block is sent once per group of the other side, not once per block.  A pair of blocks is
one numpy matrix product in which seen items are masked and only the best k items per
query (or its sums) leave; the item blocks of a cell meet a query block one after the
other, and a later one gives only what reaches the k-th score of those before it.  The
partial lists are merged by a window with a literal limit, so each task keeps its local
top k before the shuffle.  Nothing is collected to
the driver, and no query x item pair that is not a local result is ever emitted.

Where items are many, their blocks go by falling vector length.  The first block gives
every query a score to beat; a block whose longest vector cannot reach it
(Cauchy-Schwarz) is skipped for that query, which loses no result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonearm.functions import vectors
from tonearm.functions.names import query_key, short_user_id
from tonearm.operators.ids import dense_index, random_user, sample_users
from tonearm.session import materialize

# Rows per block: one block pair is a QUERY_BLOCK x ITEM_BLOCK product (32 MB of scores).
QUERY_BLOCK, ITEM_BLOCK = 1024, 4096
# Cells of the grid per core, so that cells of one core even out.
CELLS_PER_SLOT = 3
# Rows of a side that a cell holds at most: a cell stays bounded however large the sides are.
CELL_ROWS = 1 << 17
# Written query keys are broadcast to their seen rows up to so many.
MAX_BROADCAST_QUERIES = 500_000
# Scores are compared with a bound that allows for rounding.
SLACK = 1e-9
# A query that no block may be skipped for.
EVERY_BLOCK = (1 << 31) - 1


def _pair_kernel(answer: Callable) -> Callable:
    """Scores of one block of queries against one block of items, seen items marked, handed to ``answer``."""
    # Self-contained (numpy / pyarrow only): Python workers need not import this package.
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def matrix(rows: pa.StructArray) -> np.ndarray:
            flat = rows.field("features").flatten().to_numpy(zero_copy_only=False)
            return flat.reshape(len(rows), -1).astype(np.float64, copy=False)

        held, best = None, {}  # the query block of the last pair, and what the answers keep of its pairs
        for batch in batches:
            named = "query_block" in batch.schema.names
            for q, it, block, own in zip(batch.column("queries"), batch.column("items"), batch.column("item_block").to_pylist(),
                                         batch.column("query_block").to_pylist() if named else [None] * batch.num_rows):
                q, it = q.values, it.values
                if own is None or own != held:
                    held, best = own, {}
                asks = q.field("last").to_numpy() >= block  # the others skip this block
                q = q.filter(pa.array(asks))
                if not len(q):
                    continue
                names = it.field("key")
                order = np.argsort(np.array(names.to_pylist(), dtype=object), kind="stable")  # ties go by key
                names, hashes = names.take(pa.array(order)), it.field("h").to_numpy()[order]
                s = matrix(q) @ matrix(it)[order].T
                seen = q.field("seen")
                row = np.repeat(np.arange(len(q)), np.diff(seen.offsets.to_numpy()))
                by_hash = np.argsort(hashes, kind="stable")
                gone = seen.flatten().to_numpy()
                at = np.minimum(np.searchsorted(hashes, gone, sorter=by_hash), len(hashes) - 1)
                hit = hashes[by_hash[at]] == gone
                out = answer(q, names, s, row[hit], by_hash[at[hit]], asks, best)
                if out is not None:
                    yield out
    return run


def _best(query_col: str, item_col: str) -> Callable:
    """The k best unseen items of each query of a pair of blocks."""
    def answer(q: pa.StructArray, names: pa.Array, s: np.ndarray, row: np.ndarray, item: np.ndarray, asks: np.ndarray, best: dict):
        s[row, item] = -np.inf
        k = q.field("k").to_numpy()
        most = min(int(k.max()), s.shape[1])
        if most <= 0:
            return None
        # As good as the k-th score already found, here or before, or the k-th of this block.
        floor = np.maximum(q.field("beat").to_numpy(), best.get("floor", np.full(len(asks), -np.inf))[asks])
        many = np.count_nonzero(s >= floor[:, None], axis=1) > most
        if many.any():
            floor[many] = np.maximum(floor[many], np.partition(s[many], s.shape[1] - most, axis=1)[:, s.shape[1] - most])
        i, j = np.nonzero((s >= floor[:, None]) & np.isfinite(s))
        order = np.lexsort((j, -s[i, j], i))
        i, j = i[order], j[order]
        place = np.arange(len(i)) - np.searchsorted(i, np.arange(len(q)))[i]
        keep = place < k[i]
        i, j, place = i[keep], j[keep], place[keep]
        if not len(i):
            return None
        # The k best scores of each query in the item blocks so far: the next one has to reach the last of them.
        wide = int(k.max())
        top = best.setdefault("top", np.full((len(asks), wide), -np.inf))
        if top.shape[1] < wide:
            top = best["top"] = np.hstack([top, np.full((len(top), wide - top.shape[1]), -np.inf)])
        new = np.full((len(q), top.shape[1]), -np.inf)
        new[i, place] = s[i, j]
        top[asks] = merged = -np.sort(-np.hstack([top[asks], new]), axis=1)[:, :top.shape[1]]
        floors = best.setdefault("floor", np.full(len(asks), -np.inf))
        floors[asks] = np.where(k > 0, merged[np.arange(len(q)), np.maximum(k, 1) - 1], -np.inf)
        return pa.RecordBatch.from_arrays(
            [q.field("key").take(pa.array(i)), names.take(pa.array(j)), pa.array(s[i, j])],
            names=[query_col, item_col, "score"])
    return answer


def _sums(query_col: str) -> Callable:
    """Count, sum, largest and smallest score of the unseen items of each query of a pair of blocks."""
    def answer(q: pa.StructArray, names: pa.Array, s: np.ndarray, row: np.ndarray, item: np.ndarray, asks: np.ndarray, best: dict):
        open_ = np.ones(s.shape, bool)
        open_[row, item] = False
        n = open_.sum(1)
        out = pa.RecordBatch.from_arrays(
            [q.field("key"), pa.array(n), pa.array(np.where(open_, s, 0.0).sum(1)),
             pa.array(np.where(open_, s, -np.inf).max(1)), pa.array(np.where(open_, s, np.inf).min(1))],
            names=[query_col, "n_items", "score_sum", "best_score", "worst_score"])
        return out.filter(pa.array(n > 0))
    return answer


def _slots(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def grid(n_query_blocks: int, n_item_blocks: int, n_cells: int) -> tuple[int, int]:
    """(query groups, item groups): at least ``n_cells`` cells where the blocks allow it, of at most CELL_ROWS rows of a
    side, that send as few rows as such a grid can.

    A query block is sent to each item group and an item block to each query group, so with Q query rows and I item
    rows that is Q x item groups + I x query groups.
    """
    least_q = math.ceil(n_query_blocks * QUERY_BLOCK / max(QUERY_BLOCK, CELL_ROWS))
    least_i = math.ceil(n_item_blocks * ITEM_BLOCK / max(ITEM_BLOCK, CELL_ROWS))
    even = math.sqrt(n_cells * n_item_blocks * ITEM_BLOCK / (n_query_blocks * QUERY_BLOCK))
    g_i = min(n_item_blocks, max(1, least_i, round(even)))
    g_q = min(n_query_blocks, max(1, least_q, math.ceil(n_cells / g_i)))
    g_i = min(n_item_blocks, max(1, least_i, math.ceil(n_cells / g_q)))
    return g_q, g_i


def deal(queries: DataFrame, items: DataFrame, n_query_blocks: int, n_item_blocks: int, first: int = 0) -> DataFrame:
    """Pairs of blocks (query_block, queries, item_block, items), dealt over a grid by the groups of both.

    ``queries`` (query_block, queries, deepest) meets the item blocks ``first`` to
    ``deepest``.  The blocks of a side go to its groups (:func:`grid`) in turn; a query
    block is sent once to each item group that it meets and an item block once to each
    query group, and their pairs are made in the task of the cell.  The number of
    partitions is given, so adaptive coalescing, which looks at bytes and not at work,
    leaves them alone.
    """
    spark = queries.sparkSession
    n_first = max(1, n_item_blocks - first)
    g_q, g_i = grid(n_query_blocks, n_first, CELLS_PER_SLOT * spark.sparkContext.defaultParallelism)
    n = min(4 * g_q * g_i, max(_slots(spark), g_q * g_i))  # cells are dealt by hash: over more partitions they even out
    last = F.least("deepest", F.lit(n_item_blocks - 1))
    q = (queries.where(last >= first)
         .withColumn("item_block_group", F.explode(F.sequence(F.lit(0), F.least(last - first, F.lit(g_i - 1)))))
         .withColumn("query_group", F.pmod(F.xxhash64("query_block"), F.lit(g_q)).cast("int"))
         .repartition(n, "query_group", "item_block_group"))
    it = (items.where(F.col("item_block") >= first)
          .withColumn("item_block_group", F.pmod(F.col("item_block") - first, F.lit(g_i)).cast("int"))
          .withColumn("query_group", F.explode(F.sequence(F.lit(0), F.lit(g_q - 1))))
          .repartition(n, "query_group", "item_block_group"))
    pairs = q.join(it, ["query_group", "item_block_group"]).where(F.col("item_block") <= F.col("deepest"))
    return pairs.select("query_block", "queries", "item_block", "items")


#: What the kernel reads of a query.
QUERY_FIELDS = ("key", "k", "seen", "last", "beat", "features")


def _query_blocks(q: DataFrame, block) -> DataFrame:
    """(query_block, queries, deepest): arrays of structs of about QUERY_BLOCK queries each."""
    return (q.groupBy(block.alias("query_block"))
            .agg(F.collect_list(F.struct(*QUERY_FIELDS)).alias("queries"), F.max("last").alias("deepest")))


def _item_blocks(it: DataFrame) -> DataFrame:
    return it.groupBy("item_block").agg(F.collect_list(F.struct("key", "h", "features")).alias("items"))


def _stored(rows: DataFrame, feat: str) -> Column:
    """Vectors as sent: of floats as they are, else as doubles.  Both are doubles before they are multiplied."""
    of_floats = rows.schema[feat].dataType == T.ArrayType(T.FloatType(), rows.schema[feat].dataType.containsNull)
    return F.col(feat) if of_floats else F.col(feat).cast("array<double>")


class _Scoring:
    """Queries and items of one scoring job, with what the blocks need to know."""

    def __init__(self, queries: DataFrame, items: DataFrame, query_key_col: str, item_key_col: str, k_col: str | None,
                 seen: DataFrame | None, feat: str, prune: bool, item_block: int | None = None):
        self.item_block = item_block or ITEM_BLOCK
        k = F.lit(0) if k_col is None else F.col(k_col)
        q = queries.select(F.col(query_key_col).alias("key"), _stored(queries, feat).alias("features"),
                           k.cast("long").alias("k")).where(F.col("features").isNotNull())
        it = items.select(F.col(item_key_col).alias("key"), F.xxhash64(item_key_col).alias("h"),
                          _stored(items, feat).alias("features")).where(F.col("features").isNotNull())
        self.n_queries, self.max_k = q.agg(F.count("*"), F.max("k")).first()
        self.n_items = it.count()
        self.n_query_blocks = max(1, math.ceil(self.n_queries / QUERY_BLOCK))
        self.n_item_blocks = max(1, math.ceil(self.n_items / self.item_block))
        self.prune = prune and self.n_item_blocks > 1 and self.n_queries > 0
        self.q = q
        if self.prune:  # several passes over both: written once
            self.q, it = materialize(q, "score-queries"), materialize(it, "score-items")
            norms = it.select("key", vectors.norm("features").alias("norm"))
            order = dense_index(norms, [F.desc("norm"), F.asc("key")], "pos")
            block = F.floor(F.col("pos") / self.item_block).cast("int")
            it = materialize(it.join(order, "key").withColumn("item_block", block), "score-items-by-norm")
        else:
            it = it.withColumn("item_block", F.pmod(F.xxhash64("key"), F.lit(self.n_item_blocks)).cast("int"))
        self.items = it
        none = F.array().cast("array<bigint>")
        if seen is None:
            self.with_seen = lambda rows: rows.withColumn("seen", none)
        else:
            gone = seen.select(F.col(query_key_col).alias("key"), F.xxhash64(item_key_col).alias("h"))
            if self.prune and self.n_queries <= MAX_BROADCAST_QUERIES:
                gone = gone.join(F.broadcast(self.q.select("key")), "key", "left_semi")
            gone = (gone.groupBy("key").agg(F.collect_set("h").alias("seen")))
            self.with_seen = lambda rows: rows.join(gone, "key", "left").withColumn("seen", F.coalesce("seen", none))

    def blocks(self, rows: DataFrame) -> DataFrame:
        spread = F.pmod(F.xxhash64("key"), F.lit(self.n_query_blocks)).cast("int")
        return _query_blocks(self.with_seen(rows), spread)

    def all_pairs(self) -> DataFrame:
        rows = self.q.withColumn("last", F.lit(EVERY_BLOCK)).withColumn("beat", F.lit(float("-inf")))
        return deal(self.blocks(rows), _item_blocks(self.items), self.n_query_blocks, self.n_item_blocks)

    def first_pairs(self) -> DataFrame:
        """Every query against the block of the longest vectors."""
        rows = self.q.withColumn("last", F.lit(0)).withColumn("beat", F.lit(float("-inf")))
        return deal(self.blocks(rows), _item_blocks(self.items.where("item_block = 0")), self.n_query_blocks, 1)

    def depths(self, found: DataFrame, query_col: str) -> DataFrame:
        """The queries with ``beat``, the k-th score found, and ``last``, the last block whose longest vector may beat it."""
        beat = found.groupBy(F.col(query_col).alias("key")).agg(F.count("*").alias("n"), F.min("score").alias("beat"))
        # One row with a number per block of items.
        longest = (self.items.groupBy("item_block").agg(F.max("norm").alias("norm"))
                   .agg(F.transform(F.sort_array(F.collect_list(F.struct("item_block", "norm"))), lambda b: b["norm"])
                        .alias("norms")))
        rows = self.q.withColumn("size", vectors.norm("features")).join(beat, "key", "left")
        # Each row is held against a number per item block: dealt by work, not by bytes.
        rows = rows.repartition(_slots(self.q.sparkSession)).join(F.broadcast(longest))
        bound = lambda n: n * F.col("size") * (1 + SLACK) + SLACK
        full = F.coalesce(F.col("n") >= F.col("k"), F.lit(False))
        reach = F.size(F.filter("norms", lambda n: bound(n) >= F.col("beat"))) - 1
        last = F.when(F.col("k") <= 0, F.lit(-1)).when(full, reach).otherwise(F.lit(self.n_item_blocks - 1))
        return rows.select("key", "features", "k", last.cast("int").alias("last"),
                           F.when(full, F.col("beat")).otherwise(float("-inf")).alias("beat"))

    def further_pairs(self, depths: DataFrame) -> DataFrame:
        """The queries that need more blocks, in query blocks of like depth, against those blocks."""
        rows = depths.where("last >= 1").withColumn("depth", F.floor(F.log2("last")).cast("int"))
        sizes = {r["depth"]: r["count"] for r in rows.groupBy("depth").count().collect()}  # at most 31 rows
        start, block = 0, F.lit(0)
        for depth, n in sorted(sizes.items()):
            own = max(1, math.ceil(n / QUERY_BLOCK))
            block = F.when(F.col("depth") == depth, start + F.pmod(F.xxhash64("key"), F.lit(own)).cast("int")).otherwise(block)
            start += own
        return deal(_query_blocks(self.with_seen(rows), block), _item_blocks(self.items), max(1, start),
                    self.n_item_blocks, first=1)


def top_items(queries: DataFrame, items: DataFrame, query_key_col: str, item_key_col: str, k_col: str,
              seen: DataFrame | None = None, feat: str = "features", rank_col: str = "rank",
              prune: bool = True, item_block: int | None = None) -> DataFrame:
    """For each query row (unique key, features, k) the k best items by dot product, without ``seen`` pairs.

    Returns (query key, item key, score double, rank).  Scores are computed in double
    precision from the stored vectors; ties go by item key.  ``seen`` (query key, item
    key) is carried along its query as 64-bit hashes of the item keys.  ``prune`` skips
    item blocks (of ``item_block`` items, else ITEM_BLOCK) that cannot hold a result; no
    use where all vectors have one length.
    """
    spark = queries.sparkSession
    job = _Scoring(queries, items, query_key_col, item_key_col, k_col, seen, feat, prune, item_block)
    schema = T.StructType([T.StructField(query_key_col, queries.schema[query_key_col].dataType),
                           T.StructField(item_key_col, items.schema[item_key_col].dataType),
                           T.StructField("score", T.DoubleType())])
    if not job.n_queries or not job.n_items:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(rank_col, T.IntegerType())]))
    kernel = _pair_kernel(_best(query_key_col, item_key_col))
    if job.prune:
        found = materialize(job.first_pairs().mapInArrow(kernel, schema), "score-first")
        depths = materialize(job.depths(found, query_key_col), "score-depths")
        found = found.unionByName(job.further_pairs(depths).mapInArrow(kernel, schema))
    else:
        found = job.all_pairs().mapInArrow(kernel, schema)
    ranked = rank_within(found, [query_key_col], int(job.max_k), key_col=item_key_col, rank_col=rank_col)
    limit = queries.select(query_key_col, F.col(k_col).alias("_limit"))
    return ranked.join(limit, query_key_col).where(F.col(rank_col) <= F.col("_limit")).drop("_limit")


def pruned_work(queries: DataFrame, items: DataFrame, query_key_col: str, item_key_col: str, k_col: str,
                seen: DataFrame | None = None, feat: str = "features", item_block: int | None = None) -> DataFrame:
    """One row: the products :func:`top_items` computes for these queries, and those of all pairs.

    (n_queries, n_items, n_products, n_all_products, share); a catalog of one block is
    computed whole.
    """
    spark = queries.sparkSession
    job = _Scoring(queries, items, query_key_col, item_key_col, k_col, seen, feat, True, item_block)
    every = job.n_queries * job.n_items
    schema = "n_queries long, n_items long, n_products long, n_all_products long, share double"
    done = every
    if job.prune:
        kind = T.StructType([T.StructField(query_key_col, queries.schema[query_key_col].dataType),
                             T.StructField(item_key_col, items.schema[item_key_col].dataType),
                             T.StructField("score", T.DoubleType())])
        found = job.first_pairs().mapInArrow(_pair_kernel(_best(query_key_col, item_key_col)), kind)
        reach = F.least((F.greatest("last", F.lit(0)) + 1).cast("long") * job.item_block, F.lit(job.n_items))
        done = job.depths(found, query_key_col).agg(F.sum(reach)).first()[0]
    return spark.createDataFrame([(job.n_queries, job.n_items, done, every, done / every if every else None)], schema)


def score_sums(queries: DataFrame, items: DataFrame, query_key_col: str, item_key_col: str,
               seen: DataFrame | None = None, feat: str = "features") -> DataFrame:
    """Per query the count, sum, largest and smallest score over its unseen items.

    Summed inside each pair of blocks: one row per query and item block leaves the workers.
    Queries without an unseen item have no row.
    """
    spark = queries.sparkSession
    job = _Scoring(queries, items, query_key_col, item_key_col, None, seen, feat, False)
    schema = T.StructType([T.StructField(query_key_col, queries.schema[query_key_col].dataType),
                           T.StructField("n_items", T.LongType()),
                           *[T.StructField(c, T.DoubleType()) for c in ("score_sum", "best_score", "worst_score")]])
    if not job.n_queries or not job.n_items:
        return spark.createDataFrame([], schema)
    parts = job.all_pairs().mapInArrow(_pair_kernel(_sums(query_key_col)), schema)
    return parts.groupBy(query_key_col).agg(
        F.sum("n_items").alias("n_items"), F.sum("score_sum").alias("score_sum"),
        F.max("best_score").alias("best_score"), F.min("worst_score").alias("worst_score"))


def rank_within(df: DataFrame, part_cols: list[str], k: int, score_col: str = "score",
                key_col: str = "artist_name", rank_col: str = "rank") -> DataFrame:
    """1-based rank by score desc then key; keep rank <= k.

    The literal limit is planned as a WindowGroupLimit: each task keeps its local top k
    before the shuffle.
    """
    w = Window.partitionBy(*part_cols).orderBy(F.desc(score_col), F.asc(key_col))
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= F.lit(int(k)))


def recommend_unseen(users: DataFrame, user_factors: DataFrame, item_factors: DataFrame,
                     train: DataFrame, k=10, user_col: str = "user_id", item_col: str = "artist_name",
                     few_users: bool = True) -> DataFrame:
    """M3 for a table of users: top-k unseen items (J5 -> J4 -> W4).

    ``k`` may be an int or a column of ``users`` (per-request k).  Users without a
    factor vector drop out (P7).  A user's train items travel with the user into the
    block product, where they are masked.  ``few_users`` (the default) first narrows
    train to the requested users; pass False when scoring (nearly) every user, where
    that extra semi join would only add a shuffle.
    """
    kcol = F.col(k) if isinstance(k, str) else F.lit(int(k))
    req = users.select(user_col, kcol.alias("_k")).groupBy(user_col).agg(F.max("_k").alias("_k"))
    seen = train.select(user_col, item_col)
    if few_users:
        seen = seen.join(req.select(user_col), user_col, "left_semi")
    req = req.join(user_factors.select(user_col, "features"), user_col)
    top = top_items(req, item_factors.select(item_col, "features"), user_col, item_col, "_k", seen=seen)
    return top.select(user_col, item_col, "score", "rank")


def unit_items(item_factors: DataFrame, item_col: str = "artist_name") -> DataFrame:
    """The catalog's unit vectors, written once: every reader of them would else normalise them again."""
    return materialize(item_factors.select(item_col, vectors.unit("features").alias("features")), "unit-items")


def similar_items(queries: DataFrame, item_factors: DataFrame, k: int = 10,
                  item_col: str = "artist_name", query_col: str = "query", clean: bool = False) -> DataFrame:
    """M5: cosine top-k neighbours of each query artist, the artist itself excluded.

    ``queries`` has one string column ``query_col``; it is normalised with P9
    (lower + strip; ``clean=True`` uses P2).  Unknown queries drop out here and
    show up in :func:`unmatched_queries`.  Vectors are normalised once; a zero
    vector has cosine 0 with everything.
    """
    unit = unit_items(item_factors, item_col)
    asked = queries.select(F.col(query_col), query_key(query_col, clean).alias("_q")).distinct()
    # The catalog key and the query key are both artist names: rename the item side.
    cat = unit.withColumnRenamed(item_col, "similar_artist")
    names = asked.select(F.col("_q").alias(item_col)).distinct()
    qs = unit.join(names, item_col, "left_semi").select(F.col(item_col).alias("_q"), "features",
                                                         F.lit(int(k)).alias("_k"))
    itself = names.select(F.col(item_col).alias("_q"), F.col(item_col).alias("similar_artist"))
    ranked = top_items(qs, cat, "_q", "similar_artist", "_k", seen=itself, prune=False)
    return asked.join(ranked, "_q").select(query_col, F.col("_q").alias(item_col), "similar_artist",
                                           F.col("score").alias("similarity"), "rank")


def unmatched_queries(queries: DataFrame, item_factors: DataFrame, item_col: str = "artist_name",
                      query_col: str = "query", clean: bool = False) -> DataFrame:
    """P8 batch form: the queries that name no known artist."""
    return (queries.select(query_col, query_key(query_col, clean).alias(item_col))
            .join(item_factors.select(item_col), item_col, "left_anti").select(query_col))


def random_discovery(train: DataFrame, user_factors: DataFrame, item_factors: DataFrame,
                     k: int = 10, seed: int = 42, user_col: str = "user_id") -> DataFrame:
    """M7: recommendations for one seeded-random user (U6) among users with factors."""
    eligible = train.select(user_col).join(user_factors.select(user_col), user_col, "left_semi")
    who = materialize(random_user(eligible, seed, user_col), "random-user")
    return recommend_unseen(who, user_factors, item_factors, train, k, user_col)


def sample_recommendations(train: DataFrame, user_factors: DataFrame, item_factors: DataFrame,
                           n_samples: int = 5, k: int = 10, show: int = 5, seed: int = 42,
                           user_col: str = "user_id") -> DataFrame:
    """M8: U5 sample of users -> M3 -> shortened ids (P11) -> top ``show`` of each list."""
    eligible = train.select(user_col).join(user_factors.select(user_col), user_col, "left_semi")
    who = materialize(sample_users(eligible, n_samples, seed, user_col), "sample-users")  # read once, not by each pass
    recs = recommend_unseen(who, user_factors, item_factors, train, k, user_col)
    return recs.where(F.col("rank") <= show).select(
        short_user_id(user_col).alias("user_short"), user_col, "artist_name", "score", "rank")
