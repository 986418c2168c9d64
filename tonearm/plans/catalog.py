"""Registered queries (one per inventory id) and their DuckDB oracles.

Keys are ``<id>_<slug>``.  Every query reads the driver's tables (or frames
Spark derives from them) in full.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonearm.functions import names
from tonearm.operators import charts, clean, ids, kcore, matrix, metrics, mood, profile, score, similar, sketches, split
from tonearm.plans import fixtures as fx
from tonearm.plans import jobs
from tonearm.plans import oracle as o
from tonearm.session import materialize, scratch_path
from tonearm.sources import moods as moods_src
from tonearm.sources.plays import read_plays_tsv

CFG = fx.CFG
Q: dict = {}
SQL: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _r6(c):
    return F.round(F.col(c), 6).alias(c)


OUT = "user_id, artist_name, artist_mbid, play_count"


# ---------------------------------------------------------------- sources / cleaning
@register("s1_scan_plays_tsv", o.with_("plays") + "SELECT * FROM plays")
def s1(spark: SparkSession, sf: str) -> DataFrame:
    """Write the plays as a headerless TSV to the shared scratch folder, scan it back."""
    path = scratch_path(spark, "plays-tsv")
    (fx.plays(spark, sf).write.mode("overwrite").option("sep", "\t").option("header", "false")
     .option("quote", "\u0000").option("escapeQuotes", "false")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))
    return read_plays_tsv(spark, path, with_order=False)


@register("p1_drop_missing_names", o.with_("p1") + "SELECT * FROM p1")
def p1(spark, sf):
    return clean.drop_missing_names(fx.plays(spark, sf))


@register("a4_dedup_plays", o.with_("dd") + "SELECT * FROM dd")
def a4(spark, sf):
    return clean.dedup_plays(clean.drop_missing_names(fx.plays(spark, sf)))


@register("p2_clean_names", o.with_("cl") + f"SELECT {OUT} FROM cl")
def p2(spark, sf):
    return fx.prepared(spark, sf).select(*OUT.split(", "))


@register("a1_raw_counts", o.with_("plays") + "SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_users, "
          "count(DISTINCT artist_name) AS n_artists FROM plays")
def a1(spark, sf):
    return profile.table_counts(fx.plays(spark, sf))


@register("a2_null_counts", o.with_("plays") + "SELECT " + ", ".join(
    f"CAST(count(*) - count({c}) AS BIGINT) AS null_{c}" for c in OUT.split(", ")) + " FROM plays")
def a2(spark, sf):
    return profile.null_counts(fx.plays(spark, sf))


@register("a3_duplicate_pairs", o.with_("cl") + "SELECT count(*) - count(DISTINCT (user_id, artist_name)) "
          "AS n_duplicates FROM cl")
def a3(spark, sf):
    return profile.duplicate_count(fx.prepared(spark, sf))


@register("p3_implicit_feedback", o.with_("fb") + f"SELECT {OUT}, confidence, preference FROM fb")
def p3(spark, sf):
    return fx.interactions(spark, sf).select(*OUT.split(", "), "confidence", "preference")


@register("a6_confidence_stats", o.with_("fb") + "SELECT min(confidence) AS min_confidence, "
          "max(confidence) AS max_confidence, round(avg(confidence), 6) AS mean_confidence FROM fb")
def a6(spark, sf):
    return profile.confidence_stats(fx.interactions(spark, sf)).select(
        "min_confidence", "max_confidence", _r6("mean_confidence"))


# ---------------------------------------------------------------- k-core / split
@register("k1_kcore_filter", o.with_("core") + f"SELECT {OUT} FROM core")
def k1(spark, sf):
    return fx.core(spark, sf).select(*OUT.split(", "))


@register("j3_kcore_one_round", o.with_("cl", *o.kcore_ctes(rounds=1)) + f"SELECT {OUT} FROM core")
def j3(spark, sf):
    """P6 + J3: one round of having-count filters as left-semi joins."""
    return kcore.kcore_round(fx.prepared(spark, sf), CFG.min_user_interactions,
                             CFG.min_artist_listeners).select(*OUT.split(", "))


@register("a5_rows_per_user", o.with_("core") + "SELECT user_id, count(*) AS n_rows FROM core GROUP BY user_id")
def a5(spark, sf):
    return profile.group_sizes(fx.core(spark, sf), "user_id")


@register("a5_rows_per_artist", o.with_("core") + "SELECT artist_name, count(*) AS n_rows FROM core GROUP BY artist_name")
def a5a(spark, sf):
    return profile.group_sizes(fx.core(spark, sf), "artist_name")


@register("a10_retention", o.with_("core") + """SELECT n_rows, n_users, n_artists, n_rows_after, n_users_after,
  n_artists_after, round(100.0 * n_rows_after / n_rows, 6) AS pct_rows_kept,
  round(100.0 * n_users_after / n_users, 6) AS pct_users_kept,
  round(100.0 * n_artists_after / n_artists, 6) AS pct_artists_kept FROM
  (SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_users, count(DISTINCT artist_name) AS n_artists FROM cl),
  (SELECT count(*) AS n_rows_after, count(DISTINCT user_id) AS n_users_after,
          count(DISTINCT artist_name) AS n_artists_after FROM core)""")
def a10(spark, sf):
    r = profile.retention(fx.prepared_table(spark, sf), fx.core(spark, sf), written=True)
    return r.select(*[c if not c.startswith("pct") else _r6(c) for c in r.columns])


@register("w1_holdout_split", o.with_("fl") + f"SELECT {OUT}, confidence, preference, is_test FROM fl")
def w1(spark, sf):
    return fx.flagged(spark, sf).select(*OUT.split(", "), "confidence", "preference", "is_test")


@register("u1_train_rows", o.with_("split") + f"SELECT {OUT}, confidence, preference FROM train")
def u1(spark, sf):
    return fx.train(spark, sf).select(*OUT.split(", "), "confidence", "preference")


@register("u2_split_union", o.with_("split") + f"SELECT {OUT}, 'train' AS split FROM train UNION ALL "
          f"SELECT {OUT}, 'test' AS split FROM test")
def u2(spark, sf):
    cols = OUT.split(", ")
    return split.split_union(fx.train(spark, sf).select(*cols), fx.test(spark, sf).select(*cols))


@register("a10_split_shares", o.with_("fl") + """SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_users,
  count(DISTINCT artist_name) AS n_artists, count_if(NOT is_test) AS train_rows,
  count_if(is_test) AS test_rows, count(DISTINCT CASE WHEN NOT is_test THEN user_id END) AS train_users,
  count(DISTINCT CASE WHEN is_test THEN user_id END) AS test_users,
  round(100.0 * count_if(NOT is_test) / count(*), 6) AS pct_train,
  round(100.0 * count_if(is_test) / count(*), 6) AS pct_test FROM fl""")
def a10s(spark, sf):
    r = profile.split_shares(fx.flagged(spark, sf))
    return r.select(*[c if not c.startswith("pct") else _r6(c) for c in r.columns])


# ---------------------------------------------------------------- ids / matrix
@register("u3_distinct_users", o.with_("core") + "SELECT DISTINCT user_id FROM core")
def u3(spark, sf):
    return ids.distinct_keys(fx.core(spark, sf), "user_id")


@register("u3_distinct_artists", o.with_("core") + "SELECT DISTINCT artist_name FROM core")
def u3a(spark, sf):
    return ids.distinct_keys(fx.core(spark, sf), "artist_name")


@register("u4_user_index", o.with_("core", *o.dense_ids_sql()) + "SELECT * FROM umap")
def u4u(spark, sf):
    return ids.user_index(fx.core(spark, sf))


@register("u4_artist_index", o.with_("core", *o.dense_ids_sql()) + "SELECT * FROM amap")
def u4a(spark, sf):
    return ids.artist_index(fx.core(spark, sf))


def _maps(spark, sf):
    return (fx._memo(spark, sf, "umap", lambda: ids.user_index(fx.core(spark, sf)).checkpoint()),
            fx._memo(spark, sf, "amap", lambda: ids.artist_index(fx.core(spark, sf)).checkpoint()))


@register("j1_lookup_indices", o.with_("split", *o.dense_ids_sql()) +
          f"SELECT {OUT}, user_idx, artist_idx FROM fl LEFT JOIN umap USING (user_id) LEFT JOIN amap USING (artist_name)")
def j1(spark, sf):
    um, am = _maps(spark, sf)
    return ids.attach_indices(fx.flagged(spark, sf).select(*OUT.split(", ")), um, am)


@register("j2_reverse_lookup", o.with_("split", *o.dense_ids_sql()) +
          "SELECT artist_idx, artist_name FROM (SELECT DISTINCT artist_idx FROM fl JOIN amap USING (artist_name)) "
          "JOIN amap USING (artist_idx)")
def j2(spark, sf):
    um, am = _maps(spark, sf)
    idx = ids.attach_indices(fx.flagged(spark, sf), um, am, "inner").select("artist_idx").distinct()
    return ids.attach_names(idx, am).select("artist_idx", "artist_name")


MATRIX_SQL = ("mat AS (SELECT user_idx, artist_idx, sum(CAST(confidence AS DOUBLE)) AS value "
              "FROM train JOIN umap USING (user_id) JOIN amap USING (artist_name) GROUP BY user_idx, artist_idx)")


def _matrix(spark, sf):
    um, am = _maps(spark, sf)
    return matrix.sparse_matrix(matrix.indexed_interactions(fx.train(spark, sf), um, am))


@register("p4_indexed_interactions", o.with_("split", *o.dense_ids_sql()) +
          f"SELECT {OUT}, confidence, user_idx, artist_idx FROM train JOIN umap USING (user_id) JOIN amap USING (artist_name)")
def p4(spark, sf):
    um, am = _maps(spark, sf)
    return matrix.indexed_interactions(fx.train(spark, sf), um, am).select(
        *OUT.split(", "), "confidence", "user_idx", "artist_idx")


@register("a7_sparse_matrix", o.with_("split", *o.dense_ids_sql(), MATRIX_SQL) + "SELECT * FROM mat")
def a7(spark, sf):
    return _matrix(spark, sf)


@register("a8_matrix_stats", o.with_("split", *o.dense_ids_sql(), MATRIX_SQL) +
          """SELECT nnz, n_users, n_artists, round(1 - nnz / (n_users * n_artists), 6) AS sparsity FROM
          (SELECT count(*) AS nnz FROM mat), (SELECT count(*) AS n_users FROM umap),
          (SELECT count(*) AS n_artists FROM amap)""")
def a8(spark, sf):
    um, am = _maps(spark, sf)
    return matrix.matrix_stats(_matrix(spark, sf), um, am).select("nnz", "n_users", "n_artists", _r6("sparsity"))


@register("a9_active_users", o.with_("split", *o.dense_ids_sql(), MATRIX_SQL) +
          "SELECT count(*) AS n_active_users FROM (SELECT user_idx FROM mat GROUP BY user_idx HAVING sum(value) > 0)")
def a9(spark, sf):
    return matrix.active_users(_matrix(spark, sf))


# ---------------------------------------------------------------- charts
@register("a11_artist_stats", o.with_("split") + "SELECT artist_name, CAST(sum(play_count) AS BIGINT) AS play_count, "
          "count(DISTINCT user_id) AS listener_count FROM train GROUP BY artist_name")
def a11(spark, sf):
    return charts.artist_stats(fx.train(spark, sf))


@register("a11_sketched_listeners", o.with_("fl") + "SELECT artist_name, CAST(sum(play_count) AS BIGINT) AS play_count, "
          "count(DISTINCT user_id) AS listener_count, TRUE AS within_bound FROM fl GROUP BY artist_name")
def a11_sketched(spark, sf):
    """A11 from sketches stored per slice (the two split parts) and merged, each held against the exact count."""
    path, whole = scratch_path(spark, "listener-sketches"), fx.flagged(spark, sf)
    sketches.write_sketches(sketches.listener_sketches(whole, "is_test"), path, "is_test")
    merged = sketches.merged_listeners(sketches.read_sketches(spark, path))
    exact = charts.artist_stats(whole).select("artist_name", "listener_count")
    return merged.join(exact, "artist_name", "full").select(
        "artist_name", "play_count", "listener_count",
        F.coalesce(sketches.within_bound(F.col("listener_estimate"), F.col("listener_count")), F.lit(False)).alias("within_bound"))


@register("a1_sketched_counts", o.with_("fl") + "SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_users, "
          "count(DISTINCT artist_name) AS n_artists, TRUE AS users_within, TRUE AS artists_within FROM fl")
def a1_sketched(spark, sf):
    """A1 from sketches stored per slice and merged, held against the exact counts."""
    path, whole = scratch_path(spark, "table-sketches"), fx.flagged(spark, sf)
    sketches.write_sketches(sketches.table_sketches(whole, "is_test"), path, "is_test")
    merged = sketches.merged_counts(sketches.read_sketches(spark, path)).withColumnRenamed("n_rows", "_merged")
    exact = profile.table_counts(whole)
    return exact.join(merged, F.col("n_rows") == F.col("_merged"), "left").select(
        *exact.columns,
        F.coalesce(sketches.within_bound(F.col("user_estimate"), F.col("n_users")), F.lit(False)).alias("users_within"),
        F.coalesce(sketches.within_bound(F.col("artist_estimate"), F.col("n_artists")), F.lit(False)).alias("artists_within"))


REC_USERS = "ru AS (SELECT DISTINCT user_id FROM train WHERE user_id IN (SELECT user_id FROM uf))"
CHARTS_SQL = o.with_("split", """stats AS (SELECT artist_name, CAST(sum(play_count) AS BIGINT) AS play_count,
   count(DISTINCT user_id) AS listener_count FROM train GROUP BY artist_name)""",
                     o.topk_sql("stats", "1", str(CFG.charts_k), "ch", score="play_count"))


@register("m6_top_charts", CHARTS_SQL + "SELECT rank, artist_name, play_count, listener_count FROM ch")
def m6(spark, sf):
    return charts.top_charts(fx.train(spark, sf), CFG.charts_k)


@register("p12_chart_display", CHARTS_SQL + r"""SELECT rank,
    CASE rank WHEN 1 THEN '🏆' WHEN 2 THEN '🥈' WHEN 3 THEN '🥉' ELSE CAST(rank AS VARCHAR) END AS badge,
    array_to_string(list_transform(regexp_extract_all(lower(artist_name), '\p{L}+|[^\p{L}]'),
                                   lambda x: concat(upper(x[1]), x[2:])), '') AS artist,
    format('{:,}', play_count) AS plays, format('{:,}', listener_count) AS listeners FROM ch""")
def p12(spark, sf):
    return charts.chart_display(charts.top_charts(fx.train(spark, sf), CFG.charts_k))


@register("p12_recommendation_display", o.with_("factors", REC_USERS, o.unseen_scores_sql("ru"),
                                                o.topk_sql("scored", "user_id", str(CFG.top_k), "recs")) +
          r"""SELECT user_id, concat('#', rank) AS place,
    array_to_string(list_transform(regexp_extract_all(lower(artist_name), '\p{L}+|[^\p{L}]'),
                                   lambda x: concat(upper(x[1]), x[2:])), '') AS artist,
    format('Score: {:.2f}', round(score, 6)) AS shown_score,
    format('Similarity: {:.1f}%', round(score, 6) * 100) AS shown_similarity FROM recs""")
def p12r(spark, sf):
    """Rank, title-cased name, score with two decimals and as a percentage with one."""
    recs = Q["m3_user_recs"](spark, sf)
    return recs.select("user_id", F.concat(F.lit("#"), F.col("rank").cast("string")).alias("place"),
                       names.title_name("artist_name").alias("artist"),
                       F.concat(F.lit("Score: "), names.score2("score")).alias("shown_score"),
                       F.concat(F.lit("Similarity: "), names.percent1("score"), F.lit("%")).alias("shown_similarity"))


# ---------------------------------------------------------------- sampling
@register("u5_sample_users", o.with_("split") + "SELECT user_id FROM (SELECT DISTINCT user_id FROM train) "
          "ORDER BY md5(concat(user_id, ':42')), user_id LIMIT 5")
def u5(spark, sf):
    return ids.sample_users(fx.train(spark, sf), 5, CFG.seed)


@register("u6_random_user", o.with_("split") + "SELECT arg_min(user_id, md5(concat(user_id, ':42')) || user_id) "
          "AS user_id FROM train")
def u6(spark, sf):
    return ids.random_user(fx.train(spark, sf), CFG.seed)


# ---------------------------------------------------------------- scoring on given factors


@register("m3_user_recs", o.with_("factors", REC_USERS, o.unseen_scores_sql("ru"),
                                  o.topk_sql("scored", "user_id", str(CFG.top_k), "recs")) +
          "SELECT user_id, artist_name, round(score, 6) AS score, rank FROM recs")
def m3(spark, sf):
    users = fx.train(spark, sf).select("user_id").distinct()
    r = score.recommend_unseen(users, fx.user_factors(spark, sf), fx.item_factors(spark, sf),
                               fx.train(spark, sf), CFG.top_k, few_users=False)
    return r.select("user_id", "artist_name", _r6("score"), "rank")


@register("j4_unseen_candidates", o.with_("factors", REC_USERS, o.unseen_scores_sql("ru")) +
          "SELECT count(*) AS n_pairs, round(sum(score), 3) AS score_sum FROM scored")
def j4(spark, sf):
    """J4 in isolation: exactly the unseen (user, item) pairs are scored.

    Summed inside the block products, so no pair list leaves the workers.
    """
    tr = fx.train(spark, sf)
    users = tr.select("user_id").distinct().join(fx.user_factors(spark, sf), "user_id")
    r = score.score_sums(users, fx.item_factors(spark, sf), "user_id", "artist_name", seen=tr)
    return r.agg(F.coalesce(F.sum("n_items"), F.lit(0)).alias("n_pairs"),
                 F.round(F.sum("score_sum"), 3).alias("score_sum"))


PRUNE_BLOCK = 64  # items per block in the pruning key: the test catalogs are smaller than a production block


@register("m3_pruned_work", o.with_("factors", REC_USERS, o.unseen_scores_sql("ru"), f"""
  sized AS (SELECT artist_name, sqrt(list_dot_product(features, features)) AS nrm FROM itf),
  placed AS (SELECT *, (row_number() OVER (ORDER BY nrm DESC, artist_name) - 1) // {PRUNE_BLOCK} AS b FROM sized),
  longest AS (SELECT b, max(nrm) AS nrm FROM placed GROUP BY b),
  firsts AS (SELECT user_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC) AS r
             FROM scored JOIN placed USING (artist_name) WHERE b = 0),
  beat AS (SELECT user_id, min(score) AS beat, count(*) AS n FROM firsts WHERE r <= {CFG.top_k} GROUP BY user_id),
  reach AS (SELECT user_id, count(*) FILTER (coalesce(n, 0) < {CFG.top_k}
              OR l.nrm * sqrt(list_dot_product(u.features, u.features)) * (1 + 1e-9) + 1e-9 >= beat) AS blocks
            FROM ru JOIN uf u USING (user_id) LEFT JOIN beat USING (user_id) CROSS JOIN longest l GROUP BY user_id)
  """) + f"""SELECT count(*) AS n_queries, (SELECT count(*) FROM itf) AS n_items,
  CAST(sum(least(greatest(blocks, 1) * {PRUNE_BLOCK}, (SELECT count(*) FROM itf))) AS BIGINT) AS n_products,
  count(*) * (SELECT count(*) FROM itf) AS n_all_products FROM reach""")
def m3p(spark, sf):
    """M3's block pruning: products computed for every user's top k against those of all pairs."""
    tr = fx.train(spark, sf)
    users = tr.select("user_id").distinct().join(fx.user_factors(spark, sf), "user_id").withColumn("k", F.lit(CFG.top_k))
    r = score.pruned_work(users, fx.item_factors(spark, sf), "user_id", "artist_name", "k", seen=tr,
                          item_block=PRUNE_BLOCK)
    return r.select("n_queries", "n_items", "n_products", "n_all_products")


SIM_SQL = o.with_("factors", """un AS (SELECT artist_name, features,
     sqrt(list_dot_product(features, features)) AS nrm FROM itf)""",
                  """sims AS (SELECT a.artist_name, b.artist_name AS similar_artist,
     CASE WHEN a.nrm = 0 OR b.nrm = 0 THEN 0.0 ELSE list_dot_product(a.features, b.features) / (a.nrm * b.nrm) END
       AS similarity
     FROM un a, un b WHERE a.artist_name <> b.artist_name)""",
                  o.topk_sql("sims", "artist_name", str(CFG.top_k), "top", key="similar_artist", score="similarity"))


@register("m5_similar_artists", SIM_SQL + "SELECT artist_name AS query, artist_name, similar_artist, "
          "round(similarity, 6) AS similarity, rank FROM top")
def m5(spark, sf):
    itf = fx.item_factors(spark, sf)
    q = itf.select(F.col("artist_name").alias("query"))
    r = score.similar_items(q, itf, CFG.top_k)
    return r.select("query", "artist_name", "similar_artist", _r6("similarity"), "rank")


@register("m7_random_discovery", o.with_("factors", REC_USERS,
                                         "pick AS (SELECT arg_min(user_id, md5(concat(user_id, ':42')) || user_id) AS user_id FROM ru)",
                                         o.unseen_scores_sql("pick"),
                                         o.topk_sql("scored", "user_id", str(CFG.top_k), "recs")) +
          "SELECT user_id, artist_name, round(score, 6) AS score, rank FROM recs")
def m7(spark, sf):
    r = score.random_discovery(fx.train(spark, sf), fx.user_factors(spark, sf), fx.item_factors(spark, sf),
                               CFG.top_k, CFG.seed)
    return r.select("user_id", "artist_name", _r6("score"), "rank")


@register("m8_sample_recs", o.with_("factors", REC_USERS,
                                    "pick AS (SELECT user_id FROM ru ORDER BY md5(concat(user_id, ':42')), user_id LIMIT 5)",
                                    o.unseen_scores_sql("pick"),
                                    o.topk_sql("scored", "user_id", "5", "recs")) +
          "SELECT concat(substring(user_id, 1, 20), '...') AS user_short, user_id, artist_name, "
          "round(score, 6) AS score, rank FROM recs")
def m8(spark, sf):
    r = score.sample_recommendations(fx.train(spark, sf), fx.user_factors(spark, sf),
                                     fx.item_factors(spark, sf), 5, CFG.top_k, 5, CFG.seed)
    return r.select("user_short", "user_id", "artist_name", _r6("score"), "rank")


@register("m5_similar_approx_recall", o.with_("factors") + f"""SELECT (SELECT count(*) FROM itf) AS n_items,
  (SELECT count(*) FROM itf) * {CFG.top_k} AS n_rows, CAST({CFG.top_k} AS INTEGER) AS k, TRUE AS reached""")
def m5a(spark, sf):
    """M5's approximate option for every artist, with its recall measured on the run's own rows."""
    itf = fx.item_factors(spark, sf)
    rows, report = similar.similar_items_approx(itf.select(F.col("artist_name").alias("query")), itf, CFG.top_k)
    found = rows.agg(F.count("*").alias("n_rows"))
    return report.join(found).select("n_items", "n_rows", "k", (F.col("recall") >= 0.9).alias("reached"))


# ---------------------------------------------------------------- moods
def _mood_ctes(k_expr: str = str(CFG.top_k)) -> list[str]:
    return [
        o.mood_fixture_sql(),
        f"""mseed AS (SELECT mood, pos, {o.clean_sql('seed')} AS seed_name FROM mseeds)""",
        """found AS (SELECT * FROM mseed WHERE seed_name IN (SELECT artist_name FROM artists))""",
        f"""overlap AS (SELECT f.mood, t.user_id, count(DISTINCT f.seed_name) AS n_seeds
             FROM found f JOIN train t ON t.artist_name = f.seed_name
             WHERE t.user_id IN (SELECT user_id FROM uf) GROUP BY f.mood, t.user_id)""",
        f"""chosen AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mood ORDER BY n_seeds DESC, user_id)
             AS r FROM overlap) WHERE r <= {CFG.mood_users})""",
    ]


MOOD_K = CFG.top_k
MOOD_SQL = o.with_("factors", *_mood_ctes(),
                   "cu AS (SELECT DISTINCT user_id FROM chosen)",
                   o.unseen_scores_sql("cu"),
                   o.topk_sql("scored", "user_id", str(2 * MOOD_K), "urecs"),
                   """fused AS (SELECT c.mood, u.artist_name, sum(u.score) AS score FROM chosen c
                       JOIN urecs u USING (user_id)
                       WHERE NOT EXISTS (SELECT 1 FROM mseed s WHERE s.mood = c.mood AND s.seed_name = u.artist_name)
                       GROUP BY c.mood, u.artist_name)""",
                   o.topk_sql("fused", "mood", str(MOOD_K), "mrecs"))


@register("m4_mood_recs", MOOD_SQL + f"SELECT mood, CAST({MOOD_K} AS INTEGER) AS k, rank, artist_name, "
          "round(score, 6) AS score FROM mrecs")
def m4(spark, sf):
    moods = fx.moods(spark, sf)
    reqs = moods.select("mood").withColumn("k", F.lit(MOOD_K))
    r = mood.mood_recommendations(reqs, moods, fx.artists(spark, sf), fx.train(spark, sf),
                                  fx.user_factors(spark, sf), fx.item_factors(spark, sf), CFG.mood_users)
    return r.select("mood", "k", "rank", "artist_name", _r6("score"))


@register("s14_mood_dimension", o.with_("plays", o.mood_fixture_sql()) +
          "SELECT mood, name, description, seed_artists FROM moods")
def s14(spark, sf):
    return fx.moods(spark, sf)


@register("s14_mood_seeds_lookup", o.with_("plays", o.mood_fixture_sql()) +
          "SELECT mood, pos, seed FROM mseeds WHERE mood = 'rock'")
def s14b(spark, sf):
    return moods_src.mood_seeds(fx.moods(spark, sf), "  ROCK ")


_REAL_MOODS = "real(mood, name, description, seeds) AS (VALUES " + ", ".join(
    f"('{m}', '{n}', '{d}', [" + ", ".join("'" + x.replace("'", "''") + "'" for x in seeds) + "])"
    for m, n, d, seeds in moods_src.MOOD_PROFILES) + ")"


@register("s14_mood_profiles_in_catalog", o.with_("factors", _REAL_MOODS) + """SELECT mood, name, description, seed,
    CAST(pos - 1 AS INTEGER) AS pos, seed IN (SELECT artist_name FROM artists) AS found,
    (SELECT count(*) FROM train WHERE artist_name = seed) AS n_plays
    FROM (SELECT mood, name, description, unnest(seeds) AS seed, unnest(range(1, len(seeds) + 1)) AS pos FROM real)""")
def s14c(spark, sf):
    """The twelve real moods with their seeds looked up in the artist catalog and the train rows."""
    m = moods_src.mood_profiles(spark).select("mood", "name", "description",
                                              F.posexplode("seed_artists").alias("pos", "seed"))
    known = fx.artists(spark, sf).select(F.col("artist_name").alias("seed"), F.lit(True).alias("hit"))
    plays = fx.train(spark, sf).groupBy(F.col("artist_name").alias("seed")).agg(F.count("*").alias("n"))
    return m.join(known, "seed", "left").join(plays, "seed", "left").select(
        "mood", "name", "description", "seed", "pos", F.coalesce("hit", F.lit(False)).alias("found"),
        F.coalesce("n", F.lit(0)).alias("n_plays"))


@register("m4_found_seeds", o.with_("factors", *_mood_ctes()) +
          "SELECT mood, list(seed_name ORDER BY pos) AS found_seeds FROM found GROUP BY mood")
def m4f(spark, sf):
    return mood.found_seeds(fx.moods(spark, sf), fx.artists(spark, sf))


@register("a12_seed_overlap_top_users", o.with_("factors", *_mood_ctes()) +
          "SELECT mood, user_id, n_seeds FROM chosen")
def a12(spark, sf):
    return mood.mood_listeners(fx.moods(spark, sf), fx.artists(spark, sf), fx.train(spark, sf),
                               fx.user_factors(spark, sf), CFG.mood_users)


@register("m10_twin_recs", MOOD_SQL + """, prof(profile, mood) AS (VALUES """ + ", ".join(
    f"('{p[0]}', '{p[3]}')" for p in moods_src.TWIN_PROFILES) + """)
    SELECT profile, mood, rank, artist_name, round(score, 6) AS score FROM prof JOIN mrecs USING (mood)""")
def m10(spark, sf):
    r = mood.twin_recommendations(moods_src.twin_profiles(spark), fx.moods(spark, sf), fx.artists(spark, sf),
                                  fx.train(spark, sf), fx.user_factors(spark, sf), fx.item_factors(spark, sf),
                                  MOOD_K, CFG.mood_users)
    return r.select("profile", "mood", "rank", "artist_name", _r6("score"))


# ---------------------------------------------------------------- evaluation
EVAL_SQL = o.with_("factors",
                   "tu AS (SELECT DISTINCT user_id FROM test WHERE user_id IN (SELECT user_id FROM uf))",
                   o.unseen_scores_sql("tu"),
                   o.topk_sql("scored", "user_id", str(CFG.eval_k), "recs"),
                   "rel AS (SELECT DISTINCT user_id, artist_name FROM test WHERE user_id IN (SELECT user_id FROM tu))",
                   "nrel AS (SELECT user_id, count(*) AS n_rel FROM rel GROUP BY user_id)",
                   """hits AS (SELECT r.user_id, r.rank, CASE WHEN l.user_id IS NULL THEN 0 ELSE 1 END AS hit
                       FROM recs r LEFT JOIN rel l USING (user_id, artist_name))""",
                   """cum AS (SELECT *, sum(hit) OVER (PARTITION BY user_id ORDER BY rank
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c FROM hits)""",
                   """pu AS (SELECT user_id, sum(hit) AS h, sum(CASE WHEN hit = 1 THEN c / rank END) AS ap,
                       sum(CASE WHEN hit = 1 THEN 1.0 / log2(rank + 1) END) AS dcg FROM cum GROUP BY user_id)""",
                   f"""per AS (SELECT n.user_id, n.n_rel, least({CFG.eval_k}, n.n_rel) AS m, coalesce(h, 0) AS h,
                       coalesce(ap, 0) AS ap, coalesce(dcg, 0) AS dcg FROM nrel n LEFT JOIN pu USING (user_id))""")
K = CFG.eval_k
EVAL_SELECT = (f"SELECT round(sum(h) / sum(m), 6) AS precision_at_{K}, round(avg(ap / m), 6) AS map_at_{K}, "
               f"round(avg(dcg / (SELECT sum(1.0 / log2(j + 1)) FROM range(1, CAST(m AS BIGINT) + 1) t(j))), 6) "
               f"AS ndcg_at_{K}, count(*) AS n_test_users, CAST(sum(n_rel) AS BIGINT) AS n_test_interactions FROM per")


@register("m2_evaluate_ranking", EVAL_SQL + EVAL_SELECT)
def m2(spark, sf):
    r = metrics.evaluate(fx.train(spark, sf), fx.test(spark, sf), fx.user_factors(spark, sf),
                         fx.item_factors(spark, sf), K)
    return r.select(_r6(f"precision_at_{K}"), _r6(f"map_at_{K}"), _r6(f"ndcg_at_{K}"), "n_test_users",
                    "n_test_interactions")


@register("m9_model_info", o.with_("factors") + "SELECT (SELECT count(*) FROM uf) AS n_users, "
          "(SELECT count(*) FROM itf) AS n_artists, (SELECT CAST(max(len(features)) AS INTEGER) FROM uf) AS n_factors")
def m9(spark, sf):
    from tonearm.operators.als import model_info
    return model_info(fx.user_factors(spark, sf), fx.item_factors(spark, sf))


# ---------------------------------------------------------------- small expressions
@register("p9_query_key", o.with_("factors") +
          "SELECT q, trim(lower(q)) AS key, trim(lower(q)) IN (SELECT artist_name FROM itf) AS found FROM "
          "(SELECT DISTINCT concat('  ', upper(artist_name), ' ') AS q FROM itf)")
def p9(spark, sf):
    itf = fx.item_factors(spark, sf)
    q = itf.select(F.concat(F.lit("  "), F.upper("artist_name"), F.lit(" ")).alias("q")).distinct()
    keyed = q.withColumn("key", names.query_key("q"))
    return keyed.join(itf.select(F.col("artist_name").alias("key"), F.lit(True).alias("found")), "key", "left") \
        .select("q", "key", F.coalesce("found", F.lit(False)).alias("found"))


@register("p11_short_ids", o.with_("split") + "SELECT DISTINCT user_id, concat(substring(user_id, 1, 20), '...') "
          "AS user_short, substring(md5(user_id), 1, 8) AS run_short FROM train")
def p11(spark, sf):
    return fx.train(spark, sf).select(
        "user_id", names.short_user_id("user_id").alias("user_short"),
        names.short_run_id(F.md5("user_id")).alias("run_short")).distinct()


# ---------------------------------------------------------------- request-log metrics (batch and streaming)
from tonearm.streaming import monitor  # noqa: E402

LOG_SQL = f"""log AS (SELECT ts, event_id, 'POST' AS method, concat('/', event_type) AS endpoint,
  CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
  CASE event_type WHEN 'view' THEN 'mood' WHEN 'click' THEN 'user' WHEN 'purchase' THEN 'random' END AS type,
  CASE WHEN event_type = 'view' THEN {o.MOOD_ARRAY}[user_id % 12 + 1] END AS mood,
  CASE WHEN event_type = 'error' THEN 'ValueError' END AS error_type,
  CASE WHEN event_type = 'signup' THEN CASE event_id % 2 WHEN 0 THEN 'similar' ELSE 'charts' END END AS lookup,
  value AS duration, event_type = 'error' AS is_error, user_id FROM events)"""
LOG = "WITH " + LOG_SQL + "\n"
_SLIDE = "(SELECT *, time_bucket(INTERVAL 1 minute, ts) - k * INTERVAL 1 minute AS ws FROM log, range(0, 5) t(k))"
_BUCKET_SQL = ", ".join(f"count_if(duration <= {b}) AS le_{str(b).replace('.', '_')}" for b in monitor.LATENCY_BUCKETS)

R_SQL = {
    "r1_request_counts": LOG + "SELECT method, endpoint, status, count(*) AS requests FROM log GROUP BY ALL",
    "r2_latency_histogram": LOG + f"SELECT method, endpoint, {_BUCKET_SQL}, count(*) AS le_inf, "
                            "round(sum(duration), 6) AS duration_sum, count(*) AS requests FROM log GROUP BY ALL",
    "r3_recs_by_type": LOG + "SELECT type, mood, count(*) AS requests FROM log WHERE type IS NOT NULL GROUP BY ALL",
    "r3_lookup_totals": LOG + "SELECT count_if(lookup = 'similar') AS similar_artist_requests_total, "
                        "count_if(lookup = 'charts') AS charts_requests_total FROM log",
    "r4_errors_by_kind": LOG + "SELECT endpoint, error_type, count(*) AS errors FROM log WHERE is_error GROUP BY ALL",
    "r5_gauges_last": LOG + "SELECT endpoint AS gauge, arg_max(duration, row(ts, event_id)) AS value, max(ts) AS ts "
                      "FROM log GROUP BY endpoint",
    "r6_requests_per_minute": LOG + "SELECT time_bucket(INTERVAL 1 minute, ts) AS window_start, "
                              "time_bucket(INTERVAL 1 minute, ts) + INTERVAL 1 minute AS window_end, "
                              "count(*) AS requests FROM log GROUP BY ALL",
    "r7_latency_sliding": LOG + "SELECT ws AS window_start, ws + INTERVAL 5 minute AS window_end, "
                          "round(sum(duration), 6) AS duration_sum, count(*) AS requests, "
                          f"round(sum(duration) / count(*), 6) AS mean_latency FROM {_SLIDE} GROUP BY ws",
    "r8_errors_sliding": LOG + "SELECT ws AS window_start, ws + INTERVAL 5 minute AS window_end, "
                         "count_if(is_error) AS errors, round(count_if(is_error) / 5.0, 6) AS errors_per_minute "
                         f"FROM {_SLIDE} GROUP BY ws",
    "r9_top_moods": LOG + "SELECT mood, count(*) AS requests FROM log WHERE mood IS NOT NULL GROUP BY mood "
                    "ORDER BY requests DESC, mood LIMIT 5",
    "r10_total_recommendations": LOG + "SELECT count_if(type IS NOT NULL) AS total_recommendations FROM log",
    "r11_traffic_stats": LOG + """SELECT total, errors, round(el, 6) AS elapsed_seconds,
        round(total * 60.0 / el, 6) AS requests_per_minute, round(errors * 100.0 / total, 6) AS error_pct FROM
        (SELECT count(*) AS total, count_if(is_error) AS errors, epoch(max(ts)) - epoch(min(ts)) AS el FROM log)""",
    "r12_alerts": LOG + f"""SELECT window_start, window_end, requests, errors, round(error_pct, 6) AS error_pct,
        round(mean_latency, 6) AS mean_latency,
        CASE WHEN error_pct > {monitor.ERROR_CRIT_PCT} THEN 'critical' WHEN error_pct > {monitor.ERROR_WARN_PCT}
             THEN 'warning' ELSE 'ok' END AS error_alert,
        CASE WHEN mean_latency > {monitor.LATENCY_CRIT_S} THEN 'critical' WHEN mean_latency > {monitor.LATENCY_WARN_S}
             THEN 'warning' ELSE 'ok' END AS latency_alert,
        CASE WHEN requests > {monitor.VOLUME_WARN_PER_MIN} THEN 'warning' ELSE 'ok' END AS volume_alert FROM
        (SELECT time_bucket(INTERVAL 1 minute, ts) AS window_start,
                time_bucket(INTERVAL 1 minute, ts) + INTERVAL 1 minute AS window_end,
                count(*) AS requests, count_if(is_error) AS errors,
                count_if(is_error) * 100.0 / count(*) AS error_pct, sum(duration) / count(*) AS mean_latency
         FROM log GROUP BY ALL)""",
}

# name -> (metric function, streaming keys, post-processing on the final result, columns to round)
R_SPEC = {
    "r1_request_counts": (monitor.request_counts, ["method", "endpoint", "status"], None, []),
    "r2_latency_histogram": (monitor.latency_histogram, ["method", "endpoint"], None, ["duration_sum"]),
    "r3_recs_by_type": (monitor.recs_by_type, ["type", "mood"], None, []),
    "r3_lookup_totals": (monitor.lookup_totals, [], None, []),
    "r4_errors_by_kind": (monitor.errors_by_kind, ["endpoint", "error_type"], None, []),
    "r5_gauges_last": (monitor.gauges_last, ["gauge"], None, []),
    "r6_requests_per_minute": (monitor.per_minute, ["window_start", "window_end"], None, []),
    "r7_latency_sliding": (monitor.latency_sliding, ["window_start", "window_end"], None,
                           ["duration_sum", "mean_latency"]),
    "r8_errors_sliding": (monitor.errors_sliding, ["window_start", "window_end"], None, ["errors_per_minute"]),
    "r9_top_moods": (monitor.mood_counts, ["mood"], monitor.top_moods, []),
    "r10_total_recommendations": (monitor.total_recommendations, [], None, []),
    "r11_traffic_stats": (monitor.traffic_stats, [], None,
                          ["elapsed_seconds", "requests_per_minute", "error_pct"]),
    "r12_alerts": (monitor.minute_health, ["window_start", "window_end"], monitor.alerts,
                   ["error_pct", "mean_latency"]),
}

_TS_COLS = ("window_start", "window_end", "ts")


def _finish(df: DataFrame, post, rounded) -> DataFrame:
    if post is not None:
        df = post(df)
    return df.select(*[F.round(F.col(c), 6).alias(c) if c in rounded else F.col(c) for c in df.columns])


def _batch_metric(name):
    fn, _, post, rounded = R_SPEC[name]

    def run(spark, sf):
        return _finish(fn(fx.request_log(spark, sf)), post, rounded)
    run.__name__ = name
    return run


def _stream_metric(name):
    fn, keys, post, rounded = R_SPEC[name]

    def run(spark, sf):
        events = fx.table(spark, sf, "events")
        stream = monitor.event_stream(spark, f"{sf}/events.parquet", events.schema)
        agg = fn(fx.request_log(spark, sf, stream))
        if post is monitor.top_moods:  # ranked inside the stream, in complete mode: the table holds the report
            path, _ = monitor.run_stream(post(agg), keys, name, "complete")
            return monitor.latest(spark, path, None)
        path, _ = monitor.run_stream(agg, keys, name)
        out = monitor.latest(spark, path, keys)
        out = out.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in _TS_COLS else F.col(c)
                           for c in out.columns])
        return _finish(out, post, rounded)
    run.__name__ = name + "_stream"
    return run


for _name, _sql in R_SQL.items():
    register(_name, _sql)(_batch_metric(_name))
    register(_name + "_stream", _sql)(_stream_metric(_name))


@register("r5_model_gauges", o.with_("factors") + """SELECT 'model_loaded' AS gauge, CAST(1 AS DOUBLE) AS value
    UNION ALL SELECT 'model_users_total', (SELECT count(*) FROM uf)
    UNION ALL SELECT 'model_artists_total', (SELECT count(*) FROM itf)""")
def r5g(spark, sf):
    return monitor.model_gauges(fx.user_factors(spark, sf), fx.item_factors(spark, sf))


@register("r2_latency_histogram_long", LOG + f"SELECT method, endpoint, le, bucket_count, round(duration_sum, 6) AS duration_sum, requests FROM (SELECT method, endpoint, {_BUCKET_SQL}, count(*) AS le_inf, sum(duration) AS duration_sum, count(*) AS requests FROM log GROUP BY ALL) UNPIVOT (bucket_count FOR le IN (" + ", ".join(f"le_{str(b).replace('.', '_')} AS '{b}'" for b in monitor.LATENCY_BUCKETS) + ", le_inf AS 'inf'))")
def r2l(spark, sf):
    return _finish(monitor.histogram_long(monitor.latency_histogram(fx.request_log(spark, sf))), None,
                   ["duration_sum"])


# ---------------------------------------------------------------- runs and the comparison report
from tonearm.operators import runs as runs_op  # noqa: E402

RUN_DIMS = (16, 32, 64)


def _eval_ctes(sfx: str, dims: int) -> list[str]:
    """The M2 oracle over factor vectors cut to ``dims`` (CTE names suffixed)."""
    return [
        f"uf{sfx} AS (SELECT user_id, list_slice(features, 1, {dims}) AS features FROM uf)",
        f"itf{sfx} AS (SELECT artist_name, list_slice(features, 1, {dims}) AS features FROM itf)",
        f"""sc{sfx} AS (SELECT u.user_id, i.artist_name, list_dot_product(f.features, i.features) AS score
            FROM tu u JOIN uf{sfx} f USING (user_id) CROSS JOIN itf{sfx} i
            WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.artist_name = i.artist_name))""",
        o.topk_sql(f"sc{sfx}", "user_id", str(K), f"rk{sfx}"),
        f"""h{sfx} AS (SELECT r.user_id, r.rank, CASE WHEN l.user_id IS NULL THEN 0 ELSE 1 END AS hit
            FROM rk{sfx} r LEFT JOIN rel l USING (user_id, artist_name))""",
        f"""c{sfx} AS (SELECT *, sum(hit) OVER (PARTITION BY user_id ORDER BY rank
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c FROM h{sfx})""",
        f"""pu{sfx} AS (SELECT user_id, sum(hit) AS h, sum(CASE WHEN hit = 1 THEN c / rank END) AS ap,
            sum(CASE WHEN hit = 1 THEN 1.0 / log2(rank + 1) END) AS dcg FROM c{sfx} GROUP BY user_id)""",
        f"""per{sfx} AS (SELECT n.user_id, n.n_rel, least({K}, n.n_rel) AS m, coalesce(h, 0) AS h,
            coalesce(ap, 0) AS ap, coalesce(dcg, 0) AS dcg FROM nrel n LEFT JOIN pu{sfx} USING (user_id))""",
        f"""run{sfx} AS (SELECT md5('embedding-dims:{dims}') AS run_id, {dims} AS factors, sum(h) / sum(m) AS p,
            avg(ap / m) AS mp, avg(dcg / (SELECT sum(1.0 / log2(j + 1)) FROM range(1, CAST(m AS BIGINT) + 1) t(j)))
            AS nd FROM per{sfx})""",
    ]


_RUN_CTES = ["tu AS (SELECT DISTINCT user_id FROM test WHERE user_id IN (SELECT user_id FROM uf))",
             "rel AS (SELECT DISTINCT user_id, artist_name FROM test WHERE user_id IN (SELECT user_id FROM tu))",
             "nrel AS (SELECT user_id, count(*) AS n_rel FROM rel GROUP BY user_id)"]
for _d in RUN_DIMS:
    _RUN_CTES += _eval_ctes(str(_d), _d)
# Besides the three cuts: a run tied with the 32-dimension one but slower, sharing the first eight characters of
# its id, and a run without any measurement (P14 defaults).  Times grow with the number of users.
_RUN_CTES.append("runs AS (SELECT *, factors * (SELECT count(*) FROM uf) * 0.06 AS secs FROM ("
                 + " UNION ALL ".join(f"SELECT * FROM run{d}" for d in RUN_DIMS)
                 + ") UNION ALL SELECT substring(run_id, 1, 8) || '-tied', factors, p, mp, nd, factors * 2 * "
                   "(SELECT count(*) FROM uf) * 0.06 FROM run32 UNION ALL SELECT md5('unmeasured'), NULL, NULL, NULL, "
                   "NULL, NULL)")
_RUN_CTES.append("""cmp AS (SELECT run_id, substring(run_id, 1, 8) AS run_short, CAST(coalesce(factors, 0) AS INTEGER)
    AS factors, 0 AS iterations, CAST(0.0 AS DOUBLE) AS regularization, coalesce(p, 0) AS precision_at_10,
    coalesce(mp, 0) AS map_at_10, coalesce(nd, 0) AS ndcg_at_10, coalesce(secs, 0) / 60.0::DOUBLE AS training_minutes,
    CAST(NULL AS TIMESTAMP) AS start_time,
    CAST(row_number() OVER (ORDER BY coalesce(p, 0) DESC, coalesce(secs, 0), run_id) AS INTEGER) AS rank FROM runs)""")
RUNS_SQL = o.with_("factors", *_RUN_CTES)


def _embedding_runs(spark, sf) -> DataFrame:
    """Run records derived from the data: M2 of the given factors cut to 16/32/64 dimensions, a tie and a zero run."""
    n_users = fx.user_factors(spark, sf).agg(F.count("*").alias("n_users"))
    parts = []
    for d in RUN_DIMS:
        uf = fx.user_factors(spark, sf).withColumn("features", F.slice("features", 1, d))
        itf = fx.item_factors(spark, sf).withColumn("features", F.slice("features", 1, d))
        m = metrics.evaluate(fx.train(spark, sf), fx.test(spark, sf), uf, itf, K)
        parts.append(m.join(n_users).select(
            F.md5(F.lit(f"embedding-dims:{d}")).alias("run_id"), F.lit("embedding-dims").alias("experiment"),
            F.lit(d).alias("factors"), F.lit(0).alias("iterations"), F.lit(0.0).alias("regularization"),
            F.lit(CFG.alpha).alias("alpha"), F.col(f"precision_at_{K}").alias("precision_at_10"),
            F.col(f"map_at_{K}").alias("map_at_10"), F.col(f"ndcg_at_{K}").alias("ndcg_at_10"),
            (F.col("n_users") * d * 0.06).alias("training_time_seconds"), F.lit("ok").alias("status")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = materialize(runs_op.conform(out), "embedding-runs")
    tied = out.where("factors = 32").withColumn("run_id", F.concat(names.short_run_id("run_id"), F.lit("-tied"))) \
        .withColumn("training_time_seconds", F.col("training_time_seconds") * 2)
    zero = spark.range(1).select(F.md5(F.lit("unmeasured")).alias("run_id"), F.lit("embedding-dims").alias("experiment"))
    return out.unionByName(tied).unionByName(runs_op.conform(zero))


_CMP_COLS = ["run_id", "run_short", "factors", "iterations", "regularization", "precision_at_10", "map_at_10", "ndcg_at_10",
             "training_minutes", "start_time", "rank"]


@register("m12_run_comparison", RUNS_SQL + "SELECT run_id, run_short, factors, iterations, regularization, "
          "round(precision_at_10, 6) AS precision_at_10, round(map_at_10, 6) AS map_at_10, "
          "round(ndcg_at_10, 6) AS ndcg_at_10, round(training_minutes, 6) AS training_minutes, start_time, rank FROM cmp")
def m12(spark, sf):
    t = runs_op.comparison_table(_embedding_runs(spark, sf))
    return t.select(*[_r6(c) if c in ("precision_at_10", "map_at_10", "ndcg_at_10", "training_minutes") else c
                      for c in _CMP_COLS])


@register("m12_run_summary", RUNS_SQL + """, b AS (SELECT * FROM cmp WHERE rank = 1),
    w AS (SELECT * FROM cmp WHERE rank = (SELECT max(rank) FROM cmp)),
    f AS (SELECT * FROM cmp ORDER BY training_minutes, rank LIMIT 1)
    SELECT (SELECT count(*) FROM cmp) AS n_runs, b.run_short AS best_run, b.factors AS best_factors,
      round(b.precision_at_10, 6) AS best_precision, round(b.training_minutes, 6) AS best_minutes, w.run_short AS worst_run,
      round(w.precision_at_10, 6) AS worst_precision, f.run_short AS fastest_run, f.factors AS fastest_factors,
      round(f.training_minutes, 6) AS fastest_minutes,
      round(CASE WHEN w.precision_at_10 = 0 THEN NULL
            ELSE (b.precision_at_10 - w.precision_at_10) * 100.0 / w.precision_at_10 END, 6) AS improvement_pct,
      CASE WHEN f.run_id <> b.run_id THEN round((b.precision_at_10 - f.precision_at_10) * 100.0 / b.precision_at_10, 6)
      END AS precision_loss_pct,
      CASE WHEN f.run_id <> b.run_id THEN round(b.training_minutes - f.training_minutes, 6) END AS minutes_saved,
      CASE WHEN (b.precision_at_10 - w.precision_at_10) * 100.0 / nullif(w.precision_at_10, 0) > 10
           THEN concat('significant improvement: use factors=', b.factors)
           WHEN (b.precision_at_10 - w.precision_at_10) * 100.0 / nullif(w.precision_at_10, 0) > 5
           THEN concat('moderate improvement: best model recommended (factors=', b.factors, ')')
           ELSE 'small differences: weigh speed against accuracy' END AS advice,
      b.training_minutes > 8 AS best_is_slow FROM b, w, f""")
def m12s(spark, sf):
    s = runs_op.comparison_summary(runs_op.comparison_table(_embedding_runs(spark, sf)))
    r = ("best_precision", "worst_precision", "improvement_pct", "precision_loss_pct", "best_minutes",
         "fastest_minutes", "minutes_saved")
    return s.select(*[_r6(c) if c in r else c for c in s.columns])


@register("s11_s12_runs_roundtrip", RUNS_SQL + "SELECT run_id, "
          "'embedding-dims' AS experiment, CAST(factors AS INTEGER) AS factors, round(p, 6) AS precision_at_10 FROM runs")
def s11(spark, sf):
    path = scratch_path(spark, "runs")
    runs_op.append_runs(_embedding_runs(spark, sf), path)
    back = runs_op.read_runs(spark, path, "embedding-dims")
    return back.select("run_id", "experiment", "factors", _r6("precision_at_10"))


@register("s13_report_roundtrip", RUNS_SQL + """SELECT format, run_id, CAST(factors AS INTEGER) AS factors, rank
    FROM cmp, (VALUES ('csv'), ('json'), ('best')) f(format) WHERE format <> 'best' OR rank = 1""")
def s13(spark, sf):
    """The report's three files read back: the CSV, the JSON and the best run."""
    from pyspark.sql import types as T
    path = scratch_path(spark, "report")
    runs_op.save_report(runs_op.comparison_table(_embedding_runs(spark, sf)), path)
    schema = T.StructType([T.StructField("run_id", T.StringType()), T.StructField("factors", T.IntegerType()),
                           T.StructField("rank", T.IntegerType())])
    csv = spark.read.option("header", "true").csv(f"{path}/csv").select(
        "run_id", F.col("factors").cast("int").alias("factors"), F.col("rank").cast("int").alias("rank"))
    parts = {"csv": csv, "json": spark.read.schema(schema).json(f"{path}/json"),
             "best": spark.read.schema(schema).json(f"{path}/best")}
    tagged = [df.select(F.lit(name).alias("format"), "run_id", "factors", "rank") for name, df in parts.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


# ---------------------------------------------------------------- request dispatcher
from tonearm.operators import requests as req_op  # noqa: E402

_DISPATCH_CTES = [
    f"""reqs AS (SELECT event_id AS request_id,
        CASE WHEN event_type IN ('view', 'signup') THEN 'mood' WHEN event_type IN ('click', 'purchase') THEN 'user'
             ELSE 'random' END AS type,
        CASE WHEN event_type IN ('view', 'signup') THEN CASE WHEN event_id % 67 = 0 THEN '' WHEN event_id % 71 = 0
             THEN 'no such mood' ELSE {o.MOOD_ARRAY}[user_id % 12 + 1] END END AS mood,
        CASE WHEN event_type IN ('click', 'purchase') THEN CASE WHEN event_id % 73 = 0 THEN 'nobody'
             ELSE concat('u', user_id) END END AS user_id,
        CASE WHEN event_id % 61 = 0 THEN {req_op.DEFAULT_K} ELSE CAST(event_id % 60 AS INTEGER) END AS k FROM events)""",
    f"""v AS (SELECT *, CASE WHEN type IS NULL OR type NOT IN ('mood', 'user', 'random')
             THEN 'type must be mood, user or random'
           WHEN k < 1 OR k > {req_op.MAX_K} THEN 'k must be between 1 and {req_op.MAX_K}'
           WHEN type = 'mood' AND coalesce(mood, '') = '' THEN 'mood is required for mood requests'
           WHEN type = 'user' AND user_id IS NULL THEN 'user_id is required for user requests' END AS error
         FROM reqs)""",
    "ok AS (SELECT * FROM v WHERE error IS NULL)",
    "mk AS (SELECT DISTINCT mood, k FROM ok WHERE type = 'mood')",
    *_mood_ctes(),
    "cu AS (SELECT DISTINCT user_id FROM chosen)",
    o.unseen_scores_sql("cu", "scored_c"),
    o.topk_sql("scored_c", "user_id", str(2 * req_op.MAX_K), "urc"),
    """fk AS (SELECT mk.mood, mk.k, u.artist_name, sum(u.score) AS score FROM mk JOIN chosen c ON c.mood = mk.mood
        JOIN urc u ON u.user_id = c.user_id AND u.rank <= 2 * mk.k
        WHERE NOT EXISTS (SELECT 1 FROM mseed s WHERE s.mood = mk.mood AND s.seed_name = u.artist_name)
        GROUP BY mk.mood, mk.k, u.artist_name)""",
    o.topk_sql("fk", "mood, k", "k", "mrk"),
    """mood_rows AS (SELECT q.request_id, q.type, q.mood, CAST(NULL AS VARCHAR) AS user_id, m.rank, m.artist_name,
        m.score FROM ok q JOIN mrk m USING (mood, k) WHERE q.type = 'mood')""",
    "elig AS (SELECT DISTINCT user_id FROM train WHERE user_id IN (SELECT user_id FROM uf))",
    "eidx AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS ix FROM elig)",
    """rr AS (SELECT q.request_id, q.type, q.mood, e.user_id, q.k FROM ok q JOIN eidx e
        ON e.ix = CAST('0x' || substr(md5(concat(q.request_id, ':42')), 1, 8) AS BIGINT) % (SELECT count(*) FROM elig)
        WHERE q.type = 'random')""",
    """ureq AS (SELECT request_id, type, mood, user_id, k FROM ok WHERE type = 'user'
        AND user_id IN (SELECT user_id FROM elig) UNION ALL SELECT * FROM rr)""",
    "uu AS (SELECT DISTINCT user_id FROM ureq)",
    o.unseen_scores_sql("uu", "scored_u"),
    o.topk_sql("scored_u", "user_id", str(req_op.MAX_K), "uru"),
    """user_rows AS (SELECT q.request_id, q.type, CAST(NULL AS VARCHAR) AS mood, q.user_id, u.rank, u.artist_name,
        u.score FROM ureq q JOIN uru u ON u.user_id = q.user_id AND u.rank <= q.k)""",
    "answered AS (SELECT * FROM mood_rows UNION ALL SELECT * FROM user_rows)",
]
DISPATCH_SQL = o.with_("factors", *_DISPATCH_CTES) + """, seeds AS (
  SELECT mood, list(seed_name ORDER BY pos) AS seed_artists FROM found GROUP BY mood),
rows AS (SELECT request_id, rank, artist_name, score, user_id FROM answered)
SELECT q.request_id, q.type, q.mood, CASE WHEN q.type = 'mood' THEN NULL ELSE coalesce(r.user_id, q.user_id) END AS user_id,
  r.rank, r.artist_name, round(r.score, 6) AS score, s.seed_artists,
  CASE WHEN r.rank IS NOT NULL THEN NULL
       WHEN q.type = 'mood' AND q.mood NOT IN (SELECT mood FROM moods) THEN 'unknown mood'
       WHEN q.type = 'mood' AND s.mood IS NULL THEN 'no seed artist in the data'
       WHEN q.type = 'mood' AND q.mood NOT IN (SELECT mood FROM chosen) THEN 'no listener of the seed artists'
       WHEN q.type = 'user' AND q.user_id NOT IN (SELECT user_id FROM train) THEN 'unknown user'
       WHEN q.type = 'user' AND q.user_id NOT IN (SELECT user_id FROM uf) THEN 'user without factors'
       ELSE 'no recommendations for this request' END AS error
FROM ok q LEFT JOIN rows r USING (request_id) LEFT JOIN seeds s ON q.type = 'mood' AND s.mood = q.mood
UNION ALL SELECT request_id, type, mood, user_id, NULL, NULL, NULL, NULL, error FROM v WHERE error IS NOT NULL"""


@register("m15_dispatch_requests", DISPATCH_SQL)
def m15(spark, sf):
    r = req_op.dispatch(fx.recommend_requests(spark, sf), fx.moods(spark, sf), fx.artists(spark, sf),
                        fx.train(spark, sf), fx.user_factors(spark, sf), fx.item_factors(spark, sf), CFG.seed,
                        CFG.mood_users)
    return r.select("request_id", "type", "mood", "user_id", "rank", "artist_name", _r6("score"),
                    "seed_artists", "error")


@register("p10_validate_requests", o.with_("plays", *_DISPATCH_CTES[:2]) +
          "SELECT request_id, type, mood, user_id, k, error FROM v")
def p10(spark, sf):
    return req_op.validate(fx.recommend_requests(spark, sf).withColumn("mood", names.query_key("mood")))


@register("p10_validate_k", o.with_("plays", *_DISPATCH_CTES[:1]) + f"""SELECT request_id, k,
    CASE WHEN k < 1 OR k > {req_op.MAX_K} THEN 'k must be between 1 and {req_op.MAX_K}' END AS error FROM reqs""")
def p10k(spark, sf):
    """P10 for similar-artist and charts requests: default and bounds of k."""
    return req_op.validate_k(fx.recommend_requests(spark, sf), req_op.MAX_K).select("request_id", "k", "error")


# ---------------------------------------------------------------- processed-data sinks and sources
from tonearm.sources import io as io_src  # noqa: E402


def _both_halves(spark, sf, fmt):
    """S6 write (partitioned by split), then S2 read of either half (partition-pruned), labelled."""
    path = scratch_path(spark, f"interactions-{fmt}")
    io_src.write_interactions(fx.flagged(spark, sf), path, fmt=fmt)
    train, test = (io_src.read_interactions(spark, path, half, fmt=fmt).select(
        *OUT.split(", "), "confidence", "preference") for half in ("train", "test"))
    return split.split_union(train, test)


_HALVES_SQL = o.with_("split") + (f"SELECT {OUT}, confidence, preference, 'train' AS split FROM train UNION ALL "
                                  f"SELECT {OUT}, confidence, preference, 'test' AS split FROM test")


@register("s6_s2_interactions_csv_roundtrip", _HALVES_SQL)
def s6(spark, sf):
    return _both_halves(spark, sf, "csv")


@register("s6_s2_interactions_parquet_roundtrip", _HALVES_SQL)
def s6p(spark, sf):
    return _both_halves(spark, sf, "parquet")


@register("s8_s3_artist_map_json_roundtrip", o.with_("core", *o.dense_ids_sql()) + "SELECT * FROM amap")
def s8(spark, sf):
    path = scratch_path(spark, "artist-map")
    _, am = _maps(spark, sf)
    io_src.write_id_map(am, path)
    return io_src.read_id_map(spark, path, "artist_name", "artist_idx")


@register("s3_inverse_user_map", o.with_("core", *o.dense_ids_sql()) + "SELECT user_idx, user_id FROM umap")
def s3(spark, sf):
    """The inverse map is the same table keyed the other way (no second structure)."""
    path = scratch_path(spark, "user-map")
    um, _ = _maps(spark, sf)
    io_src.write_id_map(um, path)
    return io_src.read_id_map(spark, path, "user_id", "user_idx").select("user_idx", "user_id")


@register("s7_s4_matrix_roundtrip", o.with_("split", *o.dense_ids_sql(), MATRIX_SQL) + "SELECT * FROM mat")
def s7(spark, sf):
    path = scratch_path(spark, "matrix")
    io_src.write_matrix(_matrix(spark, sf), path)
    return io_src.read_matrix(spark, path)


@register("p5_weight_column", o.with_("split", *o.dense_ids_sql()) +
          "SELECT user_idx, artist_idx, sum(CAST(preference AS DOUBLE)) AS value FROM train JOIN umap USING (user_id) "
          "JOIN amap USING (artist_name) GROUP BY user_idx, artist_idx")
def p5(spark, sf):
    """P5: without a confidence column the matrix falls back to preference."""
    um, am = _maps(spark, sf)
    idx = matrix.indexed_interactions(fx.train(spark, sf).drop("confidence"), um, am)
    return matrix.sparse_matrix(idx)


# ---------------------------------------------------------------- preprocessing and training jobs
_STATS_SQL = o.with_("fl", *o.dense_ids_sql()) + f"""
SELECT (SELECT count(*) FROM plays) AS original_rows,
       (SELECT count(DISTINCT user_id) FROM plays) AS original_users,
       (SELECT count(DISTINCT artist_name) FROM plays) AS original_artists,
       (SELECT count(*) FROM plays) - (SELECT count(*) FROM p1) AS rows_dropped_missing,
       (SELECT count(*) - count(DISTINCT (user_id, artist_name)) FROM p1) AS duplicates_removed,
       (SELECT count(DISTINCT user_id) FROM core) AS users_after_filter,
       (SELECT count(DISTINCT artist_name) FROM core) AS artists_after_filter,
       (SELECT count(*) FROM core) AS rows_after_filter,
       CASE WHEN (SELECT count(*) FROM ka1) = (SELECT count(*) FROM cl) THEN 1
            WHEN (SELECT count(*) FROM ka2) = (SELECT count(*) FROM ka1) THEN 2
            WHEN (SELECT count(*) FROM ka3) = (SELECT count(*) FROM ka2) THEN 3 ELSE 4 END AS kcore_rounds,
       (SELECT count_if(NOT is_test) FROM fl) AS train_rows, (SELECT count_if(is_test) FROM fl) AS test_rows,
       (SELECT count(*) FROM umap) AS n_users, (SELECT count(*) FROM amap) AS n_artists,
       (SELECT count(*) FROM (SELECT DISTINCT user_id, artist_name FROM fl WHERE NOT is_test)) AS nnz,
       round(1 - (SELECT count(*) FROM (SELECT DISTINCT user_id, artist_name FROM fl WHERE NOT is_test))
             / ((SELECT count(*) FROM umap) * (SELECT count(*) FROM amap)), 6) AS sparsity"""


@register("m13_preprocess_stats", _STATS_SQL)
def m13(spark, sf):
    out = jobs.preprocess(fx.plays(spark, sf), CFG)
    return out["stats"].select(*[c if c != "sparsity" else _r6(c) for c in out["stats"].columns])


@register("s9_stats_json_roundtrip", _STATS_SQL)
def s9(spark, sf):
    out = jobs.preprocess(fx.plays(spark, sf), CFG)
    path = scratch_path(spark, "processed")
    jobs.save_processed(out, path)
    back = io_src.read_stats(spark, f"{path}/stats", jobs.STATS_SCHEMA)
    return back.select(*[c if c != "sparsity" else _r6(c) for c in back.columns])


def _pre(spark, sf):
    """M13 outputs shared by the training keys."""
    return fx._memo(spark, sf, "pre", lambda: jobs.preprocess(fx.plays(spark, sf), CFG))


def _model(spark, sf):
    """The fit at the production setting (rank 100, 20 iterations), with its named factors, made once."""
    from tonearm.operators import als

    def build():
        pre = _pre(spark, sf)
        model, _ = als.fit_als(pre["matrix"], CFG.factors, CFG.iterations, CFG.regularization, CFG.alpha, CFG.seed)
        uf, itf = als.named_factors(model, pre["user_map"], pre["artist_map"])
        return model, materialize(uf, "user-factors"), materialize(itf, "item-factors")
    return fx._memo(spark, sf, "als", build)


@register("m1_als_fit", o.with_("split") + f"SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT artist_name) "
          f"AS n_artists, CAST({CFG.factors} AS INTEGER) AS n_factors FROM train")
def m1(spark, sf):
    from tonearm.operators import als
    _, uf, itf = _model(spark, sf)
    return als.model_info(uf, itf)


@register("s10_s5_model_roundtrip", o.with_("split") + f"SELECT DISTINCT artist_name, CAST({CFG.factors} AS INTEGER) "
          "AS width, true AS unchanged FROM train")
def s10(spark, sf):
    """Every artist of the train data has a vector of the model's rank that comes back unchanged."""
    from tonearm.operators import als
    model, _, itf = _model(spark, sf)
    path = scratch_path(spark, "als-model")
    als.save_model(model, path)
    back = als.load_model(path).itemFactors.select(F.col("id").alias("artist_idx"), F.col("features").alias("read"))
    return itf.join(back, "artist_idx", "left").select(
        "artist_name", F.size("read").alias("width"), F.col("features").eqNullSafe(F.col("read")).alias("unchanged"))


@register("m14_train_and_log", o.with_("split") + f"""SELECT 'train-and-log' AS experiment,
    CAST({CFG.factors} AS INTEGER) AS factors, CAST({CFG.iterations} AS INTEGER) AS iterations,
    CAST({CFG.regularization} AS DOUBLE) AS regularization, CAST({CFG.alpha} AS DOUBLE) AS alpha, 'ok' AS status,
    'ALS' AS model_type, (SELECT count(DISTINCT user_id) FROM train) AS n_users,
    (SELECT count(DISTINCT artist_name) FROM train) AS n_artists,
    count(DISTINCT user_id) AS n_test_users, count(DISTINCT (user_id, artist_name)) AS n_test_interactions,
    CAST(least(5, (SELECT count(DISTINCT user_id) FROM train)) AS BIGINT) AS n_sampled_users, true AS model_reads,
    true AS same_metrics FROM test WHERE user_id IN (SELECT user_id FROM train)""")
def m14(spark, sf):
    """M14 read back from what it wrote: the run row, the metadata, the samples and the model."""
    from tonearm.operators import als
    path = scratch_path(spark, "training")
    out = jobs.train_pipeline(_pre(spark, sf), CFG, path, "train-and-log")
    run = runs_op.read_runs(spark, out["runs"], "train-and-log")
    meta = als.read_metadata(spark, path)
    samples = spark.read.parquet(out["samples"]).agg(F.countDistinct("user_id").alias("n_sampled_users"))
    info = als.saved_model_info(spark, path).select(F.col("n_factors"))
    width = als.load_model(path).rank
    metric = lambda name: F.col("metrics")[name]
    return (run.join(meta.drop("factors", "iterations", "regularization", "alpha")).join(samples).join(info).select(
        "experiment", "factors", "iterations", "regularization", "alpha", "status", "model_type", "n_users", "n_artists",
        metric("n_test_users").cast("long").alias("n_test_users"),
        metric("n_test_interactions").cast("long").alias("n_test_interactions"), "n_sampled_users",
        ((F.col("n_factors") == width) & (F.col("factors") == width)).alias("model_reads"),
        (metric(f"precision_at_{K}") == F.col("precision_at_10")).alias("same_metrics")))


@register("m11_sweep", o.with_("split") + "SELECT CAST(f AS INTEGER) AS factors, CAST(i AS INTEGER) AS iterations, "
          "CAST(r AS DOUBLE) AS regularization, 'ok' AS status, true AS measured FROM (VALUES "
          + ", ".join(map(str, jobs.EXPERIMENTS)) + ") v(f, i, r) WHERE (SELECT count(*) FROM test) > 0")
def m11(spark, sf):
    """The five settings; each run is read back with its parameters, status and a measured precision in 0..1."""
    path = scratch_path(spark, "sweep-runs")
    jobs.sweep(_pre(spark, sf), jobs.EXPERIMENTS, CFG, "sweep", path)
    return runs_op.read_runs(spark, path, "sweep").select(
        "factors", "iterations", "regularization", "status",
        (F.col("precision_at_10").between(0, 1) & (F.col("training_time_seconds") > 0)).alias("measured"))


@register("m3_recs_from_trained_factors", o.with_("split") + f"""SELECT t.user_id,
    least({CFG.top_k}, (SELECT count(DISTINCT artist_name) FROM train) - count(DISTINCT t.artist_name)) AS n_recs,
    0 AS n_seen FROM train t WHERE t.user_id IN (SELECT user_id FROM test) GROUP BY t.user_id""")
def m3t(spark, sf):
    """M3 on factors fitted by M1: as many recommendations as there are unseen artists, none seen."""
    _, uf, itf = _model(spark, sf)
    pre = _pre(spark, sf)
    users = pre["test"].select("user_id").distinct().join(uf.select("user_id"), "user_id", "left_semi")
    recs = score.recommend_unseen(users, uf, itf, pre["train"], CFG.top_k)
    seen = pre["train"].select("user_id", "artist_name").distinct().withColumn("seen", F.lit(1))
    per = recs.join(seen, ["user_id", "artist_name"], "left").groupBy("user_id").agg(
        F.count("*").alias("n_recs"), F.count("seen").alias("n_seen"))
    return users.join(per, "user_id", "left").select("user_id", F.coalesce("n_recs", F.lit(0)).alias("n_recs"),
                                                     F.coalesce("n_seen", F.lit(0)).alias("n_seen"))


# ---------------------------------------------------------------- lookup errors
@register("p8_unmatched_lookups", o.with_("factors", o.mood_fixture_sql()) +
          "SELECT DISTINCT seed AS query FROM mseeds WHERE trim(lower(seed)) NOT IN (SELECT artist_name FROM itf)")
def p8(spark, sf):
    """P8 batch form: lookups that name no known artist (``lookups.similar_to`` raises ValueError on each)."""
    q = fx.moods(spark, sf).select(F.explode("seed_artists").alias("query")).distinct()
    return score.unmatched_queries(q, fx.item_factors(spark, sf))


# ---------------------------------------------------------------- single operators out of the composites
@register("j5_user_item_scores", o.with_("factors", REC_USERS) +
          """SELECT r.user_id, count(*) AS n_items, round(sum(list_dot_product(f.features, i.features)), 4) AS score_sum,
             round(max(list_dot_product(f.features, i.features)), 6) AS best_score,
             round(min(list_dot_product(f.features, i.features)), 6) AS worst_score
             FROM ru r JOIN uf f USING (user_id) CROSS JOIN itf i GROUP BY r.user_id""")
def j5(spark, sf):
    """Every catalog item scored for every user, summed up per user inside the block products."""
    who = fx.train(spark, sf).select("user_id").distinct().join(fx.user_factors(spark, sf), "user_id")
    r = score.score_sums(who, fx.item_factors(spark, sf), "user_id", "artist_name")
    return r.select("user_id", "n_items", F.round("score_sum", 4).alias("score_sum"),
                    F.round("best_score", 6).alias("best_score"), F.round("worst_score", 6).alias("worst_score"))


@register("j6_similar_to_top_artist", o.with_("factors", """stats AS (SELECT artist_name, sum(play_count) AS plays
     FROM train WHERE artist_name IN (SELECT artist_name FROM itf) GROUP BY artist_name)""", "q AS (SELECT artist_name FROM stats ORDER BY plays DESC, artist_name LIMIT 1)",
                                              """un AS (SELECT artist_name, features,
     sqrt(list_dot_product(features, features)) AS nrm FROM itf)""",
                                              """sims AS (SELECT a.artist_name, b.artist_name AS similar_artist,
     CASE WHEN a.nrm = 0 OR b.nrm = 0 THEN 0.0 ELSE list_dot_product(a.features, b.features) / (a.nrm * b.nrm) END
       AS similarity FROM un a JOIN q USING (artist_name), un b WHERE a.artist_name <> b.artist_name)""",
                                              o.topk_sql("sims", "artist_name", str(CFG.top_k), "top",
                                                         key="similar_artist", score="similarity")) +
          "SELECT artist_name AS query, artist_name, similar_artist, round(similarity, 6) AS similarity, rank FROM top")
def j6(spark, sf):
    """One query vector (the most played scorable artist) against the whole catalog, self excluded."""
    itf = fx.item_factors(spark, sf)
    scorable = fx.train(spark, sf).join(itf.select("artist_name"), "artist_name", "left_semi")
    q = charts.top_charts(scorable, 1).select(F.col("artist_name").alias("query"))
    r = score.similar_items(q, itf, CFG.top_k)
    return r.select("query", "artist_name", "similar_artist", _r6("similarity"), "rank")


@register("j7_seed_listeners", o.with_("factors", *_mood_ctes()) +
          "SELECT DISTINCT f.mood, f.seed_name, t.user_id FROM found f JOIN train t ON t.artist_name = f.seed_name")
def j7(spark, sf):
    """Seeds joined to the train interactions that listen to them."""
    seeds = mood._seeds(fx.moods(spark, sf), True)
    return (fx.train(spark, sf).select("user_id", F.col("artist_name").alias("seed_name"))
            .join(seeds.select("mood", "seed_name"), "seed_name").select("mood", "seed_name", "user_id").distinct())


_CAND_SQL = o.with_("factors", *_mood_ctes(), "cu AS (SELECT DISTINCT user_id FROM chosen)",
                    o.unseen_scores_sql("cu"), o.topk_sql("scored", "user_id", str(2 * MOOD_K), "urecs"),
                    f"""cand AS (SELECT c.mood, CAST({MOOD_K} AS INTEGER) AS k, u.user_id, u.artist_name, u.score
                        FROM chosen c JOIN urecs u USING (user_id) WHERE NOT EXISTS
                        (SELECT 1 FROM mseed s WHERE s.mood = c.mood AND s.seed_name = u.artist_name))""")


def _mood_per_user(spark, sf):
    moods = fx.moods(spark, sf)
    chosen = mood.mood_listeners(moods, fx.artists(spark, sf), fx.train(spark, sf), fx.user_factors(spark, sf),
                                 CFG.mood_users)
    return moods, chosen.select("mood", F.lit(MOOD_K).alias("k"), "user_id")


@register("j8_mood_candidates", _CAND_SQL + "SELECT mood, k, user_id, artist_name, round(score, 6) AS score FROM cand")
def j8(spark, sf):
    """Each listener's 2k unseen artists with every seed of the mood removed."""
    moods, per_user = _mood_per_user(spark, sf)
    c = mood.mood_candidates(per_user, moods, fx.train(spark, sf), fx.user_factors(spark, sf),
                             fx.item_factors(spark, sf))
    return c.select("mood", "k", "user_id", "artist_name", _r6("score"))


@register("a13_fused_scores", _CAND_SQL + "SELECT mood, k, artist_name, round(sum(score), 6) AS score FROM cand "
          "GROUP BY mood, k, artist_name")
def a13(spark, sf):
    moods, per_user = _mood_per_user(spark, sf)
    c = mood.mood_candidates(per_user, moods, fx.train(spark, sf), fx.user_factors(spark, sf),
                             fx.item_factors(spark, sf))
    return mood.fuse_scores(c).select("mood", "k", "artist_name", _r6("score"))


@register("j9_hit_join", EVAL_SQL + "SELECT r.user_id, r.artist_name, r.rank, "
          "CASE WHEN l.user_id IS NULL THEN 0 ELSE 1 END AS hit FROM recs r LEFT JOIN rel l USING (user_id, artist_name)")
def j9(spark, sf):
    uf = fx.user_factors(spark, sf)
    tu = fx.test(spark, sf).select("user_id").distinct().join(uf.select("user_id"), "user_id", "left_semi")
    recs = score.recommend_unseen(tu, uf, fx.item_factors(spark, sf), fx.train(spark, sf), K, few_users=False)
    return metrics.hit_join(recs, fx.test(spark, sf), K).select("user_id", "artist_name", "rank", "hit")


@register("a14_a16_per_user_metrics", EVAL_SQL + "SELECT user_id, n_rel, CAST(h AS BIGINT) AS hits, "
          "round(ap, 6) AS ap_sum, round(dcg, 6) AS dcg FROM per")
def a14(spark, sf):
    uf = fx.user_factors(spark, sf)
    tu = fx.test(spark, sf).select("user_id").distinct().join(uf.select("user_id"), "user_id", "left_semi")
    recs = score.recommend_unseen(tu, uf, fx.item_factors(spark, sf), fx.train(spark, sf), K, few_users=False)
    rel = fx.test(spark, sf).join(tu, "user_id", "left_semi")
    r = metrics.per_user_metrics(recs, rel, K)
    return r.select("user_id", "n_rel", F.col("hits").cast("long").alias("hits"), _r6("ap_sum"), _r6("dcg"))


@register("j10_profile_moods", o.with_("plays", o.mood_fixture_sql()) + ", prof(profile, mood) AS (VALUES " +
          ", ".join(f"('{p[0]}', '{p[3]}')" for p in moods_src.TWIN_PROFILES) +
          ") SELECT profile, mood, name AS mood_name, seed_artists FROM prof JOIN moods USING (mood)")
def j10(spark, sf):
    return mood.profile_moods(moods_src.twin_profiles(spark), fx.moods(spark, sf)).select(
        "profile", "mood", "mood_name", "seed_artists")


@register("p7_unscorable_users", o.with_("split") +
          "SELECT DISTINCT user_id FROM train WHERE user_id NOT IN (SELECT concat('u', vec_id) FROM embeddings)")
def p7(spark, sf):
    """Users the factor tables cannot score (they silently drop out of recommendations)."""
    return (fx.train(spark, sf).select("user_id").distinct()
            .join(fx.user_factors(spark, sf).select("user_id"), "user_id", "left_anti"))
