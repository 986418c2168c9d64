"""R1-R12 request-log metrics, each defined once and run in batch or Structured Streaming.

Every metric is a function ``DataFrame -> DataFrame`` that only uses operators
valid on streaming frames (grouped / windowed aggregations).  :func:`run_stream`
drives the same function over a ``readStream`` source with a watermark and lands its
results in a :class:`ResultTable` in the shared checkpoint folder: in update mode each
micro-batch's updated rows, compacted to one version per key now and then; in complete
mode the whole result of the newest batch.  :func:`latest` reads the newest version of
each key back; :func:`late_rows` says how many rows came too late, over any number of
batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonearm.session import scratch_path

# Default latency bucket edges of the usual Prometheus client histogram, in seconds.
LATENCY_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]

# Alert thresholds (documented in the reference's risk notes).
ERROR_WARN_PCT, ERROR_CRIT_PCT = 1.0, 5.0
LATENCY_WARN_S, LATENCY_CRIT_S = 0.5, 2.0
VOLUME_WARN_PER_MIN = 100


def request_counts(log: DataFrame) -> DataFrame:
    """Requests by (method, endpoint, status)."""
    return log.groupBy("method", "endpoint", "status").agg(F.count("*").alias("requests"))


def latency_histogram(log: DataFrame) -> DataFrame:
    """R2: cumulative latency buckets per (method, endpoint), plus sum and count (wide form)."""
    d = F.col("duration")
    aggs = [F.count_if(d <= b).alias(f"le_{str(b).replace('.', '_')}") for b in LATENCY_BUCKETS]
    return log.groupBy("method", "endpoint").agg(
        *aggs, F.count("*").alias("le_inf"), F.sum(d).alias("duration_sum"), F.count("*").alias("requests"))


def histogram_long(hist: DataFrame) -> DataFrame:
    """R2 long form: one row per (method, endpoint, le) bucket."""
    cols = [c for c in hist.columns if c.startswith("le_")]
    pairs = ", ".join(f"'{c[3:].replace('_', '.')}', {c}" for c in cols)
    return hist.selectExpr("method", "endpoint", f"stack({len(cols)}, {pairs}) AS (le, bucket_count)",
                           "duration_sum", "requests")


def recs_by_type(log: DataFrame) -> DataFrame:
    """Recommendation requests by type and mood requests by mood."""
    return log.where(F.col("type").isNotNull()).groupBy("type", "mood").agg(F.count("*").alias("requests"))


def lookup_totals(log: DataFrame) -> DataFrame:
    """Similar-artist and charts requests (``lookup`` is "similar" or "charts"), failed ones included."""
    return log.agg(F.count_if(F.col("lookup") == "similar").alias("similar_artist_requests_total"),
                   F.count_if(F.col("lookup") == "charts").alias("charts_requests_total"))


def errors_by_kind(log: DataFrame) -> DataFrame:
    """Errors by (endpoint, error_type)."""
    return log.where(F.col("is_error")).groupBy("endpoint", "error_type").agg(F.count("*").alias("errors"))


def gauges_last(log: DataFrame) -> DataFrame:
    """Last value of each gauge (here: the last latency seen per endpoint)."""
    return log.groupBy(F.col("endpoint").alias("gauge")).agg(
        F.max_by("duration", F.struct("ts", "event_id")).alias("value"),
        F.max("ts").alias("ts"))


def model_gauges(user_factors: DataFrame, item_factors: DataFrame) -> DataFrame:
    """The model gauges: whether factors are loaded (1 or 0), their users and their artists."""
    sides = user_factors.select(F.lit("model_users_total").alias("gauge")).unionByName(
        item_factors.select(F.lit("model_artists_total").alias("gauge")))
    n = sides.agg(F.count_if(F.col("gauge") == "model_users_total").alias("u"),
                  F.count_if(F.col("gauge") == "model_artists_total").alias("a"))
    loaded = ((F.col("u") > 0) & (F.col("a") > 0)).cast("double")
    return n.select(F.explode(F.create_map(
        F.lit("model_loaded"), loaded, F.lit("model_users_total"), F.col("u").cast("double"),
        F.lit("model_artists_total"), F.col("a").cast("double"))).alias("gauge", "value"))


def _window_cols(w: str = "window") -> list:
    return [F.col(f"{w}.start").alias("window_start"), F.col(f"{w}.end").alias("window_end")]


def per_minute(log: DataFrame) -> DataFrame:
    """Requests per 1-minute tumbling window."""
    return (log.groupBy(F.window("ts", "1 minute")).agg(F.count("*").alias("requests"))
            .select(*_window_cols(), "requests"))


def latency_sliding(log: DataFrame, length: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """Mean latency over sliding 5-minute windows (sum / count)."""
    return (log.groupBy(F.window("ts", length, slide))
            .agg(F.sum("duration").alias("duration_sum"), F.count("*").alias("requests"))
            .select(*_window_cols(), "duration_sum", "requests",
                    (F.col("duration_sum") / F.col("requests")).alias("mean_latency")))


def errors_sliding(log: DataFrame, length: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """Errors per minute averaged over sliding windows (5 minutes by default)."""
    seconds = lambda end: F.col(f"window.{end}").cast("timestamp").cast("long")
    minutes = (seconds("end") - seconds("start")) / 60.0
    return (log.groupBy(F.window("ts", length, slide))
            .agg(F.count_if(F.col("is_error")).alias("errors"))
            .select(*_window_cols(), "errors", (F.col("errors") / minutes).alias("errors_per_minute")))


def mood_counts(log: DataFrame) -> DataFrame:
    """Counts behind R9 (streamable)."""
    return log.where(F.col("mood").isNotNull()).groupBy("mood").agg(F.count("*").alias("requests"))


def top_moods(counts: DataFrame, n: int = 5) -> DataFrame:
    """The n most requested moods (a top-k report); on a stream in complete mode too."""
    return counts.orderBy(F.desc("requests"), F.asc("mood")).limit(n)


def total_recommendations(log: DataFrame) -> DataFrame:
    """All recommendation requests."""
    return log.agg(F.count_if(F.col("type").isNotNull()).alias("total_recommendations"))


def traffic_stats(log: DataFrame) -> DataFrame:
    """Totals, elapsed seconds, requests per minute and error percentage (zero-safe)."""
    s = log.agg(F.count("*").alias("total"), F.count_if(F.col("is_error")).alias("errors"),
                F.min("ts").alias("t0"), F.max("ts").alias("t1"))
    elapsed = (F.unix_micros(F.col("t1").cast("timestamp")) - F.unix_micros(F.col("t0").cast("timestamp"))) / 1e6
    return s.select("total", "errors", elapsed.alias("elapsed_seconds")).select(
        "total", "errors", "elapsed_seconds",
        F.try_divide(F.col("total") * 60.0, F.col("elapsed_seconds")).alias("requests_per_minute"),
        F.try_divide(F.col("errors") * 100.0, F.col("total")).alias("error_pct"))


def minute_health(log: DataFrame) -> DataFrame:
    """Per-minute counts, errors and latency sum behind R12 (streamable)."""
    return (log.groupBy(F.window("ts", "1 minute"))
            .agg(F.count("*").alias("requests"), F.count_if(F.col("is_error")).alias("errors"),
                 F.sum("duration").alias("duration_sum"))
            .select(*_window_cols(), "requests", "errors", "duration_sum"))


def alerts(health: DataFrame) -> DataFrame:
    """Severity per minute from error %, mean latency and volume."""
    err = F.col("errors") * 100.0 / F.col("requests")
    lat = F.col("duration_sum") / F.col("requests")
    sev_err = F.when(err > ERROR_CRIT_PCT, "critical").when(err > ERROR_WARN_PCT, "warning").otherwise("ok")
    sev_lat = F.when(lat > LATENCY_CRIT_S, "critical").when(lat > LATENCY_WARN_S, "warning").otherwise("ok")
    sev_vol = F.when(F.col("requests") > VOLUME_WARN_PER_MIN, "warning").otherwise("ok")
    return health.select("window_start", "window_end", "requests", "errors",
                         err.alias("error_pct"), lat.alias("mean_latency"),
                         sev_err.alias("error_alert"), sev_lat.alias("latency_alert"), sev_vol.alias("volume_alert"))


# ---------------------------------------------------------------- streaming driver
def event_stream(spark: SparkSession, path: str, schema: T.StructType, watermark: str | None = None,
                 max_files: int | None = None) -> DataFrame:
    """The parquet file or folder at ``path`` as a stream; event time cast to TIMESTAMP.

    Without a watermark (a bounded run over a table) no row is ever late.  With one,
    state of old windows is dropped and so are later rows; :func:`run_stream` counts
    them.  A path without files is an error.
    """
    spark.read.parquet(path)  # raises where nothing is there
    # The file source wants a folder or a pattern; this pattern matches the path alone,
    # be it one file or a folder of part files.
    pattern = f"{path[:-1]}[{path[-1]}]"
    rs = spark.readStream.schema(schema)
    if max_files:
        rs = rs.option("maxFilesPerTrigger", max_files)
    df = rs.parquet(pattern).withColumn("ts", F.col("ts").cast("timestamp"))
    return df.withWatermark("ts", watermark) if watermark else df


#: Batches whose rows are merged into one snapshot when there are so many.
COMPACT_EVERY = 16
#: Batches whose late rows may still be reported anew.
REMEMBERED_BATCHES = 1_000


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


class ResultTable:
    """Results of a stream under ``root``: a folder per batch and snapshots of all batches up to one.

    A repeated batch overwrites its own folder, and a snapshot only covers batches that
    were committed before and counts once its writer has marked it complete, so a
    restart at any point changes nothing.  What a complete snapshot covers is deleted,
    so the table holds one version per key and at most COMPACT_EVERY batches of updates.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str]):
        self.spark, self.root, self.keys = spark, root, keys

    def _ids(self, kind: str, complete: bool = False) -> list[int]:
        p, fs = _files(self.spark, f"{self.root}/{kind}")
        if not fs.exists(p):
            return []
        found = {int(f.getPath().getName().split("=")[1]): f.getPath() for f in fs.listStatus(p) if "=" in f.getPath().getName()}
        if complete:
            found = {i: q for i, q in found.items() if fs.exists(_files(self.spark, f"{q.toString()}/_SUCCESS")[0])}
        return sorted(found)

    def _drop(self, kind: str, ids: list[int]) -> None:
        for i in ids:
            p, fs = _files(self.spark, f"{self.root}/{kind}/{'_batch' if kind == 'data' else 'upto'}={i}")
            fs.delete(p, True)

    def read(self, before: int | None = None) -> DataFrame | None:
        """All versions not yet superseded by a snapshot, with ``_batch``; None without any."""
        parts = []
        snapshots = self._ids("snapshots", complete=True)
        if snapshots:
            parts.append(self.spark.read.parquet(f"{self.root}/snapshots/upto={snapshots[-1]}"))
        batches = [i for i in self._ids("data") if (not snapshots or i > snapshots[-1]) and (before is None or i < before)]
        for i in batches:
            parts.append(self.spark.read.parquet(f"{self.root}/data/_batch={i}").withColumn("_batch", F.lit(i).cast("long")))
        out = None
        for p in parts:
            out = p if out is None else out.unionByName(p)
        return out

    def update(self, batch: DataFrame, batch_id: int) -> None:
        """The updated rows of one batch; older batches are compacted first when there are many."""
        old = [i for i in self._ids("data") if i < batch_id]
        if len(old) >= COMPACT_EVERY:
            newest_of(self.read(before=batch_id), self.keys).write.mode("overwrite").parquet(
                f"{self.root}/snapshots/upto={old[-1]}")
            self._drop("data", old)
            self._drop("snapshots", self._ids("snapshots")[:-1])
        batch.write.mode("overwrite").parquet(f"{self.root}/data/_batch={batch_id}")

    def replace(self, batch: DataFrame, batch_id: int) -> None:
        """The whole result after one batch, in place of all before."""
        batch.withColumn("_batch", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(
            f"{self.root}/snapshots/upto={batch_id}")
        self._drop("snapshots", [i for i in self._ids("snapshots") if i < batch_id])


class _LateRows:
    """Adds up the rows that a watermark dropped, batch by batch.

    A query remembers its last progress reports only; they are read at every batch, so
    none is missed however long the query runs.
    """

    def __init__(self, root: str):
        self.path, self.query, self.seen, self.total = f"{root}/late", None, {}, 0

    def note(self) -> None:
        for p in self.query.recentProgress if self.query else []:
            dropped = sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"])
            more = dropped - self.seen.get(p["batchId"], 0)
            if more > 0:
                self.total += more
                spark = SparkSession.active()
                spark.createDataFrame([(p["batchId"], dropped)], "batch long, dropped long").coalesce(1).write.mode(
                    "append").parquet(self.path)
            self.seen[p["batchId"]] = max(dropped, self.seen.get(p["batchId"], 0))
        for old in sorted(self.seen)[:-REMEMBERED_BATCHES]:
            del self.seen[old]


def run_stream(agg: DataFrame, keys: list[str], name: str, mode: str = "update") -> tuple[str, int]:
    """Run a streaming aggregation to completion (availableNow) in ``update`` or ``complete`` mode.

    The results land in a :class:`ResultTable` under the shared checkpoint folder; the
    stream's own checkpoint (offsets + state) lives next to it, so a restarted job
    resumes.  In complete mode the aggregation may be ranked and cut, and the table
    holds that result after each batch.  Returns the path of the batches' folder and the
    number of late rows that the watermark dropped, also kept per batch in a table
    (:func:`late_rows`).
    """
    spark = agg.sparkSession
    out = scratch_path(spark, f"stream-{name}")
    table, late = ResultTable(spark, out, keys), _LateRows(out)
    land = table.update if mode == "update" else table.replace

    def sink(batch: DataFrame, batch_id: int) -> None:
        late.note()
        land(batch, batch_id)

    late.query = (agg.writeStream.outputMode(mode).foreachBatch(sink)
                  .option("checkpointLocation", f"{out}/_checkpoint").trigger(availableNow=True).start())
    late.query.awaitTermination()
    late.note()
    if table.read() is None:
        # the source has files but no rows: leave an empty result table behind
        land(spark.createDataFrame([], agg.schema), 0)
    return f"{out}/data", late.total


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """(batch, dropped) of the batches in which rows came too late; ``path`` is what :func:`run_stream` returned."""
    at = f"{path.rsplit('/', 1)[0]}/late"
    p, fs = _files(spark, at)
    schema = "batch long, dropped long"
    rows = spark.read.schema(schema).parquet(at) if fs.exists(p) else spark.createDataFrame([], schema)
    return rows.groupBy("batch").agg(F.max("dropped").alias("dropped"))


def newest_of(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The newest version of each key, with its ``_batch``."""
    vals = [c for c in rows.columns if c not in keys and c != "_batch"]
    return (rows.groupBy(*keys).agg(F.max_by(F.struct(*vals), "_batch").alias("_v"), F.max("_batch").alias("_batch"))
            .select(*keys, *[F.col(f"_v.{c}").alias(c) for c in vals], "_batch"))


def latest(spark: SparkSession, path: str, keys: list[str] | None) -> DataFrame:
    """Newest version of each key from a result table; ``keys`` None: a complete-mode table as it is."""
    rows = ResultTable(spark, path.rsplit("/", 1)[0], keys or []).read()
    return (rows if keys is None else newest_of(rows, keys)).drop("_batch")
