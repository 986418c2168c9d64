"""Helpers shared by the operators: table reads, skew-proof look-ups, global positions."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonearm.session import materialize

#: A key with at least HOT_ROWS rows that is among the HOT_KEYS most frequent ones is
#: answered from a broadcast of at most HOT_KEYS rows instead of the shuffle.
HOT_KEYS = 1000
HOT_ROWS = 200
#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors (as --py-files would), once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    # The driver serves this file to the executors as long as it lives.
    folder = tempfile.mkdtemp(prefix="tonearm-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    name = f"{folder}/tonearm_package.zip"
    with zipfile.ZipFile(name, "w") as z:
        for f in sorted(root.glob("tonearm/**/*.py")):
            z.write(f, f.relative_to(root))
    spark.sparkContext.addPyFile(name)
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lookup(left: DataFrame, right: DataFrame, key: str, values: list[str],
           seen: DataFrame | None = None, counted: bool = False) -> DataFrame:
    """Left-join ``values`` of ``right`` (unique on ``key``) without a hot task.

    The most frequent keys of ``left`` (at most HOT_KEYS, so the broadcast is bounded
    whatever the input) are answered by a broadcast join; their rows, and rows with a
    null key, then pass the shuffle join under a random salt that matches nothing, so
    they spread evenly and no row is lost.  The right side's half of that second key is
    zero, but computed from its key: were it a literal, the planner would fold the
    condition and partition by the first key alone.  The keys are counted in ``seen``, a
    written table with a row per row of ``left`` (``left`` itself by default), or summed
    from its column ``n`` where ``counted`` is set.
    """
    seen = left if seen is None else seen
    count = F.sum("n") if counted else F.count(F.lit(1))
    hot_keys = (seen.filter(F.col(key).isNotNull()).groupBy(key).agg(count.alias("__n"))
                .filter(F.col("__n") >= HOT_ROWS).orderBy(F.desc("__n"), key).limit(HOT_KEYS).select(key))
    answer = F.struct(*values)
    found = right.select(key, answer.alias("__hot")).join(F.broadcast(hot_keys), key)
    # A hot key that the right side lacks is hot all the same.
    hot = hot_keys.join(F.broadcast(found), key, "left").withColumn("__is_hot", F.lit(True))
    zero = F.pmod(F.xxhash64(key), F.lit(1).cast("long")).cast("int")
    cold = right.select(F.col(key).alias("__key"), zero.alias("__zero"), answer.alias("__cold"))
    marked = left.join(F.broadcast(hot), key, "left").withColumn(
        "__salt", F.when(F.col("__is_hot").isNull() & F.col(key).isNotNull(), F.lit(0))
        .otherwise(1 + (F.monotonically_increasing_id() % 1_000_003).cast("int")))
    out = marked.join(cold, (F.col(key) == F.col("__key")) & (F.col("__salt") == F.col("__zero")), "left")
    found = F.coalesce(F.col("__hot"), F.col("__cold"))
    keep = [c for c in left.columns if c not in values]
    return out.select(*keep, *[found[v].alias(v) for v in values])


def positions(df: DataFrame, order: list[Column], name: str, partitions: int | None = None) -> DataFrame:
    """Number the rows 0, 1, ... in a global order, as column ``pos`` (long).

    Range partitions are sorted and written once with their in-partition row numbers
    (so a lost executor cannot change them); the offsets are prefix sums over one row
    per partition, a table bounded by the partition count.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    mid = F.monotonically_increasing_id()
    ranged = materialize(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                         .withColumn("__mid", mid), name)
    part, row = F.shiftright("__mid", 33), F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))
    ranged = ranged.withColumn("__part", part)
    counts = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.alias("a").join(F.broadcast(counts.alias("b")), F.col("b.__part") < F.col("a.__part"), "left") \
        .groupBy(F.col("a.__part").alias("__part")).agg(F.coalesce(F.sum("b.__n"), F.lit(0)).alias("__offset"))
    return (ranged.join(F.broadcast(offsets), "__part")
            .withColumn("pos", F.col("__offset") + row).drop("__part", "__mid", "__offset"))

