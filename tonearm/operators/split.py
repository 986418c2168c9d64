"""W1 per-user random hold-out, U1 difference, U2 union."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonearm.session import drop_scratch, materialize

# A user's boundary cell is refined above this many rows, if it also holds more than 1 / HOT_USERS of all rows.
HOT_ROWS, HOT_USERS = 100_000, 10_000
HEX = "0123456789abcdef"


def _digit_counts(rows: DataFrame, user_col: str, at: int) -> DataFrame:
    """A row per user: its rows and how many have each hash digit at place ``at`` (from 1)."""
    digit = F.substring("_h", at, 1)
    return rows.groupBy(user_col).agg(F.count("*").alias("_rows"),
                                      F.array(*[F.count_if(digit == d) for d in HEX]).alias("_by"))


def _cut(counts: DataFrame, user_col: str, prefix: Column, need: Column) -> DataFrame:
    """The cell in which the ``need``-th row of a user lies: its prefix, the rows needed of it and all its rows."""
    upto = F.transform(F.sequence(F.lit(1), F.lit(len(HEX))), lambda i: F.aggregate(
        F.slice("_by", F.lit(1), i), F.lit(0).cast("long"), lambda a, c: a + c))
    found = counts.select(user_col, "_rows", "_by", upto.alias("_upto"), prefix.alias("_p"), need.alias("_need"))
    found = found.withColumn("_d", F.size(F.filter("_upto", lambda c: c < F.col("_need"))))
    return found.select(
        user_col, "_rows", F.concat("_p", F.substring(F.lit(HEX), F.col("_d") + 1, F.lit(1))).alias("_p"),
        (F.col("_need") - F.get("_upto", F.col("_d")) + F.get("_by", F.col("_d"))).alias("_need"),
        F.get("_by", F.col("_d")).alias("_cell"))


def holdout_cuts(hashed: DataFrame, test_size: float, user_col: str, digits: int = 4,
                 hot_rows: int = HOT_ROWS) -> tuple[DataFrame, int]:
    """Per user of (user, _h): rows, cut prefix ``_p``, rows ``_need`` of its boundary cell, size ``_cell``.

    A first histogram over the first hash digit serves every user.  Boundary cells above
    the returned size (at most HOT_USERS of them, so broadcasting their prefixes is
    bounded) are refined one digit at a time, up to ``digits`` digits, from a written
    table of their own rows, which shrinks about sixteenfold per digit.
    """
    n_test = F.least(F.col("_rows"), F.greatest(F.lit(1), F.floor(F.col("_rows") * F.lit(float(test_size)))))
    cuts = materialize(_cut(_digit_counts(hashed, user_col, 1), user_col, F.lit(""), n_test), "split-cuts")
    total, most = cuts.agg(F.sum("_rows"), F.max("_cell")).first()
    least = max(hot_rows, (total or 0) // HOT_USERS)
    rows, at = hashed, 1
    while (most or 0) > least and at < digits:
        at += 1
        big = cuts.where(F.col("_cell") > least)
        inside = rows.join(F.broadcast(big.select(user_col, "_p")), user_col).where(F.col("_h").startswith(F.col("_p")))
        rows, before = materialize(inside.select(user_col, "_h"), "split-boundary"), rows
        finer = _digit_counts(rows, user_col, at).drop("_rows").join(F.broadcast(big), user_col)
        finer = _cut(finer, user_col, F.col("_p"), F.col("_need"))
        cuts, old = materialize(cuts.where(F.col("_cell") <= least).unionByName(finer), "split-cuts"), cuts
        most = cuts.agg(F.max("_cell")).first()[0]
        drop_scratch(old, before)
    if at > 1:
        drop_scratch(rows)
    return cuts, least


def holdout_flag(df: DataFrame, test_size: float = 0.2, seed: int = 42, user_col: str = "user_id",
                 item_col: str = "artist_name", digits: int = 4, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Flag ``max(1, floor(n * test_size))`` rows of each user as test.

    The rows of a user are ordered by ``md5(user:item:seed)`` (then plays, mbid,
    raw name), a seeded pseudo-random order that is the same in every engine.

    Selection instead of sorting: digit histograms give each user the hash cell in
    which its last test row lies.  Rows below that cell are test, rows above it train,
    without an order; only the rows of the cell itself (about a sixteenth, less for hot
    users) are numbered.  The full rows meet the cuts in a hash join and are never
    sorted; users above ``hot_rows`` rows and 1 / HOT_USERS of all rows (so at most
    HOT_USERS) meet a broadcast instead and are not shuffled at all.
    """
    h = F.md5(F.concat_ws(":", F.col(user_col), F.col(item_col), F.lit(str(seed))))
    cuts, least = holdout_cuts(df.select(user_col, h.alias("_h")), test_size, user_col, digits, hot_rows)
    hot, cold = cuts.where(F.col("_rows") > least), cuts.where(F.col("_rows") <= least)
    cut = ["_p", "_need"]
    # The hash is taken again after the join: shuffled along, its digits would be the largest column.
    met = df.join(cold.select(user_col, *cut).hint("shuffle_hash"), user_col).withColumn("_h", h)
    if not hot.isEmpty():
        hot = F.broadcast(hot.select(user_col, *cut))
        met = (df.join(hot, user_col, "left_anti").join(cold.select(user_col, *cut).hint("shuffle_hash"), user_col)
               .unionByName(df.join(hot, user_col)).withColumn("_h", h))
    met = met.withColumn("_head", F.substring(F.col("_h"), F.lit(1), F.length("_p")))
    order = [F.asc("_h")]
    if "play_count" in df.columns:
        order.append(F.asc("play_count"))
    if "artist_mbid" in df.columns:
        order.append(F.asc_nulls_last("artist_mbid"))
    if "raw_name" in df.columns:
        order.append(F.asc_nulls_last("raw_name"))
    sure = met.where(F.col("_head") != F.col("_p")).withColumn("is_test", F.col("_head") < F.col("_p"))
    edge = met.where(F.col("_head") == F.col("_p"))
    edge = edge.withColumn("is_test", F.row_number().over(Window.partitionBy(user_col).orderBy(*order)) <= F.col("_need"))
    return sure.unionByName(edge).select(*df.columns, "is_test")


def train_part(flagged: DataFrame) -> DataFrame:
    """train = the user's rows minus the held-out ones."""
    return flagged.where(~F.col("is_test")).drop("is_test")


def test_part(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col("is_test")).drop("is_test")


def split_union(train: DataFrame, test: DataFrame) -> DataFrame:
    """The two parts back together with a ``split`` label."""
    return (train.withColumn("split", F.lit("train"))
            .unionByName(test.withColumn("split", F.lit("test"))))
