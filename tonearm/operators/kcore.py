"""K1: iterative bipartite (user, artist) core filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.session import checkpoint_dir, drop_scratch, materialize


def kcore_round(df: DataFrame, min_user: int, min_artist: int, user_col: str = "user_id",
                item_col: str = "artist_name") -> DataFrame:
    """One round: drop users with < min_user rows, then artists with < min_artist rows.

    Counts are rows (not distinct partners), as in the reference.  Each count is
    a partial aggregation; the filters are left-semi joins, which AQE turns into
    broadcast joins when the surviving key set is measured small and splits when
    one key is skewed.
    """
    users = df.groupBy(user_col).count().where(F.col("count") >= min_user).select(user_col)
    step = df.join(users, user_col, "left_semi")
    items = step.groupBy(item_col).count().where(F.col("count") >= min_artist).select(item_col)
    return step.join(items, item_col, "left_semi")


#: Rounds rewrite the surviving pairs while they remove more than this share of the rows; then only the frontier moves.
REWRITE_SHARE = 0.05
#: Written tables of removed nodes and lost rows are merged when there are so many.
MERGE_AT = 8
#: Removed nodes are broadcast to the rows up to so many of a side; above, the survivors are joined.
MAX_BROADCAST_NODES = 500_000


def kcore_filter(df: DataFrame, min_user: int = 5, min_artist: int = 3, user_col: str = "user_id",
                 item_col: str = "artist_name", rewrite_share: float = REWRITE_SHARE) -> tuple[DataFrame, list[dict]]:
    """Repeat :func:`kcore_round` until a round removes nothing, however many rounds that takes.

    The fixpoint is unique, so the result does not depend on the execution
    order.  The rows are written once (a table of :func:`materialize` is taken as it is);
    the rounds run over their (user, artist) pairs.  A row stays exactly if neither its
    user nor its artist is ever removed, so rounds write the removed nodes, and few of
    them are broadcast to the rows: neither a round nor the last selection shuffles the
    rows then, and the result is the written rows without the removed nodes, not a second
    copy.  A round counts each side once and writes the counts.  While rounds remove much,
    each writes the surviving pairs; once a round removes at most ``rewrite_share`` of the
    rows, the pairs stay as they are and :class:`_Frontier` goes on from that round's
    counts, following only the removed nodes and their neighbours.  Everything kept is a
    parquet table in the session's shared checkpoint folder, so a lost executor replays
    one round, not all of them.  Returns the filtered frame and per-round row counts; the
    last entry is the confirming round that removes nothing.
    """
    checkpoint_dir(df.sparkSession)
    written = getattr(df, "_scratch_path", None) is not None
    source = df if written else materialize(df, "kcore-0")
    cur = source.select(user_col, item_col, F.lit(1).cast("long").alias("_n"))
    rows = source.count()
    history = [{"round": 0, "rows": rows}]
    removed_users, removed_items = [], []
    while True:
        named = cur.where(F.col(user_col).isNotNull() & F.col(item_col).isNotNull())
        by_user = materialize(_degrees(named, user_col), "kcore-degrees")
        users = materialize(_low(by_user, user_col, min_user), "kcore-low")
        step = _without(named, [users], user_col)
        by_item = materialize(_degrees(step, item_col), f"kcore-{len(history)}")
        items = materialize(_low(by_item, item_col, min_artist), "kcore-low")
        removed_users.append(users)
        removed_items.append(items)
        left = by_item.where(F.col("_c") >= min_artist).agg(F.sum("_c")).first()[0] or 0
        history.append({"round": len(history), "rows": left})
        removed, rows = rows - left, left
        if removed <= rewrite_share * (rows + removed):
            break
        step = materialize(_without(step, [items], item_col), "kcore-pairs")
        drop_scratch(cur, by_user, by_item)
        cur = step
    if removed:
        peeled = _Frontier(named, _Side(by_user, user_col, min_user, users), _Side(by_item, item_col, min_artist, items))
        for left in peeled.rounds(rows):
            history.append({"round": len(history), "rows": left})
        removed_users[-1:], removed_items[-1:] = peeled.users.gone, peeled.items.gone
        peeled.drop()
    else:
        drop_scratch(by_user, by_item)
    drop_scratch(cur)
    if history[-1]["rows"] == history[0]["rows"]:
        drop_scratch(*removed_users, *removed_items)
        return source, history
    gone = [materialize(_Side._all(tables), "kcore-removed") for tables in (removed_users, removed_items)]
    drop_scratch(*removed_users, *removed_items)
    out = source.where(F.col(user_col).isNotNull() & F.col(item_col).isNotNull())
    out = _without(_without(out, gone[:1], user_col), gone[1:], item_col)
    if max(_size(gone[:1]), _size(gone[1:])) > MAX_BROADCAST_NODES:
        out = materialize(out, "kcore")
        drop_scratch(*gone, *([] if written else [source]))
    return out, history


def _degrees(pairs: DataFrame, col: str) -> DataFrame:
    """Each node of a side with its rows."""
    return pairs.groupBy(col).agg(F.sum("_n").alias("_c"))


def _low(degrees: DataFrame, col: str, least: int) -> DataFrame:
    """The nodes of a side with fewer than ``least`` rows."""
    return degrees.where(F.col("_c") < least).select(col)


def _size(tables: list[DataFrame]) -> int:
    return sum(t.count() for t in tables)


def _few(nodes: DataFrame, n: int) -> DataFrame:
    return F.broadcast(nodes) if n <= MAX_BROADCAST_NODES else nodes


def _without(rows: DataFrame, gone: list[DataFrame], col: str) -> DataFrame:
    """The rows whose ``col`` (not null) is in none of the ``gone`` tables; few nodes are broadcast."""
    n = _size(gone)
    if not n:
        return rows
    return rows.join(_few(_Side._all(gone), n), col, "left_anti").select(*rows.columns)


class _Side:
    """The nodes of one side: row counts at the start, rows lost since, and who is gone."""

    def __init__(self, degrees: DataFrame, col: str, least: int, gone: DataFrame):
        self.degrees, self.col, self.least = degrees, col, least
        self.gone: list[DataFrame] = [gone]
        self.lost: list[DataFrame] = []

    @staticmethod
    def _all(tables: list[DataFrame]) -> DataFrame:
        out = tables[0]
        for t in tables[1:]:
            out = out.unionByName(t)
        return out

    def below(self, touched: DataFrame) -> DataFrame:
        """The ``touched`` nodes (which are still there) that have fallen below the bound."""
        lost = (self._all(self.lost).join(touched.select(self.col), self.col, "left_semi")
                .groupBy(self.col).agg(F.sum("_n").alias("_lost")))
        left = self.degrees.join(lost, self.col).select(self.col, (F.col("_c") - F.col("_lost")).alias("_c"))
        return left.where(F.col("_c") < self.least).select(self.col)

    def remove(self, nodes: DataFrame) -> DataFrame:
        table = materialize(nodes, "kcore-gone")
        self._add(self.gone, table, lambda t: t)
        return table

    def lose(self, rows: DataFrame) -> DataFrame:
        table = materialize(rows.groupBy(self.col).agg(F.sum("_n").alias("_n")), "kcore-lost")
        self._add(self.lost, table, lambda t: t.groupBy(self.col).agg(F.sum("_n").alias("_n")))
        return table

    def _add(self, tables: list[DataFrame], new: DataFrame, merge) -> None:
        tables.append(new)
        if len(tables) > MERGE_AT:
            old = tables[:-1]  # the newest is still read by the caller
            tables[:] = [materialize(merge(self._all(old)), "kcore-merged"), new]
            drop_scratch(*old)

    def drop_counts(self) -> None:
        """Delete all but the removed nodes."""
        drop_scratch(self.degrees, *self.lost)


class _Frontier:
    """Peels a table of pairs that stays as written: each round scans it for the pairs of the
    nodes removed in that round and takes their rows from their neighbours' counts.

    A round writes the removed nodes and their neighbours' losses, and shuffles no more
    than the pairs these name, so what it writes shrinks with the frontier (tables of past
    rounds are merged now and then).  Rounds are those of :func:`kcore_round`: users
    first, then artists by what is left.  No key of the pairs is null; the sides start
    with the counts and removed nodes of the round before.
    """

    def __init__(self, pairs: DataFrame, users: _Side, items: _Side):
        self.pairs, self.users, self.items = pairs, users, items

    def _losses(self, side: _Side, other: _Side, nodes: DataFrame) -> DataFrame:
        """The neighbours of removed ``nodes`` of one side that are still there, with the rows they lose; written."""
        hit = self.pairs.join(_few(nodes, nodes.count()), side.col, "left_semi")
        return other.lose(_without(hit, other.gone, other.col))

    def _peel(self, side: _Side, other: _Side, nodes: DataFrame) -> tuple[int, DataFrame]:
        """Remove ``nodes`` of one side; returns the rows lost and, if any, the neighbours that lost them."""
        table = side.remove(nodes)
        if table.isEmpty():
            return 0, table
        losses = self._losses(side, other, table)
        return losses.agg(F.sum("_n")).first()[0] or 0, losses

    def rounds(self, rows: int):
        """Row counts after each further round, the confirming one included.

        The first round found its artists among the rows without its users, so only the
        users' losses to those artists are still to be counted.
        """
        touched = self._losses(self.items, self.users, self.items.gone[0])
        while True:
            lost_u, hit = self._peel(self.users, self.items, self.users.below(touched))
            lost_i = 0
            if lost_u:
                lost_i, touched = self._peel(self.items, self.users, self.items.below(hit))
            rows -= lost_u + lost_i
            yield rows
            if not lost_i:  # no user has lost a row since the users were looked at
                if lost_u:
                    yield rows
                return

    def drop(self) -> None:
        self.users.drop_counts()
        self.items.drop_counts()
