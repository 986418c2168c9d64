"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are 64-bit SimHashes of word shingles.  Distinct fingerprints are put in
cells by the population counts of their four 16-bit words; two fingerprints within
``max_bits`` differing bits lie in cells whose count vectors differ by at most
``max_bits`` in L1 norm, so all other pairs of cells are skipped without losing a
link.  Cells are cut into tiles of bounded size and pairs of tiles are compared
exactly (numpy exclusive-or and bit counts); each pair of tiles returns a spanning
forest of its links, never all of them.  The tiles of a cell and those that come to it
from its neighbours are dealt over a grid of bounded squares, so that the central
cells, which grow with the data, meet in many tasks.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonearm.llm.common import lookup, ship
from tonearm.llm.components import connected_components, spanning_forest
from tonearm.session import materialize

SEED = 42
#: Fingerprints per tile: a pair of tiles is at most TILE x TILE comparisons.
TILE = 2048
#: A square of the grid holds at most GROUP tiles of a cell and about SLOT tiles that are compared with them.
GROUP, SLOT = 16, 128
#: Shingles whose bits are counted at once, which bounds memory on very long texts.
BLOCK = 1 << 16
#: Rows of a tile compared at once (TILE x STRIP words of 8 bytes).
STRIP = 256

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_BYTE = np.arange(8, dtype=np.int64) * 256


def simhash(data: bytes, words: int) -> int:
    """Unsigned fingerprint of a UTF-8 text; no words gives 0."""
    tokens = data.lower().split()  # on bytes: only A-Z and ASCII white space
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    n = max(len(tokens) - words + 1, 1)
    lens = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lens + 1) - 1
    starts = (ends - lens)[:n].tolist()
    ends = ends[-n:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at:at + BLOCK], ends[at:at + BLOCK])],
                     dtype="<u8")
        seen = np.bincount((h.view(np.uint8).reshape(-1, 8) + _BYTE).ravel(), minlength=2048)
        ones += np.einsum("bv,vk->bk", seen.reshape(8, 256), _BITS).ravel()
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            fps = [simhash(t.as_py() or b"", words) for t in texts]
            fp = pa.array(np.array(fps, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), fp],
                                             names=["doc_id", "th", "fp"])
    return run


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, th, fp): one row per input row; ``th`` hashes the text (null as empty)."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("th", F.xxhash64("text"))
    return rows.mapInArrow(_fingerprints(words), "doc_id long, th long, fp long")


def _compare(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            for left, right in zip(batch.column("a"), batch.column("b")):
                a = left.values.to_numpy(zero_copy_only=False)
                b = right.values.to_numpy(zero_copy_only=False)
                us_, vs_ = [], []
                for at in range(0, len(a), STRIP):
                    strip = a[at:at + STRIP]
                    near = np.bitwise_count(strip.view(np.uint64)[:, None] ^ b.view(np.uint64)) <= max_bits
                    i, j = np.nonzero(near)
                    x, y = strip[i], b[j]
                    x, y = x[x != y], y[x != y]
                    if len(x) > 2 * TILE:
                        x, y = spanning_forest(x, y)
                    us_.append(x)
                    vs_.append(y)
                x, y = np.concatenate(us_), np.concatenate(vs_)
                if len(x) > 2 * TILE:
                    x, y = spanning_forest(x, y)
                if len(x):
                    us.append(x)
                    vs.append(y)
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))],
                                                 names=["u", "v"])
    return run


def tile_pairs(fps: DataFrame, max_bits: int) -> DataFrame:
    """Pairs of tiles (a, b) whose cells are near, and their square (cell, group, slot) of the grid."""
    counts = [F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))) for i in range(4)]
    rows = fps.select("fp", *[c.alias(f"p{i}") for i, c in enumerate(counts)])
    cell = ["p0", "p1", "p2", "p3"]
    sizes = rows.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / F.lit(TILE)).cast("int").alias("tiles"))
    # Half of the offsets, as pairs of cells are unordered; zero compares a cell with itself.
    near = [d for d in itertools.product(range(-max_bits, max_bits + 1), repeat=4)
            if sum(map(abs, d)) <= max_bits and d >= (0, 0, 0, 0)]
    offsets = F.array(*[F.struct(*[F.lit(x).alias(f"d{i}") for i, x in enumerate(d)]) for d in near])
    target = [(F.col(f"p{i}") + F.col(f"d.d{i}")).cast("int").alias(f"p{i}") for i in range(4)]
    # At most 17^4 cells whatever the input: tables with a row per cell are bounded, and so are their broadcasts.
    sizes = materialize(sizes, "simhash-cells")
    coming = (sizes.withColumn("d", F.explode(offsets)).select(*target, F.col("tiles").alias("n"))
              .groupBy(*cell).agg(F.sum("n").alias("n")))
    grid = sizes.join(coming, cell).select(*cell, F.ceil(F.col("tiles") / F.lit(GROUP)).cast("int").alias("groups"),
                                           F.ceil(F.col("n") / F.lit(SLOT)).cast("int").alias("slots"))
    tiles = (rows.join(F.broadcast(sizes), cell)
             .withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles").cast("long")))
             .groupBy(*cell, "tile").agg(F.collect_list("fp").alias("fps")))
    tiles = materialize(tiles, "simhash-tiles")
    # Of the grid of cell x, a tile of x fills a row (its group, each slot), a tile that comes to x a column.
    home = (tiles.join(F.broadcast(grid), cell)
            .withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
            .select(*cell, F.pmod("tile", F.col("groups").cast("long")).cast("int").alias("group"), "slot",
                    F.col("tile"), F.col("fps").alias("b")))
    far = F.abs("d.d0") + F.abs("d.d1") + F.abs("d.d2") + F.abs("d.d3")
    slot = F.pmod(F.xxhash64(*cell, "tile", "d"), F.lit(1 << 30).cast("long"))
    probes = (tiles.withColumn("d", F.explode(offsets))
              .select(*target, F.col("fps").alias("a"), F.col("tile").alias("tile_a"), far.alias("far"),
                      slot.alias("spot"))
              .join(F.broadcast(grid), cell)
              .withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
              .select(*cell, "group", F.pmod("spot", F.col("slots").cast("long")).cast("int").alias("slot"),
                      "a", "tile_a", "far"))
    square = [*cell, "group", "slot"]
    pairs = probes.join(home, square).filter((F.col("far") > 0) | (F.col("tile_a") <= F.col("tile")))
    return pairs.select(*square, "a", "b")


def links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links (u, v) that span every class of ``fps`` (distinct column ``fp``) within ``max_bits``."""
    return tile_pairs(fps, max_bits).select("a", "b").mapInArrow(_compare(max_bits), "u long, v long")


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 3) -> tuple[DataFrame, DataFrame]:
    """Fingerprint rows and the class of each fingerprint.

    Returns the written table (doc_id, th, fp), a row per document row, and (fp,
    component_id, keep_id, keep_th): the smallest doc_id of the class (null if all are
    null) and the row that stands for it, by doc_id (null last) and text hash.
    Null and empty texts have fingerprint zero and link like any other; repeated rows
    are members of one class; empty tables give empty results; extra columns are not read.
    """
    ship(docs.sparkSession)
    rows = materialize(fingerprints(docs, words), "simhash-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("first")
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("low"), first), "simhash-fps")
    near = materialize(links(distinct.select("fp"), max_bits), "simhash-links")
    comp = connected_components(near).withColumnRenamed("node", "fp")
    member = distinct.join(comp, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    member = materialize(member, "simhash-members")
    best = member.groupBy("component").agg(F.min("low").alias("component_id"), F.min("first").alias("best"))
    best = best.select("component", "component_id", F.col("best.doc_id").alias("keep_id"),
                       F.col("best.th").alias("keep_th"))
    classes = lookup(member.select("fp", "component"), best, "component", ["component_id", "keep_id", "keep_th"])
    return rows, materialize(classes.drop("component"), "simhash-classes")


def simhash_components(docs: DataFrame, words: int = 3, max_bits: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``."""
    rows, classes = near_duplicates(docs, words, max_bits)
    out = lookup(rows, classes, "fp", ["component_id"])
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``docs``, all columns, with one row left of each class."""
    _, classes = near_duplicates(docs, words, max_bits)
    kept = classes.select("keep_id", "keep_th").distinct().select(
        F.coalesce("keep_id", F.lit(0)).alias("k_id"), F.col("keep_id").isNull().alias("k_none"),
        F.col("keep_th").alias("k_th"))
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    keyed = packed.select(
        "row", F.coalesce(F.col("row.doc_id").cast("long"), F.lit(0)).alias("k_id"),
        F.col("row.doc_id").isNull().alias("k_none"),
        F.xxhash64(F.coalesce(F.col("row.text"), F.lit(""))).alias("k_th"))
    one = keyed.join(kept, ["k_id", "k_none", "k_th"], "left_semi")
    # Rows with the same id and text that survive together are one document.
    order = Window.partitionBy("k_id", "k_none", "k_th").orderBy(F.xxhash64("row"))
    return one.withColumn("nth", F.row_number().over(order)).filter("nth = 1").select("row.*")
