"""Mixing sources to target weights, with DataFrame functions only.

Documents get hash-random keys.  The keys are uniform, so cutting their range evenly
sorts each source into ranges of about RANGE_ROWS rows whatever the source's share;
running word counts come from three bounded levels (rows in a range, ranges in a
group, groups in a source).  Each source is cut at its exact word budget; a budget
above the source's size first repeats the whole source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonearm.llm.common import WORD, lookup, positions
from tonearm.session import materialize

RANGE_ROWS = 256
WEIGHTS = (1.0, 2.0, 3.0)
MAX_EPOCHS = 3
SEED = 7
#: Equal rows are dealt out in lots of so many.
COPIES = 1000


def word_count(text: Column) -> Column:
    """Runs of non-white-space; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """sources (source, source_size) plus ``target``.

    Source i in code-point order (null last) has weight ``weights[i % len]``.  A level
    t gives source s the words min(weight_s * t, max_epochs * size_s); the level where
    these sum to all words is found from prefix sums over the sources sorted by the
    level at which they fill up.
    """
    ranked = positions(sources, [F.col("source").asc_nulls_last()], "mix-sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("pos") % len(weights) + 1).cast("int"))
    ranked = ranked.select("source", "source_size", weight.alias("weight"))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    full = positions(ranked.withColumn("level", F.col("cap") / F.col("weight")),
                     [F.col("level"), F.col("source").asc_nulls_last()], "mix-levels")
    full = materialize(full, "mix-levels-ranked")
    # Sums before each position, in blocks so that no task gets every source.
    block = F.floor(F.col("pos") / 1000)
    sums = full.groupBy(block.alias("block")).agg(F.sum("cap").alias("c"), F.sum("weight").alias("w"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("block", F.coalesce(F.sum("c").over(before), F.lit(0.0)).alias("c0"),
                       F.coalesce(F.sum("w").over(before), F.lit(0.0)).alias("w0"))
    within = Window.partitionBy("block").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    at = full.withColumn("block", block).join(sums, "block").select(
        "*", (F.col("c0") + F.coalesce(F.sum("cap").over(within), F.lit(0.0))).alias("c_before"),
        (F.col("w0") + F.coalesce(F.sum("weight").over(within), F.lit(0.0))).alias("w_before"))
    total = full.agg(F.sum("source_size").alias("all_size"), F.sum("weight").alias("all_weight"))
    level = ((F.col("all_size") - F.col("c_before")) / (F.col("all_weight") - F.col("w_before"))).alias("t")
    water = (at.join(F.broadcast(total)).select("pos", "level", level).filter("t <= level")
             .agg(F.min(F.struct("pos", "t")).alias("m")).select(F.col("m.t").alias("t")))
    target = F.least(F.col("weight") * F.coalesce("t", F.lit(0.0)), F.col("cap"))
    return full.join(F.broadcast(water)).select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
        seed: int = SEED) -> DataFrame:
    """(row, size, source_size, target, epochs, part, taken) per row of ``docs``; ``row`` packs its columns.

    taken = whole epochs of the document plus the words of the last, partial epoch,
    whose documents come in hash-random order until the budget (the target, rounded)
    is used up; the document at the cut gives only the words that still fit, so
    each source takes exactly its budget.
    Null texts have 0 words and take 0; a null source is a source of its own; repeated
    rows are documents of their own; an empty table gives no rows; extra columns stay
    inside ``row`` and cannot clash.
    """
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    rows = rows.select("row", word_count(F.col("row.text")).alias("size"), F.col("row.source").alias("source"),
                       F.xxhash64(F.lit(seed), "row.doc_id", "row.text").alias("h"))
    return _cut(rows, weights, max_epochs)


def _keys_of_copies(rows: DataFrame) -> DataFrame:
    """``rows`` with a random key of its own for each of several equal rows.

    Rows with a key of their own pass as they are.  The others are counted first, row by
    row (partial sums, so a third of all rows being equal is no hot task), and a count is
    dealt out again in lots of COPIES; the copies of a row are numbered, so reruns agree.
    """
    repeated = materialize(rows.groupBy("h").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1"), "mix-copies")
    if repeated.isEmpty():
        return rows
    marked = lookup(rows, repeated, "h", ["copies"], seen=repeated.withColumnRenamed("copies", "n"), counted=True)
    equal = marked.filter("copies IS NOT NULL").groupBy("row", "size", "source", "h").agg(F.count(F.lit(1)).alias("n"))
    lots = equal.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES))))
    lots = lots.repartition("h", "lot")
    first, last = F.col("lot") * COPIES, F.least(F.col("n"), (F.col("lot") + 1) * COPIES) - 1
    copies = lots.withColumn("i", F.explode(F.sequence(first, last)))
    # Rows that share a key but differ elsewhere get keys that differ too.
    key = F.xxhash64("h", F.xxhash64("row"), "i")
    return marked.filter("copies IS NULL").drop("copies").unionByName(
        copies.select("row", "size", "source", key.alias("h")))


def _cut(rows: DataFrame, weights: tuple[float, ...], max_epochs: int) -> DataFrame:
    """The mix of rows (row, size, source, h); ``h`` is the random key."""
    rows = _keys_of_copies(rows)
    total = rows.select("size").count()
    ranges = max(1, math.ceil(total / RANGE_ROWS))
    groups = max(1, math.isqrt(ranges))
    unit = (F.shiftrightunsigned("h", 11).cast("double") * 2.0 ** -53).alias("key")
    rows = rows.select("row", "size", F.coalesce("source", F.lit("")).alias("s"),
                       F.col("source").isNull().alias("s_null"), unit, F.xxhash64("row").alias("tie"))
    rows = rows.withColumn("range", F.floor(F.col("key") * ranges))
    light = materialize(rows.groupBy("s", "s_null", "range").agg(F.sum("size").alias("words")), "mix-ranges")
    sources = light.groupBy("s", "s_null").agg(F.sum("words").alias("source_size"))
    budget = targets(sources.select(F.when(~F.col("s_null"), F.col("s")).alias("source"), "source_size"),
                     weights, max_epochs)
    budget = budget.select(F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("s_null"),
                           "source_size", "target")
    earlier = lambda *by, order: Window.partitionBy(*by).orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1)
    src = ["s", "s_null"]
    fine = light.withColumn("grp", F.floor(F.col("range") * groups / ranges))
    coarse = fine.groupBy(*src, "grp").agg(F.sum("words").alias("words"))
    coarse = coarse.select(*src, "grp", F.coalesce(F.sum("words").over(earlier(*src, order="grp")), F.lit(0)).alias("g0"))
    fine = fine.withColumn("r0", F.coalesce(F.sum("words").over(earlier(*src, "grp", order="range")), F.lit(0)))
    start = (fine.join(coarse, [*src, "grp"]).join(budget, src)
             .select(*src, "range", (F.col("g0") + F.col("r0")).alias("start"), "source_size", "target"))
    start = materialize(start, "mix-starts")
    order = Window.partitionBy(*src, "range").orderBy("key", "tie", "size").rowsBetween(Window.unboundedPreceding, -1)
    at = rows.withColumn("run", F.coalesce(F.sum("size").over(order), F.lit(0))).join(start, [*src, "range"])
    words = F.least(F.round("target").cast("long"), F.col("source_size") * max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long")
    rest = words - epochs * F.col("source_size")
    part = F.least("size", F.greatest(rest - F.col("start") - F.col("run"), F.lit(0)))
    return at.select("row", "size", "source_size", "target", epochs.alias("epochs"), part.cast("long").alias("part"),
                     (epochs * F.col("size") + part).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, in the columns of ``docs``: a document that takes n whole copies of
    its words appears n times; the one document at a source's cut appears once more with
    its first words, joined by single spaces (``n_chars``, if there, is its new length).
    """
    mixed = mix(docs, **options)
    whole = F.col("epochs") + (F.col("part") == F.col("size")).cast("long")
    cut = (F.col("part") > 0) & (F.col("part") < F.col("size"))
    words = F.split(F.trim(F.regexp_replace(F.col("row.text"), r"[\x20\x09-\x0D]+", " ")), " ")
    short = F.array_join(F.slice(words, F.lit(1), F.greatest(F.col("part"), F.lit(0)).cast("int")), " ")
    shorter = F.col("row").withField("text", short)
    if "n_chars" in docs.columns:
        shorter = shorter.withField("n_chars", F.length(short).cast(docs.schema["n_chars"].dataType))
    # Documents without words are in every whole epoch of their source; a source that has none left out.
    copies = F.concat(F.array_repeat(F.col("row"), whole.cast("int")),
                      F.when(cut, F.array(shorter)).otherwise(F.array_repeat(F.col("row"), 0)))
    return mixed.select(F.explode(copies).alias("row")).select("row.*")


def mix_counts(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
               seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of ``docs``; texts are read once."""
    rows = docs.select(F.struct("doc_id").alias("row"), word_count(F.col("text")).alias("size"), "source",
                       F.xxhash64(F.lit(seed), "doc_id", "text").alias("h"))
    mixed = _cut(materialize(rows, "mix-sizes"), weights, max_epochs)
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")
