"""Document fingerprints by closed syncmers, with DataFrame functions only.

A text is cut into pieces: words of at most PIECE code points, and longer runs cut at
places that only the code points there decide, so that a code point inserted in a long
run leaves the later pieces alone: after each code point of a fixed set (about a fifth
of base64, nearly all from U+0100 on).  Scripts without spaces are cut into single
code points.  Of every K consecutive pieces (a k-mer) the S-piece
substrings are hashed; the k-mer is an anchor (a closed syncmer) when the smallest
hash is the first or the last.  Whether a k-mer is an anchor depends on nothing
outside it, so an edit changes only the anchors it touches, and about
2 / (K - S + 1) of all k-mers are anchors.  The fingerprint lists every anchor of the
whole text in text order, 8 hex digits each, so two fingerprints can be matched as
sets (``likeness``) or by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonearm.llm.common import HOT_KEYS, positions
from tonearm.session import materialize

PIECE, K, S = 6, 5, 2
#: Stretches without a code point to cut after (a row of dashes) are cut every so many code points.
STRETCH = 32
#: Thai and Lao, Myanmar, Khmer, CJK and kana, and the ideographs beyond the first plane.
UNSPACED = r"\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{2E80}-\x{A4CF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}"
#: A cut follows these: some letters and digits, and separators in URLs; a quarter of the Greek and Cyrillic letters.
#: All other code points from U+0100 on are pieces of their own in a long run.
CUTS = "anjkqzANJKQZ16/&?="
GREEK_CUTS = r"\x{3B1}-\x{3B3}\x{3C1}-\x{3C3}\x{410}-\x{413}\x{420}-\x{423}\x{430}-\x{433}\x{440}-\x{443}"


def _one_by_one(skip: str = "") -> str:
    """The code points up to U+00FF but white space, listed: Java looks such a class up in one table."""
    return "".join(rf"\x{{{c:X}}}" for c in range(256) if c not in (*range(9, 14), 32) and chr(c) not in skip)


_PIECES = (rf"(?<!\S)[{_one_by_one()}]{{1,{PIECE}}}+(?!\S)"  # a short run is one piece
           rf"|[{_one_by_one(CUTS)}]{{1,{STRETCH}}}+[{CUTS}]?|[{CUTS}]"
           rf"|(?<!\S)[^\s{UNSPACED}]{{1,{PIECE}}}+(?!\S)"
           rf"|[\x{{370}}-\x{{4FF}}&&[^{GREEK_CUTS}]]{{1,{STRETCH}}}+[{GREEK_CUTS}]?|\S")
_NULL_ID = -(1 << 63)
#: Rows of one id that are handled together; the HOT_KEYS most frequent ids beyond it are dealt out.
SALT_ROWS = 1000


def with_anchors(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``: array<int>, the hashes of the text's closed syncmers in text order.

    A text in which no k-mer is an anchor (always so under K pieces) gives one anchor over
    all its pieces; a text without pieces (null, empty, white space) gives none.
    """
    t, g, z, a = (f"__{name}_{c}" for c in "tgza")
    pieces = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(_PIECES), F.lit(0))
    pair = F.zip_with(t, F.slice(t, 2, 1 << 30), lambda a, b: F.xxhash64(a, b))  # S = 2 pieces
    inner = F.slice(g, 1, F.greatest(F.size(t) - (S - 1), F.lit(0)))
    # The K - S + 1 = 4 inner hashes of each k-mer, side by side.
    wide = F.arrays_zip(F.col(g).alias("a"), F.slice(g, 2, 1 << 30).alias("b"),
                        F.slice(g, 3, 1 << 30).alias("c"), F.slice(g, 4, 1 << 30).alias("d"))
    low = lambda x: F.least(x["a"], x["b"], x["c"], x["d"])
    closed = F.filter(z, lambda x: x["d"].isNotNull() & ((x["a"] == low(x)) | (x["d"] == low(x))))
    anchors = F.transform(closed, lambda x: F.hash(x["a"], x["c"], x["d"]))
    chosen = F.when((F.size(a) > 0) | (F.size(t) == 0), F.col(a)).otherwise(F.array(F.hash(F.col(t))))
    return (df.withColumn(t, pieces).withColumn(g, pair).withColumn(g, inner).withColumn(z, wide)
            .withColumn(a, anchors).withColumn(name, chosen).drop(t, g, z, a))


def as_text(anchors: str) -> Column:
    return F.array_join(F.transform(anchors, lambda x: F.lpad(F.lower(F.hex(x.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))), 8, "0")), "")


def likeness(a: str, b: str) -> Column:
    """Jaccard likeness of two anchor sets; two empty ones are equal (1), one empty one is not (0)."""
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / both)


def frequent_ids(rows: DataFrame) -> DataFrame:
    """(kid, salts): the most frequent ids, at most HOT_KEYS, and a number for every SALT_ROWS of their rows."""
    return (rows.groupBy("kid").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SALT_ROWS)
            .orderBy(F.desc("n"), "kid").limit(HOT_KEYS)
            .select("kid", F.ceil(F.col("n") / F.lit(SALT_ROWS)).cast("int").alias("salts")))


def successors(docs: DataFrame, hot: DataFrame) -> DataFrame:
    """(pid, salts, nid, nth, nhot, need): for each distinct doc_id the next smaller one (after the
    last: the largest), that one's smallest text hash, whether it is in ``hot`` and the most code
    points an edit takes from it; ``salts`` is that of ``hot`` or 1; a null id counts as the smallest."""
    ids = docs.groupBy("kid").agg(F.max(F.floor(F.length("text") / 3)).alias("need"), F.min("th").alias("least"))
    ids = positions(ids.join(F.broadcast(hot), "kid", "left"), [F.col("kid").desc()], "fingerprint-ids")
    n = ids.count()
    after = ids.select(F.col("kid").alias("nid"), F.col("least").alias("nth"), F.col("salts").isNotNull().alias("nhot"),
                       F.pmod(F.col("pos") - 1, F.lit(max(n, 1))).alias("pos"))
    return ids.join(after, "pos").select(F.col("kid").alias("pid"), F.coalesce("salts", F.lit(1)).alias("salts"),
                                         "nid", "nth", "nhot", "need")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likenesses.

    The edited text swaps the last third of the code points for the head of the next
    document's text.  Null texts count as empty; where a doc_id is repeated each row
    is kept, and the row with the smallest text hash is the one its predecessor
    borrows from; a single document is its own successor; an empty table gives no
    rows; extra columns are not read.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("kid"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    hot = materialize(frequent_ids(rows), "fingerprint-hot")
    pairs = materialize(successors(rows, hot), "fingerprint-pairs")
    # One text for each frequent id, by partial aggregation.
    asked = pairs.filter("nhot").select(F.col("nid").alias("kid"), F.col("nth").alias("th"))
    few = (rows.join(F.broadcast(asked), ["kid", "th"]).groupBy(F.col("kid").alias("nid"))
           .agg(F.min("doc_id").alias("next_doc_id"), F.min("text").alias("text")))
    # The rows of frequent ids are dealt out; a number that another attempt deals differently changes no result.
    number = F.monotonically_increasing_id() % F.coalesce("salts", F.lit(1))
    rows = rows.join(F.broadcast(hot), "kid", "left").withColumn("salt", number.cast("int")).drop("salts")
    # Both sides use the same columns, so the texts are shuffled once for both.  The salt of the other ids is zero,
    # here computed from the id: a literal would be folded, and the texts shuffled again by the id alone.
    zero = F.pmod(F.xxhash64("nid"), F.lit(1).cast("long")).cast("int")
    first = Window.partitionBy("kid", "salt").orderBy("th")
    heads = (rows.withColumn("before", F.lag(F.lit(1)).over(first)).filter("before IS NULL")
             .join(pairs.filter("NOT nhot").withColumn("nsalt", zero),
                   (F.col("kid") == F.col("nid")) & (F.col("salt") == F.col("nsalt")))
             .select("pid", "salts", F.col("doc_id").alias("next_doc_id"), "text", "need"))
    heads = heads.unionByName(few.join(pairs.filter("nhot"), "nid")
                              .select("pid", "salts", "next_doc_id", "text", "need"))
    heads = with_anchors(heads, "text", "next_anchors").select(
        "pid", "salts", "next_doc_id", F.substring("text", F.lit(1), F.col("need").cast("int")).alias("head"),
        "next_anchors")
    # An id of many rows has the next head once per salt.
    heads = heads.withColumn("psalt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    both = rows.join(heads, (F.col("kid") == F.col("pid")) & (F.col("salt") == F.col("psalt"))).select(
        "doc_id", n.cast("long").alias("n_chars"), "text", "th", "next_doc_id", "next_anchors",
        F.concat(F.substring("text", F.lit(1), n - third), F.substring("head", F.lit(1), third)).alias("edited"))
    both = both.withColumn("edited_sha256", F.sha2(F.col("edited"), 256))
    both = with_anchors(both, "text", "anchors").drop("text")
    both = with_anchors(both, "edited", "edited_anchors").drop("edited")
    return both.select(
        "doc_id", "n_chars", "edited_sha256", as_text("anchors").alias("fingerprint"),
        as_text("edited_anchors").alias("edited_fingerprint"),
        likeness("anchors", "edited_anchors").alias("near_edited"),
        likeness("anchors", "next_anchors").alias("near_next"), "next_doc_id", F.hex("th").alias("text_hash"))
