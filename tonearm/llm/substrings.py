"""Substring deduplication by seed and extend.

Seeds are winnowed anchors: every window of ``length`` words has as its anchor the
smallest hash among its ``gram``-word grams (the leftmost of equal ones), so equal
windows have equal anchors at equal places.  Occurrences of an anchor are joined on its
hash.  What an occurrence owns, the words of all windows that it is the anchor of, is its
context: occurrences with equal contexts repeat each other whole, and all but the first
are settled at once.  Where an anchor occurs in several contexts, the match is extended
both ways from the seed: every window that the first occurrence of a context owns, from
the leftmost to the rightmost, is looked up by a 128-bit hash of its words.  The windows
that repeat an earlier one merge to maximal repeats of at least ``length`` words.

No pair of documents is ever emitted.  Tasks keep the first occurrence in a batch of
documents before anything is shuffled, so a key gets at most one row per batch however
often its passage occurs; the rows that this settles are shuffled without a key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonearm.llm.common import lookup, ship
from tonearm.session import materialize

#: Words of a window: the shortest repeat that counts.
LENGTH = 20
#: Words of an anchor.
GRAM = 8
#: A batch of documents is handled in groups of about so many bytes.
GROUP_BYTES = 8 << 20
#: Bytes of a text cut into words at once, which bounds the list of words.
PIECE = 1 << 22
#: Words whose hashes are remembered.
REMEMBERED = 1 << 18

_R = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_R_INVERSE = pow(_R, -1, 1 << 64)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def word_hashes(text: bytes, known: dict) -> np.ndarray:
    """A 64-bit hash per word; ``known`` remembers some."""
    parts, at = [], 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        words = text[at:end].split()  # on bytes: only ASCII white space
        parts.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def seeds(texts: list[np.ndarray], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text number, anchor hash, context hash, first window, windows) of every anchor of the texts' word hashes."""
    sizes = np.array([len(t) for t in texts], np.int64)
    words = np.concatenate(texts) if texts else np.zeros(0, np.uint64)
    offset = np.cumsum(sizes) - sizes
    of = np.repeat(np.arange(len(texts)), sizes)
    windows = np.flatnonzero(of[:len(of) - length + 1] == of[length - 1:]) if len(words) >= length else of[:0]
    if not len(windows):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    # All texts are one run of words; grams and windows over an end are not asked for.
    grams = len(words) - gram + 1
    h = np.zeros(grams, np.uint64)
    for j in range(gram):
        h = h * np.uint64(_R) + words[j:j + grams]
    h = _mixed(h)
    # The leftmost smallest gram of each window, by minima over doubling spans.
    span, best, need = 1, np.arange(grams), length - gram + 1
    while span < need:
        step = min(span, need - span)
        left, right = best[:len(best) - step], best[step:]
        best = np.where(h[right] < h[left], right, left)
        span += step
    best = best[windows]
    at = np.flatnonzero(np.diff(best, prepend=-1))
    first, last, anchor = windows[at], windows[np.append(at[1:], len(windows)) - 1], best[at]
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * _powers(_R, len(words)), dtype=np.uint64)])
    context = (prefix[last + length] - prefix[first]) * _powers(_R_INVERSE, len(words))[first]
    place = (anchor - first).astype(np.uint64) << np.uint64(32) | (last - first).astype(np.uint64)
    text = of[first]
    return (text, h[anchor].view(np.int64), _mixed(context ^ _mixed(place)).view(np.int64), first - offset[text],
            last - first + 1)


def _in_order(batch: pa.RecordBatch) -> list[int]:
    """Row numbers of a batch in document order (doc_id, null last, then text hash), each document once."""
    keys = zip(batch.column("doc_id").to_pylist(), batch.column("th").to_pylist())
    first: dict[tuple, int] = {}
    for k, (i, t) in enumerate(keys):
        first.setdefault((i is None, i or 0, t), k)
    return [k for _, k in sorted(first.items())]


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(row numbers, texts) of a batch in document order, in groups of bounded size."""
    column, rows, texts, size = batch.column("text"), [], [], 0
    for k in _in_order(batch):
        rows.append(k)
        texts.append((column[k].as_py() or "").encode())
        size += len(texts[-1])
        if size >= GROUP_BYTES:
            yield np.array(rows), texts
            rows, texts, size = [], [], 0
    if rows:
        yield np.array(rows), texts


#: What a row of a seed stands for.
BY_KEY, REPEATS, AMBIGUOUS = 0, 1, 2


def _seed_rows(length: int, gram: int):
    """Rows of anchors: one keyed row per anchor hash and group, and the settled ones.

    The earliest occurrence in the group is the keyed row, which ``many`` tells that the
    group holds several contexts of the anchor.  Of the others, those that repeat an
    earlier context of the group are settled, and those that begin a further context are
    known to be ambiguous.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            for rows, texts in _groups(batch):
                text, anchor, context, first, n = seeds([word_hashes(t, known) for t in texts], length, gram)
                if not len(text):
                    continue
                # Occurrences are in document order, so the first of equal ones is the earliest.
                nth = np.arange(len(text))
                by_context = np.lexsort((nth, context, anchor))
                a, c = anchor[by_context], context[by_context]
                other = np.append(True, a[1:] != a[:-1])
                new = other | np.append(True, c[1:] != c[:-1])
                rep = np.zeros(len(text), bool)
                rep[by_context] = new
                of = np.cumsum(other) - 1
                lead = np.minimum.reduceat(by_context, np.flatnonzero(other))
                many = np.add.reduceat(new.astype(np.int64), np.flatnonzero(other)) > 1
                state = np.where(rep, AMBIGUOUS, REPEATS)
                state[lead] = BY_KEY
                several = np.zeros(len(text), bool)
                several[by_context] = many[of]
                take = pa.array(rows[text])
                # start, words and the flags are one number that sorts by start
                place = (first << 32) | ((n + length - 1) << 8) | (several << 2) | state
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(context), batch.column("doc_id").take(take),
                     batch.column("th").take(take), pa.array(place)],
                    names=["anchor", "context", "doc_id", "th", "place"])
    return run


def repeated_spans(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(doc_id, th, start, words, sure) of the spans that repeat an earlier one (sure), and of
    those whose windows are still to be looked up; docs are (doc_id, th, text)."""
    rows = docs.mapInArrow(_seed_rows(length, gram), "anchor long, context long, doc_id long, th long, place long")
    state = F.col("place").bitwiseAND(F.lit(3))
    # Only keyed rows meet; the others are spread by a number of their own.
    lot = 1 + F.pmod(F.xxhash64("doc_id", "th", "place"), F.lit(1 << 40))
    rows = rows.withColumn("lot", F.when(state == BY_KEY, F.lit(0).cast("long")).otherwise(lot))
    start = F.shiftright("place", 32)
    order = [F.col("doc_id").isNull(), "doc_id", "th", start]
    group = Window.partitionBy("anchor", "lot")
    same = Window.partitionBy("anchor", "lot", "context").orderBy(*order)
    rows = rows.select(
        "doc_id", "th", start.cast("int").alias("start"),
        F.shiftright("place", 8).bitwiseAND(F.lit(0xFFFFFF)).cast("int").alias("words"), state.alias("state"),
        # equal places of repeated rows are one occurrence, so rank and not row_number
        (F.rank().over(same) > 1).alias("later"),
        ((F.min("context").over(group) != F.max("context").over(group))
         | (F.max(F.col("place").bitwiseAND(F.lit(4))).over(group) > 0)).alias("several"))
    keyed = F.col("state") == BY_KEY
    sure = F.when(keyed, F.col("later")).otherwise(F.col("state") == REPEATS)
    rows = rows.withColumn("sure", sure).filter(F.col("sure") | (F.col("state") == AMBIGUOUS) | F.col("several"))
    return rows.select("doc_id", "th", "start", "words", "sure")


def _mask(n: int, starts: list[int], ends: list[int]) -> np.ndarray:
    """Which of n words lie in a span."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.array(starts, np.int64), 1)
    np.add.at(edge, np.array(ends, np.int64), -1)
    return np.cumsum(edge[:-1]) > 0


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


def _kept(words: list[bytes], mask: np.ndarray, digest: bool) -> str:
    text = b" ".join(w for w, gone in zip(words, mask.tolist()) if not gone)
    return hashlib.sha256(text).hexdigest() if digest else text.decode()


def _row(words: list[bytes], mask: np.ndarray, digest: bool) -> dict:
    starts, ends = _runs(mask)
    return {"n_words": len(words), "repeats": [{"start": a, "end": b} for a, b in zip(starts.tolist(), ends.tolist())],
            "kept": _kept(words, mask, digest)}


_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_OPEN = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("n_words", pa.int64()), ("repeats", pa.list_(_SPAN)),
                   ("kept", pa.string()), ("text", pa.string()),
                   ("asked", pa.list_(pa.struct([("start", pa.int32()), ("hash", pa.binary())])))])
_DONE = "doc_id long, th long, n_words long, repeats array<struct<start:int,end:int>>, kept string"


def _extend(length: int, digest: bool):
    """Extends ambiguous seeds: hashes the windows they own.  A document without any left is done."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ths = batch.column("doc_id").to_pylist(), batch.column("th").to_pylist()
            seen: set[bytes] = set()
            rows: dict[tuple, dict] = {}
            for k in _in_order(batch):
                text = batch.column("text")[k].as_py() or ""
                words = text.encode().split()
                spans = batch.column("spans")[k].as_py() or []
                cover = [(s["start"], s["start"] + s["words"]) for s in spans if s["sure"]]
                windows = sorted({w for s in spans if not s["sure"]
                                  for w in range(s["start"], s["start"] + s["words"] - length + 1)})
                asked = []
                if windows:
                    flat = b" ".join(words)
                    begin = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)])
                    for w, a, b in zip(windows, begin[windows].tolist(), begin[np.array(windows) + length].tolist()):
                        h = hashlib.blake2b(flat[a:b - 1], digest_size=16).digest()
                        if h in seen:  # an earlier one is in this batch
                            cover.append((w, w + length))
                        else:
                            seen.add(h)
                            asked.append({"start": w, "hash": h})
                mask = _mask(len(words), [a for a, _ in cover], [b for _, b in cover])
                row = {"text": None, "asked": []} | _row(words, mask, digest)
                rows[ids[k], ths[k]] = row | {"kept": None, "text": text, "asked": asked} if asked else row
            for at in range(0, len(ids), 256):
                yield pa.RecordBatch.from_pylist(
                    [{"doc_id": i, "th": t} | rows[i, t] for i, t in zip(ids[at:at + 256], ths[at:at + 256])], _OPEN)
    return run


def _finish(length: int, digest: bool):
    """Documents whose last windows were looked up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(list(_OPEN)[:5])
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                words, late = (r["text"] or "").encode().split(), r["late"] or []
                mask = _mask(len(words), [s["start"] for s in r["repeats"]] + late,
                             [s["end"] for s in r["repeats"]] + [w + length for w in late])
                out.append({"doc_id": r["doc_id"], "th": r["th"]} | _row(words, mask, digest))
            yield pa.RecordBatch.from_pylist(out, schema)
    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, digest: bool = False) -> DataFrame:
    """(doc_id, n_words, repeats, kept) for every row of (doc_id, text).

    Words are runs of anything but ASCII white space.  A word goes if a window of
    ``length`` words that covers it also starts earlier: in a document with a smaller
    doc_id (null last; documents of one id by a hash of the text) or further left in the
    same one.  ``repeats`` are the maximal runs of such words as spans [start, end) of
    word numbers, and ``kept`` is the rest, joined by one space, or its SHA-256 with
    ``digest``.  Windows are judged on the input.  Equality of windows is that of their
    context hashes (64 bits beside the 64 of the anchor) or of 128-bit hashes.

    Of rows equal in doc_id and text one counts as the earliest; the others lose every
    word if they have a window.  Null texts have no words; texts under ``length`` words
    lose none; texts of any length are taken whole; an empty table gives no rows; extra
    columns are not read.
    """
    if not 1 <= gram <= length:
        raise ValueError("gram lies between 1 and length")
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("th"), "text")
    key = F.struct("doc_id", "th")
    spans = materialize(repeated_spans(rows, length, gram), "repeat-spans")
    # A document's spans: no more than its words.
    by_doc = spans.groupBy(key.alias("key")).agg(F.collect_set(F.struct("start", "words", "sure")).alias("spans"))
    # Rows of one document meet its spans; only a document repeated as a whole row is a hot key.
    copies = materialize(rows.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "repeat-copies")
    told = lookup(rows.withColumn("key", key), by_doc, "key", ["spans"], seen=copies, counted=True).drop("key")
    schema = _DONE + ", text string, asked array<struct<start:int,hash:binary>>"
    told = materialize(told.mapInArrow(_extend(length, digest), schema), "repeat-open")

    done = told.filter("text IS NULL").select("doc_id", "th", "n_words", "repeats", "kept")
    open_ = told.filter("text IS NOT NULL")
    windows = open_.select("doc_id", "th", F.explode("asked").alias("w")).select("doc_id", "th", "w.start", "w.hash")
    order = Window.partitionBy("hash").orderBy(F.col("doc_id").isNull(), "doc_id", "th", "start")
    late = (windows.withColumn("nth", F.rank().over(order)).filter("nth > 1").groupBy(key.alias("key"))
            .agg(F.collect_set("start").alias("late")))
    rest = lookup(open_.select("doc_id", "th", "text", "repeats", key.alias("key")), late, "key", ["late"],
                  seen=copies, counted=True)
    rest = rest.select("doc_id", "th", "text", "repeats", "late").mapInArrow(_finish(length, digest), _DONE)
    out = materialize(done.unionByName(rest), "repeat-done")

    # Equal rows have equal results: the first keeps its own, the further ones lose every word.
    again = lookup(out.withColumn("key", key), copies, "key", ["n"], seen=copies, counted=True)
    single = again.filter("n IS NULL").drop("n", "key")
    columns = ["doc_id", "n_words", "repeats", "kept"]
    many = again.filter("n IS NOT NULL").groupBy("doc_id", "th", "n_words", "repeats", "kept").agg(F.count(F.lit(1)).alias("n"))
    gone = F.lit(hashlib.sha256(b"").hexdigest() if digest else "")
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    many = many.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    lost = (F.col("nth") > 1) & (F.col("n_words") >= length)
    many = many.select("doc_id", "n_words", F.when(lost, whole).otherwise(F.col("repeats")).alias("repeats"),
                       F.when(lost, gone).otherwise(F.col("kept")).alias("kept"))
    return single.select(*columns).unionByName(many)


def repeat_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of ``docs``."""
    rows = remove_repeats(docs, length, digest=True)
    removed = F.aggregate("repeats", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return rows.select("doc_id", "n_words", removed.alias("n_removed"), F.col("kept").alias("kept_sha256"))
