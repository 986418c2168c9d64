"""Language identification with error-correcting output codes.

Every language gets a binary codeword.  For each bit a binary classifier over hashed
character 1- to 3-grams (naive Bayes log odds) says how likely the bit is set; the
codeword with the least weighted loss wins, each bit weighing as much as its
classifier was right on training texts of that language (loss-weighted decoding).
A text is ambiguous when the runner-up's loss is about as small, or when more bits
disagree with the chosen codeword than the code corrects.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonearm.llm.common import ship
from tonearm.session import materialize

#: Training texts per language, picked by hash: the documented bound of the fitted sample.
SAMPLE_PER_LANG = 2000
#: The shares of so many languages, the most frequent ones, are broadcast to draw the sample; the rows of
#: rarer languages, each under 1 / BROADCAST_LANGS of all rows, meet theirs in a shuffle.
BROADCAST_LANGS = 1000
BUCKETS = 1 << 15
#: Code points scored at once, which bounds memory on very long texts.
BLOCK = 1 << 18
MIN_SCORE = 0.55
UND = "und"
#: Parts in which the sample of a language is counted.
_PARTS = 4


def code_matrix(n: int, seed: int = 11) -> np.ndarray:
    """n codewords of +-1: the exhaustive code up to 5 languages, else the random code
    of 12 log2 n bits (of 50 drawn) with the greatest least distance."""
    if n < 2:
        return np.zeros((n, 0), np.int8)
    if n <= 5:
        bits = [b for b in itertools.product([-1, 1], repeat=n) if b[0] == 1 and -1 in b]
        return np.array(bits, np.int8).T
    width, rng, best = 12 * int(np.ceil(np.log2(n))), random.Random(seed), None
    for _ in range(50):
        code = np.array([[rng.choice((-1, 1)) for _ in range(width)] for _ in range(n)], np.int8)
        gap = (width - code.astype(int) @ code.T.astype(int))[~np.eye(n, dtype=bool)].min() // 2
        split = (abs(code.sum(0)) < n).all()  # a bit that all languages share teaches nothing
        if split and (best is None or gap > best[0]):
            best = (gap, code)
    return best[1]


@dataclass(frozen=True)
class Model:
    langs: list[str]
    code: np.ndarray       # languages x bits, +-1
    weights: np.ndarray    # (BUCKETS + 1) x bits log odds; the last row is zero
    trust: np.ndarray      # languages x bits, rows sum to 1

    @property
    def radius(self) -> int:
        """Wrong bits that the code corrects."""
        if len(self.langs) < 2:
            return 0
        c = self.code.astype(int)
        least = ((c.shape[1] - c @ c.T) // 2)[~np.eye(len(c), dtype=bool)].min()
        return int((least - 1) // 2)

    def bits(self, text: str) -> tuple[np.ndarray, int]:
        """Mean log odds per bit and the number of n-grams."""
        total, n = np.zeros(self.weights.shape[1]), 0
        for grams in ngrams(text):
            total += self.weights[grams].sum(0)
            n += len(grams)
        return total / max(n, 1), n

    def predict(self, text: str) -> tuple[str, float, bool]:
        """Language, score in 0..1 and whether the text is ambiguous."""
        if not self.langs or not any(map(str.isalpha, text)):
            return UND, 0.0, True
        if len(self.langs) == 1:
            return self.langs[0], 1.0, False
        mean, n = self.bits(text)
        sure = np.tanh(mean * np.sqrt(n) / 2)
        loss = (self.trust * np.exp(-2 * self.code * sure)).sum(1)
        best, second = np.argsort(loss, kind="stable")[:2]
        score = float(loss[second] / (loss[best] + loss[second]))
        wrong = int((np.sign(sure) * self.code[best] < 0).sum())
        return self.langs[best], score, score < MIN_SCORE or wrong > self.radius


_ALPHA = None


def ngrams(text: str) -> Iterator[np.ndarray]:
    """Buckets of the 1-, 2- and 3-grams of the lower-cased text, runs of non-letters as one space."""
    global _ALPHA
    if _ALPHA is None:
        _ALPHA = np.array([chr(i).isalpha() for i in range(0x10000)])
    for at in range(0, len(text), BLOCK):
        part = text[at:at + BLOCK].lower().encode("utf-32-le", "surrogatepass")
        c = np.frombuffer(part, "<u4")
        letter = _ALPHA[np.minimum(c, 0xFFFF)] | (c > 0xFFFF)
        c = np.where(letter, c, 32)
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # of a run of spaces, the first one stays
        c = np.concatenate([[32], c[keep], [32]]).astype(np.uint32)
        one = c * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ np.uint32(0x85EBCA6B)) * np.uint32(0xC2B2AE35) + c[1:]
        three = (two[:-1] ^ np.uint32(0x27D4EB2F)) * np.uint32(0x165667B1) + c[2:]
        for g in (one, two, three):
            g = (g ^ (g >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            yield (g >> np.uint32(17)).astype(np.int32) & (BUCKETS - 1)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row of n-gram counts for each run of rows of one language; the rows come sorted by it."""
    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([last]), pa.array([row.tobytes()])], names=["lang", "counts"])

    last, row = None, np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            if lang != last and last is not None:
                yield out()
                row = np.zeros(BUCKETS, np.int64)
            last = lang
            for grams in ngrams(text):
                row += np.bincount(grams, minlength=BUCKETS)
    if last is not None:
        yield out()


def _hits(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, seen = dict(zip(model.langs, model.code)), {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                mean, _ = model.bits(text)
                row = seen.setdefault(lang, np.zeros(model.code.shape[1] + 1, np.int64))
                row[:-1] += np.sign(mean) == code[lang]
                row[-1] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()),
                                          pa.array([s.tobytes() for s in seen.values()], pa.binary())],
                                         names=["lang", "counts"])
    return run


def _by_lang(rows: DataFrame) -> Iterator[tuple[str, np.ndarray]]:
    """Sums per language, one language after the other in code-point order; no more than a partition is held."""
    last, total = None, None
    for r in materialize(rows, "langid-sums").orderBy("lang").toLocalIterator():
        part = np.frombuffer(r["counts"], np.int64)
        if r["lang"] == last:
            total = total + part
            continue
        if last is not None:
            yield last, total
        last, total = r["lang"], part
    if last is not None:
        yield last, total


def _sample(rows: DataFrame, per_lang: int) -> DataFrame:
    """About ``per_lang`` rows of each language, picked by hash; every language is in it."""
    sizes = materialize(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "langid-sizes")
    share = F.least(F.lit(1.0), per_lang / F.col("n"))
    unit = F.shiftrightunsigned(F.xxhash64(F.lit(3), "doc_id"), 11).cast("double") * 2.0 ** -53
    top = F.broadcast(sizes.orderBy(F.desc("n"), "lang").limit(BROADCAST_LANGS))
    sample = rows.join(top, "lang")
    if sizes.count() > BROADCAST_LANGS:
        rare = sizes.join(top.select("lang"), "lang", "left_anti")
        sample = sample.unionByName(rows.join(top.select("lang"), "lang", "left_anti").join(rare, "lang"))
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(_PARTS)).alias("part")
    return sample.filter(unit < share).select("lang", "text", part)


def fit(labelled: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> Model:
    """Fit on (doc_id, text, lang): about ``per_lang`` texts of each language, picked by hash.

    Rows with null lang or text are not learned from; the number of languages has no
    limit.  Only sums per language reach the driver, one language after the other, so it
    holds the model (BUCKETS x bits, 12 log2 of the languages) and their names.
    """
    spark = labelled.sparkSession
    ship(spark)
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sample = materialize(_sample(rows, per_lang).repartition("lang", "part").sortWithinPartitions("lang", "part")
                         .select("lang", "text"), "langid-sample")
    langs = [r["lang"] for r in sample.select("lang").distinct().orderBy("lang").collect()]
    code = code_matrix(len(langs))
    row_of = dict(zip(langs, code))
    yes, no = np.zeros((BUCKETS, code.shape[1])), np.zeros((BUCKETS, code.shape[1]))
    for lang, counts in _by_lang(sample.mapInArrow(_counts, "lang string, counts binary")):
        rate = ((counts + 0.5) / (counts + 0.5).sum())[:, None]  # every language weighs the same
        yes += rate * (row_of[lang] > 0)
        no += rate * (row_of[lang] < 0)
    weights = np.zeros((BUCKETS + 1, code.shape[1]), np.float32)
    if code.shape[1]:
        weights[:-1] = np.log(yes / (code > 0).sum(0)) - np.log(no / (code < 0).sum(0))
    even = np.full(code.shape, 1 / max(code.shape[1], 1))
    model = Model(langs, code, weights, even)
    if len(langs) < 2:
        return model
    shared = spark.sparkContext.broadcast(model)
    hits = sample.mapInArrow(lambda it: _hits(shared.value)(it), "lang string, counts binary")
    right = np.array([n[:-1] / max(n[-1], 1) for _, n in _by_lang(hits)]) + 1e-6
    return Model(langs, code, weights, right / right.sum(1, keepdims=True))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` packed in ``row``, plus lang_pred, score, ambiguous.

    Null texts, texts without a letter and an empty model give ``und``, 0.0, ambiguous.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            out = [m.predict(t or "") for t in batch.column("row").field("text").to_pylist()] if batch.num_rows else []
            cols = [pa.array([o[i] for o in out], t) for i, t in
                    enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *cols],
                                             names=["row", "lang_pred", "score", "ambiguous"])

    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    schema = (T.StructType(list(packed.schema.fields)).add("lang_pred", "string").add("score", "double")
              .add("ambiguous", "boolean"))
    return packed.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id's decimal text leaves 2 when divided by 4 (a null id: as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def language_of(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous for every row; learns from rows not held out.

    Repeated rows are predicted alike; an empty table gives no rows; extra columns are
    not read.
    """
    rows = docs.select("doc_id", "text", "lang")
    model = fit(rows.filter(~held_out(F.col("doc_id"))))
    shown = predict(rows.select("doc_id", "text"), model)
    return shown.select(F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id")).alias("held_out"),
                        "lang_pred", "score", "ambiguous")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose language was identified: ``und`` and texts
    that the code cannot tell apart go.  Learns from the labelled rows not held out."""
    model = fit(docs.select("doc_id", "text", "lang").filter(~held_out(F.col("doc_id"))))
    shown = predict(docs, model)
    return shown.filter((F.col("lang_pred") != UND) & ~F.col("ambiguous")).select("row.*")
