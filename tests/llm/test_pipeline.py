"""The pipeline against a plain version of its stages."""

from collections import Counter

import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from llm_tables import SF
from tonearm.llm import langid, mix, sentencepieces, simhash
from tonearm.llm.common import table
from test_dedup_mix import plain_components, plain_fingerprint, plain_targets


def test_stages_and_registration():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "source_mix", "sentencepiece"]
    names = entry.queries()
    assert names["pipeline"] is corpus_pipeline.run
    numbers = sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit())
    assert numbers == list(range(1, 14))  # one query for each dealt operator
    assert set(entry.oracle_sql()) <= set(names)


def test_run_equals_plain_stages(spark):
    docs = table(spark, SF, "documents")
    got = Counter()
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r.doc_id, tuple(r.token_ids), r.source, r.lang] += 1
    rows = {r.doc_id: r for r in docs.collect()}
    assert langid.keep_identified(docs).count() == len(rows)  # no clean document goes
    fp = {d: plain_fingerprint(r.text) for d, r in rows.items()}
    comp, at = plain_components(fp.values())
    best = {}
    for d in sorted(rows):
        best.setdefault(comp[at[fp[d]]], d)
    kept = spark.createDataFrame([rows[d] for d in best.values()], docs.schema)
    sizes = Counter()
    for r in kept.select("source", mix.word_count(F.col("text")).alias("n")).collect():
        sizes[r.source] += r.n
    target = plain_targets(dict(sizes))
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL)
    words = Counter()
    for (d, ids, source, lang), n in got.items():
        text = rows[d].text
        assert d in best.values() and source == rows[d].source and lang == rows[d].lang
        decoded = library.decode(list(ids))
        whole = list(ids) == library.encode(text)
        assert whole or " ".join(text.split()).startswith(" ".join(decoded.split()))  # the one cut document
        words[source] += n * len(decoded.split())
    assert all(abs(words[s] - t) <= 1 for s, t in target.items())


def test_stages_take_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SF).columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
