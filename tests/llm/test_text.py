"""Fingerprints, language ID, tokenising and licences."""

import hashlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from llm_tables import SF
from tonearm.llm import fingerprint, langid, licences, sentencepieces
from tonearm.llm.common import table


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fingerprint_edits(spark):
    docs = table(spark, SF, "documents")
    out = fingerprint.fingerprint_edits(docs)
    assert "Python" not in plan_of(out) and "Arrow" not in plan_of(out)
    got = {r.doc_id: r for r in out.collect()}
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    for i, (d, text) in enumerate(rows):
        m = len(text) // 3
        edited = text[: len(text) - m] + rows[(i + 1) % len(rows)][1][:m]
        assert got[d].n_chars == len(text) and got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    by_text = {}
    for d, text in rows:
        assert by_text.setdefault(text, got[d].fingerprint) == got[d].fingerprint
    long = [d for d, t in rows if len(t) > 300]
    assert np.mean([got[d].near_edited for d in long]) > 0.4 and np.mean([got[d].near_next for d in long]) < 0.1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got.values())


def test_anchors_are_context_free_closed_syncmers(spark):
    """Anchors equal a plain reading of the definition, and a changed head leaves the tail's anchors."""
    a = " ".join(f"tok{i * 7 % 53}" for i in range(80))
    b = "quite other words here " + a
    df = spark.createDataFrame([(1, a), (2, b)], "id long, text string")
    wide = df.withColumn("t", F.regexp_extract_all("text", F.lit(r"\S{1,6}"), F.lit(0)))
    pairs = {r.id: r for r in wide.select("id", F.zip_with("t", F.slice("t", 2, 1 << 30), lambda x, y: F.xxhash64(x, y))
                                          .alias("g"), F.size("t").alias("n")).collect()}
    got = {r.id: r.anchors for r in fingerprint.with_anchors(df, "text", "anchors").collect()}
    for i in (1, 2):
        g = pairs[i].g[: pairs[i].n - 1]
        n_closed = sum(min(g[j:j + 4]) in (g[j], g[j + 3]) for j in range(len(g) - 3))
        assert len(got[i]) == n_closed
    assert got[2][-len(got[1]):] == got[1]


def test_short_texts_have_their_own_fingerprints(spark):
    """Texts of 1 to 8 pieces: none without an anchor, no two equal ones."""
    rows = [(n, " ".join(f"w{n}x{i}"[:6] + chr(97 + j % 26) * (j % 2) for j in range(n))) for n in range(1, 9)
            for i in range(100)]
    df = spark.createDataFrame(rows, "n int, text string")
    got = fingerprint.with_anchors(df, "text", "anchors").select("n", "anchors").collect()
    assert all(len(r.anchors) > 0 for r in got) and len({tuple(r.anchors) for r in got}) == len(rows)
    pair = spark.createDataFrame([("one two three four five six", "other words are in this text")], "a string, b string")
    pair = fingerprint.with_anchors(fingerprint.with_anchors(pair, "a", "x"), "b", "y")
    assert pair.select(fingerprint.likeness("x", "y")).first()[0] == 0.0


def test_pieces_cover_the_text(spark):
    """Every code point but white space is in a piece, short words and unspaced scripts as they should be."""
    import re
    rng = np.random.default_rng(4)
    texts = ["".join(chr(c) for c in rng.choice([32, 10, 45, 65, 97, 98, 0xE9, 0x430, 0x435, 0x4E00, 0xE01, 0x1F600], 300,
                                                p=[.03, .01, *[.096] * 10])) for _ in range(40)]
    texts += ["six666 sevens7 日本語", "-" * 100 + "x" * 100, ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = df.select("text", F.regexp_extract_all("text", F.lit(fingerprint._PIECES), F.lit(0)).alias("t")).collect()
    for r in got:
        assert "".join(r.t) == re.sub("[ \n]", "", r.text)
    assert got[40].t[0] == "six666" and got[40].t[-3:] == ["日", "本", "語"]


def test_a_head_insertion_in_an_unspaced_run_is_local(spark):
    rng = np.random.default_rng(6)
    alphabets = {"han": "".join(map(chr, range(0x4E00, 0x5600))), "thai": "".join(map(chr, range(0xE01, 0xE2F))),
                 "kana": "".join(map(chr, range(0x3041, 0x3090))), "url": "abcdefghijklmnopqrstuvwxyz/-.",
                 "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "hex": "0123456789abcdef",
                 "cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "emoji": "".join(map(chr, range(0x1F600, 0x1F640)))}
    rows = []
    for name, letters in alphabets.items():
        text = "".join(rng.choice(list(letters), 1000))
        rows += [(name, text, letters[5] + text), (name, text, text[:500] + letters[7] + text[501:]),
                 (name, text, text[1:])]
    df = spark.createDataFrame(rows, "name string, a string, b string")
    df = fingerprint.with_anchors(fingerprint.with_anchors(df, "a", "x"), "b", "y")
    for r in df.select("name", F.size("x").alias("n"), fingerprint.likeness("x", "y").alias("near")).collect():
        assert r.n > 20 and r.near > 0.85, r


def test_fingerprint_odd_rows(spark, odd_docs, no_docs):
    out = fingerprint.fingerprint_edits(odd_docs).collect()
    assert len(out) == odd_docs.count()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, r)
    assert by[2].fingerprint == by[3].fingerprint == by[4].fingerprint == "" and by[2].n_chars == 0
    assert by[3].near_edited == 1.0 and len(by[5].fingerprint) > 8 * 10_000
    assert fingerprint.fingerprint_edits(no_docs).count() == 0
    one = fingerprint.fingerprint_edits(odd_docs.where("doc_id = 7")).first()  # its own successor
    assert one.near_next == 1.0 and one.n_chars == 13


def test_many_rows_of_one_id_are_dealt_out(spark, monkeypatch):
    """A third of the rows without id and a third of one id: no task gets them, and the edits are those of a plain reading."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(fingerprint, "SALT_ROWS", 20)
    try:
        n = F.col("id") % 3
        doc_id = F.when(n == 0, None).when(n == 1, F.lit(500)).otherwise(F.col("id"))
        text = F.when(F.col("id") % 5 == 0, F.lit("the same words in all of these rows here")).otherwise(
            F.concat_ws(" ", F.lit("row"), F.col("id"), F.lit("has words of its own to be cut")))
        docs = spark.range(0, 6000, 1, 8).select(doc_id.alias("doc_id"), text.alias("text"))
        out = fingerprint.fingerprint_edits(docs)
        sizes = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert sum(sizes) == 6000 and max(sizes) < 2 * 6000 / 8
        rows = docs.withColumn("th", F.xxhash64("text")).collect()
        ids = sorted({r.doc_id for r in rows if r.doc_id is not None}, reverse=True) + [None]
        head = {d: min((r.th, r.text) for r in rows if r.doc_id == d)[1] for d in ids[:50] + [500, 499, 497, None]
                if d in set(ids)}
        after = dict(zip(ids, ids[1:] + ids[:1]))
        want = {}
        for r in rows:
            if after[r.doc_id] in head:
                m = len(r.text) // 3
                edited = r.text[: len(r.text) - m] + head[after[r.doc_id]][:m]
                want.setdefault((r.doc_id, after[r.doc_id]), []).append(hashlib.sha256(edited.encode()).hexdigest())
        got = {}
        for r in out.collect():
            if (r.doc_id, r.next_doc_id) in want:
                got.setdefault((r.doc_id, r.next_doc_id), []).append(r.edited_sha256)
        assert len(want) > 50 and (None, ids[0]) in want and any(k[0] == 500 for k in want)
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_fingerprints_equal_plain_anchor_sets(spark):
    """Fingerprint, near_edited and near_next of whole documents against anchors chosen in plain Python."""
    docs = table(spark, SF, "documents").limit(60)
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    texts = {}
    for i, (d, text) in enumerate(rows):
        m = len(text) // 3
        texts[d] = (text, text[: len(text) - m] + rows[(i + 1) % len(rows)][1][:m], rows[(i + 1) % len(rows)][1])
    flat = spark.createDataFrame([(t,) for t in sorted({x for three in texts.values() for x in three})], "text string")
    pieces = F.regexp_extract_all("text", F.lit(fingerprint._PIECES), F.lit(0))
    flat = flat.withColumn("t", pieces).select(
        "text", F.zip_with("t", F.slice("t", 2, 1 << 30), lambda x, y: F.xxhash64(x, y)).alias("g"),
        F.size("t").alias("n"), F.hash("t").alias("all"))
    hashed = {r.text: (r.g[: max(r.n - 1, 0)], r.n, r.all) for r in flat.collect()}
    grams = {tuple(g[j:j + 4]) for g, _, _ in hashed.values() for j in range(len(g) - 3)
             if min(g[j:j + 4]) in (g[j], g[j + 3])}
    hashes = spark.createDataFrame(sorted(grams), "a long, b long, c long, d long")
    code = {(r.a, r.b, r.c, r.d): r.h for r in hashes.withColumn("h", F.hash("a", "c", "d")).collect()}

    def anchors(text):
        g, n, whole = hashed[text]
        found = [code[tuple(g[j:j + 4])] for j in range(len(g) - 3) if tuple(g[j:j + 4]) in code]
        return found or ([whole] if n else [])

    def near(a, b):
        a, b = set(anchors(a)), set(anchors(b))
        return len(a & b) / len(a | b) if a | b else 1.0

    keyed = spark.createDataFrame(rows, "doc_id long, text string")
    for r in fingerprint.fingerprint_edits(keyed).collect():
        text, edited, following = texts[r.doc_id]
        assert r.fingerprint == "".join(f"{h & 0xFFFFFFFF:08x}" for h in anchors(text))
        assert r.edited_fingerprint == "".join(f"{h & 0xFFFFFFFF:08x}" for h in anchors(edited))
        assert r.near_edited == pytest.approx(near(text, edited)) and r.near_next == pytest.approx(near(text, following))


def test_language_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = langid.language_of(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 100 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    import zlib
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)


def test_language_odd_rows(spark, odd_docs, no_docs):
    out = langid.language_of(odd_docs).collect()
    assert len(out) == odd_docs.count() and all(0 <= r.score <= 1 for r in out)
    by = {r.doc_id: r for r in out if r.doc_id}
    assert {by[d].lang_pred for d in (2, 3, 4, 9)} == {"und"} and by[5].lang_pred != "und"
    assert langid.language_of(no_docs).count() == 0
    kept = langid.keep_identified(odd_docs)
    assert kept.columns == odd_docs.columns and not {2, 3, 4, 9} & {r.doc_id for r in kept.collect()}


@pytest.mark.parametrize("n", [1, 2, 4, 5, 9, 40])
def test_codewords_differ(n):
    code = langid.code_matrix(n).astype(int)
    gaps = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
    assert len(code) == n and all(g > 0 for g in gaps)
    if n in (4, 5):
        assert min(gaps) == 2 ** (n - 2)


def test_one_or_no_language(spark):
    one = spark.createDataFrame([(1, "hello world", "en"), (3, "good day", "en")], "doc_id long, text string, lang string")
    model = langid.fit(one)
    assert model.predict("anything") == ("en", 1.0, False) and model.predict("123")[0] == "und"
    assert langid.fit(one.where("false")).predict("text")[0] == "und"


@pytest.fixture(scope="module")
def tokenizer():
    return sentencepieces.Vocabulary.load(), sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL)


def test_pieces_equal_the_library(spark, tokenizer):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    _, library = tokenizer
    out = sentencepieces.tokenised(docs).collect()
    text = {r.doc_id: r.text for r in docs.collect()}
    assert len(out) == len(text)
    for r in out:
        assert r.token_ids == library.encode(text[r.doc_id]) and r.n_tokens == len(r.token_ids) and r.round_trip


@pytest.mark.parametrize("text", [
    "", " ", "   ", "a    b      c", " lead and trail  ", "\n\n", "日本語のテキスト", "ab\x00ﬁ zz", "🙂🙂 ok", "x" * 3000,
    "ab" * 2000, "Hello  world\n\tfoo é", "▁▁ a▁b", "don't stop", "á é", "1234567890" * 50])
def test_pieces_of_odd_texts(tokenizer, text):
    v, library = tokenizer
    ids = sentencepieces.Encoder(v).encode([text])[0].tolist()
    assert ids == library.encode(text)
    assert v.decode(ids) == text.replace("▁", " ")


def test_pieces_with_small_bounds(tokenizer, monkeypatch):
    """Indexing in small parts and forgetting units changes nothing."""
    v, library = tokenizer
    for name in ("INDEX_CHARS", "HELD_CHARS", "KEPT_UNITS", "KEPT_PAIRS"):
        monkeypatch.setattr(sentencepieces, name, 40)
    texts = [f"some words here and word{i} number{i * i} there" for i in range(60)]
    got = sentencepieces.Encoder(v).encode(texts)
    assert [g.tolist() for g in got] == library.encode(texts)


def test_pairs_that_share_a_place_keep_their_answers(tokenizer, monkeypatch):
    """Pairs are looked up by place; where all displace each other the ids are still the library's."""
    v, library = tokenizer
    texts = [f"some words here and word{i} number{i * i} there, unbelievably anticlimactic" for i in range(60)]
    for places in (1, 2, 1 << 12):
        monkeypatch.setattr(sentencepieces, "PAIR_PLACES", places)
        encoder = sentencepieces.Encoder(v)
        assert [g.tolist() for text in texts for g in encoder.encode([text])] == library.encode(texts)
        held = encoder.place_code >= 0
        assert held.any() and all(encoder.pairs[c] == s for c, s in zip(encoder.place_code[held].tolist(),
                                                                        encoder.place_said[held].tolist()))


def test_pieces_odd_rows(spark, odd_docs, no_docs):
    out = sentencepieces.encode(odd_docs)
    assert out.columns == ["row", "token_ids"] and out.count() == odd_docs.count()
    done = {r.doc_id: r for r in sentencepieces.tokenised(odd_docs).collect()}
    assert done[2].n_tokens == done[3].n_tokens == 0 and done[5].round_trip and done[6].round_trip
    assert not done[7].round_trip  # U+2581 comes back as a space
    assert sentencepieces.tokenised(no_docs).count() == 0


def test_decode_of_a_table(spark, odd_docs):
    rows = sentencepieces.decode(sentencepieces.encode(odd_docs)).select("row.text", "decoded").collect()
    assert all(r.decoded == (r.text or "").replace("▁", " ") for r in rows)
    none = spark.createDataFrame([(None,), ([],)], "token_ids array<int>")
    assert [r.decoded for r in sentencepieces.decode(none).collect()] == [None, ""]


def plain_dice(a, b):
    ga, gb = (set(zip(x, x[1:])) for x in (a, b))
    return 2 * len(ga & gb) / (len(ga) + len(gb)) if ga or gb else 0.0


def test_licence_bounds_lose_nothing():
    s = licences.Scanner(licences.TEMPLATES, 0.8)
    rng = np.random.default_rng(0)
    for name, text in licences.TEMPLATES:
        base = licences.words(text.encode())
        for cut in (1.0, 0.9, 0.8, 0.7, 0.6):
            some = [w for w in base if rng.random() < cut] + [b"other"] * int(rng.integers(0, 3))
            want = {(n, round(plain_dice(some, licences.words(t.encode())), 9)) for n, t in licences.TEMPLATES
                    if plain_dice(some, licences.words(t.encode())) >= 0.8}
            assert {(n, round(d, 9)) for n, d in s.match(some)} == want


def test_licence_scan_rows(spark, odd_docs, no_docs):
    mit = dict(t for t in licences.TEMPLATES if len(t[1]) > 900)["MIT"].replace(", to any", ",\nto any")
    docs = spark.createDataFrame([
        (1, "prose here\nReleased under the MIT License.\nmore prose"), (2, "before\n\n" + mit + "\n\nafter it"),
        (3, "LICENSED under cc-by-nc 4.0"), (4, "a licence is not this"), (5, mit), (6, None), (6, "")],
        "doc_id long, text string")
    got = {(r.doc_id, r.licence): (round(r.dice, 6), r.n_passages) for r in licences.scan(docs).collect()}
    assert got[1, "MIT"] == (1.0, 1) and got[5, "MIT"] == (1.0, 1)
    assert got[2, "MIT"] == (1.0, 1)  # the paragraph; the whole text with its few other words is the same place
    assert got[3, "CC-BY-NC-4.0"][0] == 1.0 and not any(d in (4, 6) for d, _ in got)
    assert licences.scan(odd_docs).count() == 0 and licences.scan(no_docs).count() == 0


def test_variants_of_a_family_are_told_apart():
    s = licences.Scanner(licences.TEMPLATES, 0.8)
    texts = {
        "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
        "GPL-3.0": "this work is licensed under the GNU General Public License version 3",
        "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
        "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-Non-Commercial 4.0 International License.",
        "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0."}
    texts |= {name: text for name, text in licences.TEMPLATES if len(text) > 300}
    prose = " ".join(f"word{i % 211} of the other{i % 97}" for i in range(100))
    for name, text in texts.items():
        for around in (text, f"{prose}\n\n{text}\n\n{prose}", f"{prose} {text} {prose}"):
            got = s.scan(around.encode())
            assert set(got) == {name} and got[name][1] == 1, (name, got)
    for none in ("This work is licensed under a Creative Commons Attribution 3.0 International License.",
                 "This work is licensed under the GNU General Public License, version 1.",
                 "Licensed under the Apache License, Version 1.1."):
        assert s.scan(none.encode()) == {}, none


def test_places_equal_the_sql(spark):
    """Lines, paragraphs and whole texts of odd layouts, against the SQL where no window finds more."""
    import duckdb
    import pandas as pd

    line, gpl = "Released under the MIT License.", dict(licences.TEMPLATES)["GPL-3.0"]
    half = len(gpl.split()) // 2
    wrapped = " ".join(gpl.split()[:half]) + "\n" + " ".join(gpl.split()[half:])
    parts = " ".join(gpl.split()[:half]) + "\n\n" + " ".join(gpl.split()[half:])
    texts = [line, f"{line}\n\n{line}", f"{line}\n{line}", wrapped, parts, f"{wrapped}\n\n{wrapped}",
             gpl.replace("version 3", "version 2"), "", None, f" \n{line}\n \n"]
    docs = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    con = duckdb.connect()
    con.register("documents", docs)
    want = con.execute(licences.scan_sql()).fetchall()
    got = licences.scan(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    rounded = lambda rows: sorted((d, n, round(x, 9), k) for d, n, x, k in rows)
    assert rounded(map(tuple, got.collect())) == rounded(want)


def laid_out(name, n_words, parts=3):
    """The longest template of a licence in ``parts`` paragraphs."""
    of = max((t for t in licences.TEMPLATES if t[0] == name), key=lambda t: len(t[1]))[1].split()
    cut = [len(of) * i // parts for i in range(parts + 1)]
    return "\n\n".join("\n".join(" ".join(of[a:b][i:i + n_words]) for i in range(0, b - a, n_words))
                       for a, b in zip(cut, cut[1:]))


@pytest.mark.parametrize("name", ["MIT", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "Zlib", "Apache-2.0",
                                  "GPL-2.0", "GPL-3.0", "AGPL-3.0"])
def test_licences_across_line_breaks(name):
    s = licences.Scanner(licences.TEMPLATES, 0.8)
    prose = " ".join(f"word{i % 211} of the other{i % 97}" for i in range(400))
    three = f"{prose}\n\n{laid_out(name, 11)}\n\n{prose}"
    wrapped = f"{prose}\n{laid_out(name, 9, 1)}\n{prose}"
    inside = f"{prose} {laid_out(name, 10**6, 1)} {prose}"
    for text in (three, wrapped, inside, f"{inside}\n{inside}"):
        dice, n = s.scan(text.encode())[name]
        assert dice > 0.95 and n == (2 if "\n" in text and text.startswith(inside) else 1), text[:60]
    assert s.scan(prose.encode()) == {}


def test_licence_windows_equal_brute_force():
    """A window is found exactly where one of at most the reach has the coefficient."""
    template = [("X", "a b c d e f g h")]
    s = licences.Scanner(template, 0.8)
    rng = np.random.default_rng(3)
    for _ in range(300):
        text = [bytes([c]) for c in rng.choice(list(b"abcdefghijk"), 4)]
        text += [bytes([c]) for c in b"abcdefgh" if rng.random() < 0.9] + [bytes([c]) for c in rng.choice(list(b"abcxyz"), 6)]
        best = max(plain_dice(text[i:j], licences.words(template[0][1].encode()))
                   for i in range(len(text)) for j in range(i + 2, min(i + s.reach[0] + 1, len(text)) + 1))
        got = [d for _, d, _, _ in s.windows(text)]
        assert bool(got) == (best >= 0.8) and all(d <= best + 1e-12 for d in got)


def test_languages_without_a_limit(spark, monkeypatch):
    """Languages beyond the broadcast ones are learned too, and each is drawn whole."""
    monkeypatch.setattr(langid, "BROADCAST_LANGS", 3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i * 10 + j, f"{letters[i] * 3} {letters[i + 1] * 2} " * 9, f"l{i:02d}") for i in range(12) for j in range(2 + i % 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert langid._sample(docs, 100).count() == len(rows)
    model = langid.fit(docs)
    assert model.langs == [f"l{i:02d}" for i in range(12)]
    assert all(model.predict(text)[0] == lang for _, text, lang in rows)


def test_prediction_equals_a_plain_decoder(spark):
    """Counts, log odds, trust and loss written out over dictionaries give the same languages and scores."""
    import math
    from collections import Counter

    rows = [(i, t, lang) for i, (t, lang) in enumerate(
        [("the cat sat on the mat", "en"), ("a dog and the bird", "en"), ("le chat est sur la table", "fr"),
         ("un chien et une souris", "fr"), ("der hund und die katze", "de"), ("ein vogel auf dem dach", "de")])]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    grams = lambda t: [int(g) for part in langid.ngrams(t) for g in part]
    langs = ["de", "en", "fr"]
    counts = {lang: Counter(g for _, t, x in rows if x == lang for g in grams(t)) for lang in langs}
    rate = lambda lang, g: (counts[lang][g] + 0.5) / (sum(counts[lang].values()) + 0.5 * langid.BUCKETS)
    code, bits = langid.code_matrix(3), range(langid.code_matrix(3).shape[1])
    mean = lambda xs: sum(xs) / len(xs)
    odds = lambda b, g: math.log(mean([rate(x, g) for i, x in enumerate(langs) if code[i, b] > 0])
                                 / mean([rate(x, g) for i, x in enumerate(langs) if code[i, b] < 0]))
    vote = lambda b, t: mean([odds(b, g) for g in grams(t)])
    right = [[mean([(vote(b, t) > 0) == (code[i, b] > 0) for _, t, x in rows if x == lang]) + 1e-6 for b in bits]
             for i, lang in enumerate(langs)]
    for text in ("the bird on the table", "la souris et le chien", "die katze auf dem dach", "zzz"):
        n = len(grams(text))
        loss = [sum(right[i][b] / sum(right[i]) * math.exp(-2 * code[i, b] * math.tanh(vote(b, text) * math.sqrt(n) / 2))
                    for b in bits) for i in range(3)]
        best, second = sorted(loss)[:2]
        lang, score, _ = model.predict(text)
        assert lang == langs[loss.index(best)] and score == pytest.approx(second / (best + second), rel=1e-4)
