"""WARC archives, chat formatting, URL filters and the embedding index."""

import base64
import hashlib
import random
import struct

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_tables import SF, clashing
from tonearm.llm import chat, multiindex, queries, urlfilter, warc
from tonearm.llm.common import table
from test_dedup_mix import union_find


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.Q[name](spark, SF)
    cur = con.execute(queries.SQL[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    norm = lambda rows: sorted(str([round(x, 9) if isinstance(x, float) else x for x in r]) for r in rows)
    assert norm(map(tuple, df.select(cols).collect())) == norm(cur.fetchall())


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_archive_round_trip_and_revisits(spark):
    big = "<p>" + "long page " * 40_000
    rows = [(3, "http://a/3", "same"), (1, "http://a/1", "same"), (2, None, "same"), (4, "http://a/\r\nX: y", ""),
            (5, "http://ä/5", None), (6, "http://a/6", "bäh\r\n\r\nWARC/1.1\r\n"), (None, "http://a/n", "same"),
            (7, "http://a/7", big), (8, "http://a/8", "once"), (8, "http://a/8", "once")]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    folder, index = warc.write_archives(pages)
    got = warc.read_archives(folder, index).collect()
    assert len(got) == len(rows) == index.count()
    by = {r.page_id: r for r in got}
    assert (by[1].record_type, by[1].refers_to, bytes(by[1].payload)) == ("response", None, b"same")
    assert {(r.record_type, r.refers_to) for r in got if r.page_id in (2, 3, None)} == {("revisit", 1)}
    assert (by[5].record_type, by[5].refers_to, by[5].payload_bytes) == ("revisit", 4, 0)
    assert bytes(by[7].payload) == big.encode() and bytes(by[6].payload) == rows[5][2].encode()
    assert [r.record_type for r in got if r.page_id == 8] == ["response"] * 2  # both have the smallest page_id
    for page, _, html in rows:
        assert by[page].payload_digest == digest((html or "").encode())
    assert by[4].url == "http://a/%0D%0AX:%20y"


def test_archive_files_are_indexed_frames(spark):
    folder, index = warc.write_archives(table(spark, SF, "pages"))
    import zstandard

    name = index.first()["file"]
    data = bytes(spark.read.format("binaryFile").load(f"{folder}/{name}").first()["content"])
    magic, size = struct.unpack_from("<II", data)
    assert magic == 0x184D2A5D
    zdict = warc._dictionary(data[8:8 + size])
    for r in index.where(F.col("file") == name).collect():  # every record is a frame of its own
        frame = zstandard.ZstdDecompressor(dict_data=zdict).decompress(data[r.offset:r.offset + r.length])
        assert frame.startswith(b"WARC/1.1\r\n") and f"X-Page-Id: {r.page_id}\r\n".encode() in frame


def test_archive_min_payload_and_nothing(spark):
    pages = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (3, "u", "bbbb"), (4, "u", "bbbb")],
                                  "page_id long, url string, html string")
    folder, index = warc.write_archives(pages, min_payload=3)
    kinds = {r.page_id: r.record_type for r in warc.read_archives(folder, index).collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert warc.archived(pages.where("false")).count() == 0
    with pytest.raises(ValueError):
        list(warc.parse_archive(b"".join([__import__("zstandard").compress(b"not a record\r\n")])))


def test_chat_round_trip(spark):
    rng = random.Random(3)
    parts = ["<", "|", "/", "im_end", "|>", "<|im_start|>", "<|im_sep|>", "<|im_end|>\n", "\n", "é🙂", " ", "\\", "%0A"]
    text = lambda: "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
    rows = [(c, t, rng.choice(["user", "assistant", "system", "ro\nle<%25"]), text()) for c in range(60)
            for t in range(rng.randrange(1, 7))]
    df = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    out = chat.format_chats(df).select("conv_id", chat.formatted().alias("f"), "segments")
    back = out.select("conv_id", "f", "segments", chat.read_back(F.col("f")).alias("turns"))
    assert "Python" not in back._jdf.queryExecution().executedPlan().toString()
    for r in back.collect():
        want = [(role, t) for c, _, role, t in rows if c == r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == want
        assert r.f.count("<|im_start|>") == 1 + sum(a[0] != b[0] for a, b in zip(want, want[1:]))
        assert sum(s.loss for s in r.segments) == sum(role == "assistant" for role, _ in want)


def test_chat_digests_plain(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 2, "assistant", chat.FORGED), (2, None, None, ""),
            (None, 5, "user", "x"), (None, 5, "user", "x"), (3, 0, "assistant", "y" * 100_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.chat_digests(df).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].turns_sha256 == sha("user\n\nassistant\nb\nassistant\n" + chat.FORGED + "\n")
    assert got[1].loss_sha256 == sha("b" + chat.FORGED) and got[1].loss_chars == 1 + len(chat.FORGED)
    assert got[2].n_turns == 1 and got[2].turns_sha256 == sha("\n\n") and got[None].n_turns == 2
    assert got[3].loss_chars == 100_000
    assert chat.chat_digests(df.where("false")).count() == 0


RULES = urlfilter.RULES


def test_url_verdicts(spark):
    pages = clashing(spark.createDataFrame([
        (1, "http://a.net/es/1", '<link rel="canonical" href="https://b.org/x?y=1#f">'),
        (2, "HTTPS://B.org/x?y=1", "<META http-equiv='refresh' content='0; url=/z'>"), (3, "https://b.org/z", None),
        (4, "https://q.com/1", "<link href=https://b.org/z rel=canonical>"), (5, None, "x"),
        (6, "foo", "<link rel=canonical href=/a>"), (7, "https://c.org/", ""), (8, "https://www.example.com/en/a", ""),
        (9, "https://m.example.com/en/a", ""), (10, "http://net", ""), (11, "http://net/fr/?q#f", ""),
        (12, "http://notnet/fr/", ""), (13, "", "")], "page_id long, url string, html string"))
    got = {r.page_id: r for r in urlfilter.judge(pages, RULES).collect()}
    assert {p for p, r in got.items() if r.verdict == "block"} == {1, 2, 3, 9, 11}
    assert got[4].rule == "com/" and got[8].rule == "www.example.com/en/" and got[2].rule is None
    assert (got[2].host, got[2].path) == ("b.org", "/x") and (got[5].host, got[6].path) == ("", "")
    assert urlfilter.judge(pages.where("false"), RULES).count() == 0


def test_redirect_tables_and_chains(spark):
    urls = [f"http://h{i}.org/" for i in range(40)]
    pages = spark.createDataFrame([(i, u, "") for i, u in enumerate(urls)] + [(40, "http://h5.org/", "")],
                                  "page_id long, url string, html string")
    redirects = spark.createDataFrame([(a, b) for a, b in zip(urls[:20], urls[1:20])] + [(urls[19], "http://x.net/fr/")]
                                      + [(None, urls[30]), ("nonsense", urls[31])], "from_url string, to_url string")
    got = {r.page_id: r.verdict for r in urlfilter.judge(pages, RULES, redirects).collect()}
    assert [p for p, v in sorted(got.items()) if v == "block"] == [*range(20), 40]


def test_links_are_resolved_before_they_join(spark):
    """Decoded references, dotted, query-only and host-only links reach the page they name."""
    canon = '<link rel="canonical" href="{}">'.format
    pages = spark.createDataFrame([
        (1, "http://a.net/es/1", canon("http://q.org/x?b=1&amp;c=2")), (2, "http://q.org/x?b=1&c=2", ""),
        (3, "http://q.org/y/z", canon("../x?b=1&#38;c=2")), (4, "http://q.org/x?d=3", canon(" ?b=1&#x26;c=2\n")),
        (5, "http://q.org/p/./q", canon("./../r/../x?b=1&c=2")), (6, "http://r.org", canon("http://a.net/es/1#top")),
        (7, "http://r.org/", ""), (8, "http://s.org/", canon("//r.org")), (9, "http://t.org/x", canon("mailto:x@r.org")),
        (10, "http://u.org/k/l", canon("x?b=1&c=2")), (11, "http://v.org/" + "w" * 200_000, canon("http://r.org/")),
        (11, "http://v.org/" + "w" * 200_000, canon("http://r.org/"))], "page_id long, url string, html string")
    got = [(r.page_id, r.verdict) for r in urlfilter.judge(pages, RULES).collect()]
    assert sorted(p for p, v in got if v == "block") == [1, 2, 3, 4, 5, 6, 7, 8, 11, 11] and len(got) == 12


def test_resolution_equals_urljoin():
    from urllib.parse import urljoin

    for base in ("http://q.org/a/b/c?x=1#f", "http://q.org", "http://q.org/a/", "https://q.org?x=1", "http://a/b/c/d;p?q"):
        for link in ("g", "./g", "g/", "/g", "//h/g", "?y", "g?y", "g?y#s", ";x", "", ".", "./", "..", "../", "../g", "../..",
                     "../../g", "../../../g", "/./g", "/../g", "g.", "..g", "./g/.", "g/../h", "g;x=1/./y", "ftp://z.org/b"):
            assert urlfilter.resolve(base, link).split("#")[0] == urljoin(base, link).split("#")[0], (base, link)
    assert urlfilter.resolve("http://q.org", "http://z.org/a/../b") == "http://z.org/b"
    assert urlfilter.resolve("http://q.org", "mailto:x") is None and urlfilter.resolve("http://q.org", "HTTP:x") is None


def test_rules_without_a_limit(spark):
    """A table of rules decides as the compiled ones do: any host suffix, any path prefix, longest first."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("ab") for _ in range(rng.randrange(1, 3)))
    name = lambda n: ".".join(word() for _ in range(rng.randrange(1, n)))
    rules = [urlfilter.Rule(rng.choice(["allow", "block"]), name(4), "/" * rng.randrange(2) + "".join(
        rng.choice("ab/") for _ in range(rng.randrange(4)))) for _ in range(700)] + [urlfilter.Rule("block", "", "/x")]
    rows = [(i, f"http://{name(5)}/{word()}/{word()}?q") for i in range(400)] + [(400, None), (401, "http://a.b."), (402, "://x/x")]
    pages = spark.createDataFrame([(*r, "") for r in rows], "page_id long, url string, html string")
    got = {r.page_id: (r.rule, r.verdict) for r in urlfilter.judge(pages, rules).collect()}
    for page, url in rows:
        host, slash, path = (url or "").partition("://")[2].partition("/")
        path = (slash + path).split("?")[0]
        fit = [(len(r.host + r.path), len(r.host), r.verdict == "allow" and "z" or "b", r) for r in rules
               if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fit)[3] if fit else None
        assert got[page] == ((best.host + best.path, best.verdict) if best else (None, "allow")), url


def plain_links(rows, threshold=0.93):
    def unit(v):
        if v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, float)
        return x / np.linalg.norm(x)
    units = [unit(v) if lab is not None else None for _, v, lab in rows]
    return [(i, j) for i in range(len(rows)) for j in range(i) if units[i] is not None and units[j] is not None
            and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold]


@pytest.mark.parametrize("block", [2048, 16])
def test_vectors_equal_brute_force(spark, monkeypatch, block):
    """Groups of near and exact copies, one large; with small blocks every cell is cut up."""
    monkeypatch.setattr(multiindex, "BLOCK", block)
    rng = np.random.default_rng(5)
    rows = []
    for g in range(25):
        base, n = rng.standard_normal(16), 80 if g == 0 else int(rng.integers(1, 8))
        for _ in range(n):
            v = base + rng.standard_normal(16) * rng.choice([0.0, 0.05, 0.12])
            rows.append([len(rows), v.astype(np.float32).tolist(), int(g % 3)])
    rows += [[900, None, 1], [901, [0.0] * 16, 1], [902, [1.0] * 15 + [None], 1], [903, [1.0] * 15 + [float("nan")], 1],
             [904, rows[0][1], None], [905, [], 1], [906, [1.0, 2.0], 1], [907, [2.0, 4.0], 1], [908, rows[0][1], rows[0][2]],
             [908, rows[0][1], rows[0][2]]]
    df = clashing(spark.createDataFrame([tuple(r) for r in rows], "vec_id long, embedding array<float>, label int"))
    got = multiindex.near_duplicates(df).collect()
    links = plain_links([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab)
                         for i, v, lab in rows])
    n = np.zeros(len(rows), int)
    for i, j in links:
        n[i] += 1
        n[j] += 1
    comp = union_find(range(len(rows)), links)
    low = {}
    for i, r in enumerate(rows):
        low[comp[i]] = min(low.get(comp[i], 1 << 60), r[0])
    want = sorted((r[0], int(n[i]), low[comp[i]], r[0] == low[comp[i]]) for i, r in enumerate(rows))
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == want


@pytest.mark.parametrize("part", [slice(None), slice(0, 32), slice(32, None)])
def test_vector_recall_on_hard_pairs(spark, part):
    """Neighbours next to the threshold whose difference lies anywhere or in one half; recall as the run itself measures it."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = multiindex._neighbours(x, part, 0.9305, rng)
    assert np.allclose((x * y).sum(1), 0.9305) and np.allclose((y * y).sum(1), 1)
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(np.stack([x, y], 1).repeat(1, 0).reshape(-1, 64))]
    rows = [(i, v, (i // 2) % 3) for i, v, _ in rows] + [(9000, None, 1), (9001, [1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = multiindex.near_duplicates(df)
    assert got.where("n_links > 0").count() >= 0.98 * 3000
    report = multiindex.measured_recall(df, got, judged=5000).first()
    assert (report.judged, report.links) == (3001, 3000) and report.recall == report.found / 3000


def test_vectors_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert multiindex.near_duplicates(none).count() == 0
    alone = spark.createDataFrame([(None, [1.0, 0.0], 1), (5, None, None)], none.schema)
    assert sorted(map(str, (tuple(r) for r in multiindex.near_duplicates(alone).collect()))) == [
        "(5, 0, 5, True)", "(None, 0, None, True)"]


def test_multi_sequence_order():
    rng = np.random.default_rng(2)
    books = multiindex.Codebooks({4: (rng.random((5, 2)), rng.random((6, 2)))}, 0.4)
    d1, d2 = books.halves(rng.random((20, 4)))
    for p, q in zip(d1, d2):
        cells = list(books.visits(p, q))
        sums = [p[i] + q[j] for i, j in cells]
        grid = (p[:, None] + q).ravel()
        assert sums == sorted(sums) and len(cells) == (grid <= grid.min() + 0.4).sum()
