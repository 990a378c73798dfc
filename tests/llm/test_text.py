"""Language ID, fingerprints, HTML, secrets, line dedup and archives."""

import hashlib
import itertools
import re
import timeit
import tracemalloc
from html.parser import HTMLParser
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabkit.llm import html_blocks, language, order_minhash, warc
from tabkit.llm.line_dedup import _near_pages, line_dedup
from tabkit.llm.secrets import secret_report

FOLDER = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    held = language.held_out(F.col("doc_id"))
    model = language.train(docs.filter(~held))
    out = language.predict(model, docs.filter(held)).join(docs, "doc_id")
    assert out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.97
    mixed = "the of and that in with for was. " * 8 + "und der die das nicht mit ein auch. " * 8
    first, second = language.predict(model, spark.createDataFrame([(1, mixed)], "doc_id long, text string")).first()["spans"]
    assert (first["lang"], second["lang"]) == ("en", "de") and abs(first["end"] - 8 * 33) < 40


def test_language_edges(spark, docs):
    model = language.train(docs)
    out = {r.doc_id: r for r in language.predict(model, docs).collect()}
    assert out[4].lang_pred == out[5].lang_pred == out[6].lang_pred == "und" and out[4].score == 0.0
    assert out[1].lang_pred in ("en", "fr", "de") and 0 < out[1].score <= 1
    assert language.predict(model, docs).count() == docs.count()
    none = language.train(docs.limit(0))
    assert {r.lang_pred for r in language.predict(none, docs).collect()} == {"und"}
    assert language.predict(model, docs, whole_rows=True).columns == [c for c in docs.columns if c != "score"] + ["lang_pred", "score", "spans"]


def test_language_rare(spark):
    """A rare language is learned however many rows the others have, and the sample stays bounded."""
    rows = [(k, "the house and the garden", "en") for k in range(4000)] + [(4000 + k, "das haus und der garten", "de") for k in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(df, sample_rows=50)
    assert model.langs == ["de", "en"]
    assert language.predict(model, df).filter("doc_id >= 4000 and lang_pred = 'de'").count() == 5


def test_language_memory(spark):
    """A batch is read in parts: memory stays far below what the letters of all its texts take, with the same results."""
    rng, words = np.random.default_rng(5), {"en": "the and of in that with", "de": "der die und nicht mit ein"}
    langs = [("en", "de")[k % 2] for k in range(3000)]
    texts = [" ".join(rng.choice(words[x].split(), 250)) + (" " + words["de"]) * 9 * (k % 7 == 0) if k % 50 else None for k, x in enumerate(langs)]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string()), "lang": langs, "c0": range(3000)})
    scripts, added = language.letter_scripts(), [("lang_pred", pa.string()), ("score", pa.float64()), ("spans", pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))]
    model = language.train(spark.createDataFrame([(k, t, x) for k, (x, t) in enumerate(words.items())], "doc_id long, text string, lang string"))
    sent = SimpleNamespace(value=(model.langs, model.weights, model.written_in))
    label = language._labelled(sent, SimpleNamespace(value=scripts), 5.0, pa.schema([("c0", pa.int64()), *added]))
    found = {}
    for name, run in (("counts", language._counts(scripts)), ("labels", label)):
        tracemalloc.start()
        found[name] = list(run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 60e6, (name, peak)
        assert sum(b.num_rows for b in run(iter([batch.slice(0, 0)]))) == 0
    rows = [r for b in found["labels"] for r in b.to_pylist()]
    assert rows == [r for k in range(0, 3000, 100) for b in label(iter([batch.slice(k, 100)])) for r in b.to_pylist()]
    assert [r["c0"] for r in rows] == list(range(3000)) and {len(r["spans"]) for r in rows} >= {0, 1, 2}
    total = {x: 0 for x in words}
    for b in found["counts"]:
        for r in b.to_pylist():
            total[r["lang"]] += r["count"] * (r["bucket"] < language.BUCKETS)
    assert total == {x: sum(sum(map(str.isalpha, t or "")) for t, y in zip(texts, langs) if x == y) for x in words}


def test_viterbi():
    rng = np.random.default_rng(3)
    for _ in range(200):
        first = np.concatenate(([0], np.cumsum(rng.integers(0, 7, 5))))
        scores, penalty = np.round(rng.normal(0, 2, (first[-1], 3)), 1), 2.0
        found = language.viterbi(scores, first, penalty)
        for a, b in zip(first[:-1], first[1:]):
            own = scores[a:b]

            def value(path):
                return sum(own[i, p] for i, p in enumerate(path)) - penalty * sum(x != y for x, y in zip(path, path[1:]))

            best = max(map(value, itertools.product(range(3), repeat=b - a)))
            assert abs(value(tuple(found[a:b])) - best) < 1e-9


@pytest.mark.parametrize("range_rows", [2, 10_000])
def test_fingerprints(spark, docs, monkeypatch, range_rows):
    monkeypatch.setattr(order_minhash, "RANGE_ROWS", range_rows)
    monkeypatch.setattr(order_minhash, "GROUP", 2)
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    rows.sort(key=lambda r: r[1].encode(), reverse=True)
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0)))
    expected = []
    for (id_, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        n = len(text)
        edited = text[: n - n // 3] + after[: n // 3]
        expected.append((id_, n, hashlib.sha256(edited.encode()).hexdigest()))
    out = order_minhash.fingerprints(docs).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in out), key=str) == sorted(expected, key=str)
    assert all(0 <= x <= 1 for r in out for x in (r.near_edited, r.near_next))
    by_text = {}
    for r in docs.join(order_minhash.fingerprints(docs), "doc_id").select("text", "fingerprint").collect():
        assert by_text.setdefault(r.text, r.fingerprint) == r.fingerprint
    assert order_minhash.fingerprints(docs.limit(0)).count() == 0
    assert order_minhash.fingerprints(docs.filter("doc_id = 3")).first().near_next == 1.0


def test_fingerprint_follows_edits():
    text = " ".join(f"word{i * i % 1009}" for i in range(600))
    one, small = order_minhash.fingerprint(text), order_minhash.fingerprint(text.replace("word4 ", "other ", 1))
    swapped = order_minhash.fingerprint(text[len(text) // 2 :] + text[: len(text) // 2])
    other = order_minhash.fingerprint(" ".join(f"term{i * 7 % 997}" for i in range(600)))
    near = [order_minhash.likeness(one, x) for x in (one, small, swapped, other)]
    assert near[0] == 1.0 and near[1] > 0.8 and near[1] > near[2] > near[3] and near[3] < 0.1


def selected(text):
    """The definition, k-mer by k-mer: for each group the least ranks, in the order of the text."""
    one = np.uint64(1)
    seen, ranks = {}, []
    n = max(1, len(text) - order_minhash.K + 1)
    bits = max(order_minhash._PLACE_BITS, n.bit_length())
    for i in range(n):
        codes = [ord(c) for c in text[i : i + order_minhash.K]]
        value = sum(c * int(p) for c, p in zip(codes, order_minhash._POWERS)) % 2**64
        kmer = int(order_minhash.mixed(np.array([value], np.uint64))[0]) >> bits << bits
        seen[kmer] = occurrence = seen.get(kmer, 0) + 1
        number = order_minhash.mixed(np.array([occurrence], np.uint64))[0]
        ranks.append((int(order_minhash.mixed(np.array([kmer], np.uint64) ^ number)[0]), i))
    groups = {}
    for rank, i in sorted(ranks):
        kept = groups.setdefault(rank % order_minhash.SKETCHES, [])
        if len(kept) < order_minhash.KEPT:
            kept.append((i, rank))
    out = {}
    for group, kept in groups.items():
        value, in_text = np.zeros(1, np.uint64), [rank for _, rank in sorted(kept)]
        for k, rank in enumerate(in_text + [0] * (order_minhash.KEPT - len(in_text))):
            value = order_minhash.mixed(value + np.uint64(rank) + one * np.uint64(k + 1))
        out[group] = int(value[0])
    return out


def test_fingerprint_definition():
    for text in ("a", "abcdefgh", "abab" * 40, " ".join(f"word{i % 50}" for i in range(900))):
        found = order_minhash.fingerprint(text)
        for group, value in selected(text).items():
            assert int(found[group]) == value


def test_fingerprint_across_place_bits(monkeypatch):
    """Texts on either side of the length whose places fit beside a hash stay alike."""
    rng = np.random.default_rng(9)
    text = "".join(chr(97 + c) for c in rng.integers(0, 26, 5000))
    monkeypatch.setattr(order_minhash, "_PLACE_BITS", 12)
    short = order_minhash.fingerprint(text[: 4095 + order_minhash.K - 1])
    long = order_minhash.fingerprint(text[: 4096 + order_minhash.K + 20])
    assert order_minhash.likeness(short, long) > 0.9


def test_html(spark):
    tree = html_blocks.train(spark)
    rows = html_blocks.labelled()
    assert sum(html_blocks.classify(tree, row) == label for row, label in rows) > 0.95 * len(rows)
    page = (
        "<html><head><title>No</title><style>p{}</style></head><body><header><a href=/>Home</a></header><nav><ul><li><a href=x>One</a></li></ul></nav>"
        "<div class='ad'>Buy now</div><article><h1>Head &amp; tail</h1><p>First <b>bold</b>\n  line<br>goes on.<script>var x = '<p>';</script>"
        "<p>Second &#233;.</p><aside>Aside</aside><div class=\"reader-comments\"><p>Me too</p></div><form>Name <input></form></article><footer>&copy; me</footer>"
    )
    assert html_blocks.main_text(page, tree) == "Head & tail\nFirst bold line goes on.\nSecond é."
    for broken in ("", "<", "<p", "<p" * 2000, "<a href='" * 300, "</p></div>", "<!-- x", "<script>"):
        assert html_blocks.main_text(broken, tree) == ""
    pages = spark.createDataFrame([(1, "u", page, "z"), (1, "u", page, "z"), (None, None, None, "z"), (2, "", "", "z")], "page_id long, url string, html string, text string")
    out = html_blocks.extract(pages).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in out) == [(0, 0), (1, 46), (1, 46), (2, 0)]
    assert html_blocks.extract(pages.limit(0)).count() == 0


def test_html_of_pages(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    for row in html_blocks.extract(pages).collect():
        inside = re.search(r"<article>(.*?)(?:</article>|$)", html[row.page_id], re.S)[1].replace("<br>", " ")
        parts = [html_blocks.unescape(re.sub("<[^>]*>", "", x)).split() for x in re.split("</?(?:p|h1)>", inside)]
        assert row.text == "\n".join(" ".join(p) for p in parts if p)


class SlowBlocks(HTMLParser):
    """The blocks of a well-formed page, flags looked up among all open elements at every piece of text."""

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.open, self.found, self.text, self.linked = [], [], "", ""
        self.feed(html)
        self.close()
        self.flush()

    def flush(self):
        words = self.text.split()
        if words:
            names = [n for n, _ in self.open]
            inside = [int(any(n in group for n in names)) for group in (html_blocks.ARTICLE, html_blocks.FURNITURE)]
            told = any(set(re.findall("[a-z]+", c.lower())) & set(html_blocks.HINTS) for n, c in self.open if n not in html_blocks.ARTICLE)
            self.found.append((" ".join(words), len(words), min(1.0, len(self.linked.split()) / len(words)), *inside, int(told)))
        self.text = self.linked = ""

    def handle_starttag(self, tag, attrs):
        if tag not in html_blocks.INLINE:
            self.flush()
        if tag == "br":
            self.handle_data(" ")
        if tag in html_blocks.VOID:
            return
        if self.open and self.open[-1][0] == tag and tag in ("p", "li", "b", "i"):
            self.open.pop()
        self.open.append((tag, " ".join(v or "" for k, v in attrs if k in ("class", "id", "role"))))

    def handle_endtag(self, tag):
        if tag not in html_blocks.INLINE:
            self.flush()
        if tag in [n for n, _ in self.open]:
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if not any(n in html_blocks.RAW for n, _ in self.open):
            self.text += data
            self.linked += data if "a" in [n for n, _ in self.open] else ""


def slow_features(found):
    rows = []
    for k, block in enumerate(found):
        row = []
        for near in (k, k - 1, k + 1, k - 2, k + 2):
            row += found[near][1:3] if 0 <= near < len(found) else (0, 0.0)
        rows.append((*row, 1 if block[3] else -1 if any(b[3] for b in found) else 0, *block[4:]))
    return rows


def test_html_blocks_by_a_parser(spark):
    pages = [r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect() if r.html]
    for html in [*pages, *html_blocks.PAGES]:
        found = html_blocks.blocks(html)
        assert found == SlowBlocks(html).found
        assert html_blocks.features(found) == slow_features(found)


def test_html_numbers_decide(spark):
    """Without article elements and telling names, words and link density of the neighbours still find most blocks."""
    tree, numbers = html_blocks.train(spark), len(html_blocks.NUMBERS)
    pages = [r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect() if r.html]
    right = total = decided = 0
    for html in pages:
        truth = [b[3] for b in html_blocks.blocks(html)]
        plain = re.sub(r"<(/?)(?:article|nav|footer)>", r"<\1div>", html).replace("class=\"ad\"", "class=\"x1\"")
        rows = html_blocks.features(html_blocks.blocks(plain))
        assert len(rows) == len(truth) and all(row[numbers:] == (0, 0, 0) for row in rows)
        right += sum(html_blocks.classify(tree, row) == t for row, t in zip(rows, truth))
        total += len(truth)
        for row in html_blocks.features(html_blocks.blocks(html)):
            at = tree
            while isinstance(at, tuple) and at[0] < numbers:
                at = at[2] if row[at[0]] <= at[1] else at[3]
            decided += not isinstance(at, tuple)
    print(right, decided, total)
    assert right > 0.7 * total and decided > 0.25 * total


def test_html_changed_names(spark):
    """Names that say nothing change nothing."""
    tree = html_blocks.train(spark)
    for html in html_blocks.PAGES:
        other = re.sub(r"class=(?:a1|x7|t2|t3|col|top|right|base)\b", "class=q9", html)
        assert html_blocks.main_text(other, tree) == html_blocks.main_text(html, tree)


def test_html_advert_inside_an_article(spark):
    tree = html_blocks.train(spark)
    prose = "The river rose by a metre in one night and carried away the wooden bridge below the mill, as it had done before."
    page = f"<nav><a href=1>A</a></nav><article><h1>Flood</h1><p>{prose}</p><div class=advert>{prose}</div><p>{prose}</p></article><footer>Imprint of us</footer>"
    assert html_blocks.main_text(page, tree) == f"Flood\n{prose}\n{prose}"


def test_html_long_pages_take_linear_time():
    def seconds(n):
        html = "<div>" * 5 * n + "</p>x" * n
        return min(timeit.repeat(lambda: html_blocks.blocks(html), number=1, repeat=3))

    assert seconds(20_000) < 20 * seconds(2_000)


SECRET = "Ab3" * 12


def test_secrets(spark, docs):
    texts = {
        1: 'é token = "abcdefghijkl" and password: short token: secret: 0123456789abcdef0',
        2: "AKIAABCDEFGHIJKLMN AKIAABC",
        3: f"client_id=robot {SECRET} https://db.example.com/x",
        4: f"only {SECRET}",
        5: "user: robot" + " " * 300 + SECRET,
        6: None,
        7: "https://db.example.com/x login=robot",
        8: "Password=" + "x" * 12 + " user=bob9 10.0.0.1:80",
    }
    df = spark.createDataFrame([(k, v, 0) for k, v in texts.items()] + [(3, texts[3], 0)], "doc_id long, text string, key int")
    out = {r.doc_id: r for r in secret_report(df).collect()}
    assert secret_report(df).count() == 9
    assert (out[1].n_assign, out[1].n_access, out[1].n_hex) == (1, 0, 1)
    assert out[1].spans.startswith("assign:2:23,hex:")
    assert out[2].spans == "access:0:18"
    assert out[3].spans == f"name:0:15,key:16:{16 + len(SECRET)},endpoint:53:77"
    assert out[4].spans == out[5].spans == out[6].spans == out[7].spans == ""
    assert out[8].spans == "assign:0:21,name:22:31,endpoint:32:43"
    assert out[4].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert secret_report(docs).count() == docs.count() and secret_report(docs.limit(0)).count() == 0


def test_line_dedup(spark, docs):
    rows = [(k, "menu\nown %d\n menu \n\nmenu" % k, "a", "z") for k in range(3)] + [(3, "menu", "a", "z"), (7, "copy", "a", "z"), (8, "copy", "a", "z"), (9, "copy", "a", "z"), (4, "menu\nx", None, "z"), (5, None, "a", "z"), (6, "", "b", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_lines string")
    out = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in line_dedup(df).collect()}
    assert out[0] == ("own 0\n", 5, 3) and out[3] == ("", 1, 1)
    assert out[4] == ("menu\nx", 2, 0) and out[5] == (None, 0, 0) and out[6] == ("", 1, 0)
    assert out[7] == out[8] == ("copy", 1, 0)
    assert line_dedup(docs).count() == docs.count() and line_dedup(docs.limit(0)).count() == 0
    assert line_dedup(docs).columns == docs.columns + ["n_lines", "n_dropped"]


def test_line_dedup_chain_of_near_copies(spark):
    """Pages joined by a chain of shared signatures are one page; another host and a host without name stay apart."""
    marks = {1: [10, 11], 2: [11, 12], 3: [12, 13], 4: [13, 14], 5: [14, 15], 6: [20, 21], 7: [21, 22], 8: [30]}
    rows = [(host, k, held, []) for host in ("a", "b", None) for k, held in marks.items() if host != "b" or k != 3]
    df = spark.createDataFrame(rows, "host string, page long, marks array<long>, lines array<long>")
    groups = {}
    for host, page in _near_pages(df, 0.1).select("host", "page").collect():
        groups.setdefault(host, []).append(page)
    found = {host: sorted(pages.count(p) for p in set(pages)) for host, pages in groups.items()}
    assert found == {"a": [1, 2, 5], None: [1, 2, 5], "b": [1, 2, 2, 2]}
    assert len({p for pages in groups.values() for p in pages if p != 8}) == 7


@pytest.mark.parametrize("pages, copies", [(20, 3), (90, 30)])
def test_line_dedup_near_copies(spark, pages, copies):
    """A group of near copies keeps its text; a menu of the same host goes."""
    rng = np.random.default_rng(3)
    prose = lambda n: [" ".join(f"w{x}" for x in rng.integers(0, 9999, 12)) for _ in range(n)]
    menu, base = ["home about contact", "all rights reserved"], prose(6)
    rows = [(k, "\n".join(menu + prose(6))) for k in range(copies, pages)]
    for k in range(copies):
        words = [line.split() for line in base]
        words[k % 6][k % 12] = f"edit{k}"
        rows.append((k, "\n".join(map(" ".join, words))))
    df = spark.createDataFrame([(i, text, "a") for i, text in rows], "doc_id long, text string, source string")
    out = {r.doc_id: r for r in line_dedup(df, near=True).collect()}
    for k, text in rows:
        assert out[k].text == (text if k < copies else text.split("\n", 2)[2])
    lost = [r for r in line_dedup(df).collect() if r.doc_id < copies and r.n_dropped]
    assert len(lost) == copies


@pytest.mark.parametrize("compressed", ["true", "false"])
def test_warc_filters(spark, tmp_path, compressed):
    payload = b"<p>\r\n\r\nWARC/1.1\r\n" + bytes(range(256)) * 9000
    digest = hashlib.sha1(payload).hexdigest()
    name = tmp_path / ("a.warc.gz" if compressed == "true" else "a.warc")
    records = [
        warc.record("response", "urn:record:1", "http://a/\nb", digest, len(payload), payload, None),
        warc.record("revisit", "urn:record:2", None, digest, len(payload), None, "urn:record:1"),
        warc.record("response", "urn:record:3", "http://c", hashlib.sha1(b"").hexdigest(), 0, b"", None),
    ]
    name.write_bytes(b"".join(warc.zlib.compress(r, wbits=31) for r in records) if compressed == "true" else b"".join(records))
    rows = warc.read_archive(spark, str(tmp_path)).collect()
    assert [(r.record_type, r.record_id, r.target_uri, r.payload_digest, r.refers_to, r.payload_bytes) for r in rows] == [
        ("response", "urn:record:1", "http://a/%0Ab", digest, None, len(payload)),
        ("revisit", "urn:record:2", None, digest, "urn:record:1", len(payload)),
        ("response", "urn:record:3", "http://c", hashlib.sha1(b"").hexdigest(), None, 0),
    ]
    assert [r.payload for r in rows] == [payload, None, b""]
    for test, ids in (("record_type = 'revisit'", [2]), ("target_uri is null", [2]), ("record_id in ('urn:record:3', 'urn:record:2')", [2, 3])):
        found = warc.read_archive(spark, str(tmp_path)).filter(test)
        assert [int(r.record_id[-1]) for r in found.collect()] == ids
        assert "Filter" not in found._jdf.queryExecution().executedPlan().toString().split("BatchScan")[0]
    assert {r.payload for r in warc.read_archive(spark, str(tmp_path), payload=False).collect()} == {None}


def test_warc_round_trip(spark):
    big, other = "é" * 600, "x" * 1000
    rows = [(1, "u", big), (5, "u", big), (3, None, big), (2, "u", other), (4, "u", "small"), (6, "u", "small"), (7, "u", None), (None, "u", big), (2, "u", other)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, payload string")
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.warc_round_trip(pages).collect()), key=str)
    largest = {big: 5, other: 2}
    expected = []
    for id_, _, html in rows:
        data = (html or "").encode()
        again = len(data) >= 1000 and id_ != largest[html]
        expected.append((id_, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", largest[html] if again else None))
    assert got == sorted(expected, key=str)
    assert warc.warc_round_trip(pages.limit(0)).count() == 0


def test_warc_ids_that_are_text(spark):
    page = "x" * 2000
    rows = [("a:b", page), ("c", page), ("d:e é", "y"), (None, "z"), ("s p/%", "w")]
    pages = spark.createDataFrame(rows, "page_id string, html string").withColumn("url", F.lit("http://x"))
    found = warc.warc_round_trip(pages).select("page_id", "payload_bytes", "record_type", "refers_to").collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [("a:b", 2000, "revisit", "c"), ("c", 2000, "response", None), ("d:e é", 1, "response", None), (None, 1, "response", None), ("s p/%", 1, "response", None)], key=str
    )


def test_warc_records_of_any_size():
    import io

    payloads = [b"", b"a", b"b" * 3_000_000, b"c" * 10, b"d" * (1 << 20)]
    data = b"".join(warc.record("response", f"urn:record:{k}", "http://a", hashlib.sha1(p).hexdigest(), len(p), p, None) for k, p in enumerate(payloads))
    whole = list(warc.records(io.BytesIO(data), False, lambda row: True, True))
    assert [r[-1] for r in whole] == payloads
    some = list(warc.records(io.BytesIO(data), False, lambda row: row["record_id"] == "urn:record:3", True))
    assert [r[-1] for r in some] == [payloads[3]]


def test_many_secrets_in_one_text(spark):
    """More matches than a run holds, some of which fail, at places counted here one by one."""
    import random

    from tabkit.llm.secrets import secret_spans

    rnd = random.Random(2)
    text = " ".join(rnd.choice(("é", "漢字 ")) + f"{rnd.getrandbits(64):0{rnd.choice((12, 15, 16, 20))}x}" for _ in range(2000))
    want = [(m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    (row,) = secret_spans(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [(s.start, s.end) for s in row.base if s.kind == "hex"] == want and len(want) > 1000
