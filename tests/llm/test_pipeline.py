"""The registered queries against their SQL, and the pipeline against its parts by brute force."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from oracle import connect, difference
from tabkit.llm import language, queries

from .test_pairs import contaminated_rows, grouped

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_agrees_with_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.SQL[name]) is None


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and [n for k in range(1, 14) for n in names if n.startswith(f"op{k}_")] == list(sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0])))


@pytest.mark.parametrize("name", ["op3_decontamination", "op5_bpe", "op8_jaccard_join", "op9_language_id", "op10_order_minhash", "op11_exact_dedup", "op12_alignment", "op13_resample"])
def test_one_row_a_document(spark, name):
    folder = "/root/testdata/sf0.001"
    assert queries.QUERIES[name](spark, folder).select("doc_id").distinct().count() == 200


def test_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {"language": lambda rows: [r.doc_id for r in rows if any(c.isalpha() for c in r.text)], "boilerplate": lambda rows: [r.doc_id for r in rows]}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    kept["near_duplicates"] = lambda rows: [i for i, _, least in grouped([(r.doc_id, r.text) for r in rows]) if i == least]
    kept["contaminated"] = lambda rows: [r[0] for r in contaminated_rows([(r.doc_id, r.text) for r in rows], items) if not r[-1]]
    from tabkit.session import written

    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs.collect(), written(stage(spark, docs, folder))
        assert docs.columns == columns
        assert sorted(r.doc_id for r in docs.collect()) == sorted(kept[name](before))
    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r.doc_id for r in whole) == sorted(r.doc_id for r in docs.collect())
    assert all(len(r.ids) == r.n_tokens for r in whole)


def test_stages_on_edges(spark, docs):
    from pyspark.sql import functions as F

    docs = docs.withColumn("n_chars", F.length("text").cast("long")).select("doc_id", "text", "lang", "source", "n_chars")
    for start in (docs, docs.limit(0)):
        rows = start
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, "/root/testdata/sf0.001")
        ids = sorted(r.doc_id for r in rows.collect() if r.doc_id is not None)
        assert ids == ([] if start is not docs else [1, 7, 8, 10, 11])


def test_texts_that_share_an_id(spark):
    """A row goes only if its text is linked to one that stays; empty texts are linked with nothing."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (7, c), (7, a + " x"), (7, c), (None, b), (None, "new text of a null id here"), (9, None), (9, None), (9, " ")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(3, a), (5, b), (7, c), (None, "new text of a null id here"), (9, None), (9, None), (9, " ")], key=str
    )


@pytest.mark.parametrize("above", [True, False])
def test_language_share(spark, monkeypatch, above):
    """The score rule at the shares 4/13 and 3/11, above and below LEAST_SCORE, of five scripts counted by hand."""
    words = {"en": "abcd", "el": "αβγδ", "ru": "абвг", "he": "אבגד", "hy": "աբգդ"}
    model = language.train(spark.createDataFrame([(k, f"{w} {w}", n) for k, (n, w) in enumerate(words.items())], "doc_id long, text string, lang string"))
    monkeypatch.setattr(corpus_pipeline, "train", lambda docs: model)
    monkeypatch.setattr(corpus_pipeline, "predict", lambda *a, **k: language.predict(*a, **k, penalty=0.0))
    counts = [4, 3, 2, 2, 2] if above else [3, 2, 2, 2, 2]
    text = " ".join(w[:n] for w, n in zip(words.values(), counts))
    letters = [sum(c in w for c in text) for w in words.values()]
    share = max(letters) / sum(letters)
    assert letters == counts and abs(share - corpus_pipeline.LEAST_SCORE) < 0.03
    docs = spark.createDataFrame([(1, text, "en", "a", len(text))], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.language(spark, docs, "")
    assert kept.count() == int(share >= corpus_pipeline.LEAST_SCORE) == int(above)


def test_encoder_gets_few_rows_at_a_time(spark, monkeypatch):
    """The stage alone sends small batches and no decoded texts; the session keeps its own setting."""
    from tabkit.llm import bpe

    def counted(*args):
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"id": batch["id"], "n_tokens": [batch.num_rows] * batch.num_rows, "ids": [[]] * batch.num_rows}, schema=schema)

        schema = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])
        return run

    monkeypatch.setattr(bpe, "_encoded", counted)
    before = spark.conf.get(corpus_pipeline.BATCH_ROWS)
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("a").alias("text")).coalesce(1)
    rows = corpus_pipeline.encode(spark, docs, "").collect()
    assert len(rows) == 2000 and max(r.n_tokens for r in rows) <= corpus_pipeline.ENCODED_ROWS
    assert spark.conf.get(corpus_pipeline.BATCH_ROWS) == before
