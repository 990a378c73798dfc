"""Block names against plain comparison of the texts."""

from collections import Counter, defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tabkit.llm.block_names import SPACES, exact_dedup, identities

from .conftest import clashing


def expected(rows):
    groups = defaultdict(list)
    for id, text in rows:
        text = text or ""
        groups["".join(c for c in text if c not in SPACES)].append((-len(text), id is None, id))
    out = Counter()
    for t, members in groups.items():
        first, digest = min(members), sha256(t.encode()).hexdigest()
        for m in members:
            out[m[2], first[2], len(members), digest] += 1
    return out, Counter((min(members)[2], t) for t, members in groups.items())


def check(df, size):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    found = exact_dedup(df, size=size).collect()
    want, kept = expected(rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == want
    assert sum(r.kept for r in found) == sum(kept.values())
    assert all(r.keep_id == r.doc_id for r in found if r.kept)


@pytest.mark.parametrize("size", [3, 1024])
def test_odd_rows(docs, size):
    check(docs, size)


def test_empty_table(docs):
    assert exact_dedup(docs.limit(0)).count() == 0


def test_blocks_that_recur_in_other_texts(spark):
    """Every block occurs elsewhere, at the same place and in texts of the same length, and yet most texts are alone."""
    parts = ["aaaa", "bbbb", "cccc", "dddd"]
    texts = [x + y + z for x in parts for y in parts for z in parts]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100, "aaaa bbbb cccc"), (101, "aaaabbbbcccc"), (102, "aaaa"), (103, " "), (104, None)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), 4)


def test_names_tell_lengths_apart(spark):
    df = spark.range(12).select(F.col("id").alias("row"), F.expr("repeat('ab', cast(id div 2 as int))").cast("binary").alias("bytes"))
    df = df.withColumn("n_bytes", F.octet_length("bytes").cast("long"))
    found = identities(df, size=2).collect()
    assert len(found) == 12
    named = defaultdict(set)
    for r in found:
        named[r.n_bytes, r.name].add(r.row)
    assert sorted(map(sorted, named.values())) == [[2 * k, 2 * k + 1] for k in range(6)]


def test_a_large_group(spark):
    """Two thirds of the rows are one text of many blocks, copies with other white space among them."""
    copies = spark.range(4000).select(F.col("id").alias("doc_id"), F.expr("concat(repeat('copy ', 100), if(id % 2 = 0, ' ', ''))").alias("text"))
    others = spark.range(4000, 6000).select(F.col("id").alias("doc_id"), F.expr("concat(repeat('copy', 99), id)").alias("text"))
    found = exact_dedup(copies.union(others), size=16)
    assert {(r.keep_id, r.group_size, r["count"]) for r in found.filter("doc_id < 4000").groupBy("keep_id", "group_size").count().collect()} == {(0, 4000, 4000)}
    assert found.filter("doc_id >= 4000 and not (kept and group_size = 1 and keep_id = doc_id)").count() == 0
