"""Resampling against the definition, one row after the other."""

import math
import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabkit.llm.resample import Checksums, _features, cutoff, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def buckets(text, n=10_000):
    found = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = found + [f"{a} {b}" for a, b in zip(found, found[1:])]
    return len(found), [crc32(r.encode()) % n for r in runs]


def expected(rows, target, percent=25, least=20):
    held = [(id, *buckets(text)) for id, text in rows]
    s, t = Counter(b for h in held for b in h[2]), Counter(b for text in target for b in buckets(text)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (sum(s.values()) + 10_000) / ((s[b] + 1.0) * (sum(t.values()) + 10_000))))
    out, may = [], []
    for id, n, b in held:
        weight = sum(map(gain, b)) // len(b) if b else 0
        h = int(sha256(f"7:{'' if id is None else id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([id, len(b), weight, score, None])
        if n >= least:
            may.append(out[-1])
    may.sort(key=lambda r: (-r[3], r[0] is None, r[0], r[1]))
    for k, row in enumerate(may[: percent * len(may) // 100]):
        row[4] = k + 1
    return Counter(map(tuple, out))


def found(df):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect())


def test_checksums():
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("abC é漢0 \n-.") for _ in range(rnd.randint(0, 200))) for _ in range(300)]
    texts += ["x" * 31, "x" * 32, "x" * 33 + " " + "y" * 100, "a " + "z" * 1000, None, "", "--"]
    for at, n, single, pairs, of_pair in _features(pa.array(texts), Checksums(), 10_000):
        for d, words in enumerate(n):
            want = buckets(texts[at + d])
            own = single[n[:d].sum() : n[:d].sum() + words].tolist() + pairs[of_pair == d].tolist()
            assert (words, own) == want, texts[at + d]


def test_against_the_definition(spark):
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)] + ["é漢", "X" * 40, "Ab"]
    rows = [(i // 2 if i < 40 else i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60)))) for i in range(400)]
    rows += [(None, rows[0][1]), (None, rows[0][1]), (900, None), (901, "")]
    target = [" ".join(vocabulary[:9]), None, "W1 w2"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    benchmark = spark.createDataFrame([(t,) for t in target], "text string")
    assert found(resample(docs, benchmark)) == expected(rows, target)


def test_odd_rows(docs, benchmark):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    target = [r.text for r in benchmark.select("text").collect()]
    for percent in (0, 25, 60, 100):
        assert found(resample(docs, benchmark, percent=percent)) == expected(rows, target, percent)
    assert found(resample(docs, benchmark.limit(0))) == expected(rows, [])
    assert resample(docs.limit(0), benchmark).count() == 0


@pytest.mark.parametrize("parts", [1, 7])
def test_cutoff_of_every_kind_of_rank(spark, parts):
    """Ties, partitions of very different sizes, sorted and shuffled input."""
    rnd = np.random.default_rng(1)
    low = np.concatenate((np.arange(500), rnd.integers(0, 5, 700), np.full(300, 2)))
    rows = [(int(x), i % 3 == 0, None if i % 3 == 0 else i % 50, 1, i) for i, x in enumerate(low)]
    df = spark.createDataFrame(rows, "low long, none boolean, id long, n_features long, row long")
    df = df.repartition(parts, F.expr("id > 10"))
    order = sorted(rows, key=lambda r: (r[0], r[1], r[2] or 0, r[3], r[4]))
    for take in (1, 2, 299, 750, 1499, 1500):
        assert tuple(cutoff(df, take, few=10))[:5] == order[take - 1]
    assert cutoff(df, 0) is None


def test_text_ids(spark):
    rows = [(f"d{i}", " ".join(f"w{(i * k) % 17}" for k in range(25))) for i in range(50)]
    out = resample(spark.createDataFrame(rows, "doc_id string, text string"), spark.createDataFrame([("w1 w2",)], "text string"))
    assert found(out) == expected(rows, ["w1 w2"])
