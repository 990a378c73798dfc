"""Similarity join, decontamination and components against brute force."""

import random
import re

import pytest

from tabkit.llm import jaccard_join as join
from tabkit.llm.components import components
from tabkit.llm.decontaminate import contamination
from tabkit.llm.words import NOT_SPACE, shingles, slices, words

LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text, width=5):
    found = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate(LOWER)) if w]
    if len(found) < width:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + width]) for i in range(len(found) - width + 1))


def grouped(rows, percent=80):
    """By row: size of the set and smallest id of its group, all pairs compared."""
    sets, group = [shingle_set(t) for _, t in rows], list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                group[top(i)] = top(j)
    out = []
    for i, (id_, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(i) and rows[j][0] is not None]
        out.append((id_, len(sets[i]), min(ids, default=None) if sets[i] else id_))
    return sorted(out, key=str)


def result(df, percent=80):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in join.jaccard_join(df, percent=percent).collect()), key=str)


def test_edge_cases(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(docs) == grouped(rows)
    assert join.jaccard_join(docs.limit(0)).count() == 0
    empty = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert result(empty) == [(1, 0, 1), (2, 0, 2)]


@pytest.mark.parametrize("light", [True, False])
def test_near_copies(spark, monkeypatch, light):
    """A group whose members are not all linked with each other, chains, and passages in common."""
    monkeypatch.setattr(join, "ROW_COST", 0 if light else 10**9)
    rnd = random.Random(5)
    base, passage = [f"w{rnd.randint(0, 10**6)}" for _ in range(120)], [f"p{i}" for i in range(30)]
    rows = []
    for k in range(60):
        text = list(base)
        for _ in range(rnd.choice((0, 1, 1, 2, 3))):
            text[rnd.randrange(len(text))] = f"e{rnd.randint(0, 10**6)}"
        rows.append((k, " ".join(text)))
    for k in range(60, 110):
        own = [f"u{rnd.randint(0, 10**6)}" for _ in range(rnd.choice((3, 20, 80)))]
        rows.append((k, " ".join(own + passage)))
    rows += [(k, " ".join(f"c{i}" for i in range(k, k + 60))) for k in range(200, 230, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df) == grouped(rows)


@pytest.mark.parametrize("percent", [20, 50, 80, 90, 95, 99])
def test_other_thresholds(spark, monkeypatch, percent):
    """Pairs of sets just at and just below the threshold, of many sizes; lists larger than a block."""
    monkeypatch.setattr(join, "BLOCK_MEMBERS", 3)
    rnd, rows = random.Random(percent), []

    def new(k):
        return [f"n{rnd.randint(0, 10**9)}" for _ in range(k)]

    for n in [*range(2, 44), 60, 99, 100, 101, 140]:
        common = new(n + 4)
        least = -(-percent * n // 100)
        for cut in {n, least, least + 1, least - 1}:
            if 0 < cut <= n:  # sets of n and cut shingles, one in the other
                rows += [" ".join(common), " ".join(common[n - cut :])]
        ends = rnd.randint(1, 3)
        rows += [" ".join(common[:-ends] + new(ends)), " ".join(new(ends) + common[ends:])]
    rnd.shuffle(rows)
    rows = [*enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df, percent) == grouped(rows, percent)


def test_few_pairs_of_a_large_group(spark, monkeypatch):
    """Near copies next to the threshold: few pairs are compared last, and none of those that are links is lost."""
    seen, rnd, open_pairs = [], random.Random(3), join._open_pairs

    def counted(*args, **kwargs):
        pairs = open_pairs(*args, **kwargs)
        seen.append(pairs.count())
        return pairs

    monkeypatch.setattr(join, "_open_pairs", counted)
    monkeypatch.setattr(join, "LEADER_ROUNDS", 1)
    monkeypatch.setattr(join, "MOST_ROUNDS", 1)
    base, rows = [f"w{i}" for i in range(150)], []
    for k in range(300):
        text = list(base)
        for at in rnd.sample(range(150), rnd.choice((1, 2, 3, 4, 5))):
            text[at] = f"e{rnd.randint(0, 10**9)}"
        rows.append((k, " ".join(text)))
    expected = grouped(rows)
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == expected
    apart = len({least for _, _, least in expected})
    assert apart > 100 and len(seen) == 2 and sum(seen) < 30 * len(rows), (apart, seen)


def test_bitmaps_differ_no_more_than_sets():
    import numpy as np

    rnd = np.random.default_rng(1)
    for n in (1, 40, 300, 3000):
        tokens = rnd.integers(0, 2**64, 2 * n, dtype=np.uint64)
        for cut in (0, 1, n // 10, n):
            a, b = join._bitmap(tokens[:n]), join._bitmap(tokens[cut : cut + n])
            assert len(a) == join.BITMAP_WORDS
            assert np.unpackbits((a ^ b).view(np.uint8)).sum() <= 2 * cut and ((a == b).all() or cut)


def test_demands_are_covered():
    """What a set sends holds as many shared shingles as the larger demand, for all linked sizes."""
    for percent in (25, 30, 50, 67, 80, 90, 95, 99, 100):
        sent = [join._sent(n, percent) if n else 0 for n in range(700)]
        for n in range(1, 400):
            for m in range(n, min(len(sent), n * 100 // percent + 1)):
                shared = max(join._shared_by(n, m, percent), join._needed(m, percent))
                for a, b in ((n, m), (m, n)):
                    met = min(shared, sent[a] - (a - shared), sent[b] - (b - shared))
                    assert met >= min(shared, join._spare(a)), (percent, n, m)


def test_many_texts(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert result(df) == grouped([(r.doc_id, r.text) for r in df.collect()])


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 200)]
    out = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert out == {i: 0 for i in range(41)} | {100: 100, 101: 100, 200: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words():
    import pyarrow as pa

    texts = ["a b A b", None, "abcdefgh abcdefghi abcdefghj É", ""]
    (_, data, bounds), = slices(pa.array(texts))
    w = words(data, bounds, NOT_SPACE)
    assert [w.text(i).decode() for i in range(len(w.start))] == ["a", "b", "a", "b", "abcdefgh", "abcdefghi", "abcdefghj", "É"]
    h = w.hashes()
    assert list(w.first) == [0, 4, 4, 8, 8] and h[0] == h[2] and len(set(h)) == 6
    tokens, share = shingles(h, w.first)
    assert list(share) == [0, 1, 1, 2, 2]


def contaminated_rows(docs, items):
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    split = lambda t: pattern.findall((t or "").translate(LOWER))
    windows = {}
    for item, text in items:
        found = split(text)
        m = min(13, len(found))
        for k in range(len(found) - m + 1 if found else 0):
            windows.setdefault(tuple(found[k : k + m]), set()).add(item)
    out = []
    for id_, text in docs:
        found, hit, held = split(text), set(), set()
        for m in {len(w) for w in windows}:
            for k in range(len(found) - m + 1):
                if tuple(found[k : k + m]) in windows:
                    hit.update(range(k, k + m))
                    held |= windows[tuple(found[k : k + m])]
        held = sorted(str(i) for i in held if i is not None)
        out.append((id_, len(found), len(hit), len(held), held, bool(hit) and 20 * len(hit) >= len(found)))
    return sorted(out, key=str)


@pytest.mark.parametrize("whole", [True, False])
def test_contamination(spark, docs, benchmark, whole):
    if whole:
        folder = "/root/testdata/sf0.001"
        docs, benchmark = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    rows = contamination(docs, benchmark).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r["items"], r.contaminated) for r in rows), key=str)
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got == contaminated_rows(texts, [(r.item_id, r.text) for r in benchmark.select("item_id", "text").collect()])
    assert {r.n_hit for r in contamination(docs, benchmark.limit(0)).collect()} == {0}
    assert contamination(docs.limit(0), benchmark).count() == 0
