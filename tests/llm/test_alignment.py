"""Alignment against a plain walk over the tokens of whole texts."""

import random
from collections import Counter, defaultdict
from hashlib import sha256
from itertools import accumulate

import pytest

from tabkit.llm.alignment import Segments, align

LETTERS = "aab  \n\t'sdrelvm01_-.,!éßñ漢字🤖½²Ⅷ́\x1c\x85\xa0　<0xA>"
ODD = ["<|endoftext|> a <s> b</s>", " ", "  ", "a ", "a  ", "x" * 3000, "漢字" * 500, "a▁b", "▁", "\n", "a\x00b"]


@pytest.fixture(scope="module")
def vocabularies():
    return Segments(None, None)


def spans(text, known):
    """(id, from, to) of the tokens of either side, None if the bytes differ."""
    data, sides = (" " + text).encode(), []
    if not text:
        return None
    for of, ids in ((known.a, known.tokenizer.encode(" " + text, add_special_tokens=False).ids), (known.b, known.processor.encode(text))):
        tokens = [of.tokens[i] for i in ids]
        if b"".join(tokens) != data:
            return None
        ends = [*accumulate(map(len, tokens))]
        sides.append([*zip(ids, [0, *ends], ends)])
    return sides


def expected(texts, known):
    """Per text: the four sizes, best links, sum of counts, digest; by comparing all tokens that can overlap."""
    found = []
    for text in texts:
        sides = spans(text or "", known)
        if sides is None:
            found.append(None)
            continue
        a, b = sides
        links, j = [], 0
        for id, start, end in a:
            while b[j][2] <= start:
                j += 1
            k = j
            while k < len(b) and b[k][1] < end:
                links.append((id, b[k][0]))
                k += 1
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        lists = defaultdict(lambda: ([], []))
        for side in (0, 1):
            at = 0
            for id, _, end in sides[side]:
                while end > cuts[at]:
                    at += 1
                lists[at][side].append(str(id))
        groups = ";".join(",".join(x) + "|" + ",".join(y) for _, (x, y) in sorted(lists.items()))
        found.append((len(a), len(b), len(cuts), links, groups))
    counts = Counter(pair for f in found if f for pair in set(f[3]))
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    for f in found:
        if f is None:
            yield (0, 0, 0, 0, 0, 0, "")
        else:
            yield (*f[:3], len(f[3]), sum(counts[p] == most[p[0]] for p in f[3]), sum(counts[p] for p in f[3]), sha256(f[4].encode()).hexdigest())


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def rows(df):
    return Counter((r.doc_id, *[r[n] for n in NAMES]) for r in df.collect())


@pytest.mark.parametrize("sent", [1_000_000, 40])
def test_random_texts(spark, vocabularies, sent):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(LETTERS + "▁" * (i % 9 == 0)) for _ in range(rnd.randint(0, 60))) for i in range(600)] + ODD
    texts += ["the cat sat on the mat, the end.", "the cat sat", None]
    df = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    assert rows(align(df, sent_pairs=sent)) == Counter((i, *e) for i, e in enumerate(expected(texts, vocabularies)))


def test_odd_rows(docs, vocabularies):
    given = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = Counter((i, *e) for (i, _), e in zip(given, expected([t for _, t in given], vocabularies)))
    assert rows(align(docs)) == want
    assert align(docs.limit(0)).count() == 0


def test_full_output(spark, vocabularies):
    texts = ["a b  c\nd", "é漢字🤖 ½ Ⅷ", "x▁y", "tokenization ofwords "]
    df = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    for r in align(df, full=True).collect():
        sides = spans(texts[r.doc_id], vocabularies) or ([], [])
        assert [*zip(r.a_ids, r.a_ends)] == [(i, e) for i, _, e in sides[0]]
        assert [*zip(r.b_ids, r.b_ends)] == [(i, e) for i, _, e in sides[1]]


def test_forgetting_changes_nothing(spark, vocabularies, monkeypatch):
    from tabkit.llm import alignment

    monkeypatch.setattr(alignment, "KNOWN_BYTES", 1)
    monkeypatch.setattr(alignment, "CHUNK_LETTERS", 10)
    texts = ["one two three", "two three four", "", "three"]
    df = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    assert rows(align(df)) == Counter((i, *e) for i, e in enumerate(expected(texts, vocabularies)))
