"""Counts and ids against the tokenizers' own libraries."""

import random
from hashlib import sha256

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer, models, normalizers

from tabkit.llm import bpe as bpe_module
from tabkit.llm.bpe import Encoder, bpe_encode
from tabkit.llm.unigram import SPACE, Counter, read_pieces, token_counts

LETTERS = "aab  \n\t'sdrelvm01_-.,!éßñ漢字🤖½²Ⅷ́\x1c\x85\xa0　<0xA>▁"


def random_texts(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(LETTERS) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def bpe():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def unigram(pieces, bytewise):
    out = Tokenizer(models.Unigram(pieces, 0, bytewise))
    out.normalizer = normalizers.Sequence([normalizers.Prepend(SPACE), normalizers.Replace(" ", SPACE)])
    return out


def ids(encoder, text):
    out = []
    for part, special in encoder.parts(text):
        if special is None:
            for word in encoder.words(part):
                out += encoder.word(word.encode())
        else:
            out.append(special)
    return out


def test_bpe_of_random_texts(bpe):
    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for text in [*random_texts(5000, 1), "a<|endoftext|>b", "aaaaaaaaaaaaaaaaaaaaaaa", " " * 100, "ᲉꟋ x"]:
        assert ids(encoder, text) == bpe.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("bytewise", [True, False])
def test_unigram_of_random_texts(bytewise):
    pieces = [p for p in read_pieces() if bytewise or not p[0].startswith("<0x")]
    library, counter = unigram(pieces, bytewise), Counter(pieces)
    for text in random_texts(3000, 2):
        assert counter.count(text) == len(library.encode(text).ids), text


def test_unigram_ties():
    pieces = [("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("aba", -3.0), (SPACE, -1.0)]
    library, counter = unigram(pieces, False), Counter(pieces)
    for text in ("ab", "aba", "ababa", "bab ab", "abx", "xxab"):
        assert counter.count(text) == len(library.encode(text).ids), text


def test_operators(docs, bpe):
    texts = {(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()}
    out = bpe_encode(docs).collect()
    assert len(out) == docs.count()
    assert {(r.doc_id, r.decoded) for r in out} == texts
    expected = {(i, tuple(bpe.encode(t, add_special_tokens=False).ids)) for i, t in texts}
    assert {(r.doc_id, tuple(r.ids)) for r in out} == expected
    digests = bpe_encode(docs, digests=True).collect()
    assert {(r.doc_id, r.n_tokens, r.ids_sha256) for r in digests} == {
        (i, len(x), sha256(",".join(map(str, x)).encode()).hexdigest()) for i, x in expected
    }
    library = unigram(read_pieces(), True)
    assert {(r.doc_id, r.n_tokens) for r in token_counts(docs).collect()} == {(i, len(library.encode(t).ids) if t else 0) for i, t in texts}
    for operator in (bpe_encode, token_counts):
        assert operator(docs.limit(0)).count() == 0


def test_texts_are_encoded_in_bounded_runs(monkeypatch):
    monkeypatch.setattr(bpe_module, "TOGETHER_BYTES", 100)
    texts = ["a b " * 20, None, "", "c" * 30, "d" * 500, None, "e f"] * 3
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    out = list(bpe_module._encoded(None, pa.int64(), True)(iter([batch, batch.slice(0, 0), batch.slice(3, 2)])))
    assert max(sum(len(text) for text in b["decoded"].to_pylist()[1:]) for b in out) < 100
    rows = [r for b in out for r in b.to_pylist()]
    assert [(r["id"], r["decoded"]) for r in rows] == [(i, t or "") for i, t in [*enumerate(texts), *list(enumerate(texts))[3:5]]]
    assert all(len(r["ids"]) == r["n_tokens"] for r in rows)


def test_ids_without_decoding(docs):
    out = bpe_encode(docs, decode=False)
    assert out.columns == ["doc_id", "n_tokens", "ids"]
    key = lambda r: (r.doc_id is None, r.doc_id, r.n_tokens, r.ids)
    assert sorted(map(key, out.collect()), key=str) == sorted(map(key, bpe_encode(docs).collect()), key=str)
    assert bpe_encode(docs, digests=True, decode=False).columns == ["doc_id", "n_tokens", "ids_sha256"]


def test_words_met_lately_are_remembered(monkeypatch):
    """The memory of words stays bounded, and a word that keeps coming is encoded once."""
    monkeypatch.setattr(bpe_module, "KNOWN_WORDS", 10)
    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    known, encoded, word = bpe_module._Known(encoder), [], encoder.word
    monkeypatch.setattr(encoder, "word", lambda data: encoded.append(data) or word(data))
    for k in range(100):
        assert [known[w][0] for w in ("often", f"w{k}")] == [",".join(map(str, word(w.encode()))) for w in ("often", f"w{k}")]
        assert len(known) + len(known.before) <= 20
    assert encoded.count(b"often") == 1 and len(encoded) == 101


def test_new_words_are_encoded_together(monkeypatch, bpe):
    """A byte of all of them at a time gives the ids that one word at a time gives; only long ones are encoded singly, and the memory stays bounded."""
    monkeypatch.setattr(bpe_module, "WORDS_TOGETHER", 50)
    monkeypatch.setattr(bpe_module, "KNOWN_WORDS", 60)
    encoder, rnd = Encoder(public_tokenizers.path("byte_bpe_50k.json")), random.Random(4)
    data = [bytes(rnd.choice(some) for _ in range(rnd.randint(1, 64))) for some in (b"ab", b"- =", b"thionger", bytes(range(256))) for _ in range(300)]
    found, count = encoder.together(data)
    assert found.tolist() == [i for word in data for i in encoder.word(word)]
    assert count.tolist() == [len(encoder.word(word)) for word in data]
    known, singly, word = bpe_module._Known(encoder), [], encoder.word
    monkeypatch.setattr(encoder, "word", lambda data: singly.append(data) or word(data))
    words = [" often" if k % 2 else rnd.choice(["", " "]) + f"{k % 70}thion" * (1 + 30 * (k % 40 == 0)) for k in range(1000)]
    words[500] = 50256
    for text, n, decoded in (all := known.all(words)):
        assert text.count(",") + 1 == n and bpe.decode(list(map(int, text.split(","))), skip_special_tokens=False).encode() == decoded
    assert [text for text, _, _ in all] == [",".join(map(str, [w] if w == 50256 else bpe.encode(w, add_special_tokens=False).ids)) for w in words]
    assert singly and min(map(len, singly)) > bpe_module.LONGEST_TOGETHER
    assert len(known) <= 60 and len(known.before) <= 60
    assert encoder.together([])[0].tolist() == [] and known.all([]) == []


def test_words_of_latin_texts_are_split_as_the_library_splits_them(bpe):
    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for c in map(chr, range(0x250)):
        text = f"a{c}b 1{c}2 {c}{c}  {c}'s{c}_!{c}! {c}"
        assert encoder.words(text) == [text[a:b] for _, (a, b) in bpe.pre_tokenizer.pre_tokenize_str(text)], ascii(c)


def test_a_file_is_read_once_while_it_stays_as_it_is(tmp_path):
    from pathlib import Path

    held = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")
    file = tmp_path / "vocabulary.json"
    file.write_text(held, encoding="utf-8")
    first = bpe_module.shared_encoder(str(file))
    assert bpe_module.shared_encoder(str(file)) is first
    file.write_text(held + " ", encoding="utf-8")
    assert bpe_module.shared_encoder(str(file)) is not first
