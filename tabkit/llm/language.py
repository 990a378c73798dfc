"""Language ID of mixed text: scripts narrow the candidates, Viterbi over words labels spans.

A word's score for a language is the log likelihood of its letters, each seen with its neighbours, under
counts learned from labelled rows. A path over the words of a text changes language at a penalty. Texts
that no change can pay off for are recognised from running sums; the others go through the recurrence,
word by word, many texts at a time.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructType

from ..session import fits_broadcast, written
from .words import mixed, numbers

UNKNOWN = "und"
# Labelled rows of each language that the counts are learned from, on average; rows are chosen by a hash of the id.
SAMPLE_ROWS = 8_000
BUCKETS = 1 << 18
SWITCH_PENALTY = 20.0
# What a word costs in a language that is not written in its script.
FOREIGN_SCRIPT = 50.0
SCRIPT_SHARE = 0.01
# Rows are labelled together up to about this many bytes of text. Of these so many characters are read at a time, as the arrays
# of their letters take a hundred times as much; only the scores of words are kept.
TEXTS_BYTES = 1_000_000
READ_CHARS = 100_000

# First and last code points of scripts; all other letters form one more script.
SCRIPTS = (
    ("latin", 0x0041, 0x024F),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
)

_NEIGHBOUR = numbers(21, 3)


def letter_scripts() -> np.ndarray:
    """By code point: 0 for what is no letter, else the number of its script."""
    names = list(dict.fromkeys(name for name, _, _ in SCRIPTS))
    out = np.full(0x110000, len(names) + 1, np.uint8)
    for name, first, last in SCRIPTS:
        out[first : last + 1] = names.index(name) + 1
    letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return np.where(letters, out, 0).astype(np.uint8)


@dataclass
class Text:
    """Consecutive texts as letters and words: ``first[d]:first[d + 1]`` are the words of text ``d``."""

    buckets: np.ndarray  # of each letter with its neighbours
    script: np.ndarray  # of each letter
    begin: np.ndarray  # first letter of each word, among the letters
    start: np.ndarray  # of each word, in code points of its text
    end: np.ndarray
    first: np.ndarray


def read(texts: list[str], scripts: np.ndarray) -> Text:
    lower = [t.lower() if len(t.lower()) == len(t) else "".join(c if len(c.lower()) > 1 else c.lower() for c in t) for t in texts]
    bounds = np.cumsum([0] + [len(t) + 1 for t in lower])
    codes = np.frombuffer("\n".join(lower + [""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(codes):
        codes = np.array([10], np.uint32)
    script = scripts[codes]
    inside = script > 0
    seen = np.where(inside, codes, 0).astype(np.uint64)
    around = np.concatenate(([np.uint64(0)], seen, [np.uint64(0)]))
    at = np.flatnonzero(inside)
    mix = around[at] * _NEIGHBOUR[0] + around[at + 1] * _NEIGHBOUR[1] + around[at + 2] * _NEIGHBOUR[2]
    new = np.flatnonzero(np.concatenate(([True], np.diff(at) > 1))) if len(at) else np.zeros(0, np.int64)
    last = np.append(new[1:], len(at)) - 1 if len(at) else new
    start, end = at[new], at[last] + 1
    first = np.searchsorted(start, bounds)
    base = np.repeat(bounds[:-1], np.diff(first))
    return Text((mixed(mix) & np.uint64(BUCKETS - 1)).astype(np.int64), script[at], new, start - base, end - base, first)


@dataclass
class Model:
    """Log probabilities by bucket and language, and which scripts a language is written in."""

    langs: list[str]
    weights: np.ndarray
    written_in: np.ndarray  # script x language

    def word_scores(self, text: Text) -> np.ndarray:
        if not len(text.begin):
            return np.zeros((0, len(self.langs)))
        scores = np.add.reduceat(self.weights[text.buckets].astype(np.float64), text.begin, axis=0)
        known = self.written_in[text.script[text.begin]]
        some = known.any(axis=1, keepdims=True)
        return np.where(some, np.where(known, scores, scores.max(axis=1, keepdims=True) - FOREIGN_SCRIPT), 0.0)


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of every word. On equal paths the first language wins, and staying before changing."""
    out = np.zeros(len(scores), np.int64)
    count = np.diff(first)
    if not len(scores):
        return out
    own = np.repeat(np.arange(len(count)), count)
    totals = np.zeros((len(count), scores.shape[1]))
    np.add.at(totals, own, scores)
    best = totals.argmax(axis=1)
    out[:] = best[own]
    # A path of k stretches in other languages changes at least k - 1 times, so with k > 1 some stretch must
    # gain more than half a penalty over the best language, with k = 1 a whole one. The largest gain of any
    # stretch is the largest rise of a running sum within a text.
    gains = scores - np.take_along_axis(scores, best[own][:, None], 1)
    mixed_ = np.zeros(len(count), bool)
    fall = 2.0 * (np.abs(gains).sum() + 1.0)  # sets the running minimum back at each text
    for lang in range(scores.shape[1]):
        sums = np.cumsum(gains[:, lang]) - own * fall
        before = sums - gains[:, lang]
        rise = sums - np.minimum.accumulate(before)
        np.logical_or.at(mixed_, own[rise > penalty / 2 - 1e-6], True)
    texts = np.flatnonzero(mixed_)
    texts = texts[np.argsort(-count[texts], kind="stable")]  # those still running are a head of the list
    if not len(texts):
        return out
    length, begin = count[texts], first[texts]
    steps = int(length[0])
    running = np.searchsorted(-length, -np.arange(steps), "left")  # texts longer than t
    state = scores[begin].copy()
    came = []
    for t in range(1, steps):
        n = running[t]
        held = state[:n]
        top = held.argmax(axis=1)
        change = held[np.arange(n), top] - penalty
        stay = held >= change[:, None]
        came.append(np.where(stay, np.arange(held.shape[1]), top[:, None]).astype(np.int16))
        state[:n] = np.where(stay, held, change[:, None]) + scores[begin[:n] + t]
    label = state.argmax(axis=1)
    for t in range(steps - 1, 0, -1):
        n = running[t]
        out[begin[:n] + t] = label[:n]
        label[:n] = came[t - 1][np.arange(n), label[:n]]
    out[begin] = label
    return out


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts, without the first, have fewer than ``TEXTS_BYTES``; a batch without rows stays one."""
    for batch in batches:
        upto = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        first = np.flatnonzero(np.diff(upto // TEXTS_BYTES, prepend=-1)) if len(upto) else np.zeros(1, np.int64)
        for begin, end in zip(first, np.append(first[1:], batch.num_rows)):
            yield batch.slice(begin, end - begin)


def _groups(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    at = size = 0
    for k, text in enumerate(texts):
        size += len(text)
        if size > READ_CHARS or k == len(texts) - 1:
            yield at, texts[at : k + 1]
            at, size = k + 1, 0


def _added(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of counts by bucket."""
    bucket, count = map(np.concatenate, zip(*counts))
    found, at = np.unique(bucket, return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, at, count)
    return found, total


def _counts(scripts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _bounded(batches):
            texts, langs = [t or "" for t in batch["text"].to_pylist()], np.array(batch["lang"].to_pylist(), object)
            counts = defaultdict(list)
            for at, group in _groups(texts):
                read_ = read(group, scripts)
                letters = np.diff(np.append(read_.begin, len(read_.buckets))) if len(read_.begin) else np.zeros(0, np.int64)
                lang = np.repeat(np.repeat(langs[at : at + len(group)], np.diff(read_.first)), letters)
                for name in set(lang):
                    mine = lang == name
                    # Scripts are counted in places behind the buckets.
                    held = np.concatenate((read_.buckets[mine], BUCKETS + read_.script[mine].astype(np.int64)))
                    counts[name].append(np.unique(held, return_counts=True))
            for name, found in counts.items():
                bucket, count = _added(found)
                yield pa.RecordBatch.from_pydict({"lang": [name] * len(bucket), "bucket": bucket, "count": count})

    return run


def train(docs: DataFrame, text: str = "text", lang: str = "lang", id: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from about ``sample_rows`` rows of each label, all where there are fewer; without any, the model knows no language."""
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(id).alias("id"))
    # One row a language, of which the model holds a column each. Rows without an id are told apart by their texts.
    sizes = written(rows.groupBy("lang").agg(F.count("*").alias("n")))
    sizes = F.broadcast(sizes) if fits_broadcast(sizes.count(), 2) else sizes
    mark = F.when(F.col("id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("id"))
    chosen = rows.join(sizes, "lang").filter(F.pmod(mark, F.col("n")) < sample_rows).select("text", "lang")
    scripts = letter_scripts()
    counted = chosen.mapInArrow(_counts(scripts), "lang string, bucket long, count long").groupBy("lang", "bucket").agg(F.sum("count").alias("count")).toArrow()
    langs = sorted(set(counted["lang"].to_pylist()))
    at = np.array([langs.index(x) for x in counted["lang"].to_pylist()], np.int64)
    bucket, count = counted["bucket"].to_numpy(), counted["count"].to_numpy()
    table = np.zeros((BUCKETS + 256, max(1, len(langs))))
    table[bucket, at] = count
    grams, written_in = table[:BUCKETS] + 0.5, table[BUCKETS:]
    share = written_in / np.maximum(1, written_in.sum(axis=0))
    return Model(langs, np.log(grams / grams.sum(axis=0)).astype(np.float32), share >= SCRIPT_SHARE)


def _labelled(model, scripts, penalty: float, schema: pa.Schema):
    def rows_of(texts: list[str]) -> Iterator[tuple]:
        held, table = Model(*model.value), scripts.value
        if not held.langs:
            yield from ((UNKNOWN, 0.0, []) for _ in texts)
            return
        parts = []
        for _, group in _groups(texts):
            words = read(group, table)
            parts.append((held.word_scores(words), words.start, words.end, np.diff(words.first)))
        scores, starts, ends, count = map(np.concatenate, zip(*parts))
        first = np.concatenate(([0], np.cumsum(count)))
        labels = viterbi(scores, first, penalty)
        for d in range(len(texts)):
            at = slice(first[d], first[d + 1])
            if first[d] == first[d + 1]:
                yield UNKNOWN, 0.0, []
                continue
            label, start, end = labels[at], starts[at], ends[at]
            letters = np.bincount(label, end - start, len(held.langs))
            best = int(letters.argmax())
            new = np.flatnonzero(np.concatenate(([True], label[1:] != label[:-1])))
            last = np.append(new[1:], len(label)) - 1
            spans = [{"lang": held.langs[label[a]], "start": int(start[a]), "end": int(end[b])} for a, b in zip(new, last)]
            yield held.langs[best], float(letters[best] / letters.sum()), spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _bounded(batches):
            texts = [t or "" for t in batch["text"].to_pylist()]
            found = list(rows_of(texts)) if texts else []
            out = {"lang_pred": [f[0] for f in found], "score": [f[1] for f in found], "spans": [f[2] for f in found]}
            held = {name: batch[name] for name in schema.names if name not in out}
            yield pa.RecordBatch.from_pydict(held | out, schema=schema)

    return run


def predict(
    model: Model,
    docs: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    penalty: float = SWITCH_PENALTY,
    whole_rows: bool = False,
) -> DataFrame:
    """``id`` (with ``whole_rows`` all columns, of which these names are replaced), ``lang_pred``, ``score`` and ``spans`` (lang, start, end in code points) of every whole text.

    ``lang_pred`` is the language that most letters are labelled with (the first by name on a tie), ``score``
    their share; ``und`` and 0 for a null text, one without letters, or a model that knows no language. One row
    comes out per row, repeated or not; only ``id`` and ``text`` are read, whatever else there is. Nothing
    is shuffled; what is sent to the executors is the model, whose size does not grow with the rows.
    """
    context = docs.sparkSession.sparkContext
    span = StructType().add("lang", "string").add("start", "long").add("end", "long")
    added = StructType().add("lang_pred", "string").add("score", "double").add("spans", ArrayType(span))
    carried = [c for c in docs.columns if c not in added.names] if whole_rows else [id]
    schema = StructType()
    for k, c in enumerate(carried):
        schema = schema.add(f"c{k}", docs.schema[c].dataType)
    schema = StructType(schema.fields + added.fields)
    # Only strings and arrays are sent, so that executors need not have the package.
    sent = context.broadcast((model.langs, model.weights, model.written_in))
    run = _labelled(sent, context.broadcast(letter_scripts()), penalty, to_arrow_schema(schema))
    rows = docs.select(F.col(text).alias("text"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(carried)])
    return rows.mapInArrow(run, schema).toDF(*carried, *added.names)


def held_out(id: Column) -> Column:
    """The quarter of the rows that nothing is learned from; a null id is held out too."""
    return F.coalesce(F.crc32(id.cast("string")) % 4 == 2, F.lit(True))
