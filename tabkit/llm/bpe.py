"""Byte-pair encoding without replaying merges, and decoding.

For every prefix of a word there is exactly one token that its encoding ends with. An automaton over the
vocabulary gives the tokens that end at each byte; one of them is the prefix's last token when the
shorter prefix before it ends with a token that is compatible with it. Following the stored tokens back
from the end of the word gives the same ids as merging by rank.

Words that are not remembered are encoded together, a byte of all of them at a time.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain, pairwise
from unicodedata import category

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType
from tokenizers.pre_tokenizers import ByteLevel

from .automaton import Automaton

# Words remembered per task before those not met lately are forgotten: twice as many at most, some 300 bytes each.
KNOWN_WORDS = 50_000
# Pairs of tokens judged per worker before the memory is emptied.
KNOWN_PAIRS = 400_000
# Texts are encoded together up to about this many bytes, as lists, ids and decoded texts take several times as much.
TOGETHER_BYTES = 1_000_000

# Words of a text are looked up so many at a time, so that those not remembered are encoded together. Longer ones are encoded singly.
WORDS_TOGETHER = 25_000
LONGEST_TOGETHER = 64

# White space as the tokenizer's pattern sees it, and the endings split from words.
_SPACE = "\t-\r \x85\xa0  -     　"
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"


def _byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file.

    Printable Latin-1 characters stand for themselves, the other bytes for characters from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


def _pattern(letter: str, digit: str, other: str, space: str) -> re.Pattern:
    return re.compile(f"{_ENDINGS}| ?{letter}+| ?{digit}+| ?{other}+|[{space}]+(?![^{space}])|[{space}]+")


def word_pattern() -> re.Pattern:
    """The pattern that splits a text into words, where ``judged`` holds for the text.

    The standard library's ``[^\\W\\d_]`` and ``\\d`` are then the categories L and N.
    """
    return _pattern(r"[^\W\d_]", r"\d", f"(?:[^\\w{_SPACE}]|_)", _SPACE)


def latin_pattern() -> re.Pattern:
    """The same for texts of the first blocks of Latin script alone, whose classes are listed, which is faster."""
    letter, digit, space = (
        "".join(re.escape(c) for c in map(chr, range(0x250)) if chosen(c))
        for chosen in (lambda c: category(c)[0] == "L", lambda c: category(c)[0] == "N", re.compile(f"[{_SPACE}]").match)
    )
    return _pattern(f"[{letter}]", f"[{digit}]", f"[^{letter}{digit}{space}]", space)


# Beyond the first blocks of Latin script; in them only these are numbers but no decimal digits.
_RARE = re.compile("[²³¹¼½¾]|[^\x00-\u024f]")
_BEYOND_LATIN = re.compile("[^\x00-\u024f]")


def judged(text: str) -> bool:
    """Whether the standard library classes every character as the tokenizer does.

    Not so for numbers that are no decimal digits, and for characters newer than Python's tables.
    """
    return _RARE.search(text) is None or not any(category(c) in ("Nl", "No", "Cn") for c in set(text))


class _Slots:
    """Remembers a function of whole numbers in arrays, each answer in the slot that its question is hashed to."""

    def __init__(self, answer: Callable[[int], int], bits: int):
        self.answer, self.shift = answer, np.uint64(64 - bits)
        self.asked = np.full(1 << bits, -1)
        self.answers = np.zeros(1 << bits, np.int64)

    def __call__(self, asked: np.ndarray) -> np.ndarray:
        slots = (asked.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift
        found = self.answers[slots]
        other = np.flatnonzero(self.asked[slots] != asked)
        if other.size:
            new, first, place = np.unique(asked[other], return_index=True, return_inverse=True)
            answers = np.array([self.answer(x) for x in new.tolist()], np.int64)
            found[other] = answers[place]
            slots, one = np.unique(slots[other[first]], return_index=True)
            self.asked[slots], self.answers[slots] = new[one], answers[one]
        return found


class Encoder:
    """Exact ids of a byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        letters = _byte_letters()
        model = held["model"]
        self.bytes = {i: bytes(letters[c] for c in token) for token, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        self.bytes |= {i: content.encode() for content, i in self.special.items()}
        ids = model["vocab"]
        # By the pair it joins: the rank of a merge. By the token it makes: rank and the two parts.
        self.rank, self.made = {}, {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair = ids[left], ids[right]
            self.rank[pair] = rank
            self.made.setdefault(ids[left + right], (rank, *pair))
        self.whole = {b: i for i, b in self.bytes.items() if i in self.made or len(b) == 1}
        self.automaton = Automaton(self.whole)
        self.compatible: dict[int, bool] = {}
        # For words that are encoded together: the automaton's states by number, and what is asked of them and of pairs.
        self.states, self.number = [self.automaton.root], {self.automaton.root.text: 0}
        self.next, self.shorter, self.pair = _Slots(self._next, 18), _Slots(self._end, 16), _Slots(self._pair, 19)
        self.pattern, self.latin = word_pattern(), latin_pattern()
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def fits(self, left: int, right: int) -> bool:
        """Whether ``left`` followed by ``right`` is how their bytes are encoded together.

        Undo both tokens, latest merge first. Between two undone merges some part of ``left`` ends at
        the seam and some part of ``right`` begins there; a merge of these two that comes before the
        next merge on either side would have joined them. Equal ranks go to the leftmost pair.
        """
        none = (len(self.rank), -1, -1)
        until_left = until_right = none[0]
        while True:
            rank = self.rank.get((left, right))
            if rank is not None and rank < until_left and rank <= until_right:
                return False
            by_left, by_right = self.made.get(left), self.made.get(right)
            if by_left is None and by_right is None:
                return True
            if by_right is None or (by_left is not None and by_left[0] >= by_right[0]):
                until_left, left = by_left[0], by_left[2]
            else:
                until_right, right = by_right[0], by_right[1]

    def word(self, data: bytes) -> list[int]:
        whole = self.whole.get(data)
        if whole is not None:
            return [whole]
        last, back = [-1], [0]  # the token that the encoding of each prefix ends with, and where it begins
        known, state = self.compatible, self.automaton.root
        for end, byte in enumerate(data, 1):
            state = state[byte]
            for token, length in state.ends:
                start = end - length
                if not start:
                    break
                pair = last[start] << 32 | token
                fits = known.get(pair)
                if fits is None:
                    fits = known[pair] = self.fits(last[start], token)
                if fits:
                    break
            last.append(token)
            back.append(start)
        out, end = [], len(data)
        while end:
            out.append(last[end])
            end = back[end]
        out.reverse()
        return out

    def _next(self, asked: int) -> int:
        """The state that a state and a byte lead to, and the longest token that ends there."""
        state = self.states[asked >> 8][asked & 255]
        number = self.number.setdefault(state.text, len(self.states))
        if number == len(self.states):
            self.states.append(state)
        return number << 40 | self._end(number << 8)

    def _end(self, asked: int) -> int:
        """A token that ends at a state, its length, and whether no shorter one does."""
        ends, k = self.states[asked >> 8].ends, asked & 255
        token, length = ends[k]
        return token << 8 | length << 1 | (k + 1 == len(ends))

    def _pair(self, pair: int) -> int:
        fits = self.compatible.get(pair)
        if fits is None:
            fits = self.compatible[pair] = self.fits(pair >> 32, pair & 0xFFFFFFFF)
        return fits

    def together(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``word`` of each of many words of 1 to ``LONGEST_TOGETHER`` bytes, a byte of all of them at a time: all ids, and how many each word has."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-size, kind="stable")
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        at, size = (np.cumsum(size) - size)[order], size[order]
        longest = int(size.max(initial=0))
        # Of each prefix of each word, the longer words first: its last token, and where that begins.
        last = np.zeros((longest + 1, len(words)), np.int64)
        back = np.zeros((longest + 1, len(words)), np.int64)
        state = np.zeros(len(words), np.int64)
        for end in range(1, longest + 1):
            left = np.arange(np.searchsorted(-size, -end, "right"))
            found = self.next(state[: left.size] << 8 | data[at[: left.size] + end - 1])
            state = found >> 40
            asked, found = state << 8, found & 0xFFFFFFFFFF
            while True:
                token, start = found >> 8, end - (found >> 1 & 127)
                last[end, left], back[end, left] = token, start
                # A token that is the whole prefix stands, and so does the last one there is.
                more = np.flatnonzero((start > 0) & (found & 1 == 0))
                more = more[self.pair(last[start[more], left[more]] << 32 | token[more]) == 0]
                if not more.size:
                    break
                left, asked = left[more], asked[more] + 1
                found = self.shorter(asked)
        count, end, left, out = np.zeros(len(words), np.int64), size, np.arange(len(words)), []
        while left.size:
            out.append((order[left], last[end, left]))
            count[order[left]] += 1
            end = back[end, left]
            left, end = left[end > 0], end[end > 0]
        # The tokens came from the end of each word to its beginning.
        upto = np.cumsum(count)
        ids = np.zeros(int(count.sum()), np.int64)
        for k, (word, token) in enumerate(out, 1):
            ids[upto[word] - k] = token
        return ids, count

    def words(self, text: str) -> list[str]:
        if text.isascii() or _BEYOND_LATIN.search(text) is None:
            return self.latin.findall(text)
        if judged(text):
            return self.pattern.findall(text)
        split = ByteLevel(add_prefix_space=False).pre_tokenize_str(text)
        return [text[begin:end] for _, (begin, end) in split]

    def parts(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Runs of ordinary text, and special tokens with their id."""
        for k, part in enumerate(self.split.split(text) if self.split else [text]):
            if part:
                yield part, self.special[part] if k % 2 else None


class _Known(dict):
    """By word: (ids as decimal text, number of ids, decoded bytes). Words met since the last time it was full stay when it is full again.

    A special token is a number instead of a word.
    """

    def __init__(self, encoder: Encoder):
        self.encoder, self.before = encoder, {}
        n = max(encoder.bytes) + 1
        self.decimal = np.array([f"{i}," for i in range(n)], object)
        self.bytes = np.array([encoder.bytes.get(i, b"") for i in range(n)], object)

    def room(self, words: int) -> None:
        """Makes room for so many words more."""
        if len(self) + words > KNOWN_WORDS:
            self.before = self.copy()
            self.clear()
            if len(self.encoder.compatible) >= KNOWN_PAIRS:
                self.encoder.compatible.clear()

    def entries(self, ids: np.ndarray, count: np.ndarray) -> Iterator[tuple[str, int, bytes]]:
        """Of each word, given the ids of all of them."""
        upto = np.concatenate([[0], np.cumsum(count)])

        def parts(written):
            size = np.fromiter(map(len, written), np.int64, len(written))
            return np.concatenate([[0], np.cumsum(size)])[upto].tolist()

        decimal, held = self.decimal[ids].tolist(), self.bytes[ids].tolist()
        text, data = "".join(decimal), b"".join(held)
        spans = zip(pairwise(parts(decimal)), count.tolist(), pairwise(parts(held)))
        return ((text[a : b - 1], n, data[c:d]) for (a, b), n, (c, d) in spans)

    def __missing__(self, word: str | int) -> tuple[str, int, bytes]:
        self.room(1)
        found = self.before.get(word)
        if found is None:
            ids = [word] if isinstance(word, int) else self.encoder.word(word.encode())
            found = next(self.entries(np.array(ids), np.array([len(ids)])))
        self[word] = found
        return found

    def all(self, words: list[str | int]) -> list[tuple[str, int, bytes]]:
        """What ``self[word]`` is for each; new words are encoded together."""
        every = []
        for k in range(0, len(words), WORDS_TOGETHER):
            some = words[k : k + WORDS_TOGETHER]
            found = list(map(self.get, some))
            gaps = [place for place, known in enumerate(found) if known is None]
            new = {some[place] for place in gaps}
            self.room(len(new))
            self.update([(word, known) for word in new if (known := self.before.get(word))])
            data = {word: word.encode() for word in new if word not in self and not isinstance(word, int)}
            data = {word: held for word, held in data.items() if len(held) <= LONGEST_TOGETHER}
            self.update(zip(data, self.entries(*self.encoder.together(list(data.values())))))
            for place in gaps:
                found[place] = self[some[place]]
            every += found
        return every


def vocabulary_path(path: str | None) -> str:
    """``path``, or where the public vocabulary is installed on this machine."""
    if path is None:
        import public_tokenizers

        return public_tokenizers.path("byte_bpe_50k.json")
    return path


@lru_cache(1)
def _read(path: str, size: int, changed: int) -> Encoder:
    return Encoder(path)


def shared_encoder(path: str) -> Encoder:
    """The encoder of a file, read once a worker while the file stays as it is; a later task goes on with the pairs judged so far."""
    file = os.stat(path)
    return _read(path, file.st_size, file.st_mtime_ns)


def _bounded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts, without the first, have fewer than ``TOGETHER_BYTES``."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = np.flatnonzero(np.diff(upto // TOGETHER_BYTES, prepend=-1))
    for begin, end in zip(first, np.append(first[1:], batch.num_rows)):
        yield batch.slice(begin, end - begin)


def _encoded(path: str | None, id_type: pa.DataType, full: bool, decode: bool = True):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(vocabulary_path(path))
        known = _Known(encoder)
        for batch in chain.from_iterable(map(_bounded, batches)):
            count, ids, decoded = [], [], []
            words, every, upto = [], [], [0]
            for text in batch["text"]:
                for part, special in encoder.parts(text.as_py() or ""):
                    words += encoder.words(part) if special is None else [special]
                upto.append(len(every) + len(words))
                if len(words) >= WORDS_TOGETHER:
                    every += known.all(words)
                    words = []
            every += known.all(words)
            for begin, end in pairwise(upto):
                found = every[begin:end]
                count.append(sum([f[1] for f in found]))
                ids.append(",".join([f[0] for f in found]))
                if decode:
                    decoded.append(b"".join([f[2] for f in found]).decode("utf-8", "replace"))
            out = {"id": batch["id"].cast(id_type), "n_tokens": pa.array(count, pa.int64())}
            if full:
                numbers = np.fromstring(",".join([i for i in ids if i]), np.int32, sep=",") if any(count) else np.zeros(0, np.int32)
                places = pa.array(np.cumsum([0, *count]), pa.int32())
                out["ids"] = pa.ListArray.from_arrays(places, pa.array(numbers))
                if decode:
                    out["decoded"] = pa.array(decoded, pa.string())
            else:
                out["ids_sha256"] = pa.array([sha256(i.encode()).hexdigest() for i in ids], pa.string())
                if decode:
                    out["decoded_sha256"] = pa.array([sha256(d.encode()).hexdigest() for d in decoded], pa.string())
            yield pa.RecordBatch.from_pydict(out)

    return run


def bpe_encode(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None, digests: bool = False, decode: bool = True) -> DataFrame:
    """Encode and decode every text: ``id``, ``n_tokens``, ``ids`` and ``decoded``.

    With ``digests`` the last two are replaced by ``ids_sha256``, of the decimal ids joined by commas, and
    ``decoded_sha256``, of the decoded text in UTF-8. Without ``decode`` the last is left out. ``path`` names a byte-level vocabulary file that every
    machine can read; special tokens in a text get their own ids.

    A null text is an empty one: no tokens, an empty text. One row comes out per row, repeated or not, with
    the id as it is, also null; other columns are not read, whatever their names. Nothing is shuffled.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema[id].dataType
    schema = StructType().add("id", kind).add("n_tokens", "long")
    schema = schema.add("ids_sha256", "string") if digests else schema.add("ids", ArrayType(IntegerType()))
    if decode:
        schema = schema.add("decoded_sha256" if digests else "decoded", "string")
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(_encoded(path, to_arrow_type(kind), not digests, decode), schema).withColumnRenamed("id", id)
