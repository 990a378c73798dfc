"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

A byte-level BPE vocabulary reads a space and the text, a piece vocabulary with byte fallback the text, before which it
puts that space itself. The spans that the two libraries give, in characters, are coarse cuts. Where a token is
only a part of a character, or a byte that a character falls back to, its span is not as long as the token's decoded
bytes, and the cut is placed by those, counted from the last cut that is sure.

Neither tokenizer joins a character and a space behind it: the pattern of the one starts a new word there, and no piece
of the other has a space behind anything else. So a text is taken apart before such spaces, and each distinct segment
is encoded and aligned once a task, many at a time.

Every row's distinct id pairs are written with it. How many rows hold a pair is counted over the whole corpus
and joined back to them: a number of fixed size of the commonest pairs by broadcast, the rarer ones, if there are more, by
an ordinary join.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from ..session import written
from .bpe import _byte_letters

# Pairs that are joined by broadcast.
SENT_PAIRS = 1_000_000
# Characters of texts taken together, and bytes that a task spends on known segments before it forgets them all.
CHUNK_LETTERS = 2_000_000
KNOWN_BYTES = 150_000_000
# Segments in one call of a tokenizer.
JOINED = 500

_CUT = re.compile(r"(?<=\S) (?!\Z)")
_SPACE = "▁"
_FALLBACK = re.compile("<0x([0-9A-F]{2})>")


class Side:
    """A tokenizer's vocabulary: the bytes of each id, their number, and whether a span can show them."""

    def __init__(self, tokens: list[bytes], parts: list[bool]):
        self.tokens, self.lengths = tokens, np.array([len(t) for t in tokens], np.int64)
        self.whole = ~np.array(parts, bool)

    def cuts(self, ids: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Where each token ends, in bytes: at its span's end if the span is as long as the token."""
        length = self.lengths[ids]
        sure = (end - start == length) & self.whole[ids]
        run = np.cumsum(length)
        last = np.maximum.accumulate(np.where(sure, np.arange(len(ids)), -1))
        from_last = np.where(last >= 0, end[last] - run[last], 0)
        return np.where(sure, end, from_last + run)


class Segments(dict):
    """Alignments of segments, numbered, by their text without the space before it."""

    def __init__(self, byte_path: str | None, piece_path: str | None, full: bool = False):
        import public_tokenizers
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        byte_path = byte_path or public_tokenizers.path("byte_bpe_50k.json")
        self.tokenizer = Tokenizer.from_file(byte_path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        letters = _byte_letters()
        with open(byte_path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        tokens = [b""] * (1 + max(vocabulary.values()))
        for token, id in vocabulary.items():
            tokens[id] = bytes(map(letters.get, token)) if all(c in letters for c in token) else b""
        self.a = Side(tokens, [t != t.decode("utf-8", "ignore").encode() for t in tokens])
        self.processor = SentencePieceProcessor(model_file=piece_path or public_tokenizers.path("piece_bpe_32k.model"))
        pieces = [self.processor.id_to_piece(i) for i in range(self.processor.get_piece_size())]
        if any(_SPACE in p.lstrip(_SPACE) for p in pieces):
            raise ValueError("a piece holds a space behind another character, so texts cannot be taken apart at spaces")
        byte = [_FALLBACK.fullmatch(p) for p in pieces]
        self.b = Side([bytes([int(m[1], 16)]) if m else p.replace(_SPACE, " ").encode() for p, m in zip(pieces, byte)], [m is not None for m in byte])
        most = max(len(tokens), len(pieces))
        self.width = len(str(most))
        # The decimal digits of each id, with zero bytes where it has fewer.
        self.digits = np.array([str(i) for i in range(most)], f"S{self.width}").view(np.uint8).reshape(most, self.width)
        self.full = full
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.text: list[bytes] = []
        self.sizes, self.links, self.first = array("q"), array("q"), array("q", [0])
        self.tokens: list[tuple] = []
        self.right = bytearray()
        self.letters = 0

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number

    def held(self) -> int:
        """About how many bytes the segments take."""
        return 300 * len(self) + 8 * len(self.links) + 4 * self.letters

    def learn(self) -> None:
        """Encode and align the segments that are new; those that a tokenizer doesn't give back have no tokens."""
        new, self.new = self.new, []
        right = np.array([_SPACE not in p for p in new], bool)
        found = self._encoded([p for p in new if _SPACE not in p])
        if found is None:
            right = np.array([self._encoded([p]) is not None for p in new], bool)
            found = self._encoded([p for p, ok in zip(new, right) if ok])
        sizes = np.zeros((len(new), 4), np.int64)
        sizes[right], texts, links, *tokens = self._aligned(*found)
        self.sizes.frombytes(sizes.tobytes())
        self.first.frombytes((self.first[-1] + np.cumsum(sizes[:, 3])).tobytes())
        self.links.frombytes(links.tobytes())
        self.right += right.astype(np.uint8).tobytes()
        self.letters += sum(map(len, new))
        each = iter(texts)
        self.text += [next(each) if ok else b"" for ok in right.tolist()]
        if self.full:
            places = np.cumsum([(0, 0, 0, 0), *sizes.tolist()], axis=0)
            self.tokens += [tuple(x[places[i, k // 2] : places[i + 1, k // 2]] for k, x in enumerate(tokens)) for i in range(len(new))]

    def _encoded(self, pieces: list[str]):
        """Ids and cuts of both sides, and the segments' bounds, in bytes of all segments; None if a tokenizer doesn't give them back.

        Segments are independent of each other, so many go into one call as one text. One that ends in white space, as
        the last one of a text can, must not have another one behind it.
        """
        texts = [" " + p for p in pieces]
        joined, run = [], []
        for text in texts:
            run.append(text)
            if len(run) == JOINED or text[-1].isspace():
                joined.append("".join(run))
                run = []
        if run:
            joined.append("".join(run))
        a = self.tokenizer.encode_batch(joined, add_special_tokens=False)
        b = self.processor.encode([t[1:] for t in joined], return_type="offset_mapping", num_threads=1)
        data = "".join(joined).encode()
        raw = np.frombuffer(data, np.uint8)
        place = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))  # of each character, in bytes
        base = np.cumsum([0, *map(len, joined)])[:-1]
        sides = []
        for of, ids, spans, ahead in ((self.a, [x.ids for x in a], [x.offsets for x in a], 0), (self.b, [x["ids"] for x in b], [x["offsets"] for x in b], 1)):
            if b"".join(map(of.tokens.__getitem__, chain.from_iterable(ids))) != data:
                return None
            n = list(map(len, ids))
            flat = np.fromiter(chain.from_iterable(ids), np.int64, sum(n))
            span = np.fromiter(chain.from_iterable(chain.from_iterable(spans)), np.int64, 2 * sum(n)).reshape(-1, 2)
            at = np.repeat(base, n)
            start = np.where(span[:, 0] > 0, span[:, 0] + ahead, 0)  # the first token takes in the space before the text
            end = np.minimum(at + span[:, 1] + ahead, len(place) - 1)
            sides += [flat, of.cuts(flat, place[np.minimum(at + start, len(place) - 1)], place[end])]
        return *sides, place[np.cumsum([0, *map(len, texts)])]

    def _aligned(self, a_ids, a_cuts, b_ids, b_cuts, bounds) -> tuple:
        """Sizes and groups as text of each segment, the pairs of all links, and the tokens with their ends in the segment."""
        either = np.union1d(a_cuts, b_cuts)  # every stretch between two of these is one link
        links = a_ids[np.searchsorted(a_cuts, either)] * len(self.b.tokens) + b_ids[np.searchsorted(b_cuts, either)]
        both = np.intersect1d(a_cuts, b_cuts, assume_unique=True)
        a_group, b_group = np.searchsorted(both, a_cuts), np.searchsorted(both, b_cuts)
        groups = np.arange(len(both) + 1)
        a_first, b_first = np.searchsorted(a_group, groups), np.searchsorted(b_group, groups)
        stream = np.zeros((len(a_ids) + len(b_ids), self.width + 1), np.uint8)
        for ids, cuts, at, group, mark in (
            (a_ids, a_cuts, np.arange(len(a_ids)) + b_first[a_group], a_group, "|"),
            (b_ids, b_cuts, np.arange(len(b_ids)) + a_first[b_group + 1], b_group, ";"),
        ):
            stream[at, :-1] = self.digits[ids]
            stream[at, -1] = np.where(both[group] == cuts, ord(mark), ord(","))
        size = np.cumsum(np.append(0, (stream != 0).sum(axis=1)))
        stream = stream.reshape(-1)
        text = stream[stream != 0].tobytes()
        edges = [np.searchsorted(cuts, bounds, "right") for cuts in (a_cuts, b_cuts, both, either)]
        place = size[edges[0] + edges[1]].tolist()
        texts = [text[i:j] for i, j in zip(place, place[1:])]
        sizes = np.stack([np.diff(e) for e in edges], axis=1)
        if not self.full:
            return sizes, texts, links
        ends = [cuts - np.repeat(bounds[:-1], np.diff(e)) for cuts, e in zip((a_cuts, b_cuts), edges)]
        return sizes, texts, links, a_ids, ends[0], b_ids, ends[1]


def _rows(known: Segments, flat: np.ndarray, counts: list[int]) -> dict:
    """The columns of a run of texts whose segments are ``flat``, ``counts`` of them each."""
    bounds = np.cumsum([0, *counts])
    row = np.repeat(np.arange(len(counts)), counts)
    right = np.bincount(row[np.frombuffer(known.right, np.uint8)[flat] == 0], minlength=len(counts)) == 0
    keep = right[row]
    row, segment = row[keep], flat[keep]
    sizes, first, links = np.array(known.sizes).reshape(-1, 4), np.array(known.first), np.array(known.links)
    out = {}
    for k, name in enumerate(("n_a", "n_b", "n_groups", "n_links")):
        out[name] = np.bincount(row, sizes[segment, k], len(counts)).astype(np.int64)
    text = known.text.__getitem__
    groups = [b"".join(map(text, flat[bounds[d] : bounds[d + 1]].tolist()))[:-1] if ok else b"" for d, ok in enumerate(right)]
    out["groups_sha256"] = [sha256(g).hexdigest() if g else "" for g in groups]
    n = first[segment + 1] - first[segment]
    at = np.repeat(first[segment] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    pairs, times = np.unique(np.repeat(row, n) << 40 | links[at], return_counts=True)
    places = pa.array(np.searchsorted(pairs, np.arange(len(counts) + 1) << 40), pa.int32())
    out["pairs"] = pa.ListArray.from_arrays(places, pa.array(pairs & ((1 << 40) - 1), pa.int64()))
    out["times"] = pa.ListArray.from_arrays(places, pa.array(times, pa.int32()))
    if known.full:
        names = ("a_ids", "a_ends", "b_ids", "b_ends")
        out |= {name: [] for name in names}
        for d, ok in enumerate(right):
            ahead, found = 0, [[] for _ in names]
            for s in flat[bounds[d] : bounds[d + 1]].tolist() if ok else []:
                a_ids, a_ends, b_ids, b_ends = known.tokens[s]
                for held, new in zip(found, (a_ids, a_ends + ahead, b_ids, b_ends + ahead)):
                    held += new.tolist()
                ahead += int(a_ends[-1])
            for name, held in zip(names, found):
                out[name].append(held)
    return out


def _aligned(byte_path: str | None, piece_path: str | None, full: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        known = Segments(byte_path, piece_path, full)
        for batch in batches:
            column, at = batch["text"], 0
            while at < batch.num_rows:
                numbers, letters, to = [], 0, at
                while to < batch.num_rows and letters < CHUNK_LETTERS:
                    text = column[to].as_py()
                    numbers.append(list(map(known.__getitem__, _CUT.split(text))) if text else [])
                    letters += len(text or "")
                    to += 1
                if known.new:
                    known.learn()
                counts = list(map(len, numbers))
                flat = np.fromiter(chain.from_iterable(numbers), np.int64, sum(counts))
                out = {"id": batch["id"].slice(at, to - at)} | _rows(known, flat, counts)
                yield pa.RecordBatch.from_pydict(out, schema=schema)
                at = to
                if known.held() > KNOWN_BYTES:
                    known.forget()

    return run


def pair_counts(pairs: DataFrame, many: int) -> DataFrame:
    """Of the rows' distinct ``pairs``: ``pair``, the number of ``documents`` that hold it, and ``best``.

    A pair is an A id times ``many`` and a B id; ``best`` says whether no other pair of that A id is in more documents.
    """
    each = pairs.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("documents"))
    counts = written(each.withColumn("a", F.expr(f"pair div {many}")))
    highest = F.broadcast(counts.groupBy("a").agg(F.max("documents").alias("most")))  # a row for each id of the vocabulary
    return counts.join(highest, "a").select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def align(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    byte_path: str | None = None,
    piece_path: str | None = None,
    full: bool = False,
    sent_pairs: int = SENT_PAIRS,
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    Groups are cut where a token of A and one of B both end; a link is a token of each that share a byte. A pair's count is the
    number of rows that hold it linked; ``n_best`` are the links whose pair has the highest count of its A id, ties
    included, and ``count_sum`` adds up the counts of all links. ``groups_sha256`` is of the groups as
    ``a1,a2|b1;a3|b2,b3``. With ``full`` the ids and the places where tokens end, in bytes of a space and the text,
    come too: ``a_ids``, ``a_ends``, ``b_ids``, ``b_ends``.

    A text that is null or empty, or that either tokenizer does not give back byte for byte, has no tokens: zeros, an
    empty digest, empty lists, and no part in the counts. Special tokens inside a text are plain text.
    Repeated rows count each; ids may be null. Other columns are not read, whatever their names. An
    empty table gives an empty table. The paths name files that every machine can read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType().add("id", docs.schema[id].dataType)
    for name in ("n_a", "n_b", "n_groups", "n_links"):
        schema = schema.add(name, "long")
    schema = schema.add("groups_sha256", "string").add("pairs", ArrayType(LongType())).add("times", ArrayType(IntegerType()))
    lists = ("a_ids", "a_ends", "b_ids", "b_ends") if full else ()
    for name in lists:
        schema = schema.add(name, ArrayType(LongType()))
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    found = rows.mapInArrow(_aligned(byte_path, piece_path, full, to_arrow_schema(schema)), schema)
    held = written(found.withColumn("row", F.monotonically_increasing_id()))
    counts = written(pair_counts(held, len(Segments(byte_path, piece_path).b.tokens)))
    each = held.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    common = counts
    if counts.count() > sent_pairs:
        common = written(counts.orderBy(F.desc("documents"), "pair").limit(sent_pairs))
    met = each.join(F.broadcast(common), "pair")
    if common is not counts:
        rare = each.join(F.broadcast(common.select("pair")), "pair", "left_anti")
        met = met.unionByName(rare.join(counts, "pair"))
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("documents")).alias("count_sum")
    )
    zero = F.lit(0).cast("long")
    out = held.drop("pairs", "times").join(sums, "row", "left")
    return out.select(
        F.col("id").alias(id), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256", *lists,
    )
