"""Token counts of a unigram vocabulary, without making the tokens.

An automaton enumerates the vocabulary's matches in a chunk of text; dynamic programming over their ends
keeps, for every position, the best score and how many pieces lead to it. Ties go to the match that
starts first, as in the tokenizer. The text is cut where no piece can cross, and a chunk's count is
remembered, so that a common word is solved once a task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from .automaton import Automaton

# Chunks remembered per task before the memory is emptied.
KNOWN_CHUNKS = 500_000

# Fixed values of the tokenizer: the letter that stands for a space, and what an unknown
# character costs beyond the lowest score.
SPACE = "▁"
UNKNOWN_COST = 10.0


def read_pieces(path: str | None = None) -> list[tuple[str, float]]:
    """Pieces and scores of a vocabulary file, in the order of their ids; id 0 is the unknown piece."""
    from sentencepiece import SentencePieceProcessor

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    model = SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    """Piece counts of texts: a space is put before the text, spaces become letters of their own.

    An unknown character counts one piece for each of its bytes if the vocabulary has pieces for all
    bytes, else a run of unknown characters counts one.
    """

    def __init__(self, pieces: list[tuple[str, float]]):
        values: dict[str, float] = {}
        for piece, score in pieces[1:]:
            values.setdefault(piece, score)
        values.pop("", None)
        self.automaton = Automaton(values)
        self.unknown = min(score for _, score in pieces) - UNKNOWN_COST
        names = {piece for piece, _ in pieces}
        self.bytewise = all(f"<0x{b:02X}>" in names for b in range(256))
        self.known: dict[str, int] = {}
        # White space and control characters that no piece holds are unknown wherever they stand; a space
        # begins a chunk if no piece has one after another letter.
        letters = set().union(*names)
        lone = "".join(c for c in map(chr, [*range(0x20), 0x7F, *range(0x80, 0xA1)]) if c not in letters)
        begins = not any(SPACE in piece.lstrip(SPACE) for piece in names)
        if self.bytewise and begins:
            held = f"{SPACE}{re.escape(lone)}"
            self.chunks = re.compile(f"{SPACE}*[^{held}]+|{SPACE}+|[{re.escape(lone)}]" if lone else f"{SPACE}*[^{held}]+|{SPACE}+")
        else:
            self.chunks = None

    def chunk(self, text: str) -> int:
        scores, pieces = [0.0], [0]
        state, unknown, fused = self.automaton.root, self.unknown, False
        for end, letter in enumerate(text, 1):
            state = state[letter]
            best, start, length = None, 0, 0
            for value, length in state.ends:  # from the earliest start on; a later one must be better
                score = scores[end - length] + value
                if best is None or score > best:
                    best, start = score, end - length
            if length == 1 or (best is not None and best >= scores[end - 1] + unknown):
                pieces.append(pieces[start] + 1)
                fused = False
            else:  # no piece for the letter, and nothing better than the unknown piece
                best = scores[end - 1] + unknown
                if self.bytewise:
                    pieces.append(pieces[end - 1] + len(letter.encode()))
                else:
                    pieces.append(pieces[end - 1] + (not fused))
                fused = True
            scores.append(best)
        return pieces[-1]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        text = SPACE + text.replace(" ", SPACE)
        if self.chunks is None:
            return self.chunk(text)
        known, total = self.known, 0
        for chunk in self.chunks.findall(text):
            found = known.get(chunk)
            if found is None:
                if len(known) >= KNOWN_CHUNKS:
                    known.clear()
                found = known[chunk] = self.chunk(chunk)
            total += found
        return total


def _counted(path: str | None, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(read_pieces(path))
        for batch in batches:
            counts = [counter.count(text.as_py()) for text in batch["text"]]
            yield pa.RecordBatch.from_pydict({"id": batch["id"].cast(id_type), "n_tokens": pa.array(counts, pa.int64())})

    return run


def token_counts(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``id`` and ``n_tokens``, the number of pieces of every whole text.

    ``path`` names a vocabulary of scored pieces that every machine can read. A null or empty text has no
    piece. One row comes out per row, repeated or not, with the id as it is, also null; other columns are
    not read, whatever their names. Nothing is shuffled.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema[id].dataType
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    schema = StructType().add("id", kind).add("n_tokens", "long")
    return rows.mapInArrow(_counted(path, to_arrow_type(kind)), schema).withColumnRenamed("id", id)
