"""Target-distribution importance resampling: draw documents that look like a target corpus, without replacement.

Runs of one or two words are hashed into a fixed number of buckets. A bucket's gain is the logarithm of its share in the
target over its share in the documents, as a whole number of thousandths; a document's weight is the mean gain
of its runs. Weight plus noise that follows from the id alone gives a score, and the highest scores are drawn.

The lowest score drawn is found exactly without sorting all rows, by weighted medians of medians: every task gives the
median of the rows it still holds and their number; the median of these, weighted by the numbers, has at least a
quarter of all remaining rows on either side, so each round discards at least a quarter. Only the rows above
the cut are sorted.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.types import StructType

from ..session import written
from .words import ALPHANUMERIC, slices, words

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
# Once as few rows as this remain, they are sorted.
FEW_ROWS = 4_096
# Bytes of a word that are taken in together with those of other words; the rest of a longer one goes one word at a time.
_TOGETHER = 32


def _crc_table() -> np.ndarray:
    """The register after each byte, by the polynomial of CRC-32 with its bits in reverse."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, np.uint32(0xEDB88320) ^ (out >> np.uint32(1)), out >> np.uint32(1))
    return out


def _zeros_table(table: np.ndarray) -> np.ndarray:
    """[n, k, b]: the register that holds byte ``b`` at place ``k`` after ``n`` zero bytes."""
    now = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    out = [now]
    for _ in range(_TOGETHER):
        now = table[now & np.uint32(255)] ^ (now >> np.uint32(8))
        out.append(now)
    return np.stack(out)


class Checksums:
    """CRC-32 of many words at a time, and of pairs of words joined by a space.

    The checksum of a pair follows from those of its words: zero bytes are run through the first one's register,
    as many as the second word has.
    """

    def __init__(self):
        self.table = _crc_table()
        self.zeros = _zeros_table(self.table).reshape(-1)

    def words(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.full(len(start), 0xFFFFFFFF, np.uint32)
        which, at, left = np.arange(len(start)), start, np.minimum(end - start, _TOGETHER)
        while len(which):
            now = out[which]
            out[which] = self.table[(now ^ data[at]) & np.uint32(255)] ^ (now >> np.uint32(8))
            on = np.flatnonzero(left > 1)
            which, at, left = which[on], at[on] + 1, left[on] - 1
        out ^= np.uint32(0xFFFFFFFF)
        for i in np.flatnonzero(end - start > _TOGETHER):
            out[i] = crc32(data[start[i] + _TOGETHER : end[i]].tobytes(), int(out[i]))
        return out

    def _run(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        at = n * 1024
        out = self.zeros[at + (crc & np.uint32(255))]
        for k in range(1, 4):
            out = out ^ self.zeros[at + 256 * k + ((crc >> np.uint32(8 * k)) & np.uint32(255))]
        return out

    def pairs(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Of each word and the next one; ``own`` are the words' checksums."""
        first = self._run(own[:-1], np.ones(max(0, len(own) - 1), np.int64)) ^ np.uint32(crc32(b" "))
        n = (end - start)[1:]
        out = self._run(first, np.minimum(n, _TOGETHER)) ^ own[1:]
        for i in np.flatnonzero(n > _TOGETHER):
            out[i] = crc32(data[start[i + 1] : end[i + 1]].tobytes(), int(first[i]))
        return out


def _features(column, checksums: Checksums, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of texts: the first one's place, words of each text, buckets of all words, and of all pairs with the text of each."""
    for at, data, bounds in slices(column):
        w = words(data, bounds, ALPHANUMERIC)
        n = np.diff(w.first)
        own = checksums.words(w.data, w.start, w.end)
        text = np.repeat(np.arange(len(n)), n)
        inside = text[1:] == text[:-1]
        pairs = checksums.pairs(w.data, w.start, w.end, own)[inside] if len(own) else np.zeros(0, np.uint32)
        yield at, n, own % np.uint32(buckets), pairs % np.uint32(buckets), text[1:][inside]


def _counted(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        checksums, counts = Checksums(), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, single, pairs, _ in _features(batch["text"], checksums, buckets):
                counts += np.bincount(single, minlength=buckets) + np.bincount(pairs, minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"bucket": some, "n": counts[some]})

    return run


def bucket_counts(df: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many runs of one or two words fall into each bucket; a task sends one row a bucket."""
    found = df.select(F.col(text).alias("text")).mapInArrow(_counted(buckets), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets))))."""
    s, t, n = documents.astype(np.float64), target.astype(np.float64), float(len(documents))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def _weighed(gain: np.ndarray, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        checksums = Checksums()
        for batch in batches:
            n_words, n, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for at, count, single, pairs, of_pair in _features(batch["text"], checksums, len(gain)):
                to = at + len(count)
                n_words[at:to] = count
                n[at:to] = count + np.maximum(0, count - 1)
                of_word = np.repeat(np.arange(len(count)), count)
                total[at:to] = np.bincount(of_word, gain[single], len(count)) + np.bincount(of_pair, gain[pairs], len(count))
            out = {"id": batch["id"], "n_words": n_words, "n_features": n, "weight": np.where(n > 0, total // np.maximum(n, 1), 0)}
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return run


def _score(seed: int) -> Column:
    """Weight plus noise of the id: the seed and the id as text, with a null id as an empty one."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.col("weight") + F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


# The order of drawing; ``row`` tells equal rows apart.
_KEY = ("low", "none", "id", "n_features", "row")


def _medians(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in batches if b.num_rows]
    if held:
        table = pa.Table.from_batches(held)
        order = pc.sort_indices(table, sort_keys=[(c, "ascending") for c in _KEY])
        middle = table.take(order[(len(order) - 1) // 2 : (len(order) - 1) // 2 + 1])
        yield middle.append_column("n", pa.array([len(order)], pa.int64())).combine_chunks().to_batches()[0]


def _place(row: Row) -> tuple:
    return tuple(row[c] for c in _KEY)


def _up_to(cut: Row, schema: StructType) -> Column:
    """Rows that are drawn no later than ``cut``; the first comparison can reach the scan."""
    at = F.struct(*[F.lit(cut[c]).cast(schema[c].dataType).alias(c) for c in _KEY])
    return (F.col("low") <= cut["low"]) & (F.struct(*_KEY) <= at)


def cutoff(rows: DataFrame, take: int, few: int = FEW_ROWS) -> Row | None:
    """The key of the row number ``take`` of ``rows`` in drawing order, None for 0.

    ``rows`` has the columns of the key and must give the same rows each time it is read. What comes to the driver is a
    row for each partition, and ``few`` rows in the end.
    """
    if take <= 0:
        return None
    left, wide = rows.select(*_KEY), None
    kinds = StructType([*left.schema.fields]).add("n", "long")
    while True:
        medians = left.mapInArrow(_medians, kinds).collect()
        total = sum(m.n for m in medians)
        if wide is None:
            wide = total
        if total <= few:
            return left.orderBy(*_KEY).limit(take).collect()[-1]
        if total * 4 <= wide:
            left, wide = written(left), total
        below = 0
        for middle in sorted(medians, key=_place):
            below += middle.n
            if 2 * below >= total:
                break
        up_to = _up_to(middle, kinds)
        count = left.filter(up_to).count()
        if take <= count:
            left = left.filter(up_to)
        else:
            take -= count
            left = left.filter(~up_to)


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rank``, 1 for the first in drawing order: sorted by ranges, and numbered range by range."""
    placed = written(rows.orderBy(*_KEY).withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33).alias("part")
    ahead, offsets = 0, []
    for found in placed.groupBy(part).count().orderBy("part").collect():  # a row for each range
        offsets.append((found["part"], ahead))
        ahead += found["count"]
    table = F.broadcast(rows.sparkSession.createDataFrame(offsets, "part long, ahead long"))
    number = F.col("ahead") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.withColumn("part", part).join(table, "part").withColumn("rank", number).drop("at", "part", "ahead")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_features``, ``weight``, ``score`` and ``rank``, null where not drawn.

    Words are runs of ASCII letters and digits and of everything beyond ASCII, A-Z in lower case. Of the rows with ``least_words``
    words or more, ``percent`` in a hundred are drawn, rounded down: the highest scores, of equal ones the smallest
    id, a null id last. Rows that repeat an id are rows of their own, and of those that are equal in all this any one
    comes first.

    A null or empty text has no words: no features, weight 0, never drawn. Other columns are not read, whatever
    their names. An empty table gives an empty table; with an empty target every bucket counts as unseen there.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    gain = gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets))
    schema = StructType().add("id", docs.schema[id].dataType).add("n_words", "long").add("n_features", "long").add("weight", "long")
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    weighed = rows.mapInArrow(_weighed(gain, to_arrow_schema(schema)), schema).withColumn("score", _score(seed))
    held = written(
        weighed.withColumn("row", F.monotonically_increasing_id())
        .withColumns({"low": -F.col("score"), "none": F.col("id").isNull(), "may": F.col("n_words") >= least_words})
    )
    may = held.filter("may")
    cut = cutoff(may, percent * may.count() // 100)
    out = [F.col("id").alias(id), "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if cut is None:
        return held.select(*out, none)
    drawn = F.col("may") & _up_to(cut, held.schema)
    return ranked(held.filter(drawn)).select(*out, "rank").unionByName(held.filter(~F.coalesce(drawn, F.lit(False))).select(*out, none))
