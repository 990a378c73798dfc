"""Document fingerprints by Order MinHash, and how they change when a text's end is replaced.

The character k-mers of a text are numbered by occurrence, so that repeats count. A hash of (k-mer,
occurrence) deals each of them to one of ``SKETCHES`` groups and ranks it there. The ``KEPT`` least of a
group, put back into the order of the text, are hashed as a tuple: one number of the fingerprint. Two
texts agree on it if they select the same k-mers and have them in the same order, which edits disturb.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StructType

from .words import mixed, numbers

K = 8  # characters
SKETCHES = 64
KEPT = 2
# Rows of a range of ids that is sorted in one go, and most ranges.
RANGE_ROWS = 4_000
MOST_RANGES = 10_000
GROUP = 100

_POWERS = numbers(11, K)
_PLACE_BITS = 24


def fingerprint(text: str) -> np.ndarray:
    """``SKETCHES`` numbers; a text of fewer than K characters is one k-mer, an empty one has zeros.

    A group that no k-mer falls into repeats the number of the next group that has one, mixed with its
    own place, so that short texts are told apart on every number.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = max(1, len(codes) - K + 1)
    if not len(codes):
        return np.zeros(SKETCHES, np.uint64)
    padded = np.concatenate((codes, np.zeros(K, np.uint64)))
    hashes = np.zeros(n, np.uint64)
    for k in range(K):
        hashes += padded[k : k + n] * _POWERS[k]
    # Equal k-mers lie together, in the order of the text; the place is kept in the low bits where it fits.
    place = np.arange(n, dtype=np.uint64)
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    kmer = mixed(hashes) & ~mask  # the same in texts of any length
    if n <= 1 << _PLACE_BITS:
        packed = np.sort(kmer | place)
        kmer, place = packed & ~mask, packed & mask
    else:
        order = np.lexsort((place, kmer))
        kmer, place = kmer[order], place[order]
    begin = np.concatenate(([True], kmer[1:] != kmer[:-1]))
    at = np.arange(n)
    occurrence = at - np.maximum.accumulate(np.where(begin, at, 0))
    rank = mixed(kmer ^ mixed(occurrence.astype(np.uint64) + np.uint64(1)))
    # The least of each group: groups are the low bits, so one sort of what can be among the least is enough.
    group = (rank & np.uint64(SKETCHES - 1)).astype(np.int64)
    few = n
    if n > SKETCHES * KEPT * 16:  # about sixteen times as many as needed on average
        some = rank <= np.uint64(int(SKETCHES * KEPT * 16 / n * 2**64))
        if np.bincount(group[some], minlength=SKETCHES).min() >= KEPT:
            rank, place, group = rank[some], place[some], group[some]
            few = len(rank)
    order = np.lexsort((rank, group))
    group, place, rank = group[order], place[order], rank[order]
    first = np.searchsorted(group, np.arange(SKETCHES))
    count = np.append(first[1:], few) - first
    chosen = first[:, None] + np.arange(KEPT)
    held = np.arange(KEPT) < count[:, None]
    chosen = np.minimum(chosen, few - 1)
    places = np.where(held, place[chosen], np.uint64(2**63))
    ranks = np.where(held, rank[chosen], np.uint64(0))
    in_text = np.take_along_axis(ranks, np.argsort(places, axis=1, kind="stable"), 1)
    out = np.zeros(SKETCHES, np.uint64)
    for k in range(KEPT):
        out = mixed(out + in_text[:, k] + np.uint64(k + 1))
    full = np.flatnonzero(count > 0)
    source = full[np.searchsorted(full, np.arange(SKETCHES)) % len(full)]
    borrowed = count == 0
    out[borrowed] = mixed(out[source[borrowed]] ^ np.flatnonzero(borrowed).astype(np.uint64))
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of numbers that agree; equal texts have 1."""
    return float(np.mean(a == b))


def _streamed(schema: pa.Schema):
    """Rows in order; each is finished when the row after it in its range is known."""

    def finish(row: tuple, after: tuple) -> dict:
        part, guest, id_, text, own = row
        n = len(text)
        edited = text[: n - n // 3] + after[3][: n // 3]
        changed = fingerprint(edited)
        return {
            "id": id_,
            "n_chars": n,
            "edited_sha256": sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            "fingerprint": own.view(np.int64).tolist(),
            "edited_fingerprint": changed.view(np.int64).tolist(),
            "near_edited": likeness(own, changed),
            "near_next": likeness(own, after[4]),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            out = []
            for part, guest, id_, text in zip(*[batch[c].to_pylist() for c in ("part", "guest", "id", "text")]):
                row = (part, guest, id_, text, fingerprint(text))
                if waiting is not None and waiting[0] == part and not waiting[1]:
                    out.append(finish(waiting, row))
                waiting = row
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and likenesses.

    The edited text has its last ``floor(n_chars / 3)`` code points replaced by the first as many (or all) of
    the next document's, by descending id; after the last comes the first. Columns: ``id``, ``n_chars``,
    ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    Ids are cut into ranges by their quantiles; a range is sorted and streamed through one task, with the
    first row of the range below it as a guest at its end, so whole texts are shuffled once. A null text is
    an empty one, with a fingerprint of zeros. Null ids come last; equal ids are ordered by descending text;
    a lone row is followed by itself. Repeated rows give one result each; other columns are not read,
    whatever their names; an empty table gives an empty one.
    """
    kind = docs.schema[id].dataType
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    count = docs.count()
    ranges = min(MOST_RANGES, count // RANGE_ROWS + 1)
    cuts = rows.agg(F.percentile_approx("id", [k / ranges for k in range(1, ranges)] or [0.5], 100 * ranges)).first()[0] or []
    cuts = sorted(set(cuts)) if ranges > 1 else []
    # How many cuts lie below the id: first among every hundredth one, then in the hundred it leads to.
    groups = [cuts[k : k + GROUP] for k in range(0, len(cuts), GROUP)] or [[]]
    listed = lambda values: F.array(*[F.lit(c).cast(kind) for c in values]).cast(ArrayType(kind))
    below = lambda values: F.size(F.filter(values, lambda c: c < F.col("id")))
    group = F.least(below(listed([g[-1] for g in groups if g])), F.lit(len(groups) - 1))
    low = group * GROUP + below(F.get(F.array(*map(listed, groups)), group))
    part = F.when(F.col("id").isNull(), F.lit(-1)).otherwise(low).cast("int")
    heads = rows.select("id", part.alias("part")).groupBy("part").agg(F.max("id").alias("id"))
    # One row a range: the range above takes its head as guest, the lowest one that of the highest.
    order = Window.orderBy(F.desc("part"))
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    guests = heads.select("id", F.coalesce(F.lag("part").over(order), F.last("part").over(whole)).alias("part"))
    schema = StructType().add("id", kind).add("n_chars", "long").add("edited_sha256", "string")
    schema = schema.add("fingerprint", ArrayType(LongType())).add("edited_fingerprint", ArrayType(LongType()))
    schema = schema.add("near_edited", "double").add("near_next", "double")
    # A guest row is any with the head's id; sorting puts the right one first and the others are not read.
    sent = rows.join(F.broadcast(guests), rows["id"].eqNullSafe(guests["id"])).select("part", F.lit(True).alias("guest"), rows["id"], "text")
    both = rows.select(part.alias("part"), F.lit(False).alias("guest"), "id", "text").unionByName(sent)
    dealt = both.repartitionById(len(cuts) + 2, F.col("part") + 1).sortWithinPartitions("part", "guest", F.desc_nulls_last("id"), F.desc("text"))
    return dealt.mapInArrow(_streamed(to_arrow_schema(schema)), schema).withColumnRenamed("id", id)
