"""Benchmark decontamination: which words of each document lie in a window of a benchmark item.

A prefix-filtered set join at containment one. A window's set are its word shingles; ordered by how
rare they are in the documents, its necessary prefix is the rarest one. Stretches of a document all of
whose shingles may be in the benchmark (a filter of fixed size says so) are kept, equal stretches once.
They meet the windows on the prefix shingle; the place of the shingle in both gives where the window
would lie, which must be inside the stretch, and then the words are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from ..session import written
from .words import ALPHANUMERIC, SHINGLE_WORDS, Words, shingles, slices, words

WINDOW_WORDS = 13
# Size of the filter that is sent to every executor, whatever the size of the benchmark: 8 MB.
FILTER_BITS = 1 << 26


def _places(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(FILTER_BITS - 1)
    return tokens & mask, (tokens >> np.uint64(37)) & mask


def _windows(width: int, window: int):
    """Distinct windows of each item: words, shingles in order, and their width."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"item": [], "words": [], "tokens": [], "wide": []}
            for at, data, bounds in slices(batch["text"]):
                w = words(data, bounds, ALPHANUMERIC)
                hashes = w.hashes()
                for d in range(len(bounds) - 1):
                    first, n = int(w.first[d]), int(w.first[d + 1] - w.first[d])
                    held = min(window, n)
                    wide = min(width, held)
                    if not n:
                        continue
                    item = batch["item"][at + d].as_py()
                    texts = [w.text(first + k).decode() for k in range(n)]
                    tokens, _ = shingles(hashes[first : first + n], np.array([0, n]), wide)
                    for k in range(n - held + 1):
                        out["item"].append(item)
                        out["words"].append(texts[k : k + held])
                        out["tokens"].append(tokens[k : k + held - wide + 1].view(np.int64).tolist())
                        out["wide"].append(wide)
            yield pa.RecordBatch.from_pydict(out, pa.schema({"item": pa.string(), "words": pa.list_(pa.string()), "tokens": pa.list_(pa.int64()), "wide": pa.int32()}))

    return run


def _filter_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places = np.unique(np.concatenate(_places(batch["token"].to_numpy().view(np.uint64))))
        bits = (np.uint64(1) << (places & np.uint64(63))).view(np.int64)
        yield pa.RecordBatch.from_pydict({"at": (places >> np.uint64(6)).astype(np.int64), "bits": bits})


def _filter(tokens: DataFrame) -> np.ndarray:
    """One bit for each of two places of every token; at most ``FILTER_BITS`` / 64 rows come back."""
    rows = tokens.mapInArrow(_filter_words, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    return out.view(np.uint64)


def _stretches(found: np.ndarray, share: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(text, first, end) of runs of consecutive true places, none across texts."""
    hit = np.flatnonzero(found)
    if not len(hit):
        return
    text = np.searchsorted(share, hit, "right") - 1
    new = np.flatnonzero(np.concatenate(([True], (np.diff(hit) > 1) | (np.diff(text) > 0))))
    ends = np.append(new[1:], len(hit)) - 1
    for b, e in zip(new, ends):
        yield int(text[b]), int(hit[b]), int(hit[e]) + 1


def _scan(bits, widths: list[int], schema: pa.Schema):
    def held(tokens: np.ndarray) -> np.ndarray:
        one, two = _places(tokens)
        table = bits.value
        out = (table[one >> np.uint64(6)] >> (one & np.uint64(63))) & np.uint64(1) > 0
        some = np.flatnonzero(out)
        two = two[some]
        out[some] = (table[two >> np.uint64(6)] >> (two & np.uint64(63))) & np.uint64(1) > 0
        return out

    def rows_of(w: Words, hashes: np.ndarray, keys: list) -> Iterator[dict]:
        for width in widths:
            tokens, share = shingles(hashes, w.first, width, whole=False)
            for d, begin, end in _stretches(held(tokens), share):
                if keys[d] is not None:
                    start = begin - int(share[d])  # in words of the text
                    first = int(w.first[d]) + start
                    texts = [w.text(k).decode() for k in range(first, first + end - begin + width - 1)]
                    yield {"key": keys[d], "start": start, "wide": width, "words": texts, "tokens": tokens[begin:end].view(np.int64).tolist()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            counts, runs = np.zeros(batch.num_rows, np.int64), []
            keys = batch["key"].to_pylist()
            fresh = [k if k is not None and k not in seen and not seen.add(k) else None for k in keys]  # one of equal texts is enough
            for at, data, bounds in slices(batch["text"]):
                w = words(data, bounds, ALPHANUMERIC)
                n = len(bounds) - 1
                counts[at : at + n] = np.diff(w.first)
                runs += rows_of(w, w.hashes(), fresh[at : at + n])
            empty = {name: pa.nulls(batch.num_rows, schema.field(name).type) for name in schema.names}
            yield pa.RecordBatch.from_pydict(empty | {"id": batch["id"], "key": batch["key"], "n_words": counts}, schema=schema)
            yield pa.RecordBatch.from_pylist(runs, schema=schema)

    return run


def _covered(spans: str) -> Column:
    """How many places lie in at least one of the spans (begin, end)."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to"))
    return F.aggregate(
        F.array_sort(F.col(spans)),
        start,
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["to"], s["begin"]))).alias("n"),
            F.greatest(a["to"], s["end"]).alias("to"),
        ),
        lambda a: a["n"],
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW_WORDS,
    share_percent: int = 5,
) -> DataFrame:
    """``id``, ``n_words``, ``n_hit``, ``n_items``, ``items`` and ``contaminated`` of every row of ``docs``.

    Words are runs of ASCII letters and digits and of anything beyond ASCII, A-Z in lower case. A window is
    ``window`` consecutive words of an item; an item of fewer words, but not none, is one window. A word of
    a document is hit if it lies in any occurrence of a window; ``items`` are the distinct ids, as sorted
    text, of items of which a window occurs. A document is contaminated if some word is hit and at least
    ``share_percent`` of its words are.

    A null or empty text has no words and no hits; so has a null item. Items with a null id hit words but
    are not listed. Repeated rows give repeated results, repeated items one entry. Other columns are not
    read, whatever their names. An empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    kind = docs.schema[id].dataType
    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col(item_text).alias("text"))
    windows = written(items.mapInArrow(_windows(SHINGLE_WORDS, window), "item string, words array<string>, tokens array<long>, wide int"))
    bits = spark.sparkContext.broadcast(_filter(windows.select(F.explode("tokens").alias("token"))))
    widths = sorted(r[0] for r in windows.select("wide").distinct().collect())  # at most five

    schema = StructType().add("id", kind).add("key", "binary").add("n_words", "long")
    schema = schema.add("start", "long").add("wide", "integer").add("words", ArrayType(StringType())).add("tokens", ArrayType(LongType()))
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.unhex(F.md5(text)).alias("key"))
    scanned = written(rows.mapInArrow(_scan(bits, widths, to_arrow_schema(schema)), schema))
    found = scanned.filter("n_words is not null").select("id", "key", "n_words")
    runs = scanned.filter("n_words is null").select("key", "start", "wide", F.sha1(F.to_json(F.struct("wide", "words"))).alias("run"), "words", "tokens")

    placed = runs.select("key", "start", "run").distinct()
    distinct = runs.groupBy("run").agg(F.first("words").alias("words"), F.first("tokens").alias("tokens"), F.count_distinct("key").alias("texts"))
    distinct = written(distinct)
    held = distinct.select("run", "words", "texts", F.posexplode("tokens").alias("at", "token"))
    rarity = held.groupBy("token").agg(F.sum("texts").alias("held"))
    named = windows.withColumn("window", F.sha1(F.to_json(F.struct("words"))))
    shapes = named.groupBy("window").agg(F.first("words").alias("window_words"), F.first("tokens").alias("tokens"))
    each = shapes.select("window", F.posexplode("tokens").alias("offset", "token")).join(rarity, "token", "left")
    prefix = each.groupBy("window").agg(F.min(F.struct("held", "token", "offset")).alias("rarest"), F.min(F.col("held").isNotNull()).alias("all"))
    # A window with a shingle that no document holds cannot occur.
    prefix = prefix.filter("all").join(shapes.select("window", "window_words"), "window")
    prefix = prefix.select("window", "window_words", F.col("rarest.token").alias("token"), F.col("rarest.offset").alias("offset"))
    begin, length = F.col("at") - F.col("offset"), F.size("window_words")
    met = held.join(prefix, "token").filter((begin >= 0) & (begin + length <= F.size("words")))
    same = F.slice("words", begin + 1, length) == F.col("window_words")
    hits = written(met.filter(same).select("run", "window", begin.cast("long").alias("begin"), (begin + length).cast("long").alias("end")))
    spans = hits.groupBy("run").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    listed = hits.select("run", "window").distinct().join(named.filter("item is not null").select("window", "item").distinct(), "window")
    listed = listed.groupBy("run").agg(F.collect_set("item").alias("items"))
    of_runs = spans.join(listed, "run", "left")
    moved = F.transform("spans", lambda s: F.struct((s["begin"] + F.col("start")).alias("begin"), (s["end"] + F.col("start")).alias("end")))
    of_texts = (
        placed.join(of_runs, "run").select("key", moved.alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
        .groupBy("key")
        .agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        .select("key", _covered("spans").alias("n_hit"), "items")
    )
    # Written, so that the join is by itself and a key of very many copies can be split.
    out = found.join(written(of_texts), "key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    listed_items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        F.col("id").alias(id),
        "n_words",
        n_hit.alias("n_hit"),
        F.size(listed_items).cast("long").alias("n_items"),
        listed_items.alias("items"),
        ((n_hit > 0) & (n_hit * 100 >= F.col("n_words") * share_percent)).alias("contaminated"),
    )
