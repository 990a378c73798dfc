"""N-gram Jaccard join: documents whose sets of word shingles are alike, as connected groups.

A size-aware heavy-light join. Any two sets that reach the threshold share, in one common order of all
shingles, at least *c* of the first ``n - ceil(t * n) + c`` shingles of either. The order is by rarity, so
that what many documents share comes last.

* *Light* sets enumerate every subset of two shingles of that prefix (c = 2); two light sets are compared
  only if they share such a subset.
* *Heavy* sets, too long to enumerate, scan the inverted lists of single prefix shingles (c = 1).
* The boundary is the size at which the enumerated subsets plus the scanned list entries cost least.

Before that, equal sets become one node, and a node is left out when fewer of its first shingles than
the bound demands occur in any other node: an exact test at a tenth of ``n``, in hash order, that most
texts without a partner fail. Then the lists of single shingles are closed as far as possible: every node is
compared with a leader of its lists, round by round, and a list whose members are all connected needs nothing more. The
rounds go on while they close much of what is open, so that few pairs of a large group are left to compare.
A subset's list is part of the lists of its shingles, so only shingles whose lists are still open are
enumerated or scanned, and of these only keys after which enough is left of the set for the smallest member of the list. Members of
such lists that are in different components are compared in full, a pair once, at its first common key, unless the bitmaps of their sets
differ in more bits than linked sets in shingles; long lists are cut into blocks and compared pair of blocks by pair of blocks.
Where many pairs are open, nodes are first compared within parts of a hash of theirs only, which connects most of what
has links at all. So no link between different components is lost, and no list is expanded into all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from ..session import fits_broadcast, written
from .components import components
from .words import NOT_SPACE, SHINGLE_WORDS, mixed, shingles, slices, words

THRESHOLD_PERCENT = 80
POSTINGS_A_BUCKET = 2_000_000
# Parts of a bucket that are sorted one after the other.
_PARTS = 16
# An enumerated subset is a row that is written and shuffled, a scanned list entry is only counted.
ROW_COST = 10
# Rounds of comparing with leaders: so many at least and at most, and in between as long as a round closes a tenth of what is open.
LEADER_ROUNDS = 3
MOST_ROUNDS = 12
# Leaders that a node is compared with in a round after the first.
LEADERS = 16
# Least number of buckets, so that a node's credits come from as many of them in a small table as in a large one.
LEAST_BUCKETS = 32
# Members of an open list that one task compares with as many others.
BLOCK_MEMBERS = 512
# With more open pairs than so many times the members of lists, members are first compared within so many parts.
SAMPLE_PARTS = 8
# 64-bit words of the bitmap of a set. The generated code of the join grows with them; from 16 on the JVM no longer compiles it.
BITMAP_WORDS = 8
_SUFFIX_BYTES = 5


def _needed(n, percent: int):
    """Shingles that a set of size ``n`` shares with any partner: ceil(t * n)."""
    return -(-percent * n // 100)


def _shared_by(n: int, m: int, percent: int) -> int:
    """Shingles that linked sets of the sizes ``n`` and ``m`` share at least."""
    return -(-percent * (n + m) // (100 + percent))


def _spare(n: int) -> int:
    """Shared shingles that the test in hash order demands of a set."""
    return max(1, n // 10)


def _sent(n: int, percent: int) -> int:
    """How many first shingles in hash order a set of size ``n`` sends for that test.

    Of the shingles it shares with a partner, as many must be among them as the larger of the two demands. A partner's demand
    grows by one in ten sizes, and what is shared by more, so partners up to ten sizes larger decide. Below a
    quarter that no longer holds; there all are sent.
    """
    if percent < 25:
        return n
    larger = range(n, min(n + 10, n * 100 // percent) + 1)
    return min(n, max(n - _needed(n, percent) + _spare(n), *[n - _shared_by(n, m, percent) + _spare(m) for m in larger]))


def _sets(column, width: int) -> Iterator[tuple[int, np.ndarray]]:
    for at, data, bounds in slices(column):
        w = words(data, bounds, NOT_SPACE)
        hashes, share = shingles(w.hashes(), w.first, width)
        for d in range(len(bounds) - 1):
            yield at + d, np.unique(hashes[share[d] : share[d + 1]])


def _node(tokens: np.ndarray) -> np.ndarray:
    """128 bits that stand for a set."""
    one = mixed(tokens).sum(dtype=np.uint64) + np.uint64(len(tokens))
    two = mixed(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return mixed(np.array([one, two], np.uint64)) | np.uint64(1)


def _postings(nodes: np.ndarray, prefixes: list[np.ndarray], buckets: int) -> Iterator[dict]:
    """A batch's (shingle, node) pairs by bucket.

    A shingle that several nodes of the batch hold is credited to them here and sent once, without a
    node; so a shingle that a third of all documents hold is sent once a batch.
    """
    _, rows = np.unique(nodes, return_index=True)
    tokens = np.concatenate([prefixes[r] for r in rows])
    owner = np.repeat(nodes[rows], [len(prefixes[r]) for r in rows])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    begin = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
    count = np.diff(np.append(begin, len(tokens)))
    credited, credits = np.unique(owner[np.repeat(count, count) > 1], return_counts=True)
    tokens, owner = tokens[begin], np.where(count > 1, np.uint64(0), owner[begin])
    by, to = tokens % np.uint64(buckets), credited % np.uint64(buckets)
    order = np.lexsort((owner, by))  # equal owners lie together, which compresses
    tokens, owner, by = tokens[order], owner[order], by[order]
    order = np.argsort(to, kind="stable")
    credited, credits, to = credited[order], credits[order], to[order]
    for b in np.union1d(by, to):
        at, own = (slice(*np.searchsorted(x, [b, b + np.uint64(1)])) for x in (by, to))
        yield {
            "bucket": int(b),
            "tokens": tokens[at].view(np.uint8).reshape(-1, 8)[:, 8 - _SUFFIX_BYTES :].tobytes(),
            "owners": owner[at].tobytes(),
            "credited": credited[own].tobytes(),
            "credits": credits[own].astype(np.int64).tobytes(),
        }


def _signatures(percent: int, width: int, buckets: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes = np.zeros((batch.num_rows, 2), np.uint64), np.zeros(batch.num_rows, np.int64)
            prefixes = [np.zeros(0, np.uint64)] * batch.num_rows
            for row, tokens in _sets(batch["text"], width):
                n = sizes[row] = len(tokens)
                if n:
                    nodes[row] = _node(tokens)
                    prefixes[row] = tokens[: _sent(n, percent)]
            held = [nodes[i].tobytes() if n else None for i, n in enumerate(sizes)]
            empty = {name: pa.nulls(batch.num_rows, schema.field(name).type) for name in schema.names}
            docs = {"id": batch["id"], "key": batch["key"], "node": held, "n": sizes, "mark": nodes[:, 0].view(np.int64)}
            yield pa.RecordBatch.from_pydict(empty | docs, schema=schema)
            if sizes.any():
                sent = list(_postings(nodes[sizes > 0, 0], [p for p in prefixes if len(p)], buckets))
                yield pa.RecordBatch.from_pylist(sent, schema=schema)

    return run


def _values(column: pa.Array, kind) -> np.ndarray:
    """The bytes of all rows of a binary column, one after the other, without a copy."""
    data = column.buffers()[2]
    if data is None:
        return np.zeros(0, kind)
    edge = np.frombuffer(column.buffers()[1], np.int32)[[column.offset, column.offset + len(column)]]
    return np.frombuffer(data, np.uint8)[edge[0] : edge[1]].view(kind)


def _repeated(raw: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The owner of each shingle that has another owner too, 0 standing for several of them."""
    padded = np.zeros((len(raw), 8), np.uint8)
    padded[:, :_SUFFIX_BYTES] = raw
    tokens = padded.reshape(-1).view(np.uint64)
    order = np.lexsort((owner, tokens))
    tokens, owner = tokens[order], owner[order]
    new = np.concatenate(([True], (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])))
    tokens, owner = tokens[new], owner[new]
    begin = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
    count = np.diff(np.append(begin, len(tokens)))
    return owner[(np.repeat(count, count) > 1) & (owner != 0)]


def _summed(marks: list[np.ndarray], credits: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    out, which = np.unique(np.concatenate(marks), return_inverse=True)
    return out, np.bincount(which, np.concatenate(credits), len(out)).astype(np.int64)


def _shared(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one bucket: how many shingles of a node occur in another node. A part of the bucket is sorted at a time."""
    held = [[_values(batch[name], kind) for name, kind in (("tokens", np.uint8), ("owners", np.uint64), ("credited", np.uint64), ("credits", np.int64))] for batch in batches]
    tokens = [h[0].reshape(-1, _SUFFIX_BYTES) for h in held]
    marks, credits = _summed([h[2] for h in held], [h[3] for h in held])
    for part in range(_PARTS):
        inside = [t[:, -1] % _PARTS == part for t in tokens]
        if not any(x.any() for x in inside):
            continue
        owner = _repeated(np.concatenate([t[x] for t, x in zip(tokens, inside)]), np.concatenate([h[1][x] for h, x in zip(held, inside)]))
        marks, credits = _summed([marks, owner], [credits, np.ones(len(owner), np.int64)])
    yield pa.RecordBatch.from_pydict({"mark": marks.view(np.int64), "credits": credits})


def _bitmap(tokens: np.ndarray) -> np.ndarray:
    """For each bit whether an odd number of shingles falls on it: two sets differ in as many shingles at least as their bitmaps in bits."""
    odd = np.bincount((mixed(tokens) % np.uint64(64 * BITMAP_WORDS)).astype(np.int64), minlength=64 * BITMAP_WORDS) % 2
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _token_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [tokens for _, tokens in _sets(batch["text"], width) if len(tokens)]
            yield pa.RecordBatch.from_pydict(
                {
                    "node": pa.array([_node(t).tobytes() for t in found], pa.binary()),
                    "n": pa.array([len(t) for t in found], pa.int64()),
                    "bits": pa.array([_bitmap(t) for t in found], pa.list_(pa.int64())),
                    "tokens": pa.array([t.view(np.int64) for t in found], pa.list_(pa.int64())),
                }
            )

    return run


def _prefix(percent: int, c: int, n="n", unique="unique"):
    """How many of a set's shared shingles are among its first ``n - needed + c``."""
    need = F.ceil(F.lit(percent) * F.col(n) / 100)
    return F.greatest(F.lit(0), F.col(n) - need + c - F.col(unique)).cast("int")


def _entries(sets: DataFrame, percent: int) -> DataFrame:
    """A row for each prefix shingle of each node: ``node``, ``n``, ``unique``, ``at``, ``key`` and ``reach``.

    The ``unique`` shingles, that no other node has, come before all. The prefix is that of the subsets of two, for every node.
    """
    first = F.slice("tokens", F.lit(1), F.least(F.size("tokens"), _prefix(percent, 2)))
    rows = sets.select("node", "n", "unique", F.posexplode(first).alias("at", "key"))
    return rows.withColumn("reach", F.col("n") - F.col("unique") - F.col("at"))


def _boundary(left: DataFrame, percent: int) -> int:
    """The size up to which enumerating pairs of open shingles costs less than scanning their lists.

    Costs are summed per class of sizes, eight classes a doubling, so a few hundred rows come back.
    """
    held = F.size("open")
    single = F.filter("open", lambda x: x["at"] < _prefix(percent, 1))
    scanned = F.aggregate(single, F.lit(0).cast("bigint"), lambda a, x: a + x["entries"])
    costs = (
        left.groupBy(F.floor(F.log2("n") * 8).alias("class"))
        .agg(F.sum(held * (held - 1) / 2).alias("pairs"), F.sum(scanned).alias("scanned"), F.max("n").alias("size"))
        .orderBy("class")
        .collect()
    )
    best, boundary = sum(c["scanned"] for c in costs), 0
    total = best
    for c in costs:
        total += ROW_COST * c["pairs"] - c["scanned"]
        if total < best:
            best, boundary = total, c["size"]
    return int(boundary)


def _keys(percent: int, boundary: int, schema: pa.Schema):
    """Subsets of two open shingles of light sets, single ones of heavy sets and of those they may meet.

    ``reach`` is how many shingles a set can share with another whose first common key this is, ``before`` how many open
    shingles come before the key's last one, ``common`` how many of them belong to the key, and ``entries`` how long its list is at most.
    A key whose ``reach`` is too short for the smallest member of its list is left out.
    """

    def light(n: int) -> bool:
        return n <= boundary and _needed(n, percent) >= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = {name: [] for name in ("key", "reach", "common", "entries", "before", "row")}

            def add(row: int, **values):
                for name, value in values.items():
                    numbers[name].append(np.asarray(value).astype(np.uint64).view(np.int64))
                numbers["row"].append(np.full(len(values["key"]), row))

            opened = batch["open"]
            values, bounds = opened.flatten(), np.append(0, np.cumsum(opened.value_lengths().to_numpy()))
            tokens, at, entries, least = (values.field(name).to_numpy() for name in ("key", "at", "entries", "least"))
            for row, (n, unique) in enumerate(zip(batch["n"].to_pylist(), batch["unique"].to_pylist())):
                cut = slice(bounds[row], bounds[row + 1])
                own, place, held, smallest = tokens[cut].view(np.uint64), unique + at[cut], entries[cut], least[cut]
                if light(n):
                    first, second = np.triu_indices(len(own), 1)
                    reach = n - place[second] + 1
                    may = reach * (100 + percent) >= (n + np.maximum(smallest[first], smallest[second])) * percent
                    first, second, reach = first[may], second[may], reach[may]
                    key = mixed(mixed(own[first]) + own[second])
                    add(row, key=key, reach=reach, common=np.ones(len(key)), entries=np.minimum(held[first], held[second]), before=second)
                if not light(n) or n * 100 > percent * boundary or _needed(-(-percent * n // 100), percent) < 2:
                    may = (place < n - _needed(n, percent) + 1) & ((n - place) * (100 + percent) >= (n + smallest) * percent)
                    before = np.flatnonzero(may)
                    add(row, key=own[may], reach=n - place[may], common=np.zeros(len(before)), entries=held[may], before=before)
            found = {name: np.concatenate(x) if x else np.zeros(0, np.int64) for name, x in numbers.items()}
            row = pa.array(found.pop("row"))
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(tokens))
            out = found | {"open": lists.take(row)} | {name: batch[name].take(row) for name in ("node", "n", "root", "bits")}
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return run


def _possible(percent: int):
    """Whether the sizes of two sets, and what is left of them after a common key, allow a link."""
    smaller, larger = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
    return (smaller * 100 >= larger * percent) & (F.least("a_reach", "b_reach") * (100 + percent) >= (F.col("a_n") + F.col("b_n")) * percent)


def _alike(percent: int):
    """Whether the bitmaps of two sets differ in no more bits than linked sets of their sizes may differ in shingles."""
    differ = sum((F.bit_count(F.col("a_bits")[i].bitwiseXOR(F.col("b_bits")[i])) for i in range(BITMAP_WORDS)), F.lit(0))
    return differ * (100 + percent) <= (F.col("a_n") + F.col("b_n")) * (100 - percent)


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that reach the threshold, by the sizes of their sets and intersection."""

    def side(s: str) -> DataFrame:
        return sets.select(F.col("node").alias(s), F.col("n").alias(f"{s}_n"), F.col("tokens").alias(f"{s}_tokens"))

    common = F.size(F.array_intersect("a_tokens", "b_tokens"))
    return (
        pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a")
        .filter(common * (100 + percent) >= (F.col("a_n") + F.col("b_n")) * percent)
        .select("a", "b")
    )


def _side(df: DataFrame, s: str) -> DataFrame:
    return df.select(*[F.col(c) if c == "key" else F.col(c).alias(s if c == "node" else f"{s}_{c}") for c in df.columns])


def _open_pairs(left: DataFrame, percent: int, parts: int = 1) -> DataFrame:
    """All pairs that may still bring a link between two components, each at its first common key only.

    A list of many members is dealt to blocks, and every pair of blocks is a group of its own. With several ``parts`` only
    the pairs whose nodes are in the same part.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = left.schema["node"].dataType
    schema = StructType().add("key", "long").add("node", kind).add("n", "long").add("root", kind)
    for name in ("reach", "common", "entries", "before"):
        schema = schema.add(name, "long")
    schema = schema.add("open", ArrayType(LongType())).add("bits", ArrayType(LongType()))
    keys = left.mapInArrow(_keys(percent, _boundary(left, percent), to_arrow_schema(schema)), schema)
    blocks = F.ceil(F.col("entries") / (BLOCK_MEMBERS * parts))
    members = keys.withColumn("block", F.pmod(F.xxhash64("node"), blocks)).withColumn("part", F.pmod(F.xxhash64("node", F.lit("part")), F.lit(parts)))
    cells = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    low, high = F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    cells = cells.select("key", "part", low, high, "node", "n", "reach", "root", "common", "block", "before", "open", "bits")
    cell = cells.columns[:4]
    a, b = (cells.select(*cell, *[F.col(c).alias(s if c == "node" else f"{s}_{c}") for c in cells.columns[4:]]) for s in "ab")
    met = a.join(b, cell).filter("a < b and a_root != b_root and (low = high or a_block != b_block)").filter(_possible(percent) & _alike(percent))
    ahead = [F.slice(f"{s}_open", F.lit(1), F.col(f"{s}_before").cast("int")) for s in "ab"]
    first = (F.col("a_common") == F.col("b_common")) & (F.size(F.array_intersect(*ahead)) == F.col("a_common"))
    # What two sets share is in both prefixes, where it is open, or behind the prefix that ends first.
    behind = [F.least(F.col(f"{s}_n"), F.ceil(F.lit(percent) * F.col(f"{s}_n") / 100) - 2) for s in "ab"]
    most = F.size(F.array_intersect("a_open", "b_open")) + F.greatest(F.lit(0), *behind)
    enough = most * (100 + percent) >= (F.col("a_n") + F.col("b_n")) * percent
    return met.filter(first & enough).select("a", "b").distinct()


def _leader_pairs(rows: DataFrame, lists: DataFrame, several: int, percent: int) -> DataFrame:
    """Every member with its list's leader, or, of the lists it is in, with the leaders of ``several`` at most."""
    met = _side(rows, "b").join(_side(lists, "a"), "key").filter("a_root != b_root").filter(_possible(percent))
    part = F.pmod(F.xxhash64("key"), F.lit(several)).alias("part")
    return met.groupBy("b", part).agg(F.min("a").alias("a")).select("a", "b").distinct()


def _open_lists(rows: DataFrame, round_: int) -> DataFrame:
    """Lists with members of more than one component, and a leader of each.

    At first one leader for all lists that hold it, so that large groups become one star; then another one for each list.
    """
    order = F.xxhash64("node", "key", F.lit(round_)) if round_ else F.xxhash64("node")
    leader = F.min_by(F.struct("node", "n", "reach", "root"), order).alias("leader")
    lists = rows.groupBy("key").agg(F.count("*").alias("entries"), F.min("n").alias("least"), F.min("root").alias("low"), F.max("root").alias("high"), leader)
    return written(lists.filter("low != high").select("key", "entries", "least", "leader.*"))


def _open_work(rooted: DataFrame, lists: DataFrame) -> tuple[int, int]:
    """Pairs of members of different components in the open lists, and members."""
    held = rooted.join(lists.select("key"), "key").groupBy("key", "root").agg(F.count("*").alias("n"))
    each = held.groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("inside"))
    return each.agg(F.sum((F.col("n") * F.col("n") - F.col("inside")) / 2), F.sum("n")).first()


def _joined(roots: DataFrame | None, found: DataFrame) -> DataFrame:
    """``roots`` with the links ``found`` (a, b) between nodes added."""
    if roots is None:
        return components(found)
    for s in ("a", "b"):
        found = found.join(roots.select(F.col("node").alias(s), F.col("root").alias("to")), s, "left")
        found = found.withColumn(s, F.coalesce("to", s)).drop("to")
    merged = components(found)
    moved = merged.select(F.col("node").alias("root"), F.col("root").alias("top"))
    known = roots.join(moved, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return written(known.unionByName(merged.join(roots.select("node"), "node", "left_anti")))


def _connected(sets: DataFrame, percent: int) -> DataFrame | None:
    """(node, root) of the nodes that are linked with another, None if none is."""
    roots, rows, before = None, _entries(sets, percent), None
    for round_ in range(MOST_ROUNDS + 1):
        if roots is None:
            rooted = rows.withColumn("root", F.col("node"))
        else:
            rooted = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        lists = _open_lists(rooted, round_)
        if lists.isEmpty():
            return roots
        if round_ == 1:  # by now most lists are closed, and they stay so
            rows = written(rows.join(lists.select("key"), "key"))
            rooted = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        if round_ >= LEADER_ROUNDS:
            pairs, members = _open_work(rooted, lists)
            if pairs <= members or round_ == MOST_ROUNDS or (before is not None and pairs > 0.9 * before):
                break
            before = pairs
        found = _leader_pairs(rooted.drop("unique", "at"), lists.drop("entries", "least"), LEADERS if round_ else 1, percent)
        roots = _joined(roots, written(_linked(found, sets, percent)))
    opened = F.sort_array(F.collect_list(F.struct("at", "key", "entries", "least"))).alias("open")
    for parts in (SAMPLE_PARTS, 1) if pairs > SAMPLE_PARTS * members else (1,):
        left = rooted.join(lists.select("key", "entries", "least"), "key").groupBy("node", "n", "unique", "root").agg(opened)
        left = written(left.join(sets.select("node", "bits"), "node"))
        roots = _joined(roots, written(_linked(_open_pairs(left, percent, parts), sets, percent)))
        if parts > 1:
            rooted = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
            lists = _open_lists(rooted, round_)
    return roots


def jaccard_join(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    percent: int = THRESHOLD_PERCENT,
    width: int = SHINGLE_WORDS,
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_shingles`` and ``component_id``.

    Words are runs of anything but ASCII white space, A-Z in lower case; the set of a text holds its distinct
    shingles of ``width`` words, or its whole sequence if it has fewer. Two rows are linked when
    ``100 * |intersection| >= percent * |union|``; ``component_id`` is the smallest id that links lead to.

    A null or empty text has no shingle and is linked with nothing: its ``component_id`` is its own id.
    Rows with a null id take part; the component of null ids alone is null. Repeated rows give repeated
    results; other columns are not read, whatever their names. An empty table gives an empty table.
    """
    kind = docs.schema[id].dataType
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.unhex(F.md5(text)).alias("key"))
    letters = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = LEAST_BUCKETS + letters // 20 // POSTINGS_A_BUCKET  # a shingle is about six bytes, its prefix a third of a set
    schema = StructType().add("id", kind).add("key", "binary").add("node", "binary").add("n", "long").add("mark", "long")
    schema = schema.add("bucket", "long").add("tokens", "binary").add("owners", "binary").add("credited", "binary").add("credits", "binary")
    from pyspark.sql.pandas.types import to_arrow_schema

    held = written(rows.mapInArrow(_signatures(percent, width, buckets, to_arrow_schema(schema)), schema))
    found = held.filter("bucket is null").select("id", "key", "node", "n", "mark")
    postings = held.filter("bucket is not null").select("bucket", "tokens", "owners", "credited", "credits")
    credits = postings.groupBy("bucket").applyInArrow(_shared, "mark long, credits long").groupBy("mark").agg(F.sum("credits").alias("credits"))
    nodes = found.filter("n > 0").groupBy("node", "mark", "n").agg(F.min("key").alias("key"))
    spare = F.greatest(F.lit(1), F.floor(F.col("n") / 10))
    may = nodes if percent <= 50 else nodes.filter("n > 1")  # above a half, a set of one shingle has no partner but itself
    wanted = written(may.join(credits, "mark").filter(F.col("credits") >= spare).select("key"))
    few = wanted.distinct()
    few = F.broadcast(few) if fits_broadcast(wanted.count(), 1) else few
    texts = rows.select("text", "key").join(few, "key", "left_semi")
    raw = texts.mapInArrow(_token_sets(width), "node binary, n long, bits array<long>, tokens array<long>")
    raw = written(raw.groupBy("node").agg(*[F.first(c).alias(c) for c in ("n", "bits", "tokens")]))
    single = raw.select("node", "n", F.explode("tokens").alias("token"))
    counts = single.groupBy("token").agg(F.count("*").alias("held")).filter("held > 1")
    ranked = single.join(counts, "token").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("held", "token"))).alias("t"))
    ranked = ranked.select("node", "n", (F.col("n") - F.size("t")).alias("unique"), F.col("t.token").alias("tokens"))
    sets = written(ranked.join(raw.select("node", "bits"), "node"))
    roots = _connected(sets, percent)
    classes = found.filter("n > 0").groupBy("node").agg(F.min("id").alias("least"))
    if roots is None:
        named = classes.select("node", F.col("least").alias("component_id"))
    else:
        rooted = classes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
        named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("node", "component_id")
    out = found.select("id", "n", "node").join(named, "node", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), component.alias("component_id"))
