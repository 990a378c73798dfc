"""Exact dedup by block naming: one integer for every text, equal for equal texts and for no others.

A text is cut into blocks of a fixed number of bytes. The distinct blocks are sorted and numbered; then adjacent
numbers are paired, the distinct pairs are sorted and numbered, and so on until each text has one number.
Numbers stand for contents one to one on every level, so no two different texts of one length ever share the
last one: there is no hash to collide.

Texts that are plainly alone are not carried through the levels: where a hash of a block, its place and the
text's length occurs once, no other text can be equal. Equal hashes prove nothing and only keep a text in.

Blocks and pairs that make up more than a thousandth of their level are at most a thousand; their names are
broadcast, so that a text that a third of all rows share does not pull those rows into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import fits_broadcast, written

BLOCK_BYTES = 1024
# Keys with more than one in so many rows are joined by broadcast: there are at most as many of them.
HOT_SHARE = 1000
# The characters that do not count, and the same ones as a pattern.
SPACES = " \t\n\x0b\x0c\r"

SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t ORDER BY n DESC, doc_id)"""


def _joined(rows: DataFrame, table: DataFrame, keys: list[str], held: str, total: int) -> DataFrame:
    """``rows`` with the columns of ``table``, in which each key stands once with its number of rows ``held``."""
    hot = F.broadcast(table.filter(F.col(held) * HOT_SHARE > total))
    some = rows.join(hot, keys)
    rest = rows.join(hot.select(*keys), keys, "left_anti").join(table.filter(F.col(held) * HOT_SHARE <= total), keys)
    return some.unionByName(rest)


def _named(occurrences: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``row``, ``n_bytes``, ``at`` and ``name``: the place of the row's key among all distinct keys in order."""
    distinct = occurrences.groupBy(*keys).agg(F.count("*").alias("held")).orderBy(*keys)
    names = written(distinct.withColumn("name", F.monotonically_increasing_id()))
    return _joined(occurrences, names, keys, "held", total).select("row", "n_bytes", "at", "name")


def _blocks(texts: DataFrame, size: int) -> DataFrame:
    """A row for each block; an empty text has one empty block."""
    last = F.expr(f"greatest(n_bytes - 1, 0) div {size}")
    each = texts.select("row", "n_bytes", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("at"))
    block = F.substring("bytes", (F.col("at") * size + 1).cast("int"), F.lit(size))
    return each.select("row", "n_bytes", "at", block.alias("block"))


def _several(texts: DataFrame, size: int) -> DataFrame:
    """The texts that are not plainly alone."""
    marks = _blocks(texts, size).select("row", F.xxhash64("n_bytes", "at", "block").alias("mark"))
    owners = marks.groupBy("mark").agg(F.count("*").alias("held"), F.min("row").alias("row"))
    alone = written(owners.filter("held = 1").select("row").distinct())
    others = written(texts.select("row").join(alone, "row", "left_anti"))
    count = others.count()
    return texts.join(F.broadcast(others) if fits_broadcast(count, 1) else others, "row", "left_semi")


def identities(texts: DataFrame, size: int = BLOCK_BYTES) -> DataFrame:
    """``row``, ``n_bytes`` and ``name`` of the rows of ``texts`` (``row``, ``n_bytes``, ``bytes``) that are not plainly alone.

    ``row`` must be unique. Two rows have equal bytes just when ``n_bytes`` and ``name`` are equal.
    """
    blocks = _blocks(_several(texts, size), size)
    total, blocks_most = blocks.agg(F.count("*"), F.max("at") + 1).first()
    level = written(_named(blocks, ["block"], total))
    left = F.expr(f"greatest(n_bytes - 1, 0) div {size} + 1")
    done = level.filter(left == 1).select("row", "n_bytes", "name")
    width = 1
    while width < (blocks_most or 0):
        going = level.filter(left > width)  # their names on this level are more than one
        pair = going.groupBy("row", "n_bytes", F.expr("at div 2").alias("at")).agg(
            F.max(F.expr("if(at % 2 = 0, name, null)")).alias("first"),
            F.max(F.expr("if(at % 2 = 1, name, -1)")).alias("second"),
        )
        pairs = written(pair)
        level = written(_named(pairs, ["first", "second"], pairs.count()))
        width *= 2
        done = done.unionByName(level.filter(left <= width).select("row", "n_bytes", "name"))
    return done


def exact_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when identical without ASCII white space; ``text_sha256`` is of what is left. Of equal texts
    the row with the most characters stays, then the one with the smallest id, a null id last; of rows that agree in
    these too, any one. ``keep_id`` is its id, so null where that is null.

    A null text counts as empty, and all empty texts are equal. Repeated rows are copies like any others; other
    columns are not read, whatever their names. An empty table gives an empty table.
    """
    given = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    normal = given.select("id", F.length("text").cast("long").alias("n"), F.translate("text", SPACES, "").alias("t"))
    rows = normal.select("id", "n", F.sha2("t", 256).alias("sha"), F.octet_length("t").cast("long").alias("n_bytes"), F.col("t").cast("binary").alias("bytes"))
    held = written(rows.withColumn("row", F.monotonically_increasing_id()))
    found = identities(held.select("row", "n_bytes", "bytes"), size)
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("id").isNull().alias("none"), "id", "row")).alias("best")
    members = written(found.join(held.select("row", "id", "n"), "row"))
    classes = written(members.groupBy("n_bytes", "name").agg(F.count("*").alias("held"), best))
    classed = _joined(members.select("row", "n_bytes", "name"), classes, ["n_bytes", "name"], "held", members.count())
    out = held.select("row", "id", "sha").join(classed.select("row", "held", "best"), "row", "left")
    alone = F.col("best").isNull()
    return out.select(
        F.col("id").alias(id),
        F.when(alone, F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("held", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("best.row") == F.col("row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
