"""Lines that a site repeats: dropped where too many of its pages hold them.

For each host, the pages that contain a line are divided by all pages of the host. Copies of a page count as
one, else a text that is copied often would itself be boilerplate. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import fits_broadcast, written
from .components import components

RATIO = 0.1
# A line must be on this many pages of its host, so that a host of few pages keeps its text.
LEAST_PAGES = 3
# A page's signatures: each is the least KEPT of the shingle hashes dealt to it.
SIGNATURES = 8
KEPT = 6
SHINGLE_WORDS = 3
# The least hashes of a page that the signatures are taken from.
SKETCH = 4 * SIGNATURES * KEPT
# A signature groups pages if more than this share of ``ratio`` of the host's pages have it.
GROUP_SHARE = 0.1


def _lines(text: str) -> Column:
    return F.split(F.col(text), "\n", -1)


def _stripped(line: Column) -> Column:
    return F.trim(line)


def _signatures(text: str) -> Column:
    """Hashes that most near copies of a text share; none for a text without words."""
    words = F.filter(F.split(F.col(text), r"\s+"), lambda x: x != "")
    hashes = F.transform(words, lambda x: F.xxhash64(x))
    # The array is an argument, so that it is made once a row and not once a word.
    shingled = lambda h: F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, SHINGLE_WORDS)]))
    least = F.flatten(F.transform(F.array(hashes), lambda h: F.slice(F.sort_array(F.array_distinct(shingled(h))), 1, SKETCH)))
    dealt = lambda s, k: F.filter(s, lambda x: F.pmod(F.xxhash64(x), F.lit(SIGNATURES)) == k)
    each = lambda s: F.array(*[F.xxhash64(F.lit(k), F.slice(dealt(s, k), 1, KEPT)) for k in range(SIGNATURES)])
    return F.flatten(F.transform(F.filter(F.array(least), lambda s: F.size(s) > 0), each))


def _by_host(df: DataFrame, listed: Column, name: str) -> tuple[DataFrame, bool]:
    """``listed`` collected a host, and whether the lists are small enough to broadcast."""
    found = written(df.groupBy("__dedup_host").agg(F.sort_array(F.collect_list(listed)).alias(name)))
    hosts, held = found.agg(F.count("*"), F.coalesce(F.sum(F.size(name)), F.lit(0))).first()
    return found, fits_broadcast(hosts + held, 2)


def _near_pages(rows: DataFrame, ratio: float) -> DataFrame:
    """``rows`` (host, page, marks, lines) with one number for the pages of a host that are near copies.

    Pages that have a signature in common are one group, if the signature is on enough of the host's pages;
    groups that a page has signatures of are one, along chains of any length. Fewer than ``SIGNATURES / (ratio * GROUP_SHARE)``
    signatures remain for a host.
    """
    host = F.col("host").alias("__dedup_host")
    pages = rows.groupBy(host).agg((F.count("*") * ratio * GROUP_SHARE).alias("__dedup_least"))
    marked = rows.select(host, F.explode("marks").alias("mark")).groupBy("__dedup_host", "mark").agg(F.count("*").alias("held"))
    marked = marked.filter("held > 1").withColumnRenamed("__dedup_host", "host")
    common = marked.join(pages, F.col("host").eqNullSafe(F.col("__dedup_host"))).filter("held > __dedup_least")

    def joined(lists: DataFrame, small: bool) -> DataFrame:
        return rows.join(F.broadcast(lists) if small else lists, F.col("host").eqNullSafe(F.col("__dedup_host")), "left")

    found = joined(*_by_host(common.select("__dedup_host", "mark"), F.col("mark"), "__dedup_marks"))
    own = found.select(host, F.array_intersect("marks", "__dedup_marks").alias("own")).filter(F.size("own") > 0)
    ties = own.select("__dedup_host", F.explode("own").alias("mark"), F.array_min("own").alias("least")).distinct()
    node = lambda mark: F.xxhash64("__dedup_host", mark)
    ties = written(ties.select("__dedup_host", "mark", node("mark").alias("node"), node("least").alias("other")))
    roots = components(ties.select(F.col("node").alias("a"), F.col("other").alias("b")))
    linked = ties.select("__dedup_host", "mark", "node").distinct().join(roots, "node").select("__dedup_host", "mark", F.col("root").alias("least"))
    found = joined(*_by_host(linked, F.struct("mark", "least"), "__dedup_marks"))
    mine = F.filter("__dedup_marks", lambda x: F.array_contains("marks", x["mark"]))
    group = F.array_min(F.transform(mine, lambda x: x["least"]))
    return found.select("host", F.coalesce(group, F.col("page")).alias("page"), "lines")


def line_dedup(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
    near: bool = False,
) -> DataFrame:
    """``docs`` with the text cleaned, and ``n_lines`` and ``n_dropped`` added.

    A text's lines are split at \\n and compared without spaces at their ends; a line of spaces alone is kept and
    not counted. A line is boilerplate for a host if it is on at least ``least_pages`` of the host's pages and
    on more than ``ratio`` of them; a page counts a line once however often it repeats it, and rows of a host
    with equal texts are one page. All its occurrences are dropped from the host's pages, and the other lines joined again as they were.

    With ``near``, pages of a host that are near copies are one page too, in both counts, else a text that is
    copied with small changes would lose the lines that its copies share. Near copies are told by signatures of
    their word shingles (see ``_near_pages``), so a page of which more than about four fifths are
    boilerplate counts as a near copy of others like it.

    A null text stays null, an empty one empty, with 0 dropped lines; a text of boilerplate alone becomes empty.
    A null host is a host of its own. Repeated rows stay. All columns of ``docs`` stay
    under their names, except that columns named ``n_lines`` and ``n_dropped`` are replaced. Empty in, empty out.

    Counts are made of line hashes after partial aggregation. At most 1 / ``ratio`` times the mean number of
    lines a page remain for a host, and the table of hosts is broadcast only when its counted size allows.
    """
    rows = docs.select(F.col(host).alias("host"), F.xxhash64(text).alias("page"), F.col(text).alias("text"))
    filled = F.filter(F.transform(_lines("text"), _stripped), lambda x: x != "")
    hashed = F.array_distinct(F.transform(filled, lambda x: F.xxhash64(x)))
    if near:
        marks = F.coalesce(_signatures("text"), F.array().cast("array<bigint>"))
        rows = _near_pages(written(rows.select("host", "page", marks.alias("marks"), hashed.alias("lines")).dropDuplicates(["host", "page"])), ratio)
    else:
        rows = rows.select("host", "page", hashed.alias("lines"))
    pages = rows.select("host", "page").distinct().groupBy(F.col("host").alias("__dedup_host")).agg(F.count("*").alias("pages"))
    lines = rows.select("host", "page", F.explode("lines").alias("line")).distinct().groupBy("host", "line").agg(F.count("*").alias("held"))
    often = lines.filter(F.col("held") >= least_pages)
    often = often.join(pages, F.col("host").eqNullSafe(F.col("__dedup_host"))).filter(F.col("held") > F.col("pages") * ratio)
    boilerplate = written(often.groupBy("__dedup_host").agg(F.sort_array(F.collect_list("line")).alias("__dedup_lines")))
    hosts, held = boilerplate.agg(F.count("*"), F.coalesce(F.sum(F.size("__dedup_lines")), F.lit(0))).first()
    boilerplate = F.broadcast(boilerplate) if fits_broadcast(hosts + held, 1) else boilerplate
    found = docs.drop("n_lines", "n_dropped").join(boilerplate, F.col(host).eqNullSafe(F.col("__dedup_host")), "left")
    drop = lambda x: (_stripped(x) != "") & F.array_contains("__dedup_lines", F.xxhash64(_stripped(x)))
    # array_contains in the order of the hashes; a page without a boilerplate line is not taken apart.
    hit = F.col("__dedup_lines").isNotNull() & F.col(text).isNotNull()
    kept = F.when(hit, F.filter(_lines(text), lambda x: ~drop(x))).otherwise(_lines(text))
    split = found.withColumn("__dedup_all", F.coalesce(F.size(_lines(text)), F.lit(0))).withColumn("__dedup_kept", kept)
    size = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.col("__dedup_all"))
    dropped = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.col("__dedup_all") - F.size("__dedup_kept"))
    cleaned = F.when(dropped > 0, F.array_join("__dedup_kept", "\n")).otherwise(F.col(text))
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return split.select(
        *[cleaned.alias(text) if c == text else F.col(f"`{c}`") for c in names],
        size.cast("long").alias("n_lines"),
        dropped.cast("long").alias("n_dropped"),
    )


#: DuckDB SQL for ``line_dedup(documents)`` with the columns that the query returns.
SQL = f"""
WITH split AS (
    SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents
), distinct_pages AS (
    SELECT DISTINCT source, text FROM documents
), pages AS (
    SELECT source, count(*) AS pages FROM distinct_pages GROUP BY source
), held AS (
    SELECT source, line, count(*) AS held FROM (
        SELECT source, unnest(list_distinct(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> ''))) AS line FROM distinct_pages
    ) GROUP BY source, line
), boilerplate AS (
    SELECT held.source, list(line) AS dropped FROM held JOIN pages ON held.source IS NOT DISTINCT FROM pages.source
    WHERE held >= {LEAST_PAGES} AND held > pages * CAST({RATIO} AS DOUBLE) GROUP BY held.source
), kept AS (
    SELECT split.*, CASE WHEN dropped IS NULL THEN lines
        ELSE list_filter(lines, lambda x: NOT list_contains(dropped, trim(x, ' '))) END AS kept
    FROM split LEFT JOIN boilerplate ON split.source IS NOT DISTINCT FROM boilerplate.source
)
SELECT doc_id, source,
    CASE WHEN len(kept) < len(lines) THEN coalesce(array_to_string(kept, chr(10)), '') ELSE text END AS text,
    CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines,
    CAST(coalesce(len(lines) - len(kept), 0) AS BIGINT) AS n_dropped
FROM kept
"""
