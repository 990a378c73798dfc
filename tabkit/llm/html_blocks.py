"""Main text of HTML pages: flat text blocks, classified by a decision tree.

A page becomes a flat list of text blocks. Each is described by its number of words and its link density and by
those of the two blocks before and after it. A tree is trained on these numbers of the blocks of
``labelled_pages``. Where blocks of one leaf differ in their label, numbers do not tell them apart, and a second
tree decides there, which also knows what encloses a block: an article, page furniture (menus, footers, forms)
or an element whose name or class speaks of adverts, notices or comments.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .labelled_pages import MARK, PAGES

# Places of the blocks whose words and link density describe a block.
AROUND = (0, -1, 1, -2, 2)
NUMBERS = tuple(f"{name}{k:+d}" for k in AROUND for name in ("words", "density"))
# Inside an article 1, outside on a page that has one -1, else 0; then 0 or 1 for furniture and for a telling name.
MARKUP = ("place", "furniture", "hint")
DEPTH = 5
# A leaf of the first tree decides if all its blocks agree and it has so many.
LEAST_BLOCKS = 12

# Elements by their part in a page.
RAW = ("script", "style", "noscript", "template", "title", "textarea", "iframe", "svg", "math", "object", "canvas")
FURNITURE = ("nav", "footer", "aside", "form", "header", "menu", "dialog", "button", "select", "label")
ARTICLE = ("article", "main")
INLINE = (
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr"
).split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
# Words of a class, id or role that speak of something other than main text.
HINTS = (
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header "
    "login masthead menu modal nav navbar navigation newsletter notice pagination popup promo promoted recommended related "
    "replies reply share sharing sidebar signup social sponsor sponsored subscribe teaser widget"
).split()

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:"[^"]*"|'[^']*'|[^'"<>])*)>|<[!?/a-zA-Z][^<>]*>""", re.DOTALL)
# A slash that closes an element at once, and not the end of an unquoted value.
_CLOSED = re.compile(r"""(?:\A|[\s"'])/\Z""")
# Where a page breaks off inside a tag.
_CUT = re.compile(r"<(?:[!?/a-zA-Z]|\Z)")
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_PARTS = re.compile("[A-Za-z]+")


def blocks(html: str) -> list[tuple[str, int, float, int, int, int]]:
    """The text blocks in page order: text, words, link density, and 0 or 1 for article, furniture, hint."""
    out: list[tuple] = []
    text: list[str] = []
    linked: list[str] = []
    open_: list[tuple[str, int]] = []  # element and what it adds: 1 article, 2 furniture, 4 hint, 8 link
    held = {1: 0, 2: 0, 4: 0, 8: 0}
    names = Counter()  # how many elements of a name are open, so that a stray end tag need not look for one

    def flush() -> None:
        joined = " ".join(unescape("".join(text)).split())
        if joined:
            words, links = joined.count(" ") + 1, len(unescape("".join(linked)).split())
            out.append((joined, words, min(1.0, links / words), int(held[1] > 0), int(held[2] > 0), int(held[4] > 0)))
        text.clear()
        linked.clear()

    def add(part: str) -> None:
        text.append(part)
        if held[8]:
            linked.append(part)

    def count(flags: int, by: int) -> None:
        for flag in held:
            if flags & flag:
                held[flag] += by

    def close() -> str:
        gone, flags = open_.pop()
        names[gone] -= 1
        count(flags, -1)
        return gone

    at, n = 0, len(html)
    while at < n:
        match = _TAG.search(html, at)
        if match is None:
            add(_CUT.split(html[at:], maxsplit=1)[0])
            break
        if match.start() > at:
            add(html[at : match.start()])
        at = match.end()
        if match["name"] is None:
            continue
        name = match["name"].lower()
        if name not in INLINE:
            flush()
        elif name == "br":
            add(" ")
            if linked:
                linked.append(" ")
        if match["close"]:
            while names[name]:
                if close() == name:
                    break
            continue
        closed = _CLOSED.search(match["rest"])
        if name in RAW:
            if not closed:
                end = re.compile(f"</{name}[^>]*>", re.IGNORECASE).search(html, at)
                at = end.end() if end else n
            continue
        if name in VOID or closed:
            continue
        flags = (1 if name in ARTICLE else 0) | (2 if name in FURNITURE else 0) | (8 if name == "a" else 0)
        if match["rest"] and name not in ("html", "body"):
            named = {w.lower() for m in _NAMED.finditer(match["rest"]) for w in _PARTS.findall(m[1])}
            flags |= 4 if named.intersection(HINTS) and name not in ARTICLE else 0
        if name in ("p", "li", "b", "i"):  # a new one ends the last one of its kind, if nothing else is open inside
            if open_ and open_[-1][0] == name:
                close()
        open_.append((name, flags))
        names[name] += 1
        count(flags, 1)
    flush()
    return out


def features(found: list[tuple]) -> list[tuple[float, ...]]:
    """Numbers and markup of every block, in the order of ``NUMBERS`` and ``MARKUP``; nothing is around the page."""
    nothing = [(0, 0.0)] * max(AROUND)
    sizes = nothing + [(b[1], b[2]) for b in found] + nothing
    outside = -1 if any(b[3] for b in found) else 0
    at = [k + len(nothing) for k in range(len(found))]
    return [(*[x for near in AROUND for x in sizes[k + near]], 1 if b[3] else outside, *b[4:]) for k, b in zip(at, found)]


def labelled(pages=PAGES) -> list[tuple[tuple[float, ...], int]]:
    """Features and label (1 for main text) of every block of ``pages``; the mark is no word of its own."""
    return [(row, int(b[0].startswith(MARK))) for found in map(blocks, pages) for b, row in zip(found, features(found))]


def _grown(spark: SparkSession, rows, depth: int, least: int, mixed=None) -> tuple | int:
    """A tree as nested (feature, threshold, left, right).

    A leaf is the label of its blocks, 0 or 1; where they differ it is ``mixed``, or without that the commoner label.
    """
    table = spark.createDataFrame([(Vectors.dense(row), float(label)) for row, label in rows], ["features", "label"])
    model = DecisionTreeRegressor(maxDepth=depth, minInstancesPerNode=least, maxBins=256, seed=1).fit(table.coalesce(1))

    def taken(node) -> tuple | int:
        if node.getClass().getSimpleName() == "LeafNode":
            share = node.prediction()
            return int(share > 0.5) if mixed is None or share in (0.0, 1.0) else mixed
        split = node.split()
        return (split.featureIndex(), split.threshold(), taken(node.leftChild()), taken(node.rightChild()))

    return taken(model._call_java("rootNode"))


def train(spark: SparkSession, pages=PAGES, depth: int = DEPTH, markup: bool = True) -> tuple | int:
    """A tree over words and link density; its mixed leaves ask the markup, and mixed leaves of that the numbers more finely.

    Without ``markup`` mixed leaves go straight to the finer tree of numbers.
    """
    rows = labelled(pages)
    numbers = [(row[: len(NUMBERS)], label) for row, label in rows]
    tree = _grown(spark, numbers, depth, 1)
    if markup:
        tree = _grown(spark, [((0.0,) * len(NUMBERS) + row[len(NUMBERS) :], label) for row, label in rows], len(MARKUP), 1, tree)
    return _grown(spark, numbers, depth, LEAST_BLOCKS, tree)


def classify(tree, row: tuple[float, ...]) -> int:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def main_text(html: str, tree) -> str:
    found = blocks(html)
    return "\n".join([b[0] for b, row in zip(found, features(found)) if classify(tree, row)])


def _extracted(tree, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py() or "", tree) for h in batch["html"]]
            yield pa.RecordBatch.from_pydict({"id": batch["id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]}, schema=schema)

    return run


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", tree=None) -> DataFrame:
    """``id``, ``url``, ``text`` and ``n_chars`` of every page, from the whole html.

    ``text`` joins the blocks that the tree takes for main text with one \\n; white space in a block becomes one
    space, character references are decoded. A null or empty html, or one without main text, gives an empty text.
    Broken markup is read as far as it goes; a tag cut off by the end of the page is no text. One row comes out per row, repeated or not; other columns are
    not read, whatever their names. Nothing is shuffled.
    """
    tree = train(pages.sparkSession) if tree is None else tree
    schema = StructType().add("id", pages.schema[id].dataType).add("url", pages.schema[url].dataType).add("text", "string").add("n_chars", "long")
    rows = pages.select(F.col(id).alias("id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return rows.mapInArrow(_extracted(tree, to_arrow_schema(schema)), schema).withColumnsRenamed({"id": id, "url": url})
