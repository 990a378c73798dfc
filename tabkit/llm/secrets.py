"""Secrets in text, and weak candidates that are reported only next to a complementary part.

Some strings are secrets by their form. Others are weak: a name given to an account, a long string of
mixed letters and digits, an address. A weak one is reported if a part of another role, weak or not, lies
in its scope, which is at most ``SCOPE`` code points away. Parts meet in an interval join: each lies in
one bin or more of its text, the bins are joined on equality, and the overlap is tested; a semi join, so
that no pairs are made. Only DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..session import written

SCOPE = 200
BIN = 1024


def _either(word: str) -> str:
    """``word`` in either case, ASCII letters only in any engine."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_GIVEN = """["']?\\x20*[:=]\\x20*["']?"""


@dataclass(frozen=True)
class Kind:
    name: str
    role: str
    pattern: str
    least: int = 0  # characters of the match
    value: str = ""  # a pattern that takes what comes before the value; then ``least`` counts the value
    must: tuple[str, ...] = ()  # patterns that the match must contain
    weak: bool = False


_WORDS = "|".join(map(_either, ("password", "passwd", "secret", "token", "api_?key")))
_NAMES = "|".join(map(_either, ("client_?id", "access_?key_?id", "user_?name", "user", "login", "account")))
# In the order in which kinds are listed at equal starts.
KINDS = (
    Kind("assign", "secret", f"(?:{_WORDS}){_GIVEN}[A-Za-z0-9+/_.=-]+", 12, f"^(?:{_WORDS}){_GIVEN}"),
    Kind("access", "id", "AKIA[A-Z0-9]+", 18),
    Kind("hex", "secret", "[0-9a-f]{16,}"),
    Kind("name", "id", f"(?:{_NAMES}){_GIVEN}[A-Za-z0-9._@-]{{4,}}", weak=True),
    Kind("key", "secret", "[A-Za-z0-9+/]{32,}", must=("[0-9]", "[A-Z]", "[a-z]"), weak=True),
    Kind("endpoint", "endpoint", "[a-z][a-z0-9+.-]{0,15}://[^\\x00-\\x20\"'<>]+|[0-9]{1,3}(?:\\.[0-9]{1,3}){3}(?::[0-9]+)?", weak=True),
)
# Matches of a text that are placed one after the other.
RUN = 256
# By the role of a weak part: the roles that must all be in its scope.
NEEDS = {"id": ("secret",), "secret": ("id",), "endpoint": ("id", "secret")}


def _matches(text: Column, kind: Kind, rank: int) -> Column:
    """(start, rank, kind, end) of the leftmost matches that do not overlap, in code points, failing ones left out.

    The text between the matches and the matches themselves give the places.
    """
    between, found = F.split(text, kind.pattern, -1), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    empty = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.length(pair["between"])
        match = pair["match"]
        end = begin + F.length(match)
        held = F.length(F.regexp_replace(match, kind.value, "")) if kind.value else F.length(match)
        good = held >= kind.least
        for pattern in kind.must:
            good = good & match.rlike(pattern)
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), F.lit(kind.name).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(good, F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"))

    def length(pairs: Column) -> Column:
        return F.aggregate(pairs, F.lit(0).cast("bigint"), lambda a, p: a + F.length(p["between"]) + F.length(p["match"]))

    def placed(runs: Column) -> Column:
        """Each run of pairs with the place in the text where it begins."""
        lengths = F.transform(runs, length)
        return F.flatten(F.transform(F.array(lengths), lambda n: F.transform(
            runs, lambda run, i: F.struct(run.alias("run"), F.aggregate(F.slice(n, F.lit(1), i), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("at"))
        )))

    pairs = F.arrays_zip(F.slice(between, F.lit(1), F.size(found)).alias("between"), found.alias("match"))
    # An appended array is copied, so no array grows beyond a run.
    cut = lambda p: F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / RUN).cast("int")), lambda i: F.slice(p, i * RUN + 1, RUN))
    runs = F.flatten(F.transform(F.array(pairs), cut))
    spans = F.flatten(F.transform(F.flatten(F.transform(F.array(runs), placed)), lambda x: F.aggregate(
        x["run"], F.struct(x["at"].alias("at"), empty.alias("out")), step, lambda s: s["out"]
    )))
    return F.when(text.rlike(kind.pattern), spans).otherwise(empty)


def _text_of(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _near(weak: DataFrame, parts: DataFrame, role: str) -> DataFrame:
    """The weak parts with a part of ``role`` in their scope: a semi join of intervals on shared bins."""
    bins = F.sequence(F.floor((F.col("start") - SCOPE) / BIN), F.floor((F.col("end") + SCOPE) / BIN))
    left = weak.withColumn("bin", F.explode(bins))
    right = parts.filter(F.col("role") == role).select(F.col("key").alias("k"), F.col("start").alias("s"), F.col("end").alias("e"))
    right = right.withColumn("b", F.explode(F.sequence(F.floor(F.col("s") / BIN), F.floor(F.col("e") / BIN))))
    close = (F.col("s") < F.col("end") + SCOPE) & (F.col("start") < F.col("e") + SCOPE)
    met = left.join(right, (F.col("key") == F.col("k")) & (F.col("bin") == F.col("b")) & close, "left_semi")
    return met.drop("bin").distinct()


def secret_spans(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``base`` and ``spans`` of every row: arrays of (start, rank, kind, end), by start, then kind.

    ``base`` has what is a secret by its form, ``spans`` also the weak parts that are linked. A weak part that
    overlaps a base span is not looked at. Places are code points, ends exclusive. A null text is an empty
    one without spans. Rows come out as often as they come in; equal texts have equal spans. Other columns
    are not read, whatever their names. The text is read once; what is found in it goes to the checkpoint
    folder, and only the parts of texts with a weak one are shuffled.
    """
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    of = {kind.name: _matches(F.col("text"), kind, rank) for rank, kind in enumerate(KINDS)}
    base = F.array_sort(F.concat(*[of[k.name] for k in KINDS if not k.weak]))
    weak = F.concat(*[of[k.name] for k in KINDS if k.weak])
    read = rows.select("id", F.unhex(F.md5("text")).alias("key"), base.alias("base"), weak.alias("weak"))
    clear = F.filter("weak", lambda w: ~F.exists("base", lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))
    read = written(read.select("id", "key", "base", F.when(F.size("weak") > 0, clear).otherwise(F.col("weak")).alias("weak")))

    role = F.create_map(*[F.lit(x) for k in KINDS for x in (k.name, k.role)])
    parts = read.filter(F.size("weak") > 0).select("key", F.explode(F.concat("base", "weak")).alias("part")).select("key", "part.*").distinct()
    parts = written(parts.withColumn("role", role[F.col("kind")]))
    names = [k.name for k in KINDS if k.weak]
    linked = None
    for own, needs in NEEDS.items():
        held = parts.filter((F.col("role") == own) & F.col("kind").isin(names))
        for need in needs:
            held = _near(held, parts, need)
        linked = held if linked is None else linked.unionByName(held)
    added = linked.groupBy("key").agg(F.collect_list(F.struct("start", "rank", "kind", "end")).alias("added"))
    spans = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "added")))
    return read.select("id", "key", "base").join(added, "key", "left").select(F.col("id").alias(id), "base", spans.alias("spans"))


def secret_report(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts by kind, a digest of the base spans and all spans as text, of every row."""
    found = secret_spans(docs, id, text)

    def count(name: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    digest = F.sha2(_text_of(F.col("base")), 256)
    return found.select(id, *[count(k.name) for k in KINDS if not k.weak], digest.alias("base_sha256"), _text_of(F.col("spans")).alias("spans"))


def _sql() -> str:
    """DuckDB SQL for ``secret_report(documents)``."""
    quoted = lambda s: s.replace("'", "''")
    steps, lists = [], []
    for rank, kind in enumerate(KINDS):
        p, m = quoted(kind.pattern), "m[i]"
        good = f"length(regexp_replace({m}, '{quoted(kind.value)}', '')) >= {kind.least}" if kind.value else f"length({m}) >= {kind.least}"
        good += "".join(f" AND regexp_matches({m}, '{quoted(x)}')" for x in kind.must)
        start = "coalesce(list_sum(list_transform(b[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0)"
        steps.append(
            f"{kind.name}_m AS (SELECT row, string_split_regex(text, '{p}') AS b, regexp_extract_all(text, '{p}') AS m FROM texts), "
            f"{kind.name}_s AS (SELECT row, CAST({start} AS BIGINT) AS start, {rank} AS rank, '{kind.name}' AS kind, '{kind.role}' AS role, {str(kind.weak).lower()} AS weak, length({m}) AS size "
            f"FROM (SELECT row, b, m, unnest(range(1, len(m) + 1)) AS i FROM {kind.name}_m) WHERE {good})"
        )
        lists.append(f"SELECT * FROM {kind.name}_s")
    near = lambda need: f"EXISTS (SELECT 1 FROM parts p WHERE p.row = w.row AND p.role = '{need}' AND p.start < w.stop + {SCOPE} AND w.start < p.stop + {SCOPE})"
    linked = " OR ".join(f"(w.role = '{own}' AND " + " AND ".join(map(near, needs)) + ")" for own, needs in NEEDS.items())
    text = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank)"
    counts = ", ".join(f"CAST(coalesce(n_{k.name}, 0) AS BIGINT) AS n_{k.name}" for k in KINDS if not k.weak)
    sums = ", ".join(f"count(*) FILTER (kind = '{k.name}') AS n_{k.name}" for k in KINDS if not k.weak)
    return f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
{", ".join(steps)},
spans AS (SELECT *, start + size AS stop FROM ({" UNION ALL ".join(lists)})),
parts AS (
    SELECT * FROM spans s WHERE NOT weak OR NOT EXISTS (
        SELECT 1 FROM spans b WHERE b.row = s.row AND NOT b.weak AND b.start < s.stop AND s.start < b.stop)
),
kept AS (SELECT * FROM parts w WHERE NOT weak OR {linked}),
base AS (SELECT row, {text} AS base, {sums} FROM kept WHERE NOT weak GROUP BY row),
whole AS (SELECT row, {text} AS spans FROM kept GROUP BY row)
SELECT doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN base USING (row) LEFT JOIN whole USING (row)
"""


SQL = _sql()
