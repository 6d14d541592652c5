"""Personal data by fixed patterns and by bootstrapped contexts, in DataFrame functions only.

Base spans (e-mail addresses, IP addresses, card numbers, phone numbers) are seeds.  The one or
two words before a span are its context, a lexical pattern; other tokens that look like an
identifier stand in contexts too.  Patterns and the values found in them make a graph, whose
edges are distinct, so that copies of a text count once.  Rounds of Spark jobs score it: a
pattern is as good as the share of its different values that are believed to be of a kind, a
value is believed as its best pattern, a seed fully for its kind and not at all for the others.
Patterns with enough believed values and a high score then give unseen identifiers of the kind.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import checked_broadcast, whole_text
from estrato.session import written

# The kinds in the order of the result, and what their spans look like.  Each
# pattern matches the leftmost longest spans of its kind, and looks at a character only a few
# times: it begins at the first character of a run (or at the end of the span before) and
# doesn't give back what it has taken.
KINDS = ("email", "ip", "card", "phone")
LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this has no span of the kind.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
#: A token with a digit or an at sign, or numbers parted by single spaces.
NUMBER = r"[()+./-]*+[0-9][0-9()+./-]*+"
CANDIDATE = rf"(?<!\S)(?:{NUMBER}(?: {NUMBER})++(?=[\s,;:!?]|$)|[^\s0-9@(\[]*+(?:[0-9@]|[(\[]at[)\]])\S*+)"
AT = r"@|[(\[]at[)\]]"

#: Code points before a span in which its context is looked for.
REACH = 64
#: Different believed values that a pattern needs, and the score from which it finds others.
SUPPORT = 5
TRUST = 0.8
SMOOTH = 0.5
ROUNDS = 4
#: Numbers summed up at a time.
CHUNK = 64


def prefix_sums(items: str) -> Column:
    """For each number of an array column the sum of those before it."""
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(items) - 1) / CHUNK).cast("int")),
        lambda c: F.aggregate(F.slice(items, c * CHUNK + 1, CHUNK), F.lit(0), lambda a, x: a + x),
    )

    def one(_, i):
        chunk = F.floor(i / CHUNK).cast("int")
        here = F.aggregate(F.slice(items, chunk * CHUNK + 1, i % CHUNK), F.lit(0), lambda a, x: a + x)
        return F.aggregate(F.slice(chunks, 1, chunk), F.lit(0), lambda a, x: a + x) + here

    return F.when(F.size(items) > 0, F.transform(items, one)).otherwise(F.array().cast("array<int>"))


def with_spans(rows: DataFrame, patterns: dict[str, str], text: str = "_text") -> DataFrame:
    """``rows`` and for each name an array of the matches of its pattern in ``text``: (start, end,
    value) in code points, the end exclusive, in order.

    The gaps between matches come from a split by the same pattern, which gives the positions.
    """
    names, kept = list(patterns), [F.col(f"`{c}`") for c in rows.columns]
    none = F.array().cast("array<string>")

    def found(name):
        got = F.regexp_extract_all(text, F.lit(patterns[name]), 0)
        return F.when(F.instr(text, NEEDS[name]) > 0, got).otherwise(none) if NEEDS.get(name) else got

    def gaps(name):
        return F.when(F.size(name) > 0, F.split(text, patterns[name], -1)).otherwise(none)

    def lengths(name):
        return F.zip_with(
            F.slice(F.concat(f"_gaps_{name}", F.array(F.lit(""))), 1, F.size(name)), name,
            lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("long")),
        )

    def spans(name):
        at = F.arrays_zip(F.col(f"_before_{name}").alias("before"), F.col(f"_long_{name}").alias("n"), F.col(name).alias("value"))
        start = lambda x: x["before"] + x["n"]["gap"]
        return F.transform(at, lambda x: F.struct(
            start(x).alias("start"), (start(x) + x["n"]["long"]).alias("end"), x["value"].alias("value"),
        ))

    rows = rows.select(*kept, *[found(n).alias(n) for n in names])
    rows = rows.select("*", *[gaps(n).alias(f"_gaps_{n}") for n in names])
    rows = rows.select(*kept, *names, *[lengths(n).alias(f"_long_{n}") for n in names])
    rows = rows.select("*", *[F.transform(f"_long_{n}", lambda x: x["gap"] + x["long"]).alias(f"_sum_{n}") for n in names])
    rows = rows.select(*kept, *names, *[f"_long_{n}" for n in names], *[prefix_sums(f"_sum_{n}").alias(f"_before_{n}") for n in names])
    return rows.select(*kept, *[spans(n).alias(n) for n in names])


def is_valid(kind: str, value: Column) -> Column:
    """Whether a match of the kind's pattern is kept."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike("^([0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        figure = lambda i: F.substring(F.reverse(digits), i, 1).cast("int")
        twice = lambda i: F.when(i % 2 == 0, figure(i) * 2 - F.when(figure(i) > 4, 9).otherwise(0)).otherwise(figure(i))
        luhn = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + twice(i)) % 10 == 0
        return F.when(F.length(digits).between(13, 19), luhn).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _trimmed(span: Column) -> Column:
    """A candidate without the quotes, brackets and signs around it."""
    inner = F.regexp_replace(span["value"], r"""^["'<\[{]+""", "")
    start = span["start"] + F.length(span["value"]) - F.length(inner)
    inner = F.regexp_replace(inner, r"""[>"'\]},;:!?.]+$""", "")
    return F.struct(start.alias("start"), (start + F.length(inner)).alias("end"), inner.alias("value"))


def _context(span: Column, text: str = "_text") -> Column:
    """The words before a span, at most two, in lower case and with 0 for each digit."""
    first = F.greatest(span["start"] - (REACH - 1), F.lit(1))
    before = F.lower(F.substring(F.col(text), first, span["start"] - first + 1))
    words = F.split(F.trim(F.regexp_replace(F.regexp_replace(before, "[0-9]", "0"), r"\s+", " ")), " ")
    return F.slice(words, F.greatest(F.size(words) - 1, F.lit(1)), 2)


def spotted(docs: DataFrame) -> DataFrame:
    """(row, doc_id, base, places): the base spans (kind, start, end) of each row in order, and all
    places that the graph is made of: base spans (with a kind) and candidates (without)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("_text"))
    rows = with_spans(rows, PATTERNS | {"candidate": CANDIDATE})

    def valid(kind):
        return F.filter(kind, lambda s: is_valid(kind, s["value"]))

    def of_kind(k):
        return lambda s: F.struct(F.lit(k).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lower(s["value"]).alias("value"))

    each = [F.transform(valid(kind), of_kind(k)) for k, kind in enumerate(KINDS, 1)]
    rows = rows.select("doc_id", "_text", F.concat(*each).alias("base"), F.transform("candidate", _trimmed).alias("candidate"))
    free = F.filter("candidate", lambda c: (c["end"] > c["start"]) & ~F.exists(
        "base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])
    ))
    rows = rows.select("doc_id", "_text", "base", F.concat("base", F.transform(free, of_kind(0))).alias("places"))
    places = F.transform("places", lambda p: F.struct(
        p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end"), p["value"].alias("value"), _context(p).alias("words"),
    ))
    base = F.transform("base", lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["end"].alias("end")))
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", base.alias("base"), places.alias("places"))


def _occurrences(found: DataFrame) -> DataFrame:
    """(row, kind, start, end, value, pattern): a row for each place and pattern it stands in, the
    last word before it and the last two."""
    p = found.select("row", F.explode("places").alias("p")).select("row", "p.*")
    last = F.element_at("words", -1)
    patterns = F.array_distinct(F.array(last, F.concat_ws(" ", "words")))
    return p.select("row", "kind", "start", "end", "value", F.explode(patterns).alias("pattern")).where("pattern != ''")


def _fits(kind: int) -> Column:
    """Whether a value may be an unseen identifier of the kind."""
    is_mail = F.col("value").rlike(AT)
    if KINDS[kind - 1] == "email":
        return is_mail
    return ~is_mail & (F.length(F.regexp_replace("value", "[^0-9]", "")) >= 4)


def _believed() -> list[str]:
    return [f"b{k}" for k in range(1, len(KINDS) + 1)]


def pattern_scores(edges: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(pattern, b1, ...): the share of the pattern's values believed of each kind, 0 with too few."""
    sums = edges.groupBy("pattern").agg(F.count("*").alias("n"), *[F.sum(b).alias(b) for b in _believed()])
    score = lambda b: F.when(F.col(b) >= support, F.col(b) / (F.col("n") + SMOOTH)).otherwise(0.0).alias(b)
    scored = sums.select("pattern", *[score(b) for b in _believed()])
    return scored.where(F.greatest(*_believed()) > 0)


def trusted_patterns(occurrences: DataFrame, support: int = SUPPORT, trust: float = TRUST, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, kind): the patterns that reach ``trust`` after at most ``rounds`` rounds.

    Scores only rise from round to round, so the rounds end when their sum stays the same.
    A base span's value is believed for its kind alone, also where it stands as a candidate.
    """
    seeds = occurrences.where("kind > 0").groupBy("value").agg(*[
        F.max((F.col("kind") == k).cast("double")).alias(f"s{k}") for k in range(1, len(KINDS) + 1)
    ])
    edges = occurrences.select("pattern", "value").distinct()
    many = edges.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= support).select("pattern")
    edges = edges.join(many, "pattern").join(seeds, "value", "left")
    edges = edges.select("pattern", "value", *[F.col(f"s{k}") for k in range(1, len(KINDS) + 1)])
    edges = written(edges, "pattern-edges")
    start = [F.coalesce(f"s{k}", F.lit(0.0)).alias(f"b{k}") for k in range(1, len(KINDS) + 1)]
    believed, before = edges.select("pattern", *start), -1.0
    best = F.greatest(*_believed())
    for _ in range(rounds):
        scored = written(pattern_scores(believed, support), "pattern-scores")
        total = scored.agg(F.sum(best)).first()[0] or 0.0
        if total - before < 1e-9:
            break
        before = total
        values = edges.where("s1 is null").join(scored, "pattern").groupBy("value").agg(*[
            F.max(F.when(_fits(k), F.col(f"b{k}")).otherwise(0.0)).alias(f"b{k}") for k in range(1, len(KINDS) + 1)
        ])
        more = [F.coalesce(f"s{k}", f"b{k}", F.lit(0.0)).alias(f"b{k}") for k in range(1, len(KINDS) + 1)]
        believed = edges.join(values, "value", "left").select("pattern", *more)
    kind = F.coalesce(*[F.when(F.col(f"b{k}") == best, F.lit(k)) for k in range(1, len(KINDS) + 1)])
    return written(scored.where(best >= trust).select("pattern", kind.alias("kind"), best.alias("score")), "trusted-patterns")


@dataclass(frozen=True)
class Found:
    """Rows of the input with base and added spans, and the patterns that gave the latter."""

    rows: DataFrame
    patterns: DataFrame


def identifiers(docs: DataFrame, support: int = SUPPORT, trust: float = TRUST, rounds: int = ROUNDS) -> Found:
    """``rows``: (doc_id, base, added) with spans (kind, start, end) by kind as in ``KINDS``, then start.

    Null and empty texts have no spans; every row has its own, repeated ones equal spans; a null id
    is kept; long texts are read whole; a place that patterns of several kinds trust gets the kind
    of the best score, of equal ones the first; columns other than doc_id and text are not read;
    an empty table gives an empty one.
    """
    found = written(spotted(docs), "spotted")
    occurrences = written(_occurrences(found), "occurrences")
    patterns = trusted_patterns(occurrences, support, trust, rounds)
    kinds = checked_broadcast(patterns.select("pattern", F.col("kind").alias("of"), "score"), 128)
    new = occurrences.where("kind = 0").join(kinds, "pattern")
    fits = F.coalesce(*[F.when(F.col("of") == k, _fits(k)) for k in range(1, len(KINDS) + 1)])
    best = F.max(F.struct("score", -F.col("of"))).alias("best")
    new = new.where(fits).groupBy("row", "start", "end").agg(best)
    span = F.struct((-F.col("best.col2")).alias("kind"), "start", "end")
    added = written(new.groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("added")), "added-spans")
    added = checked_broadcast(added, 256).withColumnRenamed("row", "_row")
    rows = found.join(added, found["row"] == added["_row"], "left")
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    return Found(rows.select("doc_id", "base", F.coalesce("added", none).alias("added")), patterns)


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    each = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", each)


def digest(rows: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans): the numbers are of base spans."""

    def number(k):
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")

    numbers = [number(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS, 1)]
    everything = _joined(F.sort_array(F.concat("base", "added")))
    return rows.select("doc_id", *numbers, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), everything.alias("spans"))
