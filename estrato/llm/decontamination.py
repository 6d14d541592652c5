"""Benchmark decontamination by templates, in DataFrame functions only.

A text becomes a template: numbers, units after a number and names (capitalised words inside
a sentence) turn into typed placeholders, other words are lower-cased, signs are dropped.
Windows of five template words are hashed and joined with those of the benchmark, so that an
item with other numbers or names still meets its source.

Candidates are then aligned: an alignment of an item is one shift between its places and the
document's.  A window with the item's own values counts as it is; another one if its alignment
has enough windows and each of its slots has the value that most windows of the alignment give to
the item's value.  A second set of windows holds the plain lower-cased words, so that a copy in
other case, whose names are not seen as such, meets its source too.
Windows of several alignments count together only in order: the longest chain of windows that
goes up in the item and in the document, so that a window of the document stands for one place
of the item.  A document leaks an item if a chain in one stretch of it, of two to three times
the item's length, has at least 0.8 of the item's windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estrato.llm.common import checked_broadcast, whole_text
from estrato.session import written

WINDOW = 5
SIMILARITY = 0.8
#: Fewer plain words than this and a window says too little; it counts only for items that
#: have no better one, and then only with the same values.
LITERALS = 3
#: Windows of one alignment from which on windows with other values count, and the share of the
#: item's windows if that is less.
ALIGNED, ALIGNED_SHARE = 5, 0.2
#: Marks a placeholder, and parts it from the value it stands for.
SLOT, VALUE = "\u0002", "\u0001"

# Unit words that follow a number.
UNITS = (
    "%", "kg", "g", "mg", "km", "m", "cm", "mm", "l", "ml", "s", "ms", "min", "h", "kilograms?",
    "grams?", "kilomet(?:er|re)s?", "met(?:er|re)s?", "centimet(?:er|re)s?", "lit(?:er|re)s?",
    "miles?", "feet", "foot", "inch(?:es)?", "pounds?", "ounces?", "seconds?", "minutes?",
    "hours?", "days?", "weeks?", "months?", "years?", "dollars?", "euros?", "cents?", "degrees?",
)
NUMBER = (  # a digit is looked for first: that is cheaper than looking back at every place
    r"(?=[0-9])(?<![\p{L}\p{M}\p{Nd}])([0-9]+(?:[.,:][0-9]+)*)(?:[ ]?(" + "|".join(UNITS) + r")(?![\p{L}\p{Nd}])|(?![\p{L}\p{M}\p{Nd}]))"
)
NAME = r"\p{Lu}(?<=[\p{Ll},;:)] .)\p{Ll}[\p{L}\p{M}\p{Nd}]*"
WORDS = r"[\p{L}\p{M}\p{Nd}]+"


def marked(text: Column) -> Column:
    """The text with each number, unit and name as a marked word that keeps its value."""
    numbers = F.regexp_replace(text, NUMBER, f" {SLOT}n{VALUE}$1 {SLOT}u{VALUE}$2 ")
    numbers = F.regexp_replace(numbers, f"{SLOT}u{VALUE} ", "")
    return F.regexp_replace(numbers, NAME, f" {SLOT}p{VALUE}$0 ")


def template_words(marked_text: Column) -> Column:
    """The template as lower-case words; a placeholder is its mark and type."""
    plain = F.lower(F.regexp_replace(marked_text, f"{VALUE}[^ ]*", ""))
    return F.regexp_extract_all(plain, F.lit(f"({SLOT}[npu]|{WORDS})"), 1)


def valued_words(marked_text: Column) -> Column:
    """The same words, a placeholder with its value."""
    return F.regexp_extract_all(F.lower(marked_text), F.lit(f"({SLOT}[npu]{VALUE}[^ ]*|{WORDS})"), 1)


def plain_words(marked_text: Column) -> Column:
    """The same words without marks, so equal whatever the case of the text."""
    word = f"(?:{SLOT}[npu]{VALUE})?((?<={VALUE})[^ ]+|{WORDS})"
    return F.regexp_extract_all(F.lower(marked_text), F.lit(word), 1)


def _each_window(words: str, make) -> Column:
    """``make`` of each place at which a window starts; none below five words."""
    places = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    return F.when(F.size(words) >= WINDOW, F.transform(places, make))


def _aligned_windows(rows: DataFrame, *keep: str) -> DataFrame:
    """A row for each window: its place, the hashes of its template and plain words, and the
    values of its slots (null for a plain word)."""
    m = rows.withColumn("_m", marked(whole_text()))
    m = m.select(*keep, template_words(F.col("_m")).alias("_t"), valued_words(F.col("_m")).alias("_v"), plain_words(F.col("_m")).alias("_p"))
    m = m.select(
        *keep, "_t", "_p", _hashed("_t").alias("_th"), _hashed("_p").alias("_ph"),
        F.transform("_v", lambda v: F.when(v.startswith(SLOT), v)).alias("_v"),
    )
    window = F.explode(_each_window("_t", lambda i: F.struct(
        i.alias("place"), *_hashes("_t", "_th", i, "hash"), *_hashes("_p", "_ph", i, "plain_hash"), F.slice("_v", i, WINDOW).alias("values"),
    )))
    return m.select(*keep, window.alias("w")).select(*keep, "w.*")


def _hashed(words: str) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _hashes(words: str, hashed: str, i: Column, name: str) -> list[Column]:
    """Two 64-bit hashes of a window: one of its words' hashes to join by, one of its words to verify."""
    return [F.xxhash64(F.slice(hashed, i, WINDOW)).alias(name), F.xxhash64(F.lit("verify"), F.slice(words, i, WINDOW)).alias(f"{name}_2")]


def _window_hashes(rows: DataFrame, *keep: str) -> DataFrame:
    """(keep, hash): the first hashes of each window's template and, where they differ, plain words.

    Each word is hashed once and a window is five numbers of an array, read where it is exploded.
    Only for texts without the marks themselves, as words are told from their marks.
    """
    m = rows.select(*keep, marked(whole_text()).alias("_m"))
    m = m.select(*keep, valued_words(F.col("_m")).alias("_v"))
    kind, value = lambda w: F.substring(w, 1, len(SLOT) + 1), lambda w: F.substring(w, len(SLOT + VALUE) + 2, 1 << 30)
    template = F.transform("_v", lambda w: F.xxhash64(F.when(w.startswith(SLOT), kind(w)).otherwise(w)))
    plain = F.transform("_v", lambda w: F.xxhash64(F.when(w.startswith(SLOT), value(w)).otherwise(w)))
    words = m.select(*keep, template.alias("_t"), plain.alias("_p"))
    # the outer form keeps Spark from a filter on the array's size, which would build all words twice
    each = words.select(*keep, "_t", "_p", F.posexplode_outer("_t").alias("_i", "_first")).where(F.col("_i") <= F.size("_t") - WINDOW)
    t, p = (F.xxhash64(*[F.get(c, F.col("_i") + k) for k in range(WINDOW)]) for c in ("_t", "_p"))
    each = each.select(*keep, t.alias("_th"), p.alias("_ph"))
    both = F.array(F.col("_th"), F.when(F.col("_th") != F.col("_ph"), F.col("_ph")))
    return each.select(*keep, F.explode(both).alias("hash")).where(F.col("hash").isNotNull())


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """The windows that an item is known by, their number ``windows`` and the item's length."""
    items = benchmark.where(F.col("item_id").isNotNull()).select("item_id", "text")
    windows = _aligned_windows(items.distinct(), "item_id", "text").withColumn("item", F.xxhash64("text"))
    slots = F.size(F.filter("values", lambda v: v.isNotNull()))
    windows = windows.withColumn("telling", slots <= WINDOW - LITERALS)
    told = windows.groupBy("item_id", "item").agg(
        F.max("telling").alias("any_telling"), F.count_if("telling").alias("n1"), F.count("*").alias("n")
    )
    windows = windows.drop("text").join(told, ["item_id", "item"])
    windows = windows.where(F.col("telling") | ~F.col("any_telling"))
    return windows.select(
        "item_id", "item", F.col("place").alias("at"), "hash", "hash_2", "plain_hash", "plain_hash_2",
        F.col("values").alias("asked"), F.when(F.col("any_telling"), F.col("n1")).otherwise(F.col("n")).alias("windows"),
        F.col("n").alias("length"), (~F.col("any_telling")).alias("literal"),
    )


def longest_chain(pairs: Column) -> Column:
    """The length of the longest chain that goes up in both numbers of (place, at) pairs.

    Pairs come in order of place; those of one place from the last to the first ``at``, so that
    a chain has one of them.  The state is the least end of a chain of each length.
    """

    def longer(ends, at):
        shorter = F.size(F.filter(ends, lambda e: e < at))
        rest = F.slice(ends, shorter + 2, F.greatest(F.size(ends) - shorter - 1, F.lit(0)))
        return F.concat(F.slice(ends, 1, shorter), F.array(at), rest)

    ordered = F.transform(F.array_sort(F.transform(pairs, lambda p: F.struct(p["place"].alias("place"), (-p["at"]).alias("back")))), lambda p: -p["back"])
    return F.size(F.aggregate(ordered, F.array().cast("array<int>"), longer))


def _key(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_text", F.xxhash64(whole_text()))


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, text_hash, item_id, matched, windows, similarity): the items a document leaks.

    Null and short texts (under five words) and such items have no windows and leak nothing.
    Rows with the same id and text are reported once, a null id as null; items with the
    same text each.  Empty tables give an empty one.
    """
    asked = written(benchmark_windows(benchmark), "benchmark-windows")
    hashes = asked.select("hash").union(asked.select("plain_hash")).distinct()
    hashes = checked_broadcast(written(hashes, "benchmark-hashes"), 16)
    least = asked.agg(F.min(F.ceil(F.col("windows") * similarity))).first()[0]
    rows = _key(docs.select("doc_id", "text"))
    forged = whole_text().contains(SLOT) | whole_text().contains(VALUE)  # no words to tell by: candidates as they are
    met = _window_hashes(rows.where(~forged), "doc_id", "_text").join(hashes, "hash", "left_semi")
    met = met.groupBy("doc_id", "_text").agg(F.count("*").alias("n")).where(F.col("n") >= F.lit(least or 1))
    met = met.select("doc_id", "_text").union(rows.where(forged).select("doc_id", "_text").distinct())
    met = written(met.select(F.col("doc_id").alias("_id"), F.col("_text").alias("_hash")), "candidates")
    met = checked_broadcast(met, 24)
    same = rows["doc_id"].eqNullSafe(met["_id"]) & (rows["_text"] == met["_hash"])
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # dealt out by number: what a candidate unfolds to is much more than its text
    candidates = rows.join(met, same, "left_semi").repartition(tasks, "doc_id", "_text").dropDuplicates(["doc_id", "_text"])
    windows = _aligned_windows(candidates, "doc_id", "_text")
    key = ["doc_id", "_text"]
    asked = checked_broadcast(asked, 160)
    by_template = F.col("hash") == F.col("_hash")
    by_plain = (F.col("plain_hash") == F.col("_plain")) & (F.col("plain_hash_2") == F.col("_plain_2"))
    mine = windows.toDF(*key, "place", "_hash", "_hash_2", "_plain", "_plain_2", "values")
    plain = mine.join(asked, by_plain).select(*key, "item_id", "item", "windows", "length", "place", "at")
    found = mine.join(asked, by_template & (F.col("hash_2") == F.col("_hash_2"))).withColumn("same", by_plain)
    found = found.where(~F.col("literal") | F.col("same"))
    aligned = found.select(
        *key, "item_id", "item", "windows", "length", (F.col("place") - F.col("at")).alias("shift"), "at", "same",
        F.filter(F.arrays_zip("asked", "values"), lambda p: p["asked"].isNotNull()).alias("slots"),
    )
    fit = _consistent(aligned, [*key, "item_id", "item", "windows", "length"])
    pairs = fit.select(*key, "item_id", "item", "windows", "length", (F.col("at") + F.col("shift")).alias("place"), "at")
    pairs = pairs.union(plain)
    # stretches of three lengths, beginning at each length: what is within two lengths is within one of them
    stretch = F.floor(F.col("place") / (F.col("length") + 2 * WINDOW)).cast("int")
    pairs = pairs.withColumn("stretch", F.explode(F.sequence(stretch - 2, stretch)))
    one = F.collect_set(F.struct("place", "at")).alias("pairs")
    chains = pairs.groupBy(*key, "item_id", "item", "windows", "stretch").agg(one, F.countDistinct("at").alias("places"))
    chains = chains.where(F.col("places") / F.col("windows") >= similarity).withColumn("chain", longest_chain(F.col("pairs")))
    out = chains.groupBy(*key, "item_id", "item", "windows").agg(F.max("chain").cast("long").alias("matched"))
    out = out.withColumn("similarity", F.col("matched") / F.col("windows"))
    out = out.where(F.col("similarity") >= similarity).withColumnRenamed("_text", "text_hash")
    return out.select("doc_id", "text_hash", "item_id", "matched", "windows", "similarity")


def _consistent(aligned: DataFrame, key: list[str]) -> DataFrame:
    """(key, shift, at) of the windows that count: those with the item's values, and those of an
    alignment with enough consistent windows whose slots have its usual values.

    An alignment has each place of the item once at most, so its windows are a bounded group.
    """
    window = F.struct("at", "same", "slots")
    groups = aligned.groupBy(*key, "shift").agg(F.collect_list(window).alias("w"))
    given = F.flatten(F.transform("w", lambda w: w["slots"]))
    groups = groups.withColumn("given", given)
    # a conflict: another value of the same asked one is more frequent; of equal ones the item's own
    # value wins, then the greatest
    def times(s):
        return F.size(F.filter("given", lambda g: (g["asked"] == s["asked"]) & g["values"].eqNullSafe(s["values"])))

    ranked = F.transform(F.array_distinct("given"), lambda s: F.struct(
        s["asked"].alias("asked"), times(s).alias("n"), s["asked"].eqNullSafe(s["values"]).alias("own"), s["values"].alias("values"),
    ))
    groups = groups.withColumn("ranked", ranked)

    def usual(s):
        better = lambda r: (r["asked"] == s["asked"]) & (F.struct(r["n"], r["own"], r["values"]) > F.struct(s["n"], s["own"], s["values"]))
        return ~F.exists("ranked", better)

    groups = groups.withColumn("usual", F.transform(F.filter("ranked", usual), lambda r: F.struct(r["asked"].alias("asked"), r["values"].alias("values"))))
    in_usual = lambda s: F.exists("usual", lambda u: (u["asked"] == s["asked"]) & u["values"].eqNullSafe(s["values"]))
    fits = F.filter("w", lambda w: w["same"] | F.forall(w["slots"], in_usual))
    groups = groups.select(*key, "shift", fits.alias("w"))
    least = F.least(F.lit(float(ALIGNED)), F.col("windows") * ALIGNED_SHARE)
    enough = F.size("w") >= least
    kept = F.filter("w", lambda w: w["same"] | enough)
    return groups.select(*key, "shift", F.explode(kept).alias("w")).select(*key, "shift", F.col("w.at").alias("at"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that leak no item, with all their columns.

    A row goes with all rows of the same doc_id and text, a null id being an id; null, empty and
    short texts stay; columns may have any names; an empty benchmark leaves every row.
    """
    bad = leaks(docs, benchmark).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    bad = checked_broadcast(written(bad, "leaks"), 24)
    same = docs["doc_id"].eqNullSafe(bad["_id"]) & (F.xxhash64(docs["text"]) == bad["_hash"])
    return docs.join(bad, same, "left_anti")
