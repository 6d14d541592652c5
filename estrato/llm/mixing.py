"""Mix sources to target weights by capped water-filling.

A budget of words is shared by weight; a source stops at ``most_epochs`` times its size and
what it can't take goes to the others by weight, until none is above its cap.  Sizes and
weights are whole numbers, so the water level doesn't depend on the order of sums.

A target becomes whole repetitions of the source and a fraction of one more.  The fraction
goes along a seeded order of the documents: those before the cut are taken once more, the
one on the cut in part, so that each source takes its target to the word.  The cut of a
source, however large, is found by sums over buckets of the order, three levels deep; only
the last bucket (a 16-millionth of the source) is looked at row by row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estrato.llm.common import WORD, whole_text
from estrato.session import written

SEED = "mix"
#: Hex digits of the seeded order by which the cut is narrowed, level by level.
LEVELS = (2, 4, 6)


def ranked_sources(sources: DataFrame) -> DataFrame:
    """Add ``rank``, the place of a source by code point from 0, null last.

    Sorted in ranges, one place in a range plus the rows of the ranges before it; no task
    holds all sources.
    """
    order = F.col("source").asc_nulls_last()
    placed = written(
        sources.repartitionByRange(order).sortWithinPartitions(order).select(
            "*",
            F.spark_partition_id().alias("_range"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"),
        ),
        "mix-sources",
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy("_range").agg(F.count("*").alias("_n"))  # a row for each range
    offsets = ranges.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_b"))
    return (
        placed.join(offsets, "_range")
        .withColumn("rank", F.col("_b") + F.col("_place"))
        .drop("_range", "_place", "_b")
    )


def cyclic_weight(*weights: int) -> Column:
    """The weight of a ranked source: the list, repeating."""
    return F.element_at(F.lit(list(weights)), (F.col("rank") % len(weights) + 1).cast("int"))


def water_level(sources: DataFrame, budget: float, most_epochs: float) -> float:
    """The words a unit of weight gets; ``sources`` has source_size and weight.

    Each pass sums the sources that are at their cap; it ends when no other joins them.
    """
    level, full = 0.0, -1
    while True:
        at_cap = F.col("source_size") * most_epochs <= level * F.col("weight")
        at_cap = at_cap & F.lit(full >= 0)
        row = sources.agg(
            F.sum(F.when(at_cap, F.col("source_size") * most_epochs).otherwise(0.0)).alias("c"),
            F.sum(F.when(at_cap, 0).otherwise(F.col("weight"))).alias("w"),
            F.count_if(at_cap).alias("full"),
        ).first()
        if row["full"] == full or not row["w"]:
            return level
        full = row["full"]
        level = (budget - row["c"]) / row["w"]


def targets(
    sizes: DataFrame, weight: Callable[[DataFrame], DataFrame], share: float, most_epochs: float
) -> DataFrame:
    """(source, source_size, weight, target) of the rows' sources."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = written(weight(sources), "mix-weights")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = water_level(sources, share * total, most_epochs)
    cap = F.col("source_size") * most_epochs
    return sources.select(
        "source", "source_size", "weight",
        F.least(cap.cast("double"), F.lit(level) * F.col("weight")).alias("target"),
    )


def _same_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on the source, null matching null, keeping the left one's column."""
    other = right.withColumnRenamed("source", "_source")
    return left.join(other, left["source"].eqNullSafe(other["_source"]), how).drop("_source")


def cut_points(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, cut, before): the bucket of the seeded order in which the fraction ends,
    and the words of the buckets before it."""
    cuts = targets.select("source", "rest", F.lit("").alias("cut"), F.lit(0).cast("long").alias("before"))
    for digits in LEVELS:
        held = _same_source(rows, cuts)
        held = held.where(F.col("cut") == F.substring("order", 1, max(digits - 2, 0)))
        sums = held.groupBy("source", F.substring("order", 1, digits).alias("bucket")).agg(
            F.sum("size").alias("words"), F.first("before").alias("start"), F.first("rest").alias("rest")
        )
        along = Window.partitionBy("source").orderBy("bucket")
        end = F.col("start") + F.sum("words").over(along)
        ends = sums.withColumn("end", end).where(F.col("end") > F.col("rest"))
        cuts = ends.groupBy("source").agg(
            F.min(F.struct("bucket", F.col("end") - F.col("words"), "rest")).alias("m")
        ).select("source", F.col("m.rest"), F.col("m.bucket").alias("cut"), F.col("m.col2").alias("before"))
        cuts = written(cuts, "mix-cuts")
    return cuts


def mix(
    docs: DataFrame,
    weight: Callable[[DataFrame], DataFrame],
    share: float = 1.5,
    most_epochs: float = 2.0,
    seed: str = SEED,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, source, size, source_size, target, whole, part, taken, keep...) of each row.

    ``size`` counts words, ``whole`` is how often the mix takes the whole document, ``part``
    how many of its words it takes besides, ``taken`` their sum.  ``weight`` adds a whole
    ``weight`` above 0 to a table of source and source_size.  The seeded order goes by
    doc_id and then size; a null id counts as one id, rows that tie in both are alike.
    A null or empty text has no words and is never taken; a null source is a source.  An
    empty table gives an empty one.
    """
    names = ["doc_id", "source", "size", *keep]
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    rows = written(
        docs.select(
            "doc_id", "source",
            F.regexp_count(whole_text(), F.lit(WORD)).cast("long").alias("size"),
            order.alias("order"), *keep,
        ),
        "mix-sizes",
    )
    goals = targets(rows.select("source", "size"), weight, share, most_epochs)
    words = F.round("target").cast("long")
    goals = written(
        goals.withColumn(
            "whole",
            F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long"),
        ).withColumn("rest", words - F.col("whole") * F.col("source_size")),
        "mix-targets",
    )
    cuts = cut_points(rows.select("source", "size", "order"), goals).select("source", "cut", "before")
    plan = _same_source(goals, cuts, "left")
    joined = _same_source(rows, plan)
    bucket = F.substring("order", 1, LEVELS[-1])
    full = joined.where(F.col("cut").isNull() | (bucket != F.col("cut"))).withColumn(
        "part", F.when(bucket < F.col("cut"), F.col("size")).otherwise(0).cast("long")
    )
    along = Window.partitionBy("source").orderBy("order", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("size").over(along), F.lit(0))
    split = joined.where(bucket == F.col("cut")).withColumn(
        "part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - start)).cast("long")
    )
    out = full.unionByName(split)
    return out.select(
        *names, "source_size", "target", "whole", "part",
        (F.col("size") * F.col("whole") + F.col("part")).alias("taken"),
    )


def mixed(docs: DataFrame, weight: Callable[[DataFrame], DataFrame], **options) -> DataFrame:
    """``docs`` as the mix takes them, with all their columns: a row for each repetition.

    The document on a source's cut is taken as an excerpt, its first ``part`` words with
    single blanks; ``n_chars``, if it is a column, is that of the excerpt.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    took = mix(docs.select("doc_id", "source", "text", whole), weight, keep=("_row",), **options)
    times = F.col("whole") + F.when(F.col("part") > 0, 1).otherwise(0)
    rows = took.where(times > 0).withColumn("_time", F.explode(F.sequence(F.lit(1).cast("long"), times)))
    cut = (F.col("_time") > F.col("whole")) & (F.col("part") < F.col("size"))
    words = F.regexp_extract_all(F.col("_row.text"), F.lit(f"({WORD})"), 1)
    excerpt = F.array_join(F.slice(words, F.lit(1), F.col("part").cast("int")), " ")
    text = F.when(cut, excerpt).otherwise(F.col("_row.text"))
    made = {"text": text, "n_chars": F.when(cut, F.length(text)).otherwise(F.col("_row.n_chars")).cast(dict(docs.dtypes).get("n_chars", "long"))} if "n_chars" in docs.columns else {"text": text}
    return rows.select(*[made.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
