"""SimHash near-duplicates by deletion-variant signatures.

To link fingerprints that differ in at most ``most`` of 64 bits they are cut into
``most // 2 + 1`` segments, as few as leave one that differs in at most one bit.  Each
distinct fingerprint is indexed under its segments with one bit blanked out (64 variants);
two such fingerprints share a variant.  Fingerprints of one variant are compared bit by bit,
and a large group gives back a spanning forest of its links, so a group of thousands gives
thousands of links, not their square.  Copies share a fingerprint and are compared once.

Near copies by shingle similarity (``one_of_each``) meet in the same one-wildcard join over
several independently seeded fingerprints of their distinct shingles: a pair that one seed
misses meets by another.  Pairs that two fingerprints put far apart are dropped, the others
are held against the shingles themselves.  ``least_of_each`` keeps one text of each component of
linked fingerprints and compares no texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import WORD, checked_broadcast, text_batches, tidied, whole_text
from estrato.llm.components import components
from estrato.session import written

MOST_BITS = 4
SHINGLE = 4
SEED = 42
#: Groups up to this size give back every link, larger ones a spanning forest.
SHIFTED = 16
BLOCK = 256
#: Rows of a variant that one task compares; larger groups are dealt out in blocks of this size,
#: each pair of blocks to a group of its own.
SPLIT = 8192
#: Seeds of the fingerprints by which near copies meet; the last one makes a name of the set.
SEEDS = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xA0761D6478BD642F)
FINGERPRINTS = ["f0", "f1", "f2"]
#: Fingerprints that go with each variant, to drop far pairs before their texts are met.
CARRIED = 2
#: Of each text its so many nearest in a large group are tried first, then GROW times as many
#: of those that verified links haven't joined to it yet, until none is left.
FIRST, GROW = 4, 16


def segments(most: int) -> list[tuple[int, int]]:
    """First bit and number of bits of the segments for ``most`` differing bits."""
    count = most // 2 + 1
    edges = [round(64 * i / count) for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def fingerprint_of(text: bytes, size: int = SHINGLE) -> int:
    """The fingerprint of a text in UTF-8 as a signed 64-bit number."""
    import itertools

    import numpy as np
    import xxhash

    words = text.lower().split()  # on bytes: A-Z and the ASCII blanks only
    if not words:
        return 0
    if len(words) <= size:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    n = max(1, len(words) - size + 1)
    ones = np.zeros(64, np.int64)
    hashes = map(xxhash.xxh64_intdigest, shingles, itertools.repeat(SEED))
    while len(block := np.fromiter(itertools.islice(hashes, 1 << 16), "<u8")):
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    value = np.packbits(ones * 2 > n, bitorder="little").view("<i8")
    return int(value[0])


def fingerprints(docs: DataFrame, keep: list[str], size: int = SHINGLE) -> DataFrame:
    """``keep`` and ``fp``, the signed fingerprint of the text; nothing is shuffled."""
    text_batches(docs.sparkSession)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], whole_text().cast("binary").alias("_text"))
    out = rows.drop("_text").withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in tidied(batches):
            fp = pa.array([fingerprint_of(t.as_py(), size) for t in batch.column("_text")], pa.int64())
            names = [c for c in batch.schema.names if c != "_text"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), fp], [*names, "fp"])

    return rows.mapInArrow(run, out)


def variants(fps: DataFrame, most: int = MOST_BITS, *keep: str) -> DataFrame:
    """(key, fp): the 64 one-wildcard segment variants of each distinct fingerprint, with ``keep``."""
    value = F.lit(None)
    for start, bits in segments(most):
        segment = F.shiftrightunsigned("fp", start).bitwiseAND(F.lit((1 << bits) - 1))
        blank = F.expr(f"~shiftleft(1L, bit - {start})")
        value = F.when(F.col("bit").between(start, start + bits - 1), segment.bitwiseAND(blank)).otherwise(value)
    each = fps.select("fp", *keep, F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit"))
    width = max(bits for _, bits in segments(most))
    return each.select((F.shiftleft(F.col("bit").cast("long"), width) + value).alias("key"), "fp", *keep)


def _forest(bits, most: int):
    """Places (a, b) of links that connect what all links of a large group do."""
    import numpy as np

    n, label, a, b = len(bits), np.arange(len(bits)), [], []
    for at in range(0, n, BLOCK):
        near = np.bitwise_count(bits[at : at + BLOCK, None] ^ bits[None, : at + BLOCK]) <= most
        near &= np.arange(near.shape[1]) < np.arange(at, at + len(near))[:, None]
        for i in np.flatnonzero(near.any(1)):
            linked = np.flatnonzero(near[i])
            others, first = np.unique(label[linked], return_index=True)
            a += [at + i] * len(others)
            b += linked[first].tolist()
            if len(others) > 1:
                label[np.isin(label, others)] = others[0]
            label[at + i] = others[0]
    return np.array(a, np.int64), np.array(b, np.int64)


def group_links(key, fp, most: int = MOST_BITS):
    """Links (a, b) that connect what is within ``most`` bits in rows sorted by key."""
    import numpy as np

    n = len(key)
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if n else np.empty(0, int)
    sizes = np.diff(np.r_[starts, n])
    small = np.repeat(sizes, sizes) <= SHIFTED
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    bits = fp.view(np.uint64)  # the bits of a signed number are those of its absolute value
    for k in range(1, SHIFTED):
        i = np.flatnonzero(small[: n - k] & (key[k:] == key[: n - k])) if k < n else a[0]
        if not len(i):
            break
        i = i[np.bitwise_count(bits[i] ^ bits[i + k]) <= most]
        a.append(i)
        b.append(i + k)
    for s, size in zip(starts[sizes > SHIFTED], sizes[sizes > SHIFTED], strict=True):
        x, y = _forest(bits[s : s + size], most)
        a.append(s + x)
        b.append(s + y)
    return fp[np.concatenate(a)], fp[np.concatenate(b)]


def in_groups(batches: Iterator, most: int) -> Iterator:
    """(columns, whole) of rows sorted by their first column, the key: chunks of whole groups of
    at most ``most`` rows, and chunks of larger groups, whose rows are handed on as they come."""
    import numpy as np

    held, large = None, None  # rows of the last key so far; the key of the large group that goes on
    for batch in tidied(batches):
        columns = [c.to_numpy() for c in batch.columns]
        if not len(columns[0]):
            continue
        if large is not None:
            cut = np.searchsorted(columns[0], large, side="right")
            if cut:
                yield [c[:cut] for c in columns], False
            columns = [c[cut:] for c in columns]
            if not len(columns[0]):
                continue
            large = None
        held = columns if held is None else [np.concatenate(c) for c in zip(held, columns, strict=True)]
        key = held[0]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        ended = np.arange(len(key)) < starts[-1]
        fits = np.repeat(sizes <= most, sizes)
        for pick, whole in ((ended & fits, True), (ended & ~fits, False)):
            if pick.any():
                yield [c[pick] for c in held], whole
        held = [c[starts[-1] :] for c in held]
        if sizes[-1] > most:
            yield held, False
            held, large = None, key[-1]
    if held is not None and len(held[0]):
        yield held, len(held[0]) <= most


def blocks_met(rows: DataFrame, by: str) -> DataFrame:
    """Rows of large groups with the key of each pair of blocks that their block is in.

    Two rows of a group meet in one pair of blocks at least; a pair has about ``2 * SPLIT`` rows.
    """
    sizes = rows.groupBy("key").agg(F.ceil(F.count("*") / SPLIT).cast("int").alias("_blocks"))
    sizes = checked_broadcast(written(sizes, "simhash-blocks"), 16)
    rows = rows.join(sizes, "key").withColumn("_mine", F.pmod(F.xxhash64(by), F.col("_blocks")).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    pair = F.xxhash64("key", F.least("_mine", "_other"), F.greatest("_mine", "_other"))
    return rows.withColumn("key", pair).drop("_blocks", "_mine", "_other")


def _links(rows: DataFrame, most: int, split: int | None) -> DataFrame:
    """(key, a, b) of (key, fp): links, and with a key the rows of groups over ``split``."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for (key, fp), whole in in_groups(batches, split or 1 << 62):
            if whole:
                pairs = np.unique(np.sort(np.stack(group_links(key, fp, most), 1), 1), axis=0)
                columns = [pa.nulls(len(pairs), pa.int64()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])]
            else:
                columns = [pa.array(key), pa.array(fp), pa.nulls(len(fp), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "a", "b"])

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, "key long, a long, b long")


def links(fps: DataFrame, most: int = MOST_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints; their components are those of all pairs
    within ``most`` bits.  Groups of over ``SPLIT`` rows are met block by block."""
    found = written(_links(variants(fps, most), most, SPLIT), "simhash-links")
    large = found.where("key is not null").select("key", F.col("a").alias("fp"))
    out = found.where("key is null").select("a", "b")
    if large.isEmpty():
        return out
    return out.union(_links(blocks_met(large, "fp"), most, None).select("a", "b"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, most: int = MOST_BITS) -> DataFrame:
    """(doc_id, fp, component_id) of each row: documents that links of at most ``most``
    differing bits connect.

    ``component_id`` is the least doc_id of the component (null ids are passed over; null if
    it has no other).  Texts without words, null ones too, have fingerprint zero and are
    linked like any other; repeated rows are copies.  An empty table gives an empty one.
    """
    rows = written(fingerprints(docs, ["doc_id"], size), "simhash")
    copies = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-copies")
    labelled = _rooted(copies, most)
    least = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = written(labelled.join(least, "root").select("fp", "component_id"), "simhash-ids")
    return rows.join(ids, "fp").select("doc_id", "fp", "component_id")


def _rooted(copies: DataFrame, most: int) -> DataFrame:
    """Add ``root``, a fingerprint that names the component, to a table of distinct fingerprints."""
    rooted = components(links(copies.select("fp"), most))
    both = copies.join(rooted, copies["fp"] == rooted["node"], "left")
    return both.select(*copies.columns, F.coalesce("root", "fp").alias("root"))


def least_of_each(docs: DataFrame, size: int = SHINGLE, most: int = MOST_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component of ``near_duplicates``, with all
    their columns.

    The row with the least doc_id stays (null last), of rows that tie any one.  Null and
    empty texts are copies of each other.  Columns named as the helper ones are kept.
    """
    helper = docs.select("doc_id", whole_text().alias("text")).withColumn("hash", F.xxhash64("text"))
    rows = written(fingerprints(helper, ["doc_id", "hash"], size), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")
    copies = written(rows.groupBy("fp").agg(F.min(order).alias("first")), "simhash-copies")
    return _staying(docs, rows, _rooted(copies, most).groupBy("root").agg(F.min("first").alias("first")))


def _shingle_sets(rows: DataFrame, size: int) -> DataFrame:
    """Replace the text by ``set``, hashes of its distinct shingles (of all words if fewer)."""
    words = F.regexp_extract_all(F.lower(whole_text()), F.lit(f"({WORD})"), 1)
    last = F.greatest(F.size("w") - (size - 1), F.lit(1))
    runs = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice("w", i, size)))
    return rows.withColumn("w", words).withColumn("set", F.array_distinct(runs)).drop("w", "text")


def _alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs that share at least ``similarity`` of their shingles."""
    both = pairs.join(sets.toDF("a", "p"), "a").join(sets.toDF("b", "q"), "b")
    shared = F.size(F.array_intersect("p", "q"))
    return both.where(shared >= similarity * (F.size("p") + F.size("q") - shared)).select("a", "b")


def sketch_of(text: bytes, size: int) -> list[int]:
    """A name of the set of distinct shingles and its fingerprints, as signed numbers.

    Words and case are those of ``_shingle_sets``; equal sets have equal names.
    """
    import itertools

    import numpy as np
    import xxhash

    words = text.decode().lower().encode().split()  # on bytes: the ASCII blanks only
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)) if len(words) > size else [b" ".join(words)]
    hashes = map(xxhash.xxh64_intdigest, set(shingles), itertools.repeat(SEED))
    name, ones, n = np.zeros(1, np.uint64), np.zeros(64 * len(FINGERPRINTS), np.int64), 0
    while len(block := np.fromiter(itertools.islice(hashes, 1 << 14), "<u8")):
        z = block[:, None] + np.array(SEEDS, np.uint64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
        bits = np.unpackbits(np.ascontiguousarray(z[:, :-1]).view(np.uint8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        name += z[:, -1].sum(dtype=np.uint64)
        n += len(block)
    values = np.packbits(ones * 2 > n, bitorder="little").view("<i8")
    return [int(name.view(np.int64)[0]), *values.tolist()]


def sketches(docs: DataFrame, keep: list[str], size: int) -> DataFrame:
    """``keep``, ``name`` and the fingerprints of the text's distinct shingles."""
    text_batches(docs.sparkSession)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], whole_text().cast("binary").alias("_text"))
    made = ["name", *FINGERPRINTS]
    out = rows.drop("_text").select("*", *[F.lit(0).cast("long").alias(c) for c in made]).schema

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in tidied(batches):
            each = [sketch_of(t.as_py(), size) for t in batch.column("_text")]
            each = np.array(each, np.int64).reshape(-1, len(made))
            names = [c for c in batch.schema.names if c != "_text"]
            columns = [*map(batch.column, names), *[pa.array(each[:, i].copy()) for i in range(len(made))]]
            yield pa.RecordBatch.from_arrays(columns, [*names, *made])

    return rows.mapInArrow(run, out)


def most_apart(similarity: float) -> int:
    """Bits in which the carried fingerprints of texts of this similarity differ, and three
    standard deviations."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    bits = 64 * CARRIED
    return int(bits * share + 3 * math.sqrt(bits * share * (1 - share)))


def meeting_rows(sketched: DataFrame, most: int) -> DataFrame:
    """(key, name, carried fingerprints): the variants under each of the seeds."""
    carried = ["name", *FINGERPRINTS[:CARRIED]]
    out = None
    for i, f in enumerate(FINGERPRINTS):
        each = variants(sketched.select(F.col(f).alias("fp"), F.struct(*carried).alias("_c")), most, "_c")
        each = each.select((F.col("key") * len(FINGERPRINTS) + i).alias("key"), "_c.*")
        out = each if out is None else out.union(each)
    return out


def _apart(bits, i, j):
    """Differing bits of the rows i and j of carried fingerprints."""
    import numpy as np

    return sum(np.bitwise_count(f[i] ^ f[j]).astype(np.int16) for f in bits)


def group_pairs(key, group, bits, bound: int, lo: int, hi: int):
    """Places (a, b) of pairs within ``bound`` bits and not in one class, in rows sorted by key,
    and the places that are needed to go on.

    Of a row in a large group the pairs with earlier rows are ranked by their bits; those from
    ``lo`` to ``hi`` are given.  If later ones are not in its class the row and all that are
    ranked go on, so that the ranks are the same then.
    """
    import numpy as np

    n = len(key)
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if n else np.empty(0, int)
    sizes = np.diff(np.r_[starts, n])
    small = np.repeat(sizes, sizes) <= SHIFTED
    a, b, on = [np.empty(0, np.int64)], [np.empty(0, np.int64)], np.zeros(n, bool)
    for k in range(1, SHIFTED if lo == 0 else 1):
        i = np.flatnonzero(small[: n - k] & (key[k:] == key[: n - k])) if k < n else a[0]
        if not len(i):
            break
        i = i[(_apart(bits, i, i + k) <= bound) & (group[i] != group[i + k])]
        a.append(i + k)
        b.append(i)
    ranked_too = sizes > (SHIFTED if lo == 0 else 0)
    for s, size in zip(starts[ranked_too], sizes[ranked_too], strict=True):
        for at in range(s, s + size, BLOCK):
            some = np.arange(at, min(at + BLOCK, s + size))
            earlier = np.arange(s, some[-1] + 1)
            apart = _apart(bits, some[:, None], earlier[None, :])
            near = (apart <= bound) & (earlier < some[:, None])
            for i in np.flatnonzero(near.any(1)):
                ranked = np.flatnonzero(near[i])
                ranked = s + ranked[np.argsort(apart[i, ranked], kind="stable")]
                now, later = ranked[lo:hi], ranked[hi:]
                now = now[group[now] != group[some[i]]]
                a.append(np.full(len(now), some[i]))
                b.append(now)
                if (group[later] != group[some[i]]).any():
                    on[ranked] = on[some[i]] = True
    return np.concatenate(a), np.concatenate(b), np.flatnonzero(on)


def candidate_pairs(rows: DataFrame, bound: int, lo: int, hi: int, split: int | None = None) -> DataFrame:
    """Names (a, b) of rows that share a key, are within ``bound`` bits and not in one class,
    with a null ``key``; and ``key`` and name ``a`` of rows that go on: beyond rank ``hi``, and
    with ``large`` those of groups over ``split``, which nothing has been compared with."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def out(key, a, b, large):
            none = pa.nulls(len(a), pa.int64())
            columns = [none if key is None else pa.array(key), pa.array(a), none if b is None else pa.array(b), pa.array(np.full(len(a), large))]
            return pa.RecordBatch.from_arrays(columns, ["key", "a", "b", "large"])

        for (key, name, group, *bits), whole in in_groups(batches, split or 1 << 62):
            if not whole:
                yield out(key, name, None, True)
                continue
            x, y, on = group_pairs(key, group, [f.view(np.uint64) for f in bits], bound, lo, hi)
            pairs = np.unique(np.sort(np.stack([name[x], name[y]], 1), 1), axis=0)
            yield out(None, pairs[:, 0], pairs[:, 1], False)
            yield out(key[on], name[on], None, False)

    rows = rows.select("key", "name", "group", *FINGERPRINTS[:CARRIED])
    dealt = rows.repartition("key").sortWithinPartitions("key", "name")
    return dealt.mapInArrow(run, "key long, a long, b long, large boolean")


def first_candidates(todo: DataFrame, texts: DataFrame, bound: int, hi: int) -> DataFrame:
    """(key, a, b) of ``candidate_pairs`` for the nearest of each row; large groups block by block."""
    found = written(candidate_pairs(todo, bound, 0, hi, SPLIT), "simhash-found")
    out = found.where("not large").select("key", "a", "b")
    large = found.where("large").select("key", F.col("a").alias("name"))
    if large.isEmpty():
        return out
    met = blocks_met(large, "name").join(texts, "name").withColumn("group", F.col("name"))
    return written(out.union(candidate_pairs(met, bound, 0, hi).select("key", "a", "b")), "simhash-found")


def _joined(rooted: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, root) of what the links of all rounds connect: the classes of the rounds before are
    single nodes to the new links, so that only links between classes are followed."""
    if rooted is None:
        return components(links)
    a, b = rooted.toDF("a", "_a"), rooted.toDF("b", "_b")
    links = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
    above = written(components(links.where("a <> b").distinct()), "simhash-classes")
    moved = rooted.join(above.toDF("root", "_root"), "root", "left").select("node", F.coalesce("_root", "root").alias("root"))
    return moved.unionByName(above.join(rooted.select("node"), "node", "left_anti"))


def one_of_each(docs: DataFrame, size: int = 5, most: int = 7, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with all their columns.

    A group is what links connect: texts that share at least ``similarity`` of their distinct
    shingles (intersection by union).  ``most`` sets the segments of the fingerprints by which
    they meet; it is no threshold.  Only verified links join: what they have not joined is
    tried until no met pair of different groups is left.
    The row with the least doc_id stays (null last), of rows that tie any one.  Null and
    empty texts are copies of each other.  Columns named as the helper ones are kept.
    """
    helper = docs.select("doc_id", whole_text().alias("text")).withColumn("hash", F.xxhash64("text"))
    rows = sketches(helper, ["doc_id", "hash"], size)
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash", "row")
    sketch = [F.first(f).alias(f) for f in FINGERPRINTS]
    texts = written(rows.groupBy("name").agg(F.min(order).alias("first"), *sketch), "simhash-texts")
    todo = meeting_rows(texts, most).withColumn("group", F.col("name"))
    found = first_candidates(todo, texts, most_apart(similarity), FIRST)

    nodes = found.select("a").union(found.select("b")).where("a is not null").distinct().toDF("_name")
    nodes = texts.join(nodes, texts["name"] == nodes["_name"]).select("name", "first.doc_id", F.col("first.hash").alias("hash"))
    nodes = checked_broadcast(written(nodes, "simhash-nodes").toDF("name", "_id", "_hash"), 24)
    is_node = helper["doc_id"].eqNullSafe(nodes["_id"]) & (helper["hash"] == nodes["_hash"])
    sets = _shingle_sets(helper.join(nodes, is_node).select("name", "text"), size).dropDuplicates(["name"])
    sets = written(sets, "simhash-sets")
    rooted, lo, hi = None, 0, FIRST
    while True:
        pairs = found.where("key is null").select("a", "b").distinct()
        rooted = written(_joined(rooted, written(_alike(pairs, sets, similarity), "simhash-alike")), "simhash-roots")
        left = found.where("key is not null").select("key", F.col("a").alias("name")).distinct()
        if left.isEmpty():
            break
        lo, hi = hi, hi * GROW
        todo = left.join(texts, "name").join(rooted, F.col("name") == rooted["node"], "left")
        todo = todo.withColumn("group", F.coalesce("root", "name"))
        found = written(candidate_pairs(todo, most_apart(similarity), lo, hi).select("key", "a", "b"), "simhash-found")

    grouped = texts.join(rooted, texts["name"] == rooted["node"], "left")
    return _staying(docs, rows, grouped.groupBy(F.coalesce("root", "name")).agg(F.min("first").alias("first")))


def _staying(docs: DataFrame, rows: DataFrame, stay: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``first`` (doc_id, hash of the text) of ``stay`` names, each once;
    ``rows`` has doc_id and hash of all."""
    stay = stay.select(F.col("first.doc_id").alias("_id"), F.col("first.hash").alias("_hash"), F.lit(True).alias("_stays"))
    keys = rows.groupBy("doc_id", "hash").agg(F.count("*").alias("n"))
    marks = keys.join(stay, keys["doc_id"].eqNullSafe(stay["_id"]) & (keys["hash"] == stay["_hash"]), "left")
    marks = marks.where(F.col("_stays").isNull() | (F.col("n") > 1))  # all but rows that just stay
    marks = marks.select(F.col("doc_id").alias("_i"), F.col("hash").alias("_h"), F.coalesce("_stays", F.lit(False)).alias("_stays"))
    marks = checked_broadcast(written(marks, "simhash-marks"), 24)
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col("doc_id").alias("_id"), F.xxhash64(whole_text()).alias("_hash"),
    )
    met = whole.join(marks, whole["_id"].eqNullSafe(marks["_i"]) & (whole["_hash"] == marks["_h"]), "left")
    several = met.where("_stays").dropDuplicates(["_id", "_hash"])
    return met.where("_stays is null").unionByName(several).select("_row.*")


def hex_of(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
