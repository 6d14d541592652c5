"""Phrase collocation mining by a multikey quicksort of suffix pointers.

Words are counted first; a suffix is a place in a piece with the words that follow it, up to the
longest phrase, and it ends before a word too rare for any frequent phrase.  Suffixes go to
buckets by a hash of their two leading words, equal ones of a task as one with its weight, and a
pair of very frequent words is dealt out by the third word too.  In each bucket a multikey
three-way quicksort (``multikey.py``) sorts pointers to the suffixes as deep as the longest
phrase: the sizes of equal parts are the counts, infrequent parts are abandoned.

Words are 64-bit hashes on the way.  Each count of a hash comes with its least and greatest word,
so a collision shows, and then another seed is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estrato.llm.common import text_batches, tidied, whole_text
from estrato.llm.multikey import frequent_beginnings
from estrato.session import written

LONGEST = 4
LEAST = 30
#: Suffixes that a bucket holds about at most, and that a task gathers before it sends them on.
BUCKET_ROWS = 1_000_000
GATHERED = 1 << 18
#: Buckets for each shuffle partition at least, so that partitions are alike.
BUCKETS_EACH = 8
#: Words that a task remembers or counts before it begins anew.
HELD = 300_000
#: The filter of frequent words has 2^26 bits, whatever the vocabulary; it lets too many words
#: pass, never too few.
SLOTS = 20
#: Words are looked at as leading a hot pair if they are one of this many words at least.
HOT_SHARE = 100_000

# What ends a piece.
ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
SKIP = 2**64 - 1


def byte_table() -> bytes:
    """Lower-cases A-Z, makes a line feed of each end of a piece and a space of the tab."""
    return bytes(0x0A if b in ENDS else 0x20 if b == 0x09 else b for b in bytes(range(256)).lower())


def tokens_of(text: bytes, table: bytes) -> list[bytes]:
    """The words of a text in order, with a line feed between pieces and empty ones that say nothing."""
    return text.translate(table).replace(b"\n", b" \n ").split(b" ")


def word_key(lang: bytes, seed: int):
    """The hash of a word of ``lang``, never 0 or ``SKIP``."""
    from xxhash import xxh3_64_intdigest

    start = b"%d:%s" % (len(lang), lang)
    return lambda word: min(max(xxh3_64_intdigest(start + word, seed), 1), SKIP - 1)


def _rows(docs: DataFrame) -> DataFrame:
    text_batches(docs.sparkSession)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    return docs.select(lang.cast("binary").alias("lang"), whole_text().cast("binary").alias("text"))


def word_counts(docs: DataFrame, least: int, seed: int) -> DataFrame:
    """(hash, lang, word, n, clash) of words that occur ``least`` times, and a null word for each
    lang with the number of all its words."""
    table = byte_table()

    def run(batches: Iterator) -> Iterator:
        from collections import Counter

        import numpy as np
        import pyarrow as pa

        counts: dict[bytes, Counter] = {}

        def out():
            for lang, tally in counts.items():
                tally.pop(b"", None)
                tally.pop(b"\n", None)
                key, words = word_key(lang, seed), list(tally)
                hashes = np.array([*map(key, words), key(b"\n")], np.uint64).view(np.int64)
                n = [*tally.values(), tally.total()]
                columns = [pa.array(hashes), pa.array([lang] * len(n), pa.binary()).cast(pa.string()), pa.array([*words, None], pa.binary()).cast(pa.string()), pa.array(n, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["hash", "lang", "word", "n"])
            counts.clear()

        for batch in tidied(batches):
            for lang, text in zip(*batch.columns, strict=True):
                counts.setdefault(lang.as_py(), Counter()).update(tokens_of(text.as_py(), table))
                if sum(map(len, counts.values())) > HELD:
                    yield from out()
        yield from out()

    counted = _rows(docs).mapInArrow(run, "hash long, lang string, word string, n long")
    word = F.struct("lang", "word")
    one = counted.groupBy("hash").agg(F.sum("n").alias("n"), F.min(word).alias("one"), F.max(word).alias("other"))
    one = one.where((F.col("n") >= least) | F.col("one.word").isNull())
    clash = ~F.col("one").eqNullSafe(F.col("other"))
    return one.select("hash", "one.lang", "one.word", "n", clash.alias("clash"))


def frequent_bits(words: DataFrame):
    """The filter of frequent words: 2^``SLOTS`` numbers of 64 bits, the first bits of a hash say which."""
    import numpy as np

    slot = F.shiftrightunsigned("hash", 64 - SLOTS)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {58 - SLOTS}) & 63 as int))")
    rows = words.where("word is not null").groupBy(slot.alias("slot")).agg(F.bit_or(bit).alias("bits"))
    got = rows.toArrow()
    out = np.zeros(1 << SLOTS, np.uint64)
    out[got["slot"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return out


class Keys(dict):
    """Word to hash, 0 for a word that ends a suffix; remembers up to ``HELD`` words."""

    def __init__(self, lang: bytes, seed: int, bits):
        self.key, self.bits = word_key(lang, seed), bits
        self.forget()

    def forget(self) -> None:
        self.clear()
        self[b""], self[b"\n"] = SKIP, 0

    def __missing__(self, word: bytes) -> int:
        h = self.key(word)
        is_set = int(self.bits[h >> (64 - SLOTS)]) >> (h >> (58 - SLOTS) & 63) & 1
        self[word] = out = h if is_set else 0
        return out


def _mixed(x):
    """An odd multiple with its high bits folded in, so that any bits of it may be used."""
    x = (x ^ (x >> 32)) * 0x9E3779B97F4A7C15
    return x ^ (x >> 29)


def suffixes_at(keys, n: int, longest: int):
    """The suffixes of two keys or more that begin at the first ``n`` places, 0 after their end."""
    import numpy as np

    padded = np.concatenate([keys, np.zeros(longest, np.uint64)])
    out = np.zeros((n, longest), np.uint64)
    out[:, 0] = padded[:n]
    for d in range(1, longest):
        out[:, d] = np.where(out[:, d - 1] != 0, padded[d : d + n], 0)
    return out[(out[:, 0] != 0) & (out[:, 1] != 0)]


def combined(suffixes, weights, order):
    """Suffixes in the given order, neighbours that are equal as one with the sum of weights."""
    import numpy as np

    suffixes, weights = suffixes[order], weights[order]
    if not len(suffixes):
        return suffixes, weights, order
    first = np.flatnonzero(np.concatenate([[True], (suffixes[1:] != suffixes[:-1]).any(1)]))
    return suffixes[first], np.add.reduceat(weights, first), order[first]


def routed_suffixes(docs: DataFrame, bits, hot: dict[int, int], total: int, buckets: int, longest: int, seed: int) -> DataFrame:
    """(bucket, partial, rows, suffixes): packed suffixes by bucket; ``partial`` ones are dealt out
    by their third word too, so that a bucket has a part of those with their two leading words."""
    table, shared = byte_table(), docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        hot_keys = np.array(sorted(hot), np.uint64)
        hot_counts = np.array([hot[k] for k in sorted(hot)], np.float64)

        def often(keys):
            """How often a word occurs if it is hot, else 0."""
            if not len(hot_keys):
                return np.zeros(len(keys))
            at = np.minimum(np.searchsorted(hot_keys, keys), len(hot_keys) - 1)
            return np.where(hot_keys[at] == keys, hot_counts[at], 0.0)

        def out(keys, n):
            rows = suffixes_at(keys, n, longest)
            shares = np.ceil(np.minimum(often(rows[:, 0]), often(rows[:, 1])) * 2 * buckets / total).astype(np.uint64)
            pair = _mixed(_mixed(rows[:, 0]) + rows[:, 1])
            third = rows[:, 2] if longest > 2 else np.zeros(len(rows), np.uint64)
            salt = _mixed(third) % np.maximum(shares, 1)
            to = 2 * (_mixed(pair + salt) % buckets) + (shares > 1)
            rest = np.zeros(len(rows), np.uint64)
            for d in range(2, longest):
                rest = _mixed(rest + rows[:, d])
            order = np.argsort((to << 40) | (pair >> 44 << 20) | (rest >> 44))
            rows, weights, order = combined(rows, np.ones(len(rows), np.int64), order)
            to = to[order]
            cuts = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1], [True]])) if len(to) else np.zeros(1, int)
            packed = [rows[a:b].T.tobytes() + weights[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            some = to[cuts[:-1]].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(some >> 1), pa.array((some & 1).astype(bool)), pa.array(np.diff(cuts)), pa.array(packed, pa.binary())],
                ["bucket", "partial", "rows", "suffixes"],
            )

        langs: dict[bytes, Keys] = {}
        held, n = [], 0
        for batch in tidied(batches):
            for lang, text in zip(*batch.columns, strict=True):
                lang = lang.as_py()
                known = langs.get(lang)
                if known is None:
                    known = langs[lang] = Keys(lang, seed, shared.value)
                tokens = tokens_of(text.as_py(), table)
                keys = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
                held += [keys[keys != SKIP], np.zeros(1, np.uint64)]
                n += len(held[-2]) + 1
                if sum(map(len, langs.values())) > HELD:
                    langs.clear()
                if n >= GATHERED:
                    keys = np.concatenate(held)
                    for at in range(0, n, GATHERED):
                        yield from out(keys[at : at + GATHERED + longest], min(GATHERED, n - at))
                    held, n = [], 0
        if n:
            yield from out(np.concatenate(held), n)

    return _rows(docs).mapInArrow(run, "bucket long, partial boolean, rows long, suffixes binary")


def phrase_counts(routed: DataFrame, least: int, longest: int, tasks: int) -> DataFrame:
    """(key, a): the hashes of each phrase of two words or more that occurs ``least`` times."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def out(held, partial):
            suffixes = np.concatenate([s for s, _ in held])
            weights = np.concatenate([w for _, w in held])
            enough = [1 if partial and d < 2 else least for d in range(longest)]
            for d, (at, n) in enumerate(frequent_beginnings(suffixes, weights, enough), 1):
                if d > 1 and len(at):
                    flat = suffixes[at, :d].ravel().view(np.int64)
                    key = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, d), pa.int32()), pa.array(flat))
                    part = pa.array(np.full(len(at), partial and d == 2))
                    yield pa.RecordBatch.from_arrays([key, pa.array(n), part], ["key", "a", "part"])

        at, held, rows = None, [], 0
        for batch in batches:
            for bucket, partial, n, blob in zip(*batch.columns, strict=True):
                here, n = (bucket.as_py(), partial.as_py()), n.as_py()
                if at is not None and here != at:
                    yield from out(held, at[1])
                    held, rows = [], 0
                at = here
                flat = np.frombuffer(blob.as_py(), np.uint64)
                held.append((flat[: n * longest].reshape(longest, n).T, flat[n * longest :].view(np.int64)))
                rows += n
                if rows > 8 * BUCKET_ROWS:  # equal suffixes of different tasks as one
                    suffixes = np.concatenate([s for s, _ in held])
                    weights = np.concatenate([w for _, w in held])
                    held = [combined(suffixes, weights, np.lexsort(suffixes.T[::-1]))[:2]]
                    rows = 0
        if at is not None:
            yield from out(held, at[1])

    dealt = routed.repartitionById(tasks, F.col("bucket").cast("int")).sortWithinPartitions("bucket", "partial")
    found = written(dealt.mapInArrow(run, "key array<long>, a long, part boolean"), "phrases")
    parts = found.where("part").groupBy("key").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    return found.where("not part").select("key", "a").union(parts)


def _whole(c) -> Column:
    """As a whole number whose products don't overflow."""
    return F.col(c).cast("decimal(20,0)")


def scored_phrases(phrases: DataFrame, words: DataFrame, share: int) -> DataFrame:
    """(key, a, l, r, score) of the phrases that aren't dropped for a longer one."""
    counts = phrases.select("key", F.col("a").alias("f")).union(words.select(F.array("hash"), "n"))
    size = F.size("key")
    cuts = phrases.select("key", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumn("first", F.expr("slice(key, 1, k)")).withColumn("rest", F.expr("slice(key, k + 1, size(key) - k)"))
    cuts = cuts.join(counts.toDF("first", "l"), "first").join(counts.toDF("rest", "r"), "rest")
    score = F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = cuts.groupBy("key", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    # the runs of a longer phrase, shorter than itself and two words long at least
    runs = F.expr(
        "flatten(transform(sequence(2, size(key) - 1), n -> transform(sequence(1, size(key) - n + 1), i -> slice(key, i, n))))"
    )
    inside = phrases.where(size > 2).select(F.explode(runs).alias("key"), F.col("a").alias("longer"))
    inside = inside.groupBy("key").agg(F.max("longer").alias("longer"))
    left = best.join(inside, "key", "left")
    left = left.where(F.col("longer").isNull() | (_whole("longer") * 100 < _whole("a") * share))
    return left.select("key", "a", "cut.l", "cut.r", "cut.score")


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = 2000, share: int = 80, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each lang.

    Null texts are empty and have no words; a null lang is ``und``; repeated rows count each;
    columns other than lang and text are not read; phrases that tie in score and count are
    ordered by their bytes; an empty table gives an empty one.
    """
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for seed in range(64):
        words = written(word_counts(docs, least, seed), "words")
        if words.where("clash").isEmpty():
            break
    langs = words.where("word is null").select("lang", "n")
    total = langs.agg(F.sum("n")).first()[0] or 1
    buckets = tasks * min(max(BUCKETS_EACH, -(-total // (bucket_rows * tasks))), (1 << 22) // tasks)
    often = max(total // (2 * buckets), total // HOT_SHARE, 1)
    vocabulary = words.where("word is not null")
    hot = {r.hash % 2**64: r.n for r in vocabulary.where(F.col("n") > often).select("hash", "n").collect()}
    routed = routed_suffixes(docs, frequent_bits(words), hot, total, buckets, longest, seed)
    phrases = written(phrase_counts(routed, least, longest, tasks), "phrase-counts")
    scored = written(scored_phrases(phrases, vocabulary, share), "phrases-scored")

    places = scored.select("key", F.posexplode("key").alias("i", "hash")).join(vocabulary.select("hash", "lang", "word"), "hash")
    spelled = places.groupBy("key").agg(F.min("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("i", "word"))).alias("w"))
    spelled = spelled.select("key", "lang", F.concat_ws(" ", F.col("w.word")).alias("phrase"))
    found = scored.join(spelled, "key").drop("key")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # first in each of 64 parts of a lang, so that none is ranked whole in one task
    found = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    found = found.where(F.col("rank") <= top)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    found = found.where(F.col("rank") <= top).join(langs, "lang")
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
