"""Remove every byte of a 200-byte string that starts anywhere else, in Spark jobs.

1. Anchors.  Among the 161 40-byte strings of a window of 200 bytes the one with the least
   hash is its anchor; equal windows have equal anchors at the same place.  Anchors of all
   texts are counted by hash; those that occur once can't belong to a repeated window.
2. Contexts.  The windows around a repeated anchor travel as one context of bytes to where
   the other contexts of that anchor are.
3. Suffix sort.  There the suffixes at the anchor are sorted (``suffix_sort``); sorted
   neighbours give the common extensions to the right, a second search those to the left,
   and together which windows are equal.  Anchors with very many different contexts are
   dealt out by window instead, and the suffixes that start the windows are sorted.
4. Marked windows go back to their text, whose remaining bytes are hashed.

Texts are known by their SHA-256; copies are read once in a task and found by it.  A task
that sees an anchor or a context twice settles that itself and passes on one row, so no key
has more rows than there are tasks, but for contexts that differ.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import whole_text
from estrato.llm.suffix_sort import Hashes, suffix_sort
from estrato.session import written

SIZE = 200
GRAM = 40
#: Bytes hashed at a time; a longer text is cut into pieces that share ``SIZE - 1`` bytes.
PIECE = 1 << 20
#: Anchors and bytes of contexts that a task compares before it passes them on.
HELD_ANCHORS = 1 << 20
HELD_BYTES = 32 << 20
#: Different contexts of one anchor: compared pair by pair up to the first number, dealt out
#: by window above the second.
PAIRED = 64
HOT = 4_096


def anchor_places(data, hashes: Hashes, size: int = SIZE, gram: int = GRAM):
    """For each window of ``data`` the place of its anchor, the leftmost least hash."""
    h = hashes.every(gram)
    spread = size - gram + 1
    v = (h & ~np.uint64((1 << 24) - 1)) | np.arange(len(h), dtype=np.uint64)
    n, have = len(h), 1
    while have < spread:  # least of the next ``have`` values, doubled
        step = min(have, spread - have)
        v = np.minimum(v[: n - have - step + 1], v[step : n - have + 1])
        have += step
    return (v & np.uint64((1 << 24) - 1)).astype(np.int64), h


def batches_of(texts: list[bytes], size: int):
    """(buffer, text, place in the text, start, end of the windows) of joined pieces."""
    held, rows = [], []
    at = 0
    for k, text in enumerate(texts):
        for start in range(0, max(1, len(text) - size + 1), PIECE - size + 1):
            piece = text[start : start + PIECE]
            if len(piece) < size:
                continue
            if at and at + len(piece) > PIECE:
                yield b"".join(held), rows
                held, rows, at = [], [], 0
            held.append(piece)
            rows.append((k, start, at, len(piece)))
            at += len(piece)
    if rows:
        yield b"".join(held), rows


def _anchors(size: int, gram: int):
    """(h, key, place, kind): 0 for an anchor met once in the task, 1 for a repeated one,
    2 for a witness of it."""

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        seen: set[bytes] = set()
        parts: list = []
        count = 0

        def out():
            h, key, place = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.argsort(h, kind="stable")
            h, key, place = h[order], key[order], place[order]
            first = np.r_[True, h[1:] != h[:-1]]
            sizes = np.diff(np.r_[np.flatnonzero(first), len(h)])
            kind = (np.repeat(sizes, sizes) > 1).astype(np.int32)
            witness = np.flatnonzero(first & (kind == 1))
            columns = (
                np.r_[h, h[witness]].view(np.int64), np.r_[key, key[witness]],
                np.r_[place, place[witness]], np.r_[kind, np.full(len(witness), 2, np.int32)],
            )
            parts.clear()
            for at in range(0, len(columns[0]), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[at : at + 100_000]) for c in columns], ["h", "key", "place", "kind"])

        for batch in batches:
            texts, keys = [], []
            for t in batch.column(0).to_pylist():
                if len(t) < size:
                    continue
                digest = hashlib.sha256(t).digest()[:16]
                if digest not in seen:
                    seen.add(digest)
                    texts.append(t)
                    keys.append(int.from_bytes(digest[:8], "little", signed=True))
            for buffer, rows in batches_of(texts, size):
                data = np.frombuffer(buffer, np.uint8)
                anchors, h = anchor_places(data, Hashes(data), size, gram)
                for k, start, at, n in rows:
                    mine = anchors[at : at + n - size + 1]
                    mine = mine[np.r_[True, mine[1:] != mine[:-1]]]
                    parts.append((h[mine], np.full(len(mine), keys[k]), mine - at + start))
                    count += len(mine)
                if count >= HELD_ANCHORS:
                    yield from out()
                    count = 0
        if parts:
            yield from out()

    return run


def _repeated(batches: Iterator) -> Iterator:
    """(key, place) of the anchors that occur twice, from rows sorted by deal and h."""
    import pyarrow as pa

    held: list = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)]

    def out(h, key, place, kind):
        first = np.r_[True, h[1:] != h[:-1]]
        sizes = np.diff(np.r_[np.flatnonzero(first), len(h)])
        pick = (kind == 1) | ((kind == 0) & (np.repeat(sizes, sizes) > 1))
        return pa.RecordBatch.from_arrays([pa.array(key[pick]), pa.array(place[pick])], ["key", "place"])

    for batch in batches:
        new = [batch.column(c).to_numpy() for c in ("h", "key", "place", "kind")]
        rows = [np.concatenate(p) for p in zip(held, new, strict=True)]
        if not len(rows[0]):
            continue
        ends = np.flatnonzero(rows[0][1:] != rows[0][:-1])
        cut = ends[-1] + 1 if len(ends) else 0
        if cut:
            yield out(*(c[:cut] for c in rows))
        held = [c[cut:] for c in rows]
    if len(held[0]):
        yield out(*held)


def _stored(size: int):
    """(key, sha, text): each text of a task once, compressed."""

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa
        import zstandard

        pack, seen = zstandard.ZstdCompressor(level=1), set()
        for batch in batches:
            rows: list = []
            for t in batch.column(0).to_pylist():
                if len(t) < size:
                    continue
                digest = hashlib.sha256(t).digest()
                if digest[:16] not in seen:
                    seen.add(digest[:16])
                    rows.append((int.from_bytes(digest[:8], "little", signed=True), digest, pack.compress(t)))
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            kinds = (pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key", "sha", "packed"])

    return run


CONTEXT = "kind int, h long, sha binary, place long, offset int, windows int, context binary, until long"


def _contexts(size: int, gram: int):
    """Rows of kind 0: the windows of one repeated anchor with their bytes; of kind 1: places
    (from, until) already known to be repeated."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard

        schema = pa.schema([
            ("kind", pa.int32()), ("h", pa.int64()), ("sha", pa.binary()), ("place", pa.int64()),
            ("offset", pa.int32()), ("windows", pa.int32()), ("context", pa.binary()), ("until", pa.int64()),
        ])
        unpack, seen = zstandard.ZstdDecompressor(), set()
        rows: list[tuple] = []
        met: dict = {}
        held = 0

        def out():
            for at in range(0, len(rows), 10_000):
                columns = zip(*rows[at : at + 10_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            rows.clear()
            met.clear()

        for batch in batches:
            texts, keys, places = [], [], []
            for sha, packed, found in zip(*(batch.column(c).to_pylist() for c in ("sha", "packed", "places")), strict=True):
                if sha[:16] not in seen:
                    seen.add(sha[:16])
                    texts.append(unpack.decompress(packed))
                    keys.append(sha)
                    places.append(np.unique(np.array(found, np.int64)))
            for buffer, pieces in batches_of(texts, size):
                data = np.frombuffer(buffer, np.uint8)
                hashes = Hashes(data)
                anchors, h = anchor_places(data, hashes, size, gram)
                whole = hashes.every(size)
                for k, start, at, n in pieces:
                    mine = anchors[at : at + n - size + 1]
                    s = np.flatnonzero(np.isin(mine - at + start, places[k]))
                    if not len(s):
                        continue
                    _, back, inverse, counts = np.unique(whole[at + s], return_index=True, return_inverse=True, return_counts=True)
                    lead = back[inverse]  # the first window of the text with this hash
                    again = np.flatnonzero(counts[inverse] > 1)
                    true = hashes.same_bytes(s[lead[again]] + at, s[again] + at, np.full(len(again), size))
                    if not true.all():  # collisions stand for themselves
                        lead[again[~true]] = again[~true]
                    twice = np.zeros(len(s), bool)
                    other = np.flatnonzero(lead != np.arange(len(s)))
                    twice[other] = twice[lead[other]] = True
                    for i, j in _runs(s[twice]):
                        rows.append((1, None, keys[k], start + i, None, None, None, start + j + size))
                    ship = s[lead == np.arange(len(s))]
                    for i, j in _runs(ship, mine[ship]):
                        c = mine[i]
                        context = buffer[at + i : at + j + size]
                        same = (int(h[c]), context)
                        row = (0, int(h[c].view(np.int64)), keys[k], start + i, int(c - at - i), j - i + 1, context, None)
                        one = met.get(same)
                        if one is None:
                            met[same] = [row[2], row[3], False]
                            rows.append(row)
                            held += len(context)
                            continue
                        if not one[2]:
                            one[2] = True
                            rows.append((1, None, one[0], one[1], None, None, None, one[1] + len(context)))
                        rows.append((1, None, keys[k], start + i, None, None, None, start + j + size))
                if held > HELD_BYTES:
                    yield from out()
                    held = 0
        yield from out()

    return run


def _runs(places, kind=None):
    """(first, last) of neighbouring places, of one kind each."""
    if not len(places):
        return []
    cut = places[1:] != places[:-1] + 1
    if kind is not None:
        cut |= kind[1:] != kind[:-1]
    cuts = np.flatnonzero(cut) + 1
    return list(zip(places[np.r_[0, cuts]].tolist(), places[np.r_[cuts, len(places)] - 1].tolist(), strict=True))


def repeated_windows(group, contexts: list[bytes], offset, windows, size: int = SIZE):
    """Which windows of contexts of one group, neighbours in ``group``, are equal to another.

    ``offset`` is where the anchor stands in a context, ``windows`` how many start in it.
    Contexts of a group are all different.  A mark for each window, context after context.
    """
    n = len(contexts)
    length = np.fromiter(map(len, contexts), np.int64, n)
    start = np.cumsum(length) - length
    hashes = Hashes(np.frombuffer(b"".join(contexts), np.uint8))
    base = np.cumsum(windows) - windows
    edge = np.zeros(int(windows.sum()) + 1, np.int64)
    cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[cuts, n])
    members = np.repeat(sizes, sizes)

    pick = np.flatnonzero((members > 1) & (members <= PAIRED))
    if len(pick):
        order, common = suffix_sort(hashes, (start + offset)[pick], (start + length)[pick], group[pick])
        at, own = pick[order], group[pick]
        reach = np.full(len(at), np.iinfo(np.int64).max)
        for k in range(1, int(members[pick].max())):
            i = np.flatnonzero(own[k:] == own[:-k])  # all pairs k apart in sorted order
            if not len(i):
                break
            reach[i + k] = np.minimum(reach[i + k], common[i + 1])  # least of what lies between
            right = reach[i + k]
            a, b = at[i], at[i + k]
            pa_, pb = start[a] + offset[a], start[b] + offset[b]
            left = hashes.extension_left(pa_, pb, np.minimum(offset[a], offset[b]))
            fits = np.flatnonzero(left + right >= size)
            sure = hashes.same_bytes((pa_ - left)[fits], (pb - left)[fits], left[fits])
            for x in fits[~sure]:  # a collision: compare from the anchor outwards
                p, q = (hashes.data[y - left[x] : y][::-1] for y in (pa_[x], pb[x]))
                left[x] = np.flatnonzero(p != q)[0]
            fits = fits[left[fits] + right[fits] >= size]
            for y in (a[fits], b[fits]):
                low = np.maximum(offset[y] - left[fits], 0)
                high = np.minimum(offset[y] + right[fits] - size, windows[y] - 1)
                some = low <= high
                np.add.at(edge, base[y[some]] + low[some], 1)
                np.add.at(edge, base[y[some]] + high[some] + 1, -1)
    marks = np.cumsum(edge[:-1]) > 0

    for at in np.flatnonzero(sizes > PAIRED):
        many = np.arange(cuts[at], cuts[at] + sizes[at])
        row = np.repeat(many, windows[many])
        step = np.arange(len(row)) - np.repeat(np.cumsum(windows[many]) - windows[many], windows[many])
        level = offset[row] - step  # equal windows have the anchor at the same place
        by = np.argsort(level, kind="stable")
        place = (start[row] + step)[by]
        order, common = suffix_sort(hashes, place, place + size, level[by])
        equal = np.flatnonzero(common >= size)
        found = by[order[np.r_[equal, equal - 1]]]
        marks[base[row[found]] + step[found]] = True
    return marks


def _equal_windows(size: int):
    """(sha, place, until) of repeated places, from contexts sorted by deal."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def out(rows: list[tuple]):
            once: dict = {}
            for n, r in enumerate(rows):
                once.setdefault((r[0], r[1], r[5]), []).append(n)
            keys = list(once)
            marks = repeated_windows(
                _numbered([k[0] for k in keys]),
                [k[2] for k in keys],
                np.array([rows[once[k][0]][3] for k in keys], np.int64),
                np.array([rows[once[k][0]][4] for k in keys], np.int64),
                size,
            )
            found, at = [], 0
            for k in keys:
                windows = rows[once[k][0]][4]
                mine = np.arange(windows) if len(once[k]) > 1 else np.flatnonzero(marks[at : at + windows])
                at += windows
                for i, j in _runs(mine):
                    for n in once[k]:
                        found.append((rows[n][2], rows[n][6] + i, rows[n][6] + j + size))
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            kinds = (pa.binary(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["sha", "place", "until"])

        held: list[tuple] = []
        size_held = 0
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("deal", "h", "sha", "offset", "windows", "context", "place")), strict=True):
                if size_held > PIECE and r[0] != held[-1][0]:
                    yield out(held)
                    held, size_held = [], 0
                held.append(r)
                size_held += len(r[5])
        if held:
            yield out(held)

    return run


def _numbered(values: list):
    """Numbers that are equal for equal neighbours."""
    x = np.array(values, np.int64)
    return np.cumsum(np.r_[0, (x[1:] != x[:-1]).astype(np.int64)])


def _dealt(contexts: DataFrame, size: int) -> DataFrame:
    """Contexts by anchor; those of an anchor with more than ``HOT`` by window."""
    hot = written(contexts.groupBy("h").count().where(F.col("count") > HOT).select("h"), "hot-anchors")
    rows = contexts.withColumn("deal", F.col("h"))
    if not hot.isEmpty():
        windows = contexts.join(hot, "h", "left_semi").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("windows") - 1)))
        window = F.substring("context", F.col("i") + 1, F.lit(size))
        windows = windows.select(
            "h", "sha", (F.col("place") + F.col("i")).alias("place"), F.lit(0).alias("offset"),
            F.lit(1).alias("windows"), window.alias("context"),
        )
        cool = rows.join(hot, "h", "left_anti")
        rows = cool.unionByName(windows.withColumn("deal", F.xxhash64("h", "context")))
    columns = ["deal", "h", "sha", "place", "offset", "windows", "context"]
    return rows.select(*columns).repartition("deal").sortWithinPartitions("deal")


def _remains(batches: Iterator) -> Iterator:
    """(sha, n_removed, n_spans, kept_sha256, spans) of texts with repeated places."""
    import hashlib

    import pyarrow as pa
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        rows = []
        for sha, packed, places in zip(*(batch.column(c).to_pylist() for c in ("sha", "packed", "places")), strict=True):
            spans: list[list[int]] = []
            for p in sorted((x["place"], x["until"]) for x in places):
                if spans and p[0] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], p[1])
                else:
                    spans.append(list(p))
            text = memoryview(unpack.decompress(packed))
            kept, at = hashlib.sha256(), 0
            for start, end in spans:
                kept.update(text[at:start])
                at = end
            kept.update(text[at:])
            rows.append((sha, sum(e - s for s, e in spans), len(spans), kept.hexdigest()))
        columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["sha", "n_removed", "n_spans", "kept_sha256"])


def repeated_places(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """(sha, place, until): places of texts, by their SHA-256, covered by strings of ``size``
    bytes that start elsewhere in other texts or in the same one.  A text's copies don't count here."""
    texts = docs.select(whole_text().cast("binary").alias("text")).where(F.octet_length("text") >= size)
    anchors = texts.mapInArrow(_anchors(size, gram), "h long, key long, place long, kind int")
    deal = F.when(F.col("kind") == 1, F.xxhash64("key", "place")).otherwise(F.col("h"))
    anchors = anchors.repartition(deal).sortWithinPartitions("h")
    known = anchors.mapInArrow(_repeated, "key long, place long")
    known = known.groupBy("key").agg(F.collect_set("place").alias("places"))  # a text's own
    stored = texts.mapInArrow(_stored(size), "key long, sha binary, packed binary")
    met = stored.join(known.hint("shuffle_hash"), "key").select("sha", "packed", "places")
    contexts = written(met.mapInArrow(_contexts(size, gram), CONTEXT), "contexts")
    rows = _dealt(contexts.where("kind = 0").drop("kind", "until"), size)
    found = rows.mapInArrow(_equal_windows(size), "sha binary, place long, until long")
    return found.unionByName(contexts.where("kind = 1").select("sha", "place", "until"))


def dedup(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row.

    A text that another row has too is removed whole if it has ``size`` bytes.  Null and
    empty texts have no bytes; rows with one id each have their row; an empty table gives
    an empty one.
    """
    places = repeated_places(docs, size, gram)
    spans = places.groupBy("sha").agg(F.collect_list(F.struct("place", "until")).alias("places"))
    texts = docs.select(whole_text().cast("binary").alias("text")).where(F.octet_length("text") >= size)
    stored = texts.mapInArrow(_stored(size), "key long, sha binary, packed binary").drop("key")
    met = stored.join(spans.hint("shuffle_hash"), "sha")
    left = met.mapInArrow(_remains, "sha binary, n_removed long, n_spans long, kept_sha256 string")
    left = left.dropDuplicates(["sha"])
    sha = F.unhex(F.sha2(whole_text(), 256))
    rows = docs.select("doc_id", F.octet_length(whole_text()).cast("long").alias("n_bytes"), sha.alias("sha"))
    copies = rows.where(F.col("n_bytes") >= size).groupBy("sha").agg(F.count("*").alias("copies"))
    texts = written(copies.join(left, "sha", "left"), "remains")
    out = rows.join(texts, "sha", "left")
    copied = F.coalesce(F.col("copies") > 1, F.lit(False))
    return out.select(
        "doc_id", "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copied, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha")))).alias("kept_sha256"),
    )
