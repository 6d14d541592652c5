"""SimHash fingerprints and components against brute force."""

from __future__ import annotations

import random

import numpy as np
import xxhash

from estrato.llm.components import components
from estrato.llm import simhash
from estrato.llm.simhash import fingerprint_of, links, near_duplicates, one_of_each


def _fingerprint(text: str) -> int:
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _roots(nodes, near):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and near(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def test_components_of_odd_links(spark):
    rng = random.Random(1)
    pairs = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    rows = [*pairs, *pairs[:9], (5, 5), (None, 3), (7, None)]
    got = {r.node: r.root for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    nodes = {x for p in pairs for x in p}
    linked = {frozenset(p) for p in pairs}
    want = _roots(sorted(nodes), lambda a, b: frozenset((a, b)) in linked)
    assert got == {n: r for n, r in want.items() if n in got}
    assert nodes - set(got) <= {a for a, b in pairs if a == b}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_connect_what_all_pairs_do(spark):
    rng = random.Random(2)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for f in list(fps)[:60]:  # chains at distances up to 6
        for _ in range(6):
            for b in rng.sample(range(64), rng.randint(1, 6)):
                f ^= 1 << b
            fps.add(f)
    f = rng.getrandbits(64)
    fps |= {f ^ (1 << a) ^ (1 << b) for a in range(14) for b in range(a)}  # a large group
    signed = [int(np.uint64(x).astype(np.int64)) for x in fps]
    got = {r.node: r.root for r in components(links(spark.createDataFrame([(x,) for x in signed], "fp long"))).collect()}
    mask = (1 << 64) - 1
    want = _roots(sorted(signed), lambda a, b: ((a ^ b) & mask).bit_count() <= 4)
    assert {n: got.get(n, n) for n in signed} == want


def test_documents(spark):
    rng = random.Random(3)
    words = ["Aa", "bb", "é", "C\x85c", "dd.", "ee", "\x1cq"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(120)]
    texts += [t.upper() for t in texts[:10]] + [t + " zz" for t in texts[:40]] + ["", None, "one", "one two\tthree", "x " * 9000]
    rows = [(i * 3 % 997, t) for i, t in enumerate(texts)] + [(4, "dup dup"), (4, "dup dup"), (None, texts[0]), (None, "alone here now")]
    for t in texts:
        got = fingerprint_of((t or "").encode())
        assert got & ((1 << 64) - 1) == _fingerprint(t or "")
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, fp int")
    fps = {_fingerprint(t or "") for _, t in rows}
    root = _roots(sorted(fps), lambda a, b: (a ^ b).bit_count() <= 4)
    least: dict = {}
    for i, t in rows:
        r = root[_fingerprint(t or "")]
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    want = sorted(str((i, _fingerprint(t or ""), least[root[_fingerprint(t or "")]])) for i, t in rows)
    got = [(r.doc_id, r.fp & ((1 << 64) - 1), r.component_id) for r in near_duplicates(docs).collect()]
    assert sorted(map(str, got)) == want
    assert near_duplicates(docs.limit(0)).count() == 0


def test_one_of_each_group_stays(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choices(vocabulary, k=rng.randint(80, 200))) for _ in range(60)]
    near = [t + " one more" for t in base[:20]]  # far above 0.8, a few bits apart
    rows = [(i, t, "en", 1) for i, t in enumerate(base)] + [(100 + i, t, "en", 2) for i, t in enumerate(near)]
    rows += [(200, base[3], "de", 3), (200, base[3], "de", 3), (7, base[7], "x", 4), (None, base[9], "x", 5)]
    rows += [(300, "", "x", 6), (301, None, "x", 7), (302, "short one", "x", 8), (303, "other one", "x", 9)]
    rows += [(None, "only without an id " * 9, "x", 10), (None, "only without an id " * 9, "y", 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hash string, _stays int").repartition(3)
    got = one_of_each(docs)
    assert got.columns == docs.columns
    stayed = [(r.doc_id, r.text) for r in got.collect()]
    want = {(i, t) for i, t in enumerate(base)} | {(300, ""), (302, "short one"), (303, "other one"), (None, rows[-1][1])}
    assert {x for x in stayed if x[0] is None or x[0] < 100 or x[0] >= 300} == want
    assert len(stayed) == len(set(stayed))
    # a near copy stays only where its fingerprint is further away than the bound
    far = {100 + i for i, t in enumerate(near) if (fingerprint_of(t.encode(), 5) ^ fingerprint_of(base[i].encode(), 5)).bit_count() > 7}
    assert {i for i, _ in stayed if i is not None and 100 <= i < 300} <= far and len(far) < 10
    assert one_of_each(docs.limit(0)).count() == 0


def _shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def _alike(p, q):
    return len(p & q) >= 0.8 * len(p | q)


def test_copies_just_above_the_threshold_go(spark):
    rng = random.Random(11)
    texts = []
    for _ in range(300):
        a = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(60, 300))]
        b, s = list(a), _shingles(" ".join(a))
        while True:  # change words as long as 0.8 is left
            c = list(b)
            c[rng.randrange(len(c))] = f"x{rng.randrange(5000)}"
            if not _alike(s, _shingles(" ".join(c))):
                break
            b = c
        texts += [" ".join(a), " ".join(b)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    stayed = {r.doc_id for r in one_of_each(docs).collect()}
    sets = list(map(_shingles, texts))
    assert all(_alike(sets[i], sets[i + 1]) for i in range(0, 600, 2))
    assert {i for i in range(0, 600, 2)} <= stayed
    assert sum(i in stayed for i in range(1, 600, 2)) <= 15  # 95% are found


def test_a_family_of_hundreds_is_joined_by_verified_links_only(spark):
    rng = random.Random(12)
    frame = [f"w{i}" for i in range(300)]

    def other(words, n, tag):
        words = list(words)
        for at in rng.sample(range(len(words)), n):
            words[at] = f"{tag}{rng.randrange(10**6)}"
        return words

    texts = []
    for _ in range(100):  # much alike inside a triple, below 0.8 across
        a = other(frame, 6, "y")
        texts += [" ".join(a), " ".join(other(a, 3, "z")), " ".join(other(a, 3, "z"))]
    sets = list(map(_shingles, texts))
    n = len(texts)
    alike = {(i, j) for j in range(n) for i in range(j) if _alike(sets[i], sets[j])}
    assert 200 <= len(alike) < 2000
    root = _roots(range(n), lambda i, j: (i, j) in alike)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    stayed = {r.doc_id for r in one_of_each(docs).collect()}
    assert set(root.values()) <= stayed and len(stayed) <= len(set(root.values())) * 1.05


def _family(rng, n):
    """Signed fingerprints of which many share variants and differ in a few bits."""
    base = [rng.getrandbits(64) for _ in range(3)]
    out = set()
    while len(out) < n:
        x = rng.choice(base)
        for _ in range(rng.randrange(7)):
            x ^= 1 << rng.randrange(22)  # in the first segment, so that the others stay whole
        out.add(x - (1 << 64) if x >> 63 else x)
    return sorted(out)


def test_large_groups_are_dealt_out_in_blocks(spark, monkeypatch):
    rng = random.Random(13)
    fps = _family(rng, 500)
    rows = spark.createDataFrame([(f,) for f in fps], "fp long").repartition(7)
    near = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    want = _roots(fps, lambda a, b: (a, b) in near)
    monkeypatch.setattr(simhash, "SPLIT", 12)
    got = {tuple(sorted((r.a, r.b))) for r in simhash.links(rows).collect()}
    assert got <= near and _roots(fps, lambda a, b: (a, b) in got) == want
    # every group that is compared is bounded, and no pair of a group is lost
    large = simhash.variants(rows).groupBy("key").count().where("count > 12").select("key")
    members = simhash.variants(rows).join(large, "key")
    met = simhash.blocks_met(members, "fp")
    sizes = [r["count"] for r in met.groupBy("key").count().collect()]
    assert max(sizes) <= 5 * 12 and len(sizes) > 10
    groups, pairs = {}, {}
    for r in members.collect():
        groups.setdefault(r.key, []).append(r.fp)
    for r in met.collect():
        pairs.setdefault(r.key, []).append(r.fp)
    together = {(a, b) for g in pairs.values() for a in g for b in g}
    assert all((a, b) in together for g in groups.values() for a in g for b in g)


def test_groups_come_whole_or_as_large(spark):
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    key = np.sort(rng.choice(40, 600, p=np.r_[0.4, np.full(39, 0.6 / 39)])).astype(np.int64)
    value = np.arange(600)
    for step in (1, 7, 50, 600):
        batches = [pa.RecordBatch.from_arrays([pa.array(key[i : i + step]), pa.array(value[i : i + step])], ["key", "v"]) for i in range(0, 600, step)]
        whole, large = {}, []
        for (k, v), is_whole in simhash.in_groups(iter(batches), 30):
            for x in np.unique(k).tolist():
                mine = v[k == x].tolist()
                if is_whole:
                    assert x not in whole
                    whole[x] = mine
                else:
                    large += [(x, y) for y in mine]
        sizes = np.bincount(key, minlength=40)
        assert {x: v for x, v in whole.items()} == {x: value[key == x].tolist() for x in range(40) if 0 < sizes[x] <= 30}
        assert large == [(int(k), int(v)) for k, v in zip(key, value, strict=True) if sizes[k] > 30]
    assert list(simhash.in_groups(iter([]), 30)) == []


def test_a_family_of_hundreds_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SPLIT", 20)
    test_a_family_of_hundreds_is_joined_by_verified_links_only(spark)
