"""Embedding near-duplicates by an inverted multi-index.

Each half of a unit vector has a codebook of its own; a pair of centroids is a cell, the
cells a product grid.  Every distinct vector is filed under its nearest cell and looks into
the cells that a multi-sequence traversal reaches first, as many as a target recall takes:
the number is learned from neighbours at the threshold, the hardest there are.  What is met
in a cell is verified by its cosine in double precision.

A pair may be met from both sides.  Whether the other side looks into one's cell follows
from the codebooks, so a pair met from one side only is counted for both and no pair is
gathered twice.  Copies of a vector are filed once.  Large cells are dealt out in blocks of
members and shares of lookers; a block gives a count for each vector and links to one
representative, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.llm.components import components
from estrato.session import written

LEAST_COSINE = 0.93
#: Vectors that the codebooks are fitted on at most, and that the number of cells is learned from.
SAMPLE = 20_000
PROBED = 1_000
TARGET_RECALL = 0.995
#: Vectors of the largest label in a cell on average.
CELL = 64
MOST_CENTROIDS = 256
#: Members of a cell in one block, and lookers in one share.
BLOCK = 4_096
SHARE = 16_384
#: Lookers compared at a time.
AT_ONCE = 256


class Grid(NamedTuple):
    """Codebooks of both halves and the number of cells to look into."""

    first: object
    second: object
    probes: int


def distances(x, codebook):
    """Squared distances of rows to centroids; the same for a row in whatever company."""
    import numpy as np

    out = np.empty((len(x), len(codebook)))
    for at in range(0, len(x), 4096):
        out[at : at + 4096] = ((x[at : at + 4096, None, :] - codebook[None]) ** 2).sum(-1)
    return out


def multi_sequence(first, second, count: int) -> list[tuple[int, int]]:
    """The ``count`` cells with the least sum of distances, nearest first.

    Both halves are sorted; a heap holds the next candidates, and (i, j) comes in when
    (i-1, j) and (i, j-1) have gone.
    """
    import heapq

    import numpy as np

    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, seen, out = [(first[a[0]] + second[b[0]], 0, 0)], {(0, 0)}, []
    while heap and len(out) < count:
        _, i, j = heapq.heappop(heap)
        out.append((int(a[i]), int(b[j])))
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (first[a[x]] + second[b[y]], x, y))
    return out


def kmeans(x, k: int, rounds: int = 12, seed: int = 0):
    import numpy as np

    rng = np.random.default_rng(seed)
    centroids = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        home = distances(x, centroids).argmin(1)
        for c in range(len(centroids)):
            if (mine := x[home == c]).size:
                centroids[c] = mine.mean(0)
    return centroids


def fit(x, largest: int, least: float = LEAST_COSINE, seed: int = 0) -> Grid:
    """Codebooks from a sample ``x`` of unit vectors, for labels of up to ``largest`` vectors;
    the number of cells such that neighbours at the threshold are met from a side."""
    import numpy as np

    half = x.shape[1] // 2
    k = int(min(MOST_CENTROIDS, max(2, np.ceil(np.sqrt(largest / CELL)))))
    first, second = kmeans(x[:, :half], k, seed=seed), kmeans(x[:, half:], k, seed=seed + 1)
    rng = np.random.default_rng(seed)
    near = x[rng.integers(0, len(x), PROBED)]
    away = rng.normal(size=near.shape)
    away -= (away * near).sum(1, keepdims=True) * near
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-12)
    other = least * near + np.sqrt(1 - least**2) * away
    rank = np.minimum(_ranks(near, other, first, second, half), _ranks(other, near, first, second, half))
    probes = int(np.quantile(rank, TARGET_RECALL, method="higher")) + 1
    return Grid(first, second, probes)


def _ranks(x, y, first, second, half):
    """How many cells are nearer to x than the cell that y is filed under."""
    import numpy as np

    out = []
    a, b = distances(x[:, :half], first), distances(x[:, half:], second)
    i, j = distances(y[:, :half], first).argmin(1), distances(y[:, half:], second).argmin(1)
    for n in range(len(x)):
        out.append(int(((a[n][:, None] + b[n][None]) < a[n, i[n]] + b[n, j[n]]).sum()))
    return np.array(out)


def _units(rows: list, width: int):
    """Unit vectors in double precision, shorter ones padded with zeros."""
    import numpy as np

    x = np.zeros((len(rows), width))
    for n, row in enumerate(rows):
        x[n, : len(row)] = row
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def comparable(embedding: str, label: str, vec_id: str) -> Column:
    """Whether a row can have links at all."""
    fine = F.forall(embedding, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    some = F.exists(embedding, lambda v: v != 0)
    return F.coalesce(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & fine & some, F.lit(False))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(node, label, embedding, copies, least): each vector of a label once, numbered."""
    once = rows.groupBy("label", "embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    return written(once.withColumn("node", F.monotonically_increasing_id()), "vectors")


def learn(vectors: DataFrame, least: float = LEAST_COSINE) -> tuple[Grid, int]:
    """The grid and the width of the vectors; only a bounded sample comes to the driver."""
    width = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0
    largest = vectors.groupBy("label").count().agg(F.max("count"), F.sum("count")).first()
    if not width:
        return Grid(None, None, 0), 0
    width += width % 2
    share = min(1.0, SAMPLE / largest[1])
    drawn = F.pmod(F.xxhash64(F.lit("grid"), "embedding"), F.lit(2**31)) < int(share * 2**31)
    sample = vectors.where(drawn if share < 1 else F.lit(True)).orderBy("label", "least")
    x = _units([r.embedding for r in sample.select("embedding", "label", "least").collect()], width)
    return fit(x, largest[0], least), width


def filed(vectors: DataFrame, grid: Grid, width: int) -> DataFrame:
    """(node, label, cell, home, role, copies, embedding): a row with role 0 for the cell that
    a vector is filed under, with role 1 for each that it looks into."""
    rows = vectors.select("node", "label", "copies", "embedding")
    fields = "node long, label long, copies long, cell int, home int, role int, embedding " + dict(rows.dtypes)["embedding"]

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        k = len(grid.second)
        for batch in batches:
            x = _units(batch.column("embedding").to_pylist(), width)
            a, b = distances(x[:, : width // 2], grid.first), distances(x[:, width // 2 :], grid.second)
            home = a.argmin(1) * k + b.argmin(1)
            at, cell, role = [], [], []
            for n in range(len(x)):
                seen = multi_sequence(a[n], b[n], grid.probes)
                at += [n] * (len(seen) + 1)
                cell += [int(home[n]), *(i * k + j for i, j in seen)]
                role += [0, *([1] * len(seen))]
            took = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([
                took.column("node"), took.column("label").cast(pa.int64()), took.column("copies"),
                pa.array(cell, pa.int32()), pa.array(home[np.array(at, int)], pa.int32()), pa.array(role, pa.int32()),
                took.column("embedding"),
            ], ["node", "label", "copies", "cell", "home", "role", "embedding"])

    return rows.mapInArrow(run, fields)


def dealt(rows: DataFrame) -> DataFrame:
    """Deal large cells out: members to blocks, lookers to shares, each block meeting each
    share.  Sorted so that the members of a block come first."""
    sizes = rows.groupBy("label", "cell").agg(
        F.ceil(F.count_if(F.col("role") == 0) / BLOCK).cast("int").alias("blocks"),
        F.ceil(F.count_if(F.col("role") == 1) / SHARE).cast("int").alias("shares"),
    )
    sizes = written(sizes.where((F.col("blocks") > 0) & (F.col("shares") > 0)), "cells")
    rows = rows.join(sizes, ["label", "cell"])
    pick = F.hash("node")
    member = F.col("role") == 0
    block = F.when(member, F.array(F.pmod(pick, "blocks"))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    share = F.when(member, F.sequence(F.lit(0), F.col("shares") - 1)).otherwise(F.array(F.pmod(pick, "shares")))
    rows = rows.withColumn("block", F.explode(block)).withColumn("share", F.explode(share))
    group = ["label", "cell", "block", "share"]
    return rows.drop("blocks", "shares").repartition(*group).sortWithinPartitions(*group, "role", "node")


def least_reached(n: int, a, b):
    """The least index reachable from each of n nodes over the links a-b."""
    import numpy as np

    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if np.array_equal(label, before):
            return label


class _Block:
    """The members of a block, and what its lookers have linked so far."""

    def __init__(self, grid: Grid, width: int, rows: dict):
        import numpy as np

        self.grid, self.half, self.k = grid, width // 2, len(grid.second)
        self.node, self.copies, self.x = rows["node"], rows["copies"], rows["x"]
        self.home = rows["home"]
        self.label = np.arange(len(self.node))
        self.credit = np.zeros(len(self.node), np.int64)
        a, b = distances(self.x[:, : self.half], grid.first), distances(self.x[:, self.half :], grid.second)
        seen = [[i * self.k + j for i, j in multi_sequence(a[n], b[n], grid.probes)] for n in range(len(a))]
        self.seen = np.array(seen, np.int32)

    def look(self, rows: dict, least: float):
        """Counts and links of lookers: (node, links, linked node)."""
        import numpy as np

        near = rows["x"] @ self.x.T >= least
        near &= rows["node"][:, None] != self.node[None]
        credit = near @ self.copies
        p, m = np.nonzero(near)
        one_sided = (self.seen[m] != rows["home"][p].astype(np.int32)[:, None]).all(1)
        np.add.at(self.credit, m[one_sided], rows["copies"][p[one_sided]])
        n = len(self.node)
        reach = least_reached(n + len(near), np.r_[self.label, m], np.r_[np.arange(n), p + n])
        linked = np.flatnonzero(credit)
        to = self.node[reach[n + linked]] if len(linked) else self.node[:0]
        self.label = reach[:n]
        return rows["node"][linked], credit[linked], to

    def rest(self):
        """Counts of members met from the other side only, and links between members."""
        import numpy as np

        some = np.flatnonzero((self.credit > 0) | (self.label != np.arange(len(self.label))))
        return self.node[some], self.credit[some], self.node[self.label[some]]


def met(rows: DataFrame, grid: Grid, width: int, least: float) -> DataFrame:
    """(node, links, other): counts to add up and links that connect, of dealt rows."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def out(node, links, other):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (node, links, other)], ["node", "links", "other"])

        group, members, block = None, [], None
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in ("label", "cell", "block", "share", "role")], 1)
            if not len(key):
                continue
            data = {c: batch.column(c).to_numpy() for c in ("node", "copies", "home")}
            data["x"] = _units(batch.column("embedding").to_pylist(), width)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(key)], strict=True):
                this, role = tuple(key[start, :4]), key[start, 4]
                if this != group:
                    if block is not None:
                        yield out(*block.rest())
                    group, members, block = this, [], None
                if role == 0:
                    members.append({c: v[start:end] for c, v in data.items()})
                    continue
                if block is None and members:
                    block = _Block(grid, width, {c: np.concatenate([m[c] for m in members]) for c in members[0]})
                for at in range(start, end, AT_ONCE):
                    if block is not None:
                        chunk = slice(at, min(at + AT_ONCE, end))
                        yield out(*block.look({c: v[chunk] for c, v in data.items()}, least))
        if block is not None:
            yield out(*block.rest())

    return rows.mapInArrow(run, "node long, links long, other long")


def near_duplicates(rows: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of (vec_id, embedding, label).

    Linked are vectors of one label with a cosine of at least ``least``; a copy is a link.
    Rows with a null id, label or vector, a zero vector, or a null or non-finite component
    have no links and are their own component.  Shorter vectors are padded with zeros.  Of
    rows with one id each counts for itself; an empty table gives an empty one.
    """
    rows = rows.select("vec_id", F.col("label").cast("long").alias("label"), "embedding")
    rows = rows.withColumn("fine", comparable("embedding", "label", "vec_id"))
    vectors = distinct_vectors(rows.where("fine").drop("fine"))
    grid, width = learn(vectors, least)
    alone = rows.where(~F.col("fine")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    if not width:
        return alone.withColumn("kept", F.col("vec_id") == F.col("component_id"))
    files = written(filed(vectors, grid, width), "cells")
    found = written(met(dealt(files), grid, width, least), "vector-links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    rooted = components(found.where("node <> other").select("node", "other"))
    nodes = vectors.select("node", "copies", "least").join(counts, "node", "left").join(rooted, "node", "left")
    nodes = nodes.select(
        "node", "least", F.coalesce("root", "node").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    first = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    nodes = written(nodes.join(first, "root").select("node", "n_links", "component_id"), "vector-nodes")
    linked = rows.where("fine").join(vectors.select("node", "label", "embedding"), ["label", "embedding"])
    linked = linked.join(nodes, "node").select("vec_id", "n_links", "component_id")
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
