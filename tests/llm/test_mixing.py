"""The mix against its SQL and against the rules of the contract."""

from __future__ import annotations

from collections import defaultdict

import pytest
from conftest import SF
from oracle import duck_rows, spark_rows

from estrato.llm.mixing import cyclic_weight, mix, ranked_sources
from estrato.llm.queries import OP2_SQL, op2_mixing


def _weight(sources):
    return ranked_sources(sources).withColumn("weight", cyclic_weight(3, 1, 2)).drop("rank")


def _filled(sizes: dict, share: float = 1.5):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    free, left = set(sizes), share * sum(sizes.values())
    full: dict = {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] >= 2 * sizes[s]}
        if not over:
            break
        full |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2.0 * sizes[s] for s in over)
        free -= over
    return full | {s: level * weight[s] for s in free}


def test_matches_sql(spark):
    assert spark_rows(op2_mixing(spark, SF)) == duck_rows(SF, OP2_SQL)


@pytest.mark.parametrize("rows", [
    [(1, "a b c", "s"), (2, None, "s"), (3, "", None), (None, "x y", None), (5, "d", "t"), (5, "d", "t")],
    [(i, "w " * (i % 9), ("é", "z", None, "a", "b")[i % 5 if i % 3 else 0]) for i in range(200)],
    [(1, "only\x0bwords\x85here", "s")],
    [(1, "", "s"), (2, None, "t")],
])
def test_targets_are_met(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = docs.selectExpr("*", "1 as size", "'x' as target").drop("size", "target")
    got = mix(docs, _weight).collect()
    assert len(got) == len(rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"]
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
    want = _filled(dict(sizes))
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= 0.5
    again = mix(docs.repartition(3), _weight).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix(docs, _weight).count() == 0
