"""Template decontamination against brute force."""

from __future__ import annotations

import random
import re

from conftest import SF

from estrato.llm.common import table
from estrato.llm.decontamination import SLOT, clean, leaks, longest_chain, marked, template_words, valued_words
from estrato.llm.queries import op6_decontamination


def _shingles(text):
    w = re.findall(r"\w+", text.lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_templates(spark):
    from pyspark.sql import functions as F

    texts = ["Ann has 3 apples and 4,5 kg of flour, says Bob.", "No NUMBERS here", "", "then Zoë ran 10km in 2 hours"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    m = marked(F.col("text"))
    got = rows.select("text", template_words(m).alias("t"), valued_words(m).alias("v")).collect()
    t = {r.text: [w.replace(SLOT, "$") for w in r.t] for r in got}
    assert t[texts[0]] == ["ann", "has", "$n", "apples", "and", "$n", "$u", "of", "flour", "says", "$p"]
    assert t[texts[1]] == ["no", "numbers", "here"]
    assert t[texts[2]] == []
    assert t[texts[3]] == ["then", "$p", "ran", "$n", "$u", "in", "$n", "$u"]
    assert all(len(r.t) == len(r.v) for r in got)


def test_other_values_are_found_if_consistent(spark):
    item = "a farmer has 12 sheep and sells 5 sheep to a friend so how many of the 12 sheep does the farmer keep"
    docs = [
        (1, "noise before " + item + " noise after"),
        (2, "x " + item.replace("12", "80").replace("5", "7") + " y"),  # other numbers, consistent
        (3, "x " + item.replace("12", "80", 1) + " y"),  # 80 and then 12 where the item has 12 twice
        (4, "a farmer has 12 sheep and nothing else of this question is here at all"),
        (5, None), (6, ""), (None, item.upper()), (7, item), (7, item), (8, "word " * 3000 + item),
        (9, item.replace("friend", "neighbour")),  # one word of twenty: below 0.8 of the windows
        (10, item.replace(" to a friend", ", to  a\nfriend!")),  # signs and blanks don't count
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, _hash string")
    bench = spark.createDataFrame(
        [(70, item), (71, "too short"), (72, None), (None, item), (73, ""), (74, "1 2 3 4 5 6 7 8 9")], "item_id long, text string"
    )
    got = {(r.doc_id, r.item_id) for r in leaks(docs, bench).collect()}
    n = len(_shingles(item))
    near = len(_shingles(item) & _shingles(item.replace("friend", "neighbour"))) / n
    want = {1, 2, None, 7, 8, 10} | ({9} if near >= 0.8 else set())
    assert got == {(i, 70) for i in want}
    left = clean(docs, bench)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({3, 4, 5, 6, 9} - want)
    assert leaks(docs.limit(0), bench).count() == 0
    assert leaks(docs, bench.limit(0)).count() == 0 and clean(docs, bench.limit(0)).count() == docs.count()


def test_items_of_values_only_need_the_same_values(spark):
    bench = spark.createDataFrame([(1, "11 22 33 44 55 66 77")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "see 11 22 33 44 55 66 77 there"), (2, "see 12 23 34 45 56 67 78 there")], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in leaks(docs, bench).collect()] == [(1, 1)]


def test_matches_plain_shingles_where_there_are_no_values(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    got = {(r.doc_id, r.item_id) for r in op6_decontamination(spark, sf).collect()}
    items = {r.item_id: _shingles(r.text) for r in table(spark, sf, "benchmark").collect()}
    want = set()
    for r in table(spark, sf, "documents").collect():
        mine = _shingles(r.text or "")
        want |= {(r.doc_id, i) for i, s in items.items() if s and len(s & mine) >= 0.8 * len(s)}
    assert want <= got and len(got - want) <= 1


def test_many_repeats(spark):
    rng = random.Random(1)
    item = " ".join(rng.choices([f"w{i}" for i in range(50)], k=30))
    docs = spark.createDataFrame([(1, (item + " ") * 300), (2, " ".join(item.split()[:20]))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, item)], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id, r.similarity) for r in leaks(docs, bench).collect()) == [(1, 1, 1.0), (1, 2, 1.0)]


def test_one_odd_slot_costs_its_windows_only(spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(54)]
    words[10] = words[40] = "12"
    words[25] = "7"
    item = " ".join(words)

    def with_values(first, second, other):
        return " ".join([*words[:10], first, *words[11:25], other, *words[26:40], second, *words[41:]])

    docs = [
        (1, with_values("12", "15", "7")),  # verbatim but for one number
        (2, with_values("9", "9", "9")),  # new values that happen to be equal
        (3, with_values("9", "9", "8")),
        (4, with_values("9", "8", "6")),  # one of two new values is odd: 5 of 50 windows
    ]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: (r.matched, r.windows) for r in leaks(docs, bench).collect()}
    assert got == {1: (45, 50), 2: (50, 50), 3: (50, 50), 4: (45, 50)}


def test_copies_in_other_case_are_found(spark):
    item = (
        "in the spring Natalia sold clips to some of her friends and then Robert bought 48 clips "
        "from JavaScript fans while Natalia made half as many of them again in May"
    )
    short = "Count all the red apples there"
    docs = [(1, item), (2, item.lower()), (3, item.title()), (4, item.upper()), (5, "then they said " + short), (6, item[: len(item) // 2].lower())]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, short)], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.similarity) for r in leaks(docs, bench).collect()}
    assert got == {(1, 1, 1.0), (2, 1, 1.0), (3, 1, 1.0), (4, 1, 1.0), (5, 2, 1.0)}


def test_parts_and_lists_are_not_whole_items(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(50)]
    item = " ".join(rng.choices(words, k=30))
    labels = "apple pear plum fig kiwi lime date nut".split()
    prices = "prices were " + " ".join(f"{labels[i % 8]} {11 + i}" for i in range(14))
    names = [f"{a}{b}" for a in "bdfgklm" for b in ("an", "el", "ip", "or", "um")]
    plain = " ".join(names[:30])
    halves = [" ".join(names[:15]), " ".join(names[15:30])]
    listed = "stock list " + " ".join(f"{rng.choice(labels)} {rng.randrange(90)}" for _ in range(3000))
    docs = [
        (1, item), (2, " ".join(item.split()[:20])), (3, " ".join(item.split()[:12])), (4, " ".join(item.split()[9:21]) + " x " + item.split()[0]),
        (5, prices), (6, " ".join(prices.split()[:16])), (7, listed), (8, "x " * 400 + prices.replace("pear 12", "pear 99")),
        (9, plain), (10, f"{halves[1]} {halves[0]}"), (11, f"{halves[0]} and then {halves[1]}"), (12, f"{halves[0]} {'z ' * 5000} {halves[1]}"),
        (13, " ".join([halves[0]] * 40)), (14, "w12 " * 500), (15, " ".join(f"{w} {i}" for i, w in enumerate(labels * 50))),
    ]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, prices), (3, plain)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in leaks(docs, bench).collect()}
    assert set(got) == {(1, 1), (5, 2), (8, 2), (9, 3), (11, 3), (15, 2)}  # 15 is the list with other numbers
    assert got[1, 1] == got[5, 2] == got[9, 3] == 1.0 and got[11, 3] == 22 / 26


def test_numbers_begin_at_a_word(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([("w12 12w 3x4 5 1st 10km 7%",)], "text string")
    got = rows.select(template_words(marked(F.col("text"))).alias("t")).first().t
    assert [w.replace(SLOT, "$") for w in got] == ["w12", "12w", "3x4", "$n", "1st", "$n", "$u", "$n", "$u"]


def test_longest_chain(spark):
    from pyspark.sql import functions as F

    rng = random.Random(8)

    def plain(pairs):
        best = {}
        for p in sorted(pairs):
            best[p] = 1 + max((n for q, n in best.items() if q[0] < p[0] and q[1] < p[1]), default=0)
        return max(best.values(), default=0)

    cases = [[(rng.randrange(12), rng.randrange(12)) for _ in range(rng.randrange(1, 30))] for _ in range(60)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, p array<struct<place:int,at:int>>")
    got = {r.i: r.n for r in df.select("i", longest_chain(F.col("p")).alias("n")).collect()}
    assert got == {i: plain(c) for i, c in enumerate(cases)}


def test_each_window_is_hashed_as_the_benchmark_is_and_words_are_cut_once(spark):
    from estrato.llm.decontamination import _aligned_windows, _window_hashes

    texts = [
        "then Ann has 3 apples and 4,5 kg of flour, says Bob.", "no number or name at all here", "four words are short", "five words are just enough",
        "", None, "1 2 3 4 5 6", "so İpek ran 10km to ÉTÉ and Zoë 7% in 2 hours", "x " * 40,
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    mine = _window_hashes(rows, "doc_id")
    windows = _aligned_windows(rows, "doc_id").select("doc_id", "hash", "plain_hash")
    want = windows.select("doc_id", "hash").union(windows.where("hash != plain_hash").select("doc_id", "plain_hash"))
    assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, want.collect())) and mine.count()
    plan = mine._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and plan.count("regexp_replace") == 3
    item = "the old man walked down to the river and sat there for hours"
    docs = [(1, f"\u0001{item}\u0001"), (2, f"\u0002n\u0001{item} \u0002p\u0001 end"), (3, "\u0001 \u0002n")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {2} <= {r.doc_id for r in leaks(docs, bench).collect()} <= {1, 2}
