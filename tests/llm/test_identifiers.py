"""Personal data against plain regular expressions and a plain run of the rounds."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest
from conftest import SF

from estrato.llm.common import table
from estrato.llm.identifiers import KINDS, ROUNDS, SMOOTH, SUPPORT, TRUST, digest, identifiers
from estrato.llm.queries import op13_identifiers

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _base(text):
    out = []
    for kind in KINDS:
        for m in re.finditer(PLAIN[kind], text):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {
                "email": lambda m=m: True, "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda d=digits: 13 <= len(d) <= 19 and _luhn(d), "phone": lambda d=digits: 9 <= len(d) <= 15,
            }
            if fine[kind]():
                out.append((kind, m.start(), m.end()))
    return out


NUMBER = r"[()+./-]*[0-9][0-9()+./-]*"
CANDIDATE = rf"(?<!\S)(?:{NUMBER}(?: {NUMBER})+(?=[\s,;:!?]|$)|[^\s0-9@(\[]*(?:[0-9@]|[(\[]at[)\]])\S*)"


def _candidates(text, base):
    out = []
    for m in re.finditer(CANDIDATE, text, re.ASCII):
        start = m.start() + len(m[0]) - len(re.sub(r"""^["'<\[{]+""", "", m[0]))
        end = start + len(re.sub(r"""[>"'\]},;:!?.]+$""", "", text[start : m.end()]))
        if end > start and not any(b < end and start < e for _, b, e in base):
            out.append((start, end))
    return out


def _fits(kind, value):
    mail = bool(re.search(r"@|[(\[]at[)\]]", value))
    return mail if kind == "email" else not mail and len(re.sub("[^0-9]", "", value)) >= 4


def _plain(docs):
    """(doc_id, base, all spans) of each row, by rounds over dictionaries."""
    places, seeds = [], defaultdict(set)
    for n, (_, text) in enumerate(docs):
        text = text or ""
        base = _base(text)
        for kind, start, end in [*base, *((None, *c) for c in _candidates(text, base))]:
            before = re.sub(r"\s+", " ", re.sub("[0-9]", "0", text[max(0, start - 64) : start].lower()), flags=re.ASCII).strip(" ")
            words = before.split(" ")[-2:]
            value = text[start:end].lower()
            if kind:
                seeds[value].add(kind)
            places += [(n, kind, start, end, value, p) for p in {words[-1], " ".join(words)} if p]
    edges = {(p, v) for *_, v, p in places}
    values = defaultdict(dict)
    for v, kinds in seeds.items():
        values[v] = {k: float(k in kinds) for k in KINDS}
    of_pattern = defaultdict(set)
    for p, v in edges:
        of_pattern[p].add(v)
    score = {}
    for _ in range(ROUNDS):
        score = {}
        for p, vs in of_pattern.items():
            sums = {k: sum(values[v].get(k, 0.0) for v in vs) for k in KINDS}
            score[p] = {k: s / (len(vs) + SMOOTH) if s >= SUPPORT else 0.0 for k, s in sums.items()}
        for p, v in edges:
            if v not in seeds:
                for k in KINDS:
                    if _fits(k, v):
                        values[v][k] = max(values[v].get(k, 0.0), score[p][k])
    trusted = {}
    for p, s in score.items():
        kind = max(KINDS, key=lambda k: (s[k], -KINDS.index(k)))
        if s[kind] >= TRUST:
            trusted[p] = (s[kind], kind)
    new = defaultdict(list)
    for n, kind, start, end, v, p in places:
        if kind is None and p in trusted and _fits(trusted[p][1], v):
            new[n, start, end].append((trusted[p][0], -KINDS.index(trusted[p][1])))
    out = []
    for n, (d, text) in enumerate(docs):
        base = _base(text or "")
        added = [(KINDS[-max(best)[1]], s, e) for (m, s, e), best in new.items() if m == n]
        everything = sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
        joined = [",".join(f"{k}:{s}:{e}" for k, s, e in x) for x in (base, everything)]
        counts = [sum(k == kind for k, *_ in base) for kind in KINDS]
        out.append((d, *counts, hashlib.sha256(joined[0].encode()).hexdigest(), joined[1]))
    return sorted(out, key=str)


def test_whole_table(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    got = sorted(map(tuple, op13_identifiers(spark, sf).collect()), key=str)
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    assert got == _plain(docs)
    assert sum(sum(r[1:5]) for r in got) > 50


def test_plan_is_native(spark):
    plan = op13_identifiers(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|InArrow|InPandas|Cartesian|NestedLoop", plan)


ODD = [
    "a@b.c_d@e.fr", "x..y@z", "a@b.c.d.", "a@b@c.de", "@b.com", "a%b+c-d._@q-q.9.z and é@x.yy é.a@x.yy",
    "1.2.3.4.5.6.7.8", "01.002.255.256 0.0.0.0 1.2.3. 1.2.3.4.", "999999999999.1.1.1 12.1.1.1.1",
    "4242 4242 4242 4242", "4242-4242-4242-4242-1", "4242  4242 4242 4242 4242", "79927398713 0000000000000 1 2 3",
    "9" * 5000, "+" * 3000, "4111111111111111" * 3, "4242424242424242 4242424242424242", "+1 (988) 555-2485", "+49.30.123456-78 +1 2",
    "++1 222 333 444 5", "+1 ((((((((222333444", "+1234567890123456", "+12345678.", "", None, " ", "\n\n", "😀 4242424242424242 😀a@b.co",
    ("mail7@x.org " * 2000), "." * 4000, "a" * 20000 + "@", "1." * 8000, "0 " * 4000, "1-" * 4000 + "2",
]


def test_odd_texts(spark):
    rng = random.Random(2)
    alphabet = "aB1 23.@+-()é\n_%4"
    docs = [(i, t) for i, t in enumerate(ODD)] + [(None, "a@b.co"), (None, None), (1, ODD[1])]
    docs += [(1000 + i, "".join(rng.choices(alphabet, k=rng.randrange(60)))) for i in range(400)]
    rows = [(d, t, 1, "x") for d, t in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, base int, spans string").repartition(4)
    assert sorted(map(tuple, digest(identifiers(df).rows).collect()), key=str) == _plain(docs)
    assert digest(identifiers(df.limit(0)).rows).collect() == []


@pytest.fixture(scope="module")
def cued():
    rng = random.Random(3)
    fill = "rain falls on the hills and old rivers run to a far sea by night".split()
    some = lambda: " ".join(rng.choices(fill, k=rng.randrange(4, 12)))
    phone = lambda: f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
    docs = []
    for i in range(30):
        docs.append((i, f"{some()} write to e-mail user{i}@mail{i % 4}.org {some()} or ring me at {phone()} {some()}"))
    docs += [(100 + i, f"{some()} write to e-mail hidden{i}(at)mail.org {some()}") for i in range(3)]
    docs.append((200, f"{some()} ring me at (988) 555-2485. {some()} reach me under 0171 2345678, {some()}"))
    docs += [(300 + i, f"{some()} pager no 0171 {i}{i}45{i}78 {some()}, ring me at 0171 {i}{i}45{i}78 now") for i in range(6)]
    docs.append((400, f"{some()} pager no 0999 123456 {some()}"))  # a pattern that only found values have taught
    docs += [(500 + i, f"the year {1900 + i} and the {rng.choice(fill)} {phone() if i % 3 else i}") for i in range(30)]
    docs += [(600 + i, docs[0][1]) for i in range(20)]  # copies teach nothing more
    return docs


def test_contexts_find_unseen_identifiers(spark, cued):
    df = spark.createDataFrame(cued, "doc_id long, text string").repartition(3)
    found = identifiers(df)
    rows = sorted(map(tuple, digest(found.rows).collect()), key=str)
    assert rows == _plain(cued)
    texts = dict(cued)
    added = {r.doc_id: [(KINDS[s.kind - 1], texts[r.doc_id][s.start : s.end]) for s in r.added] for r in found.rows.collect()}
    for i in range(3):
        assert ("email", f"hidden{i}(at)mail.org") in added[100 + i]
    assert ("phone", "(988) 555-2485") in added[200]
    assert ("phone", "0999 123456") in added[400]
    assert not any(added[500 + i] for i in range(30)) and not any(added[600 + i] for i in range(20))
