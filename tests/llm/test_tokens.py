"""Token counts and packed rows against the tokenizer itself."""

from __future__ import annotations

import random

import numpy as np
import pytest

from estrato.llm.packing import best_fit_decreasing, pack
from estrato.llm.pieces import count_table, encode_unit, model_path, processor, whole_tokens
from estrato.llm.token_count import token_counts

ODD = [
    "", " ", "  a", "a  b ", "\n", "a\nb", "\n\n a\n", "<s> x </s><unk>", "▁", "a▁b", "a▁▁b ▁", "\t x\r\n",
    "é́ ﬁ", "a\x00b", "😀😀 日本 語", "x" * 3000, "a " * 5000, " " * 70 + "b", "<0x41>", "the The THE",
]


def _texts():
    rng = random.Random(7)
    letters = "ab e\n\t.▁é日😀 "
    return ODD + ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(400)]


def test_words_are_counted_as_the_library_does():
    sp, table = processor(model_path()), count_table(model_path())
    for text in _texts():
        assert table.text(text) == len(sp.encode(text)), repr(text)


def test_the_shortcut_holds_for_each_proven_string():
    sp = processor(model_path())
    proven = whole_tokens(sp)
    assert len(proven) > 20_000
    for unit, i in list(proven.items())[::97]:
        assert encode_unit(sp, unit) == [i]


def test_counts_of_odd_rows(spark):
    rows = [(i, t, "x") for i, t in enumerate(_texts())] + [(None, "a b", "y"), (1, None, None), (1, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").withColumnRenamed("n_tokens", "n_bytes")
    sp = processor(model_path())
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(docs).collect())
    want = sorted(
        (i or -1, len((t or "").encode()), n := len(sp.encode(t or "")), n > 4096) for i, t, _ in rows
    )
    assert got == want
    assert token_counts(docs.limit(0)).count() == 0


def test_best_fit_takes_the_least_room():
    rng = random.Random(3)
    for capacity in (1, 7, 64, 100):
        lengths = [rng.randint(1, capacity) for _ in range(300)]
        rooms, want = [], []
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            fits = [r for r in rooms if r >= lengths[i]]
            room = min(fits) if fits else capacity
            if fits:
                rooms.remove(room)
            rooms.append(room - lengths[i])
            want.append(room)
        rows = best_fit_decreasing(lengths, capacity)
        assert sorted(i for row in rows for i in row) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in row) <= capacity for row in rows)
        assert len(rows) == len(rooms)
        assert sorted(capacity - sum(lengths[i] for i in row) for row in rows) == sorted(rooms)


@pytest.mark.parametrize("seq_len", [16, 2048])
def test_packed_rows_give_back_every_text(spark, seq_len):
    texts = _texts()
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (3, None), (7, "twice"), (7, "twice")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = pack(docs, seq_len=seq_len, block_tokens=3000, tasks=2).collect()
    sp = processor(model_path())
    pieces: dict = {}
    for r in got:
        ids = np.frombuffer(r.input_ids, "<u2")
        assert len(ids) == seq_len and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= seq_len
        assert not ids[r.n_tokens :].any()
        assert r.position_resets == r.cu_seqlens[: len(r.cu_seqlens) - (r.n_tokens == seq_len)]
        for k in range(r.n_segments):
            part = ids[r.cu_seqlens[k] : r.cu_seqlens[k + 1]].tolist()
            pieces.setdefault(r.doc_ids[k], []).append((r.parts[k], part))
    for i, t in enumerate(texts):
        if i in (3, 7):
            continue
        parts = sorted(pieces.get(i, []))
        assert [k for k, _ in parts] == list(range(len(parts)))
        assert sum((p for _, p in parts), []) == sp.encode(t)
    assert pieces[None] == [(0, sp.encode("no id"))]
    assert sum(p == (0, sp.encode("twice")) for p in pieces[7]) == 2
    assert len({r.row_id for r in got}) == len(got)
    assert pack(docs.limit(0)).count() == 0
