from __future__ import annotations

import hashlib
import math
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from merchlens.llm import vector_codes as v

SCHEMA = "vec_id bigint, embedding array<float>, label int"


@settings(max_examples=200)
@given(st.integers(1, 40), st.integers(1, 3), st.integers(1, 6), st.integers(0, 999))
def test_tree_finds_the_first_nearest(entries, wide, span, seed):
    """Small coordinates make ties and equal entries frequent."""
    rng = np.random.default_rng(seed)
    book, rows = rng.integers(-span, span, (entries, wide)), rng.integers(-span - 2, span + 2, (50, wide))
    number, best = v.Gnat(book).nearest(rows)
    all_of_them = v.squared(rows, book)
    assert number.tolist() == all_of_them.argmin(axis=1).tolist()
    assert best.tolist() == all_of_them.min(axis=1).tolist()


def test_tree_with_saturated_coordinates():
    most = math.isqrt(2**62 // 64) // 2
    book = np.array([[most] * 8, [-most] * 8, [0] * 8, [most - 1] * 8, [1] * 8, [most, 0] * 4])
    rows = np.array([[most] * 8, [most - 1] * 8, [-most] * 8, [1] * 8, [0] * 8])
    number, best = v.Gnat(book).nearest(rows)
    assert number.tolist() == [0, 3, 1, 4, 2] and best.tolist() == [0] * 5


def test_tree_leaves_children_out(monkeypatch):
    """Far clusters are not visited, nor is any child by the row that is a split point itself."""
    visits = []
    visit = v.Gnat._visit
    monkeypatch.setattr(v.Gnat, "_visit", lambda self, *a: (visits.append(len(a[1])), visit(self, *a)))
    book = np.array([[c * 10**6 + k, k] for c in range(4) for k in range(4)])
    v.Gnat(book).nearest(book[:4])
    assert sum(visits) == 4 + 3


def brute(rows):
    """Plain loops over (vec_id, vector, label)."""
    kept = [
        (i, [math.floor(4096 * float(np.float32(x))) for x in e], label)
        for i, e, label in rows
        if e is not None and len(e) == 16 and all(x is not None and math.isfinite(x) for x in e)
    ]
    cut = lambda q: [q[p * 2 : p * 2 + 2] for p in range(8)]
    first = {}
    for i, q, _ in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        first.setdefault(i, q)
    books = [[cut(q)[p] for q in list(first.values())[:16]] for p in range(8)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def place(q):
        return [min(range(len(b)), key=lambda e: (far(x, b[e]), e)) for x, b in zip(cut(q), books, strict=True)]

    for _ in range(6):
        places = [place(q) for _, q, _ in kept]
        fresh = [[list(e) for e in b] for b in books]
        for p in range(8):
            for e in range(len(books[p])):
                mine = [cut(q)[p] for (_, q, _), at in zip(kept, places, strict=True) if at[p] == e]
                if mine:
                    fresh[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
        books = fresh
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, by_label = [], {}
    for i, q, label in kept:
        at = place(q)
        error = sum(far(x, books[p][at[p]]) for p, x in enumerate(cut(q)))
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, "".join(f"{e:02x}" for e in at), error, label))
    return sorted(((i, c, e, by_label[label], digest) for i, c, e, label in out), key=repr)


def vectors(n, seed=3):
    rng = random.Random(seed)
    rows = [(i, [rng.uniform(-0.01, 0.01) for _ in range(16)], rng.choice([None, 1, 2])) for i in range(n)]
    return rows


def odd():
    rows = vectors(60)
    rows[1:1] = [(100, None, 1), (101, [None] + [0.5] * 15, 1), (102, [float("nan")] * 16, 1), (103, [float("inf")] * 16, 2)]
    rows += [(104, [], 1), (105, [0.1] * 8, 3), (106, [0.1] * 5, 3), (None, [0.002] * 16, None), (None, [0.0] * 16, 2)]
    return rows + [rows[0], (3, [0.009] * 16, 1)] + [(200 + i, [0.003] * 16, 7) for i in range(40)]


def test_brute_force(llm):
    for rows in (odd(), vectors(5), [(None, [0.5] * 16, 1)] * 3, [(1, [3e38, -3e38] * 8, 1), (2, [0.0] * 16, 1)]):
        frame = llm.createDataFrame(rows, SCHEMA).repartition(3)
        for name in ("code", "salt", "of", "by", "q", "size", "a.b"):
            frame = frame.withColumn(name, F.lit("clash"))
        got = sorted((tuple(r) for r in v.compress(frame).collect()), key=repr)
        if rows[0][1][0] == 3e38:  # saturates; nothing to compare with
            assert [g[2] for g in got] == [0, 0]
        else:
            assert got == brute(rows)


def test_empty_table(llm):
    out = v.compress(llm.createDataFrame([], SCHEMA))
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and out.count() == 0
    assert v.compress(llm.createDataFrame([(1, None, 1), (2, [0.5], 1)], SCHEMA)).count() == 0


def test_codes_stand_for_their_vectors(llm):
    kept = v.integers(llm.createDataFrame(vectors(80), SCHEMA), 16)
    books = v.train(kept, 16)
    q = {r.vec_id: r.q for r in kept.collect()}
    for row in v.encode(kept, books).collect():
        back = v.decode(row.code, books)
        assert row.error == sum((a - b) ** 2 for a, b in zip(q[row.vec_id], back, strict=True))
