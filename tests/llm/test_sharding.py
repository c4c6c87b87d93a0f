from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from hypothesis import given
from hypothesis import strategies as st

from merchlens.llm import sharding
from tests.llm.conftest import frame, prose


def brute_best_fit(sizes, capacity):
    left, bins = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [(room, b) for b, room in enumerate(left) if room >= sizes[i]]
        if fits:
            at = min(fits)[1]
        else:
            at = len(left)
            left.append(max(capacity, sizes[i]))
        bins[i] = at
        left[at] -= sizes[i]
    return [bins[i] for i in range(len(sizes))]


@given(st.lists(st.integers(1, 30), max_size=60))
def test_best_fit_decreasing(sizes):
    assert sharding.best_fit_decreasing(np.array(sizes, dtype=np.int64), 20).tolist() == brute_best_fit(sizes, 20)


@given(st.lists(st.integers(1, 50), min_size=1, max_size=80), st.integers(1, 7))
def test_fit_into(sizes, shards):
    bins = sharding.fit_into(np.array(sizes, dtype=np.int64), shards)
    assert bins.min() >= 0 and bins.max() < shards
    totals = [sum(s for s, b in zip(sizes, bins, strict=True) if b == n) for n in range(shards)]
    assert max(totals) <= max(max(sizes), -(-sum(sizes) // shards) + max(sizes))


@pytest.mark.parametrize("hot", [0, 300])
def test_shards(llm, monkeypatch, hot):
    monkeypatch.setattr(sharding, "CELL_ROWS", 50)
    monkeypatch.setattr(sharding, "GROUPS_PER_PART", 400)
    rng = random.Random(1)
    texts = [prose(i, rng.randint(5, 60)) for i in range(1500)] + [prose(1, 40)] * 5 + [None, "", (None, "x"), (3, "y")]
    docs = frame(llm, texts + ["hot text " * 30] * hot)
    rows = sharding.assign_shards(docs, 10).collect()
    assert sorted((repr(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted(
        (repr(r.doc_id), len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect()
    )
    of_text, slots, sizes = {}, {}, [0] * 10
    for r in rows:
        assert of_text.setdefault(r.text_crc32, r.shard) == r.shard
        slots.setdefault(r.shard, []).append(r.slot)
        sizes[r.shard] += r.size
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    even = sorted(sizes)[:-1] if hot else sizes
    assert max(even) <= 1.02 * min(even)


def test_empty_table(llm):
    assert sharding.assign_shards(frame(llm, [])).count() == 0


def test_rows_without_id_are_spread(llm, monkeypatch):
    """A large group of equal texts without doc_id is numbered in many cells; columns may have the names used here."""
    monkeypatch.setattr(sharding, "CELL_ROWS", 50)
    texts = [(None, "same text")] * 900 + [prose(i, 20) for i in range(300)] + ["w " * 150_000]
    docs = frame(llm, texts).withColumns({n: F.lit("clash") for n in ("row", "size", "shard", "block", "cell", "h1", "a.b")})
    rows = sharding.assign_shards(docs, 4).collect()
    assert len(rows) == len(texts)
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in rows if r.doc_id is None}) == 1


def test_two_levels_are_near_plain_best_fit(llm):
    """The blocks cost little against best-fit decreasing over all groups at once."""
    rng = random.Random(6)
    docs = frame(llm, [prose(i, rng.randint(2, 200)) for i in range(1200)])
    totals, plain = [0] * 8, [0] * 8
    for r in sharding.assign_shards(docs, 8).collect():
        totals[r.shard] += r.size
    sizes = np.array([len(r.text.encode()) + 16 for r in docs.collect()], dtype=np.int64)
    for size, shard in zip(sizes, sharding.fit_into(sizes, 8), strict=True):
        plain[shard] += int(size)
    assert max(totals) <= 1.01 * max(plain)
