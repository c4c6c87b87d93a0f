from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from merchlens.llm import packing
from tests.llm.conftest import frame, prose


def brute_first_fit(sizes, capacity):
    left, bins = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = next((b for b, room in enumerate(left) if room >= sizes[i]), None)
        if at is None:
            at = len(left)
            left.append(capacity)
        bins[i] = at
        left[at] -= sizes[i]
    return [bins[i] for i in range(len(sizes))]


@given(st.lists(st.integers(1, 15), max_size=60))
def test_first_fit_decreasing(sizes):
    bins, offsets = packing.first_fit_decreasing(np.array(sizes, dtype=np.int64), 16)
    assert bins.tolist() == brute_first_fit(sizes, 16)
    for b in set(bins.tolist()):
        own = sorted((offsets[i], sizes[i]) for i in np.flatnonzero(bins == b))
        assert own[0][0] == 0 and all(a[0] + a[1] == c[0] for a, c in zip(own, own[1:], strict=False))


def texts():
    odd = ["", None, "<|endoftext|>", "a <|endoftext|>b", "Ünïcode 日本語 🙂 ​", "  \n\n\t x", "don't I'LL 123 4567"]
    return odd + [prose(i, 30 + 97 * i) for i in range(14)] + [prose(3, 127)] * 3 + [(None, "no id"), (4, "again")]


@pytest.mark.parametrize("group_docs", [4, 1000])
def test_every_id_once(llm, group_docs):
    docs = frame(llm, texts())
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = []
    for row in docs.collect():
        ids = np.array([*tokenizer.encode(row.text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for at in range(0, len(ids), 1024):
            part = ids[at : at + 1024]
            expected.append((repr(row.doc_id), at, len(part), zlib.crc32(part.tobytes()), len(ids)))
            assert packing.ids_of(row.text, at, len(part)).tolist() == part.tolist()
    got = packing.pack(docs, group_docs=group_docs).collect()
    assert sorted((repr(r.doc_id), r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == sorted(expected)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert parts[0][0] == 0 and sum(n for _, n in parts) <= 1024
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False))
    if group_docs == 1000:
        assert len(sequences) <= -(-sum(r.length for r in got) // 1024) + 1


def test_empty_table(llm):
    assert packing.pack(frame(llm, [])).count() == 0


def test_rows_without_id_are_spread(llm, monkeypatch):
    """A third of the rows have no id and the same text; no group is far above the median."""
    texts = [(None, "")] * 400 + [(7, "same")] * 100 + [(i, prose(i, 5)) for i in range(1000, 1700)]
    docs = frame(llm, texts).withColumns({n: F.lit("clash") for n in ("grp", "length", "start", "a.b")})
    got = packing.pack(docs, group_docs=60).collect()
    assert len(got) == len(texts)
    sizes = sorted(Counter(r.sequence_id >> 32 for r in got).values())
    assert len(sizes) == 20 and sizes[-1] < 2 * sizes[len(sizes) // 2]


def test_full_pieces_stand_alone(llm):
    docs = frame(llm, [prose(1, 3000), "short"])
    got = packing.pack(docs).collect()
    full = [r for r in got if r.length == 1024]
    assert len(full) >= 3 and all(r.offset == 0 for r in full)
    assert len({r.sequence_id for r in full}) == len(full) and not {r.sequence_id for r in full} & {r.sequence_id for r in got if r.length < 1024}
