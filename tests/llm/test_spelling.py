from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from merchlens.llm import spelling as s
from tests.llm.conftest import frame


def one_edit(a, b):
    """By making every single edit."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


WORD = st.text(alphabet="abé", min_size=1, max_size=7)


@settings(max_examples=300)
@given(st.lists(WORD, unique=True, max_size=25), st.booleans())
def test_tiles_against_single_edits(words, small):
    """Every pair is found exactly once over both halves and all lengths, whatever the tile size."""
    cells, s.CELLS = s.CELLS, 9 if small else s.CELLS
    try:
        found = Counter()
        groups = {}
        for w in words:
            for m in (len(w), len(w) - 1):
                if m > 0:
                    groups.setdefault((m, "left", w[: m // 2]), []).append(w)
                    groups.setdefault((m, "right", w[len(w) - m // 2 :]), []).append(w)
        for (m, side, _), own in groups.items():
            half = len(own) // 2
            for a, b in ((own[:half], None), (own[half:], None), (own[:half], own[half:])):
                for x, y in s.near_pairs(a, b, m, side):
                    found[frozenset((a[x], (a if b is None else b)[y]))] += 1
    finally:
        s.CELLS = cells
    wanted = {frozenset((a, b)) for i, a in enumerate(words) for b in words[:i] if one_edit(a, b)}
    assert found == dict.fromkeys(wanted, 1)


def brute(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def corpus(seed=1, documents=60):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcé×") for _ in range(rng.randint(5, 9))) for _ in range(12)]
    rows = []
    for i in range(documents):
        words = []
        for _ in range(rng.randint(0, 160)):
            w = stems[min(rng.randrange(12), rng.randrange(12))]
            for _ in range(rng.choice([0, 0, 0, 0, 1, 1, 2])):
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice("abc") + w[at:], w[:at] + "a" + w[at + 1 :]])
            words.append(w.capitalize() if rng.random() < 0.2 else w)
        rows.append((i, rng.choice([" ", "-", "\n", "1"]).join(words)))
    # A chain of forms, a long word, capitals beyond ASCII and code points beyond the range.
    chain = ["chained"] * 700 + ["chainex"] * 130 + ["chainexy"] * 25 + ["chainxxy"] * 5 + ["ÉCHAINED"] * 6
    rows += [(900, " ".join(chain)), (901, ("q" * 3000 + " ") * 6 + ("q" * 3001 + " ") * 40), (902, "İchained\U0001f600chained")]
    return rows + [(None, rows[3][1]), (5, rows[4][1]), rows[7], (70, None), (71, ""), (72, "1 2 short")]


@pytest.mark.parametrize("letters", [None, 40])
def test_brute_force(llm, monkeypatch, letters):
    if letters:  # many blocks, many hand-overs of counts
        monkeypatch.setattr(s, "BLOCK_LETTERS", letters)
        monkeypatch.setattr(s, "COUNTS_HELD", 3)
    rows = corpus()
    docs = frame(llm, rows).withColumns({n: F.lit("clash") for n in ("word", "n", "half", "size", "a.b")})
    got = sorted((tuple(r) for r in s.group_variants(docs).collect()))
    assert got == brute(rows)
    assert sum(r[1] is not None for r in got) > 20 and any(r[1] not in (None, r[2]) for r in got)


def test_dropped_code_points():
    """Some runs lose a code point; the document decides."""
    changed = [i for i in range(2000) if s.spoken(i, "balanced", zlib.crc32(f"{i}:".encode())) != "balanced"]
    assert changed == [i for i in range(2000) if zlib.crc32(f"{i}:balanced".encode()) % 199 == 0] and changed


def test_long_text_in_pieces(monkeypatch):
    text = corpus()[4][1] + " É" + "b" * 40 + "İ" + "c" * 9
    whole = [w for part in s.runs(text) for w in part]
    monkeypatch.setattr(s, "PIECE", 13)
    assert [w for part in s.runs(text) for w in part] == whole


def test_empty_table(llm):
    out = s.group_variants(frame(llm, []))
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"] and out.count() == 0
