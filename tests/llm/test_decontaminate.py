from __future__ import annotations

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from merchlens.llm import decontaminate as d
from tests.llm.conftest import frame, prose


def brute_align(words, item, weight, penalty):
    table = np.zeros((len(item) + 1, len(words) + 1))
    for i, a in enumerate(item, 1):
        for j, b in enumerate(words, 1):
            match = weight[a] if a == b else -penalty
            table[i, j] = max(0, table[i - 1, j - 1] + match, table[i - 1, j] - penalty, table[i, j - 1] - penalty)
    return table.max(initial=0)


@settings(max_examples=150)
@given(st.lists(st.integers(0, 5), max_size=12), st.lists(st.integers(1, 5), max_size=8), st.floats(0.05, 1))
def test_alignment(words, item, penalty):
    weight = np.array([0, 1, 2, 1.5, 0.5, 3])
    got, end = d.align(np.array(words, dtype=np.int64), np.array(item, dtype=np.int64), weight, penalty)
    assert got == pytest.approx(brute_align(words, item, weight, penalty))
    assert 0 <= end <= len(words)


def plain(text):
    return re.sub(r"[^\w\s]|_", " ", re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")).split()


def brute_leaks(rows, items):
    """Whole texts against whole items, no seeds and no windows."""
    texts = [plain(t) for _, t in rows]
    held = {w: sum(w in set(t) for t in texts) for _, text in items for w in plain(text)}
    weight = {w: np.log((len(rows) + 1) / (n + 0.5)) + 1 for w, n in held.items()}
    number = {w: i + 1 for i, w in enumerate(sorted(weight))}
    table = np.array([0.0, *(weight[w] for w in sorted(weight))])
    out = []
    for (i, _), words in zip(rows, texts, strict=True):
        for item, text in items:
            own = [number[w] for w in plain(text)]
            if len(own) < 2:
                continue
            total = table[own].sum()
            part = [number.get(w, 0) for w in words]
            best = brute_align(part, own, table, d.PENALTY * total / len(own))
            copied = len(own) >= d.RUN and brute_align(part, own, np.ones(len(table)), d.DEAR) >= d.RUN
            if copied or best >= max(d.SCORE * total, np.log(len(rows) + 1) + d.EVIDENCE):
                out.append((repr(i), item, float(best / total)))
    return sorted(out)


def case():
    rng = random.Random(4)
    items = [(i, prose(100 + i, rng.randint(12, 40), 3000)) for i in range(12)] + [(50, "Lone"), (51, ""), (52, None)]
    items.append((53, items[0][1]))
    rows = []
    for i in range(40):
        words = prose(i, rng.randint(20, 150), 3000).split()
        if i % 2:
            copy = items[i % 12][1].split()
            for _ in range(len(copy) // 6):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            if i % 4 == 1:
                del copy[rng.randrange(len(copy))]
            at = rng.randrange(len(words))
            words[at:at] = copy
        rows.append((i, " ".join(words)))
    long = items[4][1].split() + prose(77, 60, 3000).split()  # an excerpt of it is a small part
    items.append((54, " ".join(long)))
    rows += [(80 + i, f"{prose(60 + i, 50, 3000)} {' '.join(long[i : i + 13])}") for i in (30, 55)]
    rows += [(None, items[3][1].upper()), (60, None), (61, ""), rows[1], (62, prose(1, 900, 3000) + "\n" + items[5][1].replace(" ", " - "))]
    return rows, items


def tables(llm):
    rows, items = case()
    docs = frame(llm, rows).withColumns({n: F.lit("clash") for n in ("item_id", "score", "row", "a.b")})
    return docs, llm.createDataFrame([(*x, "x") for x in items], "item_id bigint, text string, doc_id string")


@pytest.mark.parametrize("block", [20_000, 5])
def test_brute_force(llm, monkeypatch, block):
    docs, benchmark = tables(llm)
    if block == 20_000:
        monkeypatch.setattr(d, "BLOCK_BYTES", 10**9)
        got = sorted((repr(r.doc_id), r.item_id, r.score) for r in d.leaks(docs, benchmark).collect())
        expected = brute_leaks(*case())
        assert [g[:2] for g in got] == [e[:2] for e in expected] and len(got) > 20
        assert [g[2] for g in got] == pytest.approx([e[2] for e in expected], abs=2e-6)
    else:  # blocks change nothing but the passes
        monkeypatch.setattr(d, "BLOCK_ITEMS", block)
        monkeypatch.setattr(d, "BLOCK_BYTES", 500)
    leaked = {i for i, _, _ in brute_leaks(*case())}
    kept = d.without_leaks(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(i) for i, _ in case()[0] if repr(i) not in leaked)


def test_long_text_in_pieces(monkeypatch):
    text, vocabulary = prose(1, 500), {w.encode(): i + 1 for i, w in enumerate(sorted(set(plain(prose(1, 500)))))}
    whole = d.numbered(text, vocabulary).tolist()
    monkeypatch.setattr(d, "PIECE", 17)
    assert d.numbered(text, vocabulary).tolist() == whole == [vocabulary[w.encode()] for w in plain(text)]


def test_empty_tables(llm):
    docs, benchmark = tables(llm)
    assert d.leaks(docs.where("false"), benchmark).count() == 0
    assert d.leaks(docs, benchmark.where("false")).count() == 0
    assert d.without_leaks(docs, benchmark.where("false")).count() == docs.count()


@pytest.mark.parametrize("length", [40, 300])
@pytest.mark.parametrize("at", [0.0, 0.3, 1.0])
def test_excerpts(llm, length, at):
    """Parts of an item of 13 words in a row, or of more words with some changed, are copies however long the item is."""
    item = prose(500, length, 3000).split()
    first = int(at * (length - 20))
    edited = [*item[first : first + 20]]
    edited[6] = edited[13] = "else"
    docs = [prose(i, 120, 3000) for i in range(40)]
    docs += [f"{prose(50, 60, 3000)} {' '.join(part)} {prose(51, 60, 3000)}" for part in (item[first : first + 13], edited)]
    benchmark = llm.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    found = d.leaks(frame(llm, docs), benchmark).collect()
    assert sorted(r.doc_id for r in found) == [40, 41] and (length == 40 or all(r.score < d.SCORE for r in found))
    assert sorted(r.doc_id for r in d.without_leaks(frame(llm, docs), benchmark).collect()) == list(range(40))


def test_scripts_without_spaces(llm):
    han = "".join(chr(0x4E00 + (7 * i * i + 31 * i) % 5000) for i in range(60))
    benchmark = llm.createDataFrame([(1, han)], "item_id bigint, text string")
    docs = [*(prose(i, 80) for i in range(5)), "\u6211" * 30 + han[5:55] + "\u4f60" * 30]
    assert [r.doc_id for r in d.leaks(frame(llm, docs), benchmark).collect()] == [5]


def edited(item, share, rng, how):
    """The item with a share of its words replaced, at random or every so many."""
    out = list(item)
    count = round(share * len(out))
    places = rng.sample(range(len(out)), count) if how == "random" else range(0, len(out), round(1 / share))
    for at in places:
        out[at] = rng.choice(OTHER)
    return out


OTHER = prose(900, 400, 3000).replace(".", "").replace(",", "").lower().split()


@pytest.mark.parametrize("share,how", [(0.2, "random"), (0.4, "random"), (0.5, "every second word")])
def test_recall_of_edited_copies(share, how):
    """Nine in ten are found, every second word replaced included."""
    rng = random.Random(11)
    items = d.Items([(i, prose(1000 + i, rng.randint(15, 60), 3000)) for i in range(60)])
    words, pairs = np.full(items.size, 40), np.full(len(items.codes), 2)
    matcher = d.Matcher(items, 10_000, words, pairs, d.SCORE)
    found = 0
    for i in range(60):
        copy = edited(plain(prose(1000 + i, len(items.words[i]), 3000)), share, rng, how)
        text = " ".join([*rng.choices(OTHER, k=50), *copy, *rng.choices(OTHER, k=50)])
        found += i in {m[0] for m in matcher.matches(text)}
    assert found >= 54


def test_short_items_of_common_words(llm):
    """What every text holds is no evidence; a short item of rare words is."""
    docs = [f"{prose(i, 80)} part of the whole {prose(i + 100, 20)}" for i in range(60)] + ["it reads zyxwv qponm rstuv twice"]
    benchmark = llm.createDataFrame([(1, "of the"), (2, "part of the whole"), (3, "zyxwv qponm rstuv")], "item_id bigint, text string")
    assert [(r.doc_id, r.item_id) for r in d.leaks(frame(llm, docs), benchmark).collect()] == [(60, 3)]
