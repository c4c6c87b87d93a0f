from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from merchlens.llm import quality_score as q
from tests.llm.conftest import frame, prose


def numbers(text):
    return [zlib.crc32(w.encode()) >> (32 - q.BITS) for w in re.findall(r"[A-Za-z0-9\x80-\U0010ffff]+|[!-/:-@\[-`{-~]+", text or "")]


def brute_sums(texts):
    columns, signs = q.index_vectors()
    sums, seen = np.zeros((q.ROWS, q.DIM), np.int64), np.zeros(q.ROWS, np.int64)
    for text in texts:
        words = numbers(text)
        for i, w in enumerate(words):
            seen[w] += 1
            for j in range(max(0, i - q.REACH), min(len(words), i + q.REACH + 1)):
                if i != j:
                    np.add.at(sums[w], columns[words[j]], signs[words[j]])
    return sums, seen


def brute_pooled(vectors, text):
    v = vectors[numbers(text)].astype(np.float64).reshape(-1, q.DIM)
    if not len(v):
        return np.zeros(q.POOLED)
    steps = ((v[1:] - v[:-1]) ** 2).mean(axis=0) if len(v) > 1 else np.zeros(q.DIM)
    return np.concatenate([v.mean(axis=0), v.std(axis=0), np.log1p(steps), [np.log1p(len(v))]])


def texts():
    return [prose(i, 30 + 9 * i) for i in range(12)] + ["", None, " \n ", "one", "Straße!! café $$$ #1\nend.", "a " * 900, prose(3, 39)]


@pytest.mark.parametrize("held", [None, 50])
def test_context_sums(llm, monkeypatch, held):
    if held:
        monkeypatch.setattr(q, "WORDS_HELD", held)
    sums, seen = q.context_sums(frame(llm, texts()).repartition(3))
    expected = brute_sums(texts())
    assert (sums == expected[0]).all() and (seen == expected[1]).all()


def test_pooling_in_pieces(monkeypatch):
    vectors = q.word_vectors(*brute_sums(texts()))
    whole = [q.pooled(vectors, q.Words().of(t)) for t in texts()]
    monkeypatch.setattr(q, "PIECE", 37)
    monkeypatch.setattr(q, "NAMES_HELD", 5)
    words = q.Words()
    for text, before in zip(texts(), whole, strict=True):
        assert before == pytest.approx(brute_pooled(vectors, text), abs=1e-4)
        assert q.pooled(vectors, words.of(text)) == pytest.approx(before, abs=1e-5)


def test_gradients():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(9, 5)), np.array([0, 1, 1, 0, 1, 0, 0, 1, 1.0])
    model = {"W": rng.normal(size=(5, 4)), "b": rng.normal(size=4), "out": rng.normal(size=4), "bias": np.array([0.2])}
    _, g = q.gradients(model, x, y)
    for k, value in model.items():
        for at in np.ndindex(value.shape):
            kept, ends = value[at], []
            for step in (1e-5, -1e-5):
                value[at] = kept + step
                ends.append(q.gradients(model, x, y)[0])
            value[at] = kept
            assert (ends[0] - ends[1]) / 2e-5 == pytest.approx(g[k][at], abs=1e-6)


def test_temperature_is_the_best_of_the_grid():
    rng = np.random.default_rng(2)
    z = rng.normal(0, 3, 4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-z / 2.5))).astype(float)
    assert q.temperature(z, y) == pytest.approx(2.5, rel=0.15)
    assert q.temperature(np.zeros(0), np.zeros(0)) == 1.0


def labelled(documents=360):
    rng, rows, labels = random.Random(9), [], []
    for i in range(documents):
        good = rng.random() < 0.6
        text = prose(i, rng.randint(20, 120))
        if not good:
            words = text.split()
            text = " ".join([w + "$$$" for w in words] if i % 2 else [w for w in words[:30] for _ in range(3)])
        rows.append((i, text))
        labels.append((i, int(good), 0))
    return rows, labels


LABELS = "doc_id bigint, quality int, toxic int"


def test_held_out_labels(llm):
    rows, labels = labelled()
    rows += [(None, rows[0][1]), (1000, ""), (1001, None), (3, rows[3][1]), (1002, "word " * 200_000)]
    odd = [(None, 1, 0), (5, None, 1), (6, 7, 0), (7, 0, 0), (7, 1, 0), (99_999, 1, 0)]
    docs = frame(llm, rows, lang="xx").withColumns({n: F.lit("clash") for n in ("quality", "pooled", "score", "a.b")})
    out = q.score_documents(docs, llm.createDataFrame(labels + odd, LABELS).withColumn("text", F.lit("x"))).collect()
    assert sorted(repr(r.doc_id) for r in out) == sorted(repr(i) for i, _ in rows)
    truth = {i: y for i, y, _ in labels}
    apart = [r for r in out if r.held_out]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    known = [r for r in apart if r.doc_id in truth and r.doc_id != 7]
    assert len(known) > 50 and sum(r.predicted == truth[r.doc_id] for r in known) >= 0.97 * len(known)
    empty = {r.score for r in out if r.doc_id in (1000, 1001)}
    assert len(empty) == 1


def test_labels_of_held_out_documents_are_not_read(llm):
    rows, labels = labelled(200)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y, t) for i, y, t in labels]
    first, second = (
        sorted(q.score_documents(frame(llm, rows), llm.createDataFrame(x, LABELS)).collect()) for x in (labels, flipped)
    )
    assert first == second


def test_no_labels_and_empty_tables(llm):
    docs, labels = frame(llm, texts()), llm.createDataFrame([(0, 1, 0)], LABELS)
    assert {r.score for r in q.score_documents(docs, labels).collect()} == {0.5}
    assert q.score_documents(docs.where("false"), labels.where("false")).count() == 0
