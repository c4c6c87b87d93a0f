from __future__ import annotations

import os

import numpy as np
import pytest

from merchlens.llm import toxicity as tox
from tests.llm.conftest import frame, prose

DATA = "/root/testdata/sf0.1"


def test_gradients():
    model = {k: v.astype(np.float64) for k, v in tox.new_model(1).items()}
    f = tox.word_features([b"hello", b"world", b"a", b"xy", "é".encode()])
    rng, ids = np.random.default_rng(0), np.full((4, tox.WINDOW), -1)
    for row, n in enumerate((5, tox.WINDOW, 1, 20)):
        ids[row, :n] = rng.integers(0, 5, n)
    y = np.array([1.0, 0, 1, 0])
    _, g = tox.gradients(model, f, ids, y)
    for key, d in g.items():
        for at in rng.choice(np.flatnonzero(np.abs(d) > 1e-4), 2):
            old, step, losses = model[key].flat[at], 1e-2, []
            for value in (old + step, old - step):
                model[key].flat[at] = value
                losses.append(tox.gradients(model, f, ids, y)[0])
            model[key].flat[at] = old
            assert d.flat[at] == pytest.approx((losses[0] - losses[1]) / (2 * step), rel=0.02, abs=2e-5), key


def brute_windows(words):
    starts = [0]
    while starts[-1] + tox.WINDOW < len(words):
        starts.append(starts[-1] + tox.STRIDE)
    return [words[s : s + tox.WINDOW] for s in starts] if words else []


def test_every_window_is_scored(monkeypatch):
    """A text's score is its worst window's, however the text is cut into pieces and batches."""
    model = tox.new_model(2) | {"scale": np.array((1.0, 0.0))}
    texts = [prose(i, n) for i, n in enumerate((1, 15, 16, 31, 32, 33, 47, 48, 49, 64, 200))] + ["", None, "... !!"]
    expected = []
    for text in texts:
        words = [w for part in tox.text_words(text) for w in part]
        alone = [tox.scores_of(model, iter([b" ".join(w).decode()]), 1)[0] for w in brute_windows(words)]
        expected.append(max(alone, default=0.0))
    assert tox.scores_of(model, iter(texts), len(texts)) == pytest.approx(expected, abs=1e-5)
    monkeypatch.setattr("merchlens.llm.common.PIECE", 40)
    monkeypatch.setattr(tox, "WORDS_HELD", 10)
    assert tox.scores_of(model, iter(texts), len(texts)) == pytest.approx(expected, abs=1e-5)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
def test_held_out_accuracy(llm):
    docs, labels = (llm.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = tox.score_documents(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    toxic = [r.predicted for r in rows if r.toxic == 1]
    clean = [r.predicted for r in rows if r.toxic == 0]
    # About 300 toxic labels to learn from here; with 1,500 nearly all are found.
    assert len(toxic) > 50 and sum(toxic) / len(toxic) > 0.7 and sum(clean) / len(clean) < 0.02


def test_odd_rows(llm):
    texts = [prose(i, 60) + (" awful nasty" if i % 3 == 0 else "") for i in range(60)]
    docs = frame(llm, [*texts, None, "", (None, texts[0]), (5, texts[5])]).withColumnRenamed("lang", "score")
    labels = [(i, 1, int(i % 3 == 0)) for i in range(60)] + [(None, 1, 1), (3, None, None), (4, 0, 7), (999, 0, 1), (0, 1, 1)]
    labels = llm.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    rows = tox.score_documents(docs, labels).collect()
    assert len(rows) == 64 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert [r.score for r in rows if r.doc_id in (60, 61)] == [0, 0]
    assert {r.score for r in tox.score_documents(docs, labels.where("toxic = 1")).collect()} == {0.0}
    assert tox.score_documents(docs.where("false"), labels).count() == 0
