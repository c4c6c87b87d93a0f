from __future__ import annotations

import os

import numpy as np
import pytest

from merchlens.llm import langid
from tests.llm.conftest import SCHEMA

DATA = "/root/testdata/sf0.01/documents.parquet"


def brute_counts(text):
    plain = [ord(c) if c.isalpha() else 32 for c in text.lower()]
    out = np.zeros(langid.DIM, np.int64)
    for order in (1, 2, 3):
        for i in range(len(plain) - order + 1):
            value = plain[i]
            for c in plain[i + 1 : i + order]:
                value = (value * 0x01000193 + c) % 2**32
            out[((value + order * 7919) * 2654435761 % 2**32) >> (32 - langid.BITS)] += 1
    return out


@pytest.mark.parametrize("held", [7, 1 << 20])
def test_counts(monkeypatch, held):
    monkeypatch.setattr(langid, "CHARS_HELD", held)
    for text in ("", "a", "ab", "Éa 9 日本𐐀🙂x, Straße", "the quick brown fox " * 3):
        counts, letter = langid.gram_counts(text)
        assert (counts == brute_counts(text)).all()
        assert letter == any(c.isalpha() for c in text)


def test_sparse_weights_under_strong_penalty():
    rng = np.random.default_rng(0)
    samples = [(np.sort(rng.choice(50, 5, replace=False)), rng.random(5), int(rng.integers(3))) for _ in range(60)]
    assert (langid.train(samples, 3, l1=50.0) == 0).all()
    assert (langid.train(samples, 3, l1=0.0) != 0).any()


@pytest.mark.skipif(not os.path.exists(DATA), reason="needs the test tables")
def test_held_out_accuracy(llm):
    docs = llm.read.parquet(DATA)
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL").collect()
    right = sum(r.lang_pred == r.lang for r in rows)
    assert len(rows) > 150 and right / len(rows) > 0.97
    # Calibrated: the mean score is near the share that is right.
    assert abs(np.mean([r.score for r in rows]) - right / len(rows)) < 0.05


def test_odd_rows(llm):
    rows = [(i, t, lang, None, 0) for i, (t, lang) in enumerate([("the cat and the dog " * 5, "en"), ("der hund und die katze " * 5, "de")] * 20)]
    rows += [(900, None, "en", None, 0), (901, "123 !!", "en", None, 0), (902, "", None, None, 0), (None, "the dog and the cat", "en", None, 0), rows[1]]
    docs = llm.createDataFrame(rows, SCHEMA).withColumnRenamed("source", "score")
    out = langid.identify(docs).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out}
    assert by_id[0].lang_pred == "en" and by_id[1].lang_pred == "de"
    assert [by_id[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3
    assert by_id[None].lang_pred == "en" and by_id[None].held_out is False
    assert all(0 <= r.score <= 1 for r in out)


def test_nothing_to_learn(llm):
    empty = llm.createDataFrame([], SCHEMA)
    assert langid.identify(empty).count() == 0
    unknown = llm.createDataFrame([(1, "text", None, None, 4)], SCHEMA)
    assert langid.identify(unknown).first().lang_pred == "und"


def test_every_language_is_learned(llm, monkeypatch):
    """Many languages, one of them with three documents only: each has a column of the model and is found."""
    monkeypatch.setattr(langid, "SAMPLE", 300)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for n in range(26):
        own = [letters[n], letters[(n * 7 + 3) % 26], letters[(n * 5 + 11) % 26]]
        for i in range(3 if n == 25 else 24):
            rows.append((len(rows), " ".join("".join(own[(i + j + k) % 3] for k in range(4)) for j in range(30)), f"l{n:02d}", "s", 0))
    rows.append((9999, rows[-1][1], None, "s", 0))
    out = {r.doc_id: r for r in langid.identify(llm.createDataFrame(rows, SCHEMA)).collect()}
    assert out[9999].lang_pred == "l25"
    assert sum(out[i].lang_pred == lang for i, _, lang, _, _ in rows[:-1]) >= 0.95 * len(rows)
