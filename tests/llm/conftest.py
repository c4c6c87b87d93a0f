from __future__ import annotations

import random

import pytest

from merchlens.llm.common import ready

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def llm(spark):
    return ready(spark)


def frame(spark, texts, first=0, **more):
    """Documents numbered from ``first``; a (doc_id, text) pair gives its own id."""
    rows = [t if isinstance(t, tuple) else (first + i, t) for i, t in enumerate(texts)]
    data = [(i, t, more.get("lang"), "s", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(data, SCHEMA)


def prose(seed, words, vocabulary=400):
    """Words with some commas and full stops, from an invented vocabulary."""
    rng = random.Random(seed)
    stems = random.Random(5)
    pool = ["".join(stems.choice("abcdefghilmnoprstu") for _ in range(stems.randint(3, 8))) for _ in range(vocabulary)]
    out = [rng.choice(pool) + rng.choice(["", "", "", ",", ""]) for _ in range(words)]
    for i in range(9, words, 10):
        out[i] = out[i].rstrip(",") + "."
    if out:
        out[0], out[-1] = out[0].capitalize(), out[-1].rstrip(",.") + "."
    return " ".join(out)
