"""Quality by random-indexing word vectors, pooled per document, and a two-layer network trained here in numpy.

A word is a run of letters and digits or a run of signs; it is hashed to one of 2^``BITS`` rows. Each row has a sparse
index vector of +1 and -1; the vector of a word is the sum of the index vectors of the words within ``REACH`` of it, over
all documents: tasks add them up, the driver receives one row of sums per hashed row. A document is pooled from its
words' vectors (mean, spread and mean squared step from word to word); the network reads that and its logit is moved to
the classes' shares among all labels and divided by one temperature.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.llm.common import PIECE

BITS, DIM, NONZERO, REACH = 15, 24, 4, 2
ROWS = 1 << BITS
SAMPLE = 4000  # labelled documents of each class to learn from, at most
FEW = 20  # occurrences at which a word's vector counts half
HIDDEN, EPOCHS, RATE, DECAY = 32, 300, 0.01, 1e-3
THRESHOLD = 0.3
WORDS_HELD, NAMES_HELD = 1 << 18, 200_000
TOKEN = re.compile(rb"[A-Za-z0-9\x80-\xff]+|[!-/:-@\[-`{-~]+")
POOLED = 3 * DIM + 1


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Columns and signs of the index vector of each row."""
    rng = np.random.default_rng(42)
    columns = rng.random((ROWS, DIM)).argsort(axis=1)[:, :NONZERO]
    return columns, rng.choice(np.array([-1, 1], np.int64), (ROWS, NONZERO))


class Words:
    """Numbers of a text's words, piece by piece; the names seen last are kept."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def of(self, text: str | None) -> Iterator[np.ndarray]:
        data, start = (text or "").encode("utf-8", "replace"), 0
        while start < len(data):
            end = len(data) if start + PIECE >= len(data) else data.find(b" ", start + PIECE)
            end = len(data) if end < 0 else end
            words = TOKEN.findall(data, start, end)
            for w in set(words).difference(self.known):
                self.known[w] = zlib.crc32(w) >> (32 - BITS)
            yield np.fromiter(map(self.known.__getitem__, words), np.int32, len(words))
            if len(self.known) > NAMES_HELD:
                self.known.clear()
            start = end


def add_contexts(sums: np.ndarray, words: np.ndarray, fresh: int, columns: np.ndarray, signs: np.ndarray) -> None:
    """Add to each word's sums the index vectors around it, for the pairs whose right word is at ``fresh`` or behind.

    ``words`` holds -1 between documents.
    """
    flat = sums.reshape(-1)
    for step in range(1, REACH + 1):
        right = np.arange(max(fresh, step), len(words))
        a, b = words[right - step], words[right]
        both = (a >= 0) & (b >= 0)
        a, b = a[both].astype(np.int64), b[both].astype(np.int64)
        for of, around in ((a, b), (b, a)):
            for k in range(NONZERO):
                cells = of * DIM + columns[around, k]
                flat += np.bincount(cells, signs[around, k], len(flat)).astype(np.int64)


def context_sums(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """For each hashed word the sum of the index vectors around it and its occurrences, over all whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, signs = index_vectors()
        sums, seen, names = np.zeros((ROWS, DIM), np.int64), np.zeros(ROWS, np.int64), Words()
        gap = np.full(REACH, -1, np.int32)
        held, size, fresh = [gap], REACH, REACH

        def flush() -> None:
            nonlocal held, size, fresh
            words = np.concatenate(held)
            add_contexts(sums, words, fresh, columns, signs)
            new = words[fresh:]
            np.add(seen, np.bincount(new[new >= 0], minlength=ROWS), out=seen)
            held, size, fresh = [words[-REACH:]], REACH, REACH

        for batch in batches:
            for text in batch.column(0):
                for part in names.of(text.as_py()):
                    held.append(part)
                    size += len(part)
                    if size > WORDS_HELD:
                        flush()
                held.append(gap)
                size += REACH
        flush()
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(seen[at])] + [pa.array(np.ascontiguousarray(sums[at, d])) for d in range(DIM)],
            names=["word", "n", *(f"c{d}" for d in range(DIM))],
        )

    totals = ["n", *(f"c{d}" for d in range(DIM))]
    schema = "word bigint, " + ", ".join(f"{c} bigint" for c in totals)
    rows = docs.select("text").mapInArrow(run, schema).groupBy("word").agg(*(F.sum(c).alias(c) for c in totals))
    sums, seen = np.zeros((ROWS, DIM), np.int64), np.zeros(ROWS, np.int64)
    for word, n, *cells in rows.collect():  # at most ROWS rows
        sums[word], seen[word] = cells, n
    return sums, seen


def word_vectors(sums: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Mean context of each word, less that of all words, shrunk for rare ones and scaled per column."""
    n = seen[:, None].astype(np.float64)
    mean = sums / np.maximum(n, 1)
    centre = sums.sum(axis=0) / max(1, int(seen.sum()))
    vectors = np.where(n > 0, (mean - centre) * (n / (n + FEW)), 0.0)
    spread = np.sqrt((vectors**2 * n).sum(axis=0) / max(1, int(seen.sum())))
    return (vectors / np.where(spread > 0, spread, 1.0)).astype(np.float32)


def pooled(vectors: np.ndarray, parts: Iterator[np.ndarray]) -> np.ndarray:
    """Mean, spread and mean squared step of a text's word vectors, and the logarithm of its length."""
    total, squares, steps = np.zeros(DIM), np.zeros(DIM), np.zeros(DIM)
    n, last = 0, None
    for words in parts:
        if not len(words):
            continue
        v = vectors[words].astype(np.float64)
        total += v.sum(axis=0)
        squares += (v * v).sum(axis=0)
        way = v if last is None else np.concatenate([last, v])
        steps += (np.diff(way, axis=0) ** 2).sum(axis=0)
        n, last = n + len(words), v[-1:]
    mean = total / max(1, n)
    spread = np.sqrt(np.maximum(squares / max(1, n) - mean * mean, 0))
    return np.concatenate([mean, spread, np.log1p(steps / max(1, n - 1)), [np.log1p(n)]]).astype(np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def logits(model: dict, x: np.ndarray) -> np.ndarray:
    hidden = np.maximum(((x - model["centre"]) / model["spread"]) @ model["W"] + model["b"], 0)
    return hidden @ model["out"] + model["bias"]


def gradients(model: dict, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    """Log loss with weight decay over standardised rows, and its gradients."""
    inner = x @ model["W"] + model["b"]
    hidden = np.maximum(inner, 0)
    p = sigmoid(hidden @ model["out"] + model["bias"])
    loss = -(y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12)).mean()
    loss += DECAY / 2 * ((model["W"] ** 2).sum() + (model["out"] ** 2).sum())
    d = (p - y) / len(y)
    d_inner = d[:, None] * model["out"] * (inner > 0)
    return float(loss), {
        "W": x.T @ d_inner + DECAY * model["W"],
        "b": d_inner.sum(axis=0),
        "out": hidden.T @ d + DECAY * model["out"],
        "bias": np.array([d.sum()]),
    }


def train(x: np.ndarray, y: np.ndarray, seed: int = 7) -> dict:
    """Two layers by Adam on balanced batches of all rows."""
    rng = np.random.default_rng(seed)
    model = {
        "W": rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], HIDDEN)),
        "b": np.zeros(HIDDEN),
        "out": rng.normal(0, (2 / HIDDEN) ** 0.5, HIDDEN),
        "bias": np.zeros(1),
    }
    centre, spread = x.mean(axis=0, dtype=np.float64), x.std(axis=0, dtype=np.float64)
    spread = np.where(spread > 1e-6, spread, 1.0)
    x = (x - centre) / spread
    first, second = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    t = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(order), 1024):
            part, t = order[at : at + 1024], t + 1
            for k, g in gradients(model, x[part], y[part])[1].items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                rate = RATE * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
                model[k] = model[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-8)
    return model | {"centre": centre, "spread": spread, "shift": 0.0, "heat": 1.0}


def temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The divisor with the least log loss on held-back documents, from a fixed grid."""
    if not len(y):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.1), np.log(10), 80))
    loss = [np.logaddexp(0, np.where(y > 0, -z, z) / t).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit(x: np.ndarray, y: np.ndarray, shares: tuple[int, int]) -> dict | None:
    """A calibrated model from pooled rows and labels; none if a class is missing. ``shares``: labels of each class."""
    back = np.arange(len(y)) % 5 == 4
    if len({*y[~back]}) < 2:
        back[:] = False
    if len({*y}) < 2:
        return None
    model = train(x[~back], y[~back])
    drawn = (max(1, int((y[~back] == 0).sum())), max(1, int((y[~back] == 1).sum())))
    model["heat"] = temperature(logits(model, x[back]), y[back])
    model["shift"] = float(np.log(max(1, shares[1]) / max(1, shares[0])) - np.log(drawn[1] / drawn[0]))
    return model


def probability(model: dict | None, x: np.ndarray) -> np.ndarray:
    if model is None:
        return np.full(len(x), 0.5)
    return sigmoid(logits(model, x) / model["heat"] + model["shift"])


def held_out(doc_id: str = "doc_id") -> Column:
    """A fifth of the documents, by the CRC-32 of the id as text; rows without an id are not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5)) == 0, F.lit(False))


def pooled_rows(docs: DataFrame, vectors: np.ndarray, keep: str) -> DataFrame:
    """The columns ``keep`` (a schema) of ``docs`` and the pooled vector of each whole text."""
    names = [part.split()[0] for part in keep.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            rows = [pooled(vectors, words.of(t.as_py())) for t in batch.column(len(names))]
            out = pa.array([r.tobytes() for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], out], names=[*names, "pooled"])

    return docs.select(*names, "text").mapInArrow(run, f"{keep}, pooled binary")


def labelled(docs: DataFrame, labels: DataFrame, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple[int, int]]:
    """Pooled rows and labels of a bounded sample (the smallest hashes of each class), and the labels of each class."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out()).distinct()
    shares = {row["quality"]: row["count"] for row in known.groupBy("quality").count().collect()}
    order = F.xxhash64(F.lit("quality"), "doc_id")
    drawn = known.where("quality = 1").orderBy(order, "doc_id").limit(SAMPLE).union(
        known.where("quality = 0").orderBy(order, "doc_id").limit(SAMPLE)
    )
    # Proven bound: 2 x SAMPLE rows of two numbers.
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(drawn), "doc_id")
    rows = pooled_rows(texts.limit(4 * SAMPLE), vectors, "doc_id bigint, quality int").collect()
    rows.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"], r["quality"], bytes(r["pooled"])))
    x = np.frombuffer(b"".join(bytes(r["pooled"]) for r in rows), np.float32).reshape(len(rows), POOLED)
    return x, np.array([r["quality"] for r in rows], dtype=np.float64), (shares.get(0, 0), shares.get(1, 0))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labelled documents that are not held out, then (doc_id, held_out, score, predicted) of every row.

    Only the text is scored; texts without a word, empty and null ones alike get what the network says of no words. If no
    label of one of the classes is known, every score is a half. Labels that are null or neither 0 nor 1 are ignored; a
    document with both counts as both. Repeated rows stay; rows without doc_id are scored but not learned from. An empty
    table gives no rows. Other columns are not read.
    """
    vectors = word_vectors(*context_sums(docs))
    model = fit(*labelled(docs, labels, vectors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            x = [pooled(vectors, words.of(t.as_py())) for t in batch.column(2)]
            score = probability(model, np.array(x, dtype=np.float32).reshape(len(x), POOLED))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score, pa.float64())]
                + [pa.array((score >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), held_out().alias("held_out"), "text").mapInArrow(
        run, "doc_id bigint, held_out boolean, score double, predicted int"
    )
