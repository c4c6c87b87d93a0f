"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Trained with follow-the-regularised-leader and elastic-net penalties on a bounded sample, calibrated by one
temperature. Document frequencies are counted over all documents that may be learned from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.llm.common import once

BITS = 14
DIM = 1 << BITS
CHARS_HELD = 1 << 20
PER_LANGUAGE = 500  # documents of each language in the training sample
SAMPLE, FEWEST = 100_000, 20  # documents in the whole sample, if there are many languages, and of each at least
SPREAD = np.uint32(2654435761)


def _letters() -> np.ndarray:
    """Each code point below 65,536 itself if it is a letter, else a blank."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(1 << 16)], dtype=np.uint32)


def _letter_codes(text: str) -> np.ndarray:
    table = once("letters", _letters)
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    plain = table[np.minimum(codes, 65535)]
    for code in np.unique(codes[codes > 65535]):
        plain[codes == code] = code if chr(int(code)).isalpha() else 32
    return plain


def gram_counts(text: str | None) -> tuple[np.ndarray, bool]:
    """Counts of hashed character n-grams (1 to 3 letters, lower case, blanks for all else), and whether any is a letter."""
    counts, letter = np.zeros(DIM, np.int64), False
    text = text or ""
    for start in range(0, len(text), CHARS_HELD):
        # Pieces overlap by two characters; the shorter n-grams of the overlap count in the first piece only.
        skip = min(start, 2)
        c = _letter_codes(text[start - skip : start + CHARS_HELD].lower())
        letter = letter or bool((c != 32).any())
        two = c[:-1] * np.uint32(0x01000193) + c[1:]
        three = two[:-1] * np.uint32(0x01000193) + c[2:]
        for order, grams in ((1, c[skip:]), (2, two[max(0, skip - 1) :]), (3, three)):
            hashed = (grams + np.uint32(order * 7919)) * SPREAD
            counts += np.bincount(hashed >> np.uint32(32 - BITS), minlength=DIM)
    return counts, letter


def features(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-zero TF-IDF features of unit length."""
    at = np.flatnonzero(counts)
    value = (1 + np.log(counts[at])) * idf[at]
    norm = np.sqrt((value * value).sum())
    return at, value / (norm or 1.0)


def _weights(z: np.ndarray, n: np.ndarray, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(
    samples: list[tuple[np.ndarray, np.ndarray, int]],
    classes: int,
    rounds: int = 4,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.1,
) -> np.ndarray:
    """Follow the regularised leader, one sample at a time; the last row holds the intercepts."""
    z, n = np.zeros((DIM + 1, classes)), np.zeros((DIM + 1, classes))
    order = np.random.default_rng(5)
    for _ in range(rounds):
        for s in order.permutation(len(samples)):
            at, x, y = samples[s]
            at, x = np.append(at, DIM), np.append(x, 1.0)
            w = _weights(z[at], n[at], alpha, beta, l1, l2)
            error = softmax(x @ w)
            error[y] -= 1
            g = x[:, None] * error
            squared = g * g
            sigma = (np.sqrt(n[at] + squared) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += squared
    return _weights(z, n, alpha, beta, l1, l2)


def temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the scores with the least log loss on held-back documents, from a fixed grid."""
    if not len(y):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(5), 60))
    loss = [-np.log(softmax(scores / t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def held_out(doc_id: str = "doc_id") -> Column:
    """A quarter of the documents, by the CRC-32 of the id as text; rows without an id are not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == 2, F.lit(False))


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """In how many documents each hashed n-gram is; one row per n-gram and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIM, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                total += gram_counts(text.as_py())[0] > 0
                n += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(total[at], n))], names=["gram", "n"]
        )

    rows = docs.select("text").mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    frequency, n = np.zeros(DIM, np.int64), 0
    for gram, count in rows.collect():  # at most DIM + 1 rows
        if gram < 0:
            n = count
        else:
            frequency[gram] = count
    return n, frequency


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[str], list[tuple[np.ndarray, int, bool]]]:
    """Languages and (counts, language, held back for calibration) of a bounded sample, even over the languages.

    Of every language a share of its documents by a hash of the id, about ``per_language`` of them, fewer if that made
    more than ``SAMPLE`` in all, ``FEWEST`` at least; together never more than four times as many. The model has a
    column for every language, however rare.
    """
    sizes = docs.groupBy("lang").count().collect()
    if not sizes:
        return [], []
    wanted = max(FEWEST, min(per_language, SAMPLE // len(sizes)))
    dice = F.pmod(F.xxhash64(F.lit("lang"), "doc_id"), F.lit(1_000_000)) / 1_000_000
    shares = [(r["lang"], min(1.0, wanted / r["count"])) for r in sizes]
    # One row of two values per language.
    share = F.broadcast(docs.sparkSession.createDataFrame(shares, "lang string, share double"))
    chosen = docs.join(share, "lang").where(dice < F.col("share")).limit(4 * wanted * len(sizes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [gram_counts(t.as_py())[0] for t in batch.column("text")]
            at = [np.flatnonzero(c) for c in counts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("lang"),
                    pa.array([a.astype(np.uint16).tobytes() for a in at], pa.binary()),
                    pa.array([c[a].astype(np.uint32).tobytes() for c, a in zip(counts, at, strict=True)], pa.binary()),
                ],
                names=["doc_id", "lang", "at", "counts"],
            )

    rows = chosen.select("doc_id", "lang", "text").mapInArrow(run, "doc_id bigint, lang string, at binary, counts binary")
    languages, out = sorted(r["lang"] for r in sizes), []
    number = {lang: i for i, lang in enumerate(languages)}
    for row in sorted(rows.collect(), key=lambda r: (r["doc_id"], r["lang"], r["at"], r["counts"])):
        counts = np.zeros(DIM, np.int64)
        counts[np.frombuffer(row["at"], np.uint16)] = np.frombuffer(row["counts"], np.uint32)
        at = np.flatnonzero(counts)
        out.append(((at, counts[at]), number[row["lang"]], row["doc_id"] % 5 == 0))
    return languages, out


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> dict:
    """A model from the text and lang of ``docs``; rows without either are not learned from."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    languages, drawn = sample(known, per_language)
    if not languages:
        return {"languages": []}
    n, frequency = document_frequencies(known)
    idf = np.log((1 + n) / (1 + frequency)) + 1

    def made(at, counts):
        value = (1 + np.log(counts)) * idf[at]
        return value / (np.sqrt((value * value).sum()) or 1.0)

    samples = [(at, made(at, counts), y, back) for (at, counts), y, back in drawn]
    learned = [(a, x, y) for a, x, y, back in samples if not back] or [(a, x, y) for a, x, y, _ in samples]
    weights = train(learned, len(languages))
    back = [(x @ weights[a] + weights[DIM], y) for a, x, y, b in samples if b]
    scores = np.array([s for s, _ in back]).reshape(len(back), len(languages))
    heat = temperature(scores, np.array([y for _, y in back], dtype=np.int64))
    return {"languages": languages, "idf": idf, "weights": weights.astype(np.float32), "temperature": heat}


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every whole text; no shuffle."""
    languages = model["languages"]

    def one(text: str | None) -> tuple[str, float]:
        counts, letter = gram_counts(text)
        if not letter or not languages:
            return "und", 0.0
        at, x = features(counts, model["idf"])
        scores = x @ model["weights"][at] + model["weights"][DIM]
        p = softmax(scores.astype(np.float64) / model["temperature"])
        best = int(np.argmax(p))
        return languages[best], float(p[best])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [one(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), held_out().alias("held_out"), "text").mapInArrow(
        run, "doc_id bigint, held_out boolean, lang_pred string, score double"
    )


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Learn from the documents that are not held out, then (doc_id, held_out, lang_pred, score) of every row.

    lang_pred is a learned language; ``und`` with score 0 for null texts, texts without a letter, and if nothing could
    be learned. Ties go to the first language by name. Repeated rows stay; rows without doc_id are predicted but not
    learned from. An empty table gives no rows. Other columns are not read.
    """
    return predict(docs, fit(docs.where(~held_out()).select("doc_id", "text", "lang"), per_language))
