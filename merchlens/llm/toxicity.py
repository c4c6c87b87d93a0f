"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained here in numpy.

Each step of the network is a word: an embedding of the word and the mean embedding of its character n-grams. A
document is read in overlapping windows of ``WINDOW`` words, ``STRIDE`` apart; its score is that of its worst window,
calibrated. Labels are of documents, so training chooses the windows: first by how much more often their words and
character n-grams are in toxic documents, then by the network itself.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.llm.common import LOWER_BYTES, word_lists
from merchlens.llm.langid import held_out

WINDOW, STRIDE = 32, 16
HIDDEN, EMBED, TABLE_BITS = 8, 8, 13
TABLE = 1 << TABLE_BITS
THRESHOLD = 0.3
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_CHARS = 1500, 3000, 20_000  # labelled documents to learn from, at most
WORDS_HELD, BATCH = 200_000, 2048
PLAIN = bytes(32 if b < 128 and not chr(b).isalnum() else b for b in LOWER_BYTES)


def text_words(text: str | None) -> Iterator[list[bytes]]:
    """Words in ASCII lower case without ASCII punctuation, piece by piece."""
    return word_lists((text or "").encode().translate(PLAIN))


def word_features(words: list[bytes]) -> dict[str, np.ndarray]:
    """Table rows of each word and of its character n-grams (3 and 4 bytes with both ends marked).

    An n-gram that would reach over its word's end has the row TABLE, which stays zero.
    """
    lengths = np.array([len(w) + 2 for w in words])
    starts = np.cumsum(lengths) - lengths
    raw = np.frombuffer(b"^" + b"$^".join(words) + b"$", dtype=np.uint8).astype(np.uint32)
    left = np.repeat(starts + lengths, lengths) - np.arange(len(raw))  # bytes to the end of the own word
    step, spread = np.uint32(0x01000193), np.uint32(2654435761)
    padded = np.append(raw, np.zeros(3, np.uint32))
    three = (padded[:-3] * step + padded[1:-2]) * step + padded[2:-1]
    four = three * step + padded[3:]
    shift = np.uint32(32 - TABLE_BITS)
    return {
        "word": np.array([zlib.crc32(w) >> (32 - TABLE_BITS) for w in words], dtype=np.int64),
        "three": np.where(left >= 3, (three * spread) >> shift, TABLE).astype(np.int64),
        "four": np.where(left >= 4, (four * spread + np.uint32(97)) >> shift, TABLE).astype(np.int64),
        "starts": starts,
        "grams": np.maximum(2 * lengths - 5, 1),
        "owner": np.repeat(np.arange(len(words)), lengths),
    }


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def new_model(seed: int = 11) -> dict[str, np.ndarray]:
    rng, d, h = np.random.default_rng(seed), 2 * EMBED, HIDDEN
    normal = lambda *shape, by: rng.normal(0, by, shape).astype(np.float32)
    model = {
        "words": normal(TABLE, EMBED, by=0.1),
        "grams": normal(TABLE + 1, EMBED, by=0.3),
        "attend": normal(2 * h, by=0.3),
        "out": normal(2 * h, by=0.3),
        "bias": np.zeros(1, np.float32),
    }
    model["grams"][TABLE] = 0
    for side in ("f", "b"):
        model |= {
            f"W{side}": normal(d, 3 * h, by=0.3),
            f"c{side}": np.zeros(3 * h, np.float32),
            f"U{side}": normal(h, 3 * h, by=0.3),
            f"n{side}": np.zeros(h, np.float32),
        }
    return model


def word_vectors(model: dict, f: dict) -> np.ndarray:
    chars = np.add.reduceat(model["grams"][f["three"]] + model["grams"][f["four"]], f["starts"], axis=0)
    return np.concatenate([model["words"][f["word"]], chars / f["grams"][:, None].astype(np.float32)], axis=1)


def _run_side(x: np.ndarray, mask: np.ndarray, u: np.ndarray, n_bias: np.ndarray, keep: bool):
    """One direction over projected inputs x (steps, batch, 3 gates). Returns outputs and, if asked, what backward needs."""
    steps, batch, h = x.shape[0], x.shape[1], HIDDEN
    state, outputs, saved = np.zeros((batch, h), np.float32), np.empty((steps, batch, h), np.float32), []
    for t in range(steps):
        g = state @ u
        gates = sigmoid(x[t, :, : 2 * h] + g[:, : 2 * h])
        z, r = gates[:, :h], gates[:, h:]
        inner = g[:, 2 * h :] + n_bias
        n = np.tanh(x[t, :, 2 * h :] + r * inner)
        m = mask[t][:, None]
        new = n + z * (state - n)
        if keep:
            saved.append((state, z, r, inner, n, m))
        state = state + m * (new - state)
        outputs[t] = state
    return outputs, saved


def forward(model: dict, projected: tuple[np.ndarray, np.ndarray], ids: np.ndarray, keep: bool = False):
    """Logits of windows ``ids`` (batch, steps); -1 pads. ``projected``: input gates of every word for both sides."""
    order = np.ascontiguousarray(ids.T)
    mask = (order >= 0).astype(np.float32)
    at = np.maximum(order, 0)
    ahead, saved_f = _run_side(projected[0][at], mask, model["Uf"], model["nf"], keep)
    back, saved_b = _run_side(projected[1][at[::-1]], mask[::-1], model["Ub"], model["nb"], keep)
    states = np.concatenate([ahead, back[::-1]], axis=2)
    energy = np.where(mask > 0, states @ model["attend"], -1e9)
    weight = np.exp(energy - energy.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = np.einsum("tb,tbh->bh", weight, states)
    logit = pooled @ model["out"] + model["bias"][0]
    return logit, (mask, at, states, weight, pooled, saved_f, saved_b)


def project(model: dict, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return vectors @ model["Wf"] + model["cf"], vectors @ model["Wb"] + model["cb"]


def _side_back(d_out: np.ndarray, saved: list, u: np.ndarray):
    """Gradients of one direction: of its projected inputs, of U and of the inner bias."""
    steps, h = d_out.shape[0], HIDDEN
    d_x, d_u, d_n = np.empty((*d_out.shape[:2], 3 * h), np.float32), np.zeros_like(u), np.zeros(h, np.float32)
    carry = np.zeros(d_out.shape[1:], np.float32)
    for t in range(steps - 1, -1, -1):
        state, z, r, inner, n, m = saved[t]
        d = d_out[t] + carry
        d_new = m * d
        d_tanh = d_new * (1 - z) * (1 - n * n)
        d_z = d_new * (state - n) * z * (1 - z)
        d_r = d_tanh * inner * r * (1 - r)
        d_x[t] = np.concatenate([d_z, d_r, d_tanh], axis=1)
        d_g = np.concatenate([d_z, d_r, d_tanh * r], axis=1)
        d_u += state.T @ d_g
        d_n += d_g[:, 2 * h :].sum(axis=0)
        carry = d - d_new + d_new * z + d_g @ u.T
    return d_x, d_u, d_n


def gradients(model: dict, f: dict, ids: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    """Log loss of a batch of windows over the words of ``f``, and its gradients."""
    vectors = word_vectors(model, f)
    logit, (mask, at, states, weight, pooled, saved_f, saved_b) = forward(model, project(model, vectors), ids, True)
    p = sigmoid(logit)
    loss = float(-(y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9)).mean())
    d = ((p - y) / len(y)).astype(np.float32)
    g = {"out": pooled.T @ d, "bias": np.array([d.sum()], np.float32)}
    d_pooled = d[:, None] * model["out"]
    d_weight = np.einsum("tbh,bh->tb", states, d_pooled)
    d_energy = weight * (d_weight - (weight * d_weight).sum(axis=0))
    d_states = weight[:, :, None] * d_pooled + d_energy[:, :, None] * model["attend"]
    g["attend"] = np.einsum("tb,tbh->h", d_energy, states)
    d_vectors, h = np.zeros_like(vectors), HIDDEN
    for side, d_out, saved, words, seen in (
        ("f", d_states[:, :, :h], saved_f, at, mask),
        ("b", d_states[::-1, :, h:], saved_b, at[::-1], mask[::-1]),
    ):
        d_x, g[f"U{side}"], g[f"n{side}"] = _side_back(d_out, saved, model[f"U{side}"])
        flat, words = (d_x * seen[:, :, None]).reshape(-1, 3 * h), words.reshape(-1)
        per_word = np.zeros((len(vectors), 3 * h), np.float32)
        np.add.at(per_word, words, flat)
        g[f"W{side}"], g[f"c{side}"] = vectors.T @ per_word, per_word.sum(axis=0)
        d_vectors += per_word @ model[f"W{side}"].T
    g["words"], g["grams"] = np.zeros_like(model["words"]), np.zeros_like(model["grams"])
    np.add.at(g["words"], f["word"], d_vectors[:, :EMBED])
    per_gram = (d_vectors[:, EMBED:] / f["grams"][:, None].astype(np.float32))[f["owner"]]
    np.add.at(g["grams"], f["three"], per_gram)
    np.add.at(g["grams"], f["four"], per_gram)
    g["grams"][TABLE] = 0
    return loss, g


class Adam:
    def __init__(self, model: dict, rate: float = 0.01) -> None:
        self.rate, self.t = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in model.items()}
        self.v = {k: np.zeros_like(v) for k, v in model.items()}

    def step(self, model: dict, g: dict) -> None:
        self.t += 1
        for k, d in g.items():
            self.m[k] += 0.1 * (d - self.m[k])
            self.v[k] += 0.001 * (d * d - self.v[k])
            at = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
            model[k] -= at * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)


def train_windows(model: dict, words: list[bytes], ids: np.ndarray, y: np.ndarray, rounds: int, adam: Adam) -> None:
    rng = np.random.default_rng(3)
    for _ in range(rounds):
        order = rng.permutation(len(ids))
        for at in range(0, len(order), 128):
            batch = ids[order[at : at + 128]]
            used, local = np.unique(batch, return_inverse=True)
            local, pad = local.reshape(batch.shape), int(used[0] < 0)
            f = word_features([words[i] for i in used[pad:]])
            adam.step(model, gradients(model, f, local - pad, y[order[at : at + 128]])[1])


def windows_of(sequence: np.ndarray) -> np.ndarray:
    """Overlapping windows over word numbers; the last one is padded with -1."""
    n = len(sequence)
    count = max(1, -(-(n - WINDOW) // STRIDE) + 1) if n else 0
    padded = np.full((count - 1) * STRIDE + WINDOW if count else 0, -1, np.int64)
    padded[:n] = sequence
    return sliding_window_view(padded, WINDOW)[::STRIDE] if count else np.zeros((0, WINDOW), np.int64)


def fit(rows: list[tuple[str, int]], seed: int = 11) -> dict | None:
    """A calibrated model from labelled texts; none if a class is missing."""
    y = np.array([toxic for _, toxic in rows])
    if not len(y) or y.min() == y.max():
        return None
    number: dict[bytes, int] = {}
    documents = [
        np.array([number.setdefault(w, len(number)) for part in text_words(t) for w in part], dtype=np.int64)
        for t, _ in rows
    ]
    words = list(number)
    if not words:
        return None
    f = word_features(words)
    # How much more often a word or one of its n-grams is in toxic documents.
    table = 3 * TABLE + 3
    of_gram = np.concatenate([f["word"], TABLE + 1 + f["three"], 2 * TABLE + 2 + f["four"]])
    owner = np.concatenate([np.arange(len(words)), f["owner"], f["owner"]])
    by_word = np.argsort(owner, kind="stable")
    of_gram, bounds = of_gram[by_word], np.searchsorted(owner[by_word], np.arange(len(words) + 1))
    back = np.arange(len(rows)) % 5 == 4  # calibration
    seen = np.zeros((2, table))
    for d in np.flatnonzero(~back):
        own = np.unique(documents[d])
        grams = np.unique(np.concatenate([of_gram[bounds[w] : bounds[w + 1]] for w in own])) if len(own) else own
        seen[y[d], grams] += 1
    many = [max(1, int((y[~back] == c).sum())) for c in (0, 1)]
    odds = np.log((seen[1] + 0.5) / (many[1] + 1)) - np.log((seen[0] + 0.5) / (many[0] + 1))
    odds[(seen[1] < 3)] = 0
    odds[[TABLE + TABLE + 1, 3 * TABLE + 2]] = 0
    evidence = np.maximum.reduceat(odds[of_gram], bounds[:-1])
    split = [windows_of(d) for d in documents]

    def strength(windows: np.ndarray) -> np.ndarray:
        value = np.where(windows >= 0, evidence[np.maximum(windows, 0)], 0)
        return np.sort(value, axis=1)[:, -2:].sum(axis=1)

    def chosen(rank, rng):
        ids, labels = [], []
        for d in np.flatnonzero(~back):
            if not len(split[d]):
                continue
            best = int(np.argmax(rank(d)))
            picks = {best} if y[d] else {best, int(rng.integers(len(split[d]))), int(rng.integers(len(split[d])))}
            for w in sorted(picks):
                ids.append(split[d][w])
                labels.append(y[d])
        return np.array(ids), np.array(labels, dtype=np.float32)

    model, rng = new_model(seed), np.random.default_rng(seed)
    adam = Adam(model)
    ids, labels = chosen(lambda d: strength(split[d]), rng)
    if not len(ids):
        return None
    train_windows(model, words, ids, labels, 4, adam)

    def logits() -> list[np.ndarray]:
        inputs = project(model, word_vectors(model, f))
        stacked = np.concatenate(split)
        out = [forward(model, inputs, stacked[i : i + BATCH])[0] for i in range(0, len(stacked), BATCH)]
        return np.split(np.concatenate(out), np.cumsum([len(s) for s in split])[:-1])

    scores = logits()
    ids, labels = chosen(lambda d: scores[d], rng)
    train_windows(model, words, ids, labels, 3, adam)
    scores = logits()
    known = [d for d in np.flatnonzero(back) if len(split[d])] or [d for d in range(len(rows)) if len(split[d])]
    model["scale"] = np.array(calibrate(np.array([scores[d].max() for d in known]), y[known]))
    return model


def calibrate(x: np.ndarray, y: np.ndarray, rounds: int = 200) -> tuple[float, float]:
    """Slope and intercept of a logistic fit, held near (1, 0) by a weak penalty."""
    a, b = 1.0, 0.0
    for _ in range(rounds):
        e = sigmoid(np.clip(a * x + b, -30, 30)) - y
        a -= 0.5 * ((e * x).mean() / (1 + (x * x).mean()) + 0.01 * (a - 1))
        b -= 0.5 * (e.mean() + 0.01 * b)
    return max(a, 0.05), b


def scores_of(model: dict, texts: Iterator[str | None], count: int) -> np.ndarray:
    """Score of each text: the worst of all its overlapping windows; 0 for texts without words.

    Words are numbered anew when ``WORDS_HELD`` different ones have come, so memory does not grow with a text.
    """
    best, local, held = np.full(count, -np.inf), {}, []

    def numbers(words: list[bytes]) -> np.ndarray:
        for w in set(words).difference(local):
            local[w] = len(local)
        return np.fromiter(map(local.__getitem__, words), np.int64, len(words))

    def flush() -> None:
        if not held:
            return
        inputs = project(model, word_vectors(model, word_features(list(local))))
        ids, owners = np.concatenate([w for _, w in held]), np.repeat([d for d, _ in held], [len(w) for _, w in held])
        for at in range(0, len(ids), BATCH):
            np.maximum.at(best, owners[at : at + BATCH], forward(model, inputs, ids[at : at + BATCH])[0])
        local.clear()
        held.clear()

    for d, text in enumerate(texts):
        rest: list[bytes] = []
        first = True
        for words in text_words(text):
            words = rest + words
            full = (len(words) - WINDOW) // STRIDE + 1 if len(words) >= WINDOW else 0
            if full:
                ids = numbers(words[: (full - 1) * STRIDE + WINDOW])
                held.append((d, np.ascontiguousarray(sliding_window_view(ids, WINDOW)[::STRIDE])))
                first = False
            rest = words[full * STRIDE :]
            if len(local) > WORDS_HELD:
                flush()
        if len(rest) > (0 if first else WINDOW - STRIDE):
            ids = np.full((1, WINDOW), -1, np.int64)
            ids[0, : len(rest)] = numbers(rest)
            held.append((d, ids))
    flush()
    a, b = model["scale"]
    return np.where(np.isfinite(best), sigmoid(np.clip(a * np.where(np.isfinite(best), best, 0) + b, -50, 50)), 0.0)


def labelled(docs: DataFrame, labels: DataFrame) -> list[tuple[str, int]]:
    """The bounded sample: not held out, the smallest hashes of each class, texts of at most SAMPLE_CHARS."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out()).distinct()
    order = F.xxhash64(F.lit("toxic"), "doc_id")
    drawn = known.where("toxic = 1").orderBy(order, "doc_id").limit(SAMPLE_TOXIC).union(
        known.where("toxic = 0").orderBy(order, "doc_id").limit(SAMPLE_CLEAN)
    )
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where(F.length("text") <= SAMPLE_CHARS)
    # Proven bound: SAMPLE_TOXIC + SAMPLE_CLEAN rows of two numbers.
    rows = texts.join(F.broadcast(drawn), "doc_id").limit(2 * (SAMPLE_TOXIC + SAMPLE_CLEAN)).collect()
    rows = sorted(((r["doc_id"], r["text"], r["toxic"]) for r in rows), key=lambda r: (zlib.crc32(str(r[0]).encode()), r))
    return [(text, toxic) for _, text, toxic in rows]


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labelled documents that are not held out, then (doc_id, held_out, score, predicted) of every row.

    Only the text is scored. Null and empty texts and texts without a word score 0, and so does everything if no
    label of one of the classes is known. Labels that are null or neither 0 nor 1 are ignored; a document with both
    counts as both. Repeated rows stay; rows without doc_id are scored but not learned from. An empty table gives no
    rows. Other columns are not read.
    """
    model = fit(labelled(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            score = scores_of(model, (t.as_py() for t in batch.column(2)), n) if model else np.zeros(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score, pa.float64())]
                + [pa.array((score >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), held_out().alias("held_out"), "text").mapInArrow(
        run, "doc_id bigint, held_out boolean, score double, predicted int"
    )
