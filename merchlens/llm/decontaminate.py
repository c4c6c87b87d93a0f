"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The words of a test item, its pairs of neighbouring words and its pairs of words one apart are counted over all
documents. The rarer half of an item's neighbouring pairs (eight at least) and its eight rarest pairs one apart are its
seeds. Where a document has a seed, the words around it are aligned with the item; matches weigh by the rarity of the
word, so chance agreement in common words scores little, and edited, shortened or reordered copies still reach a good
part of the item's own score. An excerpt of a long item does not; so a passage also counts if an alignment that counts
words, less half a word for a gap or a mismatch, reaches ``RUN``. Every ``INTACT`` words of an item hold a seed, so none
with up to three changes is missed. A part of an item that any text could hold by chance, such as two common words, is
no copy: its score must also reach ``EVIDENCE`` more than the logarithm of the number of documents.

The test items are held in every task, in blocks of ``BLOCK_ITEMS`` or some ``BLOCK_BYTES``: a larger benchmark takes
more passes. One item must fit in a task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.llm.common import LOWER_BYTES, PIECE

BLOCK_ITEMS, BLOCK_BYTES = 20_000, 1 << 24
LEAST_SEEDS = 8
INTACT = 4  # words of an item in a row that hold a seed
SCORE = 0.4  # of the item's score against itself
EVIDENCE = 8.0  # what a score must be at least beyond the logarithm of the number of documents
PENALTY = 0.1  # of the item's mean word weight, for a gap or a mismatch
ROWS_HELD = 64  # items whose lookup rows a task keeps
RUN, DEAR = 13, 0.5  # words that are a copy however long the item is, and what a gap or a mismatch costs of them

#: Scripts without spaces between words: each character is a word.
UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")
#: Lower case, and ASCII punctuation counts as white space.
PLAIN = bytes(32 if b < 128 and not chr(b).isalnum() else b for b in LOWER_BYTES)


def plain(text: str | None) -> bytes:
    text = text or ""
    data = text.encode()
    # Scripts without spaces lie where UTF-8 takes three bytes: most texts need no search.
    if not text.isascii() and np.frombuffer(data, np.uint8).max() >= 0xE0:
        data = UNSPACED.sub(r" \1 ", text).encode()
    return data.translate(PLAIN)


def numbered(text: str | None, vocabulary: dict[bytes, int]) -> np.ndarray:
    """The words of a text as numbers, 0 for words of no test item; a long text goes piece by piece."""
    data, get, parts, start = plain(text), vocabulary.get, [], 0
    while start < len(data):
        end = len(data) if start + PIECE >= len(data) else data.find(b" ", start + PIECE)
        end = len(data) if end < 0 else end
        words = data[start:end].split()
        parts.append(np.fromiter(map(get, words, repeat(0)), np.int32, len(words)))
        start = end
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


class Items:
    """A block of test items with their words and pairs (neighbours, and words one apart) as numbers."""

    def __init__(self, rows: list[tuple[int, str | None]]) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.ids, self.words = [], []
        for item, text in rows:
            own = plain(text).split()
            self.ids.append(item)
            self.words.append(
                np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in own], dtype=np.int64)
            )
        self.size = len(self.vocabulary) + 1
        near = [self.pairs(w, 1) for w in self.words]
        apart = [self.pairs(w, 2) for w in self.words]
        self.codes = np.unique(np.concatenate(near + apart)) if near else np.zeros(0, np.int64)
        self.of_item = [np.searchsorted(self.codes, p) for p in near]
        self.apart_of_item = [np.searchsorted(self.codes, p) for p in apart]

    def pairs(self, words: np.ndarray, step: int) -> np.ndarray:
        """Code of each word and the one ``step`` behind it; words of no item have the number 0."""
        return (words[:-step].astype(np.int64) * self.size + words[step:]) * 2 + (step - 1)

    def places(self, words: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the words' pairs that are among the sorted ``codes``, and which code each is."""
        known = words > 0
        at = [np.flatnonzero(known[:-step] & known[step:]) for step in (1, 2)]
        pairs = np.concatenate([self.pairs(words, step)[own] for step, own in zip((1, 2), at, strict=True)])
        at = np.concatenate(at)
        where = np.minimum(np.searchsorted(codes, pairs), len(codes) - 1)
        hit = codes[where] == pairs if len(codes) else at < 0
        return at[hit], where[hit]


def frequencies(docs: DataFrame, items: Items) -> tuple[int, np.ndarray, np.ndarray]:
    """Documents in all, with each word, and with each pair of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs, n = np.zeros(items.size, np.int64), np.zeros(len(items.codes), np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                numbers = numbered(text.as_py(), items.vocabulary)
                words[np.unique(numbers)] += 1
                pairs[np.unique(items.places(numbers, items.codes)[1])] += 1
                n += 1
        counts = np.concatenate([[n], words[1:], pairs])
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["what", "n"])

    rows = docs.select("text").mapInArrow(run, "what bigint, n bigint").groupBy("what").agg(F.sum("n").alias("n"))
    counts = np.zeros(items.size + len(items.codes), np.int64)
    for what, n in rows.collect():  # one row per word or pair of the block's items
        counts[what] = n
    return int(counts[0]), np.concatenate([[0], counts[1 : items.size]]), counts[items.size :]


def align(words: np.ndarray, item: np.ndarray, weight: np.ndarray, penalty: float) -> tuple[float, int]:
    """Best local alignment score and the position behind its last word, by Smith-Waterman, row by row.

    Within a row the best gap from the left is a running maximum, so a row is a few vector operations.
    """
    slope = penalty * np.arange(len(words) + 1)
    above, best, end = np.zeros(len(words) + 1), 0.0, 0
    for word in item:
        match = np.where(words == word, weight[word], -penalty)
        here = np.maximum(above - penalty, 0.0)
        here[1:] = np.maximum(here[1:], above[:-1] + match)
        here = np.maximum.accumulate(here + slope) - slope
        top = int(np.argmax(here))
        if here[top] > best + 1e-12:
            best, end = float(here[top]), top
        above = here
    return best, end


def may_hold(inside: np.ndarray) -> bool:
    """Whether an alignment by words could reach ``RUN``; ``inside``: which of the text's words are the item's at all."""
    total = np.zeros(len(inside) + 1)
    np.cumsum((1 + DEAR) * inside - DEAR, out=total[1:])
    return bool((total - np.minimum.accumulate(total)).max() >= RUN)


class Matcher:
    """Finds and scores the items of a block in a text."""

    def __init__(self, items: Items, documents: int, words: np.ndarray, pairs: np.ndarray, score: float) -> None:
        self.items, self.score = items, score
        self.weight = np.log((documents + 1) / (words + 0.5)) + 1.0
        self.weight[0] = 0.0
        self.one = np.ones(len(self.weight))
        self.total = [float(self.weight[w].sum()) for w in items.words]
        self.least = float(np.log(documents + 1)) + EVIDENCE
        self.rows: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        seeds: list[tuple[int, int, int]] = []
        for number, (own, apart) in enumerate(zip(items.of_item, items.apart_of_item, strict=True)):
            order = np.argsort(pairs[own], kind="stable")[: max(LEAST_SEEDS, -(-len(own) // 2))]
            chosen = set(order.tolist())
            for at in range(len(own) - INTACT + 2):  # words have one pair less
                if chosen.isdisjoint(range(at, at + INTACT - 1)):
                    chosen.add(at + int(np.argmin(pairs[own[at : at + INTACT - 1]])))
            seeds += [(int(own[at]), number, at) for at in sorted(chosen)]
            rare = np.argsort(pairs[apart], kind="stable")[:LEAST_SEEDS]
            seeds += [(int(apart[at]), number, int(at)) for at in sorted(rare.tolist())]
        seeds.sort()
        table = np.array(seeds, dtype=np.int64).reshape(len(seeds), 3)
        used, self.first = np.unique(table[:, 0], return_index=True)
        self.codes = items.codes[used]
        self.last = np.append(self.first[1:], len(table)).astype(np.int64)
        self.item, self.offset = table[:, 1], table[:, 2]

    def windows(self, numbers: np.ndarray) -> dict[int, list[int]]:
        """For each item where in the text it would start by a seed, half an item apart at least."""
        at, seed = self.items.places(numbers, self.codes)
        if not len(at):
            return {}
        times = self.last[seed] - self.first[seed]
        flat = np.repeat(self.first[seed], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        item, start = self.item[flat], np.repeat(at, times) - self.offset[flat]
        order = np.lexsort((start, item))
        out: dict[int, list[int]] = {}
        for number, begin in zip(item[order].tolist(), start[order].tolist(), strict=True):
            own = out.setdefault(number, [])
            if not own or begin > own[-1] + len(self.items.words[number]) // 2:
                own.append(begin)
        return out

    def row(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """For each word of the vocabulary its place among the item's different words, or -1; and these words' weights."""
        if number not in self.rows:
            if len(self.rows) >= ROWS_HELD:
                self.rows.clear()
            different, times = np.unique(self.items.words[number], return_counts=True)
            place = np.full(len(self.weight), -1, np.int32)
            place[different] = np.arange(len(different))
            self.rows[number] = place, self.weight[different] * times
        return self.rows[number]

    def matches(self, text: str | None) -> Iterator[tuple[int, float, int]]:
        """(item id, score, position behind the passage) of the best passage of each leaked item."""
        numbers = numbered(text, self.items.vocabulary)
        for number, starts in self.windows(numbers).items():
            words, total = self.items.words[number], self.total[number]
            place, weights = self.row(number)
            wide, best, end, copied = len(words), 0.0, 0, False
            enough = max(self.score * total, self.least)
            for start in starts:
                low = max(0, start - wide // 2)
                part = numbers[low : start + 2 * wide]
                own = place[part]
                inside = own >= 0
                dense = not copied and np.count_nonzero(inside) >= RUN and may_hold(inside)
                # No alignment can score more than the item's words that occur here at all.
                if not dense and weights[np.bincount(own[inside], minlength=len(weights)) > 0].sum() < enough:
                    continue
                value, last = align(part, words, self.weight, PENALTY * total / wide)
                if value > best:
                    best, end = value, low + last
                if dense and value < enough:
                    copied = align(part, words, self.one, DEAR)[0] >= RUN
            if copied or best >= enough:
                yield self.items.ids[number], round(best / total, 6), end


def matchers(docs: DataFrame, benchmark: DataFrame, score: float = SCORE) -> Iterator[Matcher]:
    """One matcher for each block of test items."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text IS NOT NULL")
    size = items.agg(F.count("*").alias("n"), F.sum(F.octet_length("text").cast("bigint")).alias("bytes")).first()
    blocks = max(-(-size["n"] // BLOCK_ITEMS), -(-(size["bytes"] or 0) // BLOCK_BYTES))
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = sorted(((r["item_id"], r["text"]) for r in part.collect()), key=repr)
        held = Items(rows)
        yield Matcher(held, *frequencies(docs, held), score)


def leaks(docs: DataFrame, benchmark: DataFrame, score: float = SCORE) -> DataFrame:
    """(doc_id, item_id, score, end_word) of every document and test item of which it holds a copy.

    score is the share of the item's weight that the best passage reaches (1: word for word); end_word counts the
    document's words up to the end of that passage. Words are compared in ASCII lower case without ASCII punctuation.
    Passages whose words any document could hold by chance, however much of a short item they are, are not reported.
    A document also holds a copy if 13 words of the item stand in it in a row, or more with a few changes, however small
    a part of the item that is. In scripts without spaces each character is a word. Items of one word and null or empty
    texts match nothing. Repeated rows are judged like others; equal items each
    match. Rows without doc_id are reported with a null. Empty tables give no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    out = spark.createDataFrame([], "doc_id bigint, item_id bigint, score double, end_word bigint")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    for matcher in matchers(docs, benchmark, score):

        def run(batches: Iterator[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [
                    (doc, *found)
                    for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)
                    for found in matcher.matches(text.as_py())
                ]
                doc, item, value, end = zip(*rows, strict=True) if rows else ([], [], [], [])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(doc), pa.int64()), pa.array(list(item), pa.int64())]
                    + [pa.array(list(value), pa.float64()), pa.array(list(end), pa.int64())],
                    names=["doc_id", "item_id", "score", "end_word"],
                )

        out = out.union(texts.mapInArrow(run, "doc_id bigint, item_id bigint, score double, end_word bigint"))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, score: float = SCORE) -> DataFrame:
    """The rows of ``docs`` that hold no copy of a test item, with all their columns; no shuffle."""
    # The row travels as one struct: its columns may have any name.
    out = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    for matcher in matchers(docs, benchmark, score):

        def run(batches: Iterator[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = [next(matcher.matches(t.as_py()), None) is None for t in batch.column(0).field("text")]
                yield batch.filter(pa.array(clean, pa.bool_()))

        out = out.mapInArrow(run, out.schema)
    return out.select("row.*")
