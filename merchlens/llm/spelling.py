"""Spelling variants: words one edit apart, found by dense prefix-suffix tiling.

Two words differ by exactly one inserted, deleted or replaced code point if their common prefix and their common suffix
together reach the longer length minus one. Words are held as padded matrices of code points, once aligned left and once
aligned right; two blocks of such rows are compared as a whole, which gives the prefix and suffix length of every pair.

One edit leaves the first or the last half of the shorter word as it is, so only blocks of words that share one of the
two halves are compared: words of one length, and they with the words one longer. A half that many words share is cut
into blocks, and every pair of its blocks is a row of its own that any task can take.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.llm.common import LOWER_BYTES, PIECE, written

MIN_LENGTH, MIN_COUNT, CLEARLY, DROP = 6, 5, 5, 199
RUN = re.compile("[a-zÀ-ÿ]+")
LONG_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % MIN_LENGTH)
COUNTS_HELD = 100_000  # words and letters of words that a task counts before it hands them on
HELD_LETTERS = 4_000_000
BLOCK_LETTERS = 16_384  # code points of a block, one word at least
CELLS = 1 << 20  # pairs of a tile at once
TASK_PAIRS = 1 << 27  # pairs that one task compares, about


def runs(text: str | None) -> Iterator[list[str]]:
    """The letter runs of ``MIN_LENGTH`` code points at least, in ASCII lower case, piece by piece."""
    text, start = text or "", 0
    while start < len(text):
        end = min(start + PIECE, len(text))
        while end < len(text) and RUN.match(text[end].lower() if text[end].isascii() else text[end]):
            end += 1
        yield LONG_RUN.findall(text[start:end].encode("utf-8", "replace").translate(LOWER_BYTES).decode())
        start = end


def spoken(doc_id: int | None, run: str, prefix: int) -> str:
    """The run, without one code point where the checksum of document and run says so."""
    h = zlib.crc32(run.encode(), prefix)
    return run if h % DROP else run[: h % len(run)] + run[h % len(run) + 1 :]


def count_words(docs: DataFrame, least: int = MIN_COUNT) -> DataFrame:
    """(word, n) of every word of ``MIN_LENGTH`` code points at least with ``least`` occurrences in all whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        letters = 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for found in runs(text.as_py()):
                    for word, n in Counter(found).items():
                        word = spoken(doc_id, word, prefix)
                        if len(word) >= MIN_LENGTH:
                            if word not in total:
                                letters += len(word)
                            total[word] += n
                    if len(total) > COUNTS_HELD or letters > HELD_LETTERS:
                        yield out()
                        total.clear()
                        letters = 0
        if total:
            yield out()

    pairs = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    counted = pairs.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least)


def halves(word: Column) -> Column:
    """The places where a word can meet others: (length of the shorter word, end, half of that length).

    A word meets words of its own length and one longer as the shorter one, and words one shorter as the longer one.
    """
    size = F.length(word)

    def places(shorter: Column) -> list[Column]:
        half = F.floor(shorter / 2).cast("int")
        return [
            F.struct(shorter.alias("size"), F.lit("left").alias("side"), F.left(word, half).alias("half")),
            F.struct(shorter.alias("size"), F.lit("right").alias("side"), F.right(word, half).alias("half")),
        ]

    return F.array(*places(size), *places(size - 1))


def padded(words: list[str], wide: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, word) matrices of code points, aligned left and aligned right (read backwards), with zeros behind."""
    left, right = np.zeros((wide, len(words)), np.uint8), np.zeros((wide, len(words)), np.uint8)
    for at, word in enumerate(words):
        codes = np.frombuffer(word.encode("latin-1"), np.uint8)  # all letters lie below U+0100
        left[: len(codes), at], right[: len(codes), at] = codes, codes[::-1]
    return left, right


def shared(a: np.ndarray, b: np.ndarray, known: int = 0) -> np.ndarray:
    """How many code points each word of ``a`` has in common with each of ``b`` from the start, where ``known`` are.

    One position at a time for the whole tile, until no pair goes on.
    """
    going = np.ones((a.shape[1], b.shape[1]), bool)
    count = np.full(going.shape, known, np.uint8 if len(a) < 255 else np.uint32)
    for one, two in zip(a[known:], b[known:], strict=True):
        going &= one[:, None] == two[None, :]
        if not going.any():
            break
        count += going
    return count


def near_pairs(a: list[str], b: list[str] | None, shorter: int, side: str) -> Iterator[tuple[int, int]]:
    """Places (in ``a``, in ``b``; in ``a`` twice if ``b`` is None) of near words, one of which has length ``shorter``.

    Pairs that share both halves are left to the left side.
    """
    own, b = b is None, a if b is None else b
    wide = shorter + 1
    sizes = [np.array([len(w) for w in part]) for part in (a, b)]
    step = max(1, int(CELLS**0.5))
    half = shorter // 2
    known = (half, 0) if side == "left" else (0, half)
    for i in range(0, len(a), step):
        left_a, right_a = padded(a[i : i + step], wide)
        for j in range(i if own else 0, len(b), step):
            left_b, right_b = padded(b[j : j + step], wide)
            size_a, size_b = sizes[0][i : i + step, None], sizes[1][None, j : j + step]
            least, most = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
            prefix = np.minimum(shared(left_a, left_b, known[0]), least)
            suffix = np.minimum(shared(right_a, right_b, known[1]), least)
            found = (prefix + suffix >= most - 1) & (least == shorter)
            if side == "right":
                found &= prefix < half
            if own and i == j:
                found &= np.arange(len(size_a))[:, None] < np.arange(size_b.shape[1])[None, :]
            for x, y in zip(*np.nonzero(found), strict=True):
                if a[i + x] != b[j + y]:
                    yield i + int(x), j + int(y)


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per pair of blocks: their words and counts."""
    for batch in batches:
        found: list[tuple[str, int, str, int]] = []
        for row in batch.to_pylist():
            a, b = row["a"], None if row["lo"] == row["hi"] else row["b"]
            words = [[x["word"] for x in a], None if b is None else [x["word"] for x in b]]
            for x, y in near_pairs(*words, row["size"], row["side"]):
                one, two = a[x], (a if b is None else b)[y]
                found.append((one["word"], one["n"], two["word"], two["n"]))
                if len(found) >= COUNTS_HELD:
                    yield _pairs(found)
                    found = []
        yield _pairs(found)


def _pairs(found: list[tuple[str, int, str, int]]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) or [()] * 4
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)], names=["one", "n_one", "two", "n_two"]
    )


def near_words(counts: DataFrame) -> DataFrame:
    """(one, n_one, two, n_two) of every pair of near words of ``counts`` (different words), each pair once.

    Halves are shared by two sizes of words; a half shared by more than a block's letters is cut by the hash of the word,
    and each pair of its blocks meets once. Blocks that no shorter word is in can hold no pair.
    """
    place = F.explode(halves(F.col("word"))).alias("place")
    listed = written(counts.select("word", "n", place).select("word", "n", "place.*"), "halves")
    key = ["size", "side", "half"]
    groups = listed.groupBy(*key).agg(
        F.sum(F.length("word")).alias("letters"), F.count("*").alias("words"), F.min(F.length("word")).alias("least")
    )
    groups = groups.where((F.col("words") > 1) & (F.col("least") == F.col("size")))
    groups = groups.select(*key, F.ceil(F.col("letters") / BLOCK_LETTERS).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    held = listed.join(groups, key).select(*key, "blocks", mine.alias("block"), F.struct("word", "n").alias("entry"))
    blocks = held.groupBy(*key, "blocks", "block").agg(F.collect_list("entry").alias("a"), F.count("*").alias("words"))
    blocks = written(blocks, "blocks")
    work = blocks.agg(F.sum(F.col("words") * F.col("words") * F.col("blocks"))).first()[0] or 0
    tasks = max(int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(work) // TASK_PAIRS + 1)
    # Block i meets itself and those behind it: each block is copied to the pairs it is in.
    pairs = blocks.select(*key, "block", "a", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    lo, hi = F.least("block", "other"), F.greatest("block", "other")
    pairs = pairs.select(*key, lo.alias("lo"), hi.alias("hi"), "block", "a")
    first = pairs.where("block = lo").drop("block")
    second = pairs.where("block = hi AND lo < hi").select(*key, "lo", "hi", F.col("a").alias("b"))
    # Tiles differ in work, not in bytes: adaptive execution would put too many of them into one task.
    tiles = first.join(second, [*key, "lo", "hi"], "left").where("lo = hi OR b IS NOT NULL").repartition(tasks)
    schema = "one string, n_one bigint, two string, n_two bigint"
    return tiles.select("size", "side", "lo", "hi", "a", "b").mapInArrow(_tiles, schema)


def roots(links: DataFrame) -> DataFrame:
    """(word, root): from each word of ``links`` (word, form) follow the forms to the last, by pointer doubling.

    Counts grow at least fivefold along a chain, so there is an end after some log2(log5(n)) rounds.
    """
    now = written(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = written(now.join(ahead, "root", "left"), "roots")
        if moved.where("further IS NOT NULL").isEmpty():
            return now
        now = moved.select("word", F.coalesce("further", "root").alias("root"))


def group_variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every frequent word of ``docs`` (doc_id, text).

    Null and empty texts have no words; a null doc_id counts as the empty text in the checksum. Rows that share a
    doc_id and repeated rows all count. Ties for the form go to the smallest word in code-point order. An empty table
    gives no rows. Other columns are not read.
    """
    counts = written(count_words(docs), "counts")
    pairs = near_words(counts)
    both = pairs.select(F.col("one").alias("word"), F.col("two").alias("near"), F.col("n_two").alias("near_n")).union(
        pairs.select(F.col("two").alias("word"), F.col("one").alias("near"), F.col("n_one").alias("near_n"))
    )
    # Largest n, then smallest word: Spark compares strings by their UTF-8 bytes, which is code-point order.
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")
    )
    best = best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.minus")).alias("near_n"))
    is_form = F.col("near_n") >= CLEARLY * F.col("n")
    formed = written(
        counts.join(best, "word", "left").select(
            "word",
            F.when(is_form, F.col("near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(is_form, F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    last = roots(formed.where("form IS NOT NULL"))
    return formed.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
