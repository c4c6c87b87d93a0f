"""Vector code compression: integer product codes, the nearest entries found by a GNAT over each codebook.

Vectors become integers and are cut into ``PARTS`` parts, each with a codebook of ``ENTRIES`` entries refined in
``ROUNDS`` rounds. An entry is found by a geometric near-neighbour access tree: a node has a few split points, and for
each child and split point the least and the greatest distance between them. A part's distances to the split points
rule out whole children whose range cannot hold anything as near as the best so far. Only the ranges use rounded square
roots, with a margin that errs to the safe side; distances themselves, and so ties, are decided in whole numbers.

A round is one pass over the written integers: tasks add up sums and counts per entry, of which the driver sees
PARTS x ENTRIES x (length of a part + 1) numbers, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.llm.common import written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
DEGREE = 4  # split points of a node
MARGIN = 1e-9  # relative, far above the error of a rounded square root
HELD = 4096  # vectors that a task assigns at once
SALTS = 16


class Gnat:
    """Nearest entry of a codebook, exactly, for many integer vectors at once; ties go to the lower number."""

    def __init__(self, entries: np.ndarray, numbers: np.ndarray | None = None) -> None:
        self.numbers = np.arange(len(entries)) if numbers is None else numbers
        chosen = [0]
        apart = squared(entries, entries[:1])[:, 0]
        while len(chosen) < min(DEGREE, len(entries)):
            far = np.where(np.isin(np.arange(len(entries)), chosen), -1, apart)
            chosen.append(int(np.argmax(far)))
            apart = np.minimum(apart, squared(entries, entries[chosen[-1:]])[:, 0])
        self.splits, self.split_numbers = entries[chosen], self.numbers[chosen]
        rest = np.setdiff1d(np.arange(len(entries)), chosen)
        distances = squared(entries[rest], self.splits)
        nearest = distances.argmin(axis=1) if len(rest) else rest
        self.children: list[tuple[np.ndarray, np.ndarray, Gnat]] = []
        for split in range(len(chosen)):
            mine = nearest == split
            if mine.any():
                root = np.sqrt(distances[mine].astype(np.float64))
                below, above = root.min(axis=0) * (1 - MARGIN), root.max(axis=0) * (1 + MARGIN)
                self.children.append((below, above, Gnat(entries[rest[mine]], self.numbers[rest[mine]])))

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest entry of each row."""
        number, best = np.full(len(vectors), np.iinfo(np.int64).max), np.full(len(vectors), np.iinfo(np.int64).max)
        self._visit(vectors, np.arange(len(vectors)), number, best)
        return number, best

    def _visit(self, vectors: np.ndarray, rows: np.ndarray, number: np.ndarray, best: np.ndarray) -> None:
        exact = squared(vectors[rows], self.splits)
        for split, name in enumerate(self.split_numbers):
            here, so_far = exact[:, split], best[rows]
            better = (here < so_far) | ((here == so_far) & (name < number[rows]))
            best[rows[better]], number[rows[better]] = here[better], name
        root = np.sqrt(exact.astype(np.float64))
        near, far = root * (1 - MARGIN), root * (1 + MARGIN)
        for below, above, child in self.children:
            reach = np.sqrt(best[rows].astype(np.float64))[:, None] * (1 + MARGIN)
            # Strict: a child that may hold an equally near entry is read.
            out = ((near - above > reach) | (below - far > reach)).any(axis=1)
            if not out.all():
                child._visit(vectors, rows[~out], number, best)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distance of each row of ``a`` to each row of ``b``, in whole numbers."""
    difference = a[:, None, :] - b[None, :, :]
    return np.einsum("ijk,ijk->ij", difference, difference)


def usual_length(vectors: DataFrame) -> int:
    """The most frequent length that divides into ``PARTS``, of several the longest; 0 without any."""
    size = F.size("embedding").alias("size")
    lengths = vectors.select(size).where((F.col("size") > 0) & (F.col("size") % PARTS == 0)).groupBy("size").count()
    row = lengths.agg(F.max_by("size", F.struct("count", "size")).alias("size")).first()
    return row["size"] or 0


def integers(vectors: DataFrame, length: int) -> DataFrame:
    """vec_id, label and the whole-number components q of the vectors that can be coded.

    Components saturate where squared distances over a whole vector would leave 64 bits.
    """
    most = min(2**31 - 1, math.isqrt(2**62 // max(length, 1)) // 2)

    def whole(x: Column) -> Column:
        scaled = F.floor(x.cast("double") * SCALE)
        return F.greatest(F.lit(-most), F.least(F.lit(most), scaled)).cast("int")

    def finite(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))

    kept = vectors.where(F.col("embedding").isNotNull() & F.lit(length > 0)).where(F.size("embedding") == length)
    kept = kept.where(F.forall("embedding", finite))
    return kept.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), "label", F.transform("embedding", whole).alias("q")
    )


def first_codebooks(kept: DataFrame, length: int) -> np.ndarray:
    """(part, entry, position) from the vectors with the smallest ids; of an id's vectors the smallest counts."""
    ids = kept.select("vec_id").distinct().orderBy(F.asc_nulls_last("vec_id")).limit(ENTRIES).collect()
    known = [row["vec_id"] for row in ids if row["vec_id"] is not None]
    wanted = F.col("vec_id").isin(known) if known else F.lit(False)
    if len(known) < len(ids):
        wanted = wanted | F.col("vec_id").isNull()
    rows = kept.where(wanted).groupBy("vec_id").agg(F.min("q").alias("q")).collect()  # ENTRIES rows at most
    rows.sort(key=lambda r: (r["vec_id"] is None, r["vec_id"] or 0))
    first = np.array([row["q"] for row in rows], dtype=np.int64).reshape(len(rows), PARTS, length // PARTS)
    return first.transpose(1, 0, 2)


def blocks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Batches put together to some ``HELD`` rows, and their vectors as (row, part, position)."""
    held: list[pa.RecordBatch] = []

    def made() -> tuple[pa.Table, np.ndarray]:
        table = pa.Table.from_batches(held)
        flat = table.column("q").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return table, flat.astype(np.int64).reshape(table.num_rows, PARTS, length // PARTS)

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= HELD:
            yield made()
            held = []
    if sum(b.num_rows for b in held):
        yield made()


def refine(kept: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: each entry becomes the floored mean of the parts nearest to it; unused entries stay."""
    parts, entries, wide = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(book) for book in books if len(book)]
        totals = np.zeros((parts, entries, wide + 1), np.int64)
        for _, vectors in blocks(batches, parts * wide):
            for part, tree in enumerate(trees):
                number, _ = tree.nearest(vectors[:, part])
                np.add.at(totals[part, :, :wide], number, vectors[:, part])
                totals[part, :, wide] += np.bincount(number, minlength=entries)
        flat = totals.reshape(-1)
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], names=["cell", "total"])

    sums = kept.select("q").mapInArrow(run, "cell bigint, total bigint")
    sums = sums.groupBy("cell").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found = {row["cell"]: int(row["total"]) for row in sums.collect()}  # one row per number of the codebooks
    out = books.copy()
    for part in range(parts):
        for entry in range(entries):
            cell = (part * entries + entry) * (wide + 1)
            count = found.get(cell + wide, 0)
            if count:
                out[part, entry] = [found.get(cell + at, 0) // count for at in range(wide)]
    return out


def train(kept: DataFrame, length: int) -> np.ndarray:
    books = first_codebooks(kept, length)
    for _ in range(ROUNDS if books.size else 0):
        books = refine(kept, books)
    return books


def encode(kept: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code and error of every row of ``kept``."""
    parts, _, wide = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(book) for book in books if len(book)]
        for table, vectors in blocks(batches, parts * wide):
            codes, error = np.empty(vectors.shape[:2], np.uint8), np.zeros(len(vectors), np.int64)
            for part, tree in enumerate(trees):
                codes[:, part], squares = tree.nearest(vectors[:, part])
                error += squares
            table = table.drop_columns(["q"]).append_column("code", pa.array([row.tobytes().hex() for row in codes]))
            yield from table.append_column("error", pa.array(error)).combine_chunks().to_batches()

    label = kept.schema["label"].dataType.simpleString()
    return kept.mapInArrow(run, f"vec_id bigint, label {label}, code string, error bigint")


def decode(code: str, books: np.ndarray) -> list[int]:
    """The whole-number vector that a code stands for."""
    return [int(x) for part, entry in enumerate(bytes.fromhex(code)) for x in books[part, entry]]


def fingerprint(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in books.reshape(-1)).encode()).hexdigest()


def compress(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every vector that can be coded.

    Rows are dropped whose vector is null, holds a null or a component that is not finite, or has another length than
    most vectors whose length divides into eight parts. Components beyond some hundred million units saturate. A null
    vec_id comes behind all others; rows that share a vec_id are all coded, the smallest of their vectors can start a
    codebook. Fewer than 16 ids give smaller codebooks. Equal labels, nulls together, share one label_error (null
    beyond 64 bits). Repeated rows stay; an empty table gives no rows. Other columns are not read.
    """
    vectors = vectors.select("vec_id", "embedding", "label")
    length = usual_length(vectors)
    kept = written(integers(vectors, length), "vectors")
    books = train(kept, length)
    coded = written(encode(kept, books), "codes")
    # Labels may be few and hot: each one's total is copied to SALTS keys, over which its rows are spread.
    salted = coded.withColumn("salt", F.pmod(F.xxhash64("code", "vec_id"), F.lit(SALTS)))
    totals = coded.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error"))
    totals = totals.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("by"))
    joined = salted.join(totals, (salted["salt"] == totals["by"]) & salted["label"].eqNullSafe(totals["of"]), "left")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256"))
