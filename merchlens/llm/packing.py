"""Packing token pieces into fixed-length sequences: first-fit decreasing in randomised groups."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.llm.common import once, written

LENGTH = 1024
END = 0
GROUP_DOCS = 16_384
SPECIAL = {"<|endoftext|>": 50256}

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


class Tournament:
    """First-fit over bins of one capacity: a winner tree of what each bin has left."""

    def __init__(self, capacity: int, bins: int) -> None:
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.left = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """Put ``size`` in the first bin with room; its number and what it had left before."""
        left, node = self.left, 1
        if left[1] < size:
            raise ValueError("no bin has room")
        while node < self.leaves:
            node *= 2
            if left[node] < size:
                node += 1
        had = left[node]
        left[node] = had - size
        place = node - self.leaves
        while node > 1:
            node //= 2
            left[node] = max(left[2 * node], left[2 * node + 1])
        return place, had


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every item; ties go in the given order."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    small = np.flatnonzero(sizes < capacity)
    tree = Tournament(capacity, len(small))
    for item in small[np.argsort(-sizes[small], kind="stable")].tolist():
        bins[item], had = tree.place(int(sizes[item]))
        offsets[item] = capacity - had
    full, used = np.flatnonzero(sizes >= capacity), int(bins[small].max(initial=-1)) + 1
    bins[full] = used + np.arange(len(full))
    return bins, offsets


def byte_bpe(ranks_path: str):
    """The byte-level vocabulary; its end mark inside a text is one id, as in the JSON form of the vocabulary."""
    import public_tokenizers
    import tiktoken

    def load():
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        return tiktoken.Encoding(
            "packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL
        )

    return once(f"bpe {ranks_path}", load)


def token_pieces(docs: DataFrame, length: int = LENGTH, ranks_path: str | None = None) -> DataFrame:
    """Cut every document's tokens into pieces of at most ``length``; no shuffle, no token leaves its task."""
    if ranks_path is None:
        import public_tokenizers

        ranks_path = public_tokenizers.path("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe(ranks_path)
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encoder.encode_to_numpy(text.as_py() or "", allowed_special="all"), END).astype("<u4")
                for start in range(0, len(ids), length):
                    part = ids[start : start + length]
                    out.append((doc, start, len(part), zlib.crc32(part.tobytes()), len(ids)))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.int64()) for c in columns], names=[f.split()[0] for f in PIECES.split(", ")]
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, PIECES)


def pack(docs: DataFrame, length: int = LENGTH, group_docs: int = GROUP_DOCS, seed: int = 7) -> DataFrame:
    """Pieces of all documents with their place: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Full pieces are sequences of their own. The others, one of a document at most, are dealt into groups of about
    ``group_docs`` by a seeded hash of the piece and its row of the written table, so that rows without doc_id or with
    the same one are spread like any; each group is packed on its own, so the padding is that of first-fit decreasing
    over a random sample, and a task holds one group's lengths only. The upper bits of sequence_id are the group. A null
    or empty text is the end id alone. Rows without doc_id are packed like others; repeated rows too, each row has its
    own pieces. An empty table gives no rows. Other columns are not read. ``ids_of`` gives the ids of a piece.
    """
    pieces = written(token_pieces(docs, length), "pieces")
    partial = pieces.where(F.col("length") < length)
    groups = max(1, -(-partial.count() // group_docs))
    row = F.monotonically_increasing_id()
    group = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "ids_crc32", row), F.lit(groups))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "start", "ids_crc32"], kind="stable")
        bins, offsets = first_fit_decreasing(frame["length"].to_numpy(), length)
        frame["sequence_id"] = (frame["grp"].to_numpy().astype(np.int64) << 32) + bins
        frame["offset"] = offsets
        return frame.drop(columns="grp")

    shared = partial.withColumn("grp", group).groupBy("grp").applyInPandas(run, PIECES + ", sequence_id bigint, offset bigint")
    full = pieces.withColumn("sequence_id", F.lit(groups << 32) + row).where(F.col("length") == length)
    return shared.union(full.withColumn("offset", F.lit(0).cast("bigint")))


def ids_of(text: str | None, start: int, length: int, ranks_path: str | None = None) -> np.ndarray:
    """The token ids of one piece, for writing a sequence."""
    import public_tokenizers

    encoder = byte_bpe(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    ids = np.append(encoder.encode_to_numpy(text or "", allowed_special="all"), END).astype("<u4")
    return ids[start : start + length]
