"""Line deduplication over levelled sorted runs of line hashes.

``LineRuns`` holds the hashes of all lines seen so far with the document that owns each, as a few bucketed and sorted
tables. A batch of documents is anti-joined with the runs; what is left becomes a new run of level 0. When a level has
``fan_in`` runs they are merged into one of the next level, so n batches leave about log(n) runs. Runs and batches are
bucketed alike: a run is never shuffled again when it is joined.
"""

from __future__ import annotations

import uuid

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.llm.common import LOWER_BYTES, SPACE, ascii_lower, free_name, id_or_last, written
from merchlens.session import work_dir

SEED = 42
MIN_CHARS = 10
BATCHES = 4
HASH = ("h1", "h2")


class LineRuns:
    """Owners of all line hashes seen so far; batches must come in ascending order of documents."""

    def __init__(self, spark: SparkSession, fan_in: int = 3) -> None:
        self.spark, self.fan_in = spark, fan_in
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []
        self.names: list[str] = []

    def _run(self, rows: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            rows.repartition(self.buckets, *HASH)
            .write.bucketBy(self.buckets, *HASH)
            .sortBy(*HASH)
            .option("path", work_dir(self.spark, "line-run"))
            .saveAsTable(name)
        )
        self.names.append(name)
        return self.spark.table(name)

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, pairs: DataFrame) -> DataFrame:
        """Take in a batch (id, h1, h2, ..); return its rows without h2 that an earlier document owns.

        The batch shrinks to one row per hash before it is shuffled, and is bucketed like the runs. Only hashes that
        are shared meet the batch's rows again, in a join that adaptive execution can split, so a line that a third of
        all documents hold is never one task. The result is written before it is returned.
        """
        hashes = list(HASH)
        batch = self._run(pairs.groupBy(*HASH).agg(F.min("id").alias("owner"), F.max("id").alias("last")))
        fresh, shared = batch, None
        for run in self.runs():
            fresh = fresh.join(run, hashes, "left_anti")
            again = batch.select(*HASH).join(run, hashes).select(*HASH, "owner")
            shared = again if shared is None else shared.union(again)
        within = fresh.where("owner < last").select(*HASH, "owner")
        owners = written(within if shared is None else shared.union(within), "shared-lines")
        self._keep(self._run(fresh.select(*HASH, "owner")), 0)
        return written(pairs.join(owners, hashes).where("owner < id").select(*(c for c in pairs.columns if c != "h2")), "dropped-lines")

    def _keep(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fan_in:
            merged, self.levels[level] = self.levels[level], []
            union = merged[0]
            for other in merged[1:]:
                union = union.union(other)
            self._keep(self._run(union), level + 1)

    def close(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def line_pairs(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, text, h1, h2): the long lines of every document, as 128-bit hashes of their keys; text is its hash.

    Rows that share an id, or have none, are told apart by the hash of their text: what is dropped from one text is the
    same wherever it stands under that id, and no list holds the lines of more than one text.
    """
    lines = docs.select(
        id_or_last().alias("id"),
        F.xxhash64("text").alias("hash"),
        F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line"),
    )
    keys = lines.select("id", "hash", ascii_lower(F.btrim("line", F.lit(SPACE))).alias("key")).where(
        F.length("key") >= min_chars
    )
    h1, h2 = F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2")
    return keys.select("id", F.col("hash").alias("text"), h1, h2)


def without_lines(text: pd.Series, drops: pd.Series) -> pd.DataFrame:
    """Drop the lines whose key hash is listed; the hash is that of ``line_pairs``."""
    white, hash64 = SPACE.encode(), xxhash.xxh64_intdigest
    kept, lines, dropped = [], [], []
    for value, gone in zip(text, drops, strict=True):
        value = value or ""
        if gone is None or not len(gone):
            kept.append(value)
            lines.append(value.count("\n") + 1)
            dropped.append(0)
            continue
        gone = {h % (1 << 64) for h in map(int, gone)}
        parts = value.encode().split(b"\n")
        stay = [p for p in parts if hash64(p.strip(white).translate(LOWER_BYTES), SEED) not in gone]
        kept.append(b"\n".join(stay).decode())
        lines.append(len(parts))
        dropped.append(len(parts) - len(stay))
    return pd.DataFrame({"text": kept, "n_lines": lines, "n_dropped": dropped})


def dropped_lines(docs: DataFrame, batches: int = BATCHES, min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, text, gone): for each text with shared lines, the hashes of those that a smaller doc_id holds."""
    spark = docs.sparkSession
    cuts = docs.select(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000)).first()[0] or []
    batch = sum((F.when(F.col("id") > c, 1).otherwise(0) for c in sorted(set(cuts))), F.lit(0))
    path = work_dir(spark, "line-pairs")
    line_pairs(docs, min_chars).withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    pairs = spark.read.schema("id bigint, text bigint, h1 bigint, h2 bigint, batch int").parquet(path)
    runs, drops = LineRuns(spark), None
    try:
        for number in range(len(set(cuts)) + 1):
            found = runs.add(pairs.where(F.col("batch") == number).drop("batch"))
            drops = found if drops is None else drops.union(found)
    finally:
        runs.close()
    return drops.groupBy("id", "text").agg(F.collect_set("h1").alias("gone"))


def dedup_lines(docs: DataFrame, batches: int = BATCHES, min_chars: int = MIN_CHARS) -> DataFrame:
    """All columns of ``docs`` (doc_id, text, ...) with the kept text, and n_lines, n_dropped behind them.

    A line's key is the line without white space at its ends, in ASCII lower case. Keys of ``min_chars`` code points
    found in at least two documents lose all their lines but those of the smallest doc_id. Null and empty texts are
    one empty line. Rows without doc_id count as one document behind all others; repeated rows of a doc_id are one
    document, and all stay. Columns of the input that are named n_lines or n_dropped are replaced. An empty table
    gives no rows.
    """
    apply = F.pandas_udf(without_lines, "text string, n_lines bigint, n_dropped bigint")
    key, hashed, gone, made = (free_name(docs, name) for name in ("key", "hash", "gone", "made"))
    drops = dropped_lines(docs, batches, min_chars).toDF(key, hashed, gone)
    keyed = docs.withColumns({key: id_or_last(), hashed: F.xxhash64("text")})
    out = keyed.join(drops, [key, hashed], "left").withColumn(made, apply("text", gone))
    others = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    columns = [F.col(f"{made}.text" if c == "text" else f"`{c}`").alias(c) for c in others]
    return out.select(*columns, f"{made}.n_lines", f"{made}.n_dropped")
