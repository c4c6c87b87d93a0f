"""Idempotent ingest over time: which request of a key came first, remembered between batches and runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from merchlens.operators.quality import first_requests, hashed_requests
from merchlens.sources.incremental import has_partitions
from merchlens.streaming.changes import available_now

BUCKETS = 64
FIRST, REPLAY, CONFLICT = "first", "replay", "conflict"  # fixed values


class Ledger:
    """(user, key, hash of the payload) of every request that was accepted, below ``path``.

    Partitioned by hash bucket of user and key, then by batch: a batch reads only the buckets it has keys in and appends
    its own new keys. What a batch itself wrote is not read, so a replayed batch gives the same outcomes and writes the
    same rows again.
    """

    def __init__(self, spark: SparkSession, path: str, user: str, key: str, at: str, payload: Sequence[str]) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.user, self.key, self.at, self.payload = user, key, at, list(payload)

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64(self.user, self.key), F.lit(BUCKETS)).cast("int"))

    def _known(self, first: DataFrame, batch: int) -> DataFrame:
        schema = first.select(self.user, self.key, "request_hash", "bucket").withColumn("batch", F.lit(0).cast("bigint")).schema
        if not has_partitions(self.spark, f"{self.path}/keys"):
            return self.spark.createDataFrame([], schema)
        touched = [row[0] for row in first.select("bucket").distinct().collect()]  # at most BUCKETS
        kept = self.spark.read.schema(schema).parquet(f"{self.path}/keys")
        return kept.where(F.col("bucket").isin(touched) & (F.col("batch") != batch))

    def add(self, batch: int, requests: DataFrame) -> None:
        """Judge a batch against all before it and against itself; see ``outcomes``.

        Requests without a user or a key promise nothing and are all first.
        """
        first = self._bucketed(first_requests(requests, self.user, self.key, self.at, self.payload))
        first = first.where(F.col(self.user).isNotNull() & F.col(self.key).isNotNull())
        known = self._known(first, batch).select(self.user, self.key, F.col("request_hash").alias("kept_hash"))
        held = first.join(known, [self.user, self.key], "left")
        self._write(
            held.where("kept_hash IS NULL").select(self.user, self.key, "request_hash", "bucket"), "keys", batch, "bucket"
        )
        kept = held.select(
            self.user, self.key, F.coalesce("kept_hash", "request_hash").alias("kept_hash"),
            F.when(F.col("kept_hash").isNull(), F.col("first_at")).alias("accepted_at"),
        )
        met = hashed_requests(requests, self.payload).join(kept, [self.user, self.key], "left")
        outcome = (
            F.when(F.col("kept_hash").isNull() | (F.col(self.at) == F.col("accepted_at")), FIRST)
            .when(F.col("request_hash") == F.col("kept_hash"), REPLAY)
            .otherwise(CONFLICT)
        )
        self._write(met.select(*requests.columns, "request_hash", outcome.alias("outcome")), "outcomes", batch)

    def _write(self, rows: DataFrame, name: str, batch: int, *parts: str) -> None:
        (
            rows.withColumn("batch", F.lit(batch).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*parts, "batch")
            .parquet(f"{self.path}/{name}")
        )

    def outcomes(self) -> DataFrame:
        """Every request with its batch and outcome: ``first`` is to be carried out, a ``replay`` is answered as before,
        a ``conflict`` reuses a key for something else. ``at`` tells the requests of a key in a batch apart."""
        return self.spark.read.parquet(f"{self.path}/outcomes")


def ledger_stream(stream: DataFrame, path: str, checkpoint: str, user: str, key: str, at: str, payload: Sequence[str]) -> StreamingQuery:
    """Judge the requests of a stream batch by batch, with all batches before in mind."""

    def add(batch: DataFrame, number: int) -> None:
        Ledger(batch.sparkSession, path, user, key, at, payload).add(number, batch)

    return available_now(stream, add, checkpoint)
