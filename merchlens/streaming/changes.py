"""Change stream over raw events: backfill, triggered upsert, running funnel, sessions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from merchlens.operators.sessions import STAGES, Stage, merge_funnels, session_funnel
from merchlens.operators.staging import clean_events
from merchlens.sources.incremental import merge_into
from merchlens.streaming.runs import Runs

# Fixed values.
BACKFILL, INSERT = "BACKFILL", "INSERT"
CART_TYPE = "decimal(10,2)"
KEY, PARTITION = ["event_id"], "event_date"
GAP = "30 minutes"


def change_stream(
    spark: SparkSession, folder: str, schema: str, files: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Append-only stream over a folder of parquet files; the checkpoint holds the offset."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def stamped(events: DataFrame, action: str) -> DataFrame:
    """Cleaned change rows with their action and time of ingestion."""
    return clean_events(events, CART_TYPE).select(
        "*", F.lit(action).alias("cdc_action"), F.current_timestamp().cast("timestamp_ntz").alias("ingested_at")
    )


def backfill(events: DataFrame, path: str) -> None:
    """Rows that existed before the stream."""
    merge_into(events.sparkSession, path, stamped(events, BACKFILL), KEY, PARTITION)


def inserts(changes: DataFrame) -> DataFrame:
    """Keep insertions when the source states actions; an append-only source has no others."""
    return changes.where(F.col("cdc_action") == INSERT) if "cdc_action" in changes.columns else changes


def upsert_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Merge what has arrived into the table, by event id, then stop.

    No watermark: late rows are accepted whenever they come. A replayed batch upserts the
    same keys again, so the table is the same after a restart.
    """

    def upsert(batch: DataFrame, _: int) -> None:
        merge_into(
            batch.sparkSession, path, stamped(inserts(batch), INSERT), KEY, PARTITION, order=["event_timestamp", "event_type"]
        )

    return available_now(stream, upsert, checkpoint)


def finish(query: StreamingQuery) -> int:
    """Wait for an available-now query, however long it takes; the number of rows it read (0: no data).

    Spark keeps the last hundred progress reports, so they are taken down while the query runs.
    """
    rows: dict[int, int] = {}
    while True:
        ended = query.awaitTermination(1)
        rows |= {progress["batchId"]: progress["numInputRows"] for progress in query.recentProgress}
        if ended:
            return sum(rows.values())


def running_funnel(stream: DataFrame, stages: Sequence[Stage] = STAGES) -> DataFrame:
    """Session funnel as a stateful aggregate: counts, firsts and maxima only, so each batch adds to the state.

    No watermark and no time bucket: rows count whenever they come, and a session may last over midnight. The state
    keeps one small row per session for good; ``funnel_stream`` needs no state.
    """
    # State needs a timestamp with time zone; the session runs in UTC.
    return session_funnel(stream.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp")), stages)


def funnel_runs(spark: SparkSession, path: str, stages: Sequence[Stage] = STAGES) -> Runs:
    return Runs(spark, path, partial(merge_funnels, stages=stages), ["session_id", "user_id"])


def funnel_stream(stream: DataFrame, path: str, checkpoint: str, stages: Sequence[Stage] = STAGES) -> StreamingQuery:
    """Keep the session funnel of an append-only stream of staged events as runs below ``path``.

    Each batch writes the funnel of its own events: counts, firsts and maxima, which ``read_funnel`` merges. Rows count
    whenever they come; nothing that is stored is read but for compaction.
    """

    def add(batch: DataFrame, number: int) -> None:
        funnel_runs(batch.sparkSession, path, stages).add(number, session_funnel(batch, stages))

    return available_now(stream, add, checkpoint)


def read_funnel(spark: SparkSession, path: str, stages: Sequence[Stage] = STAGES) -> DataFrame:
    """One row per session and user over all batches so far."""
    return funnel_runs(spark, path, stages).read()


def available_now(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand what has arrived to ``batch``, then stop."""
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def union_spans(spans: DataFrame, gap: str = GAP) -> DataFrame:
    """Spans (user_id, session_start, session_end, events) joined where no more than ``gap`` lies between them.

    The order of the spans and how often this is applied to parts of them do not matter. Spans of a user are at
    least ``gap`` apart once joined, so even a user with most of the events has few rows a day here.
    """
    in_order = Window.partitionBy("user_id").orderBy("session_start", "session_end", "events")
    before = F.max("session_end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    first = F.when(before.isNull() | (F.col("session_start") > before + F.expr(f"INTERVAL {gap}")), 1).otherwise(0)
    numbered = spans.select("user_id", "session_start", "session_end", "events", first.alias("first")).withColumn(
        "nth", F.sum("first").over(in_order)
    )
    joined = numbered.groupBy("user_id", "nth").agg(
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"), F.sum("events").alias("events")
    )
    return joined.drop("nth")


def session_windows(events: DataFrame, gap: str = GAP) -> DataFrame:
    """Sessions by silence, one row per user and session; a new one starts after more than ``gap``.

    Events of one user in one slot of length ``gap`` belong together, so each slot shrinks to one row before the
    shuffle, however many events it holds.
    """
    slots = events.groupBy("user_id", F.window("event_timestamp", gap).alias("slot")).agg(
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
        F.count(F.lit(1)).alias("events"),
    )
    return union_spans(slots.drop("slot"), gap)


def session_runs(spark: SparkSession, path: str, gap: str = GAP) -> Runs:
    return Runs(spark, path, partial(union_spans, gap=gap), ["user_id", "session_start"])


def session_stream(stream: DataFrame, path: str, checkpoint: str, gap: str = GAP) -> StreamingQuery:
    """Keep the session windows of an append-only stream of staged events as runs below ``path``, open sessions included.

    Each batch writes the spans of its own events; ``read_sessions`` joins them, so late rows may lengthen or bridge
    sessions of any age. An event that is sent twice counts twice: take repeated ids out before, with ``ledger``.
    """

    def add(batch: DataFrame, number: int) -> None:
        session_runs(batch.sparkSession, path, gap).add(number, session_windows(batch, gap))

    return available_now(stream, add, checkpoint)


def read_sessions(spark: SparkSession, path: str, gap: str = GAP) -> DataFrame:
    """One row per user and session over all batches so far."""
    return session_runs(spark, path, gap).read()
