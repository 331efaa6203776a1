"""Structured Streaming jobs (X1-X6, O1 stream form, O2).

All jobs run with ``trigger(availableNow=True)``: each run processes every
file that arrived since the last run (the file source remembers seen files
in its checkpoint) and stops. Sinks and checkpoints live under the shared
checkpoint root, so a rerun after a lost executor or driver resumes
exactly where the last committed batch ended.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from candela.operators.dedup import dedup_bars
from candela.operators.dims import scd1_latest
from candela.operators.quality import Rules, observe_rules
from candela.session import ensure_checkpoint_dir
from candela.sinks import parts
from candela.sinks.tables import table_exists
from candela.sources import csv_bars


def union_streams(*dfs: DataFrame) -> DataFrame:
    """Union of streaming (or batch) frames by column name."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def dedup_stream(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """O1 on a stream: drop re-delivered copies of a key seen within ``delay`` of event time.

    The first copy wins; the state of a key is dropped once the watermark
    passes it, so state stays bounded by the rows of one ``delay`` window.
    Structured Streaming drops rows that arrive later than the watermark,
    also first copies: choose ``delay`` over the greatest lateness of the
    source, or merge by key instead (:func:`run_upsert_bars`,
    :func:`run_scd1`), which loses no late row.
    A TIMESTAMP_NTZ event time is watermarked through a session-zone cast.
    """
    if dict(stream.dtypes)[event_time] == "timestamp_ntz":
        wm = "_event_time"
        marked = stream.withColumn(wm, F.col(event_time).cast("timestamp")).withWatermark(wm, delay)
        return marked.dropDuplicatesWithinWatermark(list(keys)).drop(wm)
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def with_load_stamp(df: DataFrame, col: str = "processed_timestamp") -> DataFrame:
    """Stateless projection adding the load time."""
    return df.withColumn(col, F.current_timestamp())


def run_append(
    stream: DataFrame,
    sink_path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    name: str | None = None,
    files_per_partition: int = 4,
) -> StreamingQuery:
    """Append every new row to a file sink and stop when caught up.

    With ``partition_by`` a batch writes at most ``files_per_partition``
    files per partition folder.
    """
    q = start_append(stream, sink_path, checkpoint, partition_by, files_per_partition, fmt=fmt, name=name)
    q.awaitTermination()
    return q


def start_append(
    stream: DataFrame, sink_path: str, checkpoint: str, partition_by: Sequence[str] = (), files_per_partition: int = 4,
    before_write: Callable[[DataFrame], DataFrame] | None = None, fmt: str = "parquet", name: str | None = None,
) -> StreamingQuery:
    """Start the query of :func:`run_append`; ``before_write`` is applied behind the clustering exchange."""
    if partition_by:
        stream = parts.clustered(stream, partition_by, files_per_partition)
    if before_write is not None:
        stream = before_write(stream)
    w = stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    return w.trigger(availableNow=True).start(sink_path)


def _run_batches(stream: DataFrame, checkpoint: str, batch_fn) -> StreamingQuery:
    ensure_checkpoint_dir(stream.sparkSession)  # batches are checkpointed before they are merged
    q = (
        stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch_fn).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return q


# -- appends that replace themselves ---------------------------------------------

BATCH, ATTEMPT, PERIOD = "_batch", "_attempt", "_period"
NO_PERIOD = "none"
COUNTS = f"{BATCH} long, {ATTEMPT} string, rule string, failed long, at timestamp"


def period_of(names: Sequence[str], date_col: str) -> Column:
    """Folder of a row: the month of its date; one folder for rows without one."""
    if date_col not in names:
        return F.lit(NO_PERIOD)
    return F.coalesce(F.date_format(date_col, "yyyy-MM"), F.lit(NO_PERIOD))


class BatchSink:
    """A table to which micro-batches append, each exactly once.

    The rows lie in one folder per month of ``date_col``, so the number of
    folders does not grow with the number of batches or tickers. A batch
    appends its rows under an attempt of its own, and then its counters (and
    a total) with the name of that attempt. Readers take, for each batch, the
    rows of the attempt that wrote its counters last: a batch that is run
    again after a crash replaces itself, and rows without counters do not
    count.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: StructType, date_col: str, partition_by: Sequence[str] = (), files_per_partition: int = 4
    ):
        extra = [StructField(BATCH, LongType()), StructField(ATTEMPT, StringType()), StructField(PERIOD, StringType())]
        parts.create(spark, path, StructType([*schema.fields, *extra]))
        self.spark, self.path, self.period = spark, path, period_of(schema.names, date_col)
        self.folders, self.files = [PERIOD, *partition_by], files_per_partition

    def append(self, rows_: DataFrame, batch_id: int, rules: Rules = ()) -> None:
        attempt = uuid.uuid4().hex
        seen = Observation(f"batch_{batch_id}_{attempt}")
        placed = rows_.withColumns({BATCH: F.lit(batch_id).cast("long"), ATTEMPT: F.lit(attempt), PERIOD: self.period})
        placed = observe_rules(parts.clustered(placed, self.folders, self.files), list(rules), seen)
        placed.write.mode("append").partitionBy(*self.folders).parquet(self.path)
        now = dt.datetime.now(dt.timezone.utc)
        counts = [(batch_id, attempt, k, int(v or 0), now) for k, v in seen.get.items()]
        self.spark.createDataFrame(counts, COUNTS).coalesce(1).write.mode("append").parquet(f"{self.path}/_counts")


def _attempts(spark: SparkSession, sink_path: str) -> DataFrame | None:
    """The counters of the attempt that holds for each batch; None before the first."""
    if not table_exists(spark, f"{sink_path}/_counts"):
        return None
    counts = spark.read.schema(COUNTS).parquet(f"{sink_path}/_counts")
    last = counts.groupBy(BATCH).agg(F.max_by(ATTEMPT, F.struct("at", ATTEMPT)).alias(ATTEMPT))
    return counts.join(last, [BATCH, ATTEMPT], "left_semi")


def read_appended(spark: SparkSession, sink_path: str) -> DataFrame:
    """Rows of a :class:`BatchSink`, with their declared types."""
    schema, _ = parts.layout(spark, sink_path)
    names = [c for c in schema.names if c not in (BATCH, ATTEMPT, PERIOD)]
    held = _attempts(spark, sink_path)
    if held is None or not table_exists(spark, sink_path):
        return spark.createDataFrame([], schema).select(names)
    rows_ = spark.read.schema(schema).parquet(sink_path)
    return rows_.join(held.select(BATCH, ATTEMPT).distinct(), [BATCH, ATTEMPT], "left_semi").select(names)


def expectation_counts(spark: SparkSession, sink_path: str, batches: Sequence[int] | None = None) -> dict[str, int]:
    """Rule failures (and ``total`` rows) over all batches of the sink, or over the given ones."""
    counts = _attempts(spark, sink_path)
    if counts is None:
        return {}
    if batches is not None:
        counts = counts.where(F.col(BATCH).isin(list(batches)) if batches else F.lit(False))
    return {r["rule"]: r["failed"] for r in counts.groupBy("rule").agg(F.sum("failed").alias("failed")).collect()}


def run_append_with_expectations(
    stream: DataFrame,
    rules: Rules,
    sink_path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    files_per_partition: int = 4,
    date_col: str = "date",
) -> dict[str, int]:
    """Append (warn mode: all rows kept) to a :class:`BatchSink` while counting rule failures per batch.

    Read the rows with :func:`read_appended` and the counters of all runs
    with :func:`expectation_counts`; returned are those of the batches of
    this run. ``partition_by`` adds folders below those of the months.
    """
    spark = stream.sparkSession
    sink = BatchSink(spark, sink_path, stream.schema, date_col, partition_by, files_per_partition)
    ran: list[int] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        ran.append(batch_id)
        sink.append(batch, batch_id, rules)

    _run_batches(stream, checkpoint, write)
    return expectation_counts(spark, sink_path, ran)


def run_ingest_with_quarantine(
    checked: DataFrame, sink_path: str, quarantine_path: str, checkpoint: str, rules: Rules = ()
) -> dict[str, int]:
    """Good rows to one sink, malformed ones with their text, file and reason to another.

    ``checked`` comes from :func:`candela.sources.csv_bars.read_checked_stream`.
    Both sinks replace the rows of a batch that is run again. Returned are
    this run's counts: ``total`` and the failures of ``rules`` among the good
    rows, and ``malformed``. Read both with :func:`read_appended`.
    """
    spark = checked.sparkSession
    good = lambda df: df.where(F.col(csv_bars.REASON).isNull()).drop(*csv_bars.CHECK_COLUMNS)
    bad = lambda df: df.where(F.col(csv_bars.REASON).isNotNull()).select("ticker", *csv_bars.CHECK_COLUMNS)
    rows_sink = BatchSink(spark, sink_path, good(checked).schema, "date")
    bad_sink = BatchSink(spark, quarantine_path, bad(checked).schema, "date")
    ran: list[int] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        ran.append(batch_id)
        batch.persist()  # the files are parsed once for both sinks
        rows_sink.append(good(batch), batch_id, rules)
        bad_sink.append(bad(batch), batch_id)
        batch.unpersist()

    _run_batches(checked, checkpoint, write)
    counts = expectation_counts(spark, sink_path, ran)
    return {**counts, "malformed": expectation_counts(spark, quarantine_path, ran).get("total", 0)}


def run_quarantine(checked: DataFrame, quarantine_path: str, checkpoint: str) -> int:
    """Only the malformed rows of ``checked``, to a sink of their own; returns how many came."""
    bad = checked.where(F.col(csv_bars.REASON).isNotNull()).select("ticker", *csv_bars.CHECK_COLUMNS)
    return run_append_with_expectations(bad, [], quarantine_path, checkpoint).get("total", 0)


# -- merges -------------------------------------------------------------------

BUCKET = parts.BUCKET
#: Bytes of a part from which on its bucket is split.
MOST_PART_BYTES = 256 << 20


def run_scd1(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: Sequence[str],
    target_path: str,
    checkpoint: str,
    buckets: int = 64,
    most_part_bytes: int = MOST_PART_BYTES,
) -> StreamingQuery:
    """Keep the latest row per key from a change stream (SCD type 1).

    Each micro-batch is reduced to its latest row per key, unioned with the
    target's rows of the hash buckets that it touches (partition pruning),
    and the greatest sequence per key stays: a late, older change never
    displaces a stored row, also after a restart with a fresh checkpoint,
    and NULL keys are one key, as in a group-by. Only touched buckets are
    rewritten, and one that has grown over ``most_part_bytes`` is split. The
    target is the only state. ``buckets`` holds for a new target; an
    existing one keeps its own.
    """
    spark = changes.sparkSession
    schema = StructType([*changes.schema.fields, StructField(BUCKET, LongType())])
    known = parts.layout(spark, target_path) is not None
    parts.create(spark, target_path, schema, buckets)
    if not known:
        parts.create_directory(spark, target_path, buckets)
    parts.finish_pending(spark, target_path)

    def merge(batch: DataFrame, batch_id: int) -> None:
        latest = scd1_latest(batch, keys, sequence_by).withColumn(BUCKET, parts.bucket_of(spark, target_path, keys))
        latest = latest.select(schema.names).checkpoint()
        touched = [r[BUCKET] for r in latest.select(BUCKET).distinct().collect()]  # at most the buckets

        def merged() -> DataFrame:
            current = parts.read_parts(spark, target_path)
            if current is None:
                return latest
            current = current.where(F.col(BUCKET).isin(touched)).select(schema.names)
            return scd1_latest(current.unionByName(latest), keys, sequence_by)

        parts.publish(spark, target_path, [BUCKET], f"{checkpoint}#{batch_id}", merged)
        parts.split_large(spark, target_path, keys, [BUCKET], BUCKET, touched, most_part_bytes)

    return _run_batches(changes, checkpoint, merge)


def read_scd1(spark: SparkSession, target_path: str) -> DataFrame:
    """The dimension written by :func:`run_scd1` (without the bucket column); None before the first batch."""
    stored = parts.read_parts(spark, target_path)
    return None if stored is None else stored.drop(BUCKET)


def _placed(bars: DataFrame, bucket: Column, source: str) -> DataFrame:
    """Bars with their part columns: the month of the date, a hash bucket of the ticker, the batch that brought them."""
    period = F.coalesce(F.date_format("date", "yyyy-MM"), F.lit(NO_PERIOD))
    return bars.withColumns({BATCH: F.lit(source), PERIOD: period, BUCKET: bucket})


def _create_bars(spark: SparkSession, path: str, bars: StructType, buckets: int) -> StructType:
    extra = [StructField(BATCH, StringType()), StructField(PERIOD, StringType()), StructField(BUCKET, LongType())]
    schema = StructType([*bars.fields, *extra])
    if parts.layout(spark, path) is None:
        parts.create(spark, path, schema, buckets)
        parts.create_directory(spark, path, buckets)
    return schema


def create_bars_table(bars: DataFrame, target_path: str, buckets: int = 16) -> None:
    """A bars table for :func:`run_upsert_bars`, partitioned by month and ticker bucket."""
    spark = bars.sparkSession
    _create_bars(spark, target_path, bars.schema, buckets)
    placed = _placed(bars, parts.bucket_of(spark, target_path, ["ticker"]), "")
    parts.replace_parts(parts.clustered(placed, [PERIOD, BUCKET], 1), target_path, [PERIOD, BUCKET])


def read_bars_table(spark: SparkSession, target_path: str) -> DataFrame:
    """The rows of a bars table, with their declared types."""
    return parts.read_parts(spark, target_path).drop(BATCH, PERIOD, BUCKET)


def run_upsert_bars(
    spark: SparkSession,
    updates: DataFrame,
    target_path: str,
    checkpoint: str,
    keys: Sequence[str] = ("ticker", "date"),
    sequence_by: str = "processed_timestamp",
    buckets: int = 16,
    on_merged: Callable[[DataFrame, int], None] | None = None,
    most_part_bytes: int = MOST_PART_BYTES,
) -> StreamingQuery:
    """O2: merge changed bars into a table partitioned by month and ticker bucket.

    Per micro-batch: the rows of the touched (month, bucket) parts are read
    (partition pruning), unioned with the batch, reduced to the latest copy
    per key, and written back over just those parts by way of a redo record
    (:func:`candela.sinks.parts.publish`); other parts' files stay as they
    are. Rows with a NULL key part have no identity: all are kept, and a
    batch that is run again after a crash replaces its own. A bucket with a
    part over ``most_part_bytes`` is split.

    ``on_merged(batch, batch_id)`` is called after a batch is published and
    before the stream commits it, e.g. to refresh tables that follow from
    this one (:func:`candela.streaming.refresh.refresh_indicators`); like the
    merge it runs again after a crash, so it must be repeatable.
    """
    _create_bars(spark, target_path, updates.schema, buckets)
    parts.finish_pending(spark, target_path)

    def merge(batch: DataFrame, batch_id: int) -> None:
        source = f"{checkpoint}#{batch_id}"
        new = _placed(batch, parts.bucket_of(spark, target_path, ["ticker"]), source).checkpoint()
        touched = [r[BUCKET] for r in new.select(BUCKET).distinct().collect()]  # at most the buckets

        def merged() -> DataFrame:
            rows_ = new
            current = parts.read_parts(spark, target_path)
            if current is not None:
                places = F.broadcast(new.select(PERIOD, BUCKET).distinct())  # months of the batch x buckets
                current = current.join(places, [PERIOD, BUCKET], "left_semi").where(F.col(BATCH) != source)
                rows_ = current.unionByName(new)
            return dedup_bars(rows_, keys, sequence_by, keep_sequence=True)

        parts.publish(spark, target_path, [PERIOD, BUCKET], source, merged)
        parts.split_large(spark, target_path, ["ticker"], [PERIOD, BUCKET], BUCKET, touched, most_part_bytes)
        if on_merged is not None:
            on_merged(new.drop(BATCH, PERIOD, BUCKET), batch_id)

    return _run_batches(updates, checkpoint, merge)
