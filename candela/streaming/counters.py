"""Rule counters of plain append streams, fed by a query listener.

The stream writes with Spark's own file sink, which appends each batch
exactly once; no foreachBatch is needed. The rules are observed metrics of
the same pass, and a StreamingQueryListener stores what each batch reports:
one small file per batch under ``<sink>/_rule_counts``, named by the batch,
so a batch that reports twice counts once.

A driver that dies between a batch's commit and its report leaves a batch
without counters. The next run sees this from the checkpoint's list of
committed batches, counts the sink once as a whole, and stores that as the
state up to the last committed batch.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from candela.files import file_names, path_exists, write_text
from candela.operators.quality import Rules, observe_rules, violation_counts
from candela.sinks.tables import table_exists
from candela.streaming.jobs import start_append

METRIC = "rules"
WAIT_S = 60


class CounterListener(StreamingQueryListener):
    """Stores the observed rule counters of one run of a query."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.run, self.ended = spark, folder, None, threading.Event()
        self.batches: list[int] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if self.run is not None and str(progress.runId) != self.run:
            return
        row = progress.observedMetrics.get(METRIC)
        if row is not None:
            store_counts(self.spark, self.folder, f"batch-{progress.batchId}", row.asDict())
            self.batches.append(progress.batchId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if self.run is None or str(event.runId) == self.run:
            self.ended.set()


def store_counts(spark: SparkSession, folder: str, name: str, counts: dict) -> None:
    write_text(spark, f"{folder}/{name}.json", json.dumps({"name": name, "counts": {k: int(v or 0) for k, v in counts.items()}}) + "\n")


def _numbers(names: Sequence[str], prefix: str) -> list[int]:
    stems = [n.removesuffix(".json") for n in names]
    return sorted(int(s.removeprefix(prefix)) for s in stems if s.startswith(prefix) and s.removeprefix(prefix).isdigit())


def run_append_counted(
    stream: DataFrame, rules: Rules, sink_path: str, checkpoint: str, partition_by: Sequence[str] = (), files_per_partition: int = 4
) -> dict[str, int]:
    """Append every new row and store rule failures per batch; returns the counts of all runs so far."""
    spark = stream.sparkSession
    folder = f"{sink_path.rstrip('/')}_rule_counts"
    close_gaps(spark, stream, rules, sink_path, checkpoint, folder)
    listener = CounterListener(spark, folder)
    spark.streams.addListener(listener)
    try:
        # The observation comes last, behind the exchange that clusters the rows, so each row counts once.
        query = start_append(stream, sink_path, checkpoint, partition_by, files_per_partition, lambda df: observe_rules(df, rules, METRIC))
        listener.run = str(query.runId)
        query.awaitTermination()
        listener.ended.wait(WAIT_S)  # reports are delivered in order, the end of the query last
    finally:
        spark.streams.removeListener(listener)
    close_gaps(spark, stream, rules, sink_path, checkpoint, folder)
    return rule_counts(spark, sink_path)


def close_gaps(spark: SparkSession, stream: DataFrame, rules: Rules, sink_path: str, checkpoint: str, folder: str) -> bool:
    """Count the whole sink if a committed batch has no counters; True if that was needed."""
    committed = _numbers(file_names(spark, f"{checkpoint}/commits"), "")
    names = file_names(spark, folder)
    from_batch = max(_numbers(names, "upto-"), default=-1) + 1
    counted = set(_numbers(names, "batch-"))
    missing = [b for b in committed if b >= from_batch and b not in counted]
    if not missing or not table_exists(spark, sink_path):
        return False
    found = violation_counts(spark.read.schema(stream.schema).parquet(sink_path), rules).collect()
    counts = {"total": found[0]["total_records"], **{r["rule"]: r["failed_records"] for r in found}}
    store_counts(spark, folder, f"upto-{committed[-1]}", counts)
    return True


def rule_counts(spark: SparkSession, sink_path: str) -> dict[str, int]:
    """Rule failures and ``total`` over all batches."""
    folder = f"{sink_path.rstrip('/')}_rule_counts"
    if not path_exists(spark, folder):
        return {}
    upto = max(_numbers(file_names(spark, folder), "upto-"), default=-1)
    rows = spark.read.schema("name string, counts map<string,long>").json(folder)
    out: dict[str, int] = {}
    for r in rows.collect():  # a few numbers per batch
        kind, number = r["name"].rsplit("-", 1)
        if (kind == "batch" and int(number) > upto) or (kind == "upto" and int(number) == upto):
            for rule, n in r["counts"].items():
                out[rule] = out.get(rule, 0) + n
    return out
