"""Summary facts kept up to date by merging partial states.

A summary table holds one state per group, in folders by year and a hash
bucket of the group. A batch of new daily rows is reduced to its own states
and merged into just the folders that it touches, by way of a redo record.
Sums must not be merged twice, so the table notes the last batch of each
stream (:func:`candela.sinks.parts.publish`, ``once``).

Appends are merged; rows that *replace* daily rows can not be subtracted
from extremes. After an upsert :func:`replace_groups` computes the states of
the touched groups from the stored daily fact.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from candela.operators.partials import Summary, merge, partial
from candela.session import ensure_checkpoint_dir, scratch_dir
from candela.sinks import parts
from candela.streaming.jobs import _run_batches

YEAR, BUCKET = "_year", "_bucket"
FOLDERS = [YEAR, BUCKET]


def _placed(states: DataFrame, summary: Summary, buckets: int) -> DataFrame:
    others = [k for k in summary.keys if k != "year"]
    return states.withColumns({
        YEAR: F.coalesce(F.col("year").cast("string"), F.lit("none")), BUCKET: F.pmod(F.xxhash64(*others), F.lit(buckets)),
    })


def _create(spark: SparkSession, path: str, states: DataFrame, buckets: int) -> int:
    fields = [*states.schema.fields, StructField(YEAR, StringType()), StructField(BUCKET, LongType())]
    return parts.create(spark, path, StructType(fields), buckets)


def _folders_of(stored: DataFrame, placed: DataFrame) -> DataFrame:
    """Stored states of the folders that ``placed`` has rows for."""
    years = [r[YEAR] for r in placed.select(YEAR).distinct().collect()]  # folders to open; at most the years there are
    touched = F.broadcast(placed.select(*FOLDERS).distinct())  # years x buckets
    return stored.where(F.col(YEAR).isin(years)).join(touched, FOLDERS, "left_semi").select(stored.columns)


def merge_batch(spark: SparkSession, rows: DataFrame, path: str, summary: Summary, stream: str, batch: int, buckets: int = 4) -> None:
    """Merge the states of a batch of new rows into the table, once."""
    ensure_checkpoint_dir(spark)
    states = partial(rows, summary)
    buckets = _create(spark, path, states, buckets)
    new = _placed(states, summary, buckets).checkpoint()

    def merged() -> DataFrame:
        stored = parts.read_parts(spark, path)
        if stored is None:
            return new
        both = merge(_folders_of(stored, new).drop(*FOLDERS), new.drop(*FOLDERS), summary)
        return _placed(both.select(states.columns), summary, buckets)

    parts.publish(spark, path, FOLDERS, f"{stream}#{batch}", merged, once=(stream, batch))


def run_merge_summaries(
    spark: SparkSession, daily: DataFrame, tables: Mapping[str, Summary], checkpoint: str, buckets: int = 4
) -> StreamingQuery:
    """Merge every new batch of daily fact rows into the summary tables (path -> summary)."""
    for path in tables:
        if parts.layout(spark, path) is not None:
            parts.finish_pending(spark, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        for path, summary in tables.items():
            merge_batch(spark, batch, path, summary, checkpoint, batch_id, buckets)
        batch.unpersist()

    return _run_batches(daily, checkpoint, write)


def build_summary(spark: SparkSession, fact: DataFrame, path: str, summary: Summary, buckets: int = 4) -> None:
    """The whole table from the daily fact."""
    states = partial(fact, summary)
    buckets = _create(spark, path, states, buckets)
    parts.replace_parts(parts.clustered(_placed(states, summary, buckets), FOLDERS, 1), path, FOLDERS)


def replace_groups(spark: SparkSession, fact: DataFrame, changed: DataFrame, path: str, summary: Summary, source: str) -> None:
    """Recompute the states of the groups that hold a changed (ticker, date) from the stored daily fact.

    ``changed`` has the daily rows as they are now (with all columns that the
    group keys are made of).
    """
    ensure_checkpoint_dir(spark)
    _, buckets = parts.layout(spark, path)
    names = list(summary.keys)
    groups = changed.select(*[c.alias(k) for k, c in summary.keys.items()]).distinct()
    kept_path = scratch_dir(spark, "summary-groups")
    groups.write.parquet(kept_path)
    groups = spark.read.schema(groups.schema).parquet(kept_path)
    keyed = fact.withColumns({f"_g_{k}": c for k, c in summary.keys.items()})
    same = [keyed[f"_g_{k}"].eqNullSafe(groups[k]) for k in names]
    new = _placed(partial(keyed.join(groups, same, "left_semi").drop(*[f"_g_{k}" for k in names]), summary), summary, buckets).checkpoint()

    def merged() -> DataFrame:
        stored = _folders_of(parts.read_parts(spark, path), new)
        others = stored.join(groups, [stored[k].eqNullSafe(groups[k]) for k in names], "left_anti")
        return others.unionByName(new.select(others.columns))

    parts.publish(spark, path, FOLDERS, source, merged)


def read_summary(spark: SparkSession, path: str, summary: Summary) -> DataFrame:
    """The finished rows of a summary table."""
    return summary.finish(parts.read_parts(spark, path).drop(*FOLDERS))
