"""Deduplication of a stream without a watermark: no first copy is lost, however late (O1).

The sink itself remembers which keys it has. To find the stored copies of a
batch's keys without reading the whole sink, every append leaves Bloom
filters of its keys beside the rows: one per part (month of the event time,
hash bucket of the key), cut into blocks of 32,768 bits, of which a key uses
one. A batch looks its keys up in the filters of their bucket, opens only
the parts that may hold one of them, and appends the keys that are not
there. A filter never misses a key, so the result is exact; its false
positives (under two percent of the keys at ``BITS_PER_KEY``) only open a
part in vain.

Rows go to a :class:`candela.streaming.jobs.BatchSink`, so a batch that is
run again after a crash replaces itself: its own earlier rows do not count
as stored copies. Its filters are written before it counts as done.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from candela.sinks import parts
from candela.sinks.tables import table_exists
from candela.streaming.jobs import ATTEMPT, BATCH, BUCKET, PERIOD, BatchSink, _attempts, _run_batches, period_of, read_appended

BLOCK_BITS, BITS_PER_KEY, HASHES = 32_768, 10, 6
#: Rows of a batch for each task that builds filters, and for each file of a part.
TASK_ROWS = 1 << 19
BLOCKS, BLOCK, BITS, PLACES = "_blocks", "_block", "_bits", "_places"
FILTERS = f"{PERIOD} string, {BUCKET} long, {BLOCKS} long, {BLOCK} long, {BITS} binary, {BATCH} long"


def _block_of(keys: Sequence[str], blocks: Column) -> Column:
    """Block of a key in a filter of so many blocks (a power of two)."""
    return F.xxhash64(*keys, F.lit(-1)).bitwiseAND(blocks - 1)


def _place(keys: Sequence[str], k: int) -> Column:
    """Bit of a key in its block by the k-th hash."""
    return F.pmod(F.xxhash64(*keys, F.lit(k)), F.lit(BLOCK_BITS))


def _places(keys: Sequence[str]) -> Column:
    """Bits of a key in its block."""
    return F.array(*[_place(keys, k) for k in range(HASHES)])


def part_sizes(rows: DataFrame) -> DataFrame:
    """(period, bucket, n) of the parts of ``rows``."""
    return rows.groupBy(PERIOD, BUCKET).agg(F.count(F.lit(1)).alias("n"))


def bloom_filters(rows: DataFrame, keys: Sequence[str], sizes: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """Filter blocks of each part of ``rows``: (period, bucket, blocks, block, bits).

    The keys are dealt by block, so that a part spreads over many tasks
    (``tasks`` of them, else as many as a shuffle has), and a task sorts one
    row per key: each hash fills a bitmap of its own, and only the bitmaps
    are put together.
    """
    needed = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") * BITS_PER_KEY / BLOCK_BITS)))
    sizes = (part_sizes(rows) if sizes is None else sizes).select(PERIOD, BUCKET, F.pow(F.lit(2), needed).cast("long").alias(BLOCKS))
    sized = rows.select(PERIOD, BUCKET, *keys).join(F.broadcast(sizes), [PERIOD, BUCKET])  # months x buckets
    sized = sized.withColumn(BLOCK, _block_of(keys, F.col(BLOCKS)))
    place = [PERIOD, BUCKET, BLOCKS, BLOCK]
    dealt = sized.repartition(*([tasks] if tasks else []), *place)
    of_hash = [F.bitmap_construct_agg(_place(keys, k)) for k in range(HASHES)]
    return dealt.groupBy(*place).agg(F.array(*of_hash).alias(BITS)).select(*place, F.explode(BITS).alias(BITS)).groupBy(*place).agg(
        F.bitmap_or_agg(BITS).alias(BITS)
    )


def _bit_is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substr(bits, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def parts_that_may_hold(keys_: DataFrame, filters: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(period, bucket) of the parts of which a filter holds all bits of one of the keys."""
    sizes = [r[BLOCKS] for r in filters.select(BLOCKS).distinct().collect()]  # powers of two: at most some 40
    probe = keys_.withColumns({PLACES: _places(keys), BLOCKS: F.explode(F.array(*[F.lit(s).cast("long") for s in sizes]))})
    probe = probe.withColumn(BLOCK, _block_of(keys, F.col(BLOCKS))).select(BUCKET, BLOCKS, BLOCK, PLACES)
    met = probe.join(filters, [BUCKET, BLOCKS, BLOCK])
    return met.where(F.forall(PLACES, lambda p: _bit_is_set(F.col(BITS), p))).select(PERIOD, BUCKET).distinct()


def first_copies(batch: DataFrame, keys: Sequence[str], event_time: str) -> DataFrame:
    """One row per key: the earliest, ties by the whole row."""
    names = batch.columns
    first = F.min(F.struct(F.col(event_time).alias("_at"), F.struct(*names).alias("_row")))
    return batch.groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).agg(first.alias("_b")).select("_b._row.*")


def run_dedup_append(
    stream: DataFrame, keys: Sequence[str], event_time: str, sink_path: str, checkpoint: str, buckets: int = 16
) -> StreamingQuery:
    """Append the first copy of every key (the first batch that brings one wins; within a batch the earliest row).

    NULL is a key value like others. Read the rows with :func:`read_deduplicated`.
    """
    spark = stream.sparkSession
    schema = StructType([*stream.schema.fields, StructField(BUCKET, LongType())])
    sink = BatchSink(spark, sink_path, schema, event_time, [BUCKET], files_per_partition=1)
    filters_path = f"{sink_path}/_filters"

    def write(batch: DataFrame, batch_id: int) -> None:
        one = first_copies(batch, keys, event_time).withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets))).checkpoint()
        new = one
        if table_exists(spark, filters_path):
            filters = spark.read.schema(FILTERS).parquet(filters_path).where(F.col(BATCH) != batch_id)
            places = parts_that_may_hold(one.select(BUCKET, *keys), filters, keys).checkpoint()
            stored = _stored_keys(spark, sink_path, places, keys, batch_id)
            if stored is not None:
                new = without_stored(one, stored, keys).checkpoint()
        placed = new.withColumn(PERIOD, period_of(new.columns, event_time))
        sizes = part_sizes(placed).checkpoint()
        total, largest = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
        blocks = bloom_filters(placed, keys, sizes, math.ceil(total / TASK_ROWS) or 1).withColumn(BATCH, F.lit(batch_id).cast("long"))
        blocks.write.mode("append").parquet(filters_path)
        sink.files = math.ceil(largest / TASK_ROWS) or 1  # files of a part: a writer sorts its rows
        sink.append(new, batch_id)

    return _run_batches(stream, checkpoint, write)


def without_stored(one: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are not stored. Stored keys can be as many as the sink's rows: a sorted join, never a broadcast."""
    same = reduce(and_, [one[k].eqNullSafe(stored[f"_key{i}"]) for i, k in enumerate(keys)])
    return one.join(stored.hint("merge"), same, "left_anti")


def _stored_keys(spark: SparkSession, sink_path: str, places: DataFrame, keys: Sequence[str], batch_id: int) -> DataFrame | None:
    """Keys of the rows that count in the given parts, without the batch's own; None where there is no part."""
    periods = [r[PERIOD] for r in places.select(PERIOD).distinct().collect()]  # folders to open; at most the months there are
    done = _attempts(spark, sink_path)
    if not periods or done is None:
        return None
    schema, _ = parts.layout(spark, sink_path)
    rows = spark.read.schema(schema).parquet(sink_path).where(F.col(PERIOD).isin(periods) & (F.col(BATCH) != batch_id))
    rows = rows.join(F.broadcast(places), [PERIOD, BUCKET], "left_semi")  # months x buckets
    rows = rows.join(done.select(BATCH, ATTEMPT).distinct(), [BATCH, ATTEMPT], "left_semi")
    return rows.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)])


def read_deduplicated(spark: SparkSession, sink_path: str) -> DataFrame:
    """Rows of a sink of :func:`run_dedup_append`."""
    return read_appended(spark, sink_path).drop(BUCKET)
