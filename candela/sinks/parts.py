"""Tables that jobs rewrite by parts (partition folders), so that a crash loses nothing.

Layout. ``<table>/_layout`` holds the table's schema (with its partition
columns) and its number of hash buckets, written when the table is created.
Readers take the schema from there, so folder names are never read as
numbers or dates, and a job that is started with another bucket count keeps
the table's.

Buckets. A table's rows are dealt to hash buckets by a directory that grows
(extendible hashing): ``<table>/_directory/<version>`` lists the buckets, each
the last ``depth`` bits of the keys' hash, and a bucket that has grown over a
byte bound is split in two by one more bit. Bucket ids are ``2^depth + bits``,
so old and new buckets never share a folder. A split writes the new folders,
then the new directory, and removes the old folder last; readers open only
the folders that the latest directory names, so they see a bucket or its
halves, whenever a crash happens.

Publishing. Replacing a part deletes its folder and then moves the new one
in; between the two the part is missing. So the new rows of all parts that
a batch touches are first written as a redo record under
``<table>/_redo/<batch>``, and a mark is set when they are complete. Only
then are the parts replaced, and the record is deleted at the end. A job
that finds a marked record publishes it again before it does anything else:
it never merges a batch with a part that a crash has left missing. A record
without its mark is of a batch that has not touched the table; it is
dropped, and the batch runs again.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candela.files import bytes_of, delete_path, folder_names, path_exists
from candela.sinks.tables import table_exists

REDO, DONE = "_redo", "_done"
#: Partition column of the hash buckets.
BUCKET = "_bucket"


# -- layout -----------------------------------------------------------------------


def layout(spark: SparkSession, path: str) -> tuple[StructType, int] | None:
    """Schema and bucket count of the table; None before it is created."""
    if not table_exists(spark, f"{path}/_layout", "json"):
        return None
    row = spark.read.schema("schema string, buckets int").json(f"{path}/_layout").first()
    return StructType.fromJson(json.loads(row["schema"])), row["buckets"]


def create(spark: SparkSession, path: str, schema: StructType, buckets: int = 0) -> int:
    """Create the table's layout, if it has none; returns the bucket count that holds."""
    known = layout(spark, path)
    if known is not None:
        return known[1]
    row = [(json.dumps(schema.jsonValue()), buckets)]
    spark.createDataFrame(row, "schema string, buckets int").coalesce(1).write.mode("overwrite").json(f"{path}/_layout")
    return buckets


def read_parts(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table with its partition columns; None before the first write."""
    known = layout(spark, path)
    if known is None or not table_exists(spark, path):
        return None
    rows = spark.read.schema(known[0]).parquet(path).select(known[0].names)
    ids = directory(spark, path)
    return rows if ids is None else rows.where(F.col(BUCKET).isin(ids))


# -- directory of buckets --------------------------------------------------------------

DIRECTORY = "_directory"


def directory(spark: SparkSession, path: str) -> list[int] | None:
    """The bucket ids of the table; None for a table without a directory."""
    for name in reversed(folder_names(spark, f"{path}/{DIRECTORY}")):
        if table_exists(spark, f"{path}/{DIRECTORY}/{name}", "json"):
            return sorted(r["id"] for r in spark.read.schema("id long").json(f"{path}/{DIRECTORY}/{name}").collect())
    return None


def _write_directory(spark: SparkSession, path: str, ids: Sequence[int]) -> None:
    versions = folder_names(spark, f"{path}/{DIRECTORY}")
    version = int(versions[-1]) + 1 if versions else 0
    rows = spark.createDataFrame([(i,) for i in ids], "id long").coalesce(1)
    rows.write.mode("overwrite").json(f"{path}/{DIRECTORY}/{version:08d}")
    for old in versions[:-1]:
        delete_path(spark, f"{path}/{DIRECTORY}/{old}")


def create_directory(spark: SparkSession, path: str, buckets: int) -> list[int]:
    """The table's bucket ids; a new table gets at least ``buckets`` of them (a power of two)."""
    known = directory(spark, path)
    if known is not None:
        return known
    depth = max(0, buckets - 1).bit_length()
    ids = [(1 << depth) | code for code in range(1 << depth)]
    _write_directory(spark, path, ids)
    return ids


def bucket_in(keys: Sequence[str], ids: Sequence[int]) -> Column:
    """Id of a row's bucket: the one whose bits end the hash of the keys."""
    hashed, by_depth = F.xxhash64(*keys), {}
    for i in ids:
        by_depth.setdefault(i.bit_length() - 1, []).append(i)
    found = []
    for depth, some in sorted(by_depth.items()):
        candidate = hashed.bitwiseAND(F.lit((1 << depth) - 1).cast("long")) + F.lit(1 << depth).cast("long")
        found.append(F.when(candidate.isin(some), candidate))
    return F.coalesce(*found)


def bucket_of(spark: SparkSession, path: str, keys: Sequence[str]) -> Column:
    """Bucket of a row of the table, by its directory, or by its fixed bucket count if it has none."""
    ids = directory(spark, path)
    if ids is not None:
        return bucket_in(keys, ids)
    return F.pmod(F.xxhash64(*keys), F.lit(layout(spark, path)[1]))


def split_large(
    spark: SparkSession, path: str, keys: Sequence[str], parts: Sequence[str], bucket: str, touched: Sequence[int], most_bytes: int
) -> list[int]:
    """Split the touched buckets of which a part is larger than ``most_bytes``, once each; returns the new ids.

    ``parts`` are the table's partition columns, ``bucket`` the last of them.
    """
    ids = set(directory(spark, path) or ())
    new: list[int] = []
    for old in [i for i in touched if i in ids]:
        folders = _bucket_folders(spark, path, len(parts) - 1, f"{bucket}={old}")
        if max((bytes_of(spark, f) for f in folders), default=0) <= most_bytes:
            continue
        depth = old.bit_length() - 1
        low = old - (1 << depth)
        halves = [(2 << depth) | low, (2 << depth) | low | (1 << depth)]
        schema = layout(spark, path)[0]
        rows = spark.read.schema(schema).parquet(path).where(F.col(bucket) == old).select(schema.names)
        replace_parts(clustered(rows.withColumn(bucket, bucket_in(keys, halves)), parts, 1), path, parts)
        ids = (ids - {old}) | set(halves)
        _write_directory(spark, path, sorted(ids))
        for folder in folders:
            delete_path(spark, folder)
        new += halves
    return new


def _bucket_folders(spark: SparkSession, path: str, depth: int, name: str) -> list[str]:
    """Folders of a bucket, ``depth`` levels of other partition columns below the table."""
    if not depth:
        return [f"{path}/{name}"] if path_exists(spark, f"{path}/{name}") else []
    inner = [n for n in folder_names(spark, path) if "=" in n]
    return [f for n in inner for f in _bucket_folders(spark, f"{path}/{n}", depth - 1, name)]


# -- publishing ---------------------------------------------------------------------


def clustered(df: DataFrame, partition_by: Sequence[str], files: int) -> DataFrame:
    """Gather the rows of a partition folder into at most ``files`` tasks (a hot folder keeps that many writers)."""
    spread = F.pmod(F.xxhash64(*[c for c, kind in df.dtypes if not kind.startswith("map")]), F.lit(files))
    return df.repartition(*partition_by, spread)


def replace_parts(df: DataFrame, path: str, parts: Sequence[str]) -> None:
    """Write the part folders that ``df`` has rows for; other folders are not touched."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def finish_pending(spark: SparkSession, path: str) -> list[str]:
    """Publish the complete redo records that a crash has left, drop the others; returns what was published."""
    done = []
    for name in folder_names(spark, f"{path}/{REDO}"):
        record = f"{path}/{REDO}/{name}"
        if path_exists(spark, f"{record}/mark"):
            done.append(_publish_record(spark, path, record))
        else:
            delete_path(spark, record)
    return done


def _publish_record(spark: SparkSession, path: str, record: str) -> str:
    mark = spark.read.schema(MARK).json(f"{record}/mark").first()
    schema = StructType.fromJson(json.loads(mark["schema"]))
    replace_parts(spark.read.schema(schema).parquet(f"{record}/rows"), path, mark["parts"])
    if mark["stream"] is not None:
        _note_done(spark, path, mark["stream"], mark["batch"])
    delete_path(spark, f"{record}/mark")  # from here on the record is of no use
    delete_path(spark, record)
    return mark["source"]


MARK = "source string, schema string, parts array<string>, stream string, batch long"


def _done_file(path: str, stream: str) -> str:
    return f"{path}/{DONE}/{hashlib.sha256(stream.encode()).hexdigest()[:24]}"


def _note_done(spark: SparkSession, path: str, stream: str, batch: int) -> None:
    spark.createDataFrame([(batch,)], "batch long").coalesce(1).write.mode("overwrite").json(_done_file(path, stream))


def last_done(spark: SparkSession, path: str, stream: str) -> int:
    """The last batch of the stream that is merged for good; -1 before the first."""
    if not table_exists(spark, _done_file(path, stream), "json"):
        return -1
    return spark.read.schema("batch long").json(_done_file(path, stream)).agg(F.max("batch")).first()[0]


def publish(
    spark: SparkSession, path: str, parts: Sequence[str], source: str, merged: Callable[[], DataFrame], files_per_part: int = 1,
    once: tuple[str, int] | None = None,
) -> None:
    """Replace the parts that ``merged()`` has rows for, by way of a redo record.

    ``source`` names the batch: if a record of it is complete already, it is
    published as it is, and nothing is merged again. ``merged`` is called
    after pending records are published, so it may read the table.

    ``once=(stream, batch)`` is for merges that must not be repeated (sums):
    the table notes the last batch of each stream before the record goes, and
    a batch that it has is left out.
    """
    if source in finish_pending(spark, path):
        return
    if once is not None and last_done(spark, path, once[0]) >= once[1]:
        return
    record = f"{path}/{REDO}/{hashlib.sha256(source.encode()).hexdigest()[:24]}"
    rows = merged()
    clustered(rows, parts, files_per_part).write.mode("overwrite").parquet(f"{record}/rows")
    mark = [(source, json.dumps(rows.schema.jsonValue()), list(parts), *(once or (None, None)))]
    spark.createDataFrame(mark, MARK).coalesce(1).write.mode("overwrite").json(f"{record}/mark")
    _publish_record(spark, path, record)


def replace_table(df: DataFrame, path: str, source: str) -> None:
    """Replace an unpartitioned table by way of a redo record (``df`` may read the table)."""
    spark = df.sparkSession
    finish_table(spark, path)
    record = _table_record(path)
    df.write.mode("overwrite").parquet(f"{record}/rows")
    spark.createDataFrame([(source, json.dumps(df.schema.jsonValue()))], "source string, schema string").coalesce(1).write.mode(
        "overwrite"
    ).json(f"{record}/mark")
    finish_table(spark, path)


def finish_table(spark: SparkSession, path: str) -> None:
    """Complete a replacement that a crash has interrupted."""
    record = _table_record(path)
    if path_exists(spark, f"{record}/mark"):
        mark = spark.read.schema("source string, schema string").json(f"{record}/mark").first()
        rows = spark.read.schema(StructType.fromJson(json.loads(mark["schema"]))).parquet(f"{record}/rows")
        rows.write.mode("overwrite").parquet(path)
        delete_path(spark, f"{record}/mark")
    delete_path(spark, record)


def _table_record(path: str) -> str:
    """Beside the table: overwriting it deletes all that it holds."""
    return f"{path.rstrip('/')}.redo"
