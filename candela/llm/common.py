"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from candela.session import scratch_dir, workers_find_package

#: Bytes of an Arrow batch that Spark hands to a Python worker at one time.
BATCH_BYTES = 8 << 20
#: Characters (or bytes) of a text that a task holds as separate pieces at one time.
SEGMENT = 1 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage, survives lost executors, and gives the planner the
    real size of the data, so that a later join broadcasts it only when it
    is small.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Prepare the session for Python stages: Arrow batches are cut at BATCH_BYTES, workers find this package.

    Spark's own bound is 64 MB. A stage holds several copies of a batch (JVM
    buffers, the worker's input and output), which long texts make large.
    """
    workers_find_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def empty_if_null(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def crc_mod(col: str | Column, n: int) -> Column:
    """crc32 of the id written as decimal text, modulo ``n`` (a NULL id counts as empty text)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def text_slices(batch: pa.Array, limit: int = 2 * SEGMENT) -> Iterator[pa.Array]:
    """Cut an Arrow text array into parts of about ``limit`` bytes (one row at least)."""
    ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch), 0).cast("int64")).to_numpy()
    at, base = 0, 0
    while at < len(batch):
        end = max(at + 1, int(ends.searchsorted(base + limit, side="right")))
        yield batch.slice(at, end - at)
        at, base = end, int(ends[end - 1])


def byte_segments(text: bytes, size: int = SEGMENT) -> Iterator[bytes]:
    """Cut ``text`` at ASCII white space into parts of about ``size`` bytes; no word is cut."""
    at, n = 0, len(text)
    while n - at > size:
        end = at + size
        while end < n and text[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def text_segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """Cut ``text`` into parts of about ``size`` characters before a blank that follows other characters."""
    at, n = 0, len(text)
    while n - at > size:
        end = at + size
        while end < n and not (text[end] == " " and not text[end - 1].isspace()):
            end += 1
        yield text[at:end]
        at = end
    if at < n:
        yield text[at:]


def unused_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet (names compare without regard to case)."""
    have = {c.lower() for c in df.columns}
    name = base
    while name.lower() in have:
        name = "_" + name
    return name


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A DataFrame of a few rows known on the driver (parameters, not data)."""
    return spark.createDataFrame(rows, schema)
