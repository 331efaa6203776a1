"""Raw bar files: one folder per ticker, CSV with a header, columns bound by position.

The ticker is the file's folder name as the data source wrote it
(``raw/CL=F/file.csv``), or the value of a ``ticker=`` folder as Spark writes
partitioned output, so one glob scan covers every ticker. A ticker list
narrows the glob itself, so folders of other tickers are not even listed; an
empty list names no ticker and gives no rows. ``date`` is cast to DATE once
at landing; unparseable text becomes NULL and is caught by the
``date IS NOT NULL`` rule.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from candela.schema import RAW_BAR

# The prefix and the NULL name of Spark's partition folders, and the characters that it escapes in them.
PARTITION_PREFIX = "ticker="
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = "\"#%'*/:=?\\{}[]^\x7f"


def partition_name(ticker: str) -> str:
    """Folder name of a ticker in partitioned output."""
    return "".join(f"%{ord(c):02X}" if c in ESCAPED or ord(c) < 32 else c for c in ticker)


def ticker_from_path(path: Column) -> Column:
    """Ticker of a file's URI: its folder name, percent-decoded without form rules (a ``+`` is a ``+``)."""
    decoded = lambda c: F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    folder = decoded(F.nullif(F.regexp_extract(path, r"/([^/]+)/[^/]+$", 1), F.lit("")))
    value = F.substring(folder, len(PARTITION_PREFIX) + 1, 1 << 30)
    inner = F.nullif(F.coalesce(decoded(value), value), F.lit(NULL_PARTITION))
    return F.when(folder.startswith(PARTITION_PREFIX), inner).otherwise(folder)


def _glob(raw_dir: str, tickers: Sequence[str] | None = None) -> str:
    """All ticker folders, or only the listed ones (a brace glob: unlisted folders are never listed).

    Characters with a meaning in globs become ``?``; the filter in ``land``
    makes the choice exact.
    """
    if tickers is None:
        return raw_dir.rstrip("/") + "/*/"
    if not tickers:  # a glob that no folder matches: a stream sees no file, so it marks none as seen
        return f"{raw_dir.rstrip('/')}/{{no-ticker-{uuid.uuid4().hex}}}/"
    names = sorted({n for t in tickers for n in (t, PARTITION_PREFIX + partition_name(t))})
    plain = [re.sub(r"[*?{}\[\]\\,^:]", "?", n) for n in names]
    return raw_dir.rstrip("/") + "/{" + ",".join(dict.fromkeys(plain)) + "}/"


def land(raw: DataFrame, tickers: Sequence[str] | None = None) -> DataFrame:
    """Add ``ticker`` from the file path and cast ``date``; works on batch and streaming frames."""
    out = raw.select(
        ticker_from_path(F.col("_metadata.file_path")).alias("ticker"),
        F.try_to_date(F.col("date")).alias("date"),
        "open", "high", "low", "close", "adj_close", "volume",
    )
    if tickers is not None:
        out = out.where(F.col("ticker").isin(list(tickers)) if tickers else F.lit(False))
    return out


def read_bars_csv(spark: SparkSession, raw_dir: str, tickers: Sequence[str] | None = None) -> DataFrame:
    """Batch read of every raw file; no ticker folder at all (or an empty list) gives an empty, typed frame."""
    try:
        if tickers is not None and not tickers:
            raise AnalysisException("PATH_NOT_FOUND: no ticker is listed")
        raw = spark.read.schema(RAW_BAR).option("header", True).csv(_glob(raw_dir, tickers))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        raw = spark.createDataFrame([], RAW_BAR).withColumn("_metadata", F.struct(F.lit("").alias("file_path")))
    return land(raw, tickers)


# -- malformed rows -----------------------------------------------------------

#: Why a row is malformed (NULL: it is not), its text and its file.
REASON, TEXT, FILE = "reason", "text", "file"
CHECK_COLUMNS = (REASON, TEXT, FILE)
CORRUPT = "_corrupt_record"
#: The raw layout with a place for the text of rows that do not fit it.
CHECKED_BAR = StructType([*RAW_BAR.fields, StructField(CORRUPT, StringType())])


def reason_of(raw: DataFrame) -> Column:
    """NULL for a row that fits RAW_BAR; else what does not fit: its number of fields, or the columns that can not be parsed.

    An empty field is a NULL, as without the check; a row is malformed if it
    has another number of fields, or text where a number or date belongs.
    """
    record, width = F.col(CORRUPT), len(RAW_BAR.fields)
    fields = F.split(F.regexp_replace(record, '"[^"]*"', "q"), ",", -1)  # a quoted field may hold commas
    unparsed = [
        F.when(F.col(f.name).isNull() & (F.trim(F.get(fields, F.lit(k))) != ""), f.name)
        for k, f in enumerate(RAW_BAR.fields) if not isinstance(f.dataType, StringType)
    ]
    bad_date = (F.trim("date") != "") & F.try_to_date(F.col("date")).isNull()
    columns = F.concat_ws(", ", F.when(bad_date, "date"), *[F.when(record.isNotNull(), c) for c in unparsed])
    count = F.size(fields)
    return (
        F.when(record.isNotNull() & (count < width), F.concat(F.lit("short row: "), count.cast("string"), F.lit(" fields")))
        .when(record.isNotNull() & (count > width), F.concat(F.lit("long row: "), count.cast("string"), F.lit(" fields")))
        .when(columns != "", F.concat(F.lit("not parsed: "), columns))
        .when(record.isNotNull(), "not parsed")
    )


def land_checked(raw: DataFrame, tickers: Sequence[str] | None = None) -> DataFrame:
    """The columns of :func:`land` and CHECK_COLUMNS, from rows read with CHECKED_BAR."""
    reason = reason_of(raw)
    plain = F.to_csv(F.struct(*RAW_BAR.names))  # the text of a row that the reader took, but whose date is none
    out = raw.select(
        ticker_from_path(F.col("_metadata.file_path")).alias("ticker"),
        F.try_to_date(F.col("date")).alias("date"),
        "open", "high", "low", "close", "adj_close", "volume",
        reason.alias(REASON),
        F.when(reason.isNotNull(), F.coalesce(CORRUPT, plain)).alias(TEXT),
        F.when(reason.isNotNull(), F.col("_metadata.file_path")).alias(FILE),
    )
    if tickers is not None:
        out = out.where(F.col("ticker").isin(list(tickers)) if tickers else F.lit(False))
    return out


def read_checked_stream(
    spark: SparkSession, raw_dir: str, tickers: Sequence[str] | None = None, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Incremental read as :func:`read_bars_stream`, with malformed rows told apart (CHECK_COLUMNS).

    Without the check Spark cuts a long row, fills up a short one and reads
    text in a number's place as NULL. All columns are parsed, whichever are
    asked for, so that a row is malformed or not independent of the query.
    """
    reader = spark.readStream.schema(CHECKED_BAR).option("header", True).option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return land_checked(reader.csv(_glob(raw_dir, tickers)), tickers)


def read_bars_stream(
    spark: SparkSession,
    raw_dir: str,
    tickers: Sequence[str] | None = None,
    max_files_per_trigger: int | None = None,
    clean_source: str | None = None,
    archive_dir: str | None = None,
) -> DataFrame:
    """Incremental read of new raw files (the source's checkpoint remembers seen files).

    ``clean_source="archive"`` (with ``archive_dir``) or ``"delete"`` moves
    processed files out of the landing folder, which keeps the per-trigger
    listing small when drops accumulate over years. An empty ticker list
    gives no rows and leaves all files to later runs.
    """
    reader = spark.readStream.schema(RAW_BAR).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
        if archive_dir:
            reader = reader.option("sourceArchiveDir", archive_dir)
    return land(reader.csv(_glob(raw_dir, tickers)), tickers)


def write_bars_csv(bars: DataFrame, raw_dir: str, mode: str = "append") -> None:
    """Write bars as raw drops, one folder per ticker (staging for ingest checks)."""
    (
        bars.select(
            F.date_format("date", "yyyy-MM-dd").alias("date"),
            "open", "high", "low", "close", "adj_close", "volume", "ticker",
        )
        .write.mode(mode)
        .partitionBy("ticker")
        .option("header", True)
        .csv(raw_dir)
    )
