"""Stand-in inputs for checks: bars in the shapes the ingest jobs expect.

These helpers only reshape rows of the test tables (add load stamps,
append older copies with altered prices, write files); they do none of the
work of the jobs they feed.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Load stamps of the two staged drops.
EARLY = _dt.datetime(2025, 1, 1, 8, 0, 0)
LATE = _dt.datetime(2025, 1, 2, 8, 0, 0)


def stamped(bars: DataFrame, ts: _dt.datetime) -> DataFrame:
    return bars.withColumn("processed_timestamp", F.lit(ts).cast("timestamp"))


def stale_copies(bars: DataFrame) -> DataFrame:
    """Older copies of every bar with a changed close (and adj_close)."""
    return stamped(bars, EARLY).withColumns(
        {"close": F.col("close") + F.lit(1.0), "adj_close": F.col("adj_close") + F.lit(1.0)}
    )


def bars_with_stale_copies(bars: DataFrame) -> DataFrame:
    """The bars stamped late, plus a stale earlier copy of each."""
    return stale_copies(bars).unionByName(stamped(bars, LATE))


def broken_bars(bars: DataFrame, close: str = "close") -> DataFrame:
    """Bars of which those of some days of the month break a rule: NULL date, NULL ticker, close and volume not positive."""
    day, broken = F.dayofmonth("date"), F.lit(None)
    return bars.withColumns({
        "ticker": F.when(day == 3, broken.cast("string")).otherwise(F.col("ticker")),
        close: F.when(day == 5, F.lit(0.0)).otherwise(F.col(close)),
        "volume": F.when(day == 7, F.lit(-1)).otherwise(F.col("volume")).cast("bigint"),
        "date": F.when(day == 2, broken.cast("date")).otherwise(F.col("date")),
    })


def with_symbols(bars: DataFrame) -> DataFrame:
    """Bars whose tickers are written as data sources write them: punctuation, digits only, leading zeros."""
    kind = F.ascii(F.right("ticker", F.lit(1))) % 4
    return bars.withColumn(
        "ticker",
        F.when(kind == 0, F.concat("ticker", F.lit("=F"))).when(kind == 1, F.concat(F.lit("A+"), F.col("ticker")))
        .when(kind == 2, F.lpad(F.regexp_extract("ticker", "[0-9]*$", 0), 4, "0"))
        .otherwise(F.concat(F.lit("^"), F.col("ticker"), F.lit("%x"))),
    )


def broken_events(events: DataFrame) -> DataFrame:
    """Events of which some have no user and some a value out of range."""
    n = F.col("event_id")
    value = F.when(n % 13 == 0, F.lit(-1.0)).when(n % 13 == 1, F.lit(1000.0)).otherwise(F.col("value"))
    return events.withColumns({
        "user_id": F.when(n % 11 == 0, F.lit(None).cast("bigint")).otherwise(F.col("user_id")),
        "value": value.cast(events.schema["value"].dataType),
    })


def null_users(events: DataFrame) -> DataFrame:
    """Events of which some users are unknown."""
    return events.withColumn("user_id", F.when(F.col("user_id") % 7 == 0, F.lit(None).cast("bigint")).otherwise(F.col("user_id")))


#: Days of the month whose staged rows are malformed, and how.
SHORT_DAY, LONG_DAY, TEXT_DAY, DATE_DAY, TWO_DAY = 4, 6, 8, 9, 10


def write_malformed_csv(bars: DataFrame, raw_dir: str) -> None:
    """Raw drops of the bars in which the rows of some days of the month are malformed, as lines of text under a header."""
    day = F.coalesce(F.dayofmonth("date"), F.lit(0))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    fields = {c: text(c) for c in ("open", "high", "low", "close", "adj_close", "volume")}
    fields["close"] = F.when(day.isin(TEXT_DAY, TWO_DAY), "oops").otherwise(fields["close"])
    fields["volume"] = F.when(day == TWO_DAY, "n/a").otherwise(fields["volume"])
    date = F.when(day == DATE_DAY, "someday").otherwise(text("date"))
    line = F.concat_ws(",", date, *fields.values())
    line = F.when(day == SHORT_DAY, F.substring_index(line, ",", 4)).when(day == LONG_DAY, F.concat(line, F.lit(",extra"))).otherwise(line)
    rows = bars.select("ticker", F.lit(1).alias("at"), line.alias("line"))
    header = bars.select("ticker").distinct().select("ticker", F.lit(0).alias("at"), F.lit("Date,Open,High,Low,Close,Adj Close,Volume").alias("line"))
    ordered = rows.unionByName(header).repartition("ticker").sortWithinPartitions("ticker", "at")
    ordered.select("ticker", "line").write.mode("append").partitionBy("ticker").text(raw_dir)
