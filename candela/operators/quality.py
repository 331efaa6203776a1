"""Row expectations (Q1, Q2) and the daily data-quality table (Q3).

Rules are SQL boolean expressions. A rule *fails* for a row when it is
false or NULL. Modes:

* ``warn`` (the reference behaviour): rows are kept; violation counts are
  gathered with ``DataFrame.observe`` while the data is written;
* ``drop``: rows failing any rule are filtered out;
* ``fail``: the first failing row raises via ``raise_error``.

``violation_counts`` computes the counts as a DataFrame in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Rules = list[tuple[str, str]]

# The rule sets of the silver and fact stages.
SILVER_RULES_TEMPLATE = [
    ("rule1", "date IS NOT NULL"),
    ("rule2", "ticker IS NOT NULL"),
    ("rule3", "close > 0"),
    ("rule4", "year(date) >= {year_floor}"),
    ("rule5", "volume > 0"),
]
FACT_RULES: Rules = [
    ("rule1", "date IS NOT NULL"),
    ("rule2", "ticker IS NOT NULL"),
    ("rule3", "close_price > 0"),
    ("rule4", "volume >= 0"),
]


def silver_rules(year_floor: int = 2022) -> Rules:
    return [(n, e.format(year_floor=year_floor)) for n, e in SILVER_RULES_TEMPLATE]


def passes(expr: str) -> Column:
    """True only when the rule holds (NULL counts as a failure)."""
    return F.coalesce(F.expr(expr), F.lit(False))


def failure_count(expr: str) -> Column:
    return F.sum(F.when(passes(expr), 0).otherwise(1))


def violation_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """``rule, expectation, failed_records, total_records``: one row per rule, one scan."""
    agg = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.coalesce(failure_count(e), F.lit(0)).cast("bigint").alias(n) for n, e in rules],
    )
    rows_ = [F.struct(F.lit(n).alias("rule"), F.lit(e).alias("expectation"), F.col(n).alias("failed_records"))
             for n, e in rules]
    return agg.select(F.explode(F.array(*rows_)).alias("r"), "_total").select(
        "r.rule", "r.expectation", "r.failed_records", F.col("_total").alias("total_records")
    )


def observe_rules(df: DataFrame, rules: Rules, name: str | Observation = "expectations") -> DataFrame:
    """Attach per-rule failure counters (plus ``total``) as observed metrics."""
    metrics = [F.count(F.lit(1)).alias("total")] + [F.coalesce(failure_count(e), F.lit(0)).alias(n) for n, e in rules]
    return df.observe(name, *metrics)


def expect_all(df: DataFrame, rules: Rules, mode: str = "warn", observation: Observation | None = None) -> DataFrame:
    """Apply ``rules`` in ``mode`` (warn / drop / fail); counters go to ``observation`` if given."""
    if observation is not None:
        df = observe_rules(df, rules, observation)
    if mode == "warn":
        return df
    all_pass = F.lit(True)
    for _, e in rules:
        all_pass = all_pass & passes(e)
    if mode == "drop":
        return df.where(all_pass)
    if mode == "fail":
        names = ", ".join(n for n, _ in rules)
        # A filter (not a dropped column) so that column pruning cannot remove the check.
        guard = F.when(all_pass, F.lit(True)).otherwise(F.raise_error(F.lit(f"expectation failed ({names})")).cast("boolean"))
        return df.where(guard)
    raise ValueError("mode must be warn, drop or fail")


def data_quality_metrics(fact: DataFrame, stamp: bool = False) -> DataFrame:
    """Q3: per date row count, distinct tickers, zero-volume and NULL-close rows, mean volume."""
    aggs = [
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct("ticker").alias("unique_tickers"),
        F.sum(F.when(F.col("volume") == 0, 1).otherwise(0)).alias("zero_volume_records"),
        F.sum(F.when(F.col("close_price").isNull(), 1).otherwise(0)).alias("null_price_records"),
        F.avg("volume").alias("avg_volume"),
    ]
    if stamp:
        aggs.append(F.current_timestamp().alias("calculated_timestamp"))
    return fact.groupBy("date").agg(*aggs)
