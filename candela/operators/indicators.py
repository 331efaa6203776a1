"""Rolling technical indicators over one series' rows.

Each indicator is declared as a short list of *levels*: dicts of output
column -> expression, where an expression may use columns of earlier
levels. Window expressions take a spec ``w`` that partitions by series and
orders by time, with bounded row frames built from it. There is no
minimum-period rule: early rows use the partial frame. Column names,
helper columns and formulas follow the reference pipeline, including its
documented quirks (SMA-based MACD, lag-of-zero "EMA", rolling OBV / A/D,
same-length stochastic signal). Ratios use ``try_divide`` so a zero
divisor gives NULL whatever the ANSI setting.

Running one indicator applies its levels in turn. ``all_indicators``
merges level *i* of every indicator into one projection, so the whole
chain costs two Window operators (levels 0 and 2) after one sort, instead
of one per indicator. ``silver_indicators`` runs the chain through
:func:`candela.operators.frames.rolling` (plain or block-split).
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candela.functions.scalar import safe_div
from candela.operators.ema import Leg, ema_legs, macd_legs, with_macd_lines
from candela.operators.frames import fitting_block_rows, rolling, rows
from candela.schema import SILVER_LOOKBACK

Levels = list[dict[str, Column]]


def _tp() -> Column:
    return (F.col("high") + F.col("low") + F.col("close")) / 3


def sma_levels(w: WindowSpec, col: str = "close", periods: Sequence[int] = (5, 15, 20, 30, 50)) -> Levels:
    """``sma_p`` = mean of the last p values."""
    return [{f"sma_{p}": F.avg(col).over(rows(w, p)) for p in periods}]


def ema_seeded_levels(w: WindowSpec, col: str = "close", span: int = 12, out_col: str = "ema_12") -> Levels:
    """T2 as the reference computes it.

    The previous value is the lag of a constant 0, so the first row of a
    series takes the span-row mean (= its close) and every later row is
    ``alpha * close``. The recursive EMA is :mod:`candela.operators.ema`.
    """
    alpha = 2.0 / (span + 1)
    prev = F.col("_ema_prev")
    value = F.when(prev.isNull(), F.col("_ema_avg")).otherwise(F.lit(alpha) * F.col(col) + F.lit(1 - alpha) * prev)
    return [
        {"_ema_prev": F.lag(F.lit(0), 1).over(w), "_ema_avg": F.avg(col).over(rows(w, span))},
        {out_col: value},
    ]


def macd_levels(w: WindowSpec, col: str = "close", fast: int = 12, slow: int = 26, signal: int = 9) -> Levels:
    """fast/slow legs are simple means (as in the reference); signal = mean of MACD."""
    return [
        {"ema_fast": F.avg(col).over(rows(w, fast)), "ema_slow": F.avg(col).over(rows(w, slow))},
        {"macd": F.col("ema_fast") - F.col("ema_slow")},
        {"macd_signal": F.avg("macd").over(rows(w, signal))},
        {"macd_gap": F.col("macd") - F.col("macd_signal")},
    ]


def bollinger_levels(w: WindowSpec, col: str = "close", period: int = 20, num_std: float = 2) -> Levels:
    """T4: mean +/- k sample standard deviations; width and %B."""
    frame = rows(w, period)
    mean, std = F.col("bbands_sma"), F.col("_bb_std")
    width = F.col("bbands_upper") - F.col("bbands_lower")
    return [
        {"bbands_sma": F.avg(col).over(frame), "_bb_std": F.stddev(col).over(frame)},
        {"bbands_upper": mean + F.lit(num_std) * std, "bbands_lower": mean - F.lit(num_std) * std},
        {"bbands_width": width, "bbands_pct": safe_div(F.col(col) - F.col("bbands_lower"), width)},
    ]


def atr_levels(w: WindowSpec, period: int = 14) -> Levels:
    """T5: true range against the previous close, simple mean over ``period`` rows."""
    h, lo, pc = F.col("high"), F.col("low"), F.col("prev_close")
    return [
        {"prev_close": F.lag("close").over(w)},
        {"tr": F.greatest(h - lo, F.abs(h - pc), F.abs(lo - pc))},
        {"atr": F.avg("tr").over(rows(w, period))},
    ]


def rsi_levels(w: WindowSpec, col: str = "close", period: int = 14) -> Levels:
    """Mean gain / mean loss over ``period`` rows; no loss -> NULL."""
    d = F.col(col) - F.col("_rsi_prev")
    frame = rows(w, period)
    return [
        {"_rsi_prev": F.lag(col).over(w)},
        {"delta": d, "gain": F.when(d > 0, d).otherwise(F.lit(0)), "loss": F.when(d < 0, -d).otherwise(F.lit(0))},
        {"avg_gain": F.avg("gain").over(frame), "avg_loss": F.avg("loss").over(frame)},
        {"rs": safe_div("avg_gain", "avg_loss")},
        {"rsi": F.lit(100) - safe_div(F.lit(100), F.lit(1) + F.col("rs"))},
    ]


def stochastic_levels(w: WindowSpec, period: int = 14) -> Levels:
    """%K over ``period`` rows; signal = mean of %K over the same ``period`` rows."""
    frame = rows(w, period)
    ll, hh = F.col("lowest_low"), F.col("highest_high")
    return [
        {"lowest_low": F.min("low").over(frame), "highest_high": F.max("high").over(frame)},
        {"stoch_oscillator": safe_div(F.col("close") - ll, hh - ll) * F.lit(100)},
        {"stoch_signal": F.avg("stoch_oscillator").over(frame)},
    ]


def cci_levels(w: WindowSpec, period: int = 20) -> Levels:
    """Each row's deviation is taken from that row's own typical-price mean."""
    frame = rows(w, period)
    return [
        {"_cci_sma_tp": F.avg(_tp()).over(frame)},
        {},
        {"_cci_md": F.avg(F.abs(_tp() - F.col("_cci_sma_tp"))).over(frame)},
        {"cci": safe_div(_tp() - F.col("_cci_sma_tp"), F.lit(0.015) * F.col("_cci_md"))},
    ]


def mfi_levels(w: WindowSpec, period: int = 14) -> Levels:
    """Money flow split by the sign of the typical-price change."""
    flow = _tp() * F.col("volume")
    d = _tp() - F.col("_mfi_prev_tp")
    frame = rows(w, period)
    return [
        {"_mfi_prev_tp": F.lag(_tp()).over(w)},
        {"pos_flow": F.when(d > 0, flow).otherwise(F.lit(0)), "neg_flow": F.when(d < 0, flow).otherwise(F.lit(0))},
        {"pos_mf": F.sum("pos_flow").over(frame), "neg_mf": F.sum("neg_flow").over(frame)},
        {"mfi": F.lit(100) - safe_div(F.lit(100), F.lit(1) + safe_div("pos_mf", "neg_mf"))},
    ]


def obv_levels(w: WindowSpec, period: int = 50) -> Levels:
    """Signed volume by close direction, summed over the last ``period`` rows (not cumulative)."""
    d = F.col("close") - F.col("_obv_prev")
    v = F.col("volume")
    return [
        {"_obv_prev": F.lag("close").over(w)},
        {"_obv_v": F.when(d > 0, v).when(d < 0, -v).otherwise(F.lit(0))},
        {"obv": F.sum("_obv_v").over(rows(w, period))},
    ]


def adl_levels(w: WindowSpec, period: int = 50) -> Levels:
    """Money-flow multiplier x volume, summed over ``period`` rows; a flat bar adds nothing."""
    c, h, lo = F.col("close"), F.col("high"), F.col("low")
    mfm = safe_div((c - lo) - (h - c), h - lo)
    return [{"adl": F.sum(mfm * F.col("volume")).over(rows(w, period))}]


def support_resistance_levels(w: WindowSpec, period: int = 20) -> Levels:
    """Rolling max high / min low and the close's relative distance to them."""
    frame = rows(w, period)
    c = F.col("close")
    return [
        {"resistance": F.max("high").over(frame), "support": F.min("low").over(frame)},
        {
            "distance_to_resistance": safe_div(F.col("resistance") - c, c),
            "distance_to_support": safe_div(c - F.col("support"), c),
        },
    ]


def _p(params: dict, name: str, default):
    return params.get(name, default)


# name -> (level builder, rows its dependency chain reaches back for given parameters)
INDICATORS: dict[str, tuple[Callable[..., Levels], Callable[[dict], int]]] = {
    "sma": (sma_levels, lambda k: max(_p(k, "periods", (5, 15, 20, 30, 50))) - 1),
    "ema_seeded": (ema_seeded_levels, lambda k: max(_p(k, "span", 12) - 1, 1)),
    "macd": (macd_levels, lambda k: max(_p(k, "fast", 12), _p(k, "slow", 26)) - 1 + _p(k, "signal", 9) - 1),
    "bollinger_bands": (bollinger_levels, lambda k: _p(k, "period", 20) - 1),
    "atr": (atr_levels, lambda k: _p(k, "period", 14)),
    "rsi": (rsi_levels, lambda k: _p(k, "period", 14)),
    "stochastic": (stochastic_levels, lambda k: 2 * (_p(k, "period", 14) - 1)),
    "cci": (cci_levels, lambda k: 2 * (_p(k, "period", 20) - 1)),
    "mfi": (mfi_levels, lambda k: _p(k, "period", 14)),
    "obv": (obv_levels, lambda k: _p(k, "period", 50)),
    "adl": (adl_levels, lambda k: _p(k, "period", 50) - 1),
    "support_resistance": (support_resistance_levels, lambda k: _p(k, "period", 20) - 1),
}
CHAIN = list(INDICATORS)


def reach(names: Sequence[str], params: dict | None = None) -> int:
    """Rows the named indicators (with ``params``) look back, at least 1."""
    params = params or {}
    return max([1] + [INDICATORS[n][1](params.get(n, {})) for n in names])


def apply_levels(df: DataFrame, levels_list: Sequence[Levels]) -> DataFrame:
    """Apply several indicators' levels merged level-wise; keep public columns in chain order.

    Within a level, identical expressions (e.g. the 20-row mean of close
    that both SMA-20 and the Bollinger mid-band need, or the previous close
    of ATR, RSI and OBV) are computed once and the other names alias it:
    Spark does not merge equal window functions by itself.
    """
    depth = max(len(lv) for lv in levels_list)
    for i in range(depth):
        first: dict[str, Column] = {}
        aliases: dict[str, str] = {}
        seen: dict[str, str] = {}
        for lv in levels_list:
            if i >= len(lv):
                continue
            for name, expr in lv[i].items():
                key = str(expr)
                if key in seen:
                    aliases[name] = seen[key]
                else:
                    seen[key] = name
                    first[name] = expr
        if first:
            df = df.withColumns(first)
        if aliases:
            df = df.withColumns({n: F.col(src) for n, src in aliases.items()})
    private = [c for lv in levels_list for level in lv for c in level if c.startswith("_")]
    return df.drop(*private)


def ordered_outputs(levels_list: Sequence[Levels]) -> list[str]:
    return [c for lv in levels_list for level in lv for c in level if not c.startswith("_")]


def with_indicators(df: DataFrame, w: WindowSpec, names: Sequence[str] = CHAIN, params: dict | None = None) -> DataFrame:
    """Add the named indicators (default: all twelve, default parameters) using spec ``w``."""
    params = params or {}
    levels_list = [INDICATORS[n][0](w, **params.get(n, {})) for n in names]
    base = [c for c in df.columns]
    out = apply_levels(df, levels_list)
    return out.select(*base, *[c for c in ordered_outputs(levels_list) if c not in base])


def all_indicators(df: DataFrame, w: WindowSpec) -> DataFrame:
    """The twelve groups with default parameters, in the reference order."""
    return with_indicators(df, w, CHAIN)


def run_indicators(
    df: DataFrame,
    names: Sequence[str],
    params: dict | None = None,
    strategy: str = "blocks",
    block_rows: int | None = None,
    key: str = "ticker",
    order: str = "date",
) -> DataFrame:
    """Run several indicator groups in one pass (merged levels) with the chosen frame strategy."""
    params = params or {}
    lookback = reach(names, params)
    return rolling(
        df, lambda d, w: with_indicators(d, w, names, params), key=key, order=order,
        lookback=lookback, strategy=strategy, block_rows=fitting_block_rows(lookback, block_rows),
    )


def indicator(df: DataFrame, name: str, strategy: str = "blocks", block_rows: int | None = None, **params) -> DataFrame:
    """Run one indicator group per ticker with the chosen frame strategy."""
    return run_indicators(df, [name], {name: params}, strategy, block_rows)


def silver_indicators(bars: DataFrame, strategy: str = "blocks", block_rows: int | None = None) -> DataFrame:
    """``silver_ticker_indicators``: bars plus every indicator and helper column."""
    kw = {} if block_rows is None else {"block_rows": block_rows}
    return rolling(bars, all_indicators, lookback=silver_lookback(), strategy=strategy, **kw)


def silver_lookback() -> int:
    return max(SILVER_LOOKBACK, reach(CHAIN))


def _recursive_legs(w, col: str = "close", span: int = 12, out_col: str = "ema_12") -> list[Leg]:
    return [Leg(out_col, span, col)]


def _macd_ema_legs(w, col: str = "close", fast: int = 12, slow: int = 26, signal: int = 9) -> list[Leg]:
    return macd_legs(col, fast, slow, signal)


#: Calls of the fluent form that are scans over a whole series: the averages of each.
SCANS = {"ema_recursive": _recursive_legs, "macd_ema": _macd_ema_legs}


class IndicatorChain:
    """Fluent form: ``IndicatorChain(df, "symbol", "date").sma().rsi(period=10).get_df()``.

    Methods take the parameters of the level builders above, by position or
    by name, and may be called repeatedly; an indicator may read an earlier
    call's output (``.rsi().sma(col="rsi")``). ``get_df`` groups the calls
    into steps: calls that do not depend on one another share their
    dependency levels, a call that reads or replaces a column of the
    current step (or repeats an indicator) opens the next step. All steps
    run on one numbering and one exchange; their look-backs add up, so the
    ghost rows of the blocks are deep enough for the last step.

    ``macd(kind="ema")`` and ``ema(kind="recursive")`` reach back to the start
    of a series: they run as scans between the windowed steps. Neighbouring
    calls that do not read one another's output are one scan.
    """

    def __init__(self, df: DataFrame, symbol_col: str = "symbol", date_col: str = "date",
                 strategy: str = "blocks", block_rows: int | None = None):
        self._df, self._key, self._order = df, symbol_col, date_col
        self._strategy, self._block_rows = strategy, block_rows
        self._calls: list[tuple[str, dict]] = []

    def _add(self, name: str, args: tuple, params: dict) -> "IndicatorChain":
        builder = SCANS[name] if name in SCANS else INDICATORS[name][0]
        bound = inspect.signature(builder).bind(None, *args, **params).arguments
        first = next(iter(inspect.signature(builder).parameters))
        self._calls.append((name, {k: v for k, v in bound.items() if k != first}))
        return self

    def sma(self, *a, **kw): return self._add("sma", a, kw)  # noqa: E704
    def bollinger_bands(self, *a, **kw): return self._add("bollinger_bands", a, kw)  # noqa: E704
    def atr(self, *a, **kw): return self._add("atr", a, kw)  # noqa: E704
    def rsi(self, *a, **kw): return self._add("rsi", a, kw)  # noqa: E704
    def stochastic(self, *a, **kw): return self._add("stochastic", a, kw)  # noqa: E704
    def cci(self, *a, **kw): return self._add("cci", a, kw)  # noqa: E704
    def mfi(self, *a, **kw): return self._add("mfi", a, kw)  # noqa: E704
    def obv(self, *a, **kw): return self._add("obv", a, kw)  # noqa: E704
    def adl(self, *a, **kw): return self._add("adl", a, kw)  # noqa: E704
    def support_resistance(self, *a, **kw): return self._add("support_resistance", a, kw)  # noqa: E704

    def ema(self, *a, kind: str = "seeded", **kw):
        """``seeded``: as the reference computes it; ``recursive``: the recurrence itself."""
        if kind not in ("seeded", "recursive"):
            raise ValueError("kind must be 'seeded' or 'recursive'")
        return self._add("ema_seeded" if kind == "seeded" else "ema_recursive", a, kw)

    def macd(self, *a, kind: str = "sma", **kw):
        if kind not in ("sma", "ema"):
            raise ValueError("kind must be 'sma' or 'ema'")
        return self._add("macd" if kind == "sma" else "macd_ema", a, kw)

    def _steps(self) -> list[list[tuple[str, dict]]]:
        """Calls grouped into steps (see the class): windowed calls, or calls of one scan."""
        steps: list[list[tuple[str, dict]]] = []
        made: set[str] = set()
        w = Window.partitionBy(self._key).orderBy(self._order)
        for name, params in self._calls:
            if name in SCANS:
                outputs = {leg.out for leg in SCANS[name](None, **params)} | ({"macd", "macd_gap"} if name == "macd_ema" else set())
            else:
                outputs = {c for level in INDICATORS[name][0](w, **params) for c in level}
            other = not steps or (name in SCANS) != (steps[-1][0][0] in SCANS)
            again = not other and name not in SCANS and any(name == n for n, _ in steps[-1])
            if other or again or params.get("col") in made or outputs & made:
                steps.append([])
                made = set()
            steps[-1].append((name, params))
            made |= outputs
        return steps

    def get_df(self) -> DataFrame:
        out, run = self._df, []
        for step in [*self._steps(), None]:
            if step is not None and step[0][0] not in SCANS:
                run.append(step)
                continue
            if run:
                out = self._windowed(out, run)
                run = []
            if step is not None:
                out = self._scanned(out, step)
        return out

    def _scanned(self, df: DataFrame, step: list[tuple[str, dict]]) -> DataFrame:
        """All averages of the step's calls by one scan."""
        legs = [leg for name, params in step for leg in SCANS[name](None, **params)]
        out = ema_legs(df, legs, key=self._key, order=self._order)
        return with_macd_lines(out) if any(name == "macd_ema" for name, _ in step) else out

    def _windowed(self, df: DataFrame, steps: list[list[tuple[str, dict]]]) -> DataFrame:
        def compute(d: DataFrame, w: WindowSpec) -> DataFrame:
            for step in steps:
                d = with_indicators(d, w, [n for n, _ in step], dict(step))
            return d

        lookback = sum(reach([n for n, _ in step], dict(step)) for step in steps)
        return rolling(
            df, compute, key=self._key, order=self._order, lookback=lookback, strategy=self._strategy,
            block_rows=fitting_block_rows(lookback, self._block_rows),
        )
