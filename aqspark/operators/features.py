"""Lag, rolling, change and exponentially weighted features, per entity and by row position.

Every feature is an expression over one window spec, so that all of them share one sort. How far
each looks back is known, so blocks with copied leading rows give exact results (see ``blocks``).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, Window as W
from pyspark.sql.window import WindowSpec

from aqspark import spec as S
from aqspark.functions import scalar as X
from aqspark.functions.calendar import CALENDAR, CYCLIC, time_features
from aqspark.operators import blocks as B
from aqspark.operators.clean import fill
from aqspark.spec import ObsSpec


# ---- expressions over a window -------------------------------------------------------------

def lag_exprs(column: str, lags, w: WindowSpec) -> dict[str, Column]:
    return {f"{column}_lag_{k}": F.lag(column, k).over(w) for k in lags}


def diff_exprs(column: str, w: WindowSpec) -> dict[str, Column]:
    return {f"{column}_diff_{k}h": F.col(column) - F.lag(column, k).over(w) for k in (1, 3)}


def pct_expr(current: Column, previous: Column) -> Column:
    """Relative change; from zero it is 0, or null if still zero. Division stays clear of zero under ANSI."""
    change = current / F.nullif(previous, F.lit(0.0)) - 1
    return F.when((previous == 0) & (current != 0), F.lit(0.0)).otherwise(change)


def ratio_exprs(available: list[str]) -> dict[str, Column]:
    return {name: X.ratio(a, b) for name, a, b in S.RATIOS if a in available and b in available}


# ---- sliding mean and deviation ------------------------------------------------------------

# Expressions of this section are written as SQL text: there are many, and each is one call to the JVM.

_RADIX = 8


def _merged(df: DataFrame, pieces: dict[str, list[tuple[str, str, str]]], kept: list[str]) -> DataFrame:
    """Count, mean and squared deviation of unions of disjoint pieces, as ``_n_{name}`` etc.

    Stable: nothing is subtracted but means. Free of branches and nulls, which keeps the generated code
    small enough to be compiled: an empty piece has count and mean 0 and adds nothing.
    """
    first, second = {}, {}
    for name, parts in pieces.items():
        first[f"_n_{name}"] = " + ".join(n for n, _, _ in parts)
        total = " + ".join(f"{n} * {m}" for n, m, _ in parts)
        first[f"_m_{name}"] = f"({total}) / greatest({first[f'_n_{name}']}, 1D)"
        second[f"_q_{name}"] = " + ".join(f"{q} + {n} * ({m} - _m_{name}) * ({m} - _m_{name})" for n, m, q in parts)
    return _with_exprs(_with_exprs(df, first), second).select(*kept, *first, *second)


def _with_exprs(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.selectExpr("*", *[f"{e} AS `{name}`" for name, e in exprs.items()])


def _lagged_stats(df: DataFrame, wanted: list[tuple[int, int]], over: str) -> DataFrame:
    """Columns ``_n_{rows}_{back}`` etc.: the statistics over ``rows`` rows, as of ``back`` rows ago."""
    return _with_exprs(
        df, {f"_{k}_{rows}_{back}": f"lag(_{k}_{rows}, {back}, 0D) OVER ({over})" for rows, back in wanted if back for k in "nmq"}
    )


def _piece(rows: int, back: int) -> tuple[str, str, str]:
    return tuple(f"_{k}_{rows}_{back}" if back else f"_{k}_{rows}" for k in "nmq")


def with_rolling(df: DataFrame, column: str, days, over: str) -> DataFrame:
    """Mean and sample deviation of the ``24 * d`` rows before the current one; a lone row deviates by 0.
    ``over`` is the window as SQL text.

    A sliding frame would visit every row of every window again. Instead statistics over 1, 8, 64, ...
    rows are built from each other, eight at a time, and each window is put together from a few of them:
    the work per row grows with the logarithm of the window. Rows without a value count as empty.
    """
    kept = df.columns
    x = f"CAST(`{column}` AS DOUBLE)"
    df = _with_exprs(df, {"_n_1": f"if({x} IS NULL, 0D, 1D)", "_m_1": f"coalesce({x}, 0D)", "_q_1": "0D"})
    sizes = [1]
    while sizes[-1] * _RADIX <= 24 * max(days):
        rows = sizes[-1]
        parts = [(rows, i * rows) for i in range(_RADIX)]
        stats = df.columns
        df = _merged(_lagged_stats(df, parts, over), {f"{rows * _RADIX}": [_piece(*p) for p in parts]}, stats)
        sizes.append(rows * _RADIX)
    plans = {}
    for d in days:
        back, left, parts = 1, 24 * d, []
        for rows in reversed(sizes):
            while left >= rows:
                parts.append((rows, back))
                back, left = back + rows, left - rows
        plans[d] = parts
    df = _lagged_stats(df, sorted({p for parts in plans.values() for p in parts}), over)
    df = _merged(df, {f"{d}d": [_piece(*p) for p in parts] for d, parts in plans.items()}, kept)
    out = {}
    for d in days:
        out[f"{column}_roll_mean_{d}d"] = f"if(_n_{d}d > 0D, _m_{d}d, NULL)"
        out[f"{column}_roll_std_{d}d"] = f"sqrt(_q_{d}d / greatest(_n_{d}d - 1D, 1D))"
    return df.selectExpr(*[f"`{c}`" for c in kept], *[f"{e} AS `{name}`" for name, e in out.items()])


# ---- operators -----------------------------------------------------------------------------

def lag_features(df: DataFrame, spec: ObsSpec, column: str | None = None, lags=S.LAGS) -> DataFrame:
    column = column or spec.target
    return B.windowed(df, spec, lambda w: lag_exprs(column, lags, w), before=max(lags))


def pollutant_lags(df: DataFrame, spec: ObsSpec) -> DataFrame:
    present = [p for p in S.LAGGED_POLLUTANTS if p in df.columns]
    return B.windowed(df, spec, lambda w: {f"{p}_lag_1": F.lag(p, 1).over(w) for p in present}, before=1)


def rolling_features(df: DataFrame, spec: ObsSpec, column: str | None = None, days=S.ROLLING_DAYS) -> DataFrame:
    column = column or spec.target
    blocked = B.in_blocks(B.with_position(df, spec), spec, before=24 * max(days))
    return with_rolling(blocked, column, days, B.block_over(spec)).where(B.OWN).drop(B.POS, B.BLOCK, B.OWN)


def rolling_strict(df: DataFrame, spec: ObsSpec, column: str | None = None, rows: int = 24) -> DataFrame:
    """Mean over the current and the ``rows - 1`` rows before it, null until all of them are known."""
    column = column or spec.target

    def build(w):
        full = w.rowsBetween(-(rows - 1), 0)
        mean = F.when(F.count(column).over(full) == rows, F.avg(column).over(full))
        return {f"{column}_roll_{rows}h": mean}

    return B.windowed(df, spec, build, before=rows - 1)


def diff_features(df: DataFrame, spec: ObsSpec, column: str | None = None) -> DataFrame:
    column = column or spec.target
    return B.windowed(df, spec, lambda w: diff_exprs(column, w), before=3)


def pct_change(df: DataFrame, spec: ObsSpec, column: str | None = None) -> DataFrame:
    """Relative change to the row before, gaps carried forward first however long they are."""
    column = column or spec.target
    held = fill(df.withColumn("_held", F.col(column)), spec, ["_held"], backward=False)
    out = B.windowed(
        held, spec, lambda w: {f"{column}_pct_1h": pct_expr(F.col("_held"), F.lag("_held", 1).over(w))}, before=1
    )
    return out.drop("_held")


def ratio_features(df: DataFrame) -> DataFrame:
    return df.withColumns(ratio_exprs(df.columns))


# ---- exponentially weighted mean -----------------------------------------------------------

# e**-40 is below double precision: weights that small no longer change the result
_NEGLIGIBLE = 40.0
_MAX_EXPONENT = 600.0
_SUB_BLOCKS = 12  # of a block, so that the decays between them stay within the exponent too
_HEAD = -1  # sub-block and position of the row that brings what was known before a block


def _decay(span: int) -> float:
    return -math.log(1 - 2 / (span + 1))


def ewm_reach(spans=S.EWM_SPANS) -> int:
    """Known rows back from which a value still counts."""
    return max(math.ceil(_NEGLIGIBLE / _decay(s)) for s in spans)


def _sub_length(spans) -> int:
    return int(_MAX_EXPONENT / max(map(_decay, spans)))


def _ewm_spec(spec: ObsSpec, spans, before: int = 0) -> ObsSpec:
    """Blocks small enough for the exponents of these spans; the heads make any size exact."""
    return spec.with_(block_rows=max(before, min(spec.block_rows, _SUB_BLOCKS * _sub_length(spans) - before)))


def _step(span: int, gap: str) -> tuple[str, str, str]:
    """A known value after ``gap`` rows: what the mean before it keeps, what the value gets, and the logarithm of the first, negated."""
    a, q = f"{2 / (span + 1)!r}D", f"exp(-{_decay(span)!r}D * {gap})"
    return f"{q} / ({q} + {a})", f"{a} / ({q} + {a})", f"({gap} * {_decay(span)!r}D + ln({q} + {a}))"


def _ewm_heads(df: DataFrame, spec: ObsSpec, column: str, spans) -> DataFrame:
    """A row per (entity, block): the last known position and value before the block, and the weighted means there.

    Reads the key and one column. Inside a block the steps after its first known value add up to a factor and a
    sum, whatever the gaps; blocks of an entity, one row each, are then chained in order.
    """
    rows = B.with_position(df.select(*dict.fromkeys([spec.entity, *spec.order]), F.col(column).cast("double").alias("_x")), spec)
    rows = B.by_group(rows.withColumn(B.BLOCK, F.floor(F.col(B.POS) / F.lit(spec.block_rows))), spec, B.BLOCK)
    over = B.block_over(spec)
    known = _with_exprs(rows, {"_at": f"if(_x IS NULL, NULL, {B.POS})"})
    known = _with_exprs(known, {"_gap": f"_at - last(_at, true) OVER ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"})
    steps = _with_exprs(known, {f"_d_{s}": f"coalesce({_step(s, '_gap')[2]}, 0D)" for s in spans})
    whole = f"PARTITION BY `{spec.entity}`, {B.BLOCK}"
    sums = {f"_c_{s}": f"sum(_d_{s}) OVER ({over} ROWS UNBOUNDED PRECEDING)" for s in spans} | {f"_t_{s}": f"sum(_d_{s}) OVER ({whole})" for s in spans}
    steps = _with_exprs(steps, sums)
    totals = ["min(_at) AS first", "max(_at) AS last", "min_by(_x, _at) AS first_x", "max_by(_x, _at) AS last_x"]
    totals += [f"exp(-max(_t_{s})) AS keep_{s}" for s in spans]
    totals += [f"coalesce(sum({_step(s, '_gap')[1]} * _x * exp(_c_{s} - _t_{s})), 0D) AS add_{s}" for s in spans]
    summed = steps.groupBy(spec.entity, B.BLOCK).agg(*map(F.expr, totals))
    names = ["_last_pos", "_last_x", *(f"_y_{s}" for s in spans)]

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(B.BLOCK)
        alpha = np.array([2 / (s + 1) for s in spans])
        keep, add = (pdf[[f"{k}_{s}" for s in spans]].to_numpy() for k in ("keep", "add"))
        out, last, last_x, y = [], np.nan, np.nan, np.full(len(spans), np.nan)
        for i, (first, end, x, x_end) in enumerate(pdf[["first", "last", "first_x", "last_x"]].to_numpy(dtype=float)):
            out.append((last, last_x, *y))
            if not np.isnan(first):
                if np.isnan(last):
                    y = np.full(len(spans), x)
                else:
                    q = (1 - alpha) ** (first - last)
                    y = (q * y + alpha * x) / (q + alpha)
                y, last, last_x = keep[i] * y + add[i], end, x_end
        found = pd.DataFrame(out, columns=names)
        found.insert(0, spec.entity, pdf[spec.entity].to_numpy())
        found.insert(1, B.BLOCK, pdf[B.BLOCK].to_numpy())
        return found

    kind = df.schema[spec.entity].dataType.simpleString()
    heads = summed.groupBy(spec.entity).applyInPandas(chain, f"`{spec.entity}` {kind}, {B.BLOCK} long, " + ", ".join(f"{n} double" for n in names))
    return heads.select(spec.entity, B.BLOCK, *[F.nanvl(n, F.lit(None)).alias(n) for n in names])


def _with_sub_blocks(df: DataFrame, spec: ObsSpec, before: int, length: int) -> DataFrame:
    # counted from the earliest row a block can hold, so that it is never negative
    local = f"({B.POS} - {B.BLOCK} * {max(spec.block_rows, before)} + {before})"
    return _with_exprs(df, {B.SUB: f"if({B.POS} = {_HEAD}, {_HEAD}, {local} div {length})", "_j": f"{local} % {length}"})


def _sub_window(spec: ObsSpec) -> WindowSpec:
    # the sub-block number leads the order, so the windows inside and across sub-blocks share one sort
    return W.partitionBy(spec.entity, B.BLOCK).orderBy(B.SUB, B.POS)


def _known_before(df: DataFrame, spec: ObsSpec, column: str, spans) -> DataFrame:
    """What the head of a block brought, on all its rows, and the last known row and value of the block itself."""
    over = B.block_over(spec, B.SUB)
    so_far, before = f"{over} ROWS UNBOUNDED PRECEDING", f"{over} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    df = _with_exprs(df, {"_x": f"if({B.OWN}, CAST(`{column}` AS DOUBLE), NULL)"})
    exprs = {"_prev": f"last(if(_x IS NULL, NULL, {B.POS}), true) OVER ({before})", "_held": f"last(coalesce(_x, _last_x), true) OVER ({so_far})"}
    exprs |= {f"_first{n}": f"first({n}) OVER ({so_far})" for n in ("_last_pos", *(f"_y_{s}" for s in spans))}
    return _with_exprs(df, exprs)


def _ewm(df: DataFrame, spec: ObsSpec, column: str, before: int, length: int, spans) -> DataFrame:
    """pandas' recursion with gaps: after ``g`` rows, y = (q**g * y + a * x) / (q**g + a); an unknown row holds y.

    So each known row keeps a share of the mean before it and adds its own. Inside a sub-block the shares multiply to
    ``exp(-_c)``, and means are a running sum of scaled terms; the share of its first known row goes to what comes from outside, so that
    a long gap costs no precision. Sub-blocks are chained the same way, from the mean that the head brought.
    """
    inside = f"PARTITION BY `{spec.entity}`, {B.BLOCK}, {B.SUB} ORDER BY {B.POS} ROWS UNBOUNDED PRECEDING"
    across = f"{B.block_over(spec, B.SUB)} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    prev_sub = f"((_prev - {B.BLOCK} * {max(spec.block_rows, before)} + {before}) div {length})"
    kept = [c for c in df.columns if not c.startswith(("_first", "_last_", "_y_"))]
    df = _with_exprs(df, {"_gap": f"if(_x IS NULL, NULL, {B.POS} - coalesce(_prev, _first_last_pos))", "_leads": f"_x IS NOT NULL AND (_prev IS NULL OR {prev_sub} < {B.SUB})"})
    stages: list[dict[str, str]] = [{}, {}, {}, {}, {}, {}]
    end = f"({B.POS} >= 0 AND _j = {length - 1})"
    for s in spans:
        share, own, decay = _step(s, "_gap")
        stages[0] |= {f"_d_{s}": f"if(_leads OR _x IS NULL, 0D, {decay})", f"_a_{s}": f"if(_leads, coalesce({share}, 0D), NULL)"}
        stages[1] |= {f"_c_{s}": f"sum(_d_{s}) OVER ({inside})", f"_o_{s}": f"coalesce(first(_a_{s}, true) OVER ({inside}), 1D)"}
        term = f"coalesce(coalesce({own}, 1D) * _x * exp(_c_{s}), 0D)"
        stages[2] |= {f"_l_{s}": f"sum({term}) OVER ({inside}) * exp(-_c_{s})", f"_w_{s}": f"_o_{s} * exp(-_c_{s})"}
        lost = f"if(_w_{s} < {math.exp(-_NEGLIGIBLE)!r}D, {_NEGLIGIBLE}D, -ln(_w_{s}))"
        stages[3] |= {f"_k_{s}": f"if({end}, {lost}, 0D)", f"_b_{s}": f"coalesce(sum(if({end}, {lost}, 0D)) OVER ({across}), 0D)"}
        outside = f"exp(-_b_{s}) * (coalesce(sum(if({end}, _l_{s} * exp(_b_{s} + _k_{s}), 0D)) OVER ({across}), 0D) + coalesce(_first_y_{s}, 0D))"
        stages[4] |= {f"_m_{s}": f"if(coalesce(_x, _prev, _first_last_pos) IS NULL, NULL, _l_{s} + _w_{s} * {outside})"}
        stages[5] |= {f"{column}_ewm_{s}h": f"lag(_m_{s}, 1) OVER ({B.block_over(spec, B.SUB)})"}
    for stage in stages:
        df = _with_exprs(df, stage)
    return df.select(*kept, *stages[5])


def ewm_features(df: DataFrame, spec: ObsSpec, column: str | None = None, spans=S.EWM_SPANS) -> DataFrame:
    """Recursive weighted means of all earlier rows, also over gaps of any length: weights decay by row, an unknown row holds the mean."""
    column = column or spec.target
    spec = _ewm_spec(spec, spans)
    length = _sub_length(spans)
    out = B.in_blocks(B.with_position(df, spec), spec, before=0, heads=_ewm_heads(df, spec, column, spans))
    out = _known_before(_with_sub_blocks(out, spec, 0, length), spec, column, spans)
    # the mean of the row before the block's first is the one that the head brought, and the head holds it
    return _ewm(out, spec, column, 0, length, spans).where(B.OWN).select(*df.columns, *[f"{column}_ewm_{s}h" for s in spans])


# ---- everything ----------------------------------------------------------------------------

def feature_reach() -> int:
    """Rows before a row on which its features depend."""
    return max(max(S.LAGS), 24 * max(S.ROLLING_DAYS), ewm_reach() + 1)


def all_features(df: DataFrame, spec: ObsSpec) -> DataFrame:
    """Calendar, lag, rolling, change, ratio and weighted features of an observation frame; the target may have gaps.

    One shuffle numbers the rows, one brings blocks together; all windows share the second. The weighted means take
    what was known before a block from a pass over the key and the target alone.
    """
    column = spec.target
    before = max(max(S.LAGS), 24 * max(S.ROLLING_DAYS))
    spec, spans, length = _ewm_spec(spec, S.EWM_SPANS, before), S.EWM_SPANS, _sub_length(S.EWM_SPANS)
    blocked = B.in_blocks(B.with_position(df, spec), spec, before=before, heads=_ewm_heads(df, spec, column, spans))
    blocked = _known_before(_with_sub_blocks(blocked, spec, before, length), spec, column, spans)
    w = _sub_window(spec)
    exprs = lag_exprs(column, S.LAGS, w)
    exprs |= {f"{p}_lag_1": F.lag(p, 1).over(w) for p in S.LAGGED_POLLUTANTS if p in df.columns}
    exprs |= diff_exprs(column, w)
    exprs[f"{column}_pct_1h"] = pct_expr(F.col("_held"), F.lag("_held", 1).over(w))
    rolled = with_rolling(blocked, column, S.ROLLING_DAYS, B.block_over(spec, B.SUB))
    rows = _ewm(rolled.withColumns(exprs), spec, column, before, length, spans).where(B.OWN)
    return time_features(ratio_features(rows), spec.time).select(*df.columns, *feature_names(df, spec))


def feature_names(df: DataFrame, spec: ObsSpec) -> list[str]:
    """Names ``all_features`` adds, in order."""
    column = spec.target
    names = [*CALENDAR, *CYCLIC]
    names += [f"{column}_lag_{k}" for k in S.LAGS]
    names += [f"{p}_lag_1" for p in S.LAGGED_POLLUTANTS if p in df.columns]
    names += [f"{column}_roll_{kind}_{d}d" for d in S.ROLLING_DAYS for kind in ("mean", "std")]
    names += [f"{column}_diff_1h", f"{column}_diff_3h", f"{column}_pct_1h"]
    names += list(ratio_exprs(df.columns))
    return names + [f"{column}_ewm_{s}h" for s in S.EWM_SPANS]
