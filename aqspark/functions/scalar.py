"""Column expressions: index conversion, categories, alerts, ratios, rounding, names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from aqspark import spec as S


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_nan(c: str | Column) -> Column:
    """NaN to null: Spark aggregates skip nulls but not NaN."""
    return F.when(~F.isnan(col(c)), col(c))


def null_if_not_finite(c: str | Column) -> Column:
    return F.when(~F.isnan(col(c)) & (F.abs(col(c)) != float("inf")), col(c))


def clip(c: str | Column, low, high) -> Column:
    """Clip, keeping nulls (``greatest`` and ``least`` alone would skip them)."""
    c = col(c)
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.when(c.isNotNull(), F.least(F.greatest(c, low), high))


def owm_to_epa(owm_aqi: str | Column, pm2_5: str | Column, mode: str = "strict") -> Column:
    """PM2.5 concentration to index, one decimal, half up; the coarse 1-5 scale is the fallback.

    ``strict`` sends concentrations between two breakpoints rows to the fallback;
    ``contiguous`` truncates to one decimal first, so that no gap is left.
    """
    pm = F.coalesce(col(pm2_5).cast("double"), F.lit(0.0))
    if mode == "contiguous":
        pm = F.floor(pm * 10) / F.lit(10.0)
    elif mode != "strict":
        raise ValueError(f"unknown mode {mode!r}")
    coarse = reduce(
        lambda acc, kv: F.when(col(owm_aqi) == kv[0], F.lit(kv[1])).otherwise(acc),
        S.COARSE_AQI.items(),
        F.lit(S.COARSE_AQI_DEFAULT),
    )
    out = coarse
    for c_lo, c_hi, i_lo, i_hi in S.PM25_BREAKPOINTS:
        slope = (i_hi - i_lo) / (c_hi - c_lo)
        value = F.round(F.lit(slope) * (pm - c_lo) + F.lit(float(i_lo)), 1)
        out = F.when(pm.between(c_lo, c_hi), value).otherwise(out)
    return out


def aqi_category(aqi: str | Column, mode: str = "strict") -> Column:
    """Struct (label, color, emoji). ``strict`` buckets are closed whole-number ranges, so 50.5 and
    everything out of range is the last category; ``contiguous`` closes the gaps from above."""
    if mode not in ("strict", "contiguous"):
        raise ValueError(f"unknown mode {mode!r}")
    a = col(aqi)

    def entry(row):
        return F.struct(F.lit(row[2]).alias("label"), F.lit(row[3]).alias("color"), F.lit(row[4]).alias("emoji"))

    branches = F.when(a.isNull(), F.lit(None))
    floor_ = S.CATEGORIES[0][0]
    for row in S.CATEGORIES:
        inside = a.between(row[0], row[1]) if mode == "strict" else (a >= floor_) & (a <= row[1])
        branches = branches.when(inside, entry(row))
        floor_ = row[1]
    return branches.otherwise(entry(S.CATEGORIES[-1]))


def category_class(aqi: str | Column) -> Column:
    """Short class name by contiguous upper bounds."""
    a = col(aqi)
    # Fixed values
    return (
        F.when(a.isNull(), F.lit(None).cast("string"))
        .when(a <= 50, "bg-good")
        .when(a <= 100, "bg-moderate")
        .when(a <= 150, "bg-sensitive")
        .when(a <= 200, "bg-unhealthy")
        .when(a <= 300, "bg-very")
        .otherwise("bg-haz")
    )


def alert_flag(aqi: str | Column, threshold: float = S.ALERT_THRESHOLD) -> Column:
    return col(aqi) > threshold


def alert_level(aqi: str | Column) -> Column:
    a = col(aqi)
    return F.when(a > S.DANGER_THRESHOLD, "danger").when(a > S.ALERT_THRESHOLD, "warning").otherwise("none")


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """``a / b`` where a zero or missing ``b`` counts as 1."""
    b = col(denominator).cast("double")
    return col(numerator).cast("double") / F.coalesce(F.nullif(b, F.lit(0.0)), F.lit(1.0))


def match_name(c: str | Column, wanted: str, rule: str = "exact") -> Column:
    """``exact``, ``ignore_case``, or ``title`` (the wanted name trimmed and title-cased first)."""
    if rule == "exact":
        return col(c) == wanted
    if rule == "ignore_case":
        return F.lower(col(c)) == F.lower(F.lit(wanted))
    if rule == "title":
        return col(c) == title_case(F.trim(F.lit(wanted)))
    raise ValueError(f"unknown rule {rule!r}")


def title_case(c: str | Column) -> Column:
    """Upper-case the first letter of every run of letters, as in ``3D`` (``initcap`` looks at spaces only)."""
    runs = F.regexp_extract_all(col(c), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    capital = F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substr(r, F.lit(2)))))
    return F.array_join(capital, "")


def display_name(c: str | Column) -> Column:
    return title_case(F.replace(col(c), F.lit("_"), F.lit(" ")))


def slug(c: str | Column) -> Column:
    return F.replace(F.lower(col(c)), F.lit(" "), F.lit("_"))


def forecast_date(as_of: str | Column, day: str | Column) -> Column:
    return F.date_format(F.date_add(col(as_of).cast("date"), col(day).cast("int")), "yyyy-MM-dd")


def report(c: str | Column, kind: str) -> Column:
    """Round for a report: index values to 1 decimal, concentrations to 2, metrics to 4 (half up)."""
    return F.round(col(c), {"aqi": 1, "pollutant": 2, "metric": 4}[kind])


def is_fresh(fetched_at: str | Column, as_of: str | Column, ttl_seconds: int = S.CACHE_TTL_SECONDS) -> Column:
    """The bare column is compared, so the filter reaches the scan."""
    return col(fetched_at) > col(as_of) - F.make_dt_interval(secs=F.lit(ttl_seconds))
