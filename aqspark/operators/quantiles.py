"""Exact interpolated quantiles that no single task has to hold, also of weighted rows.

``percentile`` keeps every distinct value of a group in one task, and ``percentile_approx`` is not
exact. Here the wanted ranks are found by radix selection: each value has a 64-bit number of the same order (sign, exponent, mantissa), and
four passes count 16 bits each of the numbers that agree with a wanted rank so far. A pass counts at most 65,536 numbers for each
prefix, combined in the tasks, however values are spread; the last one is left with equal values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

SALTS = 32
DIGIT_BITS, DIGITS = 16, 4
# exponent of a positive number: the logarithm may be off by one at powers of two
_EXPONENT = "CASE WHEN a < pow(2D, e) THEN e - 1 WHEN a >= pow(2D, e + 1) THEN e + 1 ELSE e END"
# the bits of a positive number: exponent and mantissa; below the smallest normal number the exponent stays
_BITS = """CASE WHEN a = 0D THEN 0L WHEN e < -1022 THEN CAST(a / pow(2D, -1022) * 4503599627370496D AS BIGINT)
    ELSE CAST(e + 1023 AS BIGINT) * 4503599627370496L + CAST((a / pow(2D, e) - 1D) * 4503599627370496D AS BIGINT) END"""


def _join_parameters(values: DataFrame, parameters: DataFrame, by: list[str]) -> DataFrame:
    """Rows next to the one parameter row of their column. Without groups there is one per column, which is
    broadcast. With groups both sides are salted, so the rows of a hot group meet their parameters in many tasks
    and are combined there before they are shuffled by group."""
    if not by:
        return values.join(F.broadcast(parameters), "column")
    salted = parameters.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return values.join(salted, [*by, "column", "_salt"])


def _salt(df: DataFrame, columns: list[str]) -> str:
    """A salt from what the row holds: the given columns and its times. A task that runs again after a loss
    sends each row the same way, which a running number would not."""
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))]
    return f"CAST(pmod(xxhash64({_names(dict.fromkeys([*columns, *times]))}), {SALTS}) AS INT)"


def _names(columns) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def long_values(df: DataFrame, columns: list[str], by: list[str] = (), weight: str | None = None) -> DataFrame:
    """(by, column, value) without nulls and NaN; a projection, no shuffle. With groups also ``_salt``; with ``weight`` also ``_weight``."""
    cells = ", ".join(f"struct('{c}' AS column, CAST(`{c}` AS DOUBLE) AS value)" for c in columns)
    keys = [f"`{k}`" for k in by] + ([f"CAST(`{weight}` AS BIGINT) AS _weight"] if weight else [])
    salt = [f"{_salt(df, columns)} AS _salt"] if by else []
    flat = df.selectExpr(*keys, *salt, f"inline(array({cells}))")
    return flat.where("value IS NOT NULL AND NOT isnan(value)" + (" AND _weight > 0" if weight else ""))


def ordered_bits(df: DataFrame, value: str = "value", out: str = "_bits") -> DataFrame:
    """Add a long that orders like the double ``value``; equal only for equal values (both zeros are one)."""
    kept = df.columns
    df = df.selectExpr("*", f"least(abs({value}), 1.7976931348623157E308D) AS a", f"isnan(0 * {value}) AS _infinite")
    df = df.selectExpr("*", "coalesce(floor(log2(a)), 0) AS e")
    bits = df.selectExpr(*_names_each(kept, "a", "_infinite", f"{_EXPONENT} AS e"))
    bits = bits.selectExpr(*_names_each(kept, f"if(_infinite, 1L, 0L) + {_BITS} AS _abs"))
    return bits.selectExpr(*_names_each(kept, f"if({value} < 0D, -_abs, _abs) AS `{out}`"))


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float], by: list[str] = (), weight: str | None = None) -> DataFrame:
    """(by, column, prob, value): quantiles with linear interpolation between neighbouring ranks.

    ``weight``: a column of whole numbers; a row stands for that many equal rows, and for none if it is not positive.
    """
    key = [*by, "column"]
    key_names = _names(key)
    values = ordered_bits(long_values(df, columns, by, weight))
    rows = "_weight" if weight else "1L"
    first = values.groupBy(*key, F.expr(f"shiftright(_bits, {64 - DIGIT_BITS}) AS prefix")).agg(F.expr(f"sum({rows}) AS m"))
    first = first.selectExpr("*", f"sum(m) OVER (PARTITION BY {key_names}) AS n", f"sum(m) OVER (PARTITION BY {key_names} ORDER BY prefix) - m AS below")
    # the wanted ranks are floor(rank) and ceil(rank), 0-based
    ends = ", ".join(
        f"struct({float(q)!r}D AS prob, {end} AS upper, CAST({f}({float(q)!r}D * (n - 1)) AS BIGINT) AS rest, {float(q)!r}D * (n - 1) AS rank)"
        for q in probs for end, f in ((0, "floor"), (1, "ceil"))
    )
    found = _placed(first.selectExpr("*", f"array({ends}) AS slots"), key)
    for digit in range(1, DIGITS):
        shift = 64 - DIGIT_BITS * (digit + 1)
        slots = found.groupBy(*key, "prefix").agg(F.collect_list(F.struct("prob", "upper", "rest", "rank")).alias("slots"))
        wanted = slots.groupBy(*key).agg(F.collect_list(F.struct("prefix", "slots")).alias("prefixes"))
        kept = _join_parameters(values, wanted, list(by)).selectExpr(
            *_names_each(key, "value", "_bits", f"{rows} AS w", f"inline(filter(prefixes, p -> p.prefix = shiftright(_bits, {shift + DIGIT_BITS})))")
        )
        counted = kept.groupBy(*key, "prefix", F.expr(f"shiftright(_bits, {shift}) AS longer")).agg(
            F.expr("sum(w) AS m"), F.expr("first(slots) AS slots"), F.expr("max(value) AS value")
        )
        below = f"sum(m) OVER (PARTITION BY {key_names}, prefix ORDER BY longer) - m AS below"
        found = _placed(counted.selectExpr(*_names_each(key, "longer AS prefix", "m", "slots", "value", below)), key, "value")
    ends_of = [F.expr(f"max(if(upper = {u}, value, NULL)) AS {name}") for u, name in ((0, "a"), (1, "b"))]
    both = found.groupBy(*key, "prob").agg(*ends_of, F.expr("first(rank - floor(rank)) AS part"))
    return both.selectExpr(*_names_each(key, "prob", "a + (b - a) * part AS value"))


def _placed(counted: DataFrame, key: list[str], *more: str) -> DataFrame:
    """The ranks that fall on each counted number, relative to it."""
    hit = "inline(filter(slots, s -> s.rest >= below AND s.rest < below + m))"
    hits = counted.selectExpr(*_names_each(key, "prefix", "below", *more, hit))
    return hits.selectExpr(*_names_each(key, "prefix", "prob", "upper", "rest - below AS rest", "rank", *more))


def _names_each(columns, *more: str) -> list[str]:
    return [*[f"`{c}`" for c in columns], *more]


def pick(columns: dict[str, tuple[str, float]]) -> list[Column]:
    """Aggregates that spread (column, prob, value) rows into columns: output name -> (column, prob)."""
    return [
        F.expr(f"max(if(column = '{c}' AND prob = {float(p)!r}D, value, NULL)) AS `{name}`") for name, (c, p) in columns.items()
    ]


def quantiles_wide(df: DataFrame, names: dict[str, tuple[str, float]], by: list[str] = ()) -> DataFrame:
    """One row per group with a column per entry of ``names``: output name -> (column, prob)."""
    columns = sorted({c for c, _ in names.values()})
    probs = sorted({p for _, p in names.values()})
    return exact_quantiles(df, columns, probs, by).groupBy(*by).agg(*pick(names))


def with_parameters(df: DataFrame, parameters: DataFrame, by: list[str] = ()) -> tuple[DataFrame, Column]:
    """Bring fitted parameters next to the rows: a scalar subquery when there is one row for all, else a
    left join on the group, salted so that a hot group is spread over tasks."""
    fitted = [c for c in parameters.columns if c not in by]
    packed = F.struct(*fitted).alias("_fit")
    if not by:
        return df, parameters.select(packed).scalar()
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = parameters.select(*by, packed, salts.alias("_salt"))
    return df.withColumn("_salt", F.expr(_salt(df, df.columns))).join(salted, [*by, "_salt"], "left"), F.col("_fit")
