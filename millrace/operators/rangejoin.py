"""Joins of overlapping ranges without an equality key, by bins of several widths.

A range goes to bins about as wide as itself, so that it lies in two of them at most, and
to the wider bins in which longer ranges of the other side lie. Ranges that share a bin
at the width of the longer one are compared, and a pair counts only in the first bin that both have: there
is an equality key to shuffle by, no pair comes twice, and a few very long ranges do not
fill the bins of the short ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import name as quoted

#: Bins of the next level are so many times as wide.
STEP = 4
_SIDES = ("__l_", "__r_")


def _ends(side: DataFrame, bounds: tuple[str, str]) -> tuple[Column, Column]:
    for b in bounds:
        if not isinstance(side.schema[b].dataType, T.NumericType):
            raise ValueError(f"{b} is no number; give times as unix_micros")
    return tuple(F.col(quoted(b)) for b in bounds)


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_range: tuple[str, str],
    right_range: tuple[str, str],
    *,
    width: float | None = None,
) -> DataFrame:
    """All pairs of rows whose closed ranges have a point in common, with the columns of both.

    A range is two numeric columns, or one column twice for points. A range with a null or NaN end or that
    ends before it begins has no pairs; ends may be infinite. ``width`` is that of the least bins, by default the median
    length of the ranges. The sides' column names must differ.
    """
    shared = set(left.columns) & set(right.columns)
    if shared:
        raise ValueError(f"both sides have columns {sorted(shared)}")
    sides, extremes = [], []
    for frame, bounds in ((left, left_range), (right, right_range)):
        low, high = _ends(frame, bounds)
        fine = low.isNotNull() & high.isNotNull() & (low <= high) & ~F.isnan(low.cast("double")) & ~F.isnan(high.cast("double"))
        sides.append((frame.where(fine), low.cast("double"), high.cast("double")))
    for frame, low, high in sides:
        finite = lambda x: F.when(F.abs(x) < F.lit(float("inf")), x)
        length = F.percentile_approx(finite(high - low), 0.5)
        extremes.append(frame.agg(F.min(finite(low)), F.max(finite(low)), F.min(finite(high)), F.max(finite(high)), length).first())
    ends = [x for e in extremes for x in e[:4] if x is not None]
    least, most = (min(ends), max(ends)) if ends else (0.0, 0.0)
    if width is None:
        width = max([e[4] for e in extremes if e[4] is not None], default=1.0)
    # no more than 2**40 bins, so that a bin's number is exact
    width = max(float(width), (most - least) / (1 << 40)) or 1.0
    held = lambda x: F.least(F.greatest(x, F.lit(least)), F.lit(most))

    c = F.col
    binned, levels = [], []
    for (frame, low, high), p in zip(sides, _SIDES):
        length = held(high) - held(low)
        level = F.greatest(F.ceil(F.log(float(STEP), F.greatest(length / width, F.lit(1.0)))), F.lit(0)).cast("int")
        named = frame.withColumns({f"{p}low": held(low), f"{p}high": held(high), f"{p}level": level, f"{p}from": low, f"{p}to": high})
        binned.append(named)
        levels.append({r[0] for r in named.select(f"{p}level").distinct().collect()})
    found = []
    for named, p, own, other in zip(binned, _SIDES, levels, levels[::-1]):
        at = f"{p}at"
        # its own level, and all longer ones of the other side
        longer = sorted(own | other)
        reached = F.array_compact(
            F.array(*[F.when((c(f"{p}level") == x) | (c(f"{p}level") < x) & F.lit(x in other), F.lit(x)) for x in longer])
            if longer
            else F.array().cast("array<int>")
        )
        size = F.lit(width) * F.pow(F.lit(float(STEP)), F.col(at))
        first, last = (F.floor((c(f"{p}{end}") - F.lit(least)) / size).cast("long") for end in ("low", "high"))
        spread = named.withColumn(at, F.explode(reached)).withColumn(f"{p}first", first)
        found.append(spread.withColumn(f"{p}bin", F.explode(F.sequence(c(f"{p}first"), last))))
    (a, b), (l, r) = found, _SIDES
    match = (
        (c(f"{l}at") == c(f"{r}at"))
        & (c(f"{l}bin") == c(f"{r}bin"))
        & (c(f"{l}at") == F.greatest(f"{l}level", f"{r}level"))
        & (c(f"{l}bin") == F.greatest(f"{l}first", f"{r}first"))
        & (c(f"{l}from") <= c(f"{r}to"))
        & (c(f"{r}from") <= c(f"{l}to"))
    )
    return a.join(b, match).select(*[c(quoted(n)) for n in (*left.columns, *right.columns)])
