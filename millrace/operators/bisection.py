"""Topic rows on which a job fails, told from the others by halving ranges of offsets.

A job says that it failed, not on which row. Run over half of the rows it says more:
a half that fails is halved again, until single rows stand alone. Ranges are
cut by a histogram of offsets, so that halves have equally many rows, however sparse the
offsets are; the driver holds counts of offset ranges and no rows. Where very many rows fail
the caller may tell them in one pass; otherwise the halving goes on to the last of them.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import literal

#: Ranges into which a partition's offsets are counted at a time.
BUCKETS = 1024


@dataclass(frozen=True)
class OffsetRange:
    """Offsets of one partition, both ends included, and how many rows they have."""

    partition: int
    low: int
    high: int
    rows: int

    def test(self) -> str:
        return f"(partition = {self.partition} AND offset BETWEEN {self.low} AND {self.high})"


@dataclass(frozen=True)
class Failing:
    """Ranges whose rows fail, each with its error, how many rows, and the number of runs that told them.

    With ``told``, which has ``partition, offset``, only those of the ranges' rows fail.
    """

    ranges: tuple[tuple[OffsetRange, str], ...]
    runs: int
    rows: int
    told: DataFrame | None = None

    def covers(self) -> Column:
        return within(r for r, _ in self.ranges)

    def of(self, rows: DataFrame) -> DataFrame:
        """Those of the topic's rows that fail."""
        found = rows.where(self.covers())
        return found if self.told is None else _joined(found, self.told, "left_semi")

    def others(self, rows: DataFrame) -> DataFrame:
        return rows.where(~self.covers()) if self.told is None else without(rows, self.told)

    def error(self) -> Column:
        """The error of a row's range."""
        alike: dict[str, list[OffsetRange]] = {}
        for r, e in self.ranges:
            alike.setdefault(e, []).append(r)
        cases = " ".join(f"WHEN {_tests(found)} THEN {literal(e)}" for e, found in alike.items())
        return F.expr(f"CASE {cases} END") if cases else F.lit(None).cast("string")


def _joined(rows: DataFrame, told: DataFrame, how: str) -> DataFrame:
    return rows.join(told, ["partition", "offset"], how).select(*rows.columns)


def without(rows: DataFrame, told: DataFrame) -> DataFrame:
    """The topic rows that are not among those of ``told``; so are rows without an offset."""
    return _joined(rows, told, "left_anti")


def _tests(ranges: Iterable[OffsetRange]) -> str:
    """SQL that holds within the ranges, with one list for all single offsets of a partition."""
    tests: list[str] = []
    single: dict[int, list[int]] = {}
    for r in ranges:
        if r.low == r.high:
            single.setdefault(r.partition, []).append(r.low)
        else:
            tests.append(r.test())
    tests += [f"(partition = {p} AND offset IN ({', '.join(map(str, found))}))" for p, found in single.items()]
    return " OR ".join(tests)


def within(ranges: Iterable[OffsetRange]) -> Column:
    """Whether a topic row is in one of the ranges; a row without an offset is in none."""
    tests = _tests(ranges)
    return F.expr(f"coalesce({tests}, false)") if tests else F.lit(False)


def _merged(ranges: Iterable[OffsetRange]) -> list[OffsetRange]:
    """Ranges that follow each other as one; between them there are no rows."""
    found: list[OffsetRange] = []
    for r in ranges:
        if found and found[-1].partition == r.partition:
            last = found.pop()
            r = OffsetRange(r.partition, last.low, r.high, last.rows + r.rows)
        found.append(r)
    return found


def _counted(rows: DataFrame, ranges: list[OffsetRange]) -> list[OffsetRange]:
    """The ranges' rows in up to ``BUCKETS`` smaller ones of each partition; empty ones are left out."""
    starts, steps = {}, {}
    for r in ranges:
        starts[r.partition] = r.low
        steps[r.partition] = (r.high - r.low) // BUCKETS + 1
    entry = lambda found: F.create_map(*[F.lit(x) for p, n in found.items() for x in (p, n)])[F.col("partition")].cast("long")
    start, step = entry(starts), entry(steps)
    bucket = F.floor((F.col("offset") - start) / step).cast("long").alias("bucket")
    sizes = rows.where(within(ranges)).groupBy("partition", bucket).agg(
        F.count("*").alias("n"), F.min("offset").alias("low"), F.max("offset").alias("high")
    )
    found = sizes.orderBy("partition", "bucket").collect()
    return [OffsetRange(r.partition, r.low, r.high, r.n) for r in found]


def _halves(ranges: list[OffsetRange]) -> tuple[list[OffsetRange], list[OffsetRange]]:
    """The ranges cut where about half of the rows stand before."""
    total, seen = sum(r.rows for r in ranges), 0
    for i, r in enumerate(ranges[:-1]):
        seen += r.rows
        if 2 * seen >= total:
            return ranges[: i + 1], ranges[i + 1 :]
    return ranges[:-1], ranges[-1:]


def find_failing(
    rows: DataFrame,
    failure: Callable[[Column], str | None],
    most: int,
    error: str,
    rest: Callable[[Column], DataFrame | None] | None = None,
) -> Failing | None:
    """The rows of one topic on which a job fails, of which ``error`` told that there are some.

    ``failure`` runs the job over the rows that a condition chooses and gives its error, or
    None. With k rows that fail among n it runs at most ``2 k log2(n)`` times, give or take the
    steps by which n is no power of two. Ranges wait in the order of their size.

    Where more than ``most`` fail, ``rest`` is asked for the ``partition, offset`` of all rows
    that fail among those a condition chooses; these have the error of their range. Where it
    gives None, the halving goes on, range after range, until single rows stand alone. Without
    ``rest`` the ranges are not halved further and are given as they are.

    None means that no rows fail by themselves: a part of the rows that must hold the reason
    runs without an error.
    """
    whole = rows.groupBy("partition").agg(F.count("*").alias("n"), F.min("offset").alias("low"), F.max("offset").alias("high"))
    bounds = [OffsetRange(r.partition, r.low, r.high, r.n) for r in whole.orderBy("partition").collect()]
    if not bounds or any(None in (b.partition, b.low) for b in bounds):
        return None
    runs, alone, told, asked = 0, [], None, False
    # each with its error, or with None where only the other half's success tells that it fails
    waiting: deque[tuple[list[OffsetRange], str | None]] = deque([(_counted(rows, bounds), error)])

    def run(ranges: list[OffsetRange]) -> str | None:
        nonlocal runs
        runs += 1
        return failure(within(_merged(ranges)))

    while waiting:
        if not asked and len(alone) + len(waiting) > most:
            if rest is not None:
                told = rest(within([r for r, _ in alone] + [r for ranges, _ in waiting for r in _merged(ranges)]))
            if rest is None or told is not None:
                break
            asked = True
        # the range last cut goes first once all are cut to the end: so few wait at a time
        ranges, known = waiting.pop() if asked else waiting.popleft()
        if sum(r.rows for r in ranges) == 1 or len(ranges) == 1 and ranges[0].low == ranges[0].high:
            known = known or run(ranges)
            if known is None:
                return None
            alone.append((ranges[0], known))
            continue
        if len(ranges) == 1:
            ranges = _counted(rows, ranges)
        left, right = _halves(ranges)
        found = run(left)
        if found is None:
            waiting.append((right, None))
            continue
        waiting.append((left, found))
        other = run(right)
        if other is not None:
            waiting.append((right, other))
    for ranges, known in waiting:
        known = known or run(ranges)
        if known is None:
            return None
        alone += [(r, known) for r in _merged(ranges)]
    found = tuple(sorted(alone, key=lambda a: (a[0].partition, a[0].low)))
    if told is None:
        return Failing(found, runs, sum(r.rows for r, _ in found))
    fails = Failing(found, runs, 0, told)
    return replace(fails, rows=fails.of(rows).count())
