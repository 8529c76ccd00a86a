"""Window functions over partitions of any size, none of which has to fit one task.

Spark sorts a window's partition in one task. Here the rows are dealt out by ranges of
partition and order, so that a busy partition spans several blocks. Spark's own functions
run inside blocks; what they lack is carried over from the blocks before and after:

* ranks add the rows and peer groups of earlier blocks, and a group of peers that a
  border cuts keeps the rank of its beginning and the share of its end;
* with row numbers known, offsets and ROWS frames run in tiles of consecutive rows that
  also see the rows their frames reach into; open ends get running states of whole tiles;
* RANGE frames run over one row per partition and order value, in tiles for peers and in
  bins of the frame's width for distances.

Only partitions that span blocks or tiles have anything carried, so carried tables have
about as many rows as there are blocks or tiles.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import name as quoted
from millrace.sources.paths import written

RANKS = ("row_number", "rank", "dense_rank", "percent_rank", "cume_dist", "ntile")
OFFSETS = ("lag", "lead")
FRAMED = ("sum", "count", "min", "max", "avg", "first_value", "last_value")
_OWN = "__w_"
_FAR = 1 << 62


@dataclass(frozen=True)
class By:
    """One column of an order; nulls stand first where it ascends, and last where it descends."""

    column: str
    descending: bool = False
    nulls_last: bool | None = None

    @property
    def ends_in_nulls(self) -> bool:
        return self.descending if self.nulls_last is None else self.nulls_last

    def sort(self) -> Column:
        way = ("desc" if self.descending else "asc") + ("_nulls_last" if self.ends_in_nulls else "_nulls_first")
        return getattr(_col(self.column), way)()


@dataclass(frozen=True)
class Frame:
    """From ``low`` to ``high`` rows, or distances in the order's value, after the current row.

    Numbers before the row are negative, None is an open end. With ``rows`` off, 0 stands for
    the row's peers, as in SQL's CURRENT ROW.
    """

    low: float | None = None
    high: float | None = 0
    rows: bool = False


@dataclass(frozen=True)
class Call:
    """A window function over a column; ``count`` without one counts rows.

    ``offset`` is that of lag and lead, and the number of ntile's buckets. Averages are doubles.
    """

    function: str
    column: str | None = None
    offset: int = 1
    default: object = None
    frame: Frame = Frame()

    def __post_init__(self):
        if self.function not in (*RANKS, *OFFSETS, *FRAMED):
            raise ValueError(f"no window function {self.function!r}")
        if self.column is None and self.function not in (*RANKS, "count"):
            raise ValueError(f"{self.function} needs a column")
        if self.function == "ntile" and self.offset < 1:
            raise ValueError("ntile needs a positive number of buckets")
        low, high = self.frame.low, self.frame.high
        if self.function in FRAMED and low is not None and high is not None and low > high:
            raise ValueError(f"the frame of {self.function} ends before it begins")


def _col(column: str) -> Column:
    return F.col(quoted(column))


def _own(column: str) -> str:
    return _OWN + column


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """A join on columns of one name, where nulls are equal; the left's are kept."""
    there = {k: f"{_OWN}there{i}" for i, k in enumerate(keys)}
    other = right.withColumnsRenamed(there)
    match = [_col(k).eqNullSafe(F.col(there[k])) for k in keys]
    return left.join(other, match, how).drop(*there.values())


# --- row numbers and ranks ------------------------------------------------------------


def _spanning(dealt: DataFrame, keys: list[str]) -> DataFrame:
    """The partitions that are in more than one block; only a block's first and last can be."""
    key = F.struct(*[_col(k) for k in keys])
    ends = dealt.groupBy(_own("block")).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    each = ends.select(_own("block"), F.explode(F.array("low", "high")).alias("key")).distinct()
    several = each.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return written(several.select(*[F.col("key").getField(k).alias(k) for k in keys]))


def _in_blocks(dealt: DataFrame, keys: list[str], order: list[By]) -> DataFrame:
    """Row numbers, ranks and peers' ends inside blocks."""
    inside = Window.partitionBy(*map(_col, keys), _own("block"))
    peers = inside.orderBy(*[o.sort() for o in order])
    rows = inside.orderBy(*[o.sort() for o in order], _own("tie"))
    return dealt.withColumns(
        {
            _own("rn"): F.row_number().over(rows).cast("long"),
            _own("rank"): F.rank().over(peers).cast("long"),
            _own("dense"): F.dense_rank().over(peers).cast("long"),
            _own("upto"): F.count("*").over(peers),
            _own("here"): F.count("*").over(inside),
        }
    )


def _carried(dealt: DataFrame, keys: list[str], order: list[By]) -> DataFrame:
    """One row per block of each partition that has several: what stands before it and after it."""
    wide = _joined(dealt, _spanning(dealt, keys), keys, "left_semi")
    value = F.struct(*[_col(o.column).alias(f"o{i}") for i, o in enumerate(order)])
    at = F.col(_own("rn"))
    blocks = _in_blocks(wide, keys, order).groupBy(*map(_col, keys), _own("block")).agg(
        F.count("*").alias("n"),
        F.max(_own("dense")).alias("groups"),
        F.max(_own("rank")).alias("last_rank"),
        F.count_if(F.col(_own("dense")) == 1).alias("first_peers"),
        F.min_by(value, at).alias("first"),
        F.max_by(value, at).alias("last"),
    )
    order_of = Window.partitionBy(*map(_col, keys)).orderBy(_own("block"))
    every = order_of.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = order_of.rowsBetween(Window.unboundedPreceding, -1)
    upto = order_of.rowsBetween(Window.unboundedPreceding, 0)
    later = order_of.rowsBetween(1, Window.unboundedFollowing)
    joins = lambda a, b, other: F.coalesce(a.eqNullSafe(b) & other.isNotNull(), F.lit(False))
    near = blocks.withColumns(
        {
            "before": F.coalesce(F.sum("n").over(earlier), F.lit(0)),
            "total": F.sum("n").over(every),
            "continued": joins(F.col("first"), F.lag("last").over(order_of), F.lag("n").over(order_of)),
            "goes_on": joins(F.col("last"), F.lead("first").over(order_of), F.lead("n").over(order_of)),
        }
    )
    several = F.col("groups") > 1
    near = near.withColumns(
        {
            "begins": F.when(several | ~F.col("continued"), F.col("before") + F.col("last_rank")),
            "ends": F.when(several | ~F.col("goes_on"), F.col("before") + F.col("first_peers")),
        }
    )
    groups = F.coalesce(F.sum("groups").over(earlier), F.lit(0)) - F.sum(F.col("continued").cast("long")).over(upto)
    found = near.select(
        *map(_col, keys),
        _own("block"),
        "before",
        "total",
        "last_rank",
        groups.alias("groups_before"),
        F.when(F.col("continued"), F.last("begins", ignorenulls=True).over(earlier)).alias("begun"),
        F.when(F.col("goes_on"), F.first("ends", ignorenulls=True).over(later)).alias("ending"),
    )
    renamed = ("before", "total", "last_rank", "groups_before", "begun", "ending")
    return written(found.withColumnsRenamed({c: _own(c) for c in renamed}))


def _numbered(rows: DataFrame, keys: list[str], order: list[By], calls: Mapping[str, Call], blocks: int | None) -> DataFrame:
    """The rows with their number and their partition's size, and the ranks that are asked for."""
    sort = [*[_col(k).asc_nulls_first() for k in keys], *[o.sort() for o in order], F.col(_own("tie"))]
    marked = rows.withColumn(_own("tie"), F.monotonically_increasing_id())
    ranged = marked.repartitionByRange(blocks, *sort) if blocks else marked.repartitionByRange(*sort)
    dealt = written(ranged.withColumn(_own("block"), F.spark_partition_id()))
    placed = _joined(_in_blocks(dealt, keys, order), _carried(dealt, keys, order), [*keys, _own("block")], "left")

    inside = Window.partitionBy(*map(_col, keys), _own("block"))
    peers = inside.orderBy(*[o.sort() for o in order])
    by_row = inside.orderBy(*[o.sort() for o in order], _own("tie"))
    c = lambda n: F.col(_own(n))
    alone, before = c("total").isNull(), F.coalesce(c("before"), F.lit(0))
    number = before + c("rn")
    size = F.coalesce(c("total"), c("here"))
    rank = F.when(c("begun").isNotNull() & (c("rank") == 1), c("begun")).otherwise(before + c("rank"))
    end = F.when(c("ending").isNotNull() & (c("rank") == c("last_rank")), c("ending")).otherwise(before + c("upto"))

    def tile(k: int) -> Column:
        larger, least = size % k, F.floor(size / k).cast("long")
        inner = F.floor((number - 1) / (least + 1)).cast("long")
        outer = larger + F.floor((number - 1 - larger * (least + 1)) / F.greatest(least, F.lit(1))).cast("long")
        spread = F.when(number <= larger * (least + 1), inner).otherwise(outer) + 1
        return F.when(alone, F.ntile(k).over(by_row).cast("long")).otherwise(spread)

    made: dict[str, Callable[[Call], Column]] = {
        "row_number": lambda _: number,
        "rank": lambda _: rank,
        "dense_rank": lambda _: F.coalesce(c("groups_before"), F.lit(0)) + c("dense"),
        "percent_rank": lambda _: F.when(alone, F.percent_rank().over(peers)).otherwise((rank - 1) / (size - 1)),
        "cume_dist": lambda _: F.when(alone, F.cume_dist().over(peers)).otherwise(end / size),
        "ntile": lambda call: tile(call.offset),
    }
    ranks = {n: made[call.function](call) for n, call in calls.items() if call.function in RANKS}
    return placed.select(
        *map(_col, rows.columns), *[v.alias(n) for n, v in ranks.items()], number.alias(_own("at")), size.alias(_own("size"))
    )


# --- frames ---------------------------------------------------------------------------


@dataclass(frozen=True)
class _Part:
    """A function as sums that can be merged: of a row, of several, of two, and what they stand for."""

    of: Column
    merge: Callable[[Column], Column]
    both: Callable[[Column, Column], Column]
    shown: Callable[[Column], Column]


def _added(a: Column, b: Column) -> Column:
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)


def _part(call: Call) -> _Part:
    value = None if call.column is None else _col(call.column)
    if call.function == "count":
        one = F.lit(1) if value is None else value.isNotNull().cast("long")
        return _Part(one.cast("long"), F.sum, _added, lambda v: F.coalesce(v, F.lit(0).cast("long")))
    if call.function == "sum":
        return _Part(value, F.sum, _added, lambda v: v)
    if call.function in ("min", "max"):
        merge, both = (F.min, F.least) if call.function == "min" else (F.max, F.greatest)
        return _Part(value, merge, both, lambda v: v)
    merge, both = (F.min, F.least) if call.function == "first_value" else (F.max, F.greatest)
    return _Part(F.struct(F.col(_own("at")).alias("at"), value.alias("v")), merge, both, lambda v: v.getField("v"))


def _open_ends(call: Call) -> tuple[bool, bool]:
    """Whether states from before the tile, and from behind it, belong to the result."""
    before = call.frame.low is None and call.function != "last_value"
    after = call.frame.high is None and call.function != "first_value"
    return before, after


def _native(call: Call, w) -> Column:
    value = F.lit(1) if call.column is None else _col(call.column)
    return getattr(F, call.function)(value).over(w)


def _between(call: Call, keys: list[str], cell: str) -> WindowSpec:
    low, high = call.frame.low, call.frame.high
    low = Window.unboundedPreceding if low is None else int(low)
    high = Window.unboundedFollowing if high is None else int(high)
    return Window.partitionBy(*map(_col, keys), cell).orderBy(_own("at")).rowsBetween(low, high)


def _shifted(call: Call) -> tuple[Call, Call] | None:
    """An open frame that ends before the row, or begins behind it, as a running one and an offset."""
    low, high = call.frame.low, call.frame.high
    if call.function not in FRAMED:
        return None
    none = 0 if call.function == "count" else None
    if low is None and high is not None and high < 0:
        return replace(call, frame=Frame(None, 0, True)), Call("lag", "", int(-high), none)
    if high is None and low is not None and low > 0:
        return replace(call, frame=Frame(0, None, True)), Call("lead", "", int(low), none)
    return None


def _with_rows_frames(rows: DataFrame, keys: list[str], calls: Mapping[str, Call], size: int) -> DataFrame:
    """Offsets and ROWS frames, in tiles of ``size`` rows or of the longest reach."""
    first, then = {}, {}
    for name, call in calls.items():
        steps = _shifted(call)
        if steps:
            first[_own(f"run_{name}")], then[name] = steps[0], replace(steps[1], column=_own(f"run_{name}"))
        else:
            first[name] = call
    made = _tiled(rows, keys, first, size) if first else rows
    return _tiled(written(made), keys, then, size).drop(*[c.column for c in then.values()]) if then else made


def _reach(call: Call) -> tuple[int, int]:
    """How many rows before and behind a tile its frames see."""
    if call.function in OFFSETS:
        back = call.offset if call.function == "lag" else -call.offset
        return max(back, 0), max(-back, 0)
    low, high = call.frame.low, call.frame.high
    return max(0, -int(low or 0)), max(0, int(high or 0))


def _tiled(rows: DataFrame, keys: list[str], calls: Mapping[str, Call], size: int) -> DataFrame:
    back, ahead = (max(r) for r in zip(*map(_reach, calls.values())))
    size = max(size, back, ahead, 1)
    at, tile, cell = F.col(_own("at")) - 1, _own("tile"), _own("cell")
    number = F.floor(at / size).cast("long")
    last = F.floor((F.col(_own("size")) - 1) / size).cast("long")
    copies = [F.col(tile)]
    if back:
        copies.append(F.when((at % size >= size - back) & (F.col(tile) < last), F.col(tile) + 1))
    if ahead:
        copies.append(F.when((at % size < ahead) & (F.col(tile) > 0), F.col(tile) - 1))
    placed = rows.withColumn(tile, number)
    spread = placed.withColumn(cell, F.explode(F.array_compact(F.array(*copies))))

    kinds = dict(rows.dtypes)
    inside = Window.partitionBy(*map(_col, keys), cell).orderBy(_own("at"))
    not_before, not_behind = F.col(_own("at")) > F.col(cell) * size, F.col(_own("at")) <= (F.col(cell) + 1) * size
    found, merged = {}, {}
    for name, call in calls.items():
        if call.function in OFFSETS:
            lag = getattr(F, call.function)(_col(call.column), call.offset)
            beyond = getattr(F, call.function)(F.lit(True), call.offset).over(inside)
            default = F.lit(call.default).cast(kinds[call.column])
            found[name] = F.coalesce(lag.over(inside), F.when(beyond.isNull(), default))
            continue
        before, after = _open_ends(call)
        if not (before or after):
            found[name] = _native(call, _between(call, keys, cell))
            continue
        part = _part(call)
        seen = F.lit(True) & (not_before if before else F.lit(True)) & (not_behind if after else F.lit(True))
        found[name] = part.merge(F.when(seen, part.of)).over(_between(call, keys, cell))
        merged[name] = (part, before, after)
    here = spread.withColumns(found).where(F.col(cell) == F.col(tile)).drop(cell)
    if merged:
        here = _with_states(here, placed, keys, merged, size)
    return here.drop(tile)


def _with_states(here: DataFrame, placed: DataFrame, keys: list[str], merged: Mapping, size: int) -> DataFrame:
    """The results inside tiles, merged with the states of all tiles before and after."""
    tile = _own("tile")
    several = placed.where(F.col(_own("size")) > size)
    sums = several.groupBy(*map(_col, keys), tile).agg(*[p.merge(p.of).alias(f"{_OWN}s{i}") for i, (p, _, _) in enumerate(merged.values())])
    order = Window.partitionBy(*map(_col, keys)).orderBy(tile)
    earlier, later = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    states = {}
    for i, (part, before, after) in enumerate(merged.values()):
        for side, wanted, over in (("b", before, earlier), ("a", after, later)):
            if wanted:
                states[f"{_OWN}{side}{i}"] = part.merge(F.col(f"{_OWN}s{i}")).over(over)
    carried = written(sums.select(*map(_col, keys), tile, *[v.alias(n) for n, v in states.items()]))
    joined = _joined(here, carried, [*keys, tile], "left")
    whole = {}
    for i, (name, (part, before, after)) in enumerate(merged.items()):
        value = _col(name)
        for side, wanted in (("b", before), ("a", after)):
            if wanted:
                value = part.both(F.col(f"{_OWN}{side}{i}"), value) if side == "b" else part.both(value, F.col(f"{_OWN}{side}{i}"))
        whole[name] = part.shown(value)
    return joined.withColumns(whole).drop(*states)


# --- RANGE frames ---------------------------------------------------------------------


def _with_range_frames(
    rows: DataFrame, keys: list[str], order: list[By], calls: Mapping[str, Call], size: int, blocks: int | None
) -> DataFrame:
    """RANGE frames over one row per partition and order value, which is where peers meet."""
    place = list(dict.fromkeys([*keys, *[o.column for o in order]]))
    parts = {n: _part(call) for n, call in calls.items()}
    held = {n: f"{_OWN}p{i}" for i, n in enumerate(calls)}
    peers = rows.groupBy(*map(_col, place)).agg(*[p.merge(p.of).alias(held[n]) for n, p in parts.items()])
    merges = {F.sum: "sum", F.min: "min", F.max: "max"}
    moved = {n: Call(merges[parts[n].merge], held[n], frame=replace(call.frame, rows=True)) for n, call in calls.items()}
    near = {n: c for n, c in moved.items() if {calls[n].frame.low, calls[n].frame.high} <= {None, 0}}
    found = peers
    if near:
        numbered = written(_numbered(found, keys, order, {}, blocks))
        found = _with_rows_frames(numbered, keys, near, size).drop(_own("at"), _own("size"))
    if len(near) < len(moved):
        far = {n: c for n, c in moved.items() if n not in near}
        found = _binned(written(found), keys, order, {n: (calls[n].frame, parts[n], held[n]) for n in far})
    kept = found.select(*map(_col, place), *[parts[n].shown(_col(n)).alias(n) for n in calls])
    return _joined(rows, kept, place, "inner")


def _binned(peers: DataFrame, keys: list[str], order: list[By], calls: Mapping[str, tuple[Frame, _Part, str]]) -> DataFrame:
    """Frames of distances, in bins as wide as the longest; a task sees a bin and those beside it."""
    if len(order) != 1 or not isinstance(peers.schema[order[0].column].dataType, T.NumericType):
        raise ValueError("a RANGE frame with distances needs one numeric column to order by")
    by = order[0]
    whole = isinstance(peers.schema[by.column].dataType, T.IntegralType)
    bounds = [b for f, _, _ in calls.values() for b in (f.low, f.high) if b is not None]
    if whole and any(b != int(b) for b in bounds):
        raise ValueError("the distances of a whole-number order are whole numbers")
    width = 2 * max(abs(b) for b in bounds)  # twice, so that rounding moves no row beyond the next bin
    sign, kind = (-1 if by.descending else 1), ("long" if whole else "double")
    bin_, cell, v = _own("bin"), _own("cell"), _own("v")
    value = _col(by.column).cast(kind) * F.lit(sign)
    nulls = F.lit(_FAR if by.ends_in_nulls else -_FAR)
    if whole:
        own = F.expr(f"({quoted(v)} - pmod({quoted(v)}, {int(width)}L)) div {int(width)}L")
    else:
        own = (
            F.when(F.isnan(v), F.lit(sign * (_FAR - 2)))
            .when(F.abs(F.col(v)) == F.lit(float("inf")), F.when(F.col(v) > 0, _FAR - 4).otherwise(-_FAR + 4))
            .otherwise(F.floor(F.col(v) / F.lit(float(width))).cast("long"))
        )
    placed = peers.withColumn(v, value)
    placed = placed.withColumn(bin_, F.when(F.col(v).isNull(), nulls).otherwise(own))
    regular = F.abs(F.col(bin_)) < _FAR - 8
    copies = [F.col(bin_)]
    if any((b or 0) < 0 for f, _, _ in calls.values() for b in (f.low, f.high)):
        copies.append(F.when(regular, F.col(bin_) + 1))
    if any((b or 0) > 0 for f, _, _ in calls.values() for b in (f.low, f.high)):
        copies.append(F.when(regular, F.col(bin_) - 1))
    spread = placed.withColumn(cell, F.explode(F.array_compact(F.array(*copies))))

    partition = ", ".join(quoted(k) for k in [*keys, cell])
    found, merged = {}, {}
    text = {F.sum: "sum", F.min: "min", F.max: "max"}
    for name, (frame, part, held) in calls.items():
        low = "UNBOUNDED PRECEDING" if frame.low is None else _bound(frame.low, whole)
        high = "UNBOUNDED FOLLOWING" if frame.high is None else _bound(frame.high, whole)
        # open ends begin with the bins that the row's own bin does not see
        start = f"{bin_} >= {cell}" if frame.high is None or frame.high >= 0 else f"{bin_} >= {cell} - 1"
        stop = f"{bin_} <= {cell}" if frame.low is None or frame.low <= 0 else f"{bin_} <= {cell} + 1"
        seen = " AND ".join([*([start] if frame.low is None else []), *([stop] if frame.high is None else [])]) or "true"
        found[name] = F.expr(
            f"{text[part.merge]}(CASE WHEN {seen} THEN {quoted(held)} END)"
            f" OVER (PARTITION BY {partition} ORDER BY {quoted(v)} {'NULLS LAST' if by.ends_in_nulls else 'NULLS FIRST'}"
            f" RANGE BETWEEN {low} AND {high})"
        )
        skip_before = 1 if frame.low is None and frame.high is not None and frame.high < 0 else 0
        skip_after = 1 if frame.high is None and frame.low is not None and frame.low > 0 else 0
        if frame.low is None or frame.high is None:
            merged[name] = (part, held, skip_before if frame.low is None else None, skip_after if frame.high is None else None)
    here = spread.withColumns(found).where(F.col(cell) == F.col(bin_)).drop(cell)
    for name, (part, held, before, after) in merged.items():
        here = _with_bin_states(here, placed, keys, name, part, held, before, after)
    return here.drop(bin_, v)


def _bound(distance: float, whole: bool) -> str:
    if distance == 0:
        return "CURRENT ROW"
    size = f"{int(abs(distance))}L" if whole else f"{float(abs(distance))!r}D"
    return f"{size} {'PRECEDING' if distance < 0 else 'FOLLOWING'}"


def _with_bin_states(here, placed, keys, name, part: _Part, held: str, before: int | None, after: int | None) -> DataFrame:
    """One open frame's results merged with the states of the bins before and behind those it saw.

    A bin beside the row's own one that the frame saw may be missing, so states go by the
    bin's number: of bins below it, less ``before``, and above it, plus ``after``.
    """
    bin_ = _own("bin")
    sums = placed.groupBy(*map(_col, keys), bin_).agg(part.merge(_col(held)).alias(_own("s")))
    order = Window.partitionBy(*map(_col, keys)).orderBy(bin_)
    sides = {}
    if before is not None:
        sides[_own("sb")] = part.merge(F.col(_own("s"))).over(order.rangeBetween(Window.unboundedPreceding, -1 - before))
    if after is not None:
        sides[_own("sa")] = part.merge(F.col(_own("s"))).over(order.rangeBetween(1 + after, Window.unboundedFollowing))
    carried = sums.select(*map(_col, keys), bin_, *[v.alias(n) for n, v in sides.items()])
    joined = _joined(here, carried, [*keys, bin_], "left")
    value = _col(name)
    for side in sides:
        value = part.both(F.col(side), value)
    return joined.withColumn(name, value).drop(*sides)


# --- the operator ---------------------------------------------------------------------


def blocked_windows(
    rows: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str | By],
    calls: Mapping[str, Call],
    *,
    block_rows: int = 8192,
    blocks: int | None = None,
) -> DataFrame:
    """The rows with one column for each call, equal to Spark's own window functions.

    Row numbers, ranks and buckets are longs. Where the order has ties, row numbers, offsets
    and ROWS frames take them in some order, the same for all calls. Without ``partition_by`` all rows are
    one partition. A tile has ``block_rows`` rows or as many as the longest ROWS frame
    reaches; a RANGE frame's own order values have to fit one task. ``blocks`` is the number of ranges
    in which rows are first dealt out; Spark's shuffle settings decide without it.
    Intermediate tables are written to the shared folder.
    """
    taken = [c for c in [*rows.columns, *calls] if c.startswith(_OWN)]
    twice = [c for c in calls if c in rows.columns]
    if taken or twice:
        raise ValueError(f"column names {sorted({*taken, *twice})} are taken")
    order = [By(o) if isinstance(o, str) else o for o in order_by]
    work, keys = rows, list(partition_by)
    if not keys:
        work, keys = rows.withColumn(_own("all"), F.lit(0)), [_own("all")]

    asked: dict[str, Call] = {}
    averages = {n: c for n, c in calls.items() if c.function == "avg"}
    for name, call in calls.items():
        if name in averages:
            work = work.withColumn(_own(f"avg_{name}"), _col(call.column).cast("double"))
            asked[_own(f"sum_{name}")] = replace(call, function="sum", column=_own(f"avg_{name}"))
            asked[_own(f"n_{name}")] = replace(call, function="count")
        else:
            asked[name] = call
    in_rows = {n: c for n, c in asked.items() if c.function in OFFSETS or c.function in FRAMED and c.frame.rows}
    in_ranges = {n: c for n, c in asked.items() if c.function in FRAMED and not c.frame.rows}

    made = _numbered(work, keys, order, asked, blocks)
    if in_rows or in_ranges:
        made = written(made)
    if in_rows:
        made = _with_rows_frames(made, keys, in_rows, block_rows)
    if in_ranges:
        made = _with_range_frames(made, keys, order, in_ranges, block_rows, blocks)
    shown = {n: F.try_divide(F.col(quoted(_own(f"sum_{n}"))), F.col(quoted(_own(f"n_{n}")))) for n in averages}
    return made.select(*map(_col, rows.columns), *[shown.get(n, _col(n)).alias(n) for n in calls])
