"""Line dedup by site-relative frequency: lines on a large share of a host's pages go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.store import stored

#: White space around a line does not make it another line.
EDGE = " \t\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """128 bits of a trimmed line; null for a blank one."""
    bare = F.trim(line, F.lit(EDGE))
    return F.when(
        bare != "",
        F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(bare, F.lit("line")).alias("b")),
    )


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _text_key(text: Column) -> Column:
    """128 bits of a whole text; null has bits of its own."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(text, F.lit("text")).alias("b"))


def _listed(line: Column) -> Column:
    """Whether the line is one of its host's ``__lines``."""
    return F.coalesce(F.array_contains(F.col("__lines"), line_key(line)), F.lit(False))


def _lists(found: DataFrame) -> DataFrame:
    return found.groupBy(F.col("host").alias("__host")).agg(F.collect_list("line").alias("__lines"))


def _counted(pages: DataFrame, host: Column, text: Column, copies: bool) -> DataFrame:
    """``host, line, having, pages``: the lines on more than one page, and the host's pages."""
    keys = F.array_compact(F.array_distinct(F.transform(_lines(text), line_key)))
    by_page = pages.select(host.cast("string").alias("host"), keys.alias("keys"), _text_key(text).alias("text"))
    if not copies:
        by_page = by_page.groupBy("host", "text").agg(F.first("keys").alias("keys"))
    totals = stored(by_page.groupBy("host").agg(F.count("*").alias("pages")))
    counts = (
        by_page.select("host", F.explode("keys").alias("line"))
        .groupBy("host", "line")
        .agg(F.count("*").alias("having"))
        .where(F.col("having") > 1)
    )
    return (
        counts.alias("c")
        .join(totals.alias("t"), F.col("c.host").eqNullSafe(F.col("t.host")))
        .select("c.host", "line", "having", "pages")
    )


def _among_others(pages: DataFrame, host: Column, text: Column, found: DataFrame) -> DataFrame:
    """``host, line, among``: on how many of the host's texts a found line is, not counting
    texts of which found lines make more than half of the characters."""
    joined = pages.join(_lists(found), host.cast("string").eqNullSafe(F.col("__host")))
    on = F.filter(_lines(text), _listed)
    held = joined.select(
        host.cast("string").alias("host"),
        _text_key(text).alias("text"),
        F.char_length(text).alias("whole"),
        on.alias("on"),
    ).where(2 * F.char_length(F.array_join("on", "")) <= F.col("whole"))
    return (
        held.select("host", "text", F.explode(F.transform("on", line_key)).alias("line"))
        .distinct()
        .groupBy("host", "line")
        .agg(F.count("*").alias("among"))
    )


def boilerplate_lines(
    pages: DataFrame,
    host: Column,
    text: Column,
    ratio: float = 0.1,
    min_pages: int = 20,
    copies: bool = True,
    rare: tuple[float, int] | None = None,
) -> DataFrame:
    """``host, lines``: keys of the lines on more than ``ratio`` of the host's pages.

    Hosts with fewer than ``min_pages`` pages have none, since there any line is
    frequent. A page counts once for a line however often it has it, so the
    rows that are shuffled are (host, line, pages) counts made before the
    shuffle. The result has at most (mean lines per page / ratio) keys a host.

    Without ``copies`` the rows of one text on a host are one page, so that the
    lines of a text do not pass for boilerplate because the text was copied.
    ``rare``, a lower ratio and a least number of texts, adds the lines above
    both that stand among other text: near copies share their lines too, but
    those are most of each copy, and such texts do not count for it.
    """
    counted = _counted(pages, host, text, copies)
    often = (F.col("pages") >= min_pages) & (F.col("having") > F.col("pages") * ratio)
    if rare is None:
        found = counted.where(often)
    else:
        above = lambda n: (F.col(n) >= rare[1]) & (F.col(n) > F.col("pages") * rare[0])
        open_ = stored(counted.withColumn("often", often).where(F.col("often") | above("having")))
        among = _among_others(pages, host, text, open_).alias("a")
        same = F.col("o.host").eqNullSafe(F.col("a.host")) & (F.col("o.line") == F.col("a.line"))
        found = open_.alias("o").join(among, same, "left").where(F.col("often") | above("among"))
        found = found.select("o.host", "o.line")
    return _lists(found).select(F.col("__host").alias("host"), F.col("__lines").alias("lines"))


def drop_boilerplate(
    pages: DataFrame,
    host: Column,
    text: str = "text",
    ratio: float = 0.1,
    min_pages: int = 20,
    dropped: str | None = None,
    copies: bool = True,
    rare: tuple[float, int] | None = None,
) -> DataFrame:
    """The pages with their columns, ``text`` without its host's boilerplate lines.

    The rest of the text stays as it is, blank lines too; a text that is all
    boilerplate becomes empty. Null text stays null, null hosts are one host,
    repeated rows are pages of their own (one without ``copies``) and an empty
    table stays empty. ``dropped`` names a column for the number of lines dropped.
    """
    found = stored(boilerplate_lines(pages, host, F.col(text), ratio, min_pages, copies, rare)).select(
        F.col("host").alias("__host"), F.col("lines").alias("__lines")
    )
    keep = F.filter(_lines(F.col(text)), lambda line: ~_listed(line))
    joined = pages.join(found, host.cast("string").eqNullSafe(F.col("__host")), "left")
    known = F.col("__lines").isNotNull()
    gone = F.when(known, F.size(_lines(F.col(text))) - F.size(keep)).otherwise(0)
    new = {text: F.when(known, F.array_join(keep, "\n")).otherwise(F.col(text))}
    if dropped:
        new[dropped] = F.coalesce(gone, F.lit(0)).cast("long")
    return joined.withColumns(new).drop("__host", "__lines")
