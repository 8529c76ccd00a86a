"""Quality rules whose cutoffs carry a guarantee: few good documents are rejected, in every stratum.

Labelled texts are the holdout, each distinct one once, as copies are no trials of their own.
A policy is a set of cutoffs. Policies are tested along fixed paths, each from nothing
rejected on: a rule's cutoffs from lax to strict, then the next rule's on top of them. A
path begins with each rule in turn. For a policy that rejects k of a stratum's n good texts
the exact binomial (Clopper-Pearson) upper bound of its rejection rate is below ``risk`` at a
level exactly if P(X <= k) for X ~ Bin(n, risk) is at most that level. Along a path every
policy up to the first that fails its test is certified at ``delta / (strata * paths)``
(fixed-sequence testing), and Bonferroni over strata and paths gives: with
probability 1 - delta, in no stratum more than ``risk`` of the good documents
are rejected by the policy chosen among all that are certified. Only DataFrame
functions are used.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.store import stored

SPACE = r"[\x20\x09-\x0D]"


@dataclass(frozen=True)
class Rule:
    """Rejects a document whose measure (an SQL expression) is above the cutoff."""

    name: str
    measure: str
    cutoffs: tuple[float, ...]


#: Shares of symbols a word character, and so on, in the order in which paths go through them.
RULES = (
    Rule("symbols", "n_symbols / greatest(word_chars, 1)", (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4)),
    Rule("word_length", "word_chars / greatest(n_words, 1)", (8.0, 10.0, 12.0, 16.0, 24.0)),
    Rule("upper_case", "n_upper / greatest(word_chars, 1)", (0.1, 0.2, 0.3, 0.5, 0.7)),
    Rule("repeated_lines", "n_dup_lines / greatest(n_lines, 1)", (0.05, 0.1, 0.2, 0.3, 0.5)),
    Rule("repeated_words", "n_repeat_words / greatest(n_words, 1)", (0.02, 0.05, 0.1, 0.15, 0.2)),
)


def _words(text: Column) -> Column:
    plain = F.translate(text, "\t\n\x0b\f\r", "     ")
    return F.array_remove(F.split(plain, " ", -1), "")


def _left(text: Column, others: str) -> Column:
    """Characters of the text outside a class."""
    return F.char_length(F.regexp_replace(text, others, "")).cast("long")


def text_measures(documents: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_upper, n_repeat_words``.

    Null and empty texts have zeros. A repeated word lies in a window of five
    words that the text has twice or more. Windows are compared by 64-bit
    hashes inside the row; only rows with an equal pair are looked at further.
    Columns of the same names are replaced. Store the result before filtering on these
    columns: the optimizer would copy their nested expressions into the filter.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    one = documents.withColumns({"__words": _words(body), "__lines": lines})
    hashes = F.transform("__words", lambda w: F.xxhash64(w))
    two = one.withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "word_chars": F.char_length(F.array_join("__words", "")).cast("long"),
            "n_symbols": _left(body, r"[^#*$%&|<>]+"),
            "n_upper": _left(body, r"[^A-Z]+"),
            "n_lines": F.size("__lines").cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "__hashes": hashes,
        }
    ).drop("__words", "__lines")
    part = lambda i, k: F.get("__hashes", i + k)
    windows = F.transform(
        F.sequence(F.lit(0), F.size("__hashes") - 5),
        lambda i: F.xxhash64(part(i, 0), part(i, 1), part(i, 2), part(i, 3), part(i, 4)),
    )
    none = F.array().cast("array<bigint>")
    three = two.withColumn(
        "__windows", F.when(F.size("__hashes") >= 6, windows).otherwise(none)
    ).drop("__hashes")
    repeated = F.size(F.array_distinct("__windows")) < F.size("__windows")
    four = three.withColumn(
        "__sorted",
        F.when(
            repeated,
            F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    ).drop("__windows")
    same = lambda x, j: F.get("__sorted", j)["h"].eqNullSafe(x["h"])
    twice = F.filter("__sorted", lambda x, j: same(x, j - 1) | same(x, j + 1))
    five = four.withColumn("__starts", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("__sorted")
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate(
        "__starts",
        start,
        lambda a, i: F.struct((i + 5).alias("end"), (a["n"] + i + 5 - F.greatest(a["end"], i)).alias("n")),
        lambda a: a["n"],
    )
    return five.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("__starts")


def _log_gamma(x: Column) -> Column:
    """Of x >= 1, to about 1e-13: Stirling's series at x + 8."""
    y = x + 8
    inverse = F.lit(1.0) / y
    square = inverse * inverse
    series = inverse * (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square * (1 / 1680 - square / 1188))))
    shift = F.lit(0.0)
    for k in range(8):
        shift = shift + F.log(x + k)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) for X ~ Bin(n, rate), for k up to n * rate; above that 1, which certifies nothing.

    The term at k comes from log-gamma; the terms below follow by their ratios.
    These fall like a Gaussian within a few square roots of k, so the terms
    that are left out add less than 1e-16 of the sum.
    """
    kd, nd = k.cast("double"), n.cast("double")
    log_term = (
        _log_gamma(nd + 1)
        - _log_gamma(kd + 1)
        - _log_gamma(nd - kd + 1)
        + kd * math.log(rate)
        + (nd - kd) * math.log1p(-rate)
    )
    low = F.greatest(F.lit(0).cast("long"), k - (F.sqrt(kd + 1) * 12).cast("long") - 40)
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))
    falling = F.when(k > low, F.sequence(k, low + 1, F.lit(-1).cast("long"))).otherwise(F.array().cast("array<bigint>"))

    def step(a: Column, i: Column) -> Column:
        term = a["term"] * i.cast("double") * ((1 - rate) / rate) / (nd - i.cast("double") + 1)
        return F.struct(term.alias("term"), (a["total"] + term).alias("total"))

    total = F.aggregate(falling, start, step, lambda a: a["total"])
    return F.when(kd > nd * rate, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(log_term) * total))


def _paths(rules: Sequence[Rule]) -> list[list[tuple[Rule, float]]]:
    """For each rule a path that begins with it: the rules in turn, each from its laxest cutoff on."""
    turned = [[*rules[k:], *rules[:k]] for k in range(len(rules))]
    return [[(r, c) for r in path for c in sorted(r.cutoffs, reverse=True)] for path in turned]


def _first_step(path: Sequence[tuple[Rule, float]]) -> Column:
    """The step of a path from which on its policies reject a row; null if none does."""
    steps = [
        F.when(F.expr(rule.measure) > F.lit(float(cutoff)), F.lit(step))
        for step, (rule, cutoff) in enumerate(path, start=1)
    ]
    return F.array_min(F.array_compact(F.array(*steps)))


def _policies(paths: Sequence[Sequence[tuple[Rule, float]]]) -> Column:
    """The cutoffs of the policy at ``path, step``, as a map by rule's name."""
    maps = []
    for path in paths:
        for step in range(1, len(path) + 1):
            strictest = {rule.name: cutoff for rule, cutoff in path[:step]}
            maps.append(f"map({', '.join(f"'{n}', {float(c)!r}D" for n, c in strictest.items())})")
    steps = len(paths[0])
    return F.element_at(F.expr(f"array({', '.join(maps)})"), (F.col("path") * steps + F.col("step")).cast("int"))


def certified_policies(
    holdout: DataFrame, rules: Sequence[Rule] = RULES, risk: float = 0.05, delta: float = 0.05
) -> DataFrame:
    """``stratum, cutoffs`` (by rule) and the figures they rest on: at most one row a stratum.

    ``holdout`` has ``stratum``, ``good`` (boolean), the measures, and one row per text. Of the
    certified policies the one is taken that gains most (bad rows rejected less good rows
    rejected), of equals the first of a path and the first path. A policy that gains nothing is not used. Rows
    without a label do not count; a stratum with too few good rows has no
    policy. Counts are made before the shuffle, and only strata times paths times steps rows come out of it.
    """
    paths = _paths(rules)
    steps = len(paths[0])
    first = F.array(*[F.struct(F.lit(n).alias("path"), F.coalesce(_first_step(p), F.lit(steps + 1)).alias("step")) for n, p in enumerate(paths)])
    counts = stored(
        holdout.where(F.col("good").isNotNull())
        .select("stratum", "good", F.explode(first).alias("at"))
        .groupBy("stratum", "at.path", "at.step")
        .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    )
    strata = counts.select("stratum").distinct().count()
    # a row for each step, also where no text is rejected there first
    every = counts.groupBy("stratum", "path").agg(F.sum("good").alias("n")).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps))))
    same = F.col("c.stratum").eqNullSafe(F.col("e.stratum")) & (F.col("c.path") == F.col("e.path")) & (F.col("c.step") == F.col("e.step"))
    upto = Window.partitionBy("e.stratum", "e.path").orderBy("e.step").rowsBetween(Window.unboundedPreceding, 0)
    walked = every.alias("e").join(counts.alias("c"), same, "left").select(
        "e.stratum", "e.path", "e.step", "n",
        F.sum(F.coalesce("good", F.lit(0))).over(upto).alias("k"), F.sum(F.coalesce("bad", F.lit(0))).over(upto).alias("bad"),
    )
    walk = Window.partitionBy("stratum", "path").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    level = delta / max(strata * len(paths), 1)
    tested = walked.withColumn("tail", F.when(F.col("n") > 0, binomial_tail(F.col("k"), F.col("n"), risk)).otherwise(1.0))
    certified = tested.withColumn("worst", F.max("tail").over(walk)).where((F.col("worst") <= level) & (F.col("bad") > F.col("k")))
    gain = F.struct(F.col("bad") - F.col("k"), -F.col("step"), -F.col("path"))
    best = certified.groupBy("stratum").agg(F.max_by(F.struct("path", "step", "k", "n", "bad", "tail"), gain).alias("best"))
    return best.select("stratum", "best.*").withColumn("cutoffs", _policies(paths))


def certified_cutoffs(
    holdout: DataFrame, rules: Sequence[Rule] = RULES, risk: float = 0.05, delta: float = 0.05
) -> DataFrame:
    """The certified policies with one row for each of their rules: ``stratum, rule, cutoff, k, n, bad, tail``."""
    found = certified_policies(holdout, rules, risk, delta)
    return found.select("stratum", F.explode("cutoffs").alias("rule", "cutoff"), "k", "n", "bad", "tail")


def rejected_by(cutoffs: str, rules: Sequence[Rule] = RULES) -> Column:
    """Names of the rules that reject a row, by its map of cutoffs."""
    names = [
        F.when(F.expr(r.measure) > F.try_element_at(F.col(cutoffs), F.lit(r.name)), F.lit(r.name)) for r in rules
    ]
    return F.array_compact(F.array(*names))


def judge_quality(
    documents: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    text: str = "text",
    identity: str = "doc_id",
    rules: Sequence[Rule] = RULES,
    risk: float = 0.05,
    delta: float = 0.05,
) -> DataFrame:
    """Per document: ``doc_id``, the stratum, the measures, ``base_failed``, ``failed_rules``, ``kept``.

    ``base_failed``: fewer than 10 words, or over a fifth of them repeated; such
    rows take no part in the holdout, as no cutoff decides them. ``labels`` has
    ``quality`` (1 good, 0 bad, null unknown) by id; of several labels of an id, and of
    the copies of a text in a stratum, the worst counts. Null is a stratum of its own. Null ids have no label.
    Repeated rows are judged alike, an empty table gives an empty one.
    """
    columns = [F.col(identity).alias("doc_id"), F.col(stratum).cast("string").alias("stratum")]
    kept = documents.select(*columns, F.col(text).alias("__text"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("digest"))
    measured = stored(text_measures(kept, "__text").drop("__text")).withColumn(
        "base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    )
    marks = labels.groupBy(F.col(identity).alias("__id")).agg((F.min("quality") == 1).alias("good"))
    marked = measured.where(~F.col("base_failed")).join(marks, F.col("doc_id") == F.col("__id"))
    measures = [c for c in measured.columns if c not in ("doc_id", "stratum", "digest", "base_failed")]
    holdout = marked.groupBy("stratum", "digest").agg(F.bool_and("good").alias("good"), *[F.any_value(c).alias(c) for c in measures])
    found = certified_policies(holdout, rules, risk, delta)
    by_stratum = stored(found.select(F.col("stratum").alias("__stratum"), "cutoffs"))
    judged = measured.join(by_stratum, F.col("stratum").eqNullSafe(F.col("__stratum")), "left")
    return judged.withColumn("failed_rules", rejected_by("cutoffs", rules)).select(
        "doc_id",
        "stratum",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "failed_rules",
        (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"),
    )
