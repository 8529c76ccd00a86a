"""Toxicity by a weighted finite-state pattern grammar over clauses.

A lexicon transducer turns words into symbols with weights: insults and threats
(fixed ones, and words and stems learnt from labelled rows), targets, negations,
reporting words and quotation marks. Machines for negation, reported speech and
targets read the symbols and scale the weights; their product is one machine,
which runs over the clauses that have an insult or a threat. A clause's weight
is what the product gives; a document's score is a logistic function of its
clauses' weights, fitted on the same labelled rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.arrow import with_text_columns
from millrace.llm.store import stored
from millrace.llm.words import shingle_hashes, texts, word_hashes

INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, OTHER = "itgnrq."

# The words of the grammar in four languages.
INSULTS = (
    "idiot moron loser clown scum trash stupid pathetic worthless disgusting dumb imbecile fool jerk bastard "
    "idiota imbécil estúpido basura asqueroso imbécile stupide ordure débile dumm dummkopf abschaum widerlich"
).split()
THREATS = "kill hurt destroy beat shoot burn punch strangle matar golpear tuer frapper töten schlagen".split()
TARGETS = (
    "you your you're he she they them his her their this these those people tú usted él ella ellos vous tu il elle "
    "ils du ihr sie er"
).split()
NEGATIONS = "not never nobody cannot isn't aren't wasn't don't doesn't nunca jamás jamais nicht kein keine".split()
REPORTS = "said says wrote called claimed quoted reported dijo llamó écrit appelé sagte nannte".split()

#: Rows that the lexicon and the score are fitted on at most, chosen by a hash of the id. They bound
#: the lexicon too: each of its words is in four of them that are toxic, or more.
FIT_ROWS = 20_000
STEMS = (4, 5, 6)
#: Words whose symbol a worker remembers.
REMEMBERED = 400_000

_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE = re.compile(r"[.!?;:,\n]+")
_SYMBOL = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[\"“”„«»]")


@dataclass(frozen=True)
class Machine:
    """A weighted transducer: by state and symbol the next state and a factor, else unchanged.

    ``final`` are factors of the whole clause by the state at its end.
    """

    start: tuple
    arcs: Mapping[tuple[tuple, str], tuple[tuple, float]]
    final: Mapping[tuple, float] = field(default_factory=dict)

    def states(self) -> set[tuple]:
        return {self.start} | {s for s, _ in self.arcs} | {t for t, _ in self.arcs.values()}

    def step(self, state: tuple, symbol: str) -> tuple[tuple, float]:
        return self.arcs.get((state, symbol), (state, 1.0))


def compose(first: Machine, second: Machine) -> Machine:
    """Both machines over the same symbols; factors multiply."""
    arcs = {}
    final = {}
    for a in first.states():
        for b in second.states():
            final[a + b] = first.final.get(a, 1.0) * second.final.get(b, 1.0)
            for symbol in (INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, OTHER):
                (x, p), (y, q) = first.step(a, symbol), second.step(b, symbol)
                if x + y != a + b or p * q != 1.0:
                    arcs[a + b, symbol] = x + y, p * q
    return Machine(first.start + second.start, arcs, final)


def negation(reach: int = 3, factor: float = 0.3) -> Machine:
    """A negation weakens insults and threats among the next ``reach`` words."""
    arcs = {}
    for left in range(reach + 1):
        after = max(0, left - 1)
        scale = factor if left else 1.0
        for symbol in (INSULT, THREAT):
            arcs[(left,), symbol] = (after,), scale
        for symbol in (OTHER, TARGET, REPORT):
            arcs[(left,), symbol] = (after,), 1.0
        arcs[(left,), NEGATION] = (reach,), 1.0
    return Machine((0,), arcs)


def reported(factor: float = 0.6) -> Machine:
    """Behind a reporting word, or inside quotation marks, insults and threats weigh less."""
    plain, quoted, told = ("plain",), ("quoted",), ("told",)
    arcs = {
        (plain, QUOTE): (quoted, 1.0),
        (quoted, QUOTE): (plain, 1.0),
        (plain, REPORT): (told, 1.0),
        (told, QUOTE): (quoted, 1.0),
    }
    for state in (quoted, told):
        for symbol in (INSULT, THREAT):
            arcs[state, symbol] = state, factor
    return Machine(plain, arcs)


def aimed(target: float = 1.25, idle_threat: float = 0.25) -> Machine:
    """A clause with a target weighs more; a threat before any target weighs little."""
    none, some = ("none",), ("some",)
    arcs = {(none, TARGET): (some, 1.0), (none, THREAT): (none, idle_threat)}
    return Machine(none, arcs, {some: target})


GRAMMAR = compose(compose(negation(), reported()), aimed())


@dataclass
class ToxicityModel:
    """``words`` and ``stems`` give symbol and weight; ``coefficients`` belong to ``features``."""

    words: dict[str, tuple[str, float]]
    stems: dict[str, tuple[str, float]] = field(default_factory=dict)
    coefficients: tuple[float, ...] = (-4.0, 4.0, 1.0)
    machine: Machine = GRAMMAR
    _seen: dict[str, tuple[str, float]] = field(default_factory=dict, repr=False)

    def symbol(self, word: str) -> tuple[str, float]:
        found = self._seen.get(word)
        if found is None:
            if len(self._seen) >= REMEMBERED:
                self._seen.clear()
            found = self.words.get(word)
            for n in STEMS if found is None and self.stems else ():
                found = found or (self.stems.get(word[:n]) if len(word) > n else None)
            found = self._seen[word] = found or (OTHER, 0.0)
        return found

    def clause(self, text: str) -> float:
        """The weight of a lower-case clause."""
        state, total = self.machine.start, 0.0
        for word in _SYMBOL.findall(text):
            symbol, weight = self.symbol(word) if word[0] not in "\"“”„«»" else (QUOTE, 0.0)
            state, factor = self.machine.step(state, symbol)
            if weight:
                total += weight * factor
        return total * self.machine.final.get(state, 1.0)

    def features(self, text: str | None) -> tuple[float, float]:
        """The heaviest clause, and the logarithm of one plus the sum of all."""
        low = (text or "").lower()
        charged = [w for w in set(_WORD.findall(low)) if self.symbol(w)[1]]
        if not charged:
            return 0.0, 0.0
        hits = re.compile("|".join(map(re.escape, sorted(charged, key=len, reverse=True))))
        weights = [self.clause(c) for c in _CLAUSE.split(low) if hits.search(c)]
        return max(weights, default=0.0), math.log1p(sum(weights))

    def score(self, text: str | None) -> float:
        a, b = self.features(text)
        return _logistic(self.coefficients[0] + self.coefficients[1] * a + self.coefficients[2] * b)


def _logistic(x: float) -> float:
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))


def _prior() -> dict[str, tuple[str, float]]:
    own = {}
    for words, symbol, weight in (
        (TARGETS, TARGET, 0.0),
        (NEGATIONS, NEGATION, 0.0),
        (REPORTS, REPORT, 0.0),
        (THREATS, THREAT, 1.0),
        (INSULTS, INSULT, 1.0),
    ):
        own |= {w: (symbol, weight) for w in words}
    return own


def wilson_low(hits, total, z: float = 2.58, root=math.sqrt):
    """The lower bound of a share, of numbers or of columns."""
    share = hits / total
    middle = share + z * z / (2 * total)
    spread = z * root(share * (1 - share) / total + z * z / (4 * total * total))
    return (middle - spread) / (1 + z * z / total)


def _one_of_a_group(sample: DataFrame) -> DataFrame:
    """One row for each label and smallest hash of three words, which near copies share mostly,
    so that one text copied often does not make all its words suspicious."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for part in texts(batch):
                hashes, firsts = word_hashes(part.column("text"))
                sets = (shingle_hashes(hashes[i:j], 3) for i, j in zip(firsts[:-1], firsts[1:]))
                keys = [int(s.min() >> np.uint64(1)) if len(s) else -1 for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("__id"), part.column("toxic"), pa.array(keys, pa.int64())],
                    names=["__id", "toxic", "grp"],
                )

    kind = sample.schema["__id"].dataType.simpleString()
    keyed = sample.mapInArrow(batches, f"__id {kind}, toxic int, grp long")
    firsts = keyed.groupBy("toxic", "grp").agg(F.min("__id").alias("__id")).select("__id")
    return sample.join(F.broadcast(firsts), "__id")


def _evidence(sample: DataFrame) -> DataFrame:
    """``feature, toxic, clean``: in how many texts words and stems (marked by ``*``) occur."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            counts = Counter(), Counter()
            for text, mark in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                own = set(_WORD.findall((text or "").lower()))
                counts[mark == 1].update(own | {f"{w[:n]}*" for w in own for n in STEMS if len(w) > n})
            found = [f for f, n in counts[1].items()] + [f for f in counts[0] if f not in counts[1]]
            yield pa.RecordBatch.from_pydict(
                {
                    "feature": pa.array(found, pa.string()),
                    "toxic": pa.array([counts[1][f] for f in found], pa.int64()),
                    "clean": pa.array([counts[0][f] for f in found], pa.int64()),
                }
            )

    rows = _one_of_a_group(sample).mapInArrow(batches, "feature string, toxic long, clean long")
    summed = rows.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    return summed.where(F.col("toxic") > 3)


def _passing(evidence: DataFrame) -> DataFrame:
    """``feature, toxic, clean, best`` of the words and stems whose share of toxic groups is
    surely over a half; ``best`` is the most toxic groups of any one word with the stem."""
    toxic, total = F.col("toxic"), F.col("toxic") + F.col("clean")
    passing = evidence.where(wilson_low(toxic, total, root=F.sqrt) >= 0.5)
    words = evidence.where(~F.col("feature").endswith("*"))
    starts = [F.when(F.char_length("feature") > n, F.concat(F.substring("feature", 1, n), F.lit("*"))) for n in STEMS]
    best = words.select(F.explode(F.array_compact(F.array(*starts))).alias("feature"), "toxic")
    best = best.groupBy("feature").agg(F.max("toxic").alias("best"))
    return passing.join(best, "feature", "left").fillna(0, ["best"]).select("feature", "toxic", "clean", "best")


def _lexicon(found: list[tuple[str, int, int, int]]) -> tuple[dict, dict]:
    """Words and stems that passed, with their weights, and of stems those that say more than their words."""
    weight = lambda t, c: min(3.0, max(0.25, math.log((t + 0.5) / (c + 0.5)) / 2))
    count = {f: (t, c) for f, t, c, _ in found}
    best = {f[:-1]: b for f, _, _, b in found if f.endswith("*")}
    chosen = {f: (INSULT, weight(t, c)) for f, (t, c) in count.items()}
    words = {f: v for f, v in chosen.items() if not f.endswith("*")}
    stems: dict[str, tuple[str, float]] = {}
    surest = lambda f: (-round(wilson_low(count[f][0], sum(count[f])), 2), len(f), f)
    for feature in sorted((f for f in chosen if f.endswith("*")), key=surest):
        stem = feature[:-1]
        related = any(s.startswith(stem) or stem.startswith(s) for s in stems)
        if not related and count[feature][0] > 1.5 * best[stem]:
            stems[stem] = chosen[feature]
    covered = lambda w: any(w[:n] in stems for n in STEMS if n < len(w))
    return {w: v for w, v in words.items() if not covered(w)}, stems


def _logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 60) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + penalty, x.T @ (y - p) - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def held_out(identity: Column) -> Column:
    """Rows whose label no model may see: crc32 of the id's text is 2 modulo 4. False for null."""
    return F.coalesce(F.crc32(identity.cast("string")) % 4 == 2, F.lit(False))


def fit_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    identity: str = "doc_id",
    text: str = "text",
    rows: int = FIT_ROWS,
) -> ToxicityModel:
    """A model from at most ``rows`` labelled documents that are not held out.

    ``labels`` has ``toxic`` (1, 0, null unknown) by id; of several the
    greatest counts, and of several texts of an id the least. The sample's ids are broadcast, ``rows`` at most, and its
    counts and clause weights go to the driver. Without labelled rows, or with labels of
    one kind, the fixed words and coefficients remain.
    """
    marks = (
        labels.where(F.col("toxic").isNotNull() & F.col(identity).isNotNull() & ~held_out(F.col(identity)))
        .groupBy(F.col(identity).alias("__id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(rows)
    )
    rows_of = documents.select(F.col(identity).alias("__id"), F.col(text).cast("string").alias("text"))
    sample = stored(rows_of.join(F.broadcast(marks), "__id").groupBy("__id", "toxic").agg(F.min("text").alias("text")))
    words, stems = _lexicon([tuple(r) for r in _passing(stored(_evidence(sample))).collect()])
    model = ToxicityModel(_prior() | words, stems)
    drawn = _scored(sample.select("toxic", "text"), "text", model, ["heaviest", "whole"]).select("toxic", "heaviest", "whole")
    table = np.array([tuple(r) for r in drawn.collect()], float).reshape(-1, 3)
    if 0 < table[:, 0].sum() < len(table):
        design = np.column_stack([np.ones(len(table)), table[:, 1:]])
        model.coefficients = tuple(map(float, _logistic_fit(design, table[:, 0])))
    return model


def _scored(documents: DataFrame, text: str, model: ToxicityModel, names: list[str]) -> DataFrame:
    """One name is that of the score, two are those of the features."""

    def work(values: list[str | None]) -> list[tuple[float, ...]]:
        made = [model.features(v) if len(names) > 1 else (model.score(v),) for v in values]
        return list(zip(*made)) if made else [()] * len(names)

    return with_text_columns(documents, text, [(n, T.DoubleType()) for n in names], work)


def score_toxicity(
    documents: DataFrame, model: ToxicityModel, text: str = "text", score: str = "score"
) -> DataFrame:
    """The rows with a score of 0 to 1. Only the text counts; null is the empty text, which
    scores the model's base rate. A column of that name is replaced; repeated rows score alike,
    an empty table stays empty."""
    return _scored(documents, text, model, [score])
