"""A training-data pipeline over ``documents``: five stages, each written and read again.

Toxic documents go, boilerplate lines of a source are dropped, one document of
each group of near-duplicates stays, documents with benchmark passages go, and the
rest is mixed to target weights.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.decontamination import decontaminate
from millrace.llm.lines import drop_boilerplate
from millrace.llm.mixing import mix
from millrace.llm.neardup import NearDup, deduplicated
from millrace.llm.queries import LINE_MIN_PAGES, LINE_RATIO, MIX_LIMIT, MIX_SEED, MIX_WEIGHTS, TOXIC_FROM
from millrace.llm.store import stored
from millrace.llm.toxicity import fit_toxicity, score_toxicity

#: Shingles of five words, at least 80 % alike.
NEAR = NearDup(width=5, percent=80, bands=40)
#: Lines on more than 2 % of a source's texts, and on 10 of them, go too where they stand among other text.
LINE_RARE = (0.02, 10)
#: Rows of an Arrow batch at most. Spark's 10,000 are some 30 MB of text, held on both sides.
ARROW_ROWS = 500
_ARROW = "spark.sql.execution.arrow.maxRecordsPerBatch"


def short_batches(spark: SparkSession) -> None:
    """Rows go to Python by ``ARROW_ROWS`` at most from now on; a session that has fewer keeps its number.

    The setting stays, as a stage's rows are computed after it returns.
    """
    if not 0 < int(spark.conf.get(_ARROW)) <= ARROW_ROWS:
        spark.conf.set(_ARROW, str(ARROW_ROWS))


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, by a model of the labelled ones among them."""
    short_batches(spark)
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_toxicity(docs, model, score="__score")
    return scored.where(F.col("__score") < TOXIC_FROM).drop("__score")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines, and ``n_chars`` of what is left.

    Copies of a text count once: the next stage is to see them whole, and keeps one.
    """
    shares = {"ratio": LINE_RATIO, "min_pages": LINE_MIN_PAGES, "rare": LINE_RARE}
    left = drop_boilerplate(docs, F.col("source"), copies=False, **shares)
    if "n_chars" not in docs.columns:
        return left
    return left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component."""
    short_batches(spark)
    return deduplicated(docs, NEAR)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    short_batches(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mix(docs, MIX_WEIGHTS, MIX_LIMIT, MIX_SEED)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("line dedup", drop_lines),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: SQL does not learn a lexicon or run a grammar; tests/llm hold brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents after all stages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
