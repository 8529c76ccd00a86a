"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, for all operators."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from millrace.llm.decontamination import contaminated, decontaminate
from millrace.llm.extraction import extract_text
from millrace.llm.lines import drop_boilerplate
from millrace.llm.mixing import mix, mix_counts
from millrace.llm.neardup import deduplicated, near_duplicates
from millrace.llm.quality import judge_quality
from millrace.llm.queries import url_rules
from millrace.llm.tokens import token_prefixes, token_totals
from millrace.llm.toxicity import fit_toxicity, score_toxicity
from millrace.llm.urls import judge_urls
from millrace.llm.warc import resolve_revisits

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LONG = "word " * 60_000 + "x" * 50_000


def _labels(spark, rows=()):
    return spark.createDataFrame(list(rows), LABELS)


def _benchmark(spark, rows=()):
    return spark.createDataFrame(list(rows), "item_id long, text string")


OPERATORS = {
    "quality": lambda s, d: judge_quality(d, _labels(s)),
    "lines": lambda s, d: drop_boilerplate(d, F.col("source"), dropped="n_dropped"),
    "mix_counts": lambda s, d: mix_counts(d),
    "mix": lambda s, d: mix(d),
    "near_duplicates": lambda s, d: near_duplicates(d),
    "deduplicated": lambda s, d: deduplicated(d),
    "tokens": lambda s, d: token_totals(d, TOKENIZER, 10),
    "prefixes": lambda s, d: token_prefixes(d.where("length(text) < 1000 or text is null"), TOKENIZER),
    "toxicity": lambda s, d: score_toxicity(d, fit_toxicity(d, _labels(s))),
    "contaminated": lambda s, d: contaminated(d, _benchmark(s)),
    "decontaminate": lambda s, d: decontaminate(d, _benchmark(s, [(1, None), (None, "a b"), (2, "")])),
}
#: Of as many rows as they got, save those that reject or list some.
ROW_FOR_ROW = {"quality", "lines", "mix_counts", "near_duplicates", "tokens", "toxicity", "decontaminate"}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, spark.createDataFrame([], DOCS)).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_clashing_names(spark, name):
    rows = [
        (None, None, None, None, None),
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \n\t ", "en", "a", 4),
        (4, "same words here again and again", "en", "b", None),
        (5, "same words here again and again", None, "b", 31),
        (5, "same words here again and again", None, "b", 31),
        (None, "same words here again and again", "en", None, 31),
        (6, LONG, "en", "b", len(LONG)),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    names = "key size host rep rule hash bucket item_id score stratum kept words seeds rate copies component".split()
    clash = docs.withColumns({n: F.lit("other") for n in [*names, "two words", "a.b"]})
    found = OPERATORS[name](spark, clash).collect()
    if name in ROW_FOR_ROW:
        assert len(found) == len(rows)


def test_near_duplicates_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b c d"), (5, "A b  c D"), (4, "a b c d"), (None, "a b c d"), (None, "z"), (9, "z y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_duplicates(docs).collect()}
    assert found[1, 0] == (1, True) and found[2, 0] == (2, True)
    assert found[3, 2] == (3, True) and found[4, 2] == (3, False) and found[5, 2] == (3, False)
    assert found[None, 2] == (3, False) or found[None, 2][0] == 3
    assert found[None, 1] == (None, True) and found[9, 1] == (9, True)
    assert sorted(r.doc_id or 0 for r in deduplicated(docs).collect()) == [0, 0, 1, 2, 3, 9]


def test_pages_of_odd_rows(spark):
    rows = [(1, None, None), (2, "", ""), (2, "", ""), (3, "no scheme", "<p>"), (None, "http://A.net", "x&amp;y<br>z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    clash = pages.withColumns({n: F.lit(1) for n in ("host", "path", "found", "rule", "text", "key")})
    texts = sorted((r.page_id or 0, r.text) for r in extract_text(clash).collect())
    assert texts == [(0, "x&y z"), (1, ""), (2, ""), (2, ""), (3, "")]
    hosts = sorted((r.page_id or 0, r.host, r.path) for r in judge_urls(clash, url_rules()).collect())
    assert hosts == [(0, "a.net", ""), (1, "", ""), (2, "", ""), (2, "", ""), (3, "", "")]
    nothing = spark.createDataFrame([], pages.schema)
    assert extract_text(nothing).collect() == [] and judge_urls(nothing, url_rules()).collect() == []


def test_records_of_odd_rows(spark):
    schema = "record_id long, url string, time long, kind string, headers map<string,string>"
    rows = [
        (1, None, 1, "response", None),
        (2, "http://a/", None, "revisit", None),
        (3, None, 2, "revisit", None),
        (4, "http://a", 5, "revisit", None),
        (5, "http://a", 5, "response", None),
        (6, "http://a", 6, None, None),
        (7, "http://www.A/#x", 7, "revisit", {"etag": None}),
        (7, "http://www.A/#x", 7, "revisit", {"etag": None}),
    ]
    records = spark.createDataFrame(rows, schema).withColumns({"key": F.lit(1), "full": F.lit(1), "id": F.lit(2)})
    found = [(r.record_id, r.response_id, r.verdict) for r in resolve_revisits(records).collect()]
    assert sorted(found) == [
        (2, None, "no_response"),
        (3, None, "no_response"),
        (4, None, "no_response"),
        (7, 5, "resolved"),
        (7, 5, "resolved"),
    ]
    assert resolve_revisits(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_stage_of_odd_rows(spark, sf_dir, stage):
    work = dict(corpus_pipeline.STAGES)[stage]
    rows = [(None, None, None, None, None), (1, "", None, None, 0), (2, LONG, "en", "a", len(LONG))]
    docs = spark.createDataFrame(rows, DOCS)
    assert work(spark, docs, sf_dir).columns == docs.columns
    assert work(spark, docs, sf_dir).count() >= 1
    assert work(spark, docs.limit(0), sf_dir).collect() == []
