"""Prefix tables against the library, prefix by prefix."""

import time

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.tokens import PrefixCounter, longest_within, token_prefixes, token_totals, tokenizer_body, tokens_within

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
COUNTER = PrefixCounter(tokenizer_body(PATH))
PARTS = (
    "' re ll 's don't the ing é ñ 1 23 ½ ² ... <|endoftext|> <|endof 漢字 🙂 _ Ⅷ ٣ | ª === İ ﬁ"
).split() + [" ", "  ", "\n", "\t", "\x85", "\xa0", " ", "\x1c", "\r\n", "​", "́"]


def _library(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


@given(parts=st.lists(st.sampled_from(PARTS), max_size=12), limit=st.integers(0, 9))
@settings(max_examples=300, deadline=None)
def test_every_prefix(parts, limit):
    text = "".join(parts)
    counts = [_library(text[:n]) for n in range(len(text) + 1)]
    assert list(COUNTER.counts(text)) == counts
    assert COUNTER.total_and_fit(text, limit) == (
        counts[-1],
        max(n for n, c in enumerate(counts) if c <= limit),
    )


@given(text=st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_text(text):
    assert COUNTER.total(text) == _library(text)


@pytest.mark.parametrize("late", "\u0558\u209e\ua7d2\U00010ec6\U00011de3\U000125f0\U0001e6c0\U000323b0\U0003347a")
def test_letters_and_digits_that_the_library_does_not_know(late):
    for text in (late, f"{late}'s", f"a{late}b 1{late}2", f"é {late}{late} \n{late}!漢{late}½", f"'re{late}'ll"):
        assert COUNTER.total(text) == _library(text)
        assert list(COUNTER.counts(text)) == [_library(text[:n]) for n in range(len(text) + 1)]


@pytest.mark.parametrize("unit", ["a", "ab", "é", "=", " ", "\n", "7", "漢", "xyzzy"])
def test_long_runs_without_a_break(unit):
    """One piece of a megabyte is counted once, and its prefix looked up."""
    text = unit * ((1 << 20) // len(unit.encode()))
    begun = time.process_time()
    total, fit = COUNTER.total_and_fit(text, 1024)
    assert time.process_time() - begun < 60 and len(COUNTER._totals) < 100_000
    assert _library(text[:fit]) <= 1024 < _library(text[: fit + 1])
    assert total == _library(text)


@pytest.mark.parametrize("text", ["word " * 9 + "x" * 3000, "." * 900 + "<|endoftext|>" * 40, " " * 700 + "<|endoftext|> tail", "a  \n" * 300])
def test_limits_inside_runs(text):
    counts = COUNTER.counts(text)
    assert list(counts[:: max(1, len(text) // 60)]) == [_library(text[:n]) for n in range(0, len(text) + 1, max(1, len(text) // 60))]
    for limit in (0, 1, 5, 11, 40, 200):
        assert COUNTER.total_and_fit(text, limit) == (counts[-1], max(n for n, c in enumerate(counts) if c <= limit))


def test_queries_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40)
    counted = token_totals(docs, PATH, 50)
    for row in counted.collect():
        assert row.n_tokens == _library(row.text) and row.n_bytes == len(row.text.encode())
        assert _library(row.text[: row.fit_chars]) <= 50 or row.fit_chars == 0
    prefixes = token_prefixes(docs.select(F.substring("text", 1, 200).alias("text")), PATH)
    asked = prefixes.select(
        "text",
        tokens_within(F.col("prefix_tokens"), F.lit(30)).alias("n"),
        longest_within(F.col("prefix_tokens"), F.lit(10)).alias("fit"),
    )
    for row in asked.collect():
        assert row.n == _library(row.text[:30])
        assert _library(row.text[: row.fit]) <= 10


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        PrefixCounter(tokenizer_body(public_tokenizers.path("word_bpe_49k.json")))
