"""Word and shingle hashes against a loop over words."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import words as W
from millrace.llm.bloom import LEAST_BITS, MOST_BITS, bits_for, bloom_of, passes
from pyspark.sql import functions as F

TEXT = st.one_of(st.none(), st.text(alphabet="aAbé \n\t\x0b\x1c🙂", max_size=60))


def _plain(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in found]


@pytest.mark.parametrize("piece", [5, 16, 1 << 21])
@given(rows=st.lists(TEXT, max_size=6))
@settings(max_examples=60, deadline=None)
def test_hashes_are_those_of_the_words(piece, rows):
    kept, W.PIECE = W.PIECE, piece
    try:
        hashes, firsts = W.word_hashes(pa.array(rows, pa.string()))
    finally:
        W.PIECE = kept
    seen = {}
    for row, low, high in zip(rows, firsts[:-1], firsts[1:]):
        words = _plain(row)
        assert len(words) == high - low
        assert all(seen.setdefault(w, h) == h for w, h in zip(words, hashes[low:high]))
    assert len(set(seen.values())) == len(seen)


def test_shingles_of_short_and_longer_texts():
    words = np.arange(1, 6, dtype=np.uint64)
    assert len(W.shingle_hashes(words, 3)) == 3
    assert len(W.shingle_hashes(words[:2], 3)) == 1
    assert len(W.shingle_hashes(words[:0], 3)) == 0
    assert W.shingle_hashes(words[:2], 3)[0] != W.shingle_hashes(words[1::-1], 3)[0]


def test_slices_have_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["a" * n for n in (5, 0, 30, 1, 1)] + [None])})
    parts = list(W.texts(batch, most=10))
    assert sum(p.num_rows for p in parts) == 6 and [p.num_rows for p in parts][:2] == [2, 1]


def test_filter_lets_all_keys_through(spark):
    keys = W.mixed(np.arange(3000, dtype=np.uint64))
    frame = spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "k long")
    body = bloom_of(frame, F.col("k"), frame.count())
    assert passes(body, keys).all()
    assert passes(body, W.mixed(np.arange(10**6, 2 * 10**6, dtype=np.uint64))).mean() < 1e-4


def test_filter_is_sized_by_its_keys(spark):
    """Ten million keys: all pass, and under 5 % of others."""
    n = 10_000_000
    frame = spark.range(n).select(F.xxhash64("id").alias("k"))
    body = bloom_of(frame, F.col("k"), n)
    assert len(body) == bits_for(n) // 8 == 1 << 24 and bits_for(0) == LEAST_BITS and bits_for(1 << 40) == MOST_BITS
    own = frame.limit(50_000).toPandas()["k"].to_numpy().view(np.uint64)
    others = W.mixed(np.arange(1, 200_001, dtype=np.uint64) + np.uint64(1 << 50))
    assert passes(body, own).all() and passes(body, others).mean() < 0.05
