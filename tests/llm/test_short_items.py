"""Benchmark items of fewer words than the general masks need."""

import itertools

import pytest

from millrace.llm import decontamination
from millrace.llm.decontamination import SHORT, SIMILARITY, contaminated, short_masks


@pytest.mark.parametrize("length", range(1, SHORT))
def test_short_masks_hit_all_windows_that_are_accepted(length):
    wrong = max(k for k in range(length) if length - k >= length * SIMILARITY)
    for places in itertools.combinations(range(length), wrong):
        assert any(all(mask[k] == "0" for k in places) for mask in short_masks(length, SIMILARITY))


def test_every_accepted_pattern_of_short_items_is_found(spark):
    items, docs, wanted = [], [], {}
    for length in range(1, SHORT):
        items.append([f"i{length}w{k}" for k in range(length)])
        for wrong in range(3):
            for places in itertools.combinations(range(length), wrong):
                body = [f"d{len(docs)}x{k}" for k in range(6)]
                body[3:3] = ["other" if k in places else w for k, w in enumerate(items[-1])]
                if length - wrong >= max(1, length * SIMILARITY):
                    wanted[len(docs), length - 1] = length - wrong
                docs.append(body)
    documents = spark.createDataFrame([(k, " ".join(d)) for k, d in enumerate(docs)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.matched for r in contaminated(documents, benchmark).collect()}
    assert found == wanted and len(wanted) == 11 + sum(range(5, 10)) + 10 + 45 + 11 + 55


def test_benchmarks_larger_than_a_filter_go_in_parts(spark, monkeypatch):
    rows = [(k, f"one two three w{k} five six seven eight nine ten eleven twelve thirteen v{k}") for k in range(6)]
    documents = spark.createDataFrame([(k, f"before it {t} and after") for k, t in rows], "doc_id long, text string")
    benchmark = spark.createDataFrame(rows, "item_id long, text string")
    whole = sorted(map(tuple, contaminated(documents, benchmark).collect()))
    monkeypatch.setattr(decontamination, "MOST_KEYS", 25)
    assert sorted(map(tuple, contaminated(documents, benchmark).collect())) == whole and len(whole) >= 6
