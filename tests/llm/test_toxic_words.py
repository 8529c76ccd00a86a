"""Words learnt among many more frequent ones that are no evidence."""

import itertools
import random

from millrace.llm.toxicity import fit_toxicity


def test_rare_word_of_toxic_texts_is_learnt_among_many_common_ones(spark):
    draw = random.Random(3)
    common = ["".join(w) for w in itertools.islice(itertools.product("abcdefghijklmnopqrstu", repeat=4), 9000)]
    rows, marks = [], []
    for k in range(48):
        words = draw.sample(common, len(common)) + ["zzzz"] * (k % 2)
        rows.append((k, " ".join(words)))
        marks.append((k, 1, k % 2))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    learnt = fit_toxicity(documents, labels).words
    assert "zzzz" in learnt and not learnt.keys() & set(common)
