"""Spaced seeds against a comparison of all windows."""

import itertools
import random

import pytest

from millrace.llm.decontamination import MASKS, OVERLAP, SIMILARITY, contaminated, decontaminate


def _matched(document, item):
    """The most equal words of aligned windows, over all diagonals."""
    width = min(OVERLAP, len(item))
    best = 0
    for diagonal in range(-len(item) + 1, len(document)):
        low, high = max(0, -diagonal), min(len(item), len(document) - diagonal)
        same = [document[i + diagonal] == item[i] for i in range(low, high)]
        best = max([best, *(sum(same[k : k + width]) for k in range(len(same) - width + 1))])
    return best if best >= width * SIMILARITY else None


def test_substituted_passages_are_found(spark):
    draw = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    items = [[draw.choice(words) for _ in range(draw.randint(8, 40))] for _ in range(12)]
    items.append(list(items[0]))  # the same text twice
    docs = []
    for k in range(60):
        body = [draw.choice(words) for _ in range(80)]
        if k % 2:
            item = draw.choice(items)
            part = item[: draw.randint(min(13, len(item)), len(item))]
            changed = [w if draw.random() > 0.08 else "other" for w in part]
            at = draw.randrange(60)
            body[at:at] = changed
        docs.append(body)
    rows = [(k, " ".join(d).upper() if k % 5 == 0 else " \n".join(d)) for k, d in enumerate(docs)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id long, text string")
    wanted = {
        (d, i): m for d, body in enumerate(docs) for i, item in enumerate(items) if (m := _matched(body, item))
    }
    found = {(r.doc_id, r.item_id): r.matched for r in contaminated(documents, benchmark).collect()}
    assert found == wanted and len(wanted) > 20
    left = {r.doc_id for r in decontaminate(documents, benchmark).collect()}
    assert left == {k for k, _ in rows} - {d for d, _ in wanted}


@pytest.mark.parametrize("length", [12, OVERLAP])
def test_masks_hit_all_windows_with_two_substitutions(length):
    """So no passage of 12 words or more is lost before it is compared."""
    for wrong in itertools.combinations(range(length), 2):
        assert any(
            all(bit == "0" or at + k not in wrong for k, bit in enumerate(mask))
            for mask in MASKS
            for at in range(length - len(mask) + 1)
        )
