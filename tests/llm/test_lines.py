"""Line dedup where a source holds many copies of one document."""

import corpus_pipeline as P

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{k}" for k in range(400)]


def _body(k, lines=8):
    """Lines that no other number has."""
    return [" ".join([f"d{k}l{n}", *(WORDS[(k * 37 + n * 11 + j * j) % 400] for j in range(9))]) for n in range(lines)]


def _documents(spark, bodies, source="s"):
    rows = [(k, "\n".join(b), "en", source, len("\n".join(b))) for k, b in enumerate(bodies)]
    return spark.createDataFrame(rows, DOCS)


def test_one_whole_document_is_left_of_copies_that_are_a_third_of_a_source(spark, sf_dir):
    bodies = [["Home menu", *_body(k)] for k in range(60)] + [["Home menu", *_body(99)]] * 30
    left = P.drop_lines(spark, _documents(spark, bodies), sf_dir)
    kept = {r.doc_id: r.text for r in P.drop_near_duplicates(spark, left, sf_dir).collect()}
    assert kept == {k: "\n".join(_body(k)) for k in range(60)} | {60: "\n".join(_body(99))}


def test_rare_boilerplate_goes_and_near_copies_keep_one_whole_document(spark, sf_dir):
    bodies = [_body(k) + (["Imprint and privacy"] if k % 30 == 0 else []) for k in range(390)]
    near = [[*_body(999, 30), f"copy {k}"] for k in range(15)]
    left = P.drop_lines(spark, _documents(spark, bodies + near), sf_dir)
    kept = {r.doc_id: r.text for r in P.drop_near_duplicates(spark, left, sf_dir).collect()}
    assert kept == {k: "\n".join(_body(k)) for k in range(390)} | {390: "\n".join(near[0])}
