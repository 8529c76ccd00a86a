"""The pipeline's stages against plain versions, each on its own input."""

import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from millrace.llm.decontamination import OVERLAP, SIMILARITY
from millrace.llm.mixing import LARGEST
from millrace.llm.queries import LINE_MIN_PAGES, LINE_RATIO, MIX_LIMIT, MIX_SEED, MIX_WEIGHTS, TOXIC_FROM
from millrace.llm.toxicity import fit_toxicity

WORD = r"[^\x20\x09-\x0D]+"


def _lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def _toxicity(spark, docs, sf_dir):
    model = fit_toxicity(spark.createDataFrame(docs), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return [d for d in docs if model.score(d["text"]) < TOXIC_FROM]


def _lines(spark, docs, sf_dir):
    bare = lambda x: x.strip(" \t\x0b\x0c\r")
    texts = {(d["source"], d["text"]) for d in docs}
    pages, having, among = Counter(s for s, _ in texts), Counter(), Counter()
    for s, text in texts:
        having.update({(s, bare(x)) for x in text.split("\n") if bare(x)})
    often = lambda s, x: pages[s] >= LINE_MIN_PAGES and having[s, x] > max(1, pages[s] * LINE_RATIO)
    least = lambda s, n: n >= P.LINE_RARE[1] and n > pages[s] * P.LINE_RARE[0]
    for s, text in texts:
        on = [x for x in text.split("\n") if bare(x) and (often(s, bare(x)) or least(s, having[s, bare(x)]))]
        if 2 * len("".join(on)) <= len(text):
            among.update({(s, bare(x)) for x in on})
    out = []
    for d in docs:
        s = d["source"]
        gone = lambda x: bare(x) and (often(s, bare(x)) or least(s, among[s, bare(x)]))  # noqa: B023, E731
        text = "\n".join(x for x in d["text"].split("\n") if not gone(x))
        out.append(d | {"text": text, "n_chars": len(text)})
    return out


def _near(spark, docs, sf_dir):
    sets = {}
    for d in docs:
        w = re.findall(WORD, _lower(d["text"]))
        sets[d["doc_id"]] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and min(len(x), len(y)) >= 0.8 * max(len(x), len(y)):
            if 100 * len(x & y) >= 80 * len(x | y):
                u, v = find(a), find(b)
                parent[max(u, v)] = min(u, v)
    return [d for d in docs if find(d["doc_id"]) == d["doc_id"]]


def _contaminated(words, items):
    for item in items:
        width = min(OVERLAP, len(item))
        at = defaultdict(list)
        for k, w in enumerate(item):
            at[w].append(k)
        diagonals = defaultdict(set)
        for k, w in enumerate(words):
            for j in at[w]:
                diagonals[k - j].add(j)
        for same in diagonals.values():
            if any(sum(k <= j < k + width for j in same) >= width * SIMILARITY for k in range(len(item) - width + 1)):
                return True
    return False


def _decontaminated(spark, docs, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    items = [re.findall(WORD, _lower(r.text)) for r in rows]
    return [d for d in docs if not _contaminated(re.findall(WORD, _lower(d["text"])), items)]


def _mixed(spark, docs, sf_dir):
    size = {d["doc_id"]: len(re.findall(WORD, d["text"])) for d in docs}
    whole = Counter()
    for d in docs:
        whole[d["source"]] += size[d["doc_id"]]
    weight = {s: MIX_WEIGHTS[k % 3] for k, s in enumerate(sorted(whole))}
    left, free, target = sum(whole.values()), set(whole), {}
    while free:
        total = sum(weight[s] for s in free)
        above = {s for s in free if left * weight[s] > MIX_LIMIT * whole[s] * total}
        if not above:
            target |= {s: left * weight[s] / total for s in free}
            break
        target |= {s: float(MIX_LIMIT * whole[s]) for s in above}
        left, free = left - sum(MIX_LIMIT * whole[s] for s in above), free - above
    drawn = lambda key: int(hashlib.md5(f"{MIX_SEED}:{key}".encode()).hexdigest()[:8], 16) / 2**32
    out = []
    for s in whole:
        rate, start = target[s] / whole[s], drawn(f"start:{s}")
        part = rate - int(rate)
        own = sorted((d for d in docs if d["source"] == s), key=lambda d: (-size[d["doc_id"]], drawn(d["doc_id"]), str(d["doc_id"])))
        for n, d in enumerate(own, start=1):
            passes = math.floor(n * part + start) > math.floor((n - 1) * part + start)
            out += [d] * (int(rate) + (passes if n <= LARGEST else drawn(d["doc_id"]) < part))
    return out


PLAIN = dict(zip([name for name, _ in P.STAGES], (_toxicity, _lines, _near, _decontaminated, _mixed)))


@pytest.fixture(scope="module")
def documents(spark):
    """A few hundred documents of few sources, so that lines repeat."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    source = F.concat(F.lit("src"), (F.col("doc_id") % 3).cast("string"))
    again = F.concat("text", F.when(F.col("doc_id") % 4 == 0, F.lit("\nAll rights reserved.")).otherwise(F.lit("")))
    return rows.withColumn("source", source).withColumn("text", again).withColumn("n_chars", F.length("text").cast("long"))


def _plain_rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("name", PLAIN)
def test_stage_equals_its_plain_version(spark, sf_dir, documents, name):
    found = dict(P.STAGES)[name](spark, documents, sf_dir)
    assert found.columns == documents.columns
    docs = [r.asDict() for r in documents.collect()]
    wanted = PLAIN[name](spark, docs, sf_dir)
    assert _plain_rows(found) == sorted((tuple(d[c] for c in documents.columns) for d in wanted), key=repr)
    assert wanted != docs


def test_run_is_the_stages_one_after_another(spark, sf_dir):
    docs = [r.asDict() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    for name in PLAIN:
        docs = PLAIN[name](spark, docs, sf_dir)
    found = P.run(spark, sf_dir)
    assert _plain_rows(found) == sorted((tuple(d[c] for c in found.columns) for d in docs), key=repr)


@pytest.mark.parametrize("name", ["toxicity", "near-duplicates", "decontamination"])
def test_rows_go_to_python_in_short_batches(spark, tmp_path, name):
    docs = spark.range(1300).selectExpr(
        "id AS doc_id", "concat_ws(' ', 'some you idiot words of text', id % 900, id % 900 + 1, 'more here') AS text"
    )
    spark.range(0, 1300, 2).selectExpr("id AS doc_id", "int(id % 3 = 0) AS toxic").write.parquet(f"{tmp_path}/labels.parquet")
    spark.sql("SELECT 1 AS item_id, 'some you idiot words of text 7 8 more here' AS text").write.parquet(f"{tmp_path}/benchmark.parquet")
    stage, before = dict(P.STAGES)[name], spark.conf.get(P._ARROW)

    def batches(source):
        for batch in source:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    sizes = lambda: [r.n for r in spark.range(0, 1300, 1, 1).mapInArrow(batches, "n long").collect()]
    try:
        spark.conf.set(P._ARROW, "10000")
        rows = _plain_rows(stage(spark, docs, str(tmp_path)))
        assert max(sizes()) == P.ARROW_ROWS and sum(sizes()) == 1300
        spark.conf.set(P._ARROW, "7")
        assert _plain_rows(stage(spark, docs, str(tmp_path))) == rows
        assert max(sizes()) == 7
    finally:
        spark.conf.set(P._ARROW, before)
