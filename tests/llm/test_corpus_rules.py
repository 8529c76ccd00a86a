"""Quality measures, toxicity, mixing, lines, URL rules and revisits against plain versions."""

import math
import random
import re
from collections import Counter
from math import comb

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from millrace.llm import lines as L
from millrace.llm import toxicity as X
from millrace.llm.mixing import copies_taken, mix, mix_counts, source_targets
from millrace.llm.quality import Rule, binomial_tail, certified_cutoffs, certified_policies, judge_quality, text_measures
from millrace.llm.queries import QUERIES
from millrace.llm.urls import UrlRule, judge_urls, rule_index
from millrace.llm.warc import latest_earlier, resolve_revisits

WORD = r"[^\x20\x09-\x0D]+"


def _measured(text):
    words = re.findall(WORD, text)
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    repeated = {k + j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(5)}
    rows = [x for x in text.split("\n") if re.search(WORD, x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(rows) - len(set(rows)), len(repeated)


def test_measures_are_those_of_a_loop(spark):
    draw = random.Random(5)
    parts = ["a ", "b ", "\n", "é#", "\x0b", "🙂 ", "\x1c", "|", "a b c d e "]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 40))) for _ in range(150)]
    found = text_measures(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    for r in found:
        got = r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words
        assert got == _measured(r.text)


def test_binomial_tail_is_the_sum(spark):
    pairs = [(0, 5), (0, 300), (3, 300), (10, 1000), (40, 5000), (2, 2000)]
    tail = binomial_tail(F.col("k"), F.col("n"), 0.01)
    for r in spark.createDataFrame(pairs, "k long, n long").withColumn("tail", tail).collect():
        exact = sum(comb(r.n, i) * 0.01**i * 0.99 ** (r.n - i) for i in range(r.k + 1))
        assert r.tail == pytest.approx(exact, rel=1e-8)


def test_cutoffs_keep_the_good_and_take_the_laxest_of_equals(spark):
    rows = [("a", True, 0.1)] * 990 + [("a", True, 0.5)] * 3 + [("a", False, 0.9)] * 50 + [("b", False, 0.9)] * 9
    holdout = spark.createDataFrame(rows, "stratum string, good boolean, x double")
    rule = Rule("x", "x", (0.05, 0.2, 0.6, 0.8))
    found = certified_cutoffs(holdout, [rule], risk=0.02, delta=0.05).collect()
    assert [(r.stratum, r.cutoff, r.k, r.bad) for r in found] == [("a", 0.8, 0, 50)]


def _certified(rows, rules, risk, delta):
    """The best certified policy of each stratum, by trying all policies of all paths."""
    strata = {}
    for stratum, good, *values in rows:
        if good is not None:
            strata.setdefault(stratum, []).append((good, dict(zip("xyz", values))))
    found = {}
    for stratum, texts in strata.items():
        n, best = sum(g for g, _ in texts), None
        for path in range(len(rules)):
            steps = [(r, c) for r in [*rules[path:], *rules[:path]] for c in sorted(r.cutoffs, reverse=True)]
            for step in range(1, len(steps) + 1):
                policy = {r.name: c for r, c in steps[:step]}
                gone = [g for g, v in texts if any(v[m] > c for m, c in policy.items())]
                k, bad = sum(gone), len(gone) - sum(gone)
                tail = sum(comb(n, i) * risk**i * (1 - risk) ** (n - i) for i in range(k + 1)) if n and k <= n * risk else 1
                if tail > delta / len(strata) / len(rules):
                    break
                if bad > k and (best is None or (bad - k, -step, -path) > best[0]):
                    best = (bad - k, -step, -path), policy, k, bad
        if best:
            found[stratum] = best[1:]
    return found


@pytest.mark.parametrize("seed", range(3))
def test_policies_are_those_of_a_walk_along_all_paths(spark, seed):
    draw = random.Random(seed)
    rules = [Rule("x", "x", (0.5, 0.2, 0.8)), Rule("y", "y", (0.9, 0.6)), Rule("z", "z", (0.3, 0.7))]
    rows = []
    for stratum, size in (("a", 900), ("b", 300), (None, 160), ("d", 20)):
        for _ in range(size):
            good = draw.choice([True] * 7 + [False, False, None])
            low = 0.35 if good else 1.0
            rows.append((stratum, good, *[round(draw.random() ** (1 if not good else 1.5) * (1 if draw.random() < 0.04 else low), 3) for _ in "xyz"]))
    holdout = spark.createDataFrame(rows, "stratum string, good boolean, x double, y double, z double")
    found = {r.stratum: (dict(r.cutoffs), r.k, r.bad) for r in certified_policies(holdout, rules, risk=0.1, delta=0.05).collect()}
    assert found == _certified(rows, rules, 0.1, 0.05) and "d" not in found and "a" in found


def test_copies_are_one_trial(spark):
    """Forty texts in thirty copies each are forty trials: too few to certify what a thousand would."""
    docs, marks = [], []
    for k in range(1200):
        text = f"word{k % 40} " * 3 + " ".join(f"w{k % 40}x{j}" for j in range(12))
        docs.append((k, text + (" ### ### $$$ $$$" if k % 40 == 0 else ""), "en"))
        marks.append((k, int(k % 40 != 0)))
    documents = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    assert all(r.kept for r in judge_quality(documents, labels).collect() if not r.base_failed)
    unlike = documents.withColumn("text", F.concat("text", F.lit(" t"), "doc_id"))
    assert {r.doc_id for r in judge_quality(unlike, labels).collect() if r.failed_rules} == set(range(0, 1200, 40))


def test_the_query_rejects_by_its_method(spark):
    """At sf0.01 the method certifies a policy: it rejects rows that the base rules keep, and none labelled good."""
    sf_dir = str(TESTDATA / "sf0.01")
    rows = QUERIES["op1_quality_rules"](spark, sf_dir).collect()
    good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").collect()}
    gone = {r.doc_id for r in rows if not r.kept and not r.base_failed}
    assert len(gone) >= 20 and len(gone & good) <= 0.05 * len(good)


def test_grammar_weighs_clauses():
    model = X.ToxicityModel({"clown": (X.INSULT, 1.0), "kill": (X.THREAT, 1.0), "you": (X.TARGET, 0.0),
                             "not": (X.NEGATION, 0.0), "said": (X.REPORT, 0.0)})
    plain, aimed = model.clause("what a clown"), model.clause("you clown")
    assert aimed > plain > model.clause("not a clown") > 0
    assert model.clause("they said clown") < plain
    assert model.clause('the "clown" word') < plain
    assert model.clause("not one of all these a clown") == plain
    assert model.clause("you kill") > model.clause("kill time")
    assert model.features("a fine day. no more") == (0.0, 0.0)
    assert model.features("you clown. a fine day")[0] == aimed


def test_composition_is_the_machines_one_after_another():
    one, two = X.negation(), X.reported()
    both = X.compose(one, two)
    draw = random.Random(2)
    for _ in range(200):
        text = [draw.choice("itgnrq.") for _ in range(8)]
        a, b, c = one.start, two.start, both.start
        for symbol in text:
            (a, p), (b, q), (c, r) = one.step(a, symbol), two.step(b, symbol), both.step(c, symbol)
            assert c == a + b and r == pytest.approx(p * q)


def test_learnt_words_and_stems_are_found_in_held_out_texts(spark):
    draw = random.Random(4)
    words = [f"{a}{b}" for a in "ba ke li mo nu pa ri so tu we".split() for b in "da fe gi ho ju".split()]
    rows, labels = [], []
    for k in range(600):
        text = [draw.choice(words) for _ in range(60)]
        toxic = k % 6 == 0
        if toxic:
            bad = f"zork{draw.choice(words)}" if k % 12 else "blarg"
            text[draw.randrange(60)] = text[draw.randrange(60)] = bad
        rows.append((k, " ".join(text)))
        labels.append((k, int(toxic)))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = X.fit_toxicity(documents, marks)
    assert "zork" in model.stems and "blarg" in model.words
    scored = X.score_toxicity(documents, model).withColumn("held", X.held_out(F.col("doc_id")))
    rest = scored.join(marks, "doc_id").where("held").collect()
    assert len(rest) > 100
    assert sum((r.score >= 0.3) == (r.toxic == 1) for r in rest) >= 0.97 * len(rest)


def test_labels_of_held_out_rows_change_nothing(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    turned = labels.withColumn("toxic", F.when(X.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = X.fit_toxicity(documents, labels), X.fit_toxicity(documents, turned)
    assert (one.words, one.stems, one.coefficients) == (two.words, two.stems, two.coefficients)


def _targets(sizes, weights, limit):
    """Shares by weight; the excess over the limit shared again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, free, found = sum(sizes.values()), set(sizes), {}
    while free:
        total = sum(weight[s] for s in free)
        above = {s for s in free if left * weight[s] > limit * sizes[s] * total}
        if not above:
            return found | {s: left * weight[s] / total for s in free}
        found |= {s: float(limit * sizes[s]) for s in above}
        left -= sum(limit * sizes[s] for s in above)
        free -= above
    return found


def test_targets_are_those_of_sharing_again(spark):
    draw = random.Random(6)
    for n in (1, 2, 7, 20):
        sizes = {f"s{k}": draw.choice([0, 1, 10, 500, 10_000]) for k in range(n)} | {None: 40}
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        found = {r.source: r.target for r in source_targets(frame).collect()}
        assert found == pytest.approx(_targets(sizes, (5, 2, 1), 3))


def test_many_sources_and_ties(spark):
    draw = random.Random(8)
    sizes = {f"s{k:03d}": draw.choice([0, 5, 5, 40, 1000]) for k in range(120)} | {None: 7}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in source_targets(frame, (5, 2, 1), 3).collect()}
    assert found == pytest.approx(_targets(sizes, (5, 2, 1), 3))
    none = spark.createDataFrame([], "source string, source_size long")
    assert source_targets(none).collect() == []


def test_taken_words_come_near_the_targets(spark):
    """Within 5 % or one document of the target, with the same chance for all."""
    draw = random.Random(5)
    rows = [(k, f"s{k % 6}", "w " * int(draw.paretovariate(0.9) * 10 % 5000)) for k in range(1500)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found = {}
    for r in mix_counts(frame).collect():
        source = rows[r.doc_id][1]
        taken, target, largest = found.get(source, (0, 0, 0))
        found[source] = (taken + r.taken, r.target, max(largest, r["size"]))
        assert math.floor(r.target / r.source_size) <= r.copies <= math.ceil(r.target / r.source_size) <= 3
    for taken, target, largest in found.values():
        assert abs(taken - target) <= max(0.05 * target, largest)
    again = {r.doc_id: r.copies for r in mix_counts(frame.repartition(7)).collect()}
    assert again == {r.doc_id: r.copies for r in mix_counts(frame).collect()}


def test_a_copy_is_drawn_with_the_probability_of_the_fraction(spark):
    """At each place and beyond the largest, sources take a copy as often as the fraction says; in all, each near it."""
    frame = spark.range(600).select(F.col("id").cast("string").alias("source"), F.explode(F.sequence(F.lit(1), F.lit(24))).alias("at"))
    key = F.concat("source", F.lit("-"), "at")
    nth = F.when(F.col("at") <= 20, F.col("at"))
    made = frame.withColumn("copies", copies_taken(F.lit(1.3), key, "mix-1", nth, F.col("source")))
    for row in made.groupBy("at").agg(F.avg("copies").alias("mean")).collect():
        assert row["mean"] == pytest.approx(1.3, abs=0.08)
    for row in made.where("at <= 20").groupBy("source").agg(F.sum("copies").alias("taken")).collect():
        assert abs(row.taken - 26) <= 1


def test_mix_emits_what_it_counts(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = {r.doc_id: r.copies for r in mix_counts(documents).collect()}
    emitted = Counter(r.doc_id for r in mix(documents).collect())
    assert emitted == Counter({d: n for d, n in counts.items() if n})


def test_lines_over_the_ratio_go_and_others_stay(spark):
    rows = [("h", f"menu\n \nline {k}\n menu \nrare" if k < 2 else f"menu\n \nline {k}") for k in range(30)]
    rows += [("g", "menu\nx")] * 3 + [("h", None)]
    frame = spark.createDataFrame(rows, "host string, text string")
    found = L.drop_boilerplate(frame, F.col("host"), ratio=0.1, min_pages=20, dropped="n").collect()
    texts = sorted((r.text or "?", r.n) for r in found)
    wanted = [("?", 0)] + [("menu\nx", 0)] * 3
    wanted += [(f" \nline {k}\nrare" if k < 2 else f" \nline {k}", 2 if k < 2 else 1) for k in range(30)]
    assert texts == sorted(wanted)


def test_url_rules_meet_through_their_rarest_token(spark):
    rules = [
        UrlRule("net/", "block", "||net/"),
        UrlRule("long", "allow", "||example.net/en/"),
        UrlRule("wild", "block", "/ads*/x.js"),
        UrlRule("loose", "block", "banner"),
    ]
    urls = [
        "http://example.net/en/1", "https://M.Example.NET/en/", "http://example.net/e", "http://net/", "http://net",
        "http://a.org/adsense/x.js", "http://a.org/ads/y.js", "http://a.org/xbanners?", "http://notexample.net/en/",
        "http://a.org/?u=http://b.net/", "nothing",
    ]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    wanted = {}
    for u in urls:
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", u)
        target = (m[1].lower() + m[2]) if m else ""
        hits = [r for r in rules if re.search(r.regex(), target)]
        wanted[u] = max(hits, key=lambda r: len(r.pattern)).name if hits else None
    for block in (1, 100):
        found = {r.url: r.found.rule if r.found else None for r in judge_urls(frame, rules, block=block).collect()}
        assert found == wanted
    index = rule_index(rules, {"example": 5, "net": 9, "en": 7})
    assert {k: [r.name for r in v] for k, v in index.items()} == {
        "net": ["net/"], "example": ["long"], "": ["wild", "loose"],
    } or index["example"][0].name == "long"


def test_latest_earlier_response_of_a_hot_url(spark):
    draw = random.Random(8)
    rows = [("hot" if draw.random() < 0.7 else f"u{draw.randrange(9)}", draw.randrange(300), k, draw.random() < 0.3)
            for k in range(1500)]
    frame = spark.createDataFrame(rows, "key string, time long, id long, full boolean").repartition(7)
    wanted = {
        i: max(((t2, i2) for k2, t2, i2, f2 in rows if f2 and k2 == k and t2 < t), default=(0, None))[1]
        for k, t, i, full in rows
        if not full
    }
    assert dict(latest_earlier(frame).collect()) == wanted


def test_headers_are_checked_and_merged(spark):
    rows = [
        (1, "http://a/x", 1, "response", {"etag": '"1"', "content-length": "9", "date": "d1"}),
        (2, "https://www.A/x/?utm_source=z", 2, "revisit", {"etag": 'W/"1"', "content-length": "0", "date": "d2"}),
        (3, "http://a/x", 3, "revisit", {"etag": '"2"'}),
        (4, "http://b/x", 3, "revisit", {"date": "d3"}),
    ]
    schema = "record_id long, url string, time long, kind string, headers map<string,string>"
    found = {r.record_id: r for r in resolve_revisits(spark.createDataFrame(rows, schema)).collect()}
    assert (found[2].verdict, found[2].response_id) == ("resolved", 1)
    assert found[2].headers == {"etag": 'W/"1"', "content-length": "9", "date": "d2"}
    assert (found[3].verdict, found[4].verdict) == ("mismatch", "no_response")
