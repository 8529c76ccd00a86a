"""The registered queries of the corpus operators, with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.clusters import cluster
from millrace.llm.decontamination import contaminated
from millrace.llm.extraction import extract_text
from millrace.llm.lines import drop_boilerplate
from millrace.llm.mixing import LARGEST, mix_counts
from millrace.llm.neardup import NearDup, near_duplicates
from millrace.llm.neighbours import Scan, nearest_neighbours
from millrace.llm.prefixes import prefix_trie
from millrace.llm.quality import RULES, judge_quality
from millrace.llm.tokens import token_totals
from millrace.llm.toxicity import fit_toxicity, held_out, score_toxicity
from millrace.llm.urls import UrlRule, judge_urls
from millrace.llm.warc import TRACKING, resolve_revisits


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# --- 1: quality -----------------------------------------------------------------------


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdicts; policies by language, at most 5 % of good documents lost in each."""
    judged = judge_quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def _op1_sql() -> str:
    paths = [[(r, c) for r in (*RULES[k:], *RULES[:k]) for c in sorted(r.cutoffs, reverse=True)] for k in range(len(RULES))]
    steps = len(paths[0])
    firsts = ", ".join(
        f"CASE {' '.join(f'WHEN {r.measure} > {c}::DOUBLE THEN {step}' for step, (r, c) in enumerate(path, 1))} ELSE {steps + 1} END"
        for path in paths
    )
    return rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents
), cut AS (
  SELECT r, doc_id, lang, t, regexp_extract_all(t, '[^ 	-
]+') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS lines FROM texts
), windows AS (
  SELECT r, i, words[i:i + 4] AS piece FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM cut)
), twice AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, piece) > 1
), repeated AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r
), measured AS (
  SELECT c.r, doc_id, lang, t, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS BIGINT) AS n_upper,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM cut c LEFT JOIN repeated USING (r)
), based AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured
), marks AS (
  SELECT doc_id, min(quality) = 1 AS good FROM labels GROUP BY doc_id
), holdout AS (
  SELECT lang, md5(t) AS digest, bool_and(good) AS good, any_value(columns(b.* EXCLUDE (r, doc_id, lang, t, base_failed)))
  FROM based b JOIN marks USING (doc_id) WHERE NOT base_failed GROUP BY lang, md5(t)
), tried AS (
  SELECT lang, good, unnest(range(0, {len(paths)})) AS path, unnest([{firsts}]) AS first FROM holdout WHERE good IS NOT NULL
), strata AS (SELECT count(DISTINCT coalesce(lang, '?null')) AS strata FROM tried
), counts AS (
  SELECT lang, path, step, count(*) FILTER (WHERE good) AS n, count(*) FILTER (WHERE good AND first <= step) AS k,
         count(*) FILTER (WHERE NOT good AND first <= step) AS bad
  FROM tried, range(1, {steps + 1}) t(step) GROUP BY ALL
), tails AS (
  SELECT *, CASE WHEN n = 0 OR k > n * 0.05::DOUBLE THEN 1 ELSE
    list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
             + i * ln(0.05::DOUBLE) + (n - i) * ln(1 - 0.05::DOUBLE)))) END AS tail
  FROM counts
), walked AS (
  SELECT *, max(tail) OVER (PARTITION BY lang, path ORDER BY step) AS worst FROM tails
), chosen AS (
  SELECT lang, arg_max(struct_pack(path := path, step := step), struct_pack(g := bad - k, s := -step, p := -path)) AS best
  FROM walked, strata WHERE worst <= 0.05 / (strata * {len(paths)}) AND bad > k GROUP BY lang
), failed AS (
  SELECT b.r FROM based b JOIN chosen c ON b.lang IS NOT DISTINCT FROM c.lang
  WHERE [{firsts}][c.best.path + 1] <= c.best.step
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND f.r IS NULL AS kept
FROM based b LEFT JOIN failed f ON b.r = f.r
"""


# --- 2: main text ---------------------------------------------------------------------


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = extract_text(_read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


# --- 3: lines -------------------------------------------------------------------------

LINE_RATIO, LINE_MIN_PAGES = 0.1, 20
#: Lines on more than 2 % of a source's texts, and on 10 of them, go too where they stand among other text.
LINE_RARE = (0.02, 10)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source, which stands for the host; copies count once."""
    documents = _read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return drop_boilerplate(
        documents,
        F.col("source"),
        ratio=LINE_RATIO,
        min_pages=LINE_MIN_PAGES,
        dropped="n_dropped",
        copies=False,
        rare=LINE_RARE,
    ).select("doc_id", "source", "text", "n_dropped")


OP3_SQL = rf"""
WITH pages AS (
  SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents
), lines AS (
  SELECT r, source, text, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM pages
), keyed AS (
  SELECT *, nullif(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), '') AS bare FROM lines
), totals AS (SELECT source, count(*) AS pages FROM (SELECT DISTINCT source, text FROM pages) GROUP BY source
), counts AS (
  SELECT source, bare, count(DISTINCT text) AS having_it FROM keyed WHERE bare IS NOT NULL GROUP BY ALL
), open AS (
  SELECT c.source, c.bare, t.pages,
         t.pages >= {LINE_MIN_PAGES} AND c.having_it > t.pages * CAST({LINE_RATIO} AS DOUBLE) AS often
  FROM counts c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
  WHERE c.having_it > 1 AND (t.pages >= {LINE_MIN_PAGES} AND c.having_it > t.pages * CAST({LINE_RATIO} AS DOUBLE)
                             OR c.having_it >= {LINE_RARE[1]} AND c.having_it > t.pages * CAST({LINE_RARE[0]} AS DOUBLE))
), held AS (
  SELECT k.r, k.source, k.text, o.bare, sum(length(k.line)) OVER (PARTITION BY k.r) AS on_them
  FROM keyed k JOIN open o ON k.bare = o.bare AND k.source IS NOT DISTINCT FROM o.source
), among AS (
  SELECT source, bare, count(DISTINCT text) AS among FROM held WHERE 2 * on_them <= length(text) GROUP BY ALL
), boiler AS (
  SELECT o.source, o.bare FROM open o LEFT JOIN among a ON o.bare = a.bare AND o.source IS NOT DISTINCT FROM a.source
  WHERE often OR a.among >= {LINE_RARE[1]} AND a.among > o.pages * CAST({LINE_RARE[0]} AS DOUBLE)
), judged AS (
  SELECT k.*, b.bare IS NOT NULL AS gone
  FROM keyed k LEFT JOIN boiler b ON k.bare = b.bare AND k.source IS NOT DISTINCT FROM b.source
), rebuilt AS (
  SELECT r, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
         count(*) FILTER (WHERE gone) AS n_dropped FROM judged GROUP BY r
)
SELECT p.doc_id, p.source, CASE WHEN p.text IS NULL THEN NULL ELSE b.text END AS text,
       coalesce(b.n_dropped, 0) AS n_dropped
FROM pages p LEFT JOIN rebuilt b USING (r)
"""


# --- 4: mixing ------------------------------------------------------------------------

MIX_WEIGHTS, MIX_LIMIT, MIX_SEED = (5, 2, 1), 3, "mix-1"


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of all documents takes of each."""
    return mix_counts(_read(spark, sf_dir, "documents"), MIX_WEIGHTS, MIX_LIMIT, MIX_SEED)


def mixing_sql(documents: str) -> str:
    """Common table expressions that end in ``mixed``: the documents' rows, size and copies."""
    first, second, third = MIX_WEIGHTS
    return rf"""
sized AS (
  SELECT *, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         coalesce(CAST(doc_id AS VARCHAR), md5(text), '') AS draw_key FROM {documents}
), per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN {first} WHEN 1 THEN {second} ELSE {third} END AS w FROM per_source
), capped AS (
  SELECT a.source, a.source_size, a.w,
         coalesce(sum({MIX_LIMIT} * b.source_size) FILTER (WHERE b.source_size * a.w < a.source_size * b.w), 0) AS used,
         coalesce(sum(b.w) FILTER (WHERE b.source_size * a.w < a.source_size * b.w), 0) AS used_w,
         sum(b.source_size) AS whole, sum(b.w) AS whole_w
  FROM weighed a, weighed b GROUP BY a.source, a.source_size, a.w
), marked AS (
  SELECT *, w * (whole - used) > {MIX_LIMIT} * source_size * (whole_w - used_w) AS above FROM capped
), rest AS (
  SELECT any_value(whole) - coalesce(sum({MIX_LIMIT} * source_size) FILTER (WHERE above), 0) AS left_size,
         any_value(whole_w) - coalesce(sum(w) FILTER (WHERE above), 0) AS left_w FROM marked
), targets AS (
  SELECT source, source_size,
         CASE WHEN above THEN CAST({MIX_LIMIT} * source_size AS DOUBLE)
              ELSE CAST(w * left_size AS DOUBLE) / CAST(left_w AS DOUBLE) END AS target
  FROM marked, rest
), drawn AS (
  SELECT s.*, t.source_size, t.target,
         CASE WHEN t.source_size = 0 THEN 0 ELSE t.target / CAST(t.source_size AS DOUBLE) END AS rate,
         CAST('0x' || substr(md5('{MIX_SEED}:' || draw_key), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u,
         CAST('0x' || substr(md5('{MIX_SEED}:start:' || coalesce(s.source, '')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS v
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), placed AS (
  SELECT *, rate - floor(rate) AS part, row_number() OVER (PARTITION BY source ORDER BY size DESC, u, draw_key) AS own
  FROM drawn
), rated AS (
  SELECT *, min(own) OVER (PARTITION BY source, draw_key) AS nth FROM placed
), mixed AS (
  SELECT *, CAST(floor(rate) AS BIGINT) + CASE WHEN
    CASE WHEN nth <= {LARGEST} THEN floor(nth * part + v) > floor((nth - 1) * part + v) ELSE u < part END
    THEN 1 ELSE 0 END AS copies FROM rated
)"""


OP4_SQL = f"""WITH {mixing_sql("documents")}
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM mixed
"""


# --- 5: near-duplicates ---------------------------------------------------------------


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles are at least 85 % alike."""
    return near_duplicates(_read(spark, sf_dir, "documents"), NearDup(width=3, percent=85))


# --- 6: tokens ------------------------------------------------------------------------

TOKENIZER, TOKEN_LIMIT = "byte_bpe_50k.json", 1024


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document, and where the longest prefix within the limit ends."""
    documents = _read(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_totals(documents, public_tokenizers.path(TOKENIZER), TOKEN_LIMIT)
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), "fit_chars"
    )


# --- 7: URLs --------------------------------------------------------------------------

#: The host and path rules that queries report, then the patterns
#: of advertising and tracking that decide where none of those fits.
HOST_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
BLOCK_PATTERNS = (
    "||ads.", "||ad.", "||ads-track.", "||track.", "||tracker.", "||tracking.", "||banner.", "||banners.",
    "||doubleclick.", "||adserver.", "||adservice.", "||pixel.", "||popads.", "||analytics.",
    "/ads/", "/ad/", "/adserver/", "/banner/", "/banners/", "/track/", "/tracking/", "/pixel/", "/popup/", "/sponsored/",
)


def url_rules() -> list[UrlRule]:
    fixed = [UrlRule(name, verdict, f"||{name}", rank=1) for name, verdict in HOST_RULES]
    return fixed + [UrlRule(p, "block", p) for p in BLOCK_PATTERNS]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    judged = judge_urls(_read(spark, sf_dir, "pages").select("page_id", "url"), url_rules())
    named = F.col("found.rank") == 1
    return judged.select(
        "page_id",
        "host",
        "path",
        F.when(named, F.col("found.rule")).alias("rule"),
        F.coalesce(F.col("found.verdict"), F.lit("allow")).alias("verdict"),
    )


def _op7_sql() -> str:
    rules = ", ".join(
        f"('{n}', '{v}', '{n.split('/', 1)[0]}', '/{n.split('/', 1)[1]}')" for n, v in HOST_RULES
    )
    tests = " OR ".join(
        f"target LIKE '{p[2:]}%' OR host LIKE '%.{p[2:]}%'" if p.startswith("||") else f"contains(target, '{p}')"
        for p in BLOCK_PATTERNS
    )
    return rf"""
WITH split AS (
  SELECT page_id, row_number() OVER () AS r,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages
), rules(rule, verdict, rule_host, rule_path) AS (VALUES {rules}
), fits AS (
  SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM split JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY r
)
SELECT page_id, host, path, f.rule,
       coalesce(f.verdict, CASE WHEN {tests} THEN 'block' ELSE 'allow' END) AS verdict
FROM (SELECT *, host || path AS target FROM split) s LEFT JOIN fits f USING (r)
"""


# --- 8: WARC --------------------------------------------------------------------------

_TAG = """concat('"', substr(md5(concat(html, '{0}')), 1, 16), '"')"""
#: The captures of a page: a full response, a revisit with its tag, one with the
#: tag made weak, then for every third page a changed response and otherwise a
#: revisit with the changed tag, and last a revisit with the changed tag. The
#: first response of every tenth page is missing.
_CAPTURES = f"""
SELECT page_id * 5 + k AS record_id,
       CASE WHEN k % 2 = 0 THEN url ELSE concat(replace(url, 'https://', 'http://'), '#c') END AS url,
       page_id % 1000 + k * 100000 AS time,
       CASE WHEN k = 0 OR k = 3 AND page_id % 3 = 0 THEN 'response' ELSE 'revisit' END AS kind,
       CASE k WHEN 0 THEN {_TAG.format("")} WHEN 1 THEN {_TAG.format("")}
              WHEN 2 THEN concat('W/', {_TAG.format("")}) ELSE {_TAG.format("new")} END AS etag,
       CAST(length(html) AS string) AS content_length,
       concat('max-age=', CAST(k AS string)) AS cache_control
FROM pages_at WHERE NOT (k = 0 AND page_id % 10 = 9)
"""


def captures(pages: DataFrame) -> DataFrame:
    """Capture records with headers, made from the pages."""
    at = pages.select("page_id", "url", "html", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("k"))
    made = pages.sparkSession.sql(_CAPTURES.replace("pages_at", "{pages_at}"), pages_at=at)
    names = ("etag", "content_length", "cache_control")
    entries = [e for n in names for e in (F.lit(n.replace("_", "-")), F.col(n))]
    return made.select("record_id", "url", "time", "kind", F.create_map(*entries).alias("headers"))


def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The response of every not-modified capture of the pages, with merged headers."""
    found = resolve_revisits(captures(_read(spark, sf_dir, "pages").select("page_id", "url", "html")))
    header = lambda n: F.col("headers")[n]
    return found.select(
        "record_id",
        "key",
        "response_id",
        "verdict",
        header("etag").alias("etag"),
        header("cache-control").alias("cache_control"),
        header("content-length").alias("content_length"),
    )


OP8_SQL = rf"""
WITH pages_at AS (SELECT page_id, url, html, unnest(range(0, 5)) AS k FROM pages
), records AS ({_CAPTURES}
), bare AS (
  SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', '', 's'), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS b FROM records
), parts AS (
  SELECT *, regexp_replace(lower(regexp_extract(b, '^[^/?]*')), '^www\.|:(80|443)$', '', 'g') AS host,
         regexp_replace(regexp_extract(b, '^[^/?]*([^?]*)', 1, 's'), '/+$', '') AS path,
         list_sort(list_filter(string_split(regexp_extract(b, '^[^?]*\?(.*)$', 1, 's'), '&'),
           lambda p: p <> '' AND NOT regexp_matches(p, '^({TRACKING})(=|$)'))) AS params FROM bare
), keyed AS (
  SELECT *, host || path || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS key FROM parts
), found AS (
  SELECT v.record_id, max(struct_pack(t := r.time, id := r.record_id)) AS best
  FROM keyed v JOIN keyed r ON v.key = r.key AND r.time < v.time WHERE v.kind = 'revisit' AND r.kind = 'response' GROUP BY 1
), joined AS (
  SELECT v.*, f.best.id AS response_id, r.etag AS old_etag, r.content_length AS old_length,
         CASE WHEN f.best IS NULL THEN 'no_response'
              WHEN regexp_replace(v.etag, '^W/', '') = regexp_replace(r.etag, '^W/', '') THEN 'resolved'
              ELSE 'mismatch' END AS verdict
  FROM keyed v LEFT JOIN found f USING (record_id) LEFT JOIN keyed r ON r.record_id = f.best.id WHERE v.kind = 'revisit'
)
SELECT record_id, key, response_id, verdict, etag, cache_control,
       CASE WHEN verdict = 'resolved' THEN old_length ELSE content_length END AS content_length
FROM joined
"""


# --- 9: toxicity ----------------------------------------------------------------------

TOXIC_FROM = 0.3


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, by a model that saw no held-out label."""
    documents = _read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(documents, _read(spark, sf_dir, "labels"))
    return score_toxicity(documents, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


# --- 10: decontamination --------------------------------------------------------------


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items of which they hold a passage."""
    return contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


# --- 11: nearest neighbours -----------------------------------------------------------

NEIGHBOURS = Scan(neighbours=10)


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest embeddings found for every hundredth id."""
    embeddings = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest_neighbours(embeddings, F.col("vec_id") % 100 == 0, NEIGHBOURS)


# --- 12: conversation prefixes --------------------------------------------------------


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations."""
    return prefix_trie(_read(spark, sf_dir, "conversations"))


OP12_SQL = r"""
WITH crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda x, k:
                CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v FROM range(256) r(i))
), own AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), lists AS (
  SELECT c, list(struct_pack(role := role, text := text)
                 ORDER BY turn NULLS FIRST, substr(sha256(length(role) || ':' || role || text), 1, 32)) AS turns
  FROM own GROUP BY c
), hashed AS (
  SELECT *, c - c % 20 AS base, xor(4294967295, list_reduce(
              list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
              lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) % 4 AS h
  FROM lists, crc
), built AS (
  SELECT o.c, list_concat(coalesce(b.turns, [])[1:o.h], o.turns[o.h + 1:]) AS turns
  FROM hashed o LEFT JOIN lists b ON b.c = o.base
), prefixes AS (
  SELECT c, len(turns) AS whole, d, turns[1:d] AS p FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM built)
), nodes AS (
  SELECT p, d, min(c) AS conv, count(*) AS n,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE whole = d), '')) AS ends
  FROM prefixes GROUP BY p, d
), children AS (SELECT p[1:d - 1] AS p, count(*) AS children FROM nodes WHERE d > 0 GROUP BY 1
), weighed AS (
  SELECT n.*, coalesce(k.children, 0) AS children,
         CASE WHEN d = 0 THEN 0 ELSE (n - 1) * len(regexp_extract_all(p[d].text, '[^ 	-
]+')) END AS saved
  FROM nodes n LEFT JOIN children k USING (p)
), sums AS (
  SELECT p[1:k] AS p, count(*) FILTER (WHERE children = 0) AS leaves, sum(saved) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM weighed) GROUP BY 1
)
SELECT w.conv AS conv_id, w.d AS depth, a.conv AS parent_conv_id, w.n AS n_convs, w.children AS n_children,
       s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, w.ends AS ends_sha256
FROM weighed w JOIN sums s ON s.p = w.p LEFT JOIN nodes a ON w.d > 0 AND a.p = w.p[1:w.d - 1]
"""


# --- 13: centroid clustering ----------------------------------------------------------

CLUSTERS, CLUSTER_ROUNDS, CLUSTER_SCALE, CLUSTER_WIDTH, CLUSTER_SEED = 8, 10, 1024, 64, "3"


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of the embeddings after ten rounds over whole numbers."""
    return cluster(
        _read(spark, sf_dir, "embeddings"), CLUSTERS, CLUSTER_ROUNDS, CLUSTER_SCALE, CLUSTER_WIDTH, CLUSTER_SEED
    )


def _op13_sql() -> str:
    rounds = "".join(
        f"""
), p{i} AS MATERIALIZED (
  SELECT r, any_value(v) AS v, min(struct_pack(d := {_SQUARES}, n := n)) AS best FROM kept, c{i - 1} GROUP BY r
), m{i} AS (
  SELECT n, list((s - ((s % k) + k) % k) // k ORDER BY pos) AS c FROM (
    SELECT best.n AS n, pos, sum(v[pos]) AS s, count(*) AS k FROM p{i}, range(1, {CLUSTER_WIDTH + 1}) t(pos) GROUP BY ALL
  ) GROUP BY n
), c{i} AS MATERIALIZED (SELECT n, coalesce(m.c, b.c) AS c FROM c{i - 1} b LEFT JOIN m{i} m USING (n)"""
        for i in range(1, CLUSTER_ROUNDS + 1)
    )
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor({CLUSTER_SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {CLUSTER_WIDTH}
   AND len(list_filter(embedding, lambda x: isfinite(coalesce(x, 'nan')))) = {CLUSTER_WIDTH}
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{CLUSTER_SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS n, v AS c
  FROM kept QUALIFY n < {CLUSTERS}{rounds}
), placed AS (
  SELECT r, any_value(vec_id) AS vec_id, min(struct_pack(d := {_SQUARES}, n := n)) AS best
  FROM kept, c{CLUSTER_ROUNDS} GROUP BY r
)
SELECT vec_id, CAST(best.n AS INTEGER) AS cluster, best.d AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.n) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM placed JOIN c{CLUSTER_ROUNDS} ON n = best.n
"""


_SQUARES = f"CAST(list_sum(list_transform(range(1, {CLUSTER_WIDTH + 1}), lambda i: (v[i] - c[i]) * (v[i] - c[i]))) AS BIGINT)"


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_html_extraction": op2_html_extraction,
    "op3_line_dedup": op3_line_dedup,
    "op4_mixing": op4_mixing,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_url_filter": op7_url_filter,
    "op8_warc_revisits": op8_warc_revisits,
    "op9_toxicity": op9_toxicity,
    "op10_decontamination": op10_decontamination,
    "op11_neighbours": op11_neighbours,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_clusters": op13_clusters,
}
ORACLES = {
    "op1_quality_rules": _op1_sql(),
    "op3_line_dedup": OP3_SQL,
    "op4_mixing": OP4_SQL,
    "op7_url_filter": _op7_sql(),
    "op8_warc_revisits": OP8_SQL,
    "op12_conversation_trie": OP12_SQL,
    "op13_clusters": _op13_sql(),
}
