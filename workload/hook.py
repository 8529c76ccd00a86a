"""What the transform and filter texts of a stream can do, one statement each.

Every entry: topics whose views exist, the fragments (or a whole statement),
and the same result written over the source tables.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from workload.fixtures import spliced


@dataclass(frozen=True)
class Hook:
    topics: tuple[str, ...]
    oracle: str
    transform: str = "*"
    where: str = "1=1"
    sql: str | None = None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return spliced(spark, sf_dir, self.topics, self.transform, self.where, self.sql)


HOOKS: dict[str, Hook] = {}


def _hook(name: str, topics: str, oracle: str, **parts: str) -> None:
    HOOKS[name] = Hook(tuple(topics.split()), oracle, **parts)


# -- projection and predicates ------------------------------------------------

_hook(
    "sql_transform_filter",
    "click",
    transform="user_id, value, event_id",
    where="value > 1",
    oracle="SELECT user_id, value, event_id FROM events WHERE event_type = 'click' AND value > 1",
)
_hook(
    "sql_transform_star",
    "view",
    oracle="SELECT event_id, user_id, value, ts, event_type, props FROM events"
    " WHERE event_type = 'view'",
)
_hook(
    "sql_transform_project",
    "lineitem",
    transform="""l_orderkey AS order_id, l_linenumber AS line,
        CASE WHEN l_quantity >= 40 THEN 'big' WHEN l_quantity >= 20 THEN 'mid'
             ELSE 'small' END AS size,
        CAST(l_quantity AS int) * 2 + 1 AS twice, CAST(l_shipdate AS date) AS shipped,
        CAST(l_partkey AS string) AS part_text, -l_linenumber AS neg,
        CAST(CAST(l_extendedprice AS decimal(18,2)) * CAST(l_discount AS decimal(4,2))
             AS double) AS saved""",
    where="l_returnflag = 'R'",
    oracle="""SELECT l_orderkey AS order_id, l_linenumber AS line,
        CASE WHEN l_quantity >= 40 THEN 'big' WHEN l_quantity >= 20 THEN 'mid'
             ELSE 'small' END AS size,
        CAST(l_quantity AS int) * 2 + 1 AS twice, CAST(l_shipdate AS date) AS shipped,
        CAST(l_partkey AS varchar) AS part_text, -l_linenumber AS neg,
        CAST(CAST(l_extendedprice AS decimal(18,2)) * CAST(l_discount AS decimal(4,2))
             AS double) AS saved
        FROM lineitem WHERE l_returnflag = 'R'""",
)
_hook(
    "sql_transform_distinct",
    "lineitem",
    transform="DISTINCT l_returnflag, l_linestatus, CAST(l_quantity AS int) AS quantity",
    oracle="SELECT DISTINCT l_returnflag, l_linestatus, CAST(l_quantity AS int) AS quantity"
    " FROM lineitem",
)
_hook(
    "sql_transform_predicates",
    "orders",
    transform="o_orderkey, o_orderpriority, o_orderstatus",
    where="""(o_orderpriority LIKE '%HIGH' OR o_orderpriority RLIKE '^[45]-')
        AND o_totalprice BETWEEN 1000 AND 300000 AND o_orderstatus IN ('F', 'O')
        AND o_orderdate IS NOT NULL AND NOT (o_custkey % 7 = 0)
        AND o_orderdate >= timestamp_ntz'1993-01-01 00:00:00'""",
    oracle="""SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
        WHERE (o_orderpriority LIKE '%HIGH' OR regexp_matches(o_orderpriority, '^[45]-'))
        AND o_totalprice BETWEEN 1000 AND 300000 AND o_orderstatus IN ('F', 'O')
        AND o_orderdate IS NOT NULL AND NOT (o_custkey % 7 = 0)
        AND o_orderdate >= TIMESTAMP '1993-01-01 00:00:00'""",
)
_hook(
    "sql_transform_tablesample",
    "click",
    sql="""SELECT event_id, user_id FROM TMP_CLICK TABLESAMPLE (100 PERCENT) REPEATABLE (7)""",
    oracle="SELECT event_id, user_id FROM events WHERE event_type = 'click'",
)

# -- joins --------------------------------------------------------------------
# Semi and anti joins test against one row per user, so that no pair of a
# user's clicks and views is ever formed.

_LATER = """(SELECT v.user_id FROM (SELECT user_id, max(ts) AS last_ts FROM TMP_VIEW
    GROUP BY user_id) v WHERE v.user_id = TMP_CLICK.user_id AND v.last_ts > TMP_CLICK.ts)"""
_LATER_ORACLE = """(SELECT 1 FROM events v WHERE v.event_type = 'view'
    AND v.user_id = c.user_id AND v.ts > c.ts)"""
_hook(
    "sql_transform_semi",
    "click view",
    transform="event_id, user_id",
    where=f"EXISTS {_LATER}",
    oracle=f"SELECT event_id, user_id FROM events c WHERE event_type = 'click'"
    f" AND EXISTS {_LATER_ORACLE}",
)
_hook(
    "sql_transform_anti",
    "click view",
    transform="event_id, user_id",
    where=f"NOT EXISTS {_LATER}",
    oracle=f"SELECT event_id, user_id FROM events c WHERE event_type = 'click'"
    f" AND NOT EXISTS {_LATER_ORACLE}",
)
_hook(
    "sql_transform_in_subquery",
    "orders customer",
    transform="o_orderkey, o_custkey",
    where="""o_custkey IN (SELECT c_custkey FROM TMP_CUSTOMER WHERE c_acctbal > 5000)
        AND NOT EXISTS (SELECT 1 FROM TMP_CUSTOMER c
                        WHERE c.c_mktsegment = 'BUILDING' AND c.c_custkey = o_custkey)""",
    oracle="""SELECT o_orderkey, o_custkey FROM orders
        WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)
        AND o_custkey NOT IN (SELECT c_custkey FROM customer
                              WHERE c_mktsegment = 'BUILDING' AND c_custkey IS NOT NULL)""",
)
_hook(
    "sql_transform_join",
    "orders customer",
    sql="""SELECT o.o_orderkey, c.c_name, c.c_mktsegment, o.o_totalprice
        FROM TMP_ORDERS o JOIN TMP_CUSTOMER c ON o.o_custkey = c.c_custkey
        WHERE c.c_mktsegment = 'BUILDING'""",
    oracle="""SELECT o.o_orderkey, c.c_name, c.c_mktsegment, o.o_totalprice
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        WHERE c.c_mktsegment = 'BUILDING'""",
)
_hook(
    "sql_transform_outer_joins",
    "customer orders",
    sql="""WITH bought AS (SELECT o_custkey, count(*) AS n FROM TMP_ORDERS
            WHERE o_orderstatus = 'F' GROUP BY o_custkey),
        rich AS (SELECT c_custkey, c_name FROM TMP_CUSTOMER WHERE c_acctbal > 4000)
        SELECT 'left' AS side, c_custkey, c_name, o_custkey, n
          FROM rich LEFT JOIN bought ON c_custkey = o_custkey
        UNION ALL SELECT 'right', c_custkey, c_name, o_custkey, n
          FROM rich RIGHT JOIN bought ON c_custkey = o_custkey
        UNION ALL SELECT 'full', c_custkey, c_name, o_custkey, n
          FROM rich FULL JOIN bought ON c_custkey = o_custkey""",
    oracle="""WITH bought AS (SELECT o_custkey, count(*) AS n FROM orders
            WHERE o_orderstatus = 'F' GROUP BY o_custkey),
        rich AS (SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 4000)
        SELECT 'left' AS side, c_custkey, c_name, o_custkey, n
          FROM rich LEFT JOIN bought ON c_custkey = o_custkey
        UNION ALL SELECT 'right', c_custkey, c_name, o_custkey, n
          FROM rich RIGHT JOIN bought ON c_custkey = o_custkey
        UNION ALL SELECT 'full', c_custkey, c_name, o_custkey, n
          FROM rich FULL JOIN bought ON c_custkey = o_custkey""",
)
_hook(
    "sql_transform_range_join",
    "lineitem orders",
    sql="""SELECT l.l_orderkey, l.l_linenumber, o.o_orderdate, l.l_shipdate
        FROM TMP_LINEITEM l JOIN TMP_ORDERS o ON l.l_orderkey = o.o_orderkey
        AND l.l_shipdate > o.o_orderdate
        AND l.l_shipdate <= o.o_orderdate + INTERVAL 30 DAYS""",
    oracle="""SELECT l.l_orderkey, l.l_linenumber, o.o_orderdate, l.l_shipdate
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        AND l.l_shipdate > o.o_orderdate
        AND l.l_shipdate <= o.o_orderdate + INTERVAL 30 DAY""",
)
_hook(
    "sql_transform_topic_join",
    "click view",
    transform="user_id, 0L AS clicks, 0L AS views",
    where="""1=0 UNION ALL SELECT c.user_id, c.n, v.n FROM
        (SELECT user_id, count(*) AS n FROM TMP_CLICK GROUP BY user_id) c
        JOIN (SELECT user_id, count(*) AS n FROM TMP_VIEW GROUP BY user_id) v
        ON c.user_id = v.user_id""",
    oracle="""SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS clicks,
        count(*) FILTER (WHERE event_type = 'view') AS views FROM events GROUP BY user_id
        HAVING count(*) FILTER (WHERE event_type = 'click') > 0
        AND count(*) FILTER (WHERE event_type = 'view') > 0""",
)
_HINTED = """SELECT /*+ {hint} */ o.o_orderstatus, c.c_mktsegment, n.n_name, count(*) AS orders
    FROM TMP_ORDERS o JOIN TMP_CUSTOMER c ON o.o_custkey = c.c_custkey
    JOIN TMP_NATION n ON c.c_nationkey = n.n_nationkey
    GROUP BY o.o_orderstatus, c.c_mktsegment, n.n_name"""
_HINTED_ORACLE = """SELECT o_orderstatus, c_mktsegment, n_name, count(*) AS orders
    FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    GROUP BY o_orderstatus, c_mktsegment, n_name"""
# nation has a fixed number of rows, so it may be named for broadcasting
for _name, _hint in (
    ("merge", "MERGE(c), BROADCAST(n)"),
    ("shuffle_hash", "SHUFFLE_HASH(c), BROADCAST(n)"),
):
    _hook(
        f"sql_transform_hint_{_name}",
        "orders customer nation",
        sql=_HINTED.format(hint=_hint),
        oracle=_HINTED_ORACLE,
    )

# -- aggregates ---------------------------------------------------------------

_hook(
    "sql_transform_group",
    "purchase",
    transform="""user_id, count(*) AS n, max(event_id) AS event_id,
        CAST(sum(CAST(value AS decimal(18,2))) AS double) AS spent""",
    where="value > 0 GROUP BY user_id HAVING count(*) > 3",
    oracle="""SELECT user_id, count(*) AS n, max(event_id) AS event_id,
        CAST(sum(CAST(value AS decimal(18,2))) AS double) AS spent
        FROM events WHERE event_type = 'purchase' AND value > 0
        GROUP BY user_id HAVING count(*) > 3""",
)
_hook(
    "sql_transform_global",
    "lineitem",
    transform="""count(*) AS n, count(DISTINCT l_suppkey) AS suppliers,
        count(DISTINCT l_returnflag, l_linestatus) AS flags, min(l_shipdate) AS first_ship,
        max(l_shipdate) AS last_ship,
        CAST(sum(CAST(l_quantity AS decimal(18,2))) AS double) AS quantity,
        abs(approx_count_distinct(l_partkey) - count(DISTINCT l_partkey))
            <= 0.2 * count(DISTINCT l_partkey) AS approx_close""",
    oracle="""SELECT count(*) AS n, count(DISTINCT l_suppkey) AS suppliers,
        count(DISTINCT (l_returnflag, l_linestatus)) AS flags, min(l_shipdate) AS first_ship,
        max(l_shipdate) AS last_ship,
        CAST(sum(CAST(l_quantity AS decimal(18,2))) AS double) AS quantity,
        true AS approx_close FROM lineitem""",
)
_SETS = "o_orderstatus, o_orderpriority, {gid} AS gid, count(*) AS n, max(o_orderkey) AS last_order"
for _name, _tail, _oracle_tail in (
    ("cube", "CUBE (o_orderstatus, o_orderpriority)", "CUBE (o_orderstatus, o_orderpriority)"),
    ("rollup", "ROLLUP (o_orderstatus, o_orderpriority)", "ROLLUP (o_orderstatus, o_orderpriority)"),
    (
        "grouping_sets",
        "GROUPING SETS ((o_orderstatus), (o_orderpriority), ())",
        "GROUPING SETS ((o_orderstatus), (o_orderpriority), ())",
    ),
):
    _hook(
        f"sql_transform_{_name}",
        "orders",
        transform=_SETS.format(gid="CAST(grouping_id(o_orderstatus, o_orderpriority) AS bigint)"),
        where=f"1=1 GROUP BY {_tail}",
        oracle="SELECT "
        + _SETS.format(gid="CAST(grouping_id(o_orderstatus, o_orderpriority) AS bigint)")
        + f" FROM orders GROUP BY {_oracle_tail}",
    )
_hook(
    "sql_transform_collect",
    "orders",
    transform="""o_orderpriority, concat_ws(',', sort_array(collect_set(o_orderstatus))) AS statuses,
        concat_ws(',', sort_array(collect_list(DISTINCT year(o_orderdate)))) AS years,
        round(stddev(o_totalprice), 2) AS spread, round(corr(o_custkey, o_totalprice), 6) AS cor,
        percentile_approx(month(o_orderdate), 0.5, 1000) AS median_month,
        count(*) FILTER (WHERE o_orderstatus = 'F') AS finished,
        max_by(o_orderkey, o_orderkey) AS last_order, first(o_orderpriority) AS first_priority""",
    where="1=1 GROUP BY o_orderpriority",
    oracle="""SELECT o_orderpriority,
        array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS statuses,
        array_to_string(list_sort(list(DISTINCT year(o_orderdate))), ',') AS years,
        round(stddev(o_totalprice), 2) AS spread, round(corr(o_custkey, o_totalprice), 6) AS cor,
        CAST(quantile_disc(month(o_orderdate), 0.5) AS int) AS median_month,
        count(*) FILTER (WHERE o_orderstatus = 'F') AS finished,
        max(o_orderkey) AS last_order, o_orderpriority AS first_priority
        FROM orders GROUP BY o_orderpriority""",
)
_hook(
    "sql_transform_pivot",
    "orders",
    sql="""SELECT * FROM (SELECT o_orderpriority, o_orderstatus, o_orderkey FROM TMP_ORDERS)
        PIVOT (count(o_orderkey) FOR o_orderstatus IN ('F' AS f, 'O' AS o, 'P' AS p))""",
    oracle="""SELECT o_orderpriority,
        nullif(count(*) FILTER (WHERE o_orderstatus = 'F'), 0) AS f,
        nullif(count(*) FILTER (WHERE o_orderstatus = 'O'), 0) AS o,
        nullif(count(*) FILTER (WHERE o_orderstatus = 'P'), 0) AS p
        FROM orders GROUP BY o_orderpriority""",
)
_hook(
    "sql_transform_time_window",
    "click",
    transform="""window(ts, '1 day').start AS day, count(*) AS n, count(DISTINCT user_id) AS users""",
    where="1=1 GROUP BY window(ts, '1 day')",
    oracle="""SELECT date_trunc('day', ts)::TIMESTAMP AS day, count(*) AS n,
        count(DISTINCT user_id) AS users FROM events WHERE event_type = 'click' GROUP BY 1""",
)

# -- windows ------------------------------------------------------------------
# Those over users' whole rows, however busy, are in flows.py: they run by blocks.
_OF_USER = "PARTITION BY user_id ORDER BY event_id"
# A statement may as well have a plain window; Spark then sorts a user's rows of
# the batch in one task, in memory or spilled.
_hook(
    "sql_transform_window_plain",
    "signup",
    transform=f"""event_id, lag(value, 1, 0D) OVER w AS before, lead(value) OVER w AS after, ntile(4) OVER w AS quarter,
        row_number() OVER w AS rn, rank() OVER p AS rnk, dense_rank() OVER p AS dense,
        round(percent_rank() OVER p, 6) AS pct, round(cume_dist() OVER p, 6) AS cume,
        first_value(event_id) OVER w AS first_id,
        last_value(event_id) OVER ({_OF_USER} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS next_id,
        count(*) OVER ({_OF_USER} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS near_rows,
        max(value) OVER ({_OF_USER} RANGE BETWEEN 5000 PRECEDING AND CURRENT ROW) AS recent_best""",
    where=f"1=1 WINDOW w AS ({_OF_USER}), p AS (PARTITION BY user_id ORDER BY CAST(value / 10 AS int))",
    oracle=f"""SELECT event_id, lag(value, 1, 0.0) OVER w AS before, lead(value) OVER w AS after, ntile(4) OVER w AS quarter,
        row_number() OVER w AS rn, rank() OVER p AS rnk, dense_rank() OVER p AS dense,
        round(percent_rank() OVER p, 6) AS pct, round(cume_dist() OVER p, 6) AS cume,
        first_value(event_id) OVER w AS first_id,
        last_value(event_id) OVER (w ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS next_id,
        count(*) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS near_rows,
        max(value) OVER (w RANGE BETWEEN 5000 PRECEDING AND CURRENT ROW) AS recent_best
        FROM events WHERE event_type = 'signup' WINDOW w AS ({_OF_USER}),
        p AS (PARTITION BY user_id ORDER BY CAST(trunc(value / 10) AS int) NULLS FIRST)""",
)

# -- order, limits, sets ------------------------------------------------------

_hook(
    "sql_transform_order_limit",
    "orders",
    transform="o_orderkey, o_totalprice",
    where="o_orderstatus = 'O' ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
    oracle="""SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""",
)
_hook(
    "sql_transform_sort_by",
    "orders",
    transform="o_orderkey, o_custkey",
    where="o_totalprice > 100000 DISTRIBUTE BY o_custkey SORT BY o_orderkey",
    oracle="SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice > 100000",
)
_hook(
    "sql_transform_cluster_by",
    "customer",
    transform="c_custkey, c_name",
    where="c_acctbal > 0 CLUSTER BY c_custkey",
    oracle="SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0",
)
_hook(
    "sql_transform_topk",
    "purchase",
    sql="""SELECT user_id, event_id, value FROM (SELECT user_id, event_id, value,
        row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn
        FROM TMP_PURCHASE) WHERE rn <= 3""",
    oracle="""SELECT user_id, event_id, value FROM (SELECT user_id, event_id, value,
        row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn
        FROM events WHERE event_type = 'purchase') WHERE rn <= 3""",
)
_hook(
    "sql_transform_setop",
    "click view purchase signup",
    transform="user_id, CAST(ts AS date) AS day, 'only_click' AS what",
    where="""value > 100
        EXCEPT SELECT user_id, CAST(ts AS date), 'only_click' FROM TMP_VIEW WHERE value > 100
        UNION ALL SELECT * FROM (SELECT user_id, CAST(ts AS date), 'both' FROM TMP_PURCHASE
            WHERE value > 50 INTERSECT SELECT user_id, CAST(ts AS date), 'both' FROM TMP_SIGNUP
            WHERE value > 50)
        UNION SELECT user_id, CAST(ts AS date), 'any' FROM TMP_SIGNUP WHERE value > 150""",
    oracle="""SELECT * FROM ((SELECT user_id, CAST(ts AS date) AS day, 'only_click' AS what
        FROM events WHERE event_type = 'click' AND value > 100
        EXCEPT SELECT user_id, CAST(ts AS date), 'only_click' FROM events
            WHERE event_type = 'view' AND value > 100)
        UNION ALL SELECT * FROM (SELECT user_id, CAST(ts AS date), 'both' FROM events
            WHERE event_type = 'purchase' AND value > 50
            INTERSECT SELECT user_id, CAST(ts AS date), 'both' FROM events
            WHERE event_type = 'signup' AND value > 50))
        UNION SELECT user_id, CAST(ts AS date), 'any' FROM events
            WHERE event_type = 'signup' AND value > 150""",
)
# -- functions ----------------------------------------------------------------

_hook(
    "sql_functions_string",
    "customer",
    transform="""c_custkey, concat(c_name, '/', c_mktsegment) AS joined,
        concat_ws('-', c_mktsegment, c_name) AS dashed, substring(c_name, 3, 5) AS part,
        lower(c_name) AS low, upper(c_mktsegment) AS up, trim(concat('  ', c_name, ' ')) AS trimmed,
        lpad(CAST(c_custkey AS string), 8, '0') AS padded, rpad(c_mktsegment, 12, '*') AS starred,
        regexp_extract(c_name, '([0-9]+)', 1) AS digits,
        regexp_replace(c_name, '[0-9]', 'N') AS masked, split(c_name, '#')[0] AS head,
        instr(c_mktsegment, 'E') AS at, translate(c_mktsegment, 'AEIOU', '12345') AS code,
        levenshtein(c_mktsegment, 'BUILDING') AS distance, length(c_name) AS len,
        reverse(c_mktsegment) AS backwards, repeat(substring(c_name, 1, 2), 2) AS twice,
        format_string('%s has %d', c_name, c_custkey) AS sentence, initcap(lower(c_mktsegment)) AS cap""",
    oracle="""SELECT c_custkey, concat(c_name, '/', c_mktsegment) AS joined,
        concat_ws('-', c_mktsegment, c_name) AS dashed, substring(c_name, 3, 5) AS part,
        lower(c_name) AS low, upper(c_mktsegment) AS up, trim(concat('  ', c_name, ' ')) AS trimmed,
        lpad(CAST(c_custkey AS varchar), 8, '0') AS padded, rpad(c_mktsegment, 12, '*') AS starred,
        regexp_extract(c_name, '([0-9]+)', 1) AS digits,
        regexp_replace(c_name, '[0-9]', 'N', 'g') AS masked, split_part(c_name, '#', 1) AS head,
        CAST(instr(c_mktsegment, 'E') AS int) AS at, translate(c_mktsegment, 'AEIOU', '12345') AS code,
        CAST(levenshtein(c_mktsegment, 'BUILDING') AS int) AS distance,
        CAST(length(c_name) AS int) AS len,
        reverse(c_mktsegment) AS backwards, repeat(c_name[1:2], 2) AS twice,
        printf('%s has %d', c_name, c_custkey) AS sentence,
        c_mktsegment[1:1] || lower(c_mktsegment[2:]) AS cap FROM customer""",
)
_hook(
    "sql_functions_text",
    "documents",
    transform="""doc_id, length(text) AS len, length(trim(text)) AS trimmed_len,
        md5(lower(text)) AS digest, size(split(text, ' ')) AS words,
        length(regexp_replace(text, '[0-9]', '')) AS without_digits,
        substring(text, -10) AS ending, length(replace(text, 'e', '')) AS without_e,
        instr(text, ' ') AS first_space""",
    oracle="""SELECT doc_id, CAST(length(text) AS int) AS len,
        CAST(length(trim(text)) AS int) AS trimmed_len,
        md5(lower(text)) AS digest, CAST(len(string_split(text, ' ')) AS int) AS words,
        CAST(length(regexp_replace(text, '[0-9]', '', 'g')) AS int) AS without_digits,
        right(text, 10) AS ending, CAST(length(replace(text, 'e', '')) AS int) AS without_e,
        CAST(instr(text, ' ') AS int) AS first_space FROM documents""",
)
_hook(
    "sql_functions_date",
    "orders",
    transform="""o_orderkey, to_date(o_orderdate) AS day, date_format(o_orderdate, 'yyyy/MM') AS month,
        date_add(o_orderdate, 10) AS plus10, datediff(DATE'1998-12-31', o_orderdate) AS days_left,
        trunc(o_orderdate, 'YEAR') AS year_start, add_months(o_orderdate, 2) AS plus2m,
        date_trunc('MONTH', o_orderdate) AS month_start, year(o_orderdate) AS y,
        quarter(o_orderdate) AS q, dayofyear(o_orderdate) AS doy, last_day(o_orderdate) AS last,
        o_orderdate + INTERVAL 1 DAY 2 HOURS AS later, hour(o_orderdate) AS h,
        unix_timestamp(CAST(o_orderdate AS timestamp)) AS epoch,
        to_timestamp_ntz(date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')) AS back,
        CAST(from_utc_timestamp(CAST(o_orderdate AS timestamp), 'UTC') AS timestamp_ntz) AS utc""",
    oracle="""SELECT o_orderkey, CAST(o_orderdate AS date) AS day,
        strftime(o_orderdate, '%Y/%m') AS month,
        CAST(o_orderdate AS date) + 10 AS plus10,
        CAST(DATE '1998-12-31' - CAST(o_orderdate AS date) AS int) AS days_left,
        CAST(date_trunc('year', o_orderdate) AS date) AS year_start,
        CAST(CAST(o_orderdate AS date) + INTERVAL 2 MONTH AS date) AS plus2m,
        CAST(date_trunc('month', o_orderdate) AS timestamp) AS month_start,
        CAST(year(o_orderdate) AS int) AS y, CAST(quarter(o_orderdate) AS int) AS q,
        CAST(dayofyear(o_orderdate) AS int) AS doy, last_day(o_orderdate) AS last,
        o_orderdate + INTERVAL 26 HOUR AS later, CAST(hour(o_orderdate) AS int) AS h,
        CAST(epoch(o_orderdate) AS bigint) AS epoch,
        CAST(date_trunc('second', o_orderdate) AS timestamp) AS back, o_orderdate AS utc
        FROM orders""",
)
_hook(
    "sql_functions_math",
    "lineitem",
    transform="""l_orderkey, l_linenumber, CAST(round(CAST(l_extendedprice AS decimal(18,2)), 1) AS double) AS r,
        bround(2.5 + l_linenumber, 0) AS br, floor(l_extendedprice) AS f, ceil(l_extendedprice) AS c,
        pow(l_linenumber, 2) AS p, round(log10(l_quantity), 9) AS l10, round(ln(l_quantity), 9) AS ln_,
        pmod(-l_linenumber, 3) AS pm, conv(CAST(l_partkey AS string), 10, 16) AS hexed,
        hex(l_suppkey) AS hex2, shiftleft(l_linenumber, 2) AS sl, shiftright(l_orderkey, 1) AS sr,
        l_linenumber & 3 AS band, l_linenumber | 8 AS bor, l_linenumber ^ 5 AS bxor,
        abs(-l_quantity) AS a, sign(l_quantity - 25) AS sg, round(sqrt(l_quantity), 9) AS sq,
        l_orderkey % 5 AS md, l_orderkey DIV 7 AS dv""",
    oracle="""SELECT l_orderkey, l_linenumber, CAST(round(CAST(l_extendedprice AS decimal(18,2)), 1) AS double) AS r,
        CAST(round_even(2.5 + l_linenumber, 0) AS decimal(12,0)) AS br,
        CAST(floor(l_extendedprice) AS bigint) AS f, CAST(ceil(l_extendedprice) AS bigint) AS c,
        pow(l_linenumber, 2) AS p, round(log10(l_quantity), 9) AS l10, round(ln(l_quantity), 9) AS ln_,
        ((-l_linenumber % 3) + 3) % 3 AS pm, upper(to_hex(l_partkey)) AS hexed,
        upper(to_hex(l_suppkey)) AS hex2, l_linenumber * 4 AS sl, l_orderkey // 2 AS sr,
        l_linenumber & 3 AS band, l_linenumber | 8 AS bor, xor(l_linenumber, 5) AS bxor,
        abs(l_quantity) AS a, CAST(sign(l_quantity - 25) AS double) AS sg,
        round(sqrt(l_quantity), 9) AS sq,
        l_orderkey % 5 AS md, l_orderkey // 7 AS dv FROM lineitem""",
)
_hook(
    "sql_functions_conditional",
    "view",
    transform="""event_id, CASE WHEN value > 100 THEN 'high' WHEN value > 10 THEN 'mid' END AS band,
        if(user_id % 2 = 0, 'even', 'odd') AS parity, nullif(user_id, 3) AS not3,
        coalesce(nullif(user_id % 3, 0), -1) AS c, nvl(nullif(user_id % 5, 0), 99L) AS n,
        greatest(user_id, 50) AS g, least(user_id, 50) AS l,
        CASE user_id % 4 WHEN 0 THEN 'zero' WHEN 1 THEN 'one' ELSE 'more' END AS w,
        nvl2(nullif(user_id % 2, 0), 'set', 'unset') AS n2""",
    oracle="""SELECT event_id,
        CASE WHEN value > 100 THEN 'high' WHEN value > 10 THEN 'mid' END AS band,
        CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS parity, nullif(user_id, 3) AS not3,
        coalesce(nullif(user_id % 3, 0), -1) AS c, coalesce(nullif(user_id % 5, 0), 99) AS n,
        greatest(user_id, 50) AS g, least(user_id, 50) AS l,
        CASE user_id % 4 WHEN 0 THEN 'zero' WHEN 1 THEN 'one' ELSE 'more' END AS w,
        CASE WHEN user_id % 2 <> 0 THEN 'set' ELSE 'unset' END AS n2
        FROM events WHERE event_type = 'view'""",
)
_hook(
    "sql_functions_array",
    "conversations",
    transform="""conv_id, turn, size(split(text, ' ')) AS words,
        array_contains(split(text, ' '), 'the') AS has_the,
        array_join(slice(split(text, ' '), 1, 3), '|') AS first3,
        array_join(slice(sort_array(array_distinct(split(text, ' '))), 1, 5), '|') AS sorted5,
        array_join(flatten(array(array(role), slice(split(text, ' '), 1, 2))), '-') AS flat,
        aggregate(transform(split(text, ' '), w -> length(w)), 0, (a, x) -> a + x) AS letters,
        size(filter(split(text, ' '), w -> length(w) > 5)) AS long_words,
        exists(split(text, ' '), w -> w = 'data') AS has_data,
        element_at(split(text, ' '), -1) AS last_word,
        arrays_zip(array(turn, conv_id), array('x', role))[1]['1'] AS zipped""",
    oracle="""SELECT conv_id, turn, CAST(len(string_split(text, ' ')) AS int) AS words,
        list_contains(string_split(text, ' '), 'the') AS has_the,
        array_to_string(string_split(text, ' ')[1:3], '|') AS first3,
        array_to_string(list_sort(list_distinct(string_split(text, ' ')))[1:5], '|') AS sorted5,
        role || '-' || array_to_string(string_split(text, ' ')[1:2], '-') AS flat,
        CAST(list_sum(list_transform(string_split(text, ' '), lambda w: length(w))) AS int)
            AS letters,
        CAST(len(list_filter(string_split(text, ' '), lambda w: length(w) > 5)) AS int)
            AS long_words,
        list_contains(string_split(text, ' '), 'data') AS has_data,
        string_split(text, ' ')[-1] AS last_word, role AS zipped FROM conversations""",
)
_hook(
    "sql_functions_map",
    "purchase",
    transform="""event_id, element_at(map('u', user_id, 'e', event_id), 'u') AS u,
        array_join(map_keys(map(CAST(event_id AS string), 1, 'b', 2)), ',') AS ks,
        aggregate(map_values(map('a', user_id, 'b', event_id)), 0L, (s, x) -> s + x) AS total,
        size(map_concat(map(user_id, 1), map(-1L, 2))) AS both,
        map_from_entries(array(struct('k', user_id)))['k'] AS k,
        map('x', value)['missing'] AS none""",
    oracle="""SELECT event_id, user_id AS u, event_id || ',b' AS ks, user_id + event_id AS total, 2 AS both,
        user_id AS k, CAST(NULL AS double) AS none FROM events WHERE event_type = 'purchase'""",
)
_hook(
    "sql_transform_json",
    "error",
    transform="""event_id, CAST(get_json_object(props, '$.k') AS bigint) AS k,
        from_json(props, 'k bigint').k AS k2, to_json(named_struct('id', event_id)) AS j,
        schema_of_json('{"k": 1}') AS shape,
        from_json(to_json(named_struct('a', named_struct('b', user_id))),
                  'a struct<b: bigint>').a.b AS nested""",
    oracle="""SELECT event_id, CAST(json_extract(props, '$.k') AS bigint) AS k,
        CAST(json_extract(props, '$.k') AS bigint) AS k2, concat('{"id":', event_id, '}') AS j,
        'STRUCT<k: BIGINT>' AS shape, user_id AS nested
        FROM events WHERE event_type = 'error'""",
)
_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
_hook(
    "sql_functions_hash",
    "customer",
    transform="""c_custkey, md5(c_name) AS m, sha1(c_name) AS s1, sha2(c_name, 256) AS s2,
        base64(encode(c_name, 'UTF-8')) AS b64, decode(unbase64(base64(encode(c_name, 'UTF-8'))), 'UTF-8')
        AS back, hex(encode(c_mktsegment, 'UTF-8')) AS hx, crc32(c_mktsegment) AS crc""",
    oracle="""SELECT c_custkey, md5(c_name) AS m, sha1(c_name) AS s1, sha256(c_name) AS s2,
        to_base64(encode(c_name)) AS b64, c_name AS back, hex(encode(c_mktsegment)) AS hx,
        CASE c_mktsegment """
    + " ".join(f"WHEN '{s}' THEN {zlib.crc32(s.encode())}" for s in _SEGMENTS)
    + " END AS crc FROM customer",
)

# -- generators ---------------------------------------------------------------

_hook(
    "sql_transform_explode",
    "conversations",
    transform="conv_id, turn, explode(split(text, ' ')) AS word",
    oracle="SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word FROM conversations",
)
_hook(
    "sql_transform_posexplode",
    "documents",
    transform="doc_id, posexplode(split(text, '\\\\n')) AS (pos, line)",
    oracle="""SELECT doc_id, CAST(unnest(range(len(string_split(text, chr(10))))) AS int) AS pos,
        unnest(string_split(text, chr(10))) AS line FROM documents""",
)
_hook(
    "sql_transform_stack",
    "view",
    transform="event_id, stack(2, 'user', user_id, 'twice', user_id * 2) AS (what, amount)",
    oracle="""SELECT event_id, 'user' AS what, user_id AS amount FROM events WHERE event_type = 'view'
        UNION ALL SELECT event_id, 'twice', user_id * 2 FROM events WHERE event_type = 'view'""",
)
_hook(
    "sql_transform_inline",
    "click",
    transform="event_id, inline(array(struct(1 AS n, user_id AS u), struct(2 AS n, -user_id AS u)))",
    oracle="""SELECT event_id, 1 AS n, user_id AS u FROM events WHERE event_type = 'click'
        UNION ALL SELECT event_id, 2, -user_id FROM events WHERE event_type = 'click'""",
)
_hook(
    "sql_transform_json_tuple",
    "signup",
    transform="event_id, json_tuple(props, 'k', 'absent') AS (k, absent)",
    oracle="""SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS varchar) AS absent
        FROM events WHERE event_type = 'signup'""",
)
