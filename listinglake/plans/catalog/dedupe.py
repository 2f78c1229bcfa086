"""Deduplication, numbering, page runs and request yields."""

from __future__ import annotations

from pyspark.sql import functions as F

from listinglake.functions.text import fold
from listinglake.operators import requests
from listinglake.operators.arrival import first_arrivals
from listinglake.operators.numbering import dense_keys
from listinglake.operators.ranking import latest_on_two_keys, latest_per_key
from listinglake.plans.catalog.registry import query, second, table


@query(
    "latest_per_key",
    """
    SELECT user_id, event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS r
          FROM events)
    WHERE r = 1
    """,
)
def newest_per_user(spark, tables):
    events = table(spark, tables, "events").select("user_id", "event_id", "event_type", "ts")
    newest = latest_per_key(events, ["user_id"], "ts", ["event_id"])
    return newest.select("user_id", "event_id", "event_type", second("ts"))


@query(
    "dedupe_two_keys",
    """
    WITH newest AS (
        SELECT *, row_number() OVER (PARTITION BY o_custkey
                                     ORDER BY o_orderdate DESC, o_orderkey) AS r
        FROM orders),
    pairs AS (
        SELECT *, row_number() OVER (PARTITION BY o_orderpriority, o_orderdate
                                     ORDER BY o_orderdate DESC, o_custkey) AS p
        FROM newest WHERE r = 1)
    SELECT o_custkey, o_orderkey, o_orderpriority,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate
    FROM pairs WHERE p = 1
    """,
)
def dedupe_two_keys(spark, tables):
    orders = table(spark, tables, "orders").select(
        "o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate"
    )
    deduped = latest_on_two_keys(
        orders, "o_custkey", ["o_orderpriority", "o_orderdate"], "o_orderdate", ["o_orderkey"]
    )
    return deduped.select("o_custkey", "o_orderkey", "o_orderpriority", second("o_orderdate"))


# The rows that stay, walked one by one in arrival order: a fold over the whole list.
GREEDY = """
    rows_in_order AS (
        SELECT list({'ids': [id], 'pairs': [pair], 'kept': [arrival]} ORDER BY arrival) AS rows
        FROM edges),
    walked AS (
        SELECT list_reduce(rows, lambda done, row:
            CASE WHEN list_contains(done.ids, row.ids[1])
                   OR list_contains(done.pairs, row.pairs[1]) THEN done
            ELSE {'ids': list_concat(done.ids, row.ids),
                  'pairs': list_concat(done.pairs, row.pairs),
                  'kept': list_concat(done.kept, row.kept)} END) AS state
        FROM rows_in_order),
    stays AS (SELECT unnest(state.kept) AS arrival FROM walked)
"""

EVENT_EDGES = """
    edges AS (
        SELECT user_id AS id, lower(event_type) || '|' || props AS pair, event_id AS arrival
        FROM events)
"""


def _kept_events(spark, tables):
    events = table(spark, tables, "events").select("event_id", "user_id", "event_type", "props")
    return first_arrivals(
        events, F.col("user_id"), [fold(F.col("event_type")), F.col("props")], F.col("event_id")
    )


@query(
    "greedy_dedupe",
    f"""
    WITH {EVENT_EDGES}, {GREEDY}
    SELECT event_id, user_id, event_type, props
    FROM events WHERE event_id IN (SELECT arrival FROM stays)
    """,
)
def greedy_dedupe(spark, tables):
    return _kept_events(spark, tables)


# Neighbouring events share an id or a pair by turns, and arrive in the order of a hash. An
# edge of such a chain stays if on both sides an even number of edges leads down to the
# next local minimum of the arrivals.
_CHAIN_ARRIVAL = "CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 12) AS BIGINT)"


@query(
    "greedy_chain",
    f"""
    WITH edges AS (SELECT event_id, {_CHAIN_ARRIVAL} AS arrival FROM events),
    steps AS (
        SELECT *, lag(event_id) OVER w IS DISTINCT FROM event_id - 1
                  OR lag(arrival) OVER w > arrival AS from_left,
               lead(event_id) OVER w IS DISTINCT FROM event_id + 1
                  OR lead(arrival) OVER w > arrival AS from_right
        FROM edges WINDOW w AS (ORDER BY event_id)),
    runs AS (
        SELECT *, sum(from_left::INT) OVER (ORDER BY event_id) AS up,
               sum(from_right::INT) OVER (ORDER BY event_id DESC) AS down
        FROM steps),
    places AS (
        SELECT event_id, row_number() OVER (PARTITION BY up ORDER BY event_id) AS l,
               row_number() OVER (PARTITION BY down ORDER BY event_id DESC) AS r
        FROM runs)
    SELECT event_id FROM places WHERE l % 2 = 1 AND r % 2 = 1
    """,
)
def greedy_chain(spark, tables):
    """One chain of conflicts over all events, settled in distributed rounds."""
    events = table(spark, tables, "events").select("event_id")
    digits = F.substring(F.md5(F.col("event_id").cast("string").cast("binary")), 1, 12)
    return first_arrivals(
        events,
        F.floor(F.col("event_id") / 2),
        [F.floor((F.col("event_id") + 1) / 2)],
        F.conv(digits, 16, 10).cast("bigint"),
    )


@query(
    "attempt_yield",
    f"""
    WITH {EVENT_EDGES}, {GREEDY},
    kept AS (SELECT * FROM events WHERE event_id IN (SELECT arrival FROM stays)),
    manifest AS (
        SELECT DISTINCT user_id, event_type,
               CASE WHEN user_id % 7 = 0 THEN 'failed' END AS error
        FROM events)
    SELECT m.user_id, m.event_type, coalesce(m.error, '') AS error,
           CASE WHEN m.error IS NULL THEN CAST(count(k.event_id) AS VARCHAR) ELSE '' END AS added
    FROM manifest m
    LEFT JOIN kept k ON k.user_id = m.user_id AND k.event_type = m.event_type
    GROUP BY m.user_id, m.event_type, m.error
    """,
)
def attempt_yield(spark, tables):
    """Rows newly kept per request; a request is one user and event type."""
    attempts = _attempts(spark, tables)
    return attempts.select(
        "user_id",
        "event_type",
        F.coalesce("error", F.lit("")).alias("error"),
        F.coalesce(F.col("added").cast("string"), F.lit("")).alias("added"),
    )


def _attempts(spark, tables):
    failed = F.when(F.col("user_id") % 7 == 0, F.lit("failed"))
    manifest = (
        table(spark, tables, "events")
        .select("user_id", "event_type")
        .distinct()
        .withColumn("error", failed)
    )
    return requests.request_yield(
        manifest, _kept_events(spark, tables), ["user_id", "event_type"]
    )


@query(
    "attempt_tally",
    f"""
    WITH {EVENT_EDGES}, {GREEDY},
    kept AS (SELECT * FROM events WHERE event_id IN (SELECT arrival FROM stays))
    SELECT (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events)) AS calls,
           (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events)
            WHERE user_id % 7 = 0) AS failures,
           (SELECT count(*) FROM kept WHERE user_id % 7 <> 0) AS kept
    """,
)
def attempt_tally(spark, tables):
    return requests.tally(_attempts(spark, tables))


@query(
    "dense_keys",
    """
    SELECT 'part' AS kind, CAST(row_number() OVER (ORDER BY name) AS INTEGER) AS id, name
    FROM (SELECT DISTINCT p_name AS name FROM part)
    UNION ALL
    SELECT 'customer', CAST(row_number() OVER (ORDER BY name) AS INTEGER), name
    FROM (SELECT DISTINCT c_name AS name FROM customer)
    """,
)
def number_names(spark, tables):
    def numbered(kind, name):
        rows = table(spark, tables, kind).select(F.col(name).alias("name"))
        return dense_keys(rows, "name", "id").frame.select(
            F.lit(kind).alias("kind"), "id", "name"
        )

    return numbered("part", "p_name").unionByName(numbered("customer", "c_name"))


def prefix_sql(bound: int | None) -> str:
    within = f"AND page <= {bound}" if bound else ""
    return f"""
    WITH pages AS (
        SELECT event_id, user_id AS run, 1 + event_id % 43 AS page,
               event_type <> 'error' AS ok, CAST(round(value) AS BIGINT) AS entries,
               props <> '{{"k": 7}}' AS has_next
        FROM events),
    used AS (SELECT * FROM pages WHERE page >= 1 {within}),
    leads AS (
        SELECT run, page, row_number() OVER (PARTITION BY run ORDER BY page) AS n
        FROM used GROUP BY run, page HAVING bool_or(ok AND entries > 0 AND has_next)),
    stops AS (
        SELECT r.run, 1 + count(l.page) AS stop
        FROM (SELECT DISTINCT run FROM used) r
        LEFT JOIN leads l ON l.run = r.run AND l.page = l.n
        GROUP BY r.run)
    SELECT p.event_id, p.run, p.page
    FROM used p JOIN stops s ON p.run = s.run
    WHERE p.ok AND p.page <= s.stop
    """


def _landed_pages(spark, tables):
    """Events as landed pages: one run per user, errors as failed pages."""
    return table(spark, tables, "events").select(
        "event_id",
        F.col("user_id").alias("run"),
        (F.col("event_id") % 43 + 1).alias("page"),
        (F.col("event_type") != "error").alias("ok"),
        F.round("value").cast("bigint").alias("entries"),
        (F.col("props") != '{"k": 7}').alias("has_next"),
    )


@query("page_prefix", prefix_sql(None))
def page_prefix(spark, tables):
    pages = _landed_pages(spark, tables)
    return requests.page_prefix(pages, ["run"]).select("event_id", "run", "page")


@query("page_prefix_bounded", prefix_sql(5))
def page_prefix_bounded(spark, tables):
    pages = _landed_pages(spark, tables)
    return requests.page_prefix(pages, ["run"], 5).select("event_id", "run", "page")


@query(
    "request_manifest",
    """
    WITH asked AS (
        SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'dev' WHEN 1 THEN 'data'
            WHEN 2 THEN 'software-dev' WHEN 3 THEN 'backend' ELSE lower(p_type) END AS category
        FROM part),
    catalogue AS (
        SELECT * FROM (VALUES ('dev', 0, 'industry', 'dev'), ('data', 0, 'tag', 'data'),
            ('data', 1, 'industry', 'data-science'), ('software-dev', 0, 'tag', 'software-dev'),
            ('software-dev', 1, 'industry', 'dev'), ('backend', 0, 'tag', 'backend'))
            AS t(category, query_no, kind, value))
    SELECT a.p_partkey, a.category, coalesce(c.query_no, 0) AS query_no, '100' AS count,
           coalesce(c.kind, 'tag') AS kind, coalesce(c.value, a.category) AS value
    FROM asked a LEFT JOIN catalogue c ON a.category = c.category
    """,
)
def request_manifest(spark, tables):
    """Every part asks for a category; each becomes its request rows."""
    size = F.col("p_size") % 5
    category = (
        F.when(size == 0, "dev")
        .when(size == 1, "data")
        .when(size == 2, "software-dev")
        .when(size == 3, "backend")
        .otherwise(F.lower("p_type"))
    )
    asked = table(spark, tables, "part").select("p_partkey", category.alias("category"))
    expanded = requests.expand_categories(asked)
    tag, industry = F.col("params")["tag"], F.col("params")["industry"]
    return expanded.select(
        "p_partkey",
        "category",
        "query_no",
        F.col("params")["count"].alias("count"),
        F.when(tag.isNotNull(), "tag").otherwise("industry").alias("kind"),
        F.coalesce(tag, industry).alias("value"),
    )
