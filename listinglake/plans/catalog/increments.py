"""Published tables, and silver and first-arrival dedupe capture by capture."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from listinglake import schemas
from listinglake.functions.text import fold
from listinglake.operators import heavy, members
from listinglake.plans import admission, incremental, refresh
from listinglake.plans.catalog.dedupe import EVENT_EDGES, GREEDY
from listinglake.plans.catalog.gold import LANDED_LINES, ORDER_ROWS, landed_lines, order_listings, order_star
from listinglake.plans.catalog.registry import query, second, table
from listinglake.plans.catalog.dedupe import prefix_sql
from listinglake.session import scratch_path, store
from listinglake.sinks import bronze, compaction
from listinglake.sinks.tables import write_table
from listinglake.sources import drift, landing, snapshot
from listinglake.streaming.pages import land_used_pages


def _dies(build, *arguments):
    """Run a job that must fail."""
    try:
        build(*arguments)
    except PySparkException:
        return
    raise AssertionError("the job was meant to fail")


def _broken(frame, name, key):
    """``frame``, but reading ``name`` of some late rows ends the job."""
    return frame.withColumn(
        name, F.when(F.col(key) % 1000 == 7, F.raise_error(F.lit("lost half-way"))).otherwise(F.col(name))
    )


@query(
    "table_publish",
    """
    SELECT 'after a failed write' AS state, o_orderkey, o_orderpriority AS value FROM orders
    UNION ALL SELECT 'after the next write', o_orderkey, o_orderstatus FROM orders
    """,
)
def table_publish(spark, tables):
    """A table whose second write dies half-way keeps its rows until a third one is whole."""
    path = scratch_path(spark, "published")
    orders = table(spark, tables, "orders")
    first = orders.select("o_orderkey", F.col("o_orderpriority").alias("value"))
    second_ = orders.select("o_orderkey", F.col("o_orderstatus").alias("value"))
    write_table(first, path)
    _dies(write_table, _broken(second_, "value", "o_orderkey"), path)
    failed = snapshot.read_table(spark, path)
    write_table(second_, path)
    after = snapshot.read_table(spark, path)
    return failed.select(F.lit("after a failed write").alias("state"), "*").unionByName(
        after.select(F.lit("after the next write").alias("state"), "*")
    )


def _built(company):
    return f"""
        SELECT o.o_orderkey AS vacancy_id, coalesce({company}, 'Unknown') AS company_name,
               coalesce(nullif(n.n_name, 'NATION_3'), 'Unspecified') AS location_name,
               row_number() OVER (PARTITION BY o.o_orderstatus, {company}
                                  ORDER BY o.o_orderdate DESC, o.o_orderkey) AS r
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey
    """


@query(
    "lake_publish",
    f"""
    SELECT 'after a failed build' AS state, vacancy_id, company_name, location_name
    FROM ({_built("nullif(c.c_name, 'Customer#000000001')")}) WHERE r = 1
    UNION ALL
    SELECT 'after the next build', vacancy_id, company_name, location_name
    FROM ({_built("o.o_orderpriority")}) WHERE r = 1
    """,
)
def lake_publish(spark, tables):
    """Silver and star of a build that dies stay unseen; the next build replaces all at once."""
    root = scratch_path(spark, "lake")
    listings = order_listings(spark, tables)
    renamed = listings.withColumn("company_name", F.col("category"))
    refresh.refresh_from(spark, listings, root)
    _dies(refresh.refresh_from, spark, _broken(renamed, "description", "id"), root)
    failed = snapshot.read_gold(spark, f"{root}/gold")
    refresh.refresh_from(spark, renamed, root)
    after = snapshot.read_gold(spark, f"{root}/gold")
    columns = ["vacancy_id", "company_name", "location_name"]
    return failed.select(F.lit("after a failed build").alias("state"), *columns).unionByName(
        after.select(F.lit("after the next build").alias("state"), *columns)
    )


_CAPTURES = ((1, 2), (2, 4), (3, 7))


@query(
    "silver_incremental",
    f"""
    WITH {LANDED_LINES},
    captured AS (
        SELECT * FROM cleaned
        JOIN (VALUES {", ".join(map(str, _CAPTURES))}) AS c(capture, last_line) ON line <= last_line),
    newest AS (
        SELECT *, row_number() OVER (PARTITION BY capture, id ORDER BY moment DESC NULLS LAST,
            title NULLS LAST, company_name NULLS LAST, category NULLS LAST,
            location NULLS LAST, salary NULLS LAST, description NULLS LAST) AS r
        FROM captured),
    pairs AS (
        SELECT *, row_number() OVER (PARTITION BY capture, title, company_name
                                     ORDER BY moment DESC NULLS LAST, id) AS p
        FROM newest WHERE r = 1)
    SELECT CAST(capture AS INTEGER) AS capture, id, title, company_name, category,
           strftime(moment, '%Y-%m-%d %H:%M:%S') AS publication_date,
           location AS candidate_required_location, salary, description
    FROM pairs WHERE p = 1
    """,
)
def silver_incremental(spark, tables):
    """Three captures of the same ids; silver after each equals a rebuild from all so far."""
    root = scratch_path(spark, "silver")
    states, start = [], 1
    for capture, last in _CAPTURES:
        rows = landed_lines(spark, tables, f"l_linenumber BETWEEN {start} AND {last}")
        incremental.merge_capture(spark, root, rows, ("ring", "bolt"))
        states.append(incremental.read_silver(spark, root).select(F.lit(capture).alias("capture"), "*"))
        start = last + 1
    merged = states[0].unionByName(states[1]).unionByName(states[2])
    return merged.withColumn("publication_date", second("publication_date"))


@query(
    "greedy_incremental",
    f"""
    WITH {EVENT_EDGES}, {GREEDY}
    SELECT event_id, user_id, event_type, props
    FROM events WHERE event_id IN (SELECT arrival FROM stays)
    """,
)
def greedy_incremental(spark, tables):
    """Events in three captures; what is kept of them equals one pass over all."""
    root = scratch_path(spark, "admission")
    events = table(spark, tables, "events").select("event_id", "user_id", "event_type", "props")
    last = events.agg(F.max("event_id")).first()[0] or 0
    for third in range(3):
        low, high = last * third // 3, last * (third + 1) // 3
        capture = events.where((F.col("event_id") > low) | F.lit(not third)).where(F.col("event_id") <= high)
        admission.admit(
            spark, root, capture, f"capture-{third}", F.col("user_id"),
            [fold(F.col("event_type")), F.col("props")], F.col("event_id"),
        )
    return admission.kept(spark, root)


@query(
    "kpis_by_members",
    f"""
    WITH {ORDER_ROWS}
    SELECT count(*) AS vacancies, count(DISTINCT company_name) AS companies,
           count(DISTINCT location_name) AS locations
    FROM prepared
    """,
)
def kpis_by_members(spark, tables):
    """The figures of the star from bitmaps over its dense keys."""
    fact = order_star(spark, tables).fct_vacancies
    return members.figures(fact, {"companies": "company_id", "locations": "location_id"})


@query(
    "capture_members",
    """
    WITH months AS (SELECT *, strftime(o_orderdate, '%Y') AS capture FROM orders)
    SELECT capture, count(DISTINCT o_custkey) AS own,
           (SELECT count(DISTINCT o_custkey) FROM months b WHERE b.capture <= a.capture) AS so_far
    FROM months a GROUP BY capture
    """,
)
def capture_members(spark, tables):
    """Customers of each year's orders and of all years so far; sets are merged, rows read once."""
    orders = table(spark, tables, "orders").select("o_custkey", F.year("o_orderdate").cast("string").alias("capture"))
    sets = store(
        orders.groupBy("capture", F.bitmap_bucket_number(F.col("o_custkey").cast("bigint")).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("o_custkey").cast("bigint"))).alias("bits")),
        "capture-members",
    )
    own = sets.groupBy("capture").agg(F.sum(F.bitmap_count("bits")).cast("bigint").alias("own"))
    captures = [row.capture for row in own.select("capture").orderBy("capture").collect()]
    later = F.explode(F.filter(F.array(*map(F.lit, captures)), lambda c: c >= F.col("capture"))).alias("capture")
    so_far = (
        sets.select(later, "bucket", "bits")
        .groupBy("capture", "bucket")
        .agg(F.bitmap_or_agg("bits").alias("bits"))
        .groupBy("capture")
        .agg(F.sum(F.bitmap_count("bits")).cast("bigint").alias("so_far"))
    )
    return own.join(so_far, "capture")


@query("page_stream", prefix_sql(None))
def page_stream(spark, tables):
    """Events as pages that land in the order of a hash, a few files a batch."""
    folder, target = scratch_path(spark, "landed-pages"), scratch_path(spark, "used-pages")
    pages = table(spark, tables, "events").select(
        F.col("event_id").alias("request_seq"),
        F.col("user_id").cast("string").alias("run"),
        (F.col("event_id") % 43 + 1).cast("bigint").alias("page"),
        (F.col("event_type") != "error").alias("ok"),
        F.round("value").cast("bigint").alias("entries"),
        (F.col("props") != '{"k": 7}').alias("has_next"),
    )
    pages.repartition(6, F.md5(F.col("request_seq").cast("string"))).write.parquet(folder)
    land_used_pages(spark, folder, target, f"{target}-progress", files_per_batch=2).awaitTermination()
    used = spark.read.schema("request_seq bigint, run string, page bigint").parquet(target)
    return used.select(F.col("request_seq").alias("event_id"), F.col("run").cast("bigint").alias("run"), "page")


_DECLARED = [name for name, _ in schemas.fields(schemas.BRONZE)]


@query(
    "schema_drift",
    """
    WITH sizes AS (
        SELECT CASE WHEN event_id % 3 = 0 THEN 'odd' ELSE 'plain' END AS capture, count(*) AS listings,
               count(*) FILTER (event_type = 'click') AS clicks
        FROM events GROUP BY 1),
    found AS (
        SELECT capture, unnest(['id', 'title', 'publication_date', 'salary', 'remote']) AS member,
               unnest(CASE capture WHEN 'odd' THEN ['STRING', 'STRING', 'STRING', 'BIGINT', 'BOOLEAN']
                      ELSE ['BIGINT', 'STRING', 'STRING', 'STRING', NULL] END) AS found,
               unnest(CASE capture WHEN 'odd' THEN [listings, listings, clicks, listings, listings]
                      ELSE [listings, listings, listings, listings, 0] END) AS present
        FROM sizes),
    declared AS (
        SELECT capture, listings, unnest(['id', 'source', 'source_job_id', 'query_category', 'title',
                   'company_name', 'category', 'publication_date', 'candidate_required_location',
                   'salary', 'description', 'url']) AS member
        FROM sizes)
    SELECT coalesce(d.capture, f.capture) AS capture, coalesce(d.member, f.member) AS member,
           CASE WHEN d.member = 'id' THEN 'bigint' WHEN d.member IS NOT NULL THEN 'string' END AS declared,
           f.found, coalesce(f.present, 0) AS present,
           coalesce(d.listings, s.listings) AS listings,
           CASE WHEN d.member IS NULL THEN 'unknown' WHEN f.found IS NULL THEN 'absent'
                WHEN (d.member = 'id') = (f.found = 'BIGINT') THEN 'as declared' ELSE 'other type' END AS status
    FROM declared d FULL JOIN (SELECT * FROM found WHERE found IS NOT NULL AND present > 0) f
        ON d.capture = f.capture AND d.member = f.member
    LEFT JOIN sizes s ON s.capture = f.capture
    """,
)
def schema_drift(spark, tables):
    """Landed events whose odd capture has a text id, a number as salary and a member of its own."""
    folder = scratch_path(spark, "drifting")
    events = table(spark, tables, "events")
    odd = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("id"),
            F.col("event_type").alias("title"),
            F.when(F.col("event_type") == "click", "2026-01-01").alias("publication_date"),
            F.col("user_id").alias("salary"),
            F.lit(True).alias("remote"),
        )
    )
    plain = F.to_json(
        F.struct(
            F.col("event_id").alias("id"),
            F.col("event_type").alias("title"),
            F.lit("2026-01-01").alias("publication_date"),
            F.col("user_id").cast("string").alias("salary"),
        )
    )
    is_odd = F.col("event_id") % 3 == 0
    listed = events.select(
        F.when(is_odd, "odd").otherwise("plain").alias("capture"), F.when(is_odd, odd).otherwise(plain).alias("job"),
        F.floor(F.col("event_id") / 4096).alias("chunk"),
    )
    documents = listed.groupBy("capture", "chunk").agg(
        F.concat(F.lit('{"jobs": ['), F.concat_ws(", ", F.collect_list("job")), F.lit(", null, 3]}")).alias("value")
    )
    documents.select("value", "capture").write.partitionBy("capture").option("maxRecordsPerFile", 1).text(folder)
    entries = landing.opened(landing.documents(spark, landing.Landing(folder, "*.txt")))
    named = entries.select(F.regexp_extract("file", r"/capture=(\w+)/", 1).alias("capture"), "entry")
    return drift.drift(named, capture="capture")


@query(
    "bronze_compaction",
    """
    SELECT event_id AS id, event_type AS title, props AS description,
           CASE event_id % 3 WHEN 0 THEN '20260101_000000' WHEN 1 THEN '20260102_000000'
                ELSE '20260103_000000' END AS capture_stamp
    FROM events
    """,
)
def bronze_compaction(spark, tables):
    """Three captures in many small files; two are packed, the third is still read as it landed."""
    folder = scratch_path(spark, "bronze")
    empty = [F.lit("").alias(name) for name in _DECLARED if name not in ("id", "title", "description")]
    rows = table(spark, tables, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("title"), F.col("props").alias("description"), *empty
    )
    for number in range(3):
        capture = rows.where(F.col("id") % 3 == number).repartition(12, "id")
        bronze.write_bronze(capture, folder, datetime(2026, 1, 1 + number))
        if number == 1:
            compaction.compact(spark, folder, target_bytes=1 << 20)
    return compaction.read_captures(spark, folder).select("id", "title", "description", "capture_stamp")


@query(
    "top_bounded",
    """
    (SELECT 'type' AS kind, event_type AS label, count(*) AS count FROM events
     WHERE trim(event_type) <> '' GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 3)
    UNION ALL
    (SELECT 'part', CAST(l_partkey AS VARCHAR), count(*) FROM lineitem
     GROUP BY l_partkey ORDER BY count(*) DESC, CAST(l_partkey AS VARCHAR) LIMIT 10)
    UNION ALL
    (SELECT 'day', label, count(*) FROM (
        SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'often' ELSE CAST(l_orderkey AS VARCHAR) || '-'
            || CAST(l_linenumber AS VARCHAR) END AS label FROM lineitem)
     GROUP BY label ORDER BY count(*) DESC, label LIMIT 1)
    """,
)
def top_bounded(spark, tables):
    """Top values of columns with few values, with very many about alike, and with one that stands out."""
    lines = table(spark, tables, "lineitem")
    skewed = F.when(F.col("l_orderkey") % 3 == 0, "often").otherwise(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    )
    found = [
        ("type", heavy.top_values(table(spark, tables, "events"), "event_type", 3)),
        ("part", heavy.top_values(lines.select(F.col("l_partkey").cast("string").alias("part")), "part", 10)),
        ("day", heavy.top_values(lines.select(skewed.alias("label")), "label", 1)),
    ]
    named = [top.frame.select(F.lit(kind).alias("kind"), "label", "count") for kind, top in found]
    return named[0].unionByName(named[1]).unionByName(named[2])
