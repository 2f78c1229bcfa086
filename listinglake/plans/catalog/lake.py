"""Landing, boards, tables, snapshots and source resolution."""

from __future__ import annotations

import functools
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listinglake.functions import times
from listinglake.operators import boards, requests, serving
from listinglake.plans import collect, incremental, ingest, refresh
from listinglake.plans.catalog.gold import order_listings, order_star
from listinglake.plans.catalog.registry import day, money, query, second, table
from listinglake.session import file_names, put_text, scratch_path
from listinglake.sinks import bronze
from listinglake.sinks.tables import export, write_table
from listinglake.sources import landing, resolve, snapshot
from listinglake.streaming.bronze import land_new_listings

# --- documents ---------------------------------------------------------------

# Listings per landed document: bounds the array of one document, not the data.
DOCUMENT_ROWS = 4096

_EVENT_LISTINGS = """
    listings AS (
        SELECT event_id AS id, event_type || ' data' AS title,
               'user ' || CAST(user_id AS VARCHAR) AS company_name, event_type AS category,
               strftime(ts, '%Y-%m-%dT%H:%M:%S') AS publication_date,
               CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS salary, props AS description
        FROM events)
"""


def _event_listings(spark, tables):
    """Events as canonical listings; the location field is absent on purpose."""
    return table(spark, tables, "events").select(
        F.col("event_id").alias("id"),
        F.concat("event_type", F.lit(" data")).alias("title"),
        F.concat(F.lit("user "), "user_id").alias("company_name"),
        F.col("event_type").alias("category"),
        times.iso_text(F.col("ts")).alias("publication_date"),
        money("value").alias("salary"),
        F.col("props").alias("description"),
    )


def _documents_of(listings):
    """Arrays of at most DOCUMENT_ROWS listings, whatever the data looks like."""
    chunk = F.floor(F.monotonically_increasing_id() / DOCUMENT_ROWS)
    fields = F.struct(*listings.columns)
    return (
        listings.select(chunk.alias("chunk"), fields.alias("job"))
        .groupBy("chunk")
        .agg(F.collect_list("job").alias("jobs"))
    )


def _land_objects(spark, tables, folder):
    """Pretty-printed ``{"jobs": [...]}`` documents, one per file."""
    documents = _documents_of(_event_listings(spark, tables)).select("jobs")
    writer = documents.write.mode("append").option("pretty", True)
    writer.option("maxRecordsPerFile", 1).json(folder)


_READ = ("id", "title", "company_name", "category", "publication_date",
         "candidate_required_location", "salary", "description")


def _typed(frame):
    return frame.withColumn("id", F.col("id").try_cast("bigint")).withColumn(
        "candidate_required_location", F.coalesce("candidate_required_location", F.lit("none"))
    )


_BRONZE_SQL = f"""
    WITH {_EVENT_LISTINGS}
    SELECT id, title, company_name, category, publication_date,
           'none' AS candidate_required_location, salary, description
    FROM listings
"""


@query("bronze_scan", _BRONZE_SQL)
def bronze_scan(spark, tables):
    folder = scratch_path(spark, "landed")
    _land_objects(spark, tables, folder)
    put_text(spark, f"{folder}/notes.txt", "not a document")
    put_text(spark, f"{folder}/empty.json", '{"jobs": []}')
    return _typed(landing.read_listings(spark, folder).select(*_READ))


@query("bronze_stream", _BRONZE_SQL)
def bronze_stream(spark, tables):
    """The same documents through the incremental scan, run until it has seen all."""
    folder, target = scratch_path(spark, "landed"), scratch_path(spark, "streamed")
    _land_objects(spark, tables, folder)
    land_new_listings(spark, folder, target, f"{target}-progress").awaitTermination()
    return _typed(spark.read.parquet(target).select(*_READ))


@query(
    "landing_union",
    f"""
    WITH {_EVENT_LISTINGS}
    SELECT shape, id, title, company_name, publication_date
    FROM listings CROSS JOIN (SELECT unnest(['object', 'array']) AS shape)
    """,
)
def landing_union(spark, tables):
    """Both document shapes in one scan; a broken and a foreign file do no harm."""
    folder = scratch_path(spark, "landed")
    _land_objects(spark, tables, folder)
    arrays = _documents_of(_event_listings(spark, tables)).select(F.to_json("jobs").alias("text"))
    arrays.write.mode("append").option("maxRecordsPerFile", 1).text(folder)
    put_text(spark, f"{folder}/broken.json", '{"jobs": [{"id": 1')
    put_text(spark, f"{folder}/foreign.json", '{"error": "none"}')
    at = landing.Landing(folder, "*.{json,txt}", recursive=False)
    rows = landing.listings(spark, at, arrays=True)
    shape = F.when(F.col("file").endswith(".txt"), "array").otherwise("object")
    return rows.select(
        shape.alias("shape"),
        F.col("id").try_cast("bigint").alias("id"),
        "title",
        "company_name",
        "publication_date",
    )


@query(
    "quarantine",
    """
    WITH documents AS (
        SELECT event_id // 256 AS chunk, count(*) AS listings FROM events GROUP BY 1)
    SELECT CASE chunk % 4 WHEN 0 THEN 'not valid JSON' WHEN 1 THEN 'no jobs array'
                ELSE 'listings' END AS outcome,
           count(*) AS documents, sum(listings)::BIGINT AS listings
    FROM documents GROUP BY 1
    """,
)
def quarantine(spark, tables):
    """Landed events, 256 a document, every fourth one broken and every fourth one foreign."""
    folder = scratch_path(spark, "landed")
    chunk = F.col("chunk") % 4
    whole = F.to_json(F.struct("jobs"))
    text = (
        F.when(chunk == 0, F.expr("substring(whole, 1, length(whole) - 1)"))
        .when(chunk == 1, F.concat(F.lit('{"other": '), F.to_json("jobs"), F.lit("}")))
        .otherwise(F.col("whole"))
    )
    (
        _event_listings(spark, tables)
        .select(F.floor(F.col("id") / 256).alias("chunk"), F.struct("id", "title").alias("job"))
        .groupBy("chunk")
        .agg(F.collect_list("job").alias("jobs"))
        .withColumn("whole", whole)
        .select(text.alias("value"))
        .write.option("maxRecordsPerFile", 1)
        .text(folder)
    )
    at = landing.Landing(folder, "*.txt")
    aside = landing.quarantined(spark, at).select(
        F.col("reason").alias("outcome"),
        "file",
        F.regexp_count("text", F.lit('"id":')).cast("bigint").alias("listings"),
    )
    kept = landing.listings(spark, at, ["id"]).select(
        F.lit("listings").alias("outcome"), "file", F.lit(1).cast("bigint").alias("listings")
    )
    return (
        aside.unionByName(kept)
        .groupBy("outcome")
        .agg(F.count_distinct("file").alias("documents"), F.sum("listings").alias("listings"))
    )


@query(
    "flatten_array",
    """
    SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, line
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) AS line_no
          FROM documents)
    WHERE trim(line) <> ''
    """,
)
def flatten_array(spark, tables):
    """Lines of each document as an array of structs, blank ones null, taken apart."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda line, at: F.when(
            F.trim(line) != "",
            F.struct((at + 1).cast("bigint").alias("line_no"), line.alias("line")),
        ),
    )
    docs = table(spark, tables, "documents").select("doc_id", lines.alias("lines"))
    return landing.flatten_structs(docs, "lines")


# --- responses ---------------------------------------------------------------


@query(
    "payload_counts",
    """
    WITH responses AS (
        SELECT event_id, CASE event_id % 7
            WHEN 0 THEN '{"jobs": [' || props
            WHEN 1 THEN '[' || props || ']'
            WHEN 2 THEN '{"jobs": "none"}'
            WHEN 3 THEN '{"job-count": ' || CAST(user_id AS VARCHAR) || ', "jobs": [' || props || ']}'
            ELSE '{"jobs": [' || props || ', 1, null]}' END AS body
        FROM events),
    parsed AS (
        SELECT event_id, body, json_valid(body) AS valid,
               CASE WHEN json_valid(body) THEN json_type(body) END AS kind
        FROM responses)
    SELECT event_id,
           CASE WHEN NOT valid THEN 'not valid JSON' WHEN kind <> 'OBJECT' THEN 'not a JSON object'
                ELSE 'accepted' END AS outcome,
           CASE WHEN valid AND kind = 'OBJECT' THEN coalesce(body ->> '$."job-count"',
                CASE WHEN json_type(body, '$.jobs') = 'ARRAY'
                     THEN CAST(json_array_length(body, '$.jobs') AS VARCHAR) END, 'unknown')
                ELSE '' END AS declared,
           CASE WHEN valid AND kind = 'OBJECT' AND json_type(body, '$.jobs') = 'ARRAY'
                THEN CAST(json_array_length(body, '$.jobs') AS BIGINT) ELSE 0 END AS actual
    FROM parsed
    """,
)
def payload_counts(spark, tables):
    """Event payloads as responses, some broken, some no object."""
    kind, props = F.col("event_id") % 7, F.col("props")

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    body = (
        F.when(kind == 0, text('{"jobs": [', props))
        .when(kind == 1, text("[", props, "]"))
        .when(kind == 2, '{"jobs": "none"}')
        .when(kind == 3, text('{"job-count": ', F.col("user_id").cast("string"), ', "jobs": [',
                              props, "]}"))
        .otherwise(text('{"jobs": [', props, ", 1, null]}"))
    )
    responses = table(spark, tables, "events").select("event_id", body.alias("body"))
    payload = F.when(F.col("accepted"), F.col("payload"))
    return boards.parse(responses).select(
        "event_id",
        F.coalesce("reason", F.lit("accepted")).alias("outcome"),
        F.when(F.col("accepted"), boards.declared_count(payload)).otherwise("").alias("declared"),
        F.coalesce(boards.actual_count(payload), F.lit(0)).alias("actual"),
    )


def _responses(spark, tables):
    """Landed responses of three boards, one per row of documents, part and events."""
    docs = table(spark, tables, "documents").select(
        F.lit("remotive").alias("source"),
        F.col("doc_id").alias("request_seq"),
        F.to_json(
            F.struct(
                F.array(
                    F.struct(
                        F.col("doc_id").alias("id"),
                        F.concat(F.lit(" "), "lang", F.lit(" data ")).alias("title"),
                        F.col("source").alias("company_name"),
                        F.nullif("lang", F.lit("fr")).alias("category"),
                        F.col("n_chars").alias("salary"),
                        F.col("text").alias("description"),
                    )
                ).alias("jobs")
            )
        ).alias("body"),
    )
    # One listing as an object, its neighbours no objects at all.
    parts = table(spark, tables, "part").select(
        F.lit("jobicy").alias("source"),
        (F.col("p_partkey") + 1_000_000_000).alias("request_seq"),
        F.concat(
            F.lit('{"jobs": [3, '),
            F.to_json(
                F.struct(
                    F.col("p_partkey").alias("id"),
                    F.when(F.col("p_size") % 10 == 0, "  ").otherwise(F.col("p_type")).alias(
                        "jobTitle"
                    ),
                    F.col("p_name").alias("title"),
                    F.lit("").alias("companyName"),
                    F.col("p_brand").alias("company_name"),
                    F.array("p_type").alias("jobIndustry"),
                    F.lit("2026-01-02 03:04:05").alias("pubDate"),
                    F.lit(" Worldwide ").alias("jobGeo"),
                    F.col("p_name").alias("jobDescription"),
                )
            ),
            F.lit(", null]}"),
        ).alias("body"),
    )
    events = table(spark, tables, "events").select(
        F.lit("arbeitnow").alias("source"),
        (F.col("event_id") + 2_000_000_000).alias("request_seq"),
        F.to_json(
            F.struct(
                F.array(
                    F.struct(
                        F.when(F.col("event_id") % 2 == 0, "").otherwise(
                            F.concat(F.lit("slug-"), "event_id")
                        ).alias("slug"),
                        F.concat(F.lit("http://jobs.example/"), "event_id").alias("url"),
                        F.col("event_type").alias("title"),
                        F.concat(F.lit("User "), "user_id").alias("company_name"),
                        F.array(F.lit(" "), F.nullif("event_type", F.lit("error"))).alias("tags"),
                        F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).alias(
                            "created_at"
                        ),
                        F.lit("Berlin").alias("location"),
                        F.col("props").alias("description"),
                    )
                ).alias("data")
            )
        ).alias("body"),
    )
    return docs.unionByName(parts).unionByName(events).withColumn("query_category", F.lit("dev"))


_HASHED = (
    "(('0x' || substr(sha256({source} || ':' || {native}), 1, 16))::UBIGINT "
    "& 9223372036854775807::UBIGINT)::BIGINT"
)
_BOARD_ROWS = f"""
    found AS (
        SELECT doc_id AS arrival, 'remotive' AS source, CAST(doc_id AS VARCHAR) AS native,
               lang || ' data' AS title, source AS company_name,
               coalesce(nullif(lang, 'fr'), 'dev') AS category, '' AS publication_date,
               '' AS location, CAST(n_chars AS VARCHAR) AS salary,
               regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', '') AS description,
               '' AS url
        FROM documents
        UNION ALL
        SELECT 1000000000 + p_partkey, 'jobicy', CAST(p_partkey AS VARCHAR), p_type, p_brand,
               '[''' || p_type || ''']', '2026-01-02 03:04:05', 'Worldwide', '', p_name, ''
        FROM part WHERE p_size % 10 <> 0
        UNION ALL
        SELECT 2000000000 + event_id, 'arbeitnow',
               CASE WHEN event_id % 2 = 0 THEN 'http://jobs.example/' || CAST(event_id AS VARCHAR)
                    ELSE 'slug-' || CAST(event_id AS VARCHAR) END,
               event_type, 'User ' || CAST(user_id AS VARCHAR),
               coalesce(nullif(event_type, 'error'), 'dev'),
               strftime(ts, '%Y-%m-%dT%H:%M:%S'), 'Berlin', '', props,
               'http://jobs.example/' || CAST(event_id AS VARCHAR)
        FROM events)
"""


@query(
    "normalize_union",
    f"""
    WITH {_BOARD_ROWS}
    SELECT arrival AS request_seq, {_HASHED.format(source='source', native='native')} AS id,
           source, native AS source_job_id, 'dev' AS query_category, title, company_name,
           category, publication_date, location AS candidate_required_location, salary,
           description, url
    FROM found
    """,
)
def normalize_union(spark, tables):
    return boards.union_boards(_responses(spark, tables)).drop("position")


@query(
    "catalogue_rollup",
    f"""
    WITH {_BOARD_ROWS},
    in_order AS (
        SELECT list({{'pairs': [lower(title) || '|' || lower(company_name)], 'kept': [source]}}
                    ORDER BY arrival) AS rows
        FROM found),
    walked AS (
        SELECT list_reduce(rows, lambda done, row:
            CASE WHEN list_contains(done.pairs, row.pairs[1]) THEN done
            ELSE {{'pairs': list_concat(done.pairs, row.pairs),
                   'kept': list_concat(done.kept, row.kept)}} END) AS state
        FROM in_order),
    kept AS (SELECT unnest(state.kept) AS source FROM walked)
    SELECT count(*) AS job_count, string_agg(DISTINCT source, ',' ORDER BY source) AS sources,
           'dev' AS categories, '2026-01-01T00:00:00Z' AS captured_at
    FROM kept
    """,
)
def catalogue_rollup(spark, tables):
    """A whole collection over the three boards, rolled up to one row."""
    responses = _responses(spark, tables).select(
        "request_seq",
        "source",
        F.lit("run").alias("run"),
        "query_category",
        F.lit(None).cast("bigint").alias("page"),
        F.lit(None).cast("map<string,string>").alias("params"),
        "body",
        F.lit(None).cast("string").alias("error"),
    )
    collected = collect.collect(responses)
    row = requests.catalogue(collected.listings, "2026-01-01T00:00:00Z")
    return row.withColumn("sources", F.array_join("sources", ",")).withColumn(
        "categories", F.array_join("categories", ",")
    )


# --- tables ------------------------------------------------------------------

_ORDER_TABLE = """
    SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice
    FROM orders
"""


def _orders(spark, tables):
    return table(spark, tables, "orders").select(
        "o_orderkey", "o_custkey", day("o_orderdate"), money("o_totalprice").alias("o_totalprice")
    )


@query("snapshot_listing", _ORDER_TABLE)
def snapshot_listing(spark, tables):
    """A logged table written twice: the log says which files still count."""
    folder = scratch_path(spark, "logged")

    def commit(version, actions):
        lines = "\n".join(f'{{"{kind}": {{"path": "{name}"}}}}' for kind, name in actions)
        put_text(spark, f"{folder}/{snapshot.LOG}/{version:020d}.json", lines + "\n")

    _orders(spark, tables).write.parquet(folder)
    first = file_names(spark, folder, ".parquet")
    commit(0, [("add", name) for name in first])
    _orders(spark, tables).repartition("o_custkey").write.mode("append").parquet(folder)
    second_run = [n for n in file_names(spark, folder, ".parquet") if n not in first]
    commit(1, [("add", n) for n in second_run] + [("remove", n) for n in first])
    return snapshot.read_files(spark, snapshot.active_files(spark, folder))


@query("overwrite_roundtrip", _ORDER_TABLE)
def overwrite_roundtrip(spark, tables):
    """A table written, then replaced under another schema, and read back."""
    path = scratch_path(spark, "table")
    write_table(table(spark, tables, "customer"), path)
    write_table(_orders(spark, tables), path)
    return snapshot.read_table(spark, path)


@query(
    "refresh_counts",
    """
    WITH prepared AS (
        SELECT coalesce(nullif(c.c_name, 'Customer#000000001'), 'Unknown') AS company,
               coalesce(nullif(n.n_name, 'NATION_3'), 'Unspecified') AS location,
               row_number() OVER (PARTITION BY o.o_orderstatus,
                   nullif(c.c_name, 'Customer#000000001')
                   ORDER BY o.o_orderdate DESC, o.o_orderkey) AS r
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey)
    SELECT 'silver/jobs' AS name, count(*) AS rows FROM prepared WHERE r = 1
    UNION ALL SELECT 'gold/dim_company', count(DISTINCT company) FROM prepared WHERE r = 1
    UNION ALL SELECT 'gold/dim_location', count(DISTINCT location) FROM prepared WHERE r = 1
    UNION ALL SELECT 'gold/fct_vacancies', count(*) FROM prepared WHERE r = 1
    """,
)
def refresh_counts(spark, tables):
    """The whole refresh, from listings to written tables, with its row counts."""
    root = scratch_path(spark, "lake")
    listings = order_listings(spark, tables)
    counts = refresh.refresh_from(spark, listings, root, f"{root}/export.parquet")
    return spark.createDataFrame(list(counts.items()), "name string, rows bigint")


@query(
    "refresh_landing",
    """
    SELECT 'silver/jobs' AS name, count(DISTINCT (event_type, user_id)) AS rows FROM events
    UNION ALL SELECT 'gold/dim_company', count(DISTINCT user_id) FROM events
    UNION ALL SELECT 'gold/dim_location', 1
    UNION ALL SELECT 'gold/fct_vacancies', count(DISTINCT (event_type, user_id)) FROM events
    UNION ALL SELECT 'quarantine/documents', 1
    UNION ALL SELECT 'quarantine/rejected_ids', 0
    """,
)
def refresh_landing(spark, tables):
    """The refresh from landed documents, one of them broken, with what it set aside."""
    folder, root = scratch_path(spark, "landed"), scratch_path(spark, "lake")
    _land_objects(spark, tables, folder)
    put_text(spark, f"{folder}/broken.json", '{"jobs": [{"id": 1')
    counts = refresh.refresh(spark, folder, root)
    return spark.createDataFrame(list(counts.items()), "name string, rows bigint")


_EXPORTED = """
    SELECT o.o_orderkey AS vacancy_id, strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S')
               AS publication_timestamp, o.o_orderpriority AS category,
           coalesce(nullif(c.c_name, 'Customer#000000001'), 'Unknown') AS company_name,
           coalesce(nullif(n.n_name, 'NATION_3'), 'Unspecified') AS location_name
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
"""


def _exported(spark, tables, single_file):
    """The serving export, read back."""
    built = order_star(spark, tables)
    rows = serving.denormalise(built.fct_vacancies, built.dim_company, built.dim_location)
    path = f"{scratch_path(spark, 'export')}/gold.parquet"
    files = export(rows, path, single_file)
    return snapshot.read_files(spark, files).select(
        "vacancy_id", second("publication_timestamp"), "category", "company_name", "location_name"
    )


@query("export_single_file", _EXPORTED)
def export_single_file(spark, tables):
    return _exported(spark, tables, True)


@query("export_parts", _EXPORTED)
def export_parts(spark, tables):
    return _exported(spark, tables, False)


@query(
    "landing_write",
    """
    SELECT event_id AS id, 'events' AS source, event_type AS title, props AS description,
           '20260102_030405' AS capture_stamp
    FROM events
    """,
)
def landing_write(spark, tables):
    """Two captures into bronze; only the newest is read."""
    folder = scratch_path(spark, "bronze")
    empty = [
        F.lit("").alias(name)
        for name in ("source_job_id", "query_category", "company_name", "category",
                     "publication_date", "candidate_required_location", "salary", "url")
    ]
    rows = table(spark, tables, "events").select(
        F.col("event_id").alias("id"),
        F.lit("events").alias("source"),
        F.col("event_type").alias("title"),
        F.col("props").alias("description"),
        *empty,
    )
    bronze.write_bronze(rows, folder, datetime(2025, 12, 31, 23, 59, 59))
    bronze.write_bronze(rows, folder, datetime(2026, 1, 2, 3, 4, 5))
    newest = landing.latest_capture(spark, folder)
    captured = landing.read_bronze(spark, folder).where(F.col(landing.STAMP) == newest)
    return captured.select("id", "source", "title", "description", landing.STAMP)


@query(
    "source_fallback",
    f"SELECT 'gold-parquet' AS label, e.* FROM ({_EXPORTED}) e",
)
def source_fallback(spark, tables):
    """No gold table, no export: the gold Parquet folder is the first with rows."""
    root = scratch_path(spark, "sources")
    for name, frame in order_star(spark, tables).tables().items():
        write_table(frame, f"{root}/parquet/{name}")
    found = resolve.vacancies(
        spark, f"{root}/delta", f"{root}/export.parquet", f"{root}/parquet", f"{root}/raw"
    )
    return found.frame.select(
        F.lit(found.label).alias("label"),
        "vacancy_id",
        second("publication_timestamp"),
        "category",
        "company_name",
        "location_name",
    )


@query(
    "freshness",
    """
    SELECT true AS changed, count(*) AS rows FROM orders
    """,
)
def freshness(spark, tables):
    """The token of a table moves when the table is written again."""
    path = scratch_path(spark, "token")
    before = resolve.freshness_token(spark, path)
    write_table(_orders(spark, tables), path)
    middle = resolve.freshness_token(spark, path)
    _orders(spark, tables).repartition("o_custkey").write.mode("append").parquet(f"{path}/more")
    after = resolve.freshness_token(spark, path)
    changed = len({before, middle, after}) == 3
    rows = snapshot.read_table(spark, path)
    return rows.agg(F.lit(changed).alias("changed"), F.count(F.lit(1)).alias("rows"))


@query(
    "source_order",
    """
    WITH prepared AS (
        SELECT coalesce(nullif(c.c_name, 'Customer#000000001'), 'Unknown') AS company,
               coalesce(nullif(n.n_name, 'NATION_3'), 'Unspecified') AS location,
               row_number() OVER (PARTITION BY o.o_orderstatus,
                   nullif(c.c_name, 'Customer#000000001')
                   ORDER BY o.o_orderdate DESC, o.o_orderkey) AS r
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey),
    served AS (
        SELECT count(*) AS rows, count(DISTINCT company) AS companies, count(DISTINCT location) AS locations
        FROM prepared WHERE r = 1)
    SELECT label, rows, companies, locations
    FROM served, (SELECT unnest(['gold-delta', 'gold-sample', 'gold-parquet', 'bronze-json', 'sample']) AS label)
    UNION ALL SELECT 'empty', 0, 0, 0
    """,
)
def source_order(spark, tables):
    """Every source in turn: each is found once those before it are missing."""
    root, raw = scratch_path(spark, "sources"), scratch_path(spark, "landed")
    listings = order_listings(spark, tables).withColumn(
        "publication_date", times.iso_text(F.col("publication_date"))
    )
    documents = _documents_of(listings).select("jobs").write.option("maxRecordsPerFile", 1)
    documents.json(raw)
    refresh.refresh(spark, raw, f"{root}/lake", f"{root}/export.parquet")
    gold = f"{root}/lake/gold"
    for name in snapshot.GOLD_TABLES:
        write_table(snapshot.read_table(spark, f"{gold}/{name}"), f"{root}/parquet/{name}")
    places = [gold, f"{root}/export.parquet", f"{root}/parquet", raw, raw]
    found = []
    for missing in range(len(places) + 1):
        here = [f"{root}/missing"] * missing + places[missing:]
        source = resolve.vacancies(spark, *here)
        found.append(
            serving.kpis(source.frame).select(
                F.lit(source.label).alias("label"), F.col("vacancies").alias("rows"), "companies", "locations"
            )
        )
    return functools.reduce(DataFrame.unionByName, found)


@query(
    "bronze_to_silver",
    f"""
    WITH {_BOARD_ROWS},
    in_order AS (
        SELECT list({{'pairs': [lower(title) || '|' || lower(company_name)], 'kept': [arrival]}}
                    ORDER BY arrival) AS rows
        FROM found),
    walked AS (
        SELECT list_reduce(rows, lambda done, row:
            CASE WHEN list_contains(done.pairs, row.pairs[1]) THEN done
            ELSE {{'pairs': list_concat(done.pairs, row.pairs),
                   'kept': list_concat(done.kept, row.kept)}} END) AS state
        FROM in_order),
    kept AS (SELECT unnest(state.kept) AS arrival FROM walked)
    SELECT {_HASHED.format(source='source', native='native')} AS id, title, company_name, category,
           location AS candidate_required_location
    FROM found WHERE arrival IN (SELECT arrival FROM kept)
      AND (contains(lower(title), 'data') OR contains(lower(title), 'click') OR contains(lower(title), 'steel'))
    """,
)
def bronze_to_silver(spark, tables):
    """Landed responses to a bronze capture to silver, each step reading what the last has written."""
    folder, root = scratch_path(spark, "responses"), scratch_path(spark, "lake")
    _responses(spark, tables).select(
        "request_seq", "source", F.lit("run").alias("run"), "query_category", "body"
    ).write.json(folder)
    done = ingest.ingest(spark, folder, root, datetime(2026, 1, 2), keywords=("data", "click", "steel"))
    silver_rows = incremental.read_silver(spark, f"{root}/{ingest.LAKE}")
    return silver_rows.where(F.lit(done.merged.changed > 0)).select(
        "id",
        "title",
        F.coalesce("company_name", F.lit("")).alias("company_name"),
        "category",
        F.coalesce("candidate_required_location", F.lit("")).alias("candidate_required_location"),
    )
