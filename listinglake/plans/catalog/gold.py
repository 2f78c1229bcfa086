"""Silver, the star and the serving side on the order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from listinglake.operators import serving, silver, star
from listinglake.operators.skew import lookup_join
from listinglake.plans.catalog.registry import day, money, query, second, table
from listinglake.session import store

# --- silver ------------------------------------------------------------------

LANDED_LINES = r"""
    landed AS (
        SELECT CASE WHEN l.l_linenumber = 7 THEN 'x' || CAST(l.l_orderkey AS VARCHAR)
                    ELSE CAST(l.l_orderkey AS VARCHAR) END AS id_text,
               p.p_name AS title,
               nullif(p.p_brand, 'Brand#7') AS company_name,
               p.p_type AS category,
               CASE WHEN l.l_linenumber = 5 THEN NULL ELSE l.l_shipdate END AS moment,
               l.l_returnflag AS location, l.l_linenumber AS line,
               CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS salary,
               p.p_name || ' & ' || p.p_brand || ' <' || CAST(l.l_linenumber AS VARCHAR)
                   || '>' AS description
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
    cleaned AS (
        SELECT TRY_CAST(id_text AS BIGINT) AS id, title, company_name, category, moment,
               location, salary, description, line
        FROM landed
        WHERE (contains(lower(title), 'ring') OR contains(lower(title), 'bolt'))
          AND TRY_CAST(id_text AS BIGINT) IS NOT NULL)
"""


def landed_lines(spark, tables, only="true"):
    """Order lines as landed listings: markup, odd blanks, broken ids, mixed dates."""
    lines = table(spark, tables, "lineitem").where(only).select(
        "l_orderkey",
        F.col("l_partkey").alias("p_partkey"),
        "l_linenumber",
        "l_extendedprice",
        "l_returnflag",
        F.col("l_shipdate").cast("timestamp").alias("shipped"),
    )
    parts = table(spark, tables, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    number = F.col("l_linenumber")
    return lookup_join(lines, parts, "p_partkey", "inner").select(
        F.concat(F.when(number == 7, "x").otherwise(" "), "l_orderkey", F.lit(" ")).alias("id"),
        F.concat(F.lit(" \n"), F.replace("p_name", F.lit(" "), F.lit(" \t ")), F.lit(" ")).alias(
            "title"
        ),
        F.when(F.col("p_brand") == "Brand#7", " \t").otherwise(F.col("p_brand")).alias(
            "company_name"
        ),
        F.col("p_type").alias("category"),
        F.when(number == 1, F.date_format("shipped", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(number == 2, F.date_format("shipped", "yyyy-MM-dd HH:mm:ss"))
        .when(number == 5, "soon")
        .otherwise(F.date_format("shipped", "yyyy-MM-dd"))
        .alias("publication_date"),
        F.col("l_returnflag").alias("candidate_required_location"),
        money("l_extendedprice").alias("salary"),
        F.concat(
            F.lit("<p>"), "p_name", F.lit("</p>&amp;<b>"), "p_brand", F.lit("</b>\n&lt;"),
            number.cast("string"), F.lit("&gt;"),
        ).alias("description"),
    )


@query(
    "silver_build",
    f"""
    WITH {LANDED_LINES},
    newest AS (
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY moment DESC NULLS LAST,
            title NULLS LAST, company_name NULLS LAST, category NULLS LAST,
            location NULLS LAST, salary NULLS LAST, description NULLS LAST) AS r
        FROM cleaned),
    pairs AS (
        SELECT *, row_number() OVER (PARTITION BY title, company_name
                                     ORDER BY moment DESC NULLS LAST, id) AS p
        FROM newest WHERE r = 1)
    SELECT id, title, company_name, category,
           strftime(moment, '%Y-%m-%d %H:%M:%S') AS publication_date,
           location AS candidate_required_location, salary, description
    FROM pairs WHERE p = 1
    """,
)
def silver_build(spark, tables):
    rows = silver.build(landed_lines(spark, tables), ("ring", "bolt"))
    return rows.withColumn("publication_date", second("publication_date"))


@query(
    "silver_rejected",
    f"""
    WITH {LANDED_LINES}
    SELECT id_text AS id, count(*) AS rows FROM landed
    WHERE TRY_CAST(id_text AS BIGINT) IS NULL GROUP BY id_text
    """,
)
def silver_rejected(spark, tables):
    """Listings whose id is no number, counted per id."""
    rejected = silver.rejected_ids(landed_lines(spark, tables))
    return rejected.groupBy(F.trim("id").alias("id")).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "display_build",
    f"""
    WITH {LANDED_LINES},
    filled AS (
        SELECT id, moment, title, coalesce(company_name, 'Unknown') AS company_name,
               category, location, salary, description
        FROM cleaned),
    newest AS (
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY moment DESC NULLS LAST,
            title, company_name, category, location, salary, description) AS r
        FROM filled),
    pairs AS (
        SELECT *, row_number() OVER (PARTITION BY title, company_name
                                     ORDER BY moment DESC NULLS LAST, id) AS p
        FROM newest WHERE r = 1)
    SELECT id AS vacancy_id, strftime(moment, '%Y-%m-%d') AS publication_date,
           strftime(moment, '%Y-%m-%d %H:%M:%S') AS publication_timestamp, title,
           company_name, category, location AS location_name, salary, description
    FROM pairs WHERE p = 1
    """,
)
def display_build(spark, tables):
    """Landed listings straight to serving rows; defaults are filled before the dedupe."""
    rows = silver.build_display(landed_lines(spark, tables), ("ring", "bolt"))
    return rows.withColumns(
        {n: f(n) for n, f in (("publication_date", day), ("publication_timestamp", second))}
    )


# --- the star ----------------------------------------------------------------

ORDER_ROWS = """
    prepared AS (
        SELECT o.o_orderkey AS vacancy_id,
               coalesce(nullif(c.c_name, 'Customer#000000001'), 'Unknown') AS company_name,
               coalesce(nullif(n.n_name, 'NATION_3'), 'Unspecified') AS location_name,
               strftime(o.o_orderdate, '%Y-%m-%d') AS publication_date,
               strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS publication_timestamp,
               o.o_orderstatus || ' data' AS title, c.c_mktsegment AS description,
               o.o_orderpriority AS category,
               CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS salary
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey),
    company AS (
        SELECT CAST(row_number() OVER (ORDER BY company_name) AS INTEGER) AS company_id,
               company_name FROM (SELECT DISTINCT company_name FROM prepared)),
    location AS (
        SELECT CAST(row_number() OVER (ORDER BY location_name) AS INTEGER) AS location_id,
               location_name FROM (SELECT DISTINCT location_name FROM prepared))
"""


def order_listings(spark, tables):
    """Orders on the silver columns, with their customer and nation."""
    orders = table(spark, tables, "orders").withColumnRenamed("o_custkey", "c_custkey")
    customers = table(spark, tables, "customer").drop("c_acctbal")
    nations = table(spark, tables, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name"
    )
    joined = lookup_join(orders, customers, "c_custkey", "inner")
    return lookup_join(joined, nations, "c_nationkey", "inner").select(
        F.col("o_orderkey").alias("id"),
        F.concat("o_orderstatus", F.lit(" data")).alias("title"),
        F.nullif("c_name", F.lit("Customer#000000001")).alias("company_name"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_orderdate").cast("timestamp").alias("publication_date"),
        F.nullif("n_name", F.lit("NATION_3")).alias("candidate_required_location"),
        money("o_totalprice").alias("salary"),
        F.col("c_mktsegment").alias("description"),
    )


def order_star(spark, tables):
    return star.build(store(order_listings(spark, tables), "orders-silver"))


def vacancy_rows(spark, tables):
    """Serving rows without the detour over keys."""
    return serving.prepare(star.prepare(order_listings(spark, tables)))


@query("star_dim_company", f"WITH {ORDER_ROWS} SELECT company_id, company_name FROM company")
def star_dim_company(spark, tables):
    return order_star(spark, tables).dim_company


@query("star_dim_location", f"WITH {ORDER_ROWS} SELECT location_id, location_name FROM location")
def star_dim_location(spark, tables):
    return order_star(spark, tables).dim_location


@query(
    "star_fact",
    f"""
    WITH {ORDER_ROWS}
    SELECT p.vacancy_id, c.company_id, l.location_id, p.publication_date,
           p.publication_timestamp, p.title, p.description, p.category, p.salary
    FROM prepared p JOIN company c ON p.company_name = c.company_name
    JOIN location l ON p.location_name = l.location_name
    """,
)
def star_fact(spark, tables):
    return _dated(order_star(spark, tables).fct_vacancies)


def _dated(frame):
    return frame.withColumns(
        {
            "publication_date": day("publication_date"),
            "publication_timestamp": second("publication_timestamp"),
        }
    )


@query(
    "fk_integrity",
    f"""
    WITH {ORDER_ROWS}
    SELECT count(*) AS fact_rows, count(*) - count(c.company_id) AS without_company,
           count(*) - count(l.location_id) AS without_location
    FROM prepared p LEFT JOIN company c ON p.company_name = c.company_name
    LEFT JOIN location l ON p.location_name = l.location_name
    """,
)
def fk_integrity(spark, tables):
    return star.integrity(order_star(spark, tables))


@query(
    "serving_join",
    f"""
    WITH {ORDER_ROWS}
    SELECT vacancy_id AS "Id", publication_date AS "Publicatiedatum", title AS "Titel",
           company_name AS "Bedrijf", category AS "Categorie", location_name AS "Locatie",
           salary AS "Salaris", description AS "Beschrijving"
    FROM prepared
    """,
)
def serving_join(spark, tables):
    """The star joined back, on the serving columns under their display names."""
    built = order_star(spark, tables)
    joined = serving.denormalise(built.fct_vacancies, built.dim_company, built.dim_location)
    rows = serving.prepare(joined, sort=True)
    return serving.display(rows.withColumn("publication_date", day("publication_date")))


@query(
    "gold_sql",
    f"""
    WITH {ORDER_ROWS}
    SELECT location_name AS label, company_name, count(*) AS count,
           min(publication_date) AS first_day, max(vacancy_id) AS last_id
    FROM prepared WHERE trim(location_name) <> '' GROUP BY location_name, company_name
    """,
)
def gold_sql(spark, tables):
    """The star as SQL views, joined and counted by a plain statement."""
    order_star(spark, tables).create_views("orders_")
    return spark.sql(
        """
        SELECT l.location_name AS label, c.company_name, count(*) AS count,
               date_format(min(f.publication_date), 'yyyy-MM-dd') AS first_day,
               max(f.vacancy_id) AS last_id
        FROM orders_fct_vacancies f
        LEFT JOIN orders_dim_company c USING (company_id)
        LEFT JOIN orders_dim_location l USING (location_id)
        WHERE trim(l.location_name) <> ''
        GROUP BY l.location_name, c.company_name
        """
    )


# --- serving -----------------------------------------------------------------


@query(
    "top_events",
    """
    SELECT event_type AS label, count(*) AS count FROM events
    WHERE event_type IS NOT NULL AND trim(event_type) <> ''
    GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 5
    """,
)
def top_events(spark, tables):
    return serving.value_counts(table(spark, tables, "events"), "event_type", 5)


@query(
    "top_categories",
    f"""
    WITH {ORDER_ROWS}
    SELECT category AS label, count(*) AS count FROM prepared
    WHERE category IS NOT NULL AND trim(category) <> ''
    GROUP BY category ORDER BY count(*) DESC, category LIMIT 5
    """,
)
def top_categories(spark, tables):
    return serving.top_counts(vacancy_rows(spark, tables), "category", 5)


@query(
    "top_locations",
    f"""
    WITH {ORDER_ROWS}
    SELECT location_name AS label, count(*) AS count FROM prepared
    GROUP BY location_name ORDER BY count(*) DESC, location_name LIMIT 8
    """,
)
def top_locations(spark, tables):
    return serving.top_counts(vacancy_rows(spark, tables), "location_name", 8)


@query(
    "newest_vacancies",
    f"""
    WITH {ORDER_ROWS}
    SELECT row_number() OVER (ORDER BY publication_timestamp DESC NULLS LAST, vacancy_id) AS position,
           vacancy_id, publication_timestamp, title, company_name
    FROM prepared
    """,
)
def newest_vacancies(spark, tables):
    """The whole newest-first list, each row with its position."""
    newest = serving.newest_positions(vacancy_rows(spark, tables))
    return newest.select(
        "position", "vacancy_id", second("publication_timestamp"), "title", "company_name"
    )


@query(
    "kpis",
    f"""
    WITH {ORDER_ROWS}
    SELECT count(*) AS vacancies, count(DISTINCT company_name) AS companies,
           count(DISTINCT location_name) AS locations
    FROM prepared
    """,
)
def kpis(spark, tables):
    return serving.kpis(vacancy_rows(spark, tables))


SEARCHES = ("fr src", "ss", "the th", "%", "EN SRC1")


def _searchable(spark, tables):
    return table(spark, tables, "documents").select(
        "doc_id",
        F.col("lang").alias("title"),
        F.col("source").alias("company_name"),
        F.nullif("lang", F.lit("en")).alias("category"),
        F.lit("").alias("location_name"),
        F.col("text").alias("description"),
    )


_SEARCH_TEXT = """
    searchable AS (
        SELECT doc_id, replace(lower(lang || ' ' || source || ' ' ||
            coalesce(nullif(lang, 'en'), '') || ' ' || '' || ' ' || text), 'ß', 'ss') AS visible
        FROM documents)
"""


@query(
    "search",
    f"""
    WITH {_SEARCH_TEXT},
    queries AS (SELECT unnest(['fr src', 'ss', 'the th', '%', 'EN SRC1']) AS query)
    SELECT q.query, s.doc_id FROM searchable s JOIN queries q
    ON contains(s.visible, lower(q.query))
    """,
)
def search(spark, tables):
    """Several searches in one scan: the visible text is built and folded once."""
    folded = _searchable(spark, tables).select("doc_id", serving.visible_text().alias("text"))
    hits = [F.when(serving.matches(q, F.col("text")), F.lit(q)) for q in SEARCHES]
    return folded.select("doc_id", F.explode(F.array_compact(F.array(*hits))).alias("query"))


@query(
    "search_selectivity",
    f"""
    WITH {_SEARCH_TEXT}
    SELECT count(*) FILTER (contains(visible, 'straße') OR contains(visible, 'the th'))
           AS visible, count(*) AS total
    FROM searchable
    """,
)
def search_selectivity(spark, tables):
    return serving.selectivity(_searchable(spark, tables), "The TH")
