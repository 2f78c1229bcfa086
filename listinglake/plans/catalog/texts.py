"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from listinglake.functions import keys, text, times
from listinglake.functions import variants as V
from listinglake.operators.silver import relevant
from listinglake.operators.skew import lookup_join
from listinglake.plans.catalog.registry import query, second, table


@query(
    "html_strip",
    r"""
    SELECT page_id, nullif(trim(regexp_replace(
        replace(replace(replace(replace(replace(replace(
            regexp_replace(html, '<[^>]+>', ' ', 'g'),
            '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''),
            '&amp;', '&'),
        '\s+', ' ', 'g')), '') AS text
    FROM pages
    """,
)
def html_strip(spark, tables):
    pages = table(spark, tables, "pages")
    return pages.select("page_id", text.strip_html(F.col("html")).alias("text"))


@query(
    "text_clean",
    r"""
    SELECT doc_id, nullif(trim(regexp_replace(text, '\s+', ' ', 'g')), '') AS text,
           nullif(trim(regexp_replace(nullif(lang, 'fr'), '\s+', ' ', 'g')), '') AS lang
    FROM documents
    """,
)
def text_clean(spark, tables):
    lang = F.nullif(F.col("lang"), F.lit("fr"))
    return table(spark, tables, "documents").select(
        "doc_id",
        text.clean_text(F.col("text")).alias("text"),
        text.clean_text(lang).alias("lang"),
    )


@query(
    "text_default",
    """
    SELECT d.doc_id, coalesce(CAST(l.quality AS VARCHAR), '') AS quality,
           CASE WHEN l.quality IS NULL THEN d.source
                ELSE 'q' || CAST(l.quality AS VARCHAR) END AS origin
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """,
)
def text_default(spark, tables):
    labels = table(spark, tables, "labels").select("doc_id", "quality")
    docs = table(spark, tables, "documents").select("doc_id", "source")
    quality = text.text_or_empty(F.col("quality"))
    marked = F.when(quality != "", F.concat(F.lit("q"), quality)).otherwise("")
    return lookup_join(docs, labels, "doc_id").select(
        "doc_id",
        quality.alias("quality"),
        text.or_else(marked, F.col("source")).alias("origin"),
    )


@query(
    "keyword_filter",
    """
    SELECT l.l_orderkey AS id, l.l_linenumber, p.p_name AS title
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
    WHERE (contains(lower(p.p_name), 'ring') OR contains(lower(p.p_name), 'bolt'))
      AND l.l_orderkey IS NOT NULL
    """,
)
def keyword_filter(spark, tables):
    lines = table(spark, tables, "lineitem").select(
        F.col("l_orderkey").alias("id"), "l_linenumber", F.col("l_partkey").alias("p_partkey")
    )
    parts = table(spark, tables, "part").select("p_partkey", F.col("p_name").alias("title"))
    joined = lookup_join(lines, parts, "p_partkey", "inner").drop("p_partkey")
    return relevant(joined, ("ring", "bolt"))


@query(
    "keyword_documents",
    """
    SELECT doc_id, source FROM documents
    WHERE contains(lower(text), 'data') OR contains(lower(text), 'engineer')
       OR contains(lower(text), 'developer') OR contains(lower(text), 'python')
    """,
)
def keyword_documents(spark, tables):
    docs = table(spark, tables, "documents")
    titled = docs.select(F.col("doc_id").alias("id"), "source", F.col("text").alias("title"))
    return relevant(titled).select(F.col("id").alias("doc_id"), "source")


@query(
    "canonical_ids",
    """
    SELECT doc_id, (('0x' || substr(sha256(source || ':' || CAST(doc_id AS VARCHAR)), 1, 16))
        ::UBIGINT & 9223372036854775807::UBIGINT)::BIGINT AS id
    FROM documents
    """,
)
def canonical_ids(spark, tables):
    return table(spark, tables, "documents").select(
        "doc_id", keys.canonical_id(F.col("source"), F.col("doc_id")).alias("id")
    )


@query(
    "case_fold",
    """
    SELECT doc_id, replace(lower(text), 'ß', 'ss') AS folded FROM documents
    """,
)
def case_fold(spark, tables):
    docs = table(spark, tables, "documents")
    return docs.select("doc_id", text.fold(F.col("text")).alias("folded"))


@query(
    "timestamp_chain",
    """
    SELECT event_id,
           strftime(moment, '%Y-%m-%d %H:%M:%S') AS published,
           strftime(moment, '%Y-%m-%d') AS published_day
    FROM (
        SELECT event_id, CASE event_id % 7
            WHEN 3 THEN date_trunc('day', ts)
            WHEN 4 THEN date_trunc('second', ts) - INTERVAL 2 HOUR
            WHEN 5 THEN date_trunc('minute', ts)
            WHEN 6 THEN NULL
            ELSE date_trunc('second', ts) END AS moment
        FROM events)
    """,
)
def timestamp_chain(spark, tables):
    """Event times written the way boards write them, then parsed back."""
    ts = F.col("ts").cast("timestamp")

    def shown(pattern):
        return F.date_format(ts, pattern)

    kind = F.col("event_id") % 7
    published = (
        F.when(kind == 0, shown("yyyy-MM-dd'T'HH:mm:ss"))
        .when(kind == 1, shown("yyyy-MM-dd HH:mm:ss'.123Z'"))
        .when(kind == 2, shown("yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
        .when(kind == 3, shown("yyyy-MM-dd"))
        .when(kind == 4, shown("yyyy-MM-dd'T'HH:mm:ss' +0200'"))
        .when(kind == 5, shown("yyyy-MM-dd'T'HH:mm"))
        .otherwise(shown("EEE', 'dd MMM yyyy"))
    )
    parsed = times.parse_publication(published)
    return (
        table(spark, tables, "events")
        .select("event_id", parsed.alias("published"))
        .select(
            "event_id",
            second("published"),
            F.date_format(F.to_date("published"), "yyyy-MM-dd").alias("published_day"),
        )
    )


@query(
    "epoch_normalize",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS published FROM events
    """,
)
def epoch_normalize(spark, tables):
    """Seconds and milliseconds, as text and as JSON numbers, to one ISO text."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    seconds, millis = F.floor(micros / 1_000_000), F.floor(micros / 1_000)
    landed = F.when(F.col("event_id") % 2 == 0, seconds).otherwise(millis).cast("string")
    events = table(spark, tables, "events").select("event_id", landed.alias("landed"))
    typed = V.publication(F.parse_json("landed"))
    untyped = times.publication_text(F.col("landed"))
    return events.select(
        "event_id",
        F.when(F.col("event_id") % 3 == 0, typed).otherwise(untyped).alias("published"),
    )


@query(
    "first_tag",
    """
    SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN split_part(p_name, ' ', 1)
                           ELSE p_name END AS tag
    FROM part
    """,
)
def first_tag(spark, tables):
    """Tags landed as a list with blanks in front, or as one plain text."""
    blanks = F.array(F.lit(""), F.lit("  "))
    listed = F.to_json(F.struct(F.concat(blanks, F.split("p_name", " ")).alias("tags")))
    plain = F.to_json(F.struct(F.concat(F.lit(" "), "p_name").alias("tags")))
    landed = F.when(F.col("p_partkey") % 2 == 0, listed).otherwise(plain)
    parts = table(spark, tables, "part").select("p_partkey", F.parse_json(landed).alias("job"))
    return parts.select("p_partkey", V.first_tag(F.col("job"), "tags").alias("tag"))
