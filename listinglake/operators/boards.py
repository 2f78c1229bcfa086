"""Landed board responses to canonical bronze listings.

The listing array of a response body is read as raw JSON texts, whatever its size, and each
entry becomes a VARIANT. Members keep their JSON type, so an epoch number and quoted digits
stay apart, and an entry that is no object simply has no members. All boards go through one projection over one scan: a field is a CASE on
the board, not a union of three passes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listinglake.constants import BOARDS
from listinglake.functions import variants as V
from listinglake.functions.keys import canonical_id
from listinglake.functions.text import blank_to_null, strip, text_or_empty

# --- fixed values: where each board keeps a field; the first non-empty member wins
_ARRAYS = {"arbeitnow": "data"}
_NATIVE_ID = {"arbeitnow": ("slug", "url", "title")}
_TITLE = {"jobicy": ("jobTitle", "title")}
_COMPANY = {"jobicy": ("companyName", "company_name")}
_CATEGORY = {"jobicy": ("jobIndustry", "category")}
_PUBLISHED = {
    "jobicy": ("pubDate", "publication_date"),
    "arbeitnow": ("created_at", "publication_date"),
}
_LOCATION = {
    "jobicy": ("jobGeo", "candidate_required_location"),
    "arbeitnow": ("location",),
}
_DESCRIPTION = {"jobicy": ("jobDescription", "description")}


def parse(responses: DataFrame, body: str = "body") -> DataFrame:
    """Add ``payload`` (VARIANT), ``reason`` and ``accepted`` to landed responses.

    Accepted is valid JSON whose top level is an object. A valid body beyond the size of a
    VARIANT is accepted too and has no ``payload``.
    """
    valid = F.col("payload").isNotNull() | F.get_json_object(F.col(body), "$").isNotNull()
    reason = F.when(~valid, "not valid JSON").when(
        ~strip(F.col(body)).startswith("{"), "not a JSON object"
    )
    return (
        responses.withColumn("payload", F.try_parse_json(F.col(body)))
        .withColumn("reason", reason)
        .withColumn("accepted", F.col("reason").isNull())
    )


def split(responses: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(accepted with ``payload``, rejected with ``reason``)."""
    parsed = parse(responses, body)
    return (
        parsed.where("accepted").drop("accepted", "reason"),
        parsed.where("not accepted").drop("accepted", "payload"),
    )


def entries(body: Column, name: str) -> Column:
    """The array ``name`` of a body as raw JSON texts; null when there is none."""
    return F.from_json(body, f"`{name}` array<string>")[name]


def declared_count(payload: Column, body: Column | None = None) -> Column:
    """``job-count`` when present, else the length of ``jobs``, else ``unknown``.

    ``body`` answers for what has no ``payload``.
    """

    def counted(jobs: Column) -> Column:
        return F.when(F.size(jobs) >= 0, F.size(jobs).cast("string"))

    found = [V.field(payload, "job-count"), counted(V.items(payload, "jobs"))]
    if body is not None:
        found += [F.get_json_object(body, "$['job-count']"), counted(entries(body, "jobs"))]
    return F.coalesce(*found, F.lit("unknown"))


def actual_count(payload: Column, body: Column | None = None) -> Column:
    jobs = F.size(V.items(payload, "jobs"))
    if body is not None:
        jobs = F.when(payload.isNull(), F.size(entries(body, "jobs"))).otherwise(jobs)
    return F.greatest(jobs, F.lit(0)).cast("bigint")


def _per_board(boards: Sequence[str], special: dict, default, make) -> Column:
    """CASE over the boards that differ; boards with equal rules share a branch."""
    source, result = F.col("source"), None
    rules = {board: special.get(board, default) for board in boards}
    for rule in dict.fromkeys(rules.values()):
        names = [board for board, its in rules.items() if its == rule]
        test = source.isin(*names)
        result = F.when(test, make(rule)) if result is None else result.when(test, make(rule))
    return result


def _members(*tables: dict[str, tuple[str, ...]]) -> list[str]:
    """All member names of the given field tables, each once."""
    return list(dict.fromkeys(name for table in tables for names in table.values() for name in names))


_SHARED = (
    "id",
    "title",
    "company_name",
    "category",
    "candidate_required_location",
    "salary",
    "description",
    "url",
)
_DATES = list(dict.fromkeys(["publication_date", *_members(_PUBLISHED)]))
_TEXTS = list(
    dict.fromkeys(
        [*_SHARED, *_members(_NATIVE_ID, _TITLE, _COMPANY, _CATEGORY, _LOCATION, _DESCRIPTION)]
    )
)


def raw_entries(boards: Sequence[str] = BOARDS) -> Column:
    """The listing array of a response's board as raw JSON texts; null when there is none."""
    return _per_board(boards, _ARRAYS, "jobs", lambda name: entries(F.col("body"), name))


def unreadable(responses: DataFrame, raw: str, carry: Sequence[str] = ()) -> DataFrame:
    """(carry, entry): objects of the array column ``raw`` that no VARIANT takes.

    They are beyond its size, or have one member twice.
    """
    each = responses.select(*carry, F.explode(raw).alias("entry"))
    return each.where(F.ltrim("entry").startswith("{") & F.try_parse_json("entry").isNull())


def listings(
    responses: DataFrame,
    carry: Sequence[str] = (),
    boards: Sequence[str] = BOARDS,
    raw: Column | None = None,
) -> DataFrame:
    """One raw listing per array entry: its ``position``, the ``job`` and its members.

    Needs ``source``, ``query_category`` and ``body``, or the array ``raw`` that was already
    read from it. Each entry is opened once, before
    the explode: a filter on members then reads them, where a filter on the entry would
    walk it again per member. A rejected response has no array; the outer explode gives
    it one row without members, which :func:`normalise` drops, and keeps Spark from
    parsing each body a second time in a filter of its own.
    """
    raw = raw_entries(boards) if raw is None else raw
    parsed = F.transform("entries", F.try_parse_json)
    opened = F.transform(
        parsed,
        lambda job: F.struct(job.alias("job"), V.opened(job, _TEXTS, _DATES).alias("members")),
    )
    return (
        responses.select(*carry, "source", "query_category", raw.alias("entries"))
        .select(*carry, "source", "query_category", F.posexplode_outer(opened).alias("position", "e"))
        .select(*carry, "source", "query_category", "position", "e.job", "e.members")
    )


def normalise(
    jobs: DataFrame, carry: Sequence[str] = (), boards: Sequence[str] = BOARDS
) -> DataFrame:
    """Raw listings of any mix of boards on the canonical columns.

    ``query_category`` is the category that was asked for. Listings without a native
    id or a title go.
    """
    job = F.col("job")

    def member(name: str) -> Column:
        return F.col(f"members.{name}")

    def truthy(name: str) -> Column:
        text = member(name)
        if name in _DATES:
            text = F.try_variant_get(text, "$", "string")
        return V.is_truthy(text, V.kind(job, name))

    def first_truthy(names: tuple[str, ...], read=member) -> Column:
        """The first truthy member; the last one is taken as it is."""
        *first, last = names
        found = read(last)
        for name in reversed(first):
            found = F.when(truthy(name), read(name)).otherwise(found)
        return found

    def text(table: dict, default: str) -> Column:
        return _per_board(
            boards, table, (default,), lambda names: text_or_empty(first_truthy(names))
        )

    def native(names: tuple[str, ...]) -> Column:
        if len(names) == 1:
            return member(names[0])
        found = F.when(truthy(names[-1]), member(names[-1]))
        for name in reversed(names[:-1]):
            found = F.when(truthy(name), member(name)).otherwise(found)
        return found

    def category(names: tuple[str, ...] | None) -> Column:
        if names is None:
            return V.first_tag(job, "tags")
        return text_or_empty(
            first_truthy(names, lambda name: V.listed_text(job, name, member(name)))
        )

    rows = jobs.select(
        *carry,
        "source",
        "query_category",
        _per_board(boards, _NATIVE_ID, ("id",), native).alias("native"),
        text(_TITLE, "title").alias("title"),
        text(_COMPANY, "company_name").alias("company_name"),
        _per_board(boards, {**_CATEGORY, "arbeitnow": None}, ("category",), category).alias(
            "category"
        ),
        _per_board(boards, _PUBLISHED, ("publication_date",), first_truthy).alias("published"),
        text(_LOCATION, "candidate_required_location").alias("candidate_required_location"),
        text_or_empty(member("salary")).alias("salary"),
        text(_DESCRIPTION, "description").alias("description"),
        text_or_empty(member("url")).alias("url"),
    )
    return rows.where(F.col("native").isNotNull() & (F.col("title") != "")).select(
        *carry,
        canonical_id(F.col("source"), F.col("native")).alias("id"),
        "source",
        strip(F.col("native")).alias("source_job_id"),
        "query_category",
        "title",
        "company_name",
        F.coalesce(blank_to_null(F.col("category")), F.col("query_category")).alias("category"),
        V.publication(F.col("published")).alias("publication_date"),
        "candidate_required_location",
        "salary",
        "description",
        "url",
    )


def union_boards(
    responses: DataFrame, boards: Sequence[str] = BOARDS, raw: Column | None = None
) -> DataFrame:
    """Listings of all boards; ``request_seq`` and ``position`` give the arrival order."""
    return normalise(
        listings(responses, ["request_seq"], boards, raw), ["request_seq", "position"], boards
    )
