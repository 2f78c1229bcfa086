import json
import random

import models
import pytest
from pyspark.sql import functions as F

from listinglake import schemas
from listinglake.errors import NothingCollectedError
from listinglake.operators import boards, requests
from listinglake.plans.collect import collect

RESPONSES = schemas.RESPONSES


def response(seq, source, body, page=None, error=None, category="dev", run="r"):
    text = body if isinstance(body, str) or body is None else json.dumps(body)
    return seq, source, run, category, page, {"n": str(seq)}, text, error


REMOTIVE = dict(id=7, title=" Data Engineer ", company_name="Acme", category="", salary=5,
                publication_date="2026-09-21T12:00:00", candidate_required_location="EU",
                description="<p>x</p>", url="http://x", extra={"a": 1})
JOBICY = dict(id=7, jobTitle="Python", companyName="Beta", jobIndustry=["Dev", "Ops"], jobGeo="USA",
              jobDescription="d", pubDate="2026-09-21 12:00:00", url="u")
ARBEITNOW = dict(slug="php-7", title="PHP", company_name="Gamma", tags=["", "php"], location="Berlin",
                 created_at=1780000000, description="d", url="u")


def canonical(frame, *rows):
    found = boards.union_boards(frame(list(rows), RESPONSES))
    assert [c for c in found.columns if c not in ("request_seq", "position")] == [
        n for n, _ in schemas.fields(schemas.BRONZE)]
    return found.orderBy("request_seq", "position").collect()


def test_three_boards_on_one_shape(frame):
    first, second, third = canonical(
        frame, response(1, "remotive", {"jobs": [REMOTIVE]}),
        response(2, "jobicy", {"jobs": [JOBICY]}), response(3, "arbeitnow", {"data": [ARBEITNOW]}))
    assert (first.id, first.source_job_id) == (4320693985432383462, "7")
    assert (first.title, first.category, first.salary) == ("Data Engineer", "dev", "5")
    assert (second.title, second.company_name, second.category) == ("Python", "Beta", "['Dev', 'Ops']")
    assert (second.candidate_required_location, second.publication_date) == ("USA", "2026-09-21 12:00:00")
    assert (third.source_job_id, third.category) == ("php-7", "php")
    assert third.publication_date == "2026-05-28T20:26:40"
    assert len({first.id, second.id, third.id}) == 3


@pytest.mark.parametrize(
    "source, job, kept",
    [
        ("remotive", {"id": None, "title": "x"}, None),
        ("remotive", {"id": 1, "title": "  "}, None),
        ("remotive", {"title": "x"}, None),
        ("remotive", {"id": 0, "title": "x"}, "0"),
        ("jobicy", {"id": 1, "jobTitle": "  ", "title": "x"}, None),
        ("jobicy", {"id": 1, "jobTitle": "", "title": "x"}, "1"),
        ("jobicy", {"id": 1, "jobTitle": 0, "title": "x"}, "1"),
        ("arbeitnow", {"slug": "", "url": "u", "title": "x"}, "u"),
        ("arbeitnow", {"slug": 0, "title": "x"}, "x"),
        ("arbeitnow", {"slug": "s", "title": ""}, None),
        ("arbeitnow", 5, None),
        ("remotive", ["x"], None),
        ("remotive", None, None),
    ],
)
def test_what_makes_a_listing(frame, source, job, kept):
    body = {"data": [job], "jobs": [job]}
    assert [r.source_job_id for r in canonical(frame, response(1, source, body))] == (
        [kept] if kept else [])


def test_epoch_zero_falls_back(frame):
    job = {**ARBEITNOW, "created_at": 0, "publication_date": "2026-01-01"}
    assert canonical(frame, response(1, "arbeitnow", {"data": [job]}))[0].publication_date == "2026-01-01"


def test_responses_must_be_objects(frame):
    rows = [response(1, "remotive", {"jobs": []}), response(2, "remotive", "<html>"),
            response(3, "remotive", "[1]"), response(4, "remotive", ""), response(5, "remotive", None),
            response(6, "remotive", ' \n{"a": 1}'), response(7, "remotive", "3")]
    good, bad = boards.split(frame(rows, RESPONSES))
    assert sorted(r.request_seq for r in good.collect()) == [1, 6]
    assert {r.request_seq: r.reason for r in bad.collect()} == {
        2: "not valid JSON", 3: "not a JSON object", 4: "not valid JSON", 5: "not valid JSON",
        7: "not a JSON object"}


def test_declared_and_actual_counts(frame):
    bodies = [{"job-count": 9, "jobs": [1]}, {"jobs": [1, 2]}, {"jobs": "x"}, {}]
    data = frame([(json.dumps(b),) for b in bodies], "body string").select(F.parse_json("body").alias("p"))
    found = data.select(boards.declared_count(F.col("p")), boards.actual_count(F.col("p"))).collect()
    assert [tuple(r) for r in found] == [("9", 1), ("2", 2), ("unknown", 0), ("unknown", 0)]


def test_collection_survives_partial_failure(frame):
    page = {"data": [ARBEITNOW], "links": {"next": "n"}}
    rows = [
        response(1, "remotive", None, error="HTTP 500"),
        response(2, "jobicy", {"jobs": [JOBICY, {**JOBICY, "id": 8, "jobTitle": "PYTHON", "companyName": "BETA"}, 3]}),
        response(3, "arbeitnow", page, page=1),
        response(4, "arbeitnow", {**page, "data": [{**ARBEITNOW, "slug": "b", "title": "Go"}], "links": {}}, page=2),
        response(5, "arbeitnow", {**page, "data": [{**ARBEITNOW, "slug": "c", "title": "C"}]}, page=3),
    ]
    found = collect(frame(rows, RESPONSES))
    assert sorted(r.title for r in found.listings.collect()) == ["Go", "PHP", "Python"]
    attempts = {(r.source, r.page): (r.added, r.error) for r in found.attempts.collect()}
    assert attempts == {("remotive", None): (None, "HTTP 500"), ("jobicy", None): (1, None),
                        ("arbeitnow", 1): (1, None), ("arbeitnow", 2): (1, None)}
    assert found.attempts.dtypes == [tuple(f) for f in schemas.fields(schemas.ATTEMPTS)]
    assert {r.request_seq: r.reason for r in found.rejected.collect()} == {
        1: "HTTP 500", 5: "behind the stop of its run"}
    assert tuple(requests.tally(found.attempts).first()) == (4, 1, 3)
    row = requests.catalogue(found.listings, "now").first()
    assert (row.job_count, row.sources, row.categories) == (3, ["arbeitnow", "jobicy"], ["dev"])


def test_a_failed_page_is_asked_but_ends_the_run(frame):
    page = {"data": [ARBEITNOW], "links": {"next": "n"}}
    rows = [response(1, "arbeitnow", page, page=1), response(2, "arbeitnow", "oops", page=2),
            response(3, "arbeitnow", {**page, "data": [{**ARBEITNOW, "slug": "z", "title": "Z"}]}, page=3)]
    found = collect(frame(rows, RESPONSES))
    assert [r.title for r in found.listings.collect()] == ["PHP"]
    assert sorted((r.page, r.error) for r in found.attempts.collect()) == [
        (1, None), (2, "not valid JSON")]


def test_nothing_collected_is_an_error(frame):
    rows = [response(1, "remotive", None, error="down"), response(2, "jobicy", {"jobs": []})]
    with pytest.raises(NothingCollectedError, match="1 failed"):
        collect(frame(rows, RESPONSES))


@pytest.mark.parametrize("hot_rows", [10**6, 10])
def test_page_prefix_equals_the_model(frame, monkeypatch, hot_rows):
    draw = random.Random(hot_rows)
    rows = []
    for run in range(40):
        for page in range(1, draw.choice([2, 6, 50])):
            for _ in range(draw.choice([0, 1, 1, 1, 1, 1, 1, 1, 2])):
                rows.append((len(rows), f"run{run}", page, draw.random() > 0.05,
                             draw.choice([0] + [5] * 15), draw.random() > 0.05))
    rows += [(len(rows) + i, "full", i + 1, True, 5, True) for i in range(60)]
    if hot_rows < 100:
        small = requests.hot_from_counts
        monkeypatch.setattr(requests, "hot_from_counts", lambda c, t: small(c, t, rows=hot_rows))
    data = frame(rows, "n bigint, run string, page bigint, ok boolean, entries bigint, has_next boolean")
    for bound in (None, 40, 1):
        found = sorted(r.n for r in requests.page_prefix(data, ["run"], bound).collect())
        wanted = []
        for run in {r[1] for r in rows}:
            read = models.page_prefix([r[2:] for r in rows if r[1] == run], bound or 10**6)
            wanted += [r[0] for r in rows if r[1] == run and r[2] in read and r[3]]
        assert found == sorted(wanted)
    with pytest.raises(ValueError):
        requests.page_prefix(data, ["run"], max_pages=0)


def test_all_landed_pages_count_unless_bounded(frame):
    rows = [
        response(n, "arbeitnow", {"data": [{**ARBEITNOW, "slug": f"s{n}", "title": f"T{n}"}],
                                  "links": {"next": "n"}}, page=n)
        for n in range(1, 61)
    ]
    data = frame(rows, RESPONSES)
    whole = collect(data)
    assert whole.listings.count() == 60 and whole.rejected.count() == 0
    bounded = collect(data, max_pages=40)
    assert bounded.listings.count() == 40
    assert sorted(r.request_seq for r in bounded.rejected.collect()) == list(range(41, 61))
    assert {r.reason for r in bounded.rejected.collect()} == {"behind the stop of its run"}


def test_request_expansion(frame):
    data = frame([("dev",), ("data",), ("software-dev",), ("backend",), ("qa",)], "category string")
    found = {}
    for r in requests.expand_categories(data).orderBy("category", "query_no").collect():
        found.setdefault(r.category, []).append(r.params)
    assert found == {
        "dev": [{"count": "100", "industry": "dev"}],
        "data": [{"count": "100", "tag": "data"}, {"count": "100", "industry": "data-science"}],
        "software-dev": [{"count": "100", "tag": "software-dev"}, {"count": "100", "industry": "dev"}],
        "backend": [{"count": "100", "tag": "backend"}],
        "qa": [{"count": "100", "tag": "qa"}],
    }


def test_an_entry_no_variant_takes_is_rejected(frame):
    """Such an entry costs itself, is reported, and its neighbours count."""
    twice = '{"id":9,"id":10,"title":"data"}'
    body = '{"jobs": [' + json.dumps(REMOTIVE) + ", " + twice + ", 3, null]}"
    found = collect(frame([response(1, "remotive", body), response(2, "jobicy", "oops")], RESPONSES))
    assert [r.title for r in found.listings.collect()] == ["Data Engineer"]
    rejected = {(r.request_seq, r.reason): len(r.body) for r in found.rejected.collect()}
    assert rejected == {(1, "unreadable entry"): len(twice), (2, "not valid JSON"): 4}
