"""Each landed entry is parsed once."""

import pytest

from listinglake.operators import silver
from listinglake.sources import landing


@pytest.fixture
def entries(frame):
    found = [
        '{"id": 1, "title": "data a", "salary": {"min": 1.50}}', ' \n{"id": "2", "title": "python b"}', "3", "null",
        '"text"', "[1]", '{"id": 4, "id": 5}', '{"id": 6', "{}", None,
    ]
    return frame([("f", True, entry, None) for entry in found], "file string, whole boolean, entry string, text string")


def test_an_entry_is_parsed_once_whatever_is_asked_of_its_fields(entries):
    rows = silver.relevant(silver.project(landing.listings_of(entries)))
    plan = rows._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("parsejson") + plan.count("parse_json") == 1


def test_parsed_entries_give_the_same_listings_and_quarantine(entries):
    parsed = landing.parsed(entries)
    found = {(r.id, r.title, r.salary) for r in landing.listed(parsed).collect()}
    assert found == {("1", "data a", '{"min":1.5}'), ("2", "python b", None), (None, None, None)}
    texts = {r.text for r in landing.quarantine_of(parsed).collect()}
    assert texts == {r.text for r in landing.quarantine_of(entries).collect()} == {'{"id": 4, "id": 5}', '{"id": 6'}
