"""Ids of a merge pass the driver only while they are few."""

import random

import pytest

from listinglake.operators import silver
from listinglake.plans import incremental


def test_ids_beyond_the_limit_never_pass_the_driver(frame, monkeypatch):
    left, right = (frame([(n,) for n in range(start, 50)], "id bigint") for start in (0, 20))
    monkeypatch.setattr(incremental, "SMALL", 0)
    joined = incremental._by_same_id(left, right, "left_semi")
    assert sorted(r.id for r in joined.collect()) == list(range(20, 50))
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("limit", [0, incremental.BUCKETS << 20])
def test_captures_merge_alike_whatever_is_broadcast(spark, frame, monkeypatch, tmp_path, limit):
    rng = random.Random(5)
    rows = [
        (str(rng.randrange(40)), f"data {rng.randrange(4)}", rng.choice(["x", "y", None]), f"2026-01-{rng.randrange(1, 29):02d}")
        for _ in range(160)
    ]
    schema = "id string, title string, company_name string, publication_date string"
    monkeypatch.setattr(incremental, "SMALL", limit)
    for part in (rows[:80], rows[80:]):
        incremental.merge_capture(spark, str(tmp_path / "root"), frame(part, schema), buckets=4)
    columns = ["id", "title", "company_name", "publication_date"]
    wanted = silver.build(frame(rows, schema)).select(*columns).collect()
    assert sorted(map(str, incremental.read_silver(spark, str(tmp_path / "root")).select(*columns).collect())) == sorted(map(str, wanted))
