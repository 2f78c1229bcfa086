import random
from datetime import datetime

import models
import pytest
from pyspark.sql import functions as F

from listinglake.operators import arrival, skew
from listinglake.operators.numbering import dense_keys
from listinglake.operators.ranking import latest_on_two_keys, latest_per_key

LISTING = "id bigint, title string, company_name string, day timestamp, note string"


def day(number):
    return datetime(2026, 9, number) if number else None


def test_latest_wins_and_nulls_lose(frame):
    rows = [(1, "a", "x", day(1), "old"), (1, "a", "x", day(3), "new"), (1, "a", "x", None, "none"),
            (2, "b", "y", None, "only")]
    found = latest_per_key(frame(rows, LISTING), ["id"], "day").collect()
    assert sorted((r.id, r.note) for r in found) == [(1, "new"), (2, "only")]


def test_second_key_runs_on_winners_only(frame):
    # id 1's newest row has another title, so its old row must not beat id 2.
    rows = [(1, "a", "x", day(5), "w"), (1, "b", "x", day(9), "w"), (2, "a", "x", day(1), "w"),
            (3, "a", None, day(2), "w"), (4, "a", None, day(2), "w"), (5, "A", "x", day(1), "w")]
    found = latest_on_two_keys(frame(rows, LISTING), "id", ["title", "company_name"], "day")
    assert sorted(r.id for r in found.collect()) == [1, 2, 3, 5]


def test_survivors_do_not_depend_on_row_order(frame):
    rows = [(i % 7, f"t{i % 3}", f"c{i % 2}", day(1 + i % 2), f"n{i}") for i in range(60)]
    results = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        data = frame(rows, LISTING).repartition(1 + seed * 3)
        found = latest_on_two_keys(data, "id", ["title", "company_name"], "day").collect()
        results.add(tuple(sorted(map(tuple, found), key=repr)))
    assert len(results) == 1


def test_a_hot_key_is_cut_before_the_shuffle(frame):
    data = frame([(1, "a", "x", day(1), "n")] * 50, LISTING).repartition(8)
    plan = latest_per_key(data, ["id"], "day")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


EDGES = "arrival bigint, id bigint, pair string"


def stays(frame, rows, **options):
    kept = arrival.first_arrivals(
        frame(rows, EDGES), F.col("id"), [F.col("pair")], F.col("arrival"), **options
    )
    return sorted(r.arrival for r in kept.collect())


def test_dropped_rows_block_nothing(frame):
    assert stays(frame, [(1, 1, "A"), (2, 2, "A"), (3, 2, "B")]) == [1, 3]


@pytest.mark.parametrize("seed", range(4))
def test_first_arrivals_equal_the_model(frame, seed):
    draw = random.Random(seed)
    width = draw.choice([5, 40, 300])
    rows = [(i, draw.randrange(width), f"p{draw.randrange(width)}") for i in range(1500)]
    options = [
        {},
        {"slice_rows": 20},
        {"progress": 2.0, "slice_rows": 50},
        {"slice_rows": 0, "hot_rows": 1},
    ][seed]
    assert stays(frame, rows, **options) == models.first_arrivals(rows)


def test_a_long_chain_goes_through_slices(frame):
    rows = [(i, (i + 1) // 2, f"p{i // 2}") for i in range(3000)]
    found = stays(frame, rows, slice_rows=700)
    assert found == models.first_arrivals(rows)


def test_a_hot_pair_and_copies(frame):
    rows = [(i, i, "hot") for i in range(500)] + [(500 + i, 1, "copy") for i in range(500)]
    rows += [(1000 + i, 5000 + i, f"own{i}") for i in range(300)]
    assert stays(frame, rows, hot_rows=50, slice_rows=0) == models.first_arrivals(rows)


def test_two_part_arrival_keeps_order(frame):
    parts = [(-3, 0), (0, 0), (0, 2**31 - 1), (1, 0), (2**63 - 1, 5)]
    data = frame(parts[::-1], "a bigint, b int")
    found = data.orderBy(arrival.two_part_arrival("a", "b")).collect()
    assert [tuple(r) for r in found] == parts


KEYS = {
    "timestamp": "timestamp_micros(k)",
    "decimal": "cast(k as decimal(20, 6)) / 1000000",
    "double": "cast(k as double)",
}


@pytest.mark.parametrize("kind", KEYS)
@pytest.mark.parametrize("options", [{}, {"slice_rows": 0}, {"progress": 2.0, "slice_rows": 2}])
def test_keys_of_any_type_are_compared_by_value(frame, kind, options):
    # Keys a microsecond apart, which text forms of a timestamp would merge.
    rows = [(1, 1, "A"), (2, 2, "A"), (3, 2, "B"), (4, 11, "C"), (5, 3, "C"), (6, 3, "D")]
    rows += [(7, None, "E"), (8, None, "F")]
    data = frame(rows, "arrival bigint, k bigint, pair string").selectExpr(
        "arrival", f"{KEYS[kind]} as id", "pair"
    )
    kept = arrival.first_arrivals(data, F.col("id"), [F.col("pair")], F.col("arrival"), **options)
    assert sorted(r.arrival for r in kept.collect()) == [1, 3, 4, 6, 7]


def test_no_rows_no_winners(frame):
    assert stays(frame, []) == []


def test_null_keys_count_as_equal(frame):
    rows = [(1, None, "a"), (2, None, "b"), (3, 3, None), (4, 4, None)]
    assert stays(frame, rows) == [1, 3]
    assert stays(frame, rows, slice_rows=0) == [1, 3]


@pytest.mark.parametrize("partitions", [1, 8])
def test_dense_keys_follow_name_order(spark, frame, partitions):
    draw = random.Random(partitions)
    names = [f"{draw.randrange(3000)}é{draw.choice('Abß')}" for _ in range(6000)] + ["hot"] * 3000
    data = frame([(n,) for n in names], "name string").repartition(partitions)
    numbered = dense_keys(data, "name", "id")
    wanted = sorted(set(names), key=lambda n: n.encode())
    found = sorted(numbered.frame.collect(), key=lambda r: r.id)
    assert [(r.id, r.name) for r in found] == list(enumerate(wanted, 1))
    assert numbered.frame.dtypes == [("id", "int"), ("name", "string")]
    hot = numbered.hot(rows=1000).collect()
    assert [r._fan for r in hot] == [3]
    assert numbered.hot() is None


JOINS = ("inner", "left", "left_semi", "left_anti")


@pytest.mark.parametrize("how", JOINS)
def test_spread_join_equals_the_plain_join(frame, how):
    draw = random.Random(3)
    keys = ["hot"] * 400 + [None] * 200 + [f"k{draw.randrange(50)}" for _ in range(400)]
    left = frame([(k, i) for i, k in enumerate(keys)], "k string, v int").repartition(6)
    right = frame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 50, 2)], "k string, w int")
    hot = skew.hot_keys(left, ["k"], rows=100)
    fans = sorted(r._fan for r in hot.collect())
    assert fans == [2, 4]
    plain = sorted(map(repr, left.join(right, "k", how).collect()))
    salted = skew.spread_join(left, right, ["k"], how, hot, ["v"])
    assert sorted(map(repr, salted.collect())) == plain
    by_task = skew.spread_join(left, right, ["k"], how, hot)
    assert sorted(map(repr, by_task.collect())) == plain


def test_lookup_join_broadcasts_only_what_it_measured(frame):
    left = frame([(i % 3, i) for i in range(30)], "k int, v int")
    right = frame([(0, "zero"), (1, "one")], "k int, name string")
    wanted = sorted(map(repr, left.join(right, "k", "left").collect()))
    for limit, hot_rows in ((10**6, 10**6), (0, 10**6), (0, 5)):
        joined = skew.lookup_join(left, right, "k", "left", limit, hot_rows)
        assert sorted(map(repr, joined.select("k", "v", "name").collect())) == wanted
    plan = skew.lookup_join(left, right, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert skew.measured_bytes(right) >= 2 * 64 + len("zeroone")
