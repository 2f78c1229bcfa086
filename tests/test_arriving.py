"""Pages as they arrive, drifting schemas, member sets and packed captures."""

import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from listinglake import schemas
from listinglake.operators import heavy, members, requests, serving
from listinglake.sinks import bronze, compaction
from listinglake.sources import drift
from listinglake.streaming import pages


def rows_of(frame):
    return sorted(map(tuple, frame.select(*sorted(frame.columns)).collect()), key=repr)


# --- pages ------------------------------------------------------------------------------------


def made_up_pages(rng, n):
    return [
        (seq, rng.choice("abc"), rng.randrange(0, 9), rng.random() < 0.8, rng.choice([0, 5, 5, 5]), rng.random() < 0.9)
        for seq in range(n)
    ]


def test_any_order_of_arrival_gives_the_batch_prefix(spark, tmp_path):
    rng = random.Random(7)
    rows = made_up_pages(rng, 90) + [(900 + k, "long", 40 - k, True, 1, k > 0) for k in range(40)]
    rows += [(1000, "none", 2, True, 1, True), (1001, "late", 1, False, 1, True), (1002, None, 1, True, 1, True)]
    rng.shuffle(rows)
    folder, target = str(tmp_path / "landed"), str(tmp_path / "used")
    seen = spark.createDataFrame([], pages.PAGES)
    for start in range(0, len(rows), 50):
        # A call after each landing goes on from the checkpoint, as after a stop or a failure.
        batch = spark.createDataFrame(rows[start : start + 50], pages.PAGES)
        batch.repartition(3).write.mode("append").parquet(folder)
        pages.land_used_pages(spark, folder, target, str(tmp_path / "progress"), 2).awaitTermination()
        seen = seen.union(batch)
        wanted = requests.page_prefix(seen.where("run IS NOT NULL"), ["run"]).select("request_seq", "run", "page")
        assert rows_of(spark.read.schema(pages.USED).parquet(target)) == rows_of(wanted)
    assert sum(row[2] == "long" for row in rows_of(spark.read.schema(pages.USED).parquet(target))) == 40


# --- drift ------------------------------------------------------------------------------------


def test_drift_names_each_member_of_each_capture(spark):
    listings = [
        ("a", {"id": 1, "title": "x", "salary": None}),
        ("a", {"id": 2, "title": "y", "company": {"name": "z"}}),
        ("b", {"id": "3", "title": ["x"], "salary": 5}),
        ("b", {"id": 4, "title": "x"}),
        ("c", {}),
    ]
    entries = [(capture, json.dumps(job)) for capture, job in listings]
    entries += [("a", None), ("a", "3"), ("b", "null"), ("d", '"text"'), ("a", '{"id": 5, "broken')]
    frame = spark.createDataFrame(entries, "capture string, entry string")
    found = {
        (r.capture, r.member): (r.status, r.present, r.listings, r.found)
        for r in drift.drift(frame, "id bigint, title string, salary string", "capture").collect()
    }
    assert found == {
        ("a", "id"): ("as declared", 2, 2, "BIGINT"),
        ("a", "title"): ("as declared", 2, 2, "STRING"),
        ("a", "salary"): ("as declared", 1, 2, "VOID"),
        ("a", "company"): ("unknown", 1, 2, "OBJECT<name: STRING>"),
        ("b", "id"): ("other type", 2, 2, "VARIANT"),
        ("b", "title"): ("other type", 2, 2, "VARIANT"),
        ("b", "salary"): ("other type", 1, 2, "BIGINT"),
        ("c", "id"): ("absent", 0, 1, None),
        ("c", "title"): ("absent", 0, 1, None),
        ("c", "salary"): ("absent", 0, 1, None),
    }
    assert drift.drift(frame.limit(0), capture="capture").count() == 0


# --- members ----------------------------------------------------------------------------------


def test_member_sets_count_and_merge_exactly(spark):
    rng = random.Random(8)
    left = [rng.randrange(1, 200_000) for _ in range(5000)]
    right = [rng.randrange(1, 200_000) for _ in range(5000)]
    sets = [
        members.member_set(spark.createDataFrame([(k,) for k in [*keys, None, *keys[:9]]], "k int"), "k")
        for keys in (left, right)
    ]
    assert [members.size(s).first()[0] for s in sets] == [len(set(left)), len(set(right))]
    assert members.size(members.merged(sets)).first()[0] == len({*left, *right})
    assert members.size(members.common(*sets)).first()[0] == len(set(left) & set(right))
    assert members.size(sets[0].limit(0)).first()[0] == 0


def test_figures_expand_no_row(spark):
    fact = spark.range(1000).select((F.col("id") % 7 + 1).alias("c"), (F.col("id") % 3 + 1).alias("l"))
    made = members.figures(fact, {"companies": "c", "locations": "l"})
    assert made.first().asDict() == {"vacancies": 1000, "companies": 7, "locations": 3}
    assert "Expand" not in made._jdf.queryExecution().executedPlan().toString()
    assert members.figures(fact.limit(0), {"companies": "c"}).first().asDict() == {"vacancies": 0, "companies": 0}


# --- most frequent values ---------------------------------------------------------------------


def test_top_values_are_exact_and_proven_where_they_stand_out(spark):
    rng = random.Random(9)
    values = [rng.choice(["a", "b", "b", "c", "c", "c"]) for _ in range(3000)] + [f"x{k}" for k in range(30_000)]
    values += ["", " ", None] * 5000
    rng.shuffle(values)
    frame = spark.createDataFrame([(v,) for v in values], "v string").repartition(8)
    wanted = [(r.label, r["count"]) for r in serving.value_counts(frame, "v", 3).collect()]
    top = heavy.top_values(frame, "v", 3)
    assert top.proven and [(r.label, r["count"]) for r in top.frame.collect()] == wanted
    # Far fewer tracked items than values: the bound is too wide for the third of them.
    few = heavy.top_values(frame, "v", 3, tracked=64)
    assert not few.proven and [(r.label, r["count"]) for r in few.frame.collect()] == wanted
    alike = heavy.top_values(frame, "v", 50)
    assert not alike.proven
    assert [tuple(r) for r in alike.frame.collect()] == [tuple(r) for r in serving.value_counts(frame, "v", 50).collect()]
    some = frame.where("v < 'd'")
    small = heavy.top_values(some, "v", 9)
    assert small.proven and [r.label for r in small.frame.collect()] == ["c", "b", "a"]
    assert heavy.top_values(frame.limit(0), "v", 3).frame.count() == 0


# --- compaction -------------------------------------------------------------------------------


def capture(spark, low, high):
    values = {n: F.lit("v") for n, k in schemas.fields(schemas.BRONZE) if k == "string" and n != "title"}
    return spark.range(low, high).withColumns(values).withColumn("title", F.repeat(F.lit("t"), 200))


def packed_files(folder):
    return sorted(p.stat().st_size for p in (folder / "_compacted").rglob("*.parquet"))


def test_packed_captures_hold_the_same_rows_in_few_files(spark, tmp_path):
    folder = tmp_path / "bronze"
    for day in (1, 2):
        rows = capture(spark, 1000 * day, 1000 * day + 600).repartition(20)
        bronze.write_bronze(rows, str(folder), datetime(2026, 1, day))
    before = rows_of(compaction.read_captures(spark, str(folder)))
    done = compaction.compact(spark, str(folder), target_bytes=100_000)
    assert (done.captures, done.files_in) == (2, 40) and 4 <= done.files_out <= 10
    assert len(packed_files(folder)) == done.files_out
    assert rows_of(compaction.read_captures(spark, str(folder))) == before
    assert len({row[6] for row in before}) >= 20  # the landed file of every row is kept
    assert compaction.compact(spark, str(folder), target_bytes=100_000).captures == 0
    # A new capture and one landed anew: read as they landed, until the next run.
    bronze.write_bronze(capture(spark, 0, 50), str(folder), datetime(2026, 1, 3))
    bronze.write_bronze(capture(spark, 2000, 2010), str(folder), datetime(2026, 1, 2))
    wanted = sorted([*range(1000, 1600), *range(2000, 2010), *range(50)])
    for _ in range(2):
        found = compaction.read_captures(spark, str(folder))
        assert sorted(row.id for row in found.collect()) == wanted
        done = compaction.compact(spark, str(folder))
    assert done.captures == 0


def test_a_file_above_the_target_is_split(spark, tmp_path):
    folder = tmp_path / "bronze"
    bronze.write_bronze(capture(spark, 0, 3000).coalesce(1), str(folder), datetime(2026, 1, 1))
    done = compaction.compact(spark, str(folder), target_bytes=200_000)
    assert done.files_in == 1 and done.files_out > 3
    assert compaction.read_captures(spark, str(folder)).select("id").distinct().count() == 3000


@pytest.mark.parametrize("rows", [0, 1])
def test_a_capture_without_rows_is_packed_once(spark, tmp_path, rows):
    folder = str(tmp_path / "bronze")
    bronze.write_bronze(capture(spark, 0, rows), folder, datetime(2026, 1, 1))
    compaction.compact(spark, folder)
    assert compaction.compact(spark, folder).captures == 0
    assert compaction.read_captures(spark, folder).count() == rows
