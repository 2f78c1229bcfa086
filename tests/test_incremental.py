import json
import random
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from listinglake import publication
from listinglake.operators import bloom, silver
from listinglake.operators.arrival import first_arrivals
from listinglake.plans import admission, incremental, ingest
from listinglake.sources import landing, resolve

LISTING = "id string, title string, company_name string, category string, publication_date string"


def rows_of(frame):
    return sorted(map(tuple, frame.select(*sorted(frame.columns)).collect()), key=repr)


def made_up(spark, rng, ids, n):
    rows = []
    for _ in range(n):
        day = rng.choice([None, "soon", *(f"2026-01-{d:02d}" for d in range(1, 9))])
        company = rng.choice(["A", "B", "C", None, " "])
        rows.append(
            (str(rng.choice(ids)), f"data {rng.randrange(6)}", company, rng.choice("xyz"), day)
        )
    rows += [("no id", "data 1", "A", "x", None), (None, "data 2", "A", "x", None), ("5", "cook", "A", "x", None)]
    return spark.createDataFrame(rows, LISTING)


# --- silver -----------------------------------------------------------------------------------


def test_silver_equals_the_rebuild_after_each_capture(spark, tmp_path):
    rng = random.Random(1)
    root, seen = str(tmp_path / "lake"), None
    for number, ids in enumerate((range(40), range(25, 60), range(5), range(80))):
        capture = made_up(spark, rng, ids, 60)
        seen = capture if seen is None else seen.union(capture)
        merged = incremental.merge_capture(spark, root, capture, buckets=8)
        assert merged.version == number + 1
        assert rows_of(incremental.read_silver(spark, root)) == rows_of(silver.build(seen))


def test_a_loser_comes_back_when_its_better_leaves(spark, tmp_path):
    root = str(tmp_path / "lake")

    def merge(*rows):
        incremental.merge_capture(spark, root, spark.createDataFrame(rows, LISTING))
        return {row.id: row.title for row in incremental.read_silver(spark, root).collect()}

    assert merge(("1", "data a", None, "", "2026-01-01"), ("2", "data a", None, "", "2026-01-02")) == {2: "data a"}
    assert merge(("2", "data b", None, "", "2026-01-03")) == {1: "data a", 2: "data b"}
    # An older row of a known id changes nothing; a newer one joins the pair and wins it.
    assert merge(("2", "data c", None, "", "2026-01-01")) == {1: "data a", 2: "data b"}
    assert merge(("1", "data b", None, "", "2026-01-09")) == {1: "data b"}


def test_only_touched_parts_are_read_and_written(spark, tmp_path):
    root = str(tmp_path / "lake")
    rows = spark.range(4000).select(
        F.col("id").cast("string").alias("id"),
        F.concat(F.lit("data "), "id").alias("title"),
        F.lit("A").alias("company_name"),
        F.lit("2026-01-01").alias("publication_date"),
    )
    first = incremental.merge_capture(spark, root, rows, buckets=32)
    assert (first.rows_read, first.rows_written, first.changed) == (0, 8000, 4000)
    before = publication.live(spark, root).tables
    one = rows.where("id = '17'").withColumn("publication_date", F.lit("2026-02-01"))
    second = incremental.merge_capture(spark, root, one)
    assert second.changed == 1
    assert second.rows_read < 600 and second.rows_written < 600
    assert second.rows_read + second.rows_kept == 8000
    after = publication.live(spark, root).tables
    for name, table in before.items():
        assert sum(table.parts[key] != after[name].parts[key] for key in table.parts) == 1
    # The same rows again publish nothing.
    again = incremental.merge_capture(spark, root, one)
    assert (again.version, again.changed, again.rows_written) == (second.version, 0, 0)


def test_a_merge_that_dies_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "lake")
    rows = spark.createDataFrame([("1", "data a", "A", "", "2026-01-01")], LISTING)
    incremental.merge_capture(spark, root, rows)
    with pytest.raises(PySparkException):
        incremental.merge_capture(spark, root, rows.withColumn("category", F.raise_error(F.lit("x")).cast("string")))
    assert rows_of(incremental.read_silver(spark, root)) == rows_of(silver.build(rows))


def test_parts_can_be_dealt_anew(spark, tmp_path):
    rng = random.Random(2)
    root = str(tmp_path / "lake")
    assert incremental.read_silver(spark, root).count() == 0
    one, two = made_up(spark, rng, range(30), 50), made_up(spark, rng, range(30), 50)
    incremental.merge_capture(spark, root, one, buckets=2)
    incremental.deal_anew(spark, root, 16, files=2)
    incremental.merge_capture(spark, root, two, buckets=2, files=3)
    assert publication.live(spark, root).tables[incremental.WINNERS].notes["buckets"] == 16
    assert rows_of(incremental.read_silver(spark, root)) == rows_of(silver.build(one.union(two)))
    empty = one.limit(0)
    assert incremental.merge_capture(spark, root, empty).changed == 0


# --- first arrivals ---------------------------------------------------------------------------


def arrivals(spark, rng, low, high):
    rows = [
        (n, rng.choice([None, *range(60)]), rng.choice(["a", "b", "c", None]), rng.choice([None, *range(9)]))
        for n in range(low, high)
    ]
    return spark.createDataFrame(rows, "n long, id long, title string, company long")


def admit(spark, root, capture, label, **more):
    return admission.admit(
        spark, root, capture, label, F.col("id"), [F.col("title"), F.col("company")], F.col("n"), **more
    )


def test_admission_equals_one_pass_over_all_captures(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(admission, "LAYERS", 3)
    rng = random.Random(3)
    root, seen = str(tmp_path / "lake"), None
    assert admission.kept(spark, root) is None
    for number in range(4):
        capture = arrivals(spark, rng, 50 * number, 50 * number + 50)
        seen = capture if seen is None else seen.union(capture)
        done = admit(spark, root, capture, f"c{number}", buckets=4)
        assert done.version == number + 1
        wanted = first_arrivals(seen, F.col("id"), [F.col("title"), F.col("company")], F.col("n"))
        assert rows_of(admission.kept(spark, root)) == rows_of(wanted)
    tables = publication.live(spark, root).tables
    layers = [key.split("/")[0] for key in tables[admission.IDS].parts]
    assert max(map(layers.count, layers)) < 3
    assert tables[admission.IDS].rows == tables[admission.KEY_PAIRS].rows == tables[admission.ROWS].rows


def test_the_same_capture_again_does_nothing(spark, tmp_path):
    root = str(tmp_path / "lake")
    capture = arrivals(spark, random.Random(4), 0, 40)
    first = admit(spark, root, capture, "a")
    again = admit(spark, root, capture, "a")
    assert (again.version, again.kept, again.rows) == (first.version, first.kept, 0)
    other = admit(spark, root, capture, "b")
    assert (other.kept, other.blocked) == (0, 40)


def test_new_keys_read_hardly_any_old_ones(spark, tmp_path):
    """The filter rules out nearly all new keys; its blocks grow with the keys."""
    root = str(tmp_path / "lake")

    def fresh(low, high):
        return spark.range(low, high).select(
            F.col("id").alias("n"), "id", F.lit("t").alias("title"), F.col("id").alias("company")
        )

    admit(spark, root, fresh(0, 20_000), "a")
    blocks = publication.live(spark, root).tables[admission.FILTER].notes["blocks"]
    assert blocks * bloom.BLOCK_BITS >= 20_000 * bloom.BITS
    done = admit(spark, root, fresh(20_000, 22_000), "b")
    assert done.kept == 2000 and done.blocked == 0 and done.asked < 0.06 * 2 * 2000
    admit(spark, root, fresh(22_000, 50_000), "c")
    grown = publication.live(spark, root).tables[admission.FILTER].notes["blocks"]
    assert grown > blocks
    late = admit(spark, root, fresh(0, 50_000), "d")
    assert (late.kept, late.blocked, late.asked) == (0, 50_000, 100_000)


def test_keys_of_a_capture_that_dies_do_not_count(spark, tmp_path):
    root = str(tmp_path / "lake")
    capture = arrivals(spark, random.Random(5), 0, 30)
    with pytest.raises(PySparkException):
        admit(spark, root, capture.withColumn("title", F.raise_error(F.lit("x")).cast("string")), "a")
    assert admission.kept(spark, root) is None
    assert admit(spark, root, capture, "a").kept > 0


# --- filters ----------------------------------------------------------------------------------


def test_a_filter_never_rules_out_its_keys(spark):
    keys = spark.range(0, 9000, 3).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("x").alias("s"))
    rows = spark.range(9000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("x").alias("s"))
    for most, alarms in ((bloom.MOST_BLOCKS, 0.05), (1, 0.5)):
        found = bloom.marked(rows, keys, ["k", "s"], most)
        hits = {r.k for r in found.where("_maybe").collect()}
        assert hits >= {None, *range(3, 9000, 3)}
        assert len(hits) - 3000 < alarms * 6000
    assert bloom.marked(rows, keys.limit(0), ["k", "s"]).where("_maybe").count() == 0


# --- responses to silver ----------------------------------------------------------------------


def test_captures_go_from_responses_to_the_star(spark, tmp_path):
    root = str(tmp_path / "root")

    def landed(name, *jobs):
        folder = tmp_path / name
        folder.mkdir()
        rows = [
            {"request_seq": k, "source": "remotive", "run": "r", "query_category": "data", "body": json.dumps({"jobs": [job]})}
            for k, job in enumerate(jobs)
        ]
        (folder / "a.json").write_text("\n".join(map(json.dumps, rows)))
        return str(folder)

    def job(key, title, company, day):
        return {"id": key, "title": title, "company_name": company, "publication_date": f"2026-01-{day:02d}"}

    def served():
        gold = resolve.vacancies(spark, f"{root}/{ingest.LAKE}/gold").frame
        return sorted((r.title, r.company_name, str(r.publication_date)) for r in gold.collect())

    one = landed("one", job(1, "Data A", "Acme", 1), job(2, "data a", "ACME", 2), job(3, "Cook", "Acme", 1))
    first = ingest.ingest(spark, one, root, datetime(2026, 1, 1))
    assert (first.stamp, first.merged.changed, first.rows["gold/fct_vacancies"]) == ("20260101_000000", 1, 1)
    two = landed("two", job(1, "Data A", "Acme", 9), job(4, "Python", None, 3))
    for again in range(2):
        done = ingest.ingest(spark, two, root, datetime(2026, 1, 2))
        assert done.merged.changed == (0 if again else 2)
        assert served() == [("Data A", "Acme", "2026-01-09"), ("Python", "Unknown", "2026-01-03")]
    bronze = landing.read_bronze(spark, f"{root}/{ingest.BRONZE}")
    assert sorted(r.capture_stamp for r in bronze.select("capture_stamp").distinct().collect()) == [
        "20260101_000000", "20260102_000000"]


def test_joins_behind_a_filter_equal_plain_ones(spark):
    keys = spark.range(0, 900, 3).select((F.col("id") % 200).alias("k"), F.lit("x").alias("s")).distinct()
    rows = spark.range(3000).select(F.when(F.col("id") % 7 > 0, F.col("id") % 400).alias("k"), F.lit("x").alias("s"), "id")
    for small in (0, 1 << 20):
        for join, how in ((bloom.semi_join, "left_semi"), (bloom.anti_join, "left_anti")):
            found = join(rows, keys, ["k", "s"], small)
            assert rows_of(found) == rows_of(rows.join(keys, ["k", "s"], how))
