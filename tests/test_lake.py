import json
import os
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from listinglake import schemas, session
from listinglake.errors import (
    ExportError,
    LandingNotFoundError,
    SnapshotLogError,
    UnusableLandingError,
)
from listinglake.operators import serving
from listinglake.plans.collect import collect_into
from listinglake.plans.refresh import refresh, refresh_from
from listinglake.sinks import bronze
from listinglake.sinks.tables import export, write_table
from listinglake.sources import landing, resolve, snapshot
from listinglake.streaming.bronze import land_new_listings


def listing(key, title="Data", company="Acme", **more):
    return dict(id=key, title=title, company_name=company, publication_date="2026-09-20T09:00:00",
                description="<p>a</p>", **more)


def land(folder, **documents):
    folder.mkdir(exist_ok=True)
    for name, content in documents.items():
        text = content if isinstance(content, str) else json.dumps(content, indent=2)
        (folder / f"{name}.json").write_text(text, encoding="utf-8")
    return str(folder)


# --- landing -----------------------------------------------------------------


def test_landing_must_be_there(spark, tmp_path):
    with pytest.raises(LandingNotFoundError):
        landing.read_listings(spark, str(tmp_path / "none"))
    nested = tmp_path / "raw" / "deep"
    nested.mkdir(parents=True)
    (nested / "a.json").write_text('{"jobs": []}')
    with pytest.raises(LandingNotFoundError):
        landing.read_listings(spark, str(tmp_path / "raw"))


def test_every_shape_of_document(spark, tmp_path):
    folder = land(tmp_path / "raw", a={"jobs": [listing(1, created=True), 3, None, "x", [4]]},
                  b=[listing("2", salary=5)], c={"jobs": []}, d='{"jobs": [{"id"', e={"x": 1})
    (tmp_path / "raw" / "notes.txt").write_text("no document")
    (tmp_path / "raw" / "deep").mkdir()
    land(tmp_path / "raw" / "deep", f={"jobs": [listing(3)]})

    jobs_only = landing.read_listings(spark, folder)
    assert sorted(r.id for r in jobs_only.collect()) == ["1", "3"]
    both = landing.read_listings(spark, folder, arrays=True, recursive=False)
    found = {r.id: r for r in both.collect()}
    assert set(found) == {"1", "2"}
    assert (found["2"].salary, found["1"].candidate_required_location) == ("5", None)

    at = landing.Landing(folder, recursive=False)
    aside = {r.file[-6:]: r.reason for r in landing.quarantined(spark, at, arrays=True).collect()}
    assert aside == {"d.json": "not valid JSON", "e.json": "no jobs array"}
    assert landing.quarantined(spark, at).count() == 3


def test_one_route_for_documents_of_every_size(spark, tmp_path):
    """Beyond the size of a VARIANT, odd entries still cost only themselves."""
    odd = [listing(1), 5, None, "x", [4], {}, {"x": 1}]
    many = [listing(10 + i, note="x" * 2000) for i in range(10_000)]
    folder = land(tmp_path / "raw", small={"jobs": odd}, big={"jobs": [*odd, *many]},
                  array=odd, lone=listing(7), foreign='{"x": "' + "y" * 5000 + '"}',
                  broken='{"jobs": [{"id": "' + "z" * 5000)
    assert (tmp_path / "raw" / "big.json").stat().st_size > 16 * 1024 * 1024
    at = landing.Landing(folder)
    rows = landing.listings(spark, at, arrays=True).groupBy(
        F.regexp_extract("file", r"(\w+)\.json", 1).alias("name")).count().collect()
    assert dict(map(tuple, rows)) == {"small": 3, "array": 3, "big": 10_003}
    aside = landing.quarantined(spark, at, arrays=True).collect()
    assert {(r.file[-8:], r.reason) for r in aside} == {
        ("ign.json", "no jobs array"), ("one.json", "no jobs array"),
        ("ken.json", "not valid JSON")}


def test_refresh_fails_before_it_replaces_good_tables(spark, tmp_path):
    good = land(tmp_path / "good", a={"jobs": [listing(1), listing("abc")]}, b='{"jobs": [')
    root = str(tmp_path / "lake")
    counts = refresh(spark, good, root)
    assert counts["silver/jobs"] == 1
    assert (counts["quarantine/documents"], counts["quarantine/rejected_ids"]) == (1, 1)
    reasons = snapshot.read_table(spark, f"{root}/quarantine/documents").collect()
    assert [r.reason for r in reasons] == ["not valid JSON"]
    bad = land(tmp_path / "bad", a='{"jobs": [', b={"x": 1})
    with pytest.raises(UnusableLandingError):
        refresh(spark, bad, root)
    assert snapshot.read_table(spark, f"{root}/silver/jobs").count() == 1


def test_the_same_capture_again_replaces_itself(spark, tmp_path):
    values = {n: F.lit("v") for n, k in schemas.fields(schemas.BRONZE) if k == "string"}
    rows = spark.range(3).withColumns(values)
    for _ in range(2):
        bronze.write_bronze(rows, str(tmp_path / "b"), datetime(2026, 1, 2, 3, 4, 5))
    bronze.write_bronze(rows, str(tmp_path / "b"), datetime(2026, 1, 3))
    assert landing.read_bronze(spark, str(tmp_path / "b")).count() == 6


def test_an_empty_document_alone_is_no_error(spark, tmp_path):
    assert landing.read_listings(spark, land(tmp_path / "raw", a={"jobs": []})).count() == 0


def test_latest_capture_file(spark, tmp_path):
    folder = land(tmp_path / "raw", jobs_raw_20260101_000000={}, jobs_raw_20260301_120000={},
                  jobs_raw_20260201_235959={}, notes={}, zzz={})
    assert landing.latest_file(spark, folder).endswith("jobs_raw_20260301_120000.json")
    with pytest.raises(LandingNotFoundError):
        landing.latest_file(spark, land(tmp_path / "other", notes={}))


def test_flatten_structs_drops_nulls(spark):
    rows = spark.sql("SELECT 1 AS k, array(named_struct('a', 1), null, named_struct('a', 2)) AS x "
                     "UNION ALL SELECT 2, array() UNION ALL SELECT 3, null")
    assert sorted(map(tuple, landing.flatten_structs(rows, "x").collect())) == [(1, 1), (1, 2)]


def test_bronze_captures(spark, tmp_path):
    folder = str(tmp_path / "bronze")
    values = {n: F.lit("v") for n, k in schemas.fields(schemas.BRONZE) if k == "string"}
    rows = spark.range(3).withColumns(values)
    tokyo = timezone(timedelta(hours=9))
    assert bronze.write_bronze(rows, folder, datetime(2026, 1, 2, 3, 4, 5)) == "20260102_030405"
    stamp = bronze.write_bronze(rows.limit(1), folder, datetime(2026, 1, 2, 20, 0, tzinfo=tokyo))
    assert stamp == "20260102_110000" == landing.latest_capture(spark, folder)
    everything = landing.read_bronze(spark, folder)
    assert everything.count() == 4
    newest = everything.where(F.col("capture_stamp") == stamp)
    assert newest.count() == 1
    assert "PartitionFilters: [isnotnull(capture_stamp" in newest._jdf.queryExecution().toString()
    with pytest.raises(LandingNotFoundError):
        landing.latest_capture(spark, str(tmp_path))


def test_stream_takes_each_document_once(spark, tmp_path):
    folder, target = tmp_path / "raw", str(tmp_path / "out")
    land(folder, a={"jobs": [listing(1), listing(2)]}, bad='{"jobs"')
    for documents, wanted in (({}, 2), ({}, 2), ({"b": [listing(3)]}, 3)):
        land(folder, **documents)
        land_new_listings(spark, str(folder), target, str(tmp_path / "progress")).awaitTermination()
        assert spark.read.parquet(target).count() == wanted


# --- tables and snapshots ----------------------------------------------------


def test_write_table_replaces_rows_and_schema(spark, tmp_path):
    path = str(tmp_path / "table")
    assert write_table(spark.range(5), path) == 5
    assert write_table(spark.range(3).select(F.col("id").alias("other")), path) == 3
    again = snapshot.read_table(spark, path)
    assert (again.columns, again.count()) == (["other"], 3)
    assert write_table(spark.range(0), path) == 0
    assert snapshot.read_table(spark, path).count() == 0
    assert snapshot.read_table(spark, str(tmp_path / "none")) is None


def logged_table(spark, folder, *commits, start=0):
    """Each file of ``commits`` holds its own name."""
    table = folder / "table"
    (table / "_delta_log").mkdir(parents=True)
    for name in {path for commit in commits for _, path in commit}:
        if name.startswith("gone"):
            continue
        at = table / name
        at.parent.mkdir(exist_ok=True)
        spark.createDataFrame([(name,)], "name string").toPandas().to_parquet(at)
    for number, commit in enumerate(commits, start):
        lines = [json.dumps({"commitInfo": {"n": number}})]
        lines += [json.dumps({kind: {"path": path, "size": 1}}) for kind, path in commit]
        (table / "_delta_log" / f"{number:020d}.json").write_text("\n".join(lines) + "\n\n")
    return str(table)


def names_in(spark, table):
    return sorted(r.name for r in snapshot.read_table(spark, table).collect())


def test_removed_files_do_not_count(spark, tmp_path):
    table = logged_table(
        spark, tmp_path,
        [("add", "a.parquet"), ("add", "b.parquet"), ("remove", "a.parquet")],
        [("add", "c.parquet"), ("add", "part=1/d.parquet"), ("add", "gone.parquet")],
        [("remove", "c.parquet"), ("remove", "never.parquet")],
        [("add", "c.parquet"), ("remove", "b.parquet")])
    names = [os.path.basename(p) for p in snapshot.active_files(spark, table)]
    assert names == ["c.parquet", "d.parquet"]
    assert names_in(spark, table) == ["c.parquet", "part=1/d.parquet"]


def test_table_without_a_log(spark, tmp_path):
    spark.range(4).repartition(2).write.parquet(str(tmp_path / "plain"))
    assert len(snapshot.active_files(spark, str(tmp_path / "plain"))) == 2
    assert snapshot.active_files(spark, str(tmp_path / "none")) == []
    assert snapshot.read_files(spark, []).count() == 0


def test_a_log_that_starts_late_is_refused(spark, tmp_path):
    table = logged_table(spark, tmp_path, [("add", "a.parquet")], start=3)
    with pytest.raises(SnapshotLogError):
        snapshot.read_table(spark, table)


def test_a_broken_log_line_is_an_error(spark, tmp_path):
    table = logged_table(spark, tmp_path, [("add", "a.parquet")])
    with open(f"{table}/_delta_log/{0:020d}.json", "a") as log:
        log.write("{broken\n")
    found = resolve.first_with_rows(spark, [("t", lambda: snapshot.read_table(spark, table))])
    assert found.label == "empty" and "t" in found.skipped


def test_export_is_one_file_or_whole_parts(spark, tmp_path):
    rows = spark.range(1000).repartition(4)
    single = str(tmp_path / "one.parquet")
    for _ in range(2):  # the second run replaces the first
        assert export(rows, single, single_file=True) == [single]
    assert os.path.isfile(single) and not os.path.exists(f"{single}__staging")
    assert spark.read.parquet(single).count() == 1000
    parts = export(rows, str(tmp_path / "parts"), part_rows=100)
    assert len(parts) >= 10
    assert snapshot.read_files(spark, parts).count() == 1000
    assert issubclass(ExportError, Exception)


def test_a_failed_swap_leaves_the_old_export(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "one.parquet")
    export(spark.range(3), path, single_file=True)
    monkeypatch.setattr("listinglake.sinks.tables.file_names", lambda *a: ["not-there.parquet"])
    with pytest.raises(Exception):
        export(spark.range(9), path, single_file=True)
    assert spark.read.parquet(path).count() == 3


# --- resolution --------------------------------------------------------------


@pytest.fixture
def lake(spark, tmp_path):
    raw = land(tmp_path / "raw", a={"jobs": [listing(1), listing(1), listing(2, "Python", None)]},
               b={"jobs": [listing(1), listing(3, "Cook")]})
    counts = refresh(spark, raw, str(tmp_path / "lake"), str(tmp_path / "gold.parquet"))
    return tmp_path, raw, counts


def test_refresh_and_every_source(spark, lake):
    root, raw, counts = lake
    assert counts == {"silver/jobs": 2, "gold/dim_company": 2, "gold/dim_location": 1,
                      "gold/fct_vacancies": 2, "quarantine/documents": 0,
                      "quarantine/rejected_ids": 0}
    gold, exported, missing = f"{root}/lake/gold", f"{root}/gold.parquet", f"{root}/missing"
    sources = [
        ("gold-delta", (gold, exported, gold, raw, raw)),
        ("gold-sample", (missing, exported, gold, raw, raw)),
        ("gold-parquet", (missing, missing, gold, raw, raw)),
        ("bronze-json", (missing, missing, missing, raw, raw)),
        ("sample", (missing, missing, missing, missing, f"{raw}/a.json")),
    ]
    results = []
    for label, places in sources:
        found = resolve.vacancies(spark, *places)
        assert found.label == label
        results.append(sorted(map(repr, found.frame.collect())))
    assert all(rows == results[0] for rows in results) and len(results[0]) == 2


def test_nothing_found(spark, tmp_path):
    found = resolve.vacancies(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    assert (found.label, found.frame.count()) == ("empty", 0)
    assert found.frame.dtypes == [tuple(f) for f in schemas.fields(schemas.SERVING)]
    assert set(found.skipped) == {"gold-delta", "gold-sample"}


def test_an_unreadable_source_is_skipped_with_its_reason(spark, tmp_path, lake):
    broken = tmp_path / "broken.parquet"
    broken.write_text("no parquet")
    found = resolve.vacancies(spark, export_path=str(broken), raw_folder=lake[1])
    assert found.label == "bronze-json" and found.skipped["gold-sample"]

    def bug():
        raise KeyError("a bug is not a missing source")

    with pytest.raises(KeyError):
        resolve.first_with_rows(spark, [("x", bug)])


def test_gold_needs_all_three_tables(spark, lake, tmp_path):
    gold = tmp_path / "part"
    write_table(spark.range(1), f"{gold}/fct_vacancies")
    assert snapshot.read_gold(spark, str(gold)) is None


def test_empty_silver_still_builds(spark, tmp_path):
    raw = land(tmp_path / "raw", a={"jobs": [listing(1, "Cook")]})
    assert set(refresh(spark, raw, str(tmp_path / "lake")).values()) == {0}


def test_freshness_token(spark, tmp_path):
    assert resolve.freshness_token(spark, str(tmp_path / "none")) == ""
    root = tmp_path / "gold"
    table = logged_table(spark, root, [("add", "a.parquet")])
    first = resolve.freshness_token(spark, str(root))
    assert first.startswith("2:") and first == resolve.freshness_token(spark, str(root))
    time.sleep(0.05)
    open(f"{table}/_delta_log/{1:020d}.json", "w").write("{}\n")
    second = resolve.freshness_token(spark, str(root))
    assert second.startswith("3:") and second != first
    (root / "notes.txt").write_text("x")
    assert resolve.freshness_token(spark, str(root)) == second


def test_gold_views_answer_sql(spark, lake):
    found = resolve.vacancies(spark, f"{lake[0]}/lake/gold")
    found.frame.createOrReplaceTempView("vacancies")
    row = spark.sql("SELECT company_name, count(*) FROM vacancies GROUP BY 1 ORDER BY 1").collect()
    assert [tuple(r) for r in row] == [("Acme", 1), ("Unknown", 1)]
    assert serving.kpis(found.frame).first().vacancies == 2


def test_scratch_follows_the_session(spark):
    folder = session.shared_folder(spark)
    app = spark.sparkContext.applicationId
    assert session.scratch_path(spark, "x").startswith(f"{folder}/listinglake/{app}/x-")
    with pytest.raises(ValueError):
        session.remove(spark, "/tmp/elsewhere")


def test_an_empty_export_is_one_file(spark, tmp_path):
    path = str(tmp_path / "none.parquet")
    assert export(spark.range(0), path, single_file=True) == [path]
    assert spark.read.parquet(path).count() == 0


def test_responses_to_star(spark, tmp_path):
    """Landed responses to bronze to gold, through files at every step."""
    job = dict(id=1, title="Data Engineer", company_name="Acme", publication_date=1780000000)
    more = [{**job, "id": 2, "title": "DATA engineer"}, {**job, "id": 3, "title": "Cook"}]
    landed = [dict(request_seq=1, source="remotive", run="a", query_category="data", params={"q": "data"},
                   body=json.dumps({"jobs": [job, *more]})),
              dict(request_seq=2, source="jobicy", run="a", query_category="data", body="oops")]
    (tmp_path / "responses").mkdir()
    (tmp_path / "responses" / "a.json").write_text("\n".join(map(json.dumps, landed)))
    places = [str(tmp_path / name) for name in ("responses", "bronze", "attempts")]
    stamp = collect_into(spark, *places, captured_at=datetime(2026, 1, 2))
    attempts = snapshot.read_table(spark, f"{places[2]}/{stamp}").orderBy("source").collect()
    assert [(r.added, r.error) for r in attempts] == [(None, "not valid JSON"), (2, None)]
    listings = landing.read_bronze(spark, places[1])
    assert refresh_from(spark, listings, str(tmp_path / "lake"))["gold/fct_vacancies"] == 1
    row = snapshot.read_gold(spark, f"{tmp_path}/lake/gold").first()
    assert (row.company_name, str(row.publication_timestamp)) == ("Acme", "2026-05-28 20:26:40")
