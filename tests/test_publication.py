import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from listinglake import publication
from listinglake.errors import IntegrityError, PublicationConflictError
from listinglake.operators import star
from listinglake.plans.refresh import refresh_from
from listinglake.sinks.tables import write_table
from listinglake.sources import resolve, snapshot


def numbers(spark, root, name=""):
    found = publication.live(spark, root).read(spark, name)
    return sorted(row[0] for row in found.collect())


def dying(spark, rows):
    """Its first partition is written whole, its last one fails."""
    frame = spark.range(0, rows, 1, 4)
    return frame.withColumn("id", F.when(F.col("id") == rows - 1, F.raise_error(F.lit("x"))).otherwise(F.col("id")))


def generations(root, name=""):
    at = os.path.join(root, name, publication.GENERATIONS)
    return sorted(os.listdir(at)) if os.path.isdir(at) else []


def test_a_write_that_dies_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "table")
    assert write_table(spark.range(5), path) == 5
    with pytest.raises(PySparkException):
        write_table(dying(spark, 4000), path)
    assert numbers(spark, path) == [0, 1, 2, 3, 4]
    assert sorted(row.id for row in snapshot.read_table(spark, path).collect()) == [0, 1, 2, 3, 4]
    assert write_table(spark.range(2), path) == 2
    assert snapshot.read_table(spark, path).count() == 2


def test_a_reader_keeps_the_generation_it_found(spark, tmp_path):
    path = str(tmp_path / "table")
    write_table(spark.range(5), path)
    held = snapshot.read_table(spark, path)
    write_table(spark.range(2), path)
    assert held.count() == 5
    write_table(spark.range(3), path)
    assert len(generations(path)) == 2
    assert snapshot.read_table(spark, path).count() == 3


def test_a_pointer_that_is_not_complete_is_not_read(spark, tmp_path):
    path = str(tmp_path / "table")
    write_table(spark.range(5), path)
    (tmp_path / "table" / publication.POINTERS / ".2-half").write_text('{"tables": {')
    assert snapshot.read_table(spark, path).count() == 5
    write_table(spark.range(1), path)
    assert publication.live(spark, path).version == 2


def test_several_tables_become_live_together(spark, tmp_path):
    root = str(tmp_path / "lake")
    publication.publish(spark, root, [publication.stage(spark.range(n), root, f"t{n}") for n in (1, 2)])
    staged = publication.stage(spark.range(7), root, "t1")
    assert numbers(spark, root, "t1") == [0]
    publication.publish(spark, root, [staged])
    assert (len(numbers(spark, root, "t1")), len(numbers(spark, root, "t2"))) == (7, 2)
    assert snapshot.read_table(spark, f"{root}/t2").count() == 2
    assert snapshot.read_table(spark, f"{root}/t3") is None


def test_a_writer_that_comes_late_is_refused(spark, tmp_path):
    root = str(tmp_path / "lake")
    publication.publish(spark, root, [publication.stage(spark.range(1), root, "a")], expected=0)
    late = publication.stage(spark.range(9), root, "a")
    publication.publish(spark, root, [publication.stage(spark.range(2), root, "a")], expected=1)
    with pytest.raises(PublicationConflictError):
        publication.publish(spark, root, [late], expected=1)
    assert numbers(spark, root, "a") == [0, 1]


def test_parts_are_replaced_one_by_one(spark, tmp_path):
    root = str(tmp_path / "lake")
    rows = spark.range(100).withColumn("part", (F.col("id") % 4).cast("int"))
    first = publication.stage_parts(rows, root, "t", "part")
    assert {key: part.rows for key, part in first.parts.items()} == dict.fromkeys("0123", 25)
    publication.publish(spark, root, [first])
    some = rows.where("part = 1 AND id < 10")
    newer = first.with_parts(publication.stage_parts(some, root, "t", "part"), gone=["1", "3"])
    publication.publish(spark, root, [newer])
    found = numbers(spark, root, "t")
    assert found == [n for n in range(100) if n % 4 in (0, 2) or n in (1, 5, 9)]
    table = publication.live(spark, root).tables["t"]
    assert (table.rows, table.rows_in(["1", "9"])) == (53, 3)
    assert table.read(spark, root, ["1"]).columns == ["id"] and table.read(spark, root, []).count() == 0
    # Parts of the first generation are still named, so it stays.
    assert publication.sweep(spark, root, keep=1) == 0
    assert numbers(spark, root, "t") == found


def test_a_sweep_spares_what_may_still_be_published(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in range(1, 5):
        write_table(spark.range(n), root)
    assert len(generations(root)) == 2
    staged = publication.stage(spark.range(9), root)
    assert publication.sweep(spark, root, keep=1) == 1
    publication.publish(spark, root, [staged])
    assert len(numbers(spark, root)) == 9
    publication.stage(spark.range(3), root)
    assert publication.sweep(spark, root, keep=1, left_behind=-1) == 2
    assert len(numbers(spark, root)) == 9 and len(generations(root)) == 1


def test_an_empty_table_keeps_its_schema(spark, tmp_path):
    root = str(tmp_path / "lake")
    empty = spark.range(0).withColumn("part", F.lit(1))
    tables = [publication.stage(spark.range(0), root, "a"), publication.stage_parts(empty, root, "b", "part")]
    live = publication.publish(spark, root, tables)
    for name in ("a", "b"):
        found = live.read(spark, name)
        assert (found.columns, found.count()) == (["id"], 0)
    assert publication.live(spark, str(tmp_path / "none")) is None
    assert publication.locate(spark, "none") is None


# --- builds of several tables -----------------------------------------------------------------


def silver_rows(spark, rows):
    return spark.createDataFrame(rows, "id long, title string, company_name string").withColumns(
        {
            "category": F.lit("c"),
            "publication_date": F.lit("2026-01-01"),
            "candidate_required_location": F.concat(F.lit("in "), "company_name"),
        }
    )


def served(spark, root):
    rows = resolve.vacancies(spark, f"{root}/gold").frame
    return sorted((r.vacancy_id, r.company_name, r.location_name) for r in rows.collect())


def test_no_reader_sees_a_fact_with_other_dimensions(spark, tmp_path, monkeypatch):
    """At every step of a second build, readers find the whole first one."""
    root = str(tmp_path / "lake")
    refresh_from(spark, silver_rows(spark, [(1, "data a", "Acme"), (2, "data b", "Zeta")]), root)
    first = served(spark, root)
    assert first == [(1, "Acme", "in Acme"), (2, "Zeta", "in Zeta")]
    seen = []
    stage = publication.stage

    def watched(*arguments, **more):
        done = stage(*arguments, **more)
        seen.append(served(spark, root))
        return done

    monkeypatch.setattr(publication, "stage", watched)
    held = resolve.vacancies(spark, f"{root}/gold").frame
    refresh_from(spark, silver_rows(spark, [(1, "data a", "Beta"), (3, "data c", "Beta")]), root)
    assert len(seen) == 4 and all(rows == first for rows in seen)
    assert served(spark, root) == [(1, "Beta", "in Beta"), (3, "Beta", "in Beta")]
    assert sorted(r.company_name for r in held.collect()) == ["Acme", "Zeta"]


def test_tables_that_do_not_fit_are_not_published(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    rows = silver_rows(spark, [(1, "data a", "Acme"), (2, "data b", "Zeta")])
    refresh_from(spark, rows, root)
    build = star.build

    def lossy(silver):
        made = build(silver)
        return star.Star(made.dim_company.where("company_id > 1"), made.dim_location, made.fct_vacancies)

    monkeypatch.setattr(star, "build", lossy)
    with pytest.raises(IntegrityError):
        refresh_from(spark, rows.where("id = 2").union(rows.where("id = 1")), root)
    assert publication.live(spark, root).version == 1
    assert len(served(spark, root)) == 2


def test_a_build_that_dies_leaves_the_last_one(spark, tmp_path):
    root = str(tmp_path / "lake")
    rows = silver_rows(spark, [(1, "data a", "Acme")])
    refresh_from(spark, rows, root)
    with pytest.raises(PySparkException):
        refresh_from(spark, rows.withColumn("category", F.raise_error(F.lit("x")).cast("string")), root)
    assert served(spark, root) == [(1, "Acme", "in Acme")]
    pointer = json.loads((tmp_path / "lake" / "_live" / f"{1:020d}.json").read_text())
    assert pointer["tables"]["gold/fct_vacancies"]["parts"][""]["rows"] == 1
