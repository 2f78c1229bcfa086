import json
from datetime import date, datetime

import pytest

from listinglake import schemas
from listinglake.operators import serving, silver, star

BRONZE = (
    "id bigint, title string, company_name string, category string, publication_date string, "
    "candidate_required_location string, salary string, description string"
)


def listing(key, title, company="Acme", day="2026-09-20T09:00:00", place="Europe", **more):
    row = dict(id=key, title=title, company_name=company, category="Data", publication_date=day,
               candidate_required_location=place, salary="", description="<p>a &amp; b</p>")
    return {**row, **more}


@pytest.fixture
def listings(spark):
    return lambda *rows: spark.createDataFrame(list(rows), BRONZE)


def test_projection_cleans_and_types(listings):
    found = silver.build(
        listings(listing(1, "  Data\n Engineer "), listing(2, "PYTHON dev", salary=" 10 "),
                 listing(3, "Chef"), listing(4, None), listing(None, "Data")))
    assert found.dtypes == [tuple(f) for f in schemas.fields(schemas.SILVER)]
    rows = {r.id: r for r in found.collect()}
    assert set(rows) == {1, 2}
    assert (rows[1].title, rows[1].salary, rows[1].description) == ("Data Engineer", None, "a & b")
    assert rows[2].salary == "10"
    assert rows[1].publication_date == datetime(2026, 9, 20, 9)


def test_missing_columns_are_null(frame):
    found = silver.build(frame([(1, "Data")], "id int, title string")).first()
    assert (found.company_name, found.publication_date, found.description) == (None, None, None)


def test_broken_ids_are_set_aside(frame):
    rows = frame([("abc", "Data"), (" 12 ", "Data"), ("1.7", "Data"), (None, "Data")],
                 "id string, title string")
    assert [r.id for r in silver.build(rows).collect()] == [12]
    assert sorted(r.id for r in silver.rejected_ids(rows).collect()) == ["1.7", "abc"]


def test_silver_is_a_fixpoint(listings):
    once = silver.build(listings(listing(1, "Data"), listing(2, "Data"), listing(3, "Python", None)))
    again = silver.build(once)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, once.collect()))


def test_defaults_before_or_after_the_dedupe(listings):
    rows = listings(listing(1, "Data", None), listing(2, "Data", "Unknown"))
    assert silver.build(rows).count() == 2
    assert silver.build_display(rows).count() == 1


def test_ten_landed_listings_give_eight(listings):
    """One repeated id, one title without a keyword, one blank company and place."""
    rows = [listing(1, "Database operator", "Quince"),
            listing(1, "Database operator", "Quince", "2026-09-01T09:00:00", salary="old"),
            listing(2, "Python teacher", "Medlar", "2026-09-18T11:30:00"),
            listing(3, "Property developer", "Sorrel", place="Peru, Chile"),
            listing(4, "Sound engineer", "Tansy"),
            listing(5, "Gardener", "Tansy"),
            listing(6, "Data keeper", " ", place=""),
            listing(7, "Bridge engineer", "Yarrow"),
            listing(8, "Metadata clerk", "Borage", "some day"),
            listing(9, "Game developer", "Borage")]
    found = silver.build_display(listings(*rows)).collect()
    assert [r.vacancy_id for r in found][-1] == 8  # undated comes last
    by_id = {r.vacancy_id: r for r in found}
    assert set(by_id) == {1, 2, 3, 4, 6, 7, 8, 9} and len(found) == 8
    blank = by_id[6]
    assert (blank.company_name, blank.location_name, blank.salary) == ("Unknown", "Unspecified", "")
    assert by_id[1].salary == ""


@pytest.fixture
def small_star(listings):
    def build(**options):
        rows = [listing(1, "Data", "Zeta", place="USA, Canada"), listing(2, "Data", "Alpha", place=None),
                listing(3, "Data", None, "soon")]
        rows += [listing(10 + i, f"Data {i}", "Zeta", place=f"P{i % 3}") for i in range(60)]
        return star.build_stored(silver.build(listings(*rows)), **options)

    return build


@pytest.mark.parametrize(
    "options", [{}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "hot_rows": 20}]
)
def test_star(small_star, options):
    built = small_star(**options)
    assert built.dim_company.dtypes == [tuple(f) for f in schemas.fields(schemas.DIM_COMPANY)]
    assert built.dim_location.dtypes == [tuple(f) for f in schemas.fields(schemas.DIM_LOCATION)]
    assert built.fct_vacancies.dtypes == [tuple(f) for f in schemas.fields(schemas.FACT)]
    companies = {r.company_name: r.company_id for r in built.dim_company.collect()}
    assert companies == {"Alpha": 1, "Unknown": 2, "Zeta": 3}
    places = sorted((r.location_id, r.location_name) for r in built.dim_location.collect())
    assert [name for _, name in places] == ["Europe", "P0", "P1", "P2", "USA, Canada", "Unspecified"]
    fact = {r.vacancy_id: r for r in built.fct_vacancies.collect()}
    assert len(fact) == 63
    assert (fact[3].company_id, fact[3].publication_date) == (2, None)
    assert (fact[1].publication_date, fact[2].location_id) == (date(2026, 9, 20), 6)
    assert star.integrity(built).first().asDict() == {
        "fact_rows": 63, "without_company": 0, "without_location": 0}


def test_orphans_are_named(small_star, frame):
    built = small_star()
    part = built.dim_company.where("company_id <> 3")
    found = star.orphans(built.fct_vacancies, part, "company_id").collect()
    assert [(r.company_id, r.rows) for r in found] == [(3, 61)]
    broken = star.Star(part, built.dim_location, built.fct_vacancies)
    assert star.integrity(broken).first().without_company == 61


def test_no_global_window_over_the_names(small_star):
    plan = small_star().dim_company._jdf.queryExecution().executedPlan().toString()
    names_part = plan.split("BroadcastExchange")[0]
    assert "SinglePartition" not in names_part


def test_denormalise_keeps_every_fact_row(small_star):
    built = small_star()
    for limit in (10**6, 0):
        rows = serving.denormalise(built.fct_vacancies, built.dim_company.limit(1),
                                   built.dim_location, limit)
        assert rows.columns == list(schemas.EXPORT_COLUMNS)
        assert rows.count() == 63


# --- serving -----------------------------------------------------------------

VIEW = "vacancy_id bigint, title string, company_name string, category string, location_name string, description string"


@pytest.fixture
def view(frame):
    return frame(
        [(1, "Data Engineer", "Acme", "Dev", "Berlin", "100% remote"),
         (2, "Straße", None, "Dev", "", "a.b"),
         (3, None, "ACME", "  ", "Berlin", None),
         (4, "x", "Beta", "Ops", "Oslo", "")], VIEW)


@pytest.mark.parametrize(
    "query, wanted",
    [("acme dev", [1]), ("ENGINEER ACME", [1]), ("%", [1]), ("a.b", [2]), ("a?b", []),
     ("STRASSE", [2]), ("straße", [2]), ("  ", [1, 2, 3, 4]), ("", [1, 2, 3, 4]),
     ("acme", [1, 3]), ("remote ", []), ("beta ops oslo", [4])],
)
def test_search(view, query, wanted):
    assert sorted(r.vacancy_id for r in serving.search(view, query).collect()) == wanted
    assert tuple(serving.selectivity(view, query).first()) == (len(wanted), 4)


def test_counts_and_figures(view):
    top = serving.top_counts(view, "category", 5).collect()
    assert [tuple(r) for r in top] == [("Dev", 2), ("Ops", 1)]
    tied = serving.value_counts(view, "company_name", 2).collect()
    assert [r.label for r in tied] == ["ACME", "Acme"]
    assert serving.top_counts(view, "title", 5).count() == 0
    assert tuple(serving.kpis(view).first()) == (4, 3, 2)
    assert tuple(serving.kpis(view, approximate=True).first()) == (4, 3, 2)


def test_top_counts_never_sorts_the_table(view):
    plan = serving.top_counts(view, "category", 5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_prepare_shapes_any_frame(frame):
    rows = frame([("7", " a ", " d ", "2026-01-02", "bad"), (None, None, None, None, None)],
                 "vacancy_id string, title string, description string, publication_date string, "
                 "publication_timestamp string")
    found = serving.prepare(rows, sort=True)
    assert found.dtypes == [tuple(f) for f in schemas.fields(schemas.SERVING)]
    first = next(r for r in found.collect() if r.vacancy_id == 7)
    assert (first.title, first.description, first.salary) == ("a", " d ", "")
    assert (first.publication_date, first.publication_timestamp) == (date(2026, 1, 2), None)
    assert serving.display(found).columns[:3] == ["Id", "Publicatiedatum", "Titel"]
    assert json.dumps(serving.display(found).columns).count("publication") == 0
