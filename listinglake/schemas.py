"""Explicit schemas of every zone, as DDL strings Spark parses."""

BRONZE = (
    "id bigint, source string, source_job_id string, query_category string, "
    "title string, company_name string, category string, publication_date string, "
    "candidate_required_location string, salary string, description string, url string"
)
# What silver reads from a landed document: every leaf as text, cast later.
LISTING_FIELDS = (
    "id",
    "title",
    "company_name",
    "category",
    "publication_date",
    "candidate_required_location",
    "salary",
    "description",
)
SILVER = (
    "id bigint, title string, company_name string, category string, "
    "publication_date timestamp, candidate_required_location string, "
    "salary string, description string"
)
DIM_COMPANY = "company_id int, company_name string"
DIM_LOCATION = "location_id int, location_name string"
FACT = (
    "vacancy_id bigint, company_id int, location_id int, publication_date date, "
    "publication_timestamp timestamp, title string, description string, "
    "category string, salary string"
)
SERVING = (
    "vacancy_id bigint, publication_date date, publication_timestamp timestamp, "
    "title string, company_name string, category string, location_name string, "
    "salary string, description string"
)
EXPORT_COLUMNS = (
    "vacancy_id",
    "company_id",
    "location_id",
    "publication_date",
    "publication_timestamp",
    "title",
    "company_name",
    "category",
    "location_name",
    "salary",
    "description",
)
# A landed response: what was asked, in which order, and the untouched body.
RESPONSES = (
    "request_seq bigint, source string, run string, query_category string, page bigint, "
    "params map<string,string>, body string, error string"
)
ATTEMPTS = (
    "source string, category string, page int, params map<string,string>, "
    "added bigint, error string"
)


def fields(ddl: str) -> list[tuple[str, str]]:
    """(name, type) pairs of a DDL string whose types hold no ``", "``."""
    return [tuple(part.split(" ", 1)) for part in ddl.split(", ")]
