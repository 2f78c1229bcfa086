"""Fixed values that decide results; everything else is a parameter."""

# --- fixed values: text rules ------------------------------------------------
TITLE_KEYWORDS = ("data", "engineer", "developer", "python")
HTML_TAG = r"<[^>]+>"
# Order matters: "&amp;" last, so "&amp;lt;" becomes "&lt;" and not "<".
HTML_ENTITIES = {
    "&nbsp;": " ",
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&amp;": "&",
}
UNKNOWN_COMPANY = "Unknown"
UNSPECIFIED_LOCATION = "Unspecified"

# --- fixed values: dates -----------------------------------------------------
FRACTION_AND_ZONE = r"(?:\.\d+)?(?:Z|[+-]\d{2}:?\d{2})$"
EPOCH_MS_ABOVE = 10_000_000_000
CAPTURE_STAMP = "yyyyMMdd_HHmmss"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"

# --- fixed values: landing zone and request catalogue ------------------------
LANDING_GLOB = "*.json"
CAPTURE_GLOB = "jobs_raw_*.json"
BOARDS = ("remotive", "jobicy", "arbeitnow")
PAGED_BOARD = "arbeitnow"
JOBICY_PAGE_SIZE = 100
# category -> (query parameter, value) pairs; any other category asks by tag.
JOBICY_QUERIES = {
    "dev": [("industry", "dev")],
    "data": [("tag", "data"), ("industry", "data-science")],
    "software-dev": [("tag", "software-dev"), ("industry", "dev")],
    "backend": [("tag", "backend")],
}

# --- fixed values: serving ---------------------------------------------------
SOURCE_GOLD = "gold-delta"
SOURCE_GOLD_SAMPLE = "gold-sample"
SOURCE_PARQUET = "gold-parquet"
SOURCE_RAW = "bronze-json"
SOURCE_SAMPLE = "sample"
SOURCE_EMPTY = "empty"
DISPLAY_NAMES = {
    "vacancy_id": "Id",
    "publication_date": "Publicatiedatum",
    "title": "Titel",
    "company_name": "Bedrijf",
    "category": "Categorie",
    "location_name": "Locatie",
    "salary": "Salaris",
    "description": "Beschrijving",
}
