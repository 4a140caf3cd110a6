"""Job parameters. The reference hard-codes these; here they are defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: must equal the reference's for the same results. ---------
# Discover crawl: genre ids (fantasy, science fiction), years, page cap.
GENRE_IDS = [14, 878]
YEAR_FIRST, YEAR_LAST = 2001, 2015
MAX_PAGES = 500
# Raw API files hold at most this many records each.
RECORDS_PER_FILE = 100
# Trusted catalogue: character keywords of the three sagas, genre keywords,
# ids denied in the keyword branch.
SAGA_KEYWORDS = ["Harry Potter", "Katniss Everdeen", "Bella Swan"]
GENRE_KEYWORDS = ["Fantasy", "Sci-Fi"]
DENY_IDS = ["tt0092115", "tt20766450", "tt8443702"]
# Quality gates shared by the catalogue and API jobs.
MIN_MINUTES = 80
MIN_VOTES = 30
# Extraction date stamped on the trusted API rows.
EXTRACTION_DATE = "2024/04/12"
# The titles of the subset star, in the reference's order.
SUBSET_IDS = [
    "tt0241527", "tt0295297", "tt0304141", "tt0330373", "tt0373889", "tt0417741",
    "tt0926084", "tt1201607", "tt1392170", "tt1951264", "tt1951265", "tt1951266",
    "tt1099212", "tt1259571", "tt1324999", "tt1325004", "tt1673434",
]
# Surrogate key prefixes: general star (date, title, adult), subset star.
GENERAL_PREFIXES = ("dtg", "tig", "adg")
SUBSET_PREFIXES = ("dt", "ti", "ad")
# --- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class CatalogParams:
    """Gates of the trusted catalogue job (keyword branch OR genre branch)."""

    saga_keywords: list = field(default_factory=lambda: list(SAGA_KEYWORDS))
    genre_keywords: list = field(default_factory=lambda: list(GENRE_KEYWORDS))
    deny_ids: list = field(default_factory=lambda: list(DENY_IDS))
    year_first: int = YEAR_FIRST
    year_last: int = YEAR_LAST
    min_minutes: int = MIN_MINUTES
    min_votes: float = MIN_VOTES


@dataclass(frozen=True)
class ApiParams:
    """Gates and stamp of the trusted API job."""

    min_minutes: int = MIN_MINUTES
    min_votes: int = MIN_VOTES
    extraction_date: str = EXTRACTION_DATE
