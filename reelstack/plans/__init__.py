"""Star builder, layer jobs and the acceptance query set."""

from .jobs import (api_profile, land_extracts_job, quarantine_report, raw_ingest_job, raw_rows,
                   star_job, star_report, trusted_api, trusted_api_job, trusted_api_rows, trusted_catalog,
                   trusted_catalog_job)
from .star import (GENERAL, GENERAL_TABELA_KEYS, SUBSET, StarSpec, build_star, joined_base,
                   star_general, star_subset)

__all__ = [
    "api_profile", "land_extracts_job", "quarantine_report", "raw_ingest_job", "raw_rows", "star_job", "star_report",
    "trusted_api", "trusted_api_job", "trusted_api_rows", "trusted_catalog",
    "trusted_catalog_job",
    "GENERAL", "GENERAL_TABELA_KEYS", "SUBSET", "StarSpec", "build_star", "joined_base",
    "star_general", "star_subset",
]
