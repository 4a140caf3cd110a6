"""One place that names every layer path, used by writers and readers alike."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


def date_path(day: dt.date | str) -> str:
    """``yyyy/MM/dd`` folder of a day (the landing convention)."""
    if isinstance(day, str):
        day = dt.date.fromisoformat(day.replace("/", "-"))
    return day.strftime("%Y/%m/%d")


@dataclass(frozen=True)
class Layout:
    root: str

    def raw_files_root(self, kind: str) -> str:
        """Landed CSV extracts of one kind (``Movies``, ``Series``)."""
        return f"{self.root}/Raw/Local/CSV/{kind}"

    def raw_files(self, kind: str, day) -> str:
        """One day of landed extracts: ``Raw/Local/CSV/{kind}/yyyy/MM/dd``."""
        return f"{self.raw_files_root(kind)}/{date_path(day)}"

    def raw_pages(self, day) -> str:
        return f"{self.root}/Raw/API/pages/{date_path(day)}"

    @property
    def raw_api_root(self) -> str:
        """Raw API layer: one ``yyyy/MM/dd`` folder of NDJSON per extraction."""
        return f"{self.root}/Raw/API/json"

    def raw_api(self, day) -> str:
        return f"{self.raw_api_root}/{date_path(day)}"

    @property
    def trusted_movies(self) -> str:
        return f"{self.root}/TRT/Movies"

    @property
    def trusted_api(self) -> str:
        """Partitioned by ``dt``; read the root and filter on ``dt``."""
        return f"{self.root}/TRT/API"

    def registry(self, star: str = "geral") -> str:
        """Key registries of a star's dimensions (stable keys)."""
        return f"{self.root}/Refined/_keys/{star}"

    @property
    def profiles_api(self) -> str:
        """Mergeable profiles of the trusted API table, one per ``dt``."""
        return f"{self.root}/TRT/_profiles/API"

    @property
    def quarantine_api(self) -> str:
        """Raw API records that did not decode in full, partitioned by ``dt``."""
        return f"{self.root}/TRT/_quarantine/API"

    def refined(self, star: str = "geral") -> str:
        return f"{self.root}/Refined/{star}"
