"""Settings of a run, from the environment or given."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

PREFIX = "PLACELOOM_"


@dataclass(frozen=True)
class Settings:
    """``store`` holds the tables, ``data_root`` the raw and processed records, ``places_root`` the releases of open place data."""

    data_root: str = "./data"
    store: str = "./data/store"
    places_root: str = "s3a://overturemaps-us-west-2/release"
    release: str = "2026-08-19.0"
    extracts_root: str = "https://download.geofabrik.de"
    worker: str = "worker"
    max_attempts: int = 3
    pipeline: str = "0.1.0"

    @classmethod
    def of(cls, environment: Mapping[str, str] | None = None) -> Settings:
        """Each field from PLACELOOM_<FIELD> where that is set and not empty."""
        have = os.environ if environment is None else environment
        given = {f.name: have[PREFIX + f.name.upper()] for f in fields(cls) if have.get(PREFIX + f.name.upper())}
        return cls(**{k: int(v) if k == "max_attempts" else v for k, v in given.items()})
