"""What one run needs to know. There is no clock in here: the load date is an argument."""

from __future__ import annotations

import posixpath
import re
from dataclasses import dataclass

from reviewloom.functions import paths
from reviewloom.operators import sizing


@dataclass(frozen=True)
class Labels:
    """Names written into metrics documents; every deployment has its own."""

    sigla: str = "NA"
    projeto: str = "reviews"
    layer_lake: str = "silver"
    job: str = "app_store_reviews"
    priority: str = "0"
    tower: str = "NA"
    app: str = "silver_app_store"
    search: str = "app_store"
    ts_prefix: str = ""


@dataclass(frozen=True)
class RunConfig:
    env: str
    as_of: str
    bronze: str
    silver: str
    quarantine: str
    metrics: str
    store: str = paths.STORE
    segments: tuple[str, ...] = paths.SEGMENTS
    success_index: str = "datametrics"
    fail_index: str = "datametrics_fail"
    sample_env: str = "pre"
    broadcast_limit: int = sizing.BROADCAST_LIMIT
    # Silver and ledger are clustered by id into so many files a load date; None: they are not.
    buckets: int | None = None
    labels: Labels = Labels()

    def __post_init__(self) -> None:
        if not re.fullmatch(r"[0-9]{8}", self.as_of):
            raise ValueError(f"as_of must look like yyyyMMdd: {self.as_of}")

    def segment_globs(self) -> list[str]:
        """One glob per client segment, over all apps of the load date."""
        return [
            posixpath.join(self.bronze, self.store, f"*_{segment}", f"odate={self.as_of}")
            for segment in self.segments
        ]

    @property
    def silver_path(self) -> str:
        return posixpath.join(self.silver, self.store)

    @property
    def ledger_path(self) -> str:
        """Beside silver. Its files of one number of buckets lie apart from others."""
        kind = "plain" if self.buckets is None else f"buckets_{self.buckets}"
        return posixpath.join(f"{self.silver.rstrip('/')}_ledger", self.store, kind)

    @property
    def runs_path(self) -> str:
        return posixpath.join(f"{self.silver.rstrip('/')}_runs", self.store)

    @property
    def quarantine_path(self) -> str:
        return posixpath.join(self.quarantine, self.store)
