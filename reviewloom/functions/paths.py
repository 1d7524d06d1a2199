"""Attributes carried by a review file's path.

The layout is ``<base>/<store>/<app>_<segment>/odate=<yyyyMMdd>/``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

STORE = "appleStore"
SEGMENTS = ("pf", "pj")


def source_path() -> Column:
    """Path of the file a row was read from; only for frames scanned from files."""
    return F.col("_metadata.file_path")


def app_of(path: Column, store: str = STORE) -> Column:
    """The folder below the store, segment suffix included; '' where there is none."""
    return F.regexp_extract(path, f"/{re.escape(store)}/(.*?)/odate=", 1)


def segment_of(path: Column, segments: tuple[str, ...] = SEGMENTS) -> Column:
    """The segment that ends the app folder; '' where there is none."""
    names = "|".join(re.escape(name) for name in segments)
    return F.regexp_extract(path, f"/([^/]+)_({names})/odate=", 2)
