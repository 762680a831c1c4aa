"""Settings of a mart: where data lives and which dates it covers."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Calendar:
    """Inclusive day range of the date dimension; day one has key 1."""

    start: dt.date
    end: dt.date


# The default calendar range and the watermark of a dimension that has no closed version yet.
DEFAULT_CALENDAR = Calendar(dt.date(2020, 1, 1), dt.date(2025, 12, 31))
DEFAULT_FLOOR_DATE = dt.date(1999, 12, 31)

# Formats whose catalogs run MERGE themselves.
ROW_LEVEL_FORMATS = ("iceberg", "delta")


@dataclass(frozen=True)
class MartConfig:
    """Locations take any Hadoop file system URI (``s3a://``, ``hdfs://``, ``file:/``)."""

    inputs: str
    staging: str
    warehouse: str
    namespace: str = "starmart"
    table_format: str = "parquet"
    calendar: Calendar = field(default=DEFAULT_CALENDAR)
    floor_date: dt.date = DEFAULT_FLOOR_DATE
    # False keeps rows that break the table contracts (no matching version, huge totals) instead of failing the run.
    strict: bool = True
    # True sets fact rows that break the strict contracts aside, counted by column, instead of failing the run. A warehouse
    # keeps one of the three ways.
    quarantine: bool = False
    # True gives facts without a valid version, date or item the unknown members and zeros instead of NULLs.
    unknown_members: bool = False
    # True lets a version end where the next one of its key begins, for facts, instead of where it was closed.
    contiguous_validity: bool = False

    def __post_init__(self) -> None:
        if self.quarantine and (not self.strict or self.row_level):
            raise ValueError("the quarantine is for strict contracts of file tables")

    @property
    def row_level(self) -> bool:
        return self.table_format in ROW_LEVEL_FORMATS

    def table(self, name: str) -> str:
        return f"{self.namespace}.{name}"

    def folder(self, name: str) -> str:
        """Where the files of a file table are."""
        return f"{self.warehouse.rstrip('/')}/{name}"
