"""Report requests."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.schemas import REPORT_REQUEST

# Device names of a request and the codes stored in the bid table.
DEVICE_CODES = {"PC": 2, "Mobile": 0, "Tablet": 1}

FILTERS = ("tagid", "placementid", "channel", "device", "os", "size")


@dataclass(frozen=True)
class ReportSpec:
    """What an on-demand traffic report asks for.

    An empty filter lets every row pass; an unknown device name matches no row.
    """

    platform: str
    start: str
    end: str
    columns: tuple[str, ...] = ()
    filters: dict[str, tuple] = field(default_factory=dict)
    id: str = ""

    @classmethod
    def from_json(cls, text: str) -> ReportSpec:
        """One request document."""
        request = json.loads(text)
        filters = {}
        for name in FILTERS:
            values = tuple((request.get("filters") or {}).get(name) or ())
            if name == "device":
                values = tuple(DEVICE_CODES.get(value) for value in values)
            if values:
                filters[name] = values
        return cls(
            platform=request["platform"],
            start=str(request["start_time"]),
            end=str(request["end_time"]),
            columns=split_columns((request.get("report") or {}).get("columns", "")),
            filters=filters,
            id=str(request.get("id", "")),
        )


@dataclass(frozen=True)
class ReachSpec:
    """What a keyword reach estimate asks for."""

    platform: str = "youku"
    id: int = 0
    path: str = ""
    channel: tuple[str, ...] = ()
    device: tuple[str, ...] = ()
    size: tuple[str, ...] = ()
    system: tuple[str, ...] = ()
    placementid: tuple[str, ...] = ()

    @classmethod
    def from_json(cls, text: str) -> ReachSpec:
        request = json.loads(text)
        lists = ("channel", "device", "size", "system", "placementid")
        return cls(
            platform=request.get("platform", "youku"),
            id=int(request["id"]),
            path=request.get("path", "").replace(":", "/"),
            **{name: tuple(request.get(name) or ()) for name in lists},
        )


def split_columns(text: str) -> tuple[str, ...]:
    """Comma-joined column names, blanks trimmed, repeats removed, order kept."""
    names = [name.strip() for name in text.split(",")]
    return tuple(dict.fromkeys(name for name in names if name))


def parse_requests(lines: DataFrame, column: str = "value") -> DataFrame:
    """A table of request documents as typed columns."""
    return lines.select(F.from_json(column, REPORT_REQUEST).alias("r")).select("r.*")
