"""Declarative specs of a run: its sources, its star and its sinks."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field, fields
from pathlib import Path


def _from_dict(cls, values: Mapping):
    unknown = set(values) - {f.name for f in fields(cls)}
    if unknown:
        raise ValueError(f"{cls.__name__} has no field {', '.join(sorted(unknown))}")
    return cls(**values)


@dataclass(frozen=True)
class SourceSpec:
    """One source table and how to clean it.

    ``schema`` names the columns the source must have and their Spark types;
    without it CSV columns are read as text, or with ``infer`` as the types that one
    more pass over them finds. ``dedupe_order`` decides which of
    several rows with equal ``dedupe`` columns survives (the smallest one).
    """

    path: str
    sep: str = ","
    schema: Mapping[str, str] | None = None
    casts: Mapping[str, str] = field(default_factory=dict)
    dropna: Sequence[str] = ()
    dedupe: Sequence[str] = ()
    dedupe_order: Sequence[str] = ()
    drop: Sequence[str] = ()
    min_rows: int = 10
    infer: bool = False


@dataclass(frozen=True)
class SinkSpec:
    """Where one table of the star is written."""

    path: str
    name: str
    partition_by: Sequence[str] = ()
    min_rows: int = 10


@dataclass(frozen=True)
class StarSpec:
    """Column names and choices of a star over one arrivals table."""

    # columns of the arrivals
    date: str = "arrdate"
    country: str = "i94res"
    port: str = "i94port"
    mode: str = "i94mode"
    state: str = "i94addr"
    air_mode: int = 1
    date_columns: Sequence[str] = ("arrdate", "depdate")

    # names of the dimension keys, also those of the fact table's foreign keys
    date_key: str = "arrival_date"
    country_key: str = "country_code"
    port_key: str = "arrival_port"
    state_key: str = "state_code"

    # one airport row per port (the matched one), or also a row without an
    # airport for a port that is used by air and otherwise
    unique_ports: bool = False

    # a race without a row counts as 0 in its city's average, or not at all
    zero_fill: bool = True

    @property
    def renames(self) -> dict[str, str]:
        return {
            self.date: self.date_key,
            self.country: self.country_key,
            self.port: self.port_key,
            self.state: self.state_key,
        }


@dataclass(frozen=True)
class RunSpec:
    """A whole run. Sources and sinks are named; see ``plans.arrivals``."""

    sources: Mapping[str, SourceSpec]
    star: StarSpec = field(default_factory=StarSpec)
    sinks: Mapping[str, SinkSpec] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, values: Mapping) -> RunSpec:
        unknown = set(values) - {"sources", "star", "sinks"}
        if unknown:
            raise ValueError(f"RunSpec has no field {', '.join(sorted(unknown))}")
        return cls(
            sources={k: _from_dict(SourceSpec, v) for k, v in values["sources"].items()},
            star=_from_dict(StarSpec, values.get("star", {})),
            sinks={k: _from_dict(SinkSpec, v) for k, v in values.get("sinks", {}).items()},
        )

    def to_dict(self) -> dict:
        return asdict(self)

    @classmethod
    def read_json(cls, path: str | Path) -> RunSpec:
        return cls.from_dict(json.loads(Path(path).read_text()))

    def write_json(self, path: str | Path) -> None:
        Path(path).write_text(json.dumps(self.to_dict(), indent=2))
