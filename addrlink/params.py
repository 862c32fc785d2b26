"""Thresholds of the address operators."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class LinkParams:
    cluster_cell: float = 0.02
    footprint_cell: float = 0.01
    mass_cell: float = 0.05
    dilate: int = 1
    anchor_radius_km: float = 60.0
    max_extent_km: float = 15.0
    envelope_km: float = 1.0
    neighbour_km: float = 1.0
    neighbour_min: int = 3
    fuzzy: bool = True
    envelope: bool = True
    neighbours: bool = True
    exclusive: bool = True
    validate: bool = True
    examples: int = 30


@dataclass(frozen=True)
class NetworkParams:
    cell: float = 0.002
    max_segment_km: float = 0.111
    touch_km: float = 0.0015
    only_ok: bool = True
    bbox: tuple[float, float, float, float] | None = None  # lng_min, lat_min, lng_max, lat_max


@dataclass(frozen=True)
class ExtractParams:
    datasets: tuple[str, ...] = ("estado", "municipio", "bairro", "logradouro")
    addr_points: bool = False
    way_geom: bool = False
    states: tuple[str, ...] = ()
    shard_lines: int = 0
    extra: dict = field(default_factory=dict)


def parse_bbox(text: str) -> tuple[float, float, float, float]:
    """lng_min,lat_min,lng_max,lat_max; raises unless there are four numbers in order."""
    parts = [float(x) for x in text.split(",")]
    if len(parts) != 4 or parts[0] > parts[2] or parts[1] > parts[3]:
        raise ValueError(f"a bounding box is four numbers lng_min,lat_min,lng_max,lat_max: {text}")
    return tuple(parts)  # type: ignore[return-value]


def parse_datasets(text: str, way_geom: bool = False, addr_points: bool = False) -> ExtractParams:
    """Comma-separated datasets; ``geom`` forces the streets it belongs to."""
    wanted = [x.strip().lower() for x in text.split(",") if x.strip()] or list(ExtractParams().datasets)
    geom = way_geom or "geom" in wanted
    names = [x for x in wanted if x != "geom"]
    if geom and "logradouro" not in names:
        names.append("logradouro")
    return ExtractParams(tuple(dict.fromkeys(names)), addr_points, geom)
