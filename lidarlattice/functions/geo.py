"""Projection, grid cells and chunk names as column math."""

from __future__ import annotations

from dataclasses import dataclass
from math import cos, radians, sin, sqrt

from pyspark.sql import Column
from pyspark.sql import functions as F

#: WGS84, and the standard parallel of the equal-area cylindrical projection.
AXIS, FLATTENING, PARALLEL = 6378137.0, 1 / 298.257223563, 30.0
E2 = FLATTENING * (2 - FLATTENING)
E1 = sqrt(E2)
K0 = cos(radians(PARALLEL)) / sqrt(1 - E2 * sin(radians(PARALLEL)) ** 2)


@dataclass(frozen=True)
class GridSpec:
    """A global grid: upper-left corner and cell size in metres; rows run downward."""

    res: float
    x0: float = -17367530.445
    y0: float = 7314540.83

    @property
    def cell_area(self) -> float:
        return self.res * self.res


@dataclass(frozen=True)
class DegreeGrid:
    """A global grid in degrees, anchored at (-180, 90); its size in metres is that at the equator."""

    res: float
    x0: float = -180.0
    y0: float = 90.0

    @property
    def metres(self) -> float:
        return self.res * 111320.0

    @property
    def cell_area(self) -> float:
        return self.metres * self.metres


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def project_x(lon) -> Column:
    return F.lit(AXIS * K0) * F.radians(col(lon))


def project_y(lat) -> Column:
    s = F.sin(F.radians(col(lat)))
    q = F.lit(1 - E2) * (s / (1 - F.lit(E2) * s * s) - F.ln((1 - F.lit(E1) * s) / (1 + F.lit(E1) * s)) / F.lit(2 * E1))
    return F.lit(AXIS) * q / F.lit(2 * K0)


def cell_col(x, grid: GridSpec | DegreeGrid) -> Column:
    return F.floor((col(x) - F.lit(grid.x0)) / F.lit(grid.res)).cast("long")


def cell_row(y, grid: GridSpec | DegreeGrid) -> Column:
    return F.floor((F.lit(grid.y0) - col(y)) / F.lit(grid.res)).cast("long")


def fine_col(x, size: float = 30.0) -> Column:
    return F.floor(col(x) / F.lit(size)).cast("long")


def fine_row(y, size: float = 30.0) -> Column:
    return F.floor(-col(y) / F.lit(size)).cast("long")


def fine_cell_4326(lon, lat, step: float = 0.00026949335) -> tuple[Column, Column]:
    """The fine grid in degrees, anchored at (-180, 90)."""
    return F.floor((col(lon) + 180.0) / F.lit(step)).cast("long"), F.floor((90.0 - col(lat)) / F.lit(step)).cast("long")


def chunk_id(lon, lat, dim: int = 1, x_max: int = 180, y_max: int = 52) -> Column:
    """Name of the lower-left corner, like 112W34N; null outside [-x_max, x_max) x [-y_max, y_max)."""
    x, y = (F.floor(col(c) / dim).cast("int") * dim for c in (lon, lat))
    name = F.concat(F.lpad(F.abs(x).cast("string"), 3, "0"), F.when(x < 0, "W").otherwise("E"), F.lpad(F.abs(y).cast("string"), 2, "0"), F.when(y < 0, "S").otherwise("N"))
    return F.when((col(lon) >= -x_max) & (col(lon) < x_max) & (col(lat) >= -y_max) & (col(lat) < y_max), name)


def chunk_bounds(chunk, dim: int = 1, buffer: float = 0.0) -> dict[str, Column]:
    """xmin, ymin, xmax, ymax of a chunk name, widened by `buffer` degrees."""
    c = col(chunk)
    x = F.substring(c, 1, 3).cast("int") * F.when(F.substring(c, 4, 1) == "W", -1).otherwise(1)
    y = F.substring(c, 5, 2).cast("int") * F.when(F.substring(c, 7, 1) == "S", -1).otherwise(1)
    b = F.lit(float(buffer))
    return {"xmin": x - b, "ymin": y - b, "xmax": x + dim + b, "ymax": y + dim + b}


def in_bbox(lon, lat, xmin: float, ymin: float, xmax: float, ymax: float, half_open: bool = False) -> Column:
    if half_open:
        return (col(lon) >= xmin) & (col(lon) < xmax) & (col(lat) >= ymin) & (col(lat) < ymax)
    return col(lon).between(xmin, xmax) & col(lat).between(ymin, ymax)


def in_polygon(lon, lat, vertices: list[tuple[float, float]]) -> Column:
    """Even-odd rule by crossing counts, one term per edge, after a bounding-box test; polygons of a few hundred edges at most."""
    x, y = col(lon), col(lat)
    crossings = F.lit(0)
    for (ax, ay), (bx, by) in zip(vertices, vertices[1:] + vertices[:1], strict=True):
        if ay != by:
            hit = ((F.lit(ay) > y) != (F.lit(by) > y)) & (x < F.lit(bx - ax) * (y - F.lit(ay)) / F.lit(by - ay) + F.lit(ax))
            crossings = crossings + hit.cast("int")
    xs, ys = zip(*vertices, strict=True)
    return in_bbox(x, y, min(xs), min(ys), max(xs), max(ys)) & (crossings % 2 == 1)


def track_id(orbit, beam) -> Column:
    return F.concat_ws("-", col(orbit).cast("string"), col(beam))


def orbit_grid_id(orbit, sub_orbit, grid) -> Column:
    return F.concat(col(orbit).cast("string"), col(sub_orbit).cast("int").cast("string"), F.lit("-"), col(grid))


def perc_cover(shots, res: float, footprint: float = 25.0) -> Column:
    """Footprint area as a share of the cell, in percent."""
    return col(shots) * F.lit(3.141592653589793 * (footprint / 2) ** 2) / F.lit(res * res) * 100
