"""Lambert conformal conic (two standard parallels) as column expressions.

The zone polygons are published in a state-plane system (EPSG:2263, US survey
feet); the grid lookup works in WGS84 degrees. The projection is closed-form
math, so it runs as built-in expressions inside the scan's codegen, vertex by
vertex through ``transform`` on the ring arrays, with no per-row library.
NAD83 and WGS84 are treated as the same datum (they differ by about a metre,
a hundredth of a grid cell).
"""
from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

US_SURVEY_FOOT_M = 1200.0 / 3937.0


@dataclass(frozen=True)
class ConicConformal:
    """Ellipsoid, standard parallels, false origin (degrees) and false easting /
    northing in the projection's own unit (``unit`` metres per unit)."""
    a: float
    inv_f: float
    lat1: float
    lat2: float
    lat0: float
    lon0: float
    false_easting: float
    false_northing: float
    unit: float = 1.0

    @property
    def e(self) -> float:
        f = 1.0 / self.inv_f
        return math.sqrt(2 * f - f * f)

    def _m(self, phi: float) -> float:
        return math.cos(phi) / math.sqrt(1 - (self.e * math.sin(phi)) ** 2)

    def _t(self, phi: float) -> float:
        es = self.e * math.sin(phi)
        return math.tan(math.pi / 4 - phi / 2) / ((1 - es) / (1 + es)) ** (self.e / 2)

    @property
    def constants(self) -> tuple[float, float, float]:
        """(n, a*F, rho0) of the cone."""
        p1, p2, p0 = (math.radians(v) for v in (self.lat1, self.lat2, self.lat0))
        m1, m2 = self._m(p1), self._m(p2)
        t1, t2, t0 = self._t(p1), self._t(p2), self._t(p0)
        n = (math.log(m1) - math.log(m2)) / (math.log(t1) - math.log(t2))
        af = self.a * m1 / (n * t1 ** n)
        return n, af, af * t0 ** n


# EPSG:2263, NAD83 / New York Long Island (ftUS), the system of
# the published taxi zone polygons. GRS80 ellipsoid; standard parallels
# 41°02' N and 40°40' N; false origin 40°10' N, 74° W; false easting
# 300,000 m = 984,250 US survey feet; false northing 0.
NY_LONG_ISLAND_FTUS = ConicConformal(
    a=6378137.0, inv_f=298.257222101,
    lat1=41 + 2 / 60, lat2=40 + 40 / 60, lat0=40 + 10 / 60, lon0=-74.0,
    false_easting=984250.0, false_northing=0.0, unit=US_SURVEY_FOOT_M)


def to_lon_lat(x: Column, y: Column, crs: ConicConformal = NY_LONG_ISLAND_FTUS) -> tuple[Column, Column]:
    """(easting, northing) in the projection's unit -> (longitude, latitude) in degrees.

    Latitude from the conformal latitude by its series in the eccentricity
    (no iteration), exact to well below a millimetre on the ground."""
    n, af, rho0 = crs.constants
    e2 = crs.e ** 2
    dx = (x - F.lit(crs.false_easting)) * F.lit(crs.unit)
    dy = F.lit(rho0) - (y - F.lit(crs.false_northing)) * F.lit(crs.unit)
    sign = 1.0 if n > 0 else -1.0
    rho = F.sqrt(dx * dx + dy * dy) * F.lit(sign)
    t = F.pow(rho / F.lit(af), F.lit(1.0 / n))
    theta = F.atan2(dx * F.lit(sign), dy * F.lit(sign))
    lon = F.degrees(theta / F.lit(n)) + F.lit(crs.lon0)
    chi = F.lit(math.pi / 2) - F.atan(t) * 2
    c2 = e2 / 2 + 5 * e2 ** 2 / 24 + e2 ** 3 / 12 + 13 * e2 ** 4 / 360
    c4 = 7 * e2 ** 2 / 48 + 29 * e2 ** 3 / 240 + 811 * e2 ** 4 / 11520
    c6 = 7 * e2 ** 3 / 120 + 81 * e2 ** 4 / 1120
    c8 = 4279 * e2 ** 4 / 161280
    phi = (chi + F.sin(chi * 2) * c2 + F.sin(chi * 4) * c4
           + F.sin(chi * 6) * c6 + F.sin(chi * 8) * c8)
    return lon, F.degrees(phi)


def to_easting_northing(lon: Column, lat: Column,
                        crs: ConicConformal = NY_LONG_ISLAND_FTUS) -> tuple[Column, Column]:
    """(longitude, latitude) in degrees -> (easting, northing) in the projection's unit."""
    n, af, rho0 = crs.constants
    e = crs.e
    phi = F.radians(lat)
    es = F.sin(phi) * e
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((F.lit(1.0) - es) / (F.lit(1.0) + es), F.lit(e / 2))
    rho = F.pow(t, F.lit(n)) * af
    gamma = F.radians(lon - F.lit(crs.lon0)) * n
    x = F.sin(gamma) * rho / F.lit(crs.unit) + F.lit(crs.false_easting)
    y = (F.lit(rho0) - rho * F.cos(gamma)) / F.lit(crs.unit) + F.lit(crs.false_northing)
    return x, y


def rings_to_wgs84(pts: str | Column, crs: ConicConformal = NY_LONG_ISLAND_FTUS) -> Column:
    """A ring ``array<struct<lon, lat>>`` holding projected (easting, northing)
    pairs -> the same ring in degrees, vertex by vertex."""
    col = F.col(pts) if isinstance(pts, str) else pts

    def vertex(p: Column) -> Column:
        lon, lat = to_lon_lat(p["lon"], p["lat"], crs)
        return F.struct(lon.alias("lon"), lat.alias("lat"))
    return F.transform(col, vertex)
