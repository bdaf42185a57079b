"""Distances and coordinates."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EARTH_M = 6_371_000


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres; null if a coordinate is."""
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_M * F.atan2(F.sqrt(h), F.sqrt(1 - h))


def far_if_unknown(distance: Column) -> Column:
    return F.coalesce(distance, F.lit(math.inf))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle kilometres by the arc sine."""
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * 6371 * F.asin(F.sqrt(h))


def planar(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in degrees."""
    return F.sqrt(F.pow(lat1 - lat2, 2) + F.pow(lon1 - lon2, 2))


def within_box(lat: Column, lon: Column, south: float, west: float, north: float, east: float) -> Column:
    return lat.between(south, north) & lon.between(west, east)


def geodesic(lat1, lon1, lat2, lon2):
    """Metres on the WGS 84 ellipsoid by Vincenty's inverse formula, for arrays."""
    a, f = 6378137.0, 1 / 298.257223563
    b = (1 - f) * a
    lat1, lon1, lat2, lon2 = (np.radians(np.asarray(x, dtype=float)) for x in (lat1, lon1, lat2, lon2))
    u1, u2 = np.arctan((1 - f) * np.tan(lat1)), np.arctan((1 - f) * np.tan(lat2))
    span = lon2 - lon1
    angle = span.copy()
    for _ in range(60):
        s, c = np.sin(angle), np.cos(angle)
        sin_sigma = np.sqrt((np.cos(u2) * s) ** 2 + (np.cos(u1) * np.sin(u2) - np.sin(u1) * np.cos(u2) * c) ** 2)
        cos_sigma = np.sin(u1) * np.sin(u2) + np.cos(u1) * np.cos(u2) * c
        sigma = np.arctan2(sin_sigma, cos_sigma)
        sin_alpha = np.where(sin_sigma == 0, 0, np.cos(u1) * np.cos(u2) * s / np.where(sin_sigma == 0, 1, sin_sigma))
        cos2 = 1 - sin_alpha**2
        middle = np.where(cos2 == 0, 0, cos_sigma - 2 * np.sin(u1) * np.sin(u2) / np.where(cos2 == 0, 1, cos2))
        k = f / 16 * cos2 * (4 + f * (4 - 3 * cos2))
        new = span + (1 - k) * f * sin_alpha * (sigma + k * sin_sigma * (middle + k * cos_sigma * (2 * middle**2 - 1)))
        done = np.all(np.abs(new - angle) < 1e-13)
        angle = new
        if done:
            break
    u = cos2 * (a**2 - b**2) / b**2
    big, small = 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u))), u / 1024 * (256 + u * (-128 + u * (74 - 47 * u)))
    change = small * sin_sigma * (middle + small / 4 * (cos_sigma * (2 * middle**2 - 1) - small / 6 * middle * (4 * sin_sigma**2 - 3) * (4 * middle**2 - 3)))
    return b * big * (sigma - change)


def near_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres on the WGS 84 ellipsoid between places that are near each other: by the radii of curvature between them."""
    a, e2 = 6378137.0, 1 / 298.257223563 * (2 - 1 / 298.257223563)
    middle = F.radians((lat1 + lat2) / 2)
    w = 1 - e2 * F.pow(F.sin(middle), 2)
    north = F.lit(a * (1 - e2)) / F.pow(w, 1.5) * F.radians(lat2 - lat1)
    east = F.lit(a) / F.sqrt(w) * F.cos(middle) * F.radians(lon2 - lon1)
    return F.sqrt(F.pow(north, 2) + F.pow(east, 2))


def grid_to_wgs84(east, north) -> tuple[np.ndarray, np.ndarray]:
    """(lat, lon) of metres in the Hong Kong 1980 Grid (EPSG:2326), by the registry's projection and datum parameters."""
    a, f = 6378388.0, 1 / 297.0
    lat0, lon0, east0, north0 = math.radians(22 + 18 / 60 + 43.68 / 3600), math.radians(114 + 10 / 60 + 42.80 / 3600), 836694.05, 819069.80
    e2 = f * (2 - f)
    c0, c2, c4 = 1 - e2 / 4 - 3 * e2**2 / 64, 3 / 8 * (e2 + e2**2 / 4), 15 / 256 * e2**2
    arc = lambda x: a * (c0 * x - c2 * np.sin(2 * x) + c4 * np.sin(4 * x))
    east, north = np.asarray(east, dtype=float) - east0, np.asarray(north, dtype=float) - north0
    foot = lat0 + north / (a * c0)
    for _ in range(8):
        foot = foot - (arc(foot) - arc(lat0) - north) / (a * (1 - e2) / (1 - e2 * np.sin(foot) ** 2) ** 1.5)
    t, nu, rho = np.tan(foot), a / np.sqrt(1 - e2 * np.sin(foot) ** 2), a * (1 - e2) / (1 - e2 * np.sin(foot) ** 2) ** 1.5
    psi = nu / rho
    lat = foot - t / rho * east**2 / (2 * nu) * (1 - east**2 / (12 * nu**2) * (9 * psi * (1 - t**2) + 12 * t**2 - 4 * psi**2))
    lon = lon0 + east / (nu * np.cos(foot)) * (1 - east**2 / (6 * nu**2) * (psi + 2 * t**2))
    # to Earth-centred coordinates, then seven parameters (EPSG:1825)
    nu = a / np.sqrt(1 - e2 * np.sin(lat) ** 2)
    x, y, z = nu * np.cos(lat) * np.cos(lon), nu * np.cos(lat) * np.sin(lon), nu * (1 - e2) * np.sin(lat)
    rx, ry, rz = (math.radians(s / 3600) for s in (0.067753, -2.243649, -1.158827))
    scale = 1 - 1.094246e-6
    x, y, z = -162.619 + scale * (x - rz * y + ry * z), -276.959 + scale * (rz * x + y - rx * z), -161.764 + scale * (-ry * x + rx * y + z)
    a, f = 6378137.0, 1 / 298.257223563
    e2 = f * (2 - f)
    p = np.hypot(x, y)
    lat = np.arctan2(z, p * (1 - e2))
    for _ in range(6):
        nu = a / np.sqrt(1 - e2 * np.sin(lat) ** 2)
        lat = np.arctan2(z + e2 * nu * np.sin(lat), p)
    return np.degrees(lat), np.degrees(np.arctan2(y, x))


@F.pandas_udf(T.DoubleType())
def geodesic_m(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.Series:
    return pd.Series(geodesic(lat1, lon1, lat2, lon2))


@F.pandas_udf(T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())]))
def wgs84(east: pd.Series, north: pd.Series) -> pd.DataFrame:
    lat, lon = grid_to_wgs84(east, north)
    return pd.DataFrame({"lat": lat, "lon": lon})
