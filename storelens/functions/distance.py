"""Distances between points on the globe."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T
from pyspark.sql.functions import pandas_udf

# Mean earth radius (km) and the WGS-84 ellipsoid.
EARTH_RADIUS_KM = 6371.0088
WGS84_A_KM = 6378.137
WGS84_F = 1 / 298.257223563

# Geodesic and great-circle distance differ by less than this share.
GEODESIC_SLACK = 0.006


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance as a JVM expression."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    h = (
        F.sin(half_lat) * F.sin(half_lat)
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(half_lon) * F.sin(half_lon)
    )
    # not least(): it would turn an unknown position into a distance
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.when(h > 1, F.lit(1.0)).otherwise(F.sqrt(h)))


def _arc(sin_alpha, sin_sigma, cos_sigma, cos_2m):
    """Longitude the ellipsoid takes off the auxiliary sphere's, and the length, of an arc by Vincenty's series."""
    f, b = WGS84_F, (1 - WGS84_F) * WGS84_A_KM
    sigma, cos2_alpha = np.arctan2(sin_sigma, cos_sigma), 1 - sin_alpha**2
    c = f / 16 * cos2_alpha * (4 + f * (4 - 3 * cos2_alpha))
    lost = (1 - c) * f * sin_alpha * (sigma + c * sin_sigma * (cos_2m + c * cos_sigma * (2 * cos_2m**2 - 1)))
    usq = cos2_alpha * (WGS84_A_KM**2 - b**2) / b**2
    aa = 1 + usq / 16384 * (4096 + usq * (-768 + usq * (320 - 175 * usq)))
    bb = usq / 1024 * (256 + usq * (-128 + usq * (74 - 47 * usq)))
    delta = bb * sin_sigma * (cos_2m + bb / 4 * (
        cos_sigma * (2 * cos_2m**2 - 1) - bb / 6 * cos_2m * (4 * sin_sigma**2 - 3) * (4 * cos_2m**2 - 3)))
    return lost, b * aa * (sigma - delta)


def _by_azimuth_km(u1, u2, big_l) -> np.ndarray:
    """Geodesics between nearly opposite points, where iterating the longitude does not settle.

    From the point farther from the equator, put south of it, the longitude reached at the other's latitude grows with
    the azimuth from 0 to 180 degrees; the azimuth is halved in.
    """
    swap = np.abs(u1) < np.abs(u2)
    far, near = np.where(swap, u2, u1), np.where(swap, u1, u2)
    near, far, wanted = np.where(far > 0, -near, near), -np.abs(far), np.abs(big_l)
    low, high = np.zeros_like(wanted), np.full_like(wanted, np.pi)
    for _ in range(60):
        alpha = (low + high) / 2
        sin0 = np.sin(alpha) * np.cos(far)
        cos2 = np.sqrt(np.maximum(0.0, (np.cos(alpha) * np.cos(far))**2 + np.cos(near)**2 - np.cos(far)**2))
        s1, s2 = np.arctan2(np.sin(far), np.cos(alpha) * np.cos(far)), np.arctan2(np.sin(near), cos2)
        w1, w2 = np.arctan2(sin0 * np.sin(s1), np.cos(s1)), np.arctan2(sin0 * np.sin(s2), np.cos(s2))
        lost, length = _arc(sin0, np.sin(s2 - s1), np.cos(s2 - s1), np.cos(s1 + s2))
        short = w2 - w1 - lost < wanted
        low, high = np.where(short, alpha, low), np.where(short, high, alpha)
    return length


def _vincenty_km(lat1, lon1, lat2, lon2) -> np.ndarray:
    """Vectorised inverse geodesic on WGS-84 (Vincenty 1975)."""
    f = WGS84_F
    u1 = np.arctan((1 - f) * np.tan(np.radians(lat1)))
    u2 = np.arctan((1 - f) * np.tan(np.radians(lat2)))
    big_l = np.radians((lon2 - lon1 + 540.0) % 360.0 - 180.0)
    lam = big_l.copy()
    s1, c1, s2, c2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    with np.errstate(divide="ignore", invalid="ignore"):
        for _ in range(100):
            sl, cl = np.sin(lam), np.cos(lam)
            sin_sigma = np.hypot(c2 * sl, c1 * s2 - s1 * c2 * cl)
            cos_sigma = s1 * s2 + c1 * c2 * cl
            sigma = np.arctan2(sin_sigma, cos_sigma)
            sin_alpha = np.where(sin_sigma == 0, 0.0, c1 * c2 * sl / sin_sigma)
            cos2_alpha = 1 - sin_alpha**2
            cos_2m = np.where(cos2_alpha == 0, 0.0, cos_sigma - 2 * s1 * s2 / cos2_alpha)
            cc = f / 16 * cos2_alpha * (4 + f * (4 - 3 * cos2_alpha))
            nxt = big_l + (1 - cc) * f * sin_alpha * (
                sigma + cc * sin_sigma * (cos_2m + cc * cos_sigma * (2 * cos_2m**2 - 1))
            )
            moved = np.abs(nxt - lam)
            lam = nxt
            if np.nanmax(moved, initial=0.0) < 1e-12:
                break
        _, length = _arc(sin_alpha, sin_sigma, cos_sigma, cos_2m)
    out = np.where((sin_sigma == 0) & (cos_sigma > 0), 0.0, length)
    # longitudes that do not settle, or settle beyond half a turn, belong to nearly opposite points
    rest = np.flatnonzero(((moved >= 1e-12) | (np.abs(lam) > np.pi) | ((sin_sigma == 0) & (cos_sigma < 0))) & np.isfinite(u1 + u2 + big_l))
    if len(rest):
        out[rest] = _by_azimuth_km(u1[rest], u2[rest], big_l[rest])
    return out


@pandas_udf(T.DoubleType())
def geodesic_km(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.Series:
    """WGS-84 geodesic distance, one Arrow batch at a time."""
    args = [s.to_numpy(dtype="float64") for s in (lat1, lon1, lat2, lon2)]
    return pd.Series(_vincenty_km(*args))


def distance_km(method: str):
    """The distance function named ``haversine`` or ``geodesic``."""
    if method not in ("haversine", "geodesic"):
        raise ValueError(f"unknown distance {method!r}")
    return haversine_km if method == "haversine" else geodesic_km
