"""Expected power and clear-sky irradiance as column expressions."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, types as T
from pyspark.sql import functions as F


def expected_kw(poa: Column, dc_kw: Column, derate: Column, low_light_k: Column) -> Column:
    """Nameplate times suns times the loss factor, with a low-light curve where k > 0."""
    flat = dc_kw * (poa / 1000.0) * derate
    g = F.greatest(poa, F.lit(0.0))
    curve = F.try_divide(g * (1000.0 + low_light_k), 1000.0 * (g + low_light_k))
    return F.when(poa.isNull(), F.lit(None)).when(low_light_k > 0, flat * curve).otherwise(flat)


def _sky(doy, utc_min, lat, lon, tilt, azimuth, diffuse_frac, albedo):
    """Irradiance of arrays of labels; NaN where an input is missing that it needs."""
    import numpy as np

    gamma = 2 * math.pi / 365.0 * (doy - 1)
    decl = (
        0.006918 - 0.399912 * np.cos(gamma) + 0.070257 * np.sin(gamma)
        - 0.006758 * np.cos(2 * gamma) + 0.000907 * np.sin(2 * gamma)
        - 0.002697 * np.cos(3 * gamma) + 0.00148 * np.sin(3 * gamma)
    )
    eot_min = 229.18 * (
        0.000075 + 0.001868 * np.cos(gamma) - 0.032077 * np.sin(gamma)
        - 0.014615 * np.cos(2 * gamma) - 0.040849 * np.sin(2 * gamma)
    )
    hour_angle = np.radians((utc_min + 4 * lon + eot_min) / 4 - 180.0)
    phi, beta, face = np.radians(lat), np.radians(tilt), np.radians(azimuth)
    east = -np.cos(decl) * np.sin(hour_angle)
    north = np.sin(decl) * np.cos(phi) - np.cos(decl) * np.sin(phi) * np.cos(hour_angle)
    up = np.sin(phi) * np.sin(decl) + np.cos(phi) * np.cos(decl) * np.cos(hour_angle)
    facing = (
        up * np.cos(beta)
        + north * np.sin(beta) * np.cos(face)
        + east * np.sin(beta) * np.sin(face)
    )
    lit_up = np.fmax(up, 1e-6)
    ghi = 1098.0 * up * np.exp(-0.057 / lit_up)
    direct = (1 - diffuse_frac) * ghi / lit_up
    poa = (
        direct * np.fmax(facing, 0.0)
        + diffuse_frac * ghi * (1 + np.cos(beta)) / 2
        + albedo * ghi * (1 - np.cos(beta)) / 2
    )
    return np.where(up > 0, poa, np.where(np.isnan(up), np.nan, 0.0))


def clearsky_poa(
    ts_utc: Column, lat: Column, lon: Column, tilt: Column, azimuth: Column,
    diffuse_frac: float = 0.12, albedo: float = 0.25,
) -> Column:
    """Clear-sky plane-of-array irradiance (W/m2) at the interval label.

    Spencer's series for declination and the equation of time, Haurwitz' global
    horizontal model, a fixed clear-sky diffuse fraction and an isotropic sky.
    Worked out in Arrow batches: as one expression, its repeated terms make a
    method too long for the JVM to compile.
    """
    @F.pandas_udf(T.DoubleType())
    def sky(doy: pd.Series, utc_min: pd.Series, lat: pd.Series, lon: pd.Series, tilt: pd.Series, azimuth: pd.Series) -> pd.Series:
        given = (c.to_numpy(float, na_value=float("nan")) for c in (doy, utc_min, lat, lon, tilt, azimuth))
        return pd.Series(_sky(*given, diffuse_frac, albedo))

    utc_min = F.hour(ts_utc) * 60 + F.minute(ts_utc) + F.second(ts_utc) / 60.0
    return sky(F.dayofyear(ts_utc), utc_min, *(c.cast("double") for c in (lat, lon, tilt, azimuth)))


def per_hour(interval_min: Column) -> Column:
    return 60.0 / interval_min


def night_zero(ac: Column, clearsky: Column) -> Column:
    """A missing meter value with the sun down is an implicit zero."""
    return F.when(ac.isNull() & (clearsky <= 0), F.lit(0.0)).otherwise(ac)


def unit_count(deficit: Column, ac_kw: Column, n_units: Column) -> Column:
    return F.try_divide(deficit, ac_kw / n_units)


def unit_distance(units: Column) -> Column:
    return F.abs(units - F.rint(units))
