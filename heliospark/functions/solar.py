"""Sun position and clear-sky irradiance as closed-form column expressions.

Position follows the NOAA solar calculator (Meeus series, about 0.01 degree). Clear-sky irradiance
is Haurwitz's formula, or Ineichen-Perez when monthly Linke turbidities are given.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliospark import config
from heliospark.functions.times import epoch_seconds, local_to_utc


def with_solar_position(df: DataFrame, ts: str = "generation_date", latitude: float = config.LATITUDE,
                        longitude: float = config.LONGITUDE, tz: str = config.TIMEZONE) -> DataFrame:
    """Add ``elevation`` and ``azimuth`` in degrees for a local wall-clock column."""
    lat = math.radians(latitude)
    sin_lat, cos_lat = f"{math.sin(lat)!r}D", f"{math.cos(lat)!r}D"
    equation_of_time = (
        "4D * degrees(_y * sin(2D * _l0) - 2D * _e * sin(_m) + 4D * _e * _y * sin(_m) * cos(2D * _l0)"
        " - 0.5D * _y * _y * sin(4D * _l0) - 1.25D * _e * _e * sin(2D * _m))")
    stages = [
        {"_utc": local_to_utc(ts, tz)},
        {"_secs": epoch_seconds("_utc")},
        {"_t": "(_secs / 86400D + 2440587.5D - 2451545D) / 36525D"},
        {
            "_l0": "radians((280.46646D + _t * (36000.76983D + _t * 0.0003032D)) % 360D)",
            "_m": "radians(357.52911D + _t * (35999.05029D - 0.0001537D * _t))",
            "_e": "0.016708634D - _t * (0.000042037D + 0.0000001267D * _t)",
            "_omega": "radians(125.04D - 1934.136D * _t)",
        },
        {
            "_lam": "_l0 + radians(sin(_m) * (1.914602D - _t * (0.004817D + 0.000014D * _t))"
                    " + sin(2D * _m) * (0.019993D - 0.000101D * _t) + sin(3D * _m) * 0.000289D"
                    " - 0.00569D - 0.00478D * sin(_omega))",
            "_eps": "radians(23D + (26D + (21.448D - _t * (46.815D + _t * (0.00059D - _t * 0.001813D))) / 60D) / 60D"
                    " + 0.00256D * cos(_omega))",
        },
        {"_decl": "asin(sin(_eps) * sin(_lam))", "_y": "pow(tan(_eps / 2D), 2D)"},
        {"_ha": f"radians(((_secs % 86400) / 60D + 4D * {longitude!r}D + {equation_of_time}) / 4D - 180D)"},
        {
            "elevation": f"degrees(asin(greatest(-1D, least(1D, sin(_decl) * {sin_lat} + cos(_decl) * {cos_lat} * cos(_ha)))))",
            "azimuth": f"pmod(degrees(atan2(sin(_ha), cos(_ha) * {sin_lat} - tan(_decl) * {cos_lat})) + 180D, 360D)",
        },
    ]
    out = df
    for stage in stages:
        out = out.withColumns({name: F.expr(e) if isinstance(e, str) else e for name, e in stage.items()})
    return out.drop(*[n for stage in stages for n in stage if n.startswith("_")])


def haurwitz_ghi(elevation: Column) -> Column:
    """Clear-sky global horizontal irradiance in W/m2, 0 with the sun at or below the horizon."""
    cosz = F.sin(F.radians(elevation))
    return F.when(elevation.isNull(), None).when(
        cosz > 0, cosz * 1098.0 * F.exp(F.lit(-0.057) / cosz)).otherwise(F.lit(0.0))


def ineichen_ghi(ts: Column, elevation: Column, turbidity: list[float], altitude: float = 0.0) -> Column:
    """Ineichen-Perez clear-sky irradiance from twelve monthly Linke turbidities."""
    if len(turbidity) != 12:
        raise ValueError("twelve monthly turbidities are needed")
    cosz = F.sin(F.radians(elevation))
    linke = F.element_at(F.array(*[F.lit(float(v)) for v in turbidity]), F.month(ts))
    pressure = (1 - 2.25577e-5 * altitude) ** 5.25588
    airmass = F.lit(pressure) / (cosz + F.lit(0.50572) * F.pow(elevation + 6.07995, F.lit(-1.6364)))
    day_angle = (F.dayofyear(ts) - 1) * (2 * math.pi / 365)
    extra = 1366.1 * (F.lit(1.00011) + F.cos(day_angle) * 0.034221 + F.sin(day_angle) * 0.00128
                      + F.cos(day_angle * 2) * 0.000719 + F.sin(day_angle * 2) * 0.000077)
    fh1, fh2 = math.exp(-altitude / 8000), math.exp(-altitude / 1250)
    cg1, cg2 = 5.09e-5 * altitude + 0.868, 3.92e-5 * altitude + 0.0387
    ghi = extra * cosz * cg1 * F.exp(airmass * -cg2 * ((linke - 1) * fh2 + fh1))
    return F.when(elevation.isNull(), None).when(cosz > 0, ghi).otherwise(F.lit(0.0))


def with_clearsky(df: DataFrame, capacity: Column, ts: str = "generation_date",
                  turbidity: list[float] | None = None) -> DataFrame:
    """Add ``ghi`` and ``clearsky_expected_kwh`` to a frame that already has ``elevation``."""
    elevation = F.col("elevation")
    ghi = haurwitz_ghi(elevation) if turbidity is None else ineichen_ghi(F.col(ts), elevation, turbidity)
    return df.withColumn("ghi", ghi).withColumn(
        "clearsky_expected_kwh", F.col("ghi") / 1000 * capacity * config.PERFORMANCE_RATIO)
