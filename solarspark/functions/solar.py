"""Position of the sun from time and place, after the published NOAA/Meeus series.

Good to about a hundredth of a degree for the years 1950 to 2050; angles are
geometric, without refraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solarspark.functions.features import clip_col


def _sin(degrees: Column) -> Column:
    return F.sin(F.radians(degrees))


def _cos(degrees: Column) -> Column:
    return F.cos(F.radians(degrees))


def optimal_tilt(zenith: Column) -> Column:
    """Panel tilt facing the sun: 90 minus the zenith angle clipped to 0..90."""
    return F.lit(90.0) - clip_col(zenith, 0, 90)


def with_solar_position(df: DataFrame, ts: str, latitude: str, longitude: str,
                        zenith: str = "SOLAR_ZENITH_ANGLE",
                        azimuth: str = "SOLAR_AZIMUTH") -> DataFrame:
    """Add zenith and azimuth (degrees, clockwise from north) for a UTC column.

    The series is built in stages of plain columns, so each intermediate angle is
    computed once per row.
    """
    c = {n: F.col(f"__sun_{n}") for n in (
        "day", "t", "mean_long", "anomaly", "ecc", "app_long", "obliq", "decl", "y", "eot",
        "angle",
    )}

    def add(frame, **columns):
        return frame.withColumns({f"__sun_{n}": v for n, v in columns.items()})

    clock = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts).cast("int")
    out = add(df, day=clock / F.lit(86400.0))
    # Julian centuries since noon of 1 January 2000.
    days = F.datediff(F.to_date(ts), F.lit("2000-01-01").cast("date"))
    out = add(out, t=(days + c["day"] - 0.5) / F.lit(36525.0))
    out = add(
        out,
        mean_long=F.pmod(280.46646 + c["t"] * (36000.76983 + c["t"] * 0.0003032), F.lit(360.0)),
        anomaly=357.52911 + c["t"] * (35999.05029 - 0.0001537 * c["t"]),
        ecc=0.016708634 - c["t"] * (0.000042037 + 0.0000001267 * c["t"]),
    )
    center = (
        _sin(c["anomaly"]) * (1.914602 - c["t"] * (0.004817 + 0.000014 * c["t"]))
        + _sin(2.0 * c["anomaly"]) * (0.019993 - 0.000101 * c["t"])
        + _sin(3.0 * c["anomaly"]) * 0.000289
    )
    node = 125.04 - 1934.136 * c["t"]
    arcsec = 21.448 - c["t"] * (46.815 + c["t"] * (0.00059 - c["t"] * 0.001813))
    out = add(
        out,
        app_long=c["mean_long"] + center - 0.00569 - 0.00478 * _sin(node),
        obliq=23.0 + (26.0 + arcsec / 60.0) / 60.0 + 0.00256 * _cos(node),
    )
    half = F.tan(F.radians(c["obliq"] / 2.0))
    out = add(out, decl=F.asin(_sin(c["obliq"]) * _sin(c["app_long"])), y=half * half)
    # Equation of time in minutes.
    out = add(out, eot=4.0 * F.degrees(
        c["y"] * _sin(2.0 * c["mean_long"])
        - 2.0 * c["ecc"] * _sin(c["anomaly"])
        + 4.0 * c["ecc"] * c["y"] * _sin(c["anomaly"]) * _cos(2.0 * c["mean_long"])
        - 0.5 * c["y"] * c["y"] * _sin(4.0 * c["mean_long"])
        - 1.25 * c["ecc"] * c["ecc"] * _sin(2.0 * c["anomaly"])
    ))
    solar_minutes = F.pmod(
        c["day"] * 1440.0 + c["eot"] + 4.0 * F.col(longitude), F.lit(1440.0))
    out = add(out, angle=F.radians(solar_minutes / 4.0 - 180.0))
    lat = F.radians(F.col(latitude))
    cos_zenith = (F.sin(lat) * F.sin(c["decl"])
                  + F.cos(lat) * F.cos(c["decl"]) * F.cos(c["angle"]))
    bearing = F.atan2(
        F.sin(c["angle"]),
        F.cos(c["angle"]) * F.sin(lat) - F.tan(c["decl"]) * F.cos(lat))
    out = out.withColumns({
        zenith: F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cos_zenith)))),
        azimuth: F.pmod(F.degrees(bearing) + 180.0, F.lit(360.0)),
    })
    return out.drop(*[f"__sun_{n}" for n in c])
