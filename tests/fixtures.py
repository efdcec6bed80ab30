"""Small plant and irradiance files for tests."""

from __future__ import annotations

import datetime as dt
import math
import pathlib

UTC = dt.timezone.utc
DAYS = [dt.date(2020, 5, 29), dt.date(2020, 5, 30), dt.date(2020, 5, 31),
        dt.date(2020, 6, 1), dt.date(2020, 6, 2), dt.date(2020, 6, 3)]
IRRADIANCE_HEADER = ["DATETIME", "ghi", "dhi", "dni", "temp_air", "wind_speed", "CITY", "LATITUDE",
                     "LONGITUDE", "YEAR", "SOLAR_ZENITH_ANGLE", "SOLAR_AZIMUTH", "OPTIMAL_TILT"]


def sunlight(local: dt.datetime) -> float:
    """Half sine between 06:00 and 18:00 local time."""
    hour = local.hour + local.minute / 60
    return max(0.0, math.sin(math.pi * (hour - 6) / 12)) if 6 <= hour <= 18 else 0.0


def quarter_hours(day):
    start = dt.datetime.combine(day, dt.time())
    return [start + dt.timedelta(minutes=15 * i) for i in range(96)]


def generation_rows(plant, form):
    rows = []
    for unit in range(2):
        for day in DAYS:
            total = 0.0
            for at in quarter_hours(day):
                dc = 1000 * sunlight(at) * (0.6 if unit else 1.0)
                ac = dc * (0.90 if (unit and day.day % 2) else 0.97)
                total += ac / 4
                rows.append([at.strftime(form), plant, f"inv{plant}_{unit}", round(dc, 4),
                             round(ac, 4), round(total, 4), round(5e6 + total, 4)])
    return rows


def weather_rows(plant, form):
    return [[at.strftime(form), plant, f"sensor{plant}", round(25 + 5 * sunlight(at), 4),
             round(25 + 25 * sunlight(at), 4), round(sunlight(at), 5)]
            for day in DAYS for at in quarter_hours(day)]


def irradiance_rows(city, lat, lon, year, days):
    rows = []
    for day in days:
        for hour in range(24):
            at = dt.datetime.combine(day, dt.time(hour), UTC)
            light = sunlight((at + dt.timedelta(minutes=330)).replace(tzinfo=None))
            zenith = 90 - 80 * light if light else 100
            rows.append([str(at), round(900 * light, 3), round(200 * light, 3),
                         round(600 * light, 3), round(24 + 9 * light, 3),
                         round(3 + math.sin(hour), 3), city, lat, lon, year, round(zenith, 4),
                         180.0, round(90 - min(90, zenith), 4)])
    return rows


def write(path: pathlib.Path, header, rows):
    lines = [",".join(header)] + [",".join("" if v is None else str(v) for v in r) for r in rows]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def write_sources(folder: pathlib.Path) -> dict:
    """Two plants in their two timestamp formats and three irradiance files."""
    gen_header = ["DATE_TIME", "PLANT_ID", "SOURCE_KEY", "DC_POWER", "AC_POWER", "DAILY_YIELD",
                  "TOTAL_YIELD"]
    wx_header = ["DATE_TIME", "PLANT_ID", "SOURCE_KEY", "AMBIENT_TEMPERATURE",
                 "MODULE_TEMPERATURE", "IRRADIATION"]
    first, second = "%d-%m-%Y %H:%M", "%Y-%m-%d %H:%M:%S"
    gen1, gen2 = generation_rows(1, first), generation_rows(2, second)
    gen1 += gen1[:3]
    gen2[5][3] = None
    gen2[6][0] = None
    wx2 = weather_rows(2, second)
    wx2[0][5] = None
    power = folder / "power"
    power.mkdir()
    days = [DAYS[0] - dt.timedelta(days=1), *DAYS]
    for name, city, lat, lon, year in (("Gandikota_2020", "Gandikota", 14.813, 78.286, 2020),
                                       ("Kadapa_2020", "Kadapa", 14.4673, 78.8242, 2020)):
        write(power / f"{name}.csv", IRRADIANCE_HEADER,
              irradiance_rows(city, lat, lon, year, days))
    write(power / "Gandikota_2019.csv", IRRADIANCE_HEADER, irradiance_rows(
        "Gandikota", 14.813, 78.286, 2019, [d.replace(year=2019) for d in days]))
    write(power / "all_combined.csv", IRRADIANCE_HEADER,
          irradiance_rows("Nowhere", 0, 0, 1999, days[:1]))
    return {
        "generation": [write(folder / "gen1.csv", gen_header, gen1),
                       write(folder / "gen2.csv", gen_header, gen2)],
        "weather": [write(folder / "wx1.csv", wx_header, weather_rows(1, first)),
                    write(folder / "wx2.csv", wx_header, wx2)],
        "irradiance": str(power),
        "generation_rows": len(gen1) + len(gen2),
    }
