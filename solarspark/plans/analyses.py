"""The eight exploratory analyses, each as a set of small result tables.

``raw`` frames may be None where a source is absent; tables that need it are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solarspark import fixed_values as fixed
from solarspark.functions.features import clip_col, valid
from solarspark.operators import audit, profiles, stats
from solarspark.operators.filters import above, daylight, present_columns, within
from solarspark.operators.merge import union_all
from solarspark.operators.sampling import hash_sample

Tables = dict[str, DataFrame]


def missing_values(generation, weather, irradiance, clean) -> Tables:
    """Missing values before and after cleaning."""
    before = {}
    if generation is not None:
        before["generation"] = (generation, generation.columns)
    if weather is not None:
        before["weather"] = (weather, fixed.WEATHER_MEASURES)
    if irradiance is not None:
        before["irradiance"] = (irradiance, ["ghi", "dhi", "dni", "temp_air", "wind_speed"])
    if clean is None:
        return {f"missing_{name}": audit.null_counts_long(df, present_columns(df, columns))
                for name, (df, columns) in before.items()}
    return {"missing": audit.null_compare(before, clean)}


def _distribution(df: DataFrame, column: str, name: str) -> Tables:
    return {f"{name}_histogram": stats.histogram(df, column),
            f"{name}_center": stats.center(df, column)}


def dc_power(generation, clean) -> Tables:
    """Power distribution, raw with zeros and clean above zero."""
    out: Tables = {}
    if generation is not None:
        out |= _distribution(generation, "DC_POWER", "before")
    if clean is not None:
        out |= _distribution(above(clean, "DC_POWER", 0), "DC_POWER", "after")
    return out


def irradiance_levels(irradiance) -> Tables:
    """Irradiance distribution over all hours and over daylight."""
    if irradiance is None:
        return {}
    return (_distribution(irradiance, "ghi", "before")
            | _distribution(daylight(irradiance, "ghi"), "ghi", "after"))


def boxes(generation, irradiance, clean) -> Tables:
    """Box summaries of raw values scaled by their maximum and of engineered features."""
    def summary(df, value, name):
        scaled = df.select(value.alias("v"))
        return stats.box_summary(scaled, "v").select(F.lit(name).alias("variable"), "*")

    def by_max(df, column):
        top = df.agg(F.max(valid(df, column)).alias("top")).scalar()
        return F.try_divide(valid(df, column), top)

    before, after = [], []
    if generation is not None:
        before += [summary(generation, by_max(generation, c), c)
                   for c in ("DC_POWER", "DAILY_YIELD")]
    if irradiance is not None:
        lit_hours = above(irradiance, "ghi", 0)
        before.append(summary(lit_hours, by_max(lit_hours, "ghi"), "ghi"))
    if clean is not None:
        after = [
            summary(within(clean, "EFFICIENCY", 0, 1), F.col("EFFICIENCY"), "EFFICIENCY"),
            summary(clean, clip_col(F.col("SOILING_PROXY"), 0, 1), "SOILING_PROXY"),
            summary(clean, clip_col(F.col("OPTIMAL_TILT") / 90.0, 0, 1), "OPTIMAL_TILT"),
        ]
    return {name: union_all(parts) for name, parts in
            (("before", before), ("after", after)) if parts}


def monthly_tilt(irradiance) -> Tables:
    """Mean tilt and irradiance per UTC month."""
    return {} if irradiance is None else {"monthly": profiles.monthly(irradiance)}


def cities(irradiance) -> Tables:
    """Daylight irradiance per city: ranking, boxes and month table."""
    if irradiance is None:
        return {}
    day = daylight(irradiance, "ghi")
    return {"ranking": profiles.city_ranking(day),
            "boxes": stats.box_summary(day, "ghi", ["CITY"]),
            "city_month": profiles.city_month(day)}


def correlation(irradiance, clean) -> Tables:
    """Correlations of the merged table, or of the irradiance series where there is none."""
    if clean is not None:
        columns = present_columns(clean, fixed.CORRELATION_COLUMNS)
        full = stats.corr_matrix(clean, columns)
    elif irradiance is not None:
        columns = present_columns(irradiance, fixed.IRRADIANCE_CORRELATION_COLUMNS)
        full = stats.corr_matrix(irradiance, columns, min_pairs=2)
    else:
        return {}
    return {"correlation": full, "lower": stats.lower_triangle(full)}


def zenith_fit(irradiance, keys=("DATETIME", "CITY"), n: int = fixed.SCATTER_ROWS) -> Tables:
    """The line of tilt over zenith through all bright hours, and ``n`` of them as points."""
    if irradiance is None:
        return {}
    bright = above(irradiance, "ghi", fixed.SCATTER_GHI)
    sample = hash_sample(bright, list(keys), n)
    fit = stats.linear_fit(bright, "SOLAR_ZENITH_ANGLE", "OPTIMAL_TILT")
    return {"sample": sample.select("CITY", "SOLAR_ZENITH_ANGLE", "ghi", "OPTIMAL_TILT"),
            "fit": fit, "line": stats.fitted_line(fit)}


def run(name: str, generation=None, weather=None, irradiance=None, clean=None) -> Tables:
    """One analysis by name."""
    analyses = {
        "missing_values": lambda: missing_values(generation, weather, irradiance, clean),
        "dc_power": lambda: dc_power(generation, clean),
        "irradiance_levels": lambda: irradiance_levels(irradiance),
        "boxes": lambda: boxes(generation, irradiance, clean),
        "monthly_tilt": lambda: monthly_tilt(irradiance),
        "cities": lambda: cities(irradiance),
        "correlation": lambda: correlation(irradiance, clean),
        "zenith_fit": lambda: zenith_fit(irradiance),
    }
    if name not in analyses:
        raise ValueError(f"no analysis {name!r}; there are {', '.join(analyses)}")
    return analyses[name]()
