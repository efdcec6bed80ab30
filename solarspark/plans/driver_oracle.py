"""The SQL twin of each driver query, for an independent engine on the same tables."""

from __future__ import annotations

from solarspark.fixed_values import (
    BASELINE_FEATURES,
    IRRADIANCE_MEASURES,
    LOCATIONS,
    MIN_TOTAL_ROWS,
    PREPROCESSED_COLUMNS,
    WEATHER_MEASURES,
)

LINE = "l_orderkey, l_partkey, l_linenumber"

READINGS = """
    SELECT l_orderkey, l_partkey, l_linenumber, l_shipdate, l_suppkey AS plant_id,
           CASE WHEN l_tax > 0 THEN l_extendedprice ELSE 0.0::DOUBLE END AS dc_power,
           l_extendedprice * (1 - l_discount) AS ac_power, l_quantity AS daily_yield
    FROM lineitem"""

GAPPY = """
    SELECT * EXCLUDE (value),
           CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN 'NaN'::DOUBLE
                ELSE value END AS value
    FROM events"""

# Readings whose value is neither NULL nor NaN.
VALID = f"SELECT * FROM ({GAPPY}) WHERE value IS NOT NULL AND NOT isnan(value)"

UNCLASSED = f"""(
    SELECT * REPLACE (CASE WHEN event_id % 6 > 0 THEN event_type END AS event_type)
    FROM ({VALID}))"""

FLAGGED = """
    SELECT *, CASE WHEN proxy > 0.10::DOUBLE AND efficiency < 0.95::DOUBLE THEN 1 ELSE 0 END
                  ::INTEGER AS cleaning_flag
    FROM (
        SELECT *,
               CASE WHEN plant_mean > 0 THEN CAST(1.0::DOUBLE - l_quantity / plant_mean AS FLOAT)
                    ELSE 0.0::FLOAT END::DOUBLE AS proxy,
               CASE WHEN l_extendedprice > 0
                    THEN CAST(l_extendedprice * (1 - l_discount) / l_extendedprice AS FLOAT)
                    ELSE 0.0::FLOAT END::DOUBLE AS efficiency
        FROM (SELECT *, avg(l_quantity) OVER (PARTITION BY l_suppkey) AS plant_mean
              FROM lineitem))"""

SCORED = """
    SELECT *, CASE WHEN score >= 0.5::DOUBLE THEN 1 ELSE 0 END AS prediction
    FROM (SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
                 (l_discount * 10 + l_tax * 10 + l_quantity / 50) / 3 AS score
          FROM lineitem)"""

CELLS = f"""
    SELECT count(*) FILTER (y = 0 AND prediction = 0) AS tn,
           count(*) FILTER (y = 0 AND prediction = 1) AS fp,
           count(*) FILTER (y = 1 AND prediction = 0) AS fn,
           count(*) FILTER (y = 1 AND prediction = 1) AS tp
    FROM ({SCORED})"""

SHIPPED = """
    SELECT n_name AS "CITY", l_shipdate, l_extendedprice
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"""

CURVE = f"""
    WITH cuts AS (
        SELECT CASE WHEN i = 79 THEN 0.9::DOUBLE
                    ELSE i * ((0.9::DOUBLE - 0.1::DOUBLE) / 79.0::DOUBLE) + 0.1::DOUBLE END AS t
        FROM range(80) r(i)),
    cells AS (
        SELECT t, (count(*) FILTER (y = 1 AND score >= t))::DOUBLE AS tp,
               (count(*) FILTER (y = 0 AND score >= t))::DOUBLE AS fp,
               (count(*) FILTER (y = 1))::DOUBLE AS p
        FROM cuts CROSS JOIN ({SCORED}) GROUP BY t),
    rates AS (
        SELECT t, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS pr,
               CASE WHEN p > 0 THEN tp / p ELSE 0 END AS re
        FROM cells)
    SELECT t, pr, re, CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END AS f
    FROM rates"""

CURVE_OUT = """round(t, 6) AS threshold, round(pr, 6) AS "precision",
           round(re, 6) AS recall, round(f, 6) AS f1"""

SEARCH = """
    SELECT ceil(l_quantity / 10)::INTEGER AS "maxDepth", l_linenumber AS "numTrees",
           avg(l_discount) AS "AUC"
    FROM lineitem GROUP BY ALL"""

CORR_INPUT = """
    SELECT l_quantity AS a, l_extendedprice AS b,
           CASE WHEN l_linenumber IN (3, 4) THEN NULL
                ELSE l_extendedprice * (1 - l_discount) END AS c, 1.5::DOUBLE AS d
    FROM lineitem"""


def _corr(pairs) -> str:
    cells = [f"""
        SELECT '{i}' AS col_i, '{j}' AS col_j, regr_count({i}, {j})::BIGINT AS pairs,
               CASE WHEN min({i}) FILTER ({j} IS NOT NULL) = max({i}) FILTER ({j} IS NOT NULL)
                      OR min({j}) FILTER ({i} IS NOT NULL) = max({j}) FILTER ({i} IS NOT NULL)
                    THEN NULL
                    ELSE round(covar_pop({i}, {j}) / sqrt(
                        var_pop({i}) FILTER ({j} IS NOT NULL)
                        * var_pop({j}) FILTER ({i} IS NOT NULL)), 6) END AS r
        FROM ({CORR_INPUT})""" for i, j in pairs]
    return " UNION ALL ".join(cells)


def _bins(source: str, value: str, bins: int, key: str = "") -> str:
    """Counts per equal-width bin from comparisons with the bin edges."""
    by = f"{key}, " if key else ""
    match = f"b.{key} IS NOT DISTINCT FROM v.{key} AND " if key else ""
    return f"""
    ends AS (SELECT {by}min({value}) AS lo, max({value}) AS hi, count(*) AS n_all
             FROM {source} {f"GROUP BY {key}" if key else ""}),
    edges AS (SELECT {by}(i + 1)::INTEGER AS bin, lo, hi, n_all,
                     i * ((hi - lo) / {bins}::DOUBLE) + lo AS low,
                     CASE WHEN i = {bins - 1} THEN hi
                          ELSE (i + 1) * ((hi - lo) / {bins}::DOUBLE) + lo END AS high
              FROM ends CROSS JOIN range({bins}) r(i)),
    counted AS (SELECT {"b." + key + ", " if key else ""}b.bin, b.low, b.high, b.n_all, b.lo, b.hi,
                       count(v.{value}) AS n
                FROM edges b LEFT JOIN {source} v
                  ON {match}v.{value} >= b.low
                 AND (v.{value} < b.high OR (b.bin = {bins} AND v.{value} <= b.high))
                GROUP BY ALL)"""


def _box(source: str, value: str, key: str = "") -> str:
    by = f"{key}, " if key else ""
    join = f"JOIN q ON v.{key} IS NOT DISTINCT FROM q.{key}" if key else "CROSS JOIN q"
    group = f"GROUP BY {key}" if key else ""
    own = f"v.{key}, " if key else ""
    return f"""
    WITH v AS ({source}),
    q AS (SELECT {by}quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median,
                 quantile_cont({value}, 0.75) AS q3 FROM v {group})
    SELECT {own}count(*) AS n,
           count(*) FILTER ({value} < q1 - 1.5 * (q3 - q1) OR {value} > q3 + 1.5 * (q3 - q1))
               AS outliers,
           round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median,
           round(any_value(q3), 6) AS q3,
           round(min({value}) FILTER ({value} >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low,
           round(max({value}) FILTER ({value} <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high
    FROM v {join} {f"GROUP BY v.{key}" if key else ""}"""


def _places() -> str:
    rows = ", ".join(f"({k}, '{c}', {la}::DOUBLE, {lo}::DOUBLE)"
                     for k, (c, la, lo) in enumerate(LOCATIONS))
    return f"(VALUES {rows}) AS p(k, city, la, lo)"


SOLAR = f"""
    WITH placed AS (
        SELECT event_id, city, radians(la) AS lat, lo,
               (hour(ts) * 3600 + minute(ts) * 60 + floor(second(ts)))::DOUBLE / 86400.0::DOUBLE
                   AS day,
               date_diff('day', DATE '2000-01-01', ts::DATE)::DOUBLE AS days
        FROM events JOIN {_places()} ON user_id % 5 = k),
    century AS (SELECT *, (days + day - 0.5::DOUBLE) / 36525.0::DOUBLE AS t FROM placed),
    series AS (
        SELECT *,
               280.46646::DOUBLE + t * (36000.76983::DOUBLE + t * 0.0003032::DOUBLE)
                   - 360 * floor((280.46646::DOUBLE + t * (36000.76983::DOUBLE
                       + t * 0.0003032::DOUBLE)) / 360) AS l0,
               357.52911::DOUBLE + t * (35999.05029::DOUBLE - 0.0001537::DOUBLE * t) AS m,
               0.016708634::DOUBLE - t * (0.000042037::DOUBLE + 0.0000001267::DOUBLE * t) AS e,
               125.04::DOUBLE - 1934.136::DOUBLE * t AS node
        FROM century),
    sun AS (
        SELECT *,
               l0 + sin(radians(m)) * (1.914602::DOUBLE - t * (0.004817::DOUBLE
                       + 0.000014::DOUBLE * t))
                  + sin(radians(2 * m)) * (0.019993::DOUBLE - 0.000101::DOUBLE * t)
                  + sin(radians(3 * m)) * 0.000289::DOUBLE
                  - 0.00569::DOUBLE - 0.00478::DOUBLE * sin(radians(node)) AS app,
               23 + (26 + (21.448::DOUBLE - t * (46.815::DOUBLE + t * (0.00059::DOUBLE
                       - t * 0.001813::DOUBLE))) / 60) / 60
                  + 0.00256::DOUBLE * cos(radians(node)) AS obliq
        FROM series),
    angles AS (
        SELECT *, asin(sin(radians(obliq)) * sin(radians(app))) AS decl,
               tan(radians(obliq / 2)) * tan(radians(obliq / 2)) AS y
        FROM sun),
    clock AS (
        SELECT *, 4 * degrees(y * sin(radians(2 * l0)) - 2 * e * sin(radians(m))
                   + 4 * e * y * sin(radians(m)) * cos(radians(2 * l0))
                   - 0.5::DOUBLE * y * y * sin(radians(4 * l0))
                   - 1.25::DOUBLE * e * e * sin(radians(2 * m))) + day * 1440 + 4 * lo AS minutes
        FROM angles),
    hours AS (SELECT *, radians((minutes - 1440 * floor(minutes / 1440)) / 4 - 180) AS h
              FROM clock),
    result AS (
        SELECT event_id, city, degrees(acos(sin(lat) * sin(decl) + cos(lat) * cos(decl) * cos(h)))
                   AS zenith,
               degrees(atan2(sin(h), cos(h) * sin(lat) - tan(decl) * cos(lat))) + 180 AS azimuth
        FROM hours)
    SELECT event_id, city AS "CITY", round(zenith, 6) AS zenith,
           round(azimuth - 360 * floor(azimuth / 360), 6) AS azimuth,
           round(90 - least(90, greatest(0, zenith)), 6) AS tilt
    FROM result"""

RAW_LINES = """(SELECT * FROM lineitem UNION ALL
        SELECT * FROM lineitem WHERE l_linenumber = 1 AND l_orderkey % 40 = 0)"""

PREPROCESS = f"""
    WITH gen_raw AS (
        SELECT DISTINCT CASE WHEN l_orderkey % 89 <> 0 THEN l_shipdate END AS ts, l_suppkey::INTEGER AS plant,
               concat_ws('-', l_orderkey, l_partkey, l_linenumber) AS source,
               CASE WHEN l_tax > 0 THEN l_extendedprice END AS dc,
               l_extendedprice * (1 - l_discount) AS ac,
               CASE WHEN l_discount > 0 THEN l_quantity END AS dy, l_quantity AS ty, l_linenumber
        FROM {RAW_LINES} WHERE l_orderkey % 97 <> 0),
    gen AS (SELECT ts, plant, source, coalesce(dc, avg(dc) OVER ()) AS dc, ac,
                   coalesce(dy, avg(dy) OVER ()) AS dy, ty FROM gen_raw),
    feat AS (
        SELECT *, CASE WHEN dc > 0 THEN CAST(ac / dc AS FLOAT) ELSE 0::FLOAT END::DOUBLE AS eff,
               CASE WHEN pm > 0 THEN CAST(1.0::DOUBLE - dy / pm AS FLOAT) ELSE 0::FLOAT END
                   ::DOUBLE AS proxy
        FROM (SELECT *, avg(dy) OVER (PARTITION BY plant) AS pm FROM gen)),
    wx_raw AS (
        SELECT o_orderdate AS ts, o_custkey::INTEGER AS plant, avg(o_totalprice) AS irr,
               min(o_totalprice) AS amb,
               CASE WHEN o_custkey % 3 > 0 THEN max(o_totalprice) END AS module
        FROM orders GROUP BY o_orderdate, o_custkey),
    wx AS (SELECT ts, plant, irr, amb, coalesce(module, avg(module) OVER ()) AS module
           FROM wx_raw),
    ev AS (
        SELECT ts + INTERVAL 330 MINUTE AS ts, event_type, value,
               coalesce(CASE WHEN event_id % 9 > 0 THEN value + 1 END,
                        avg(CASE WHEN event_id % 9 > 0 THEN value + 1 END) OVER ()) AS temp,
               user_id::DOUBLE AS wind, CAST(least(90, greatest(0, 90 - value)) AS FLOAT) AS tilt
        FROM events),
    hourly AS (
        SELECT month(ts) AS mo, day(ts) AS da, hour(ts) AS ho, avg(value) AS v, avg(temp) AS temp,
               avg(value / 2) AS dhi, avg(value * 2) AS dni, avg(wind) AS wind, avg(tilt::DOUBLE) AS tilt
        FROM ev WHERE event_type = 'view' GROUP BY ALL)
    SELECT month(f.ts)::INTEGER AS "MONTH", strftime(f.ts, '%Y-%m-%d %H:%M:%S') AS "DATETIME",
           f.plant AS "PLANT_ID", f.source AS "SOURCE_KEY", round(dc, 6) AS "DC_POWER",
           round(ac, 6) AS "AC_POWER", round(dy, 6) AS "DAILY_YIELD", round(ty, 6) AS "TOTAL_YIELD",
           round(eff, 6) AS "EFFICIENCY", round(proxy, 6) AS "SOILING_PROXY",
           CASE WHEN proxy > 0.10::DOUBLE AND eff < 0.95::DOUBLE THEN 1 ELSE 0 END::INTEGER
               AS "CLEANING_FLAG",
           round(irr, 6) AS "IRRADIATION", round(amb, 6) AS "AMBIENT_TEMPERATURE",
           round(module, 6) AS "MODULE_TEMPERATURE", round(h.v, 9) AS "GHI",
           round(h.dhi, 9) AS "DHI", round(h.dni, 9) AS "DNI",
           round(h.temp, 9) AS "AIR_TEMPERATURE", round(h.wind, 9) AS "WIND_SPEED",
           round(h.v, 9) AS "SOLAR_ZENITH_ANGLE", round(h.tilt, 9) AS "OPTIMAL_TILT",
           CASE WHEN h.v IS NOT NULL THEN 14.5::DOUBLE END AS "LATITUDE",
           CASE WHEN h.v IS NOT NULL THEN 78.25::DOUBLE END AS "LONGITUDE"
    FROM feat f LEFT JOIN wx USING (ts, plant)
    LEFT JOIN hourly h ON month(f.ts) = mo AND day(f.ts) = da AND hour(f.ts) = ho"""

GENERATION = f"""
    SELECT CASE WHEN l_orderkey % 97 = 0 THEN NULL
                WHEN l_orderkey % 89 = 0 THEN 'not a time'
                WHEN l_linenumber % 2 = 0 THEN strftime(l_shipdate, '%d-%m-%Y %H:%M')
                ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS "DATE_TIME",
           l_suppkey::INTEGER AS "PLANT_ID",
           concat_ws('-', l_orderkey, l_partkey, l_linenumber) AS "SOURCE_KEY",
           CASE WHEN l_tax > 0 THEN l_extendedprice END AS "DC_POWER",
           l_quantity AS "TOTAL_YIELD", l_discount
    FROM {RAW_LINES}"""

# The cleaned readings of the same query, before weather and irradiance join them.
PREPROCESS_GENERATION = PREPROCESS[:PREPROCESS.index("    feat AS (")].rstrip().rstrip(",") + " SELECT * FROM gen"

MERGED = PREPROCESS.replace("round(eff, 6)", "eff").replace("round(proxy, 6)", "proxy")

PREPROCESSED_COLUMNS_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS item, count(*) FILTER ("{c}" IS NULL) AS n FROM merged"""
    for c in PREPROCESSED_COLUMNS)

MERGED_PAIRS = [("AC_POWER", "DC_POWER"), ("GHI", "DC_POWER"), ("GHI", "AC_POWER"),
                ("EFFICIENCY", "DC_POWER"), ("EFFICIENCY", "AC_POWER"), ("EFFICIENCY", "GHI"),
                ("SOILING_PROXY", "DC_POWER"), ("SOILING_PROXY", "AC_POWER"),
                ("SOILING_PROXY", "GHI"), ("SOILING_PROXY", "EFFICIENCY")]

AUDITED = {
    "generation": (f"({GENERATION})", {
        "DATE_TIME": '"DATE_TIME" IS NULL', "PLANT_ID": "false", "SOURCE_KEY": "false",
        "DC_POWER": '"DC_POWER" IS NULL', "AC_POWER": "false", "DAILY_YIELD": "l_discount <= 0",
        "TOTAL_YIELD": "false"}),
    "weather": ("(SELECT o_orderdate, o_custkey FROM orders GROUP BY o_orderdate, o_custkey)", {
        "DATE_TIME": "false", "PLANT_ID": "false", "SOURCE_KEY": "false",
        "AMBIENT_TEMPERATURE": "false", "MODULE_TEMPERATURE": "o_custkey % 3 = 0",
        "IRRADIATION": "false"}),
    "irradiance": ("events", {
        "DATETIME": "false", "ghi": "false", "dhi": "false", "dni": "false",
        "temp_air": "event_id % 9 = 0", "wind_speed": "false", "CITY": "false",
        "SERIAL": "false", "LATITUDE": "false", "LONGITUDE": "false", "YEAR": "false",
        "SOLAR_ZENITH_ANGLE": "false", "SOLAR_AZIMUTH": "false", "OPTIMAL_TILT": "false"}),
}

DESCRIBED = {
    "generation": (f"""(
        SELECT CASE WHEN l_tax > 0 THEN l_extendedprice END AS "DC_POWER",
               l_extendedprice * (1 - l_discount) AS "AC_POWER",
               CASE WHEN l_discount > 0 THEN l_quantity END AS "DAILY_YIELD" FROM {RAW_LINES})""",
                   ["DC_POWER", "AC_POWER", "DAILY_YIELD"]),
    "weather": ("""(SELECT avg(o_totalprice) AS "IRRADIATION" FROM orders GROUP BY o_orderdate, o_custkey)""",
                ["IRRADIATION"]),
    "irradiance": ("""(
        SELECT value AS ghi, value / 2 AS dhi, value * 2 AS dni,
               CASE WHEN event_id % 9 > 0 THEN value + 1 END AS temp_air, user_id::DOUBLE AS wind_speed,
               value AS "SOLAR_ZENITH_ANGLE", 90 - value AS "OPTIMAL_TILT" FROM events)""", IRRADIANCE_MEASURES),
}

STUMP_FEATURES = ["l_discount", "l_tax", "l_linenumber"]
OTHER_FEATURES = ["l_tax", "l_linenumber"]


def _stump(source: str, features: list[str], y: str, weight: str = "1.0::DOUBLE") -> str:
    """The split of greatest gain over all features and midpoints: f, t, left and right mean.

    For classes 0 and 1 the gain in Gini impurity is largest where that in variance is.
    """
    long = " UNION ALL ".join(
        f"SELECT '{f}' AS f, {f}::DOUBLE AS x, {y} AS y, {weight} AS w FROM {source}" for f in features)
    return f"""(
        SELECT f, (x + following) / 2 AS t, sl / wl AS low, (sa - sl) / (wa - wl) AS high
        FROM (SELECT f, x, lead(x) OVER by_value AS following,
                     sum(w) OVER by_value AS wl, sum(s) OVER by_value AS sl,
                     sum(w) OVER (PARTITION BY f) AS wa, sum(s) OVER (PARTITION BY f) AS sa
              FROM (SELECT f, x, sum(w) AS w, sum(w * y) AS s FROM ({long}) GROUP BY f, x)
              WINDOW by_value AS (PARTITION BY f ORDER BY x))
        WHERE following IS NOT NULL
        ORDER BY sl * sl / wl + (sa - sl) * (sa - sl) / (wa - wl) DESC, f LIMIT 1)"""


def _side(features: list[str]) -> str:
    """The value of a split's feature in a row."""
    return "CASE f " + " ".join(f"WHEN '{f}' THEN {f}::DOUBLE" for f in features) + " END"


def _gains(stump: str) -> str:
    rows = ", ".join(f"('{f}')" for f in STUMP_FEATURES)
    return f"""
    SELECT name AS "Feature", CASE WHEN name = f THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "Importance"
    FROM {stump} CROSS JOIN (VALUES {rows}) AS n(name)"""


MONTHS = f"""
    train AS (SELECT * FROM ({FLAGGED}) WHERE month(l_shipdate) = 5),
    test AS (SELECT * FROM ({FLAGGED}) WHERE month(l_shipdate) = 6),
    weighted AS (SELECT *, CASE WHEN cleaning_flag = 1 THEN (
                     SELECT count(*) FILTER (cleaning_flag = 0)::DOUBLE / count(*) FILTER (cleaning_flag = 1)
                     FROM train) ELSE 1.0::DOUBLE END AS weight FROM train)"""

WEIGHTED_STUMP = _stump("weighted", STUMP_FEATURES, "cleaning_flag", "weight")


def _fold_errors(fold: int) -> str:
    """Root mean square errors of a constant and of a stump on one fold."""
    rest, own = f"(SELECT * FROM train WHERE l_orderkey % 2 <> {fold})", f"train WHERE l_orderkey % 2 = {fold}"
    return f"""
        SELECT 0 AS depth, sqrt(avg(pow(l_extendedprice - m, 2))) AS rmse
        FROM (SELECT l_extendedprice, (SELECT avg(l_extendedprice) FROM {rest}) AS m FROM {own})
        UNION ALL
        SELECT 1, sqrt(avg(pow(l_extendedprice - CASE WHEN {_side(STUMP_FEATURES)} <= t THEN low ELSE high END, 2)))
        FROM (SELECT * FROM {own}) CROSS JOIN {_stump(rest, STUMP_FEATURES, "l_extendedprice")}"""


def _rival(name: str, features: list[str]) -> str:
    return f"""
        SELECT '{name}' AS algorithm, sqrt(avg(pow(e, 2))) AS rmse,
               1 - sum(pow(e, 2)) / (var_pop(l_extendedprice) * count(*)) AS r2
        FROM (SELECT l_extendedprice, l_extendedprice
                     - CASE WHEN {_side(features)} <= t THEN low ELSE high END AS e
              FROM test CROSS JOIN {_stump("train", features, "l_extendedprice")})"""


RIVALS = f"""
    WITH {MONTHS}, rivals AS ({_rival("RF Regressor", OTHER_FEATURES)}
        UNION ALL {_rival("GBT Regressor", STUMP_FEATURES)})"""

BRIGHT = "(SELECT * FROM events WHERE value > 10)"

MODEL_SOURCE = f"""
    SELECT month(l_shipdate) AS mo, cleaning_flag AS y, l_extendedprice AS p, efficiency AS "EFFICIENCY",
           20.0 + l_orderkey % 7 AS "GHI", l_linenumber AS "DNI", round(l_tax * 100) AS "DHI",
           l_partkey % 5 AS "AIR_TEMPERATURE", round(l_discount * 100) AS "MODULE_TEMPERATURE",
           round(l_discount * 100) - l_partkey % 3 AS "TEMP_DIFF", ceil(l_quantity / 5) AS "IRRADIATION",
           l_orderkey % 3 AS "WIND_SPEED", l_orderkey % 4 AS "SOLAR_ZENITH_ANGLE"
    FROM ({FLAGGED})"""

# Features that vary; the others are constant at midnight or in a month and are never split on.
VARIED = {"baseline": ["GHI", "AIR_TEMPERATURE", "SOLAR_ZENITH_ANGLE", "EFFICIENCY"],
          "classifier": ["GHI", "DNI", "DHI", "AIR_TEMPERATURE", "MODULE_TEMPERATURE", "WIND_SPEED",
                         "SOLAR_ZENITH_ANGLE", "TEMP_DIFF"],
          "regressor": ["IRRADIATION", "GHI", "MODULE_TEMPERATURE", "AIR_TEMPERATURE", "SOLAR_ZENITH_ANGLE",
                        "TEMP_DIFF"]}

MODEL_SIDES = f"""
    rows AS ({MODEL_SOURCE}),
    train AS (SELECT * FROM rows WHERE mo = 5), test AS (SELECT * FROM rows WHERE mo = 6),
    weighted AS (SELECT *, CASE WHEN y = 1 THEN (
        SELECT count(*) FILTER (y = 0)::DOUBLE / count(*) FILTER (y = 1) FROM train) ELSE 1.0::DOUBLE END AS w
        FROM train)"""


def _class_cells(features: list[str], stump: str, cut: str) -> str:
    """Cells and area of a stump whose leaves have two scores, positive above ``cut``."""
    return f"""(
        SELECT *, 0.5::DOUBLE + 0.5::DOUBLE * (tp2 / (tp + fn) - fp2 / (tn + fp)) AS auc
        FROM (SELECT (count(*) FILTER (y = 0 AND s <= {cut}))::DOUBLE AS tn,
                     (count(*) FILTER (y = 0 AND s > {cut}))::DOUBLE AS fp,
                     (count(*) FILTER (y = 1 AND s <= {cut}))::DOUBLE AS fn,
                     (count(*) FILTER (y = 1 AND s > {cut}))::DOUBLE AS tp,
                     (count(*) FILTER (y = 0 AND s = top))::DOUBLE AS fp2,
                     (count(*) FILTER (y = 1 AND s = top))::DOUBLE AS tp2
              FROM (SELECT y, CASE WHEN {_side(features)} <= t THEN low ELSE high END AS s,
                           greatest(low, high) AS top FROM test CROSS JOIN {stump})))"""


def _weighted_f1() -> str:
    """F1 of both classes, weighted by their rows."""
    return """(tn + fp) / (tn + fp + fn + tp) * 2 * tn / (2 * tn + fp + fn)
              + (tp + fn) / (tn + fp + fn + tp) * 2 * tp / (2 * tp + fp + fn)"""


def _power_errors(name: str) -> str:
    return f"""
        SELECT '{name}' AS algorithm, sqrt(avg(e * e)) AS rmse,
               1 - sum(e * e) / (var_pop(p) * count(*)) AS r2
        FROM (SELECT p, p - CASE WHEN {_side(VARIED["regressor"])} <= t THEN low ELSE high END AS e
              FROM test CROSS JOIN {_stump("train", VARIED["regressor"], "p")})"""


FOREST = _stump("weighted", VARIED["classifier"], "y", "w")
BOOSTED = _stump("train", VARIED["classifier"], "2.0::DOUBLE * y - 1")

ORACLE: dict[str, str] = {
    "dq_union_dedupe": "SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem)",
    "dq_union_missing": """
        SELECT event_id, ts, value FROM events
        UNION ALL BY NAME SELECT event_type, event_id FROM events""",
    "dq_missing_partitions": """
        SELECT c_custkey AS "CITY", y::INTEGER AS "YEAR"
        FROM customer CROSS JOIN range(1995, 2002) r(y)
        WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
                          AND year(o_orderdate) = y)""",
    "dq_location_enrich": """
        SELECT s_suppkey, s_name, n_name AS "NATION", r_name AS "REGION"
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "dq_weather_join": """
        WITH weather AS (
            SELECT date_trunc('month', o_orderdate) AS dt, o_custkey AS plant,
                   avg(o_totalprice) AS irr FROM orders GROUP BY ALL)
        SELECT date_trunc('month', l_shipdate)::TIMESTAMP AS "DATETIME", l_suppkey AS "PLANT_ID",
               l_orderkey AS "SOURCE_KEY", l_linenumber, round(irr, 6) AS "IRRADIATION"
        FROM lineitem LEFT JOIN weather
          ON date_trunc('month', l_shipdate) = dt AND l_suppkey = plant""",
    "dq_hourly_join": """
        WITH ev AS (SELECT *, ts + INTERVAL 330 MINUTE AS lt FROM events),
        hourly AS (SELECT month(lt) AS mo, day(lt) AS da, hour(lt) AS ho, avg(value) AS ghi,
                          avg(user_id) AS wind
                   FROM ev WHERE event_type = 'view' GROUP BY ALL)
        SELECT event_id, event_type, month(lt)::INTEGER AS "MONTH", round(ghi, 6) AS "GHI",
               round(wind, 6) AS "WIND_SPEED"
        FROM ev LEFT JOIN hourly ON month(lt) = mo AND day(lt) = da AND hour(lt) = ho""",
    "dq_group_mean": f"""
        SELECT {LINE}, plant_id,
               round(avg(CASE WHEN l_linenumber <> 2 THEN daily_yield END)
                     OVER (PARTITION BY plant_id), 6) AS plant_mean
        FROM ({READINGS})""",
    "dq_repeated_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS copies
        FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "dq_null_audit": f"""
        SELECT * FROM (
            SELECT 'before' AS phase, 'events' AS source, 'event_id' AS "column",
                   count(*) FILTER (event_id IS NULL) AS missing FROM ({GAPPY})
            UNION ALL SELECT 'before', 'events', 'value',
                   count(*) FILTER (value IS NULL OR isnan(value)) FROM ({GAPPY})
            UNION ALL SELECT 'before', 'events', 'props', count(*) FILTER (props IS NULL)
                   FROM ({GAPPY})
            UNION ALL SELECT 'before', 'orders', 'o_orderkey',
                   count(*) FILTER (o_orderkey IS NULL) FROM orders
            UNION ALL SELECT 'before', 'orders', 'o_totalprice',
                   count(*) FILTER (o_orderkey % 10 = 0) FROM orders
            UNION ALL SELECT 'after', 'merged', 'props',
                   count(*) FILTER (event_id % 5 = 0) FROM events)""",
    "dq_null_audit_plain": f"""
        SELECT 'value' AS "column", count(*) FILTER (value IS NULL) AS missing FROM ({GAPPY})
        UNION ALL SELECT 'user_id', count(*) FILTER (user_id IS NULL) FROM ({GAPPY})""",
    "dq_dup_audit": " UNION ALL ".join(f"""
        SELECT '{name}' AS source, sum(c)::BIGINT AS total, count(*) AS distinct_rows,
               (sum(c) - count(*))::BIGINT AS duplicates,
               round((sum(c) - count(*)) * 100.0::DOUBLE / sum(c), 6) AS percent
        FROM (SELECT count(*) AS c FROM {name} GROUP BY {keys})""" for name, keys in (
            ("lineitem", "l_suppkey, l_quantity, l_returnflag"),
            ("orders", "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
                       "o_orderpriority"),
            ("events", "user_id, event_type"))),
    "dq_describe": " UNION ALL ".join(f"""
        SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
               round(stddev_samp({c}), 6) AS stddev, min({c}) AS min, max({c}) AS max
        FROM {t}""" for c, t in (
            ("l_quantity", "lineitem"), ("l_extendedprice", "lineitem"),
            ("l_discount", "lineitem"), ("l_tax", "lineitem"), ("value", f"({VALID})"))),
    "dq_volume": """
        WITH c AS (SELECT 'lineitem' AS source, count(*) AS n FROM lineitem
                   UNION ALL SELECT 'orders', count(*) FROM orders
                   UNION ALL SELECT 'events', count(*) FROM events)
        SELECT source, n AS rows, NULL::BOOLEAN AS requirement_met FROM c
        UNION ALL SELECT 'TOTAL', sum(n)::BIGINT, sum(n) >= 500000 FROM c""",
    "dq_flag_distribution": f"""
        SELECT cleaning_flag, count(*) AS count FROM ({FLAGGED}) GROUP BY cleaning_flag""",
    "dq_mean_fill": f"""
        SELECT event_id, round(CASE WHEN value IS NULL OR isnan(value)
                                    THEN (SELECT avg(value) FROM ({VALID})) ELSE value END, 6)
                             AS value
        FROM ({GAPPY})""",
    "dq_efficiency": f"""
        SELECT {LINE}, CASE WHEN dc_power > 0 THEN CAST(ac_power / dc_power AS FLOAT)
                            ELSE 0.0::FLOAT END::DOUBLE AS efficiency
        FROM ({READINGS})""",
    "dq_soiling_proxy": f"SELECT {LINE}, proxy, cleaning_flag FROM ({FLAGGED})",
    "dq_parse_two_formats": """
        WITH logged AS (
            SELECT event_id, CASE WHEN event_id % 13 = 0 THEN 'not a time'
                                  WHEN event_id % 2 = 0 THEN strftime(ts, '%d-%m-%Y %H:%M')
                                  ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS txt
            FROM events)
        SELECT event_id, strftime(coalesce(try_strptime(txt, '%d-%m-%Y %H:%M'),
                                           try_strptime(txt, '%Y-%m-%d %H:%M:%S')),
                                  '%Y-%m-%d %H:%M:%S') AS datetime
        FROM logged""",
    "dq_unparseable": """
        SELECT count(*) FILTER (event_id % 13 = 0) AS unparseable FROM events""",
    "dq_to_local": """
        WITH ev AS (SELECT event_id, ts + INTERVAL 330 MINUTE AS ts FROM events)
        SELECT event_id, ts, month(ts)::INTEGER AS "MONTH", day(ts)::INTEGER AS "DAY",
               hour(ts)::INTEGER AS "HOUR" FROM ev""",
    "dq_clip": f"""
        SELECT event_id, CASE WHEN value IS NOT NULL AND NOT isnan(value)
                              THEN greatest(10.0::DOUBLE, least(90.0::DOUBLE, value)) END
                             AS clipped
        FROM ({GAPPY})""",
    "dq_max_scale": f"""
        SELECT {LINE}, round(l_extendedprice / max(l_extendedprice) OVER (), 6) AS price,
               round(l_quantity / max(l_quantity) OVER (), 6) AS quantity
        FROM lineitem""",
    "dq_cyclic": """
        SELECT event_id, hour(ts)::DOUBLE AS "HOUR", month(ts)::DOUBLE AS "MONTH_NUM",
               round(sin(hour(ts) * 2 * pi() / 24), 6) AS "HOUR_SIN",
               round(cos(hour(ts) * 2 * pi() / 24), 6) AS "HOUR_COS",
               round(sin(month(ts) * 2 * pi() / 12), 6) AS "MONTH_SIN",
               round(cos(month(ts) * 2 * pi() / 12), 6) AS "MONTH_COS"
        FROM events""",
    "dq_ratio_diff": f"""
        SELECT {LINE}, round(CASE WHEN dc_power > 0 THEN ac_power / dc_power ELSE 0 END, 6)
                           AS "DC_PER_GHI",
               round(dc_power - ac_power, 6) AS "TEMP_DIFF"
        FROM ({READINGS})""",
    "dq_daylight": f"SELECT event_id, value FROM ({VALID}) WHERE value > 10 AND value <= 400",
    "dq_solar_position": SOLAR,
    "dq_hourly_profile": """
        WITH ev AS (SELECT ts + INTERVAL 330 MINUTE AS ts, value FROM events)
        SELECT month(ts)::INTEGER AS "MONTH", day(ts)::INTEGER AS "DAY",
               hour(ts)::INTEGER AS "HOUR", round(avg(value), 6) AS value
        FROM ev GROUP BY 1, 2, 3""",
    "dq_monthly_profile": f"""
        WITH means AS (
            SELECT month(ts) AS m,
                   avg(CASE WHEN NOT isnan(value) THEN value END) AS v, avg(user_id) AS u
            FROM ({GAPPY}) GROUP BY 1)
        SELECT i::INTEGER AS month, strftime(make_date(2000, i::INTEGER, 1), '%b') AS label,
               round(v, 6) AS value, round(u, 6) AS users
        FROM range(1, 13) r(i) LEFT JOIN means ON m = i""",
    "dq_city_median": f"""
        SELECT "CITY", count(*) AS n, round(median(l_extendedprice), 6) AS median
        FROM ({SHIPPED}) GROUP BY 1""",
    "dq_city_month_pivot": f"""
        SELECT "CITY", {", ".join(
            f'round(avg(l_extendedprice) FILTER (month(l_shipdate) = {m}), 6) AS m{m}'
            for m in range(1, 13))}
        FROM ({SHIPPED}) GROUP BY 1""",
    "dq_corr_matrix": _corr([(i, j) for i in "abcd" for j in "abcd"]),
    "dq_corr_lower": f"SELECT col_i, col_j, r FROM ({_corr([('b', 'a'), ('c', 'a'), ('c', 'b')])})",
    "dq_histogram": f"""
        WITH {_bins("lineitem", "l_extendedprice", 80)}
        SELECT bin, round(low, 6) AS low, round(high, 6) AS high, n AS count FROM counted""",
    "dq_density_by_class": f"""
        WITH {_bins(UNCLASSED, "value", 50, "event_type")}
        SELECT event_type, bin, round(low, 6) AS low, round(high, 6) AS high,
               round(n / (n_all * ((hi - lo) / 50.0::DOUBLE)), 6) AS density
        FROM counted""",
    "dq_center_zero_share": """
        SELECT count(l_discount) AS n, count(*) FILTER (l_discount = 0) AS zeros,
               round(avg(l_discount), 6) AS mean, round(median(l_discount), 6) AS median,
               round(avg((l_discount = 0)::INTEGER), 6) AS zero_share
        FROM lineitem""",
    "dq_box_summary": _box(f"SELECT * FROM {UNCLASSED}", "value", "event_type"),
    "dq_box_summary_all": _box("SELECT * FROM lineitem", "l_extendedprice"),
    "dq_linear_fit": """
        SELECT count(*) AS n, min(l_quantity) AS x_min, max(l_quantity) AS x_max,
               round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
               round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept
        FROM lineitem""",
    "dq_fitted_line": """
        WITH fit AS (SELECT regr_slope(l_extendedprice, l_quantity) AS s,
                            regr_intercept(l_extendedprice, l_quantity) AS c,
                            min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem),
        points AS (SELECT i::INTEGER AS point, lo + i * ((hi - lo) / 99.0::DOUBLE) AS x, s, c
                   FROM fit CROSS JOIN range(100) r(i))
        SELECT point, round(x, 6) AS x, round(c + s * x, 3) AS y FROM points""",
    "dq_vif": """
        WITH c AS (SELECT corr(l_extendedprice, l_extendedprice * (1 - l_discount)) AS r
                   FROM lineitem)
        SELECT unnest(['dc', 'ac', 'twin', 'same']) AS feature,
               unnest(['inf'::DOUBLE, round(1 / (1 - r * r), 4), 'inf'::DOUBLE, NULL]) AS vif
        FROM c""",
    "dq_topn_chrono": """
        SELECT event_id, ts, value FROM events ORDER BY ts, event_id LIMIT 500""",
    "dq_hash_sample": """
        SELECT event_id, event_type FROM events
        ORDER BY md5(event_id::VARCHAR || ':42'), event_id LIMIT 50""",
    "dq_temporal_split": """
        WITH o AS (SELECT CASE month(o_orderdate) WHEN 5 THEN 'train' ELSE 'test' END AS side,
                          o_orderstatus = 'F' AS y
                   FROM orders WHERE month(o_orderdate) IN (5, 6))
        SELECT side, count(*) AS n, count(*) FILTER (y) AS positives,
               count(*) FILTER (NOT y) AS negatives,
               round(count(*) FILTER (y) / count(*), 6) AS positive_rate,
               round(count(*) FILTER (NOT y) / count(*) FILTER (y), 6) AS ratio
        FROM o GROUP BY side""",
    "dq_class_weight": f"""
        SELECT {LINE}, (l_returnflag = 'R')::INTEGER AS y,
               round(CASE WHEN l_returnflag = 'R'
                          THEN (SELECT count(*) FILTER (l_returnflag <> 'R')::DOUBLE
                                       / count(*) FILTER (l_returnflag = 'R') FROM lineitem)
                          ELSE 1.0::DOUBLE END, 6) AS sample_weight
        FROM lineitem""",
    "dq_confusion": f"""
        SELECT tn, fp, fn, tp, round(tp / (tp + fp), 6) AS "precision",
               round(tp / (tp + fn), 6) AS recall FROM ({CELLS})""",
    "dq_class_metrics": f"""
        WITH s AS (SELECT *, tp + fn AS p, tn + fp AS q, tn + fp + fn + tp AS n,
                          tp / (tp + fp) AS p1, tn / (tn + fn) AS p0,
                          tp / (tp + fn) AS r1, tn / (tn + fp) AS r0 FROM ({CELLS}))
        SELECT round((tp + tn) / n, 6) AS accuracy,
               round((2 * p1 * r1 / (p1 + r1) * p + 2 * p0 * r0 / (p0 + r0) * q) / n, 6) AS f1,
               round((p1 * p + p0 * q) / n, 6) AS weighted_precision,
               round((r1 * p + r0 * q) / n, 6) AS weighted_recall
        FROM s""",
    "dq_threshold_curve": f"SELECT {CURVE_OUT} FROM ({CURVE})",
    "dq_best_threshold": f"SELECT {CURVE_OUT} FROM ({CURVE}) ORDER BY f DESC, t LIMIT 1",
    "dq_auc": f"""
        WITH ranked AS (
            SELECT y, avg(rn) OVER (PARTITION BY score) AS rank
            FROM (SELECT y, score, row_number() OVER (ORDER BY score) AS rn FROM ({SCORED}))),
        sums AS (SELECT (sum(rank) FILTER (y = 1))::DOUBLE AS s,
                        (count(*) FILTER (y = 1))::DOUBLE AS p,
                        (count(*) FILTER (y = 0))::DOUBLE AS n FROM ranked)
        SELECT round((s - p * (p + 1) / 2) / (p * n), 6) AS auc FROM sums""",
    "dq_reg_metrics": """
        WITH e AS (SELECT l_extendedprice AS y, l_extendedprice - l_quantity * 2000 AS err
                   FROM lineitem)
        SELECT count(*) AS n, round(sqrt(avg(err * err)), 6) AS rmse,
               round(1 - sum(err * err) / (var_pop(y) * count(*)), 6) AS r2
        FROM e""",
    "dq_grid_table": f"""
        SELECT "maxDepth", {", ".join(
            f'round(max("AUC") FILTER ("numTrees" = {t}), 6) AS t{t}' for t in (1, 2, 3, 4))}
        FROM ({SEARCH}) GROUP BY 1""",
    "dq_grid_best": f"""
        SELECT "maxDepth", round(max("AUC"), 6) AS "AUC" FROM ({SEARCH}) GROUP BY 1""",
    "dq_grid_slice": f"""
        SELECT "maxDepth", "numTrees", round("AUC", 6) AS "AUC"
        FROM ({SEARCH}) WHERE "maxDepth" = 2""",
    "dq_preprocess": PREPROCESS,
    "dq_csv_scan": f"""
        SELECT "DATE_TIME", "PLANT_ID", "SOURCE_KEY", "DC_POWER", "TOTAL_YIELD"
        FROM ({GENERATION})""",
    "dq_landing_zone": """
        SELECT event_type AS "CITY", year(ts)::INTEGER AS "YEAR", count(*) AS n,
               min(value) AS lowest, max(value) AS highest
        FROM events GROUP BY ALL""",
    "dq_job_audit": " UNION ALL ".join(f"""
        SELECT '{source}' AS source, '{column}' AS "column",
               count(*) FILTER ({gap}) AS missing, count(*) AS total,
               count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {relation})) AS duplicates
        FROM {relation}""" for source, (relation, gaps) in AUDITED.items()
        for column, gap in gaps.items()),
    "dq_job_validation": f"""
        WITH merged AS ({MERGED})
        {PREPROCESSED_COLUMNS_SQL}
        UNION ALL SELECT 'flag ' || "CLEANING_FLAG", count(*) FROM merged GROUP BY 1""",
    "dq_merged_correlation": f"WITH merged AS ({MERGED}) " + " UNION ALL ".join(f"""
        SELECT '{i}' AS col_i, '{j}' AS col_j, count(*) AS pairs, round(corr("{i}", "{j}"), 6) AS r
        FROM merged WHERE "{i}" IS NOT NULL AND "{j}" IS NOT NULL""" for i, j in MERGED_PAIRS),
    "dq_zenith_fit": """
        WITH sample AS (
            SELECT value AS x, 90 - value AS y FROM events WHERE value > 50)
        SELECT count(*) AS n, round(regr_slope(y, x), 6) AS slope,
               round(regr_intercept(y, x), 6) AS intercept
        FROM sample""",
    "dq_rf_importance": f"WITH {MONTHS} {_gains(WEIGHTED_STUMP)}",
    # The constant forest has an area of one half; the stump wins if it has more.
    "dq_best_params": f"""
        WITH {MONTHS}, folds AS ({" UNION ALL ".join(f"""
            SELECT y, {_side(STUMP_FEATURES)} <= t AS here, low > high AS up, {k} AS fold
            FROM (SELECT *, cleaning_flag AS y FROM train WHERE l_orderkey % 2 = {k}) CROSS JOIN {_stump(
                f"(SELECT * FROM weighted WHERE l_orderkey % 2 <> {k})", STUMP_FEATURES, "cleaning_flag", "weight")}"""
            for k in (0, 1))}),
        areas AS (SELECT fold, 0.5 + 0.5 * (
                      count(*) FILTER (y = 1 AND here = up)::DOUBLE / count(*) FILTER (y = 1)
                      - count(*) FILTER (y = 0 AND here = up)::DOUBLE / count(*) FILTER (y = 0)) AS area
                  FROM folds GROUP BY fold)
        SELECT 'maxDepth' AS parameter, CASE WHEN avg(area) > 0.5 THEN '1' ELSE '0' END AS value
        FROM areas""",
    "dq_rf_scores": f"""
        WITH {MONTHS}, s AS (
            SELECT cleaning_flag AS y, CASE WHEN {_side(STUMP_FEATURES)} <= t THEN low ELSE high END AS p,
                   low, high
            FROM test CROSS JOIN {WEIGHTED_STUMP}),
        c AS (SELECT count(*) FILTER (y = 0 AND p <= 0.5) AS tn, count(*) FILTER (y = 0 AND p > 0.5) AS fp,
                     count(*) FILTER (y = 1 AND p <= 0.5) AS fn, count(*) FILTER (y = 1 AND p > 0.5) AS tp,
                     count(*) FILTER (y = 0 AND p = greatest(low, high)) AS fp2,
                     count(*) FILTER (y = 1 AND p = greatest(low, high)) AS tp2 FROM s)
        SELECT round(0.5 + 0.5 * (tp2::DOUBLE / (tp + fn) - fp2::DOUBLE / (tn + fp)), 6) AS auc, tn, fp, fn, tp
        FROM c""",
    "dq_gbt_importance": f"""
        WITH {MONTHS} {_gains(_stump("train", STUMP_FEATURES, "2.0::DOUBLE * cleaning_flag - 1"))}""",
    "dq_reg_importance": f"WITH {MONTHS} {_gains(_stump('train', STUMP_FEATURES, 'l_extendedprice'))}",
    "dq_search_grid": f"""
        WITH {MONTHS}, errors AS ({_fold_errors(0)} UNION ALL {_fold_errors(1)})
        SELECT depth::BIGINT AS "maxDepth", round(avg(rmse), 6) AS rmse FROM errors GROUP BY depth""",
    "dq_champion": f"""
        {RIVALS} SELECT algorithm, round(rmse, 6) AS rmse, round(r2, 6) AS r2
        FROM rivals ORDER BY rivals.r2 DESC, algorithm <> 'GBT Regressor' LIMIT 1""",
    "dq_best_scores": f"""
        {RIVALS} SELECT round(min(rmse), 6) AS best_rmse, round(max(r2), 6) AS best_r2 FROM rivals""",
    "dq_split_report": f"""
        WITH {MONTHS}, sides AS (SELECT 'train' AS side, * FROM train UNION ALL SELECT 'test', * FROM test)
        SELECT side, count(*) AS n, count(*) FILTER (cleaning_flag = 1) AS positives,
               count(*) FILTER (cleaning_flag = 0) AS negatives,
               round(count(*) FILTER (cleaning_flag = 1) / count(*), 6) AS positive_rate,
               round(count(*) FILTER (cleaning_flag = 0) / count(*) FILTER (cleaning_flag = 1), 6) AS ratio,
               count(*) FILTER (l_linenumber NOT IN (3, 4)) AS trainable
        FROM sides GROUP BY side""",
    "dq_null_keys": f"""
        SELECT event_type, count(*) AS n FROM ({GAPPY})
        WHERE value IS NOT NULL AND NOT isnan(value) AND user_id IS NOT NULL GROUP BY 1""",
    "dq_analysis_cities": f"""
        SELECT event_type AS "CITY", * EXCLUDE (event_type)
        FROM ({_box(f"SELECT event_type, value FROM {BRIGHT}", "value", "event_type")})""",
    "dq_analysis_monthly": """
        WITH means AS (SELECT month(ts) AS m, avg(90 - value) AS tilt, avg(value) AS ghi FROM events GROUP BY 1)
        SELECT i::INTEGER AS month, strftime(make_date(2000, i::INTEGER, 1), '%b') AS label,
               round(tilt, 6) AS tilt, round(ghi, 6) AS ghi
        FROM range(1, 13) r(i) LEFT JOIN means ON m = i""",
    "dq_analysis_irradiance": " UNION ALL ".join(f"""
        SELECT '{phase}' AS phase, count(value) AS n, count(*) FILTER (value = 0) AS zeros,
               round(avg(value), 6) AS mean, round(median(value), 6) AS median,
               round(avg((value = 0)::INTEGER), 6) AS zero_share FROM {source}"""
        for phase, source in (("before", "events"), ("after", BRIGHT))),
    "dq_malformed": f"""
        WITH lines AS (SELECT *, l_orderkey % 53 = 0 OR l_orderkey % 59 = 0 AS bad,
                              CASE WHEN l_tax > 0 THEN l_extendedprice END AS dc FROM {RAW_LINES})
        SELECT 'read' AS item, count(*) AS n, (count(*) FILTER (bad))::DOUBLE AS value FROM lines
        UNION ALL SELECT 'set apart', count(*), (count(*) FILTER (l_orderkey % 53 = 0))::DOUBLE FROM lines WHERE bad
        UNION ALL SELECT 'kept', count(*), round(avg(dc), 6) FROM lines WHERE NOT bad""",
    "dq_city_year_scan": """
        SELECT event_type AS "CITY", year(ts)::INTEGER AS "YEAR", count(*) AS n,
               count(*) FILTER (length(event_type) % 2 = 0) AS dhi,
               count(*) FILTER (length(event_type) % 2 = 1) AS notes,
               strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first, max(value) AS highest,
               round(avg(CASE WHEN event_id % 9 > 0 THEN value + 1 END), 6) AS temp,
               round(avg(90 - value), 6) AS tilt
        FROM events GROUP BY ALL""",
    "dq_analysis_missing": " UNION ALL ".join([f"""
        SELECT 'before' AS phase, '{source}' AS source, '{column}' AS "column",
               count(*) FILTER ({gap}) AS missing FROM {relation}"""
        for source, (relation, gaps) in AUDITED.items() for column, gap in gaps.items()
        if source == "generation" or column in ("ghi", "dhi", "dni", "temp_air", "wind_speed")
        or source == "weather" and column in WEATHER_MEASURES]) + f"""
        UNION ALL SELECT * FROM (
            SELECT 'after', 'merged', 'AC_POWER', count(*) FILTER (dc <= 1000) AS missing
            FROM ({PREPROCESS_GENERATION})) WHERE missing > 0""",
    "dq_analysis_dc_power": " UNION ALL ".join(f"""
        SELECT '{phase}' AS phase, center.*, histogram.* FROM (
            SELECT count(v) AS n, count(*) FILTER (v = 0) AS zeros, round(avg(v), 6) AS mean,
                   round(median(v), 6) AS median, round(avg((v = 0)::INTEGER), 6) AS zero_share
            FROM {source}) center CROSS JOIN (
            WITH {_bins(f"(SELECT v FROM {source} WHERE v IS NOT NULL)", "v", 80)}
            SELECT count(*) AS bins, sum(n)::BIGINT AS binned, max(n) AS fullest FROM counted) histogram"""
        for phase, source in (
            ("before", f"(SELECT CASE WHEN l_tax > 0 THEN l_extendedprice END AS v FROM {RAW_LINES})"),
            ("after", "(SELECT l_extendedprice AS v FROM lineitem WHERE l_extendedprice > 0)"))),
    "dq_analysis_boxes": " UNION ALL ".join(f"""
        SELECT '{phase}' AS phase, '{name}' AS variable, * FROM ({_box(source, "v")})"""
        for phase, name, source in (
            ("before", "DC_POWER", f"""SELECT dc / max(dc) OVER () AS v FROM (
                SELECT CASE WHEN l_tax > 0 THEN l_extendedprice END AS dc FROM {RAW_LINES}) WHERE dc IS NOT NULL"""),
            ("before", "DAILY_YIELD", f"""SELECT dy / max(dy) OVER () AS v FROM (
                SELECT CASE WHEN l_discount > 0 THEN l_quantity END AS dy FROM {RAW_LINES}) WHERE dy IS NOT NULL"""),
            ("before", "ghi", "SELECT value / max(value) OVER () AS v FROM events WHERE value > 0"),
            ("after", "EFFICIENCY", f"SELECT efficiency AS v FROM ({FLAGGED}) WHERE efficiency BETWEEN 0 AND 1"),
            ("after", "SOILING_PROXY", f"SELECT greatest(0, least(1, proxy)) AS v FROM ({FLAGGED})"),
            ("after", "OPTIMAL_TILT", "SELECT greatest(0, least(1, l_quantity * 2 / 90.0::DOUBLE)) AS v FROM lineitem"))),
    "dq_baseline_job": f"""
        WITH {MODEL_SIDES},
        stump AS (SELECT * FROM {_stump("weighted", VARIED["baseline"], "y", "w")}),
        cells AS (SELECT * FROM {_class_cells(VARIED["baseline"], "stump", "0.5::DOUBLE")})
        SELECT name AS item, CASE WHEN name = f THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value
        FROM stump CROSS JOIN (VALUES {", ".join(f"('{c}')" for c in BASELINE_FEATURES)}) AS n(name)
        UNION ALL SELECT 'auc', round(auc, 6) FROM cells
        {" ".join(f"UNION ALL SELECT '{c}', {c} FROM cells" for c in ("tn", "fp", "fn", "tp"))}
        UNION ALL SELECT 'trainable train', count(*)::DOUBLE FROM train
        UNION ALL SELECT 'trainable test', count(*)::DOUBLE FROM test""",
    "dq_tuned_job": f"""
        WITH {MODEL_SIDES},
        rivals AS (SELECT 'Random Forest' AS algorithm, * FROM {_class_cells(VARIED["classifier"], FOREST, "0.5::DOUBLE")}
                   UNION ALL SELECT 'GBT', * FROM {_class_cells(VARIED["classifier"], BOOSTED, "0.0::DOUBLE")}),
        errors AS ({_power_errors("RF Regressor")} UNION ALL {_power_errors("GBT Regressor")}),
        top AS (SELECT algorithm FROM rivals ORDER BY round(auc, 12) DESC, algorithm <> 'GBT' LIMIT 1)
        SELECT algorithm, 'auc' AS item, round(auc, 6) AS value FROM rivals
        UNION ALL SELECT algorithm, 'f1', round({_weighted_f1()}, 6) FROM rivals
        UNION ALL SELECT algorithm, 'rmse', round(rmse, 6) FROM errors
        UNION ALL SELECT algorithm, 'r2', round(r2, 6) FROM errors
        UNION ALL SELECT algorithm, 'winner', 1.0::DOUBLE FROM (
            SELECT algorithm FROM errors ORDER BY round(r2, 12) DESC, algorithm <> 'GBT Regressor' LIMIT 1)
        UNION ALL SELECT CASE (SELECT algorithm FROM top) WHEN 'GBT' THEN g.f ELSE r.f END, 'importance', 1.0::DOUBLE
        FROM {FOREST} r CROSS JOIN {BOOSTED} g""",
    "dq_incremental": PREPROCESS,
    "dq_laid_out": PREPROCESS,
    "dq_job_describe": " UNION ALL ".join(f"""
        SELECT '{source}' AS source, '{c}' AS "column", count("{c}") AS count, round(avg("{c}"), 6) AS mean,
               round(stddev_samp("{c}"), 6) AS stddev, round(min("{c}"), 6) AS min, round(max("{c}"), 6) AS max
        FROM {relation}""" for source, (relation, columns) in DESCRIBED.items() for c in columns),
    "dq_job_volume": " UNION ALL ".join(
        f"SELECT '{source}' AS source, count(*) AS rows, NULL::BOOLEAN AS requirement_met FROM {relation}"
        for source, (relation, _) in DESCRIBED.items()) + " UNION ALL SELECT 'TOTAL', " + " + ".join(
        f"(SELECT count(*) FROM {relation})" for relation, _ in DESCRIBED.values()) + f""", {" + ".join(
        f"(SELECT count(*) FROM {relation})" for relation, _ in DESCRIBED.values())} >= {MIN_TOTAL_ROWS}""",
}
