"""Values that results depend on: names, formats, thresholds, places, feature sets, grids."""

# Places (name, latitude, longitude) and years of the irradiance series.
LOCATIONS = [
    ("Gandikota", 14.8130, 78.2860),
    ("Kadapa", 14.4673, 78.8242),
    ("Anantapur", 14.6819, 77.6006),
    ("Kurnool", 15.8281, 78.0373),
    ("Tirupati", 13.6288, 79.4192),
]
FIRST_YEAR = 2016
LAST_YEAR = 2024

# The site and year whose irradiance belongs to the plants.
PLANT_CITY = "Gandikota"
PLANT_YEAR = 2020
PLANT_ZONE = "Asia/Kolkata"

# Timestamp formats of the two plants' loggers, in order of trial.
TIMESTAMP_FORMATS = ["dd-MM-yyyy HH:mm", "yyyy-MM-dd HH:mm:ss"]

# Irradiance files are City_Year.csv; names with this word are left out.
IRRADIANCE_GLOB = "*_*.csv"
IRRADIANCE_EXCLUDE = "combined"

# Thresholds.
SOILING_THRESHOLD = 0.10
EFFICIENCY_THRESHOLD = 0.95
DAYLIGHT_GHI = 10
MIN_TOTAL_ROWS = 500_000
MIN_CORRELATION_PAIRS = 30
TRAIN_MONTH = 5
TEST_MONTH = 6
HISTOGRAM_BINS = 80
SCORE_BINS = 50
SWEEP_FIRST = 0.1
SWEEP_LAST = 0.9
SWEEP_POINTS = 80
SCATTER_ROWS = 5000
SCATTER_GHI = 50
LINE_POINTS = 100
FORECAST_ROWS = 500

# Measured columns whose gaps are filled with the column mean.
GENERATION_MEASURES = ["DC_POWER", "AC_POWER", "DAILY_YIELD", "TOTAL_YIELD"]
WEATHER_MEASURES = ["IRRADIATION", "AMBIENT_TEMPERATURE", "MODULE_TEMPERATURE"]
IRRADIANCE_MEASURES = [
    "ghi", "dhi", "dni", "temp_air", "wind_speed", "SOLAR_ZENITH_ANGLE", "OPTIMAL_TILT",
]

# Canonical names of irradiance columns.
IRRADIANCE_NAMES = {
    "ghi": "GHI",
    "dhi": "DHI",
    "dni": "DNI",
    "temp_air": "AIR_TEMPERATURE",
    "wind_speed": "WIND_SPEED",
}

# Columns averaged into the hourly irradiance profile.
HOURLY_MEASURES = [
    "GHI", "DHI", "DNI", "AIR_TEMPERATURE", "WIND_SPEED",
    "SOLAR_ZENITH_ANGLE", "OPTIMAL_TILT", "LATITUDE", "LONGITUDE",
]

# Columns of the preprocessed table, in order.
PREPROCESSED_COLUMNS = [
    "MONTH", "DATETIME", "PLANT_ID", "SOURCE_KEY",
    "DC_POWER", "AC_POWER", "DAILY_YIELD", "TOTAL_YIELD",
    "EFFICIENCY", "SOILING_PROXY", "CLEANING_FLAG",
    "IRRADIATION", "AMBIENT_TEMPERATURE", "MODULE_TEMPERATURE",
    "GHI", "DHI", "DNI", "AIR_TEMPERATURE", "WIND_SPEED",
    "SOLAR_ZENITH_ANGLE", "OPTIMAL_TILT", "LATITUDE", "LONGITUDE",
]

# Columns of the correlation analysis, merged and irradiance-only.
CORRELATION_COLUMNS = [
    "DC_POWER", "AC_POWER", "GHI", "AIR_TEMPERATURE", "WIND_SPEED", "EFFICIENCY",
    "OPTIMAL_TILT", "SOILING_PROXY", "SOLAR_ZENITH_ANGLE", "DNI", "DHI",
]
IRRADIANCE_CORRELATION_COLUMNS = IRRADIANCE_MEASURES

# Labels and feature sets of the models.
CLEANING_LABEL = "CLEANING_FLAG"
POWER_LABEL = "DC_POWER"
BASELINE_FEATURES = [
    "GHI", "AIR_TEMPERATURE", "SOLAR_ZENITH_ANGLE", "EFFICIENCY",
    "HOUR_SIN", "HOUR_COS", "MONTH_SIN", "MONTH_COS",
]
CLF_FEATURES = [
    "GHI", "DNI", "DHI", "AIR_TEMPERATURE", "MODULE_TEMPERATURE",
    "WIND_SPEED", "SOLAR_ZENITH_ANGLE", "TEMP_DIFF", "HOUR_SIN", "HOUR_COS",
]
REG_FEATURES = [
    "IRRADIATION", "GHI", "MODULE_TEMPERATURE", "AIR_TEMPERATURE",
    "SOLAR_ZENITH_ANGLE", "TEMP_DIFF", "HOUR_SIN", "HOUR_COS",
]

# Search grids, seed and folds.
SEED = 42
FOLDS = 3
BASELINE_TREES = 100
BASELINE_DEPTH = 10
BASELINE_GRID = {"numTrees": [100, 200], "maxDepth": [8, 12]}
RF_GRID = {"maxDepth": [10, 15, 20], "numTrees": [100, 200]}
GBT_GRID = {"maxIter": [50, 100], "stepSize": [0.05, 0.10], "maxDepth": [4, 6]}
RF_REGRESSOR_GRID = {"maxDepth": [10, 15], "numTrees": [100, 200]}
GBT_REGRESSOR_GRID = {"maxIter": [50, 100], "stepSize": [0.05, 0.10], "maxDepth": [5, 8]}
