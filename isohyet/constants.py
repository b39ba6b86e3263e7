"""Fixed values of the domain: names, years, ranges and feature lists."""

# Climate models and scenarios.
MODELS = (
    "BCC-CSM2-MR",
    "CAMS-CSM1-0",
    "CanESM5",
    "CESM2",
    "CESM2-WACCM",
    "EC-Earth3",
    "IPSL-CM6A-LR",
    "MIROC6",
    "MRI-ESM2-0",
)
HISTORICAL = "hist"
SCENARIOS = ("hist", "ssp126", "ssp585")
FUTURE_SCENARIOS = ("ssp126", "ssp585")

# Periods, inclusive years.
ALL_YEARS = (1980, 2014)
TRAIN_YEARS = (1980, 2005)
VALIDATION_YEARS = (2006, 2010)
TEST_YEARS = (2011, 2014)
FUTURE_YEARS = (2071, 2100)

# Seasons by calendar month, no year shift for December.
SEASONS = {
    "DJF": (12, 1, 2),
    "MAM": (3, 4, 5),
    "JJA": (6, 7, 8),
    "SON": (9, 10, 11),
}

# Sample points (lat, lon).
SAMPLE_POINTS = ((30.0, 70.0), (33.5, 73.0), (25.0, 67.0))

# Accepted ranges (low, high, strict) per source and variable.
RANGES = {
    "reference": {"tas": (-50.0, 60.0, True), "pr": (0.0, 1000.0, True)},
    "target": {"tas": (-50.0, 60.0, True), "pr": (0.0, 1000.0, True)},
    "model": {"tas": (-50.0, 60.0, False), "pr": (0.0, 2000.0, False)},
}

# Coordinate and variable names per source.
TARGET_COORDS = {"valid_time": "time", "latitude": "lat", "longitude": "lon"}
MODEL_COORDS = {"TIME": "time", "YAX": "lat", "XAX": "lon"}
UNUSED_COORDS = ("expver", "number")
VARIABLE_ALIASES = {
    "cru_tmp": ("tmp", "tas", "temperature"),
    "cru_pre": ("pre", "pr", "precipitation"),
    "era5_t2m": ("t2m", "temperature", "tas"),
    "era5_tp": ("tp", "pr", "precipitation"),
    "gcm_tas": ("tas", "TMP", "tas_monthly", "temperature"),
    "gcm_pr": ("pr", "PRE", "precipitation"),
}
TRAINING_NAMES = {
    "cru_tmp": "cru_tmp_degC",
    "cru_pre": "cru_pre_mm",
    "era5_t2m": "era_t2m_degC",
    "era5_tp": "era_tp_mm",
    "gcm_tas": "gcm_tas_degC",
    "gcm_pr": "gcm_pr_mm",
}
CORE_COLUMNS = ("gcm_tas_degC", "gcm_pr_mm", "era_t2m_degC", "era_tp_mm")

# Ordered feature lists and targets.
TEMPERATURE_FEATURES = (
    "gcm_tas_degC", "gcm_pr_mm", "lat", "lon", "month_sin", "month_cos",
)
PRECIPITATION_FEATURES = (
    "gcm_pr_log1p", "gcm_tas_degC", "lat", "lon", "month_sin", "month_cos",
)
FEATURE_SETS = {
    "temperature": (TEMPERATURE_FEATURES, "era_t2m_degC"),
    "precipitation": (PRECIPITATION_FEATURES, "era_tp_log1p"),
}

# Output metadata.
OUTPUT_ATTRIBUTES = {
    "tas": {
        "long_name": "Near-Surface Air Temperature (downscaled)",
        "units": "degC",
        "standard_name": "air_temperature",
    },
    "pr": {
        "long_name": "Precipitation (downscaled)",
        "units": "mm/month",
        "standard_name": "precipitation_amount",
    },
}
TARGET_RESOLUTION = "0.25 degrees"
