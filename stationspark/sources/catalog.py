"""Dimensions that ship with the library: states, record kinds, metric catalog.

These are small, fixed tables.  They are exposed both as Python mappings
(for plan-time parameter checks and unit lookup) and as DataFrames (for
joins); a join with one of them is always a broadcast of a proven size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the original application's tables).
# ---------------------------------------------------------------------------

# State code -> state name: the 50 US states, no DC, no territories.
STATES = {
    "AL": "Alabama",
    "AK": "Alaska",
    "AZ": "Arizona",
    "AR": "Arkansas",
    "CA": "California",
    "CO": "Colorado",
    "CT": "Connecticut",
    "DE": "Delaware",
    "FL": "Florida",
    "GA": "Georgia",
    "HI": "Hawaii",
    "ID": "Idaho",
    "IL": "Illinois",
    "IN": "Indiana",
    "IA": "Iowa",
    "KS": "Kansas",
    "KY": "Kentucky",
    "LA": "Louisiana",
    "ME": "Maine",
    "MD": "Maryland",
    "MA": "Massachusetts",
    "MI": "Michigan",
    "MN": "Minnesota",
    "MS": "Mississippi",
    "MO": "Missouri",
    "MT": "Montana",
    "NE": "Nebraska",
    "NV": "Nevada",
    "NH": "New Hampshire",
    "NJ": "New Jersey",
    "NM": "New Mexico",
    "NY": "New York",
    "NC": "North Carolina",
    "ND": "North Dakota",
    "OH": "Ohio",
    "OK": "Oklahoma",
    "OR": "Oregon",
    "PA": "Pennsylvania",
    "RI": "Rhode Island",
    "SC": "South Carolina",
    "SD": "South Dakota",
    "TN": "Tennessee",
    "TX": "Texas",
    "UT": "Utah",
    "VT": "Vermont",
    "VA": "Virginia",
    "WA": "Washington",
    "WV": "West Virginia",
    "WI": "Wisconsin",
    "WY": "Wyoming",
}

# Record kinds a user can pick: type id -> label.
KINDS = {
    "1": "Daily",
    "2": "Hourly",
    "3": "Monthly",
}

# Metric catalog per record kind: metric column -> (description, unit).
DAILY_METRICS = {
    "Tmax": ("Maximum Temperature", "°F"),
    "Tmin": ("Minimum Temperature", "°F"),
    "Tavg": ("Average Temperature", "°F"),
    "Depart": ("Temperature Departure", "°F"),
    "DewPoint": ("Dew Point Temperature", "°F"),
    "WetBulb": ("Wet Bulb Temperature", "°F"),
    "Heat": ("Heating Degree Days", "°F-days"),
    "Cool": ("Cooling Degree Days", "°F-days"),
    "Depth": ("Snow Depth", "inches"),
    "Water1": ("Water Equivalent", "inches"),
    "SnowFall": ("Snowfall", "inches"),
    "PrecipTotal": ("Total Precipitation", "inches"),
    "StnPressure": ("Station Pressure", "inches of mercury"),
    "SeaLevel": ("Sea Level Pressure", "inches of mercury"),
    "ResultSpeed": ("Resultant Wind Speed", "mph"),
    "ResultDir": ("Resultant Wind Direction", "degrees"),
    "AvgSpeed": ("Average Wind Speed", "mph"),
    "Max5Speed": ("Max 5-Minute Wind Speed", "mph"),
    "Max2Speed": ("Max 2-Minute Wind Speed", "mph"),
}

HOURLY_METRICS = {
    "DryBulbFarenheit": ("Dry Bulb Temperature in Fahrenheit", "°F"),
    "DryBulbCelsius": ("Dry Bulb Temperature in Celsius", "°C"),
    "WetBulbFarenheit": ("Wet Bulb Temperature in Fahrenheit", "°F"),
    "WetBulbCelsius": ("Wet Bulb Temperature in Celsius", "°C"),
    "DewPointFarenheit": ("Dew Point in Fahrenheit", "°F"),
    "DewPointCelsius": ("Dew Point in Celsius", "°C"),
    "RelativeHumidity": ("Relative Humidity", "%"),
    "WindSpeed": ("Wind Speed", "m/s"),
    "WindDirection": ("Wind Direction", "°"),
    "StationPressure": ("Station Atmospheric Pressure", "hPa"),
    "SeaLevelPressure": ("Sea Level Pressure", "hPa"),
    "HourlyPrecip": ("Hourly Precipitation", "mm"),
}

MONTHLY_METRICS = {
    "AvgMaxTemp": ("Average Maximum Temperature", "°F"),
    "DepartureMaxTemp": ("Maximum Temperature Departure", "°F"),
    "AvgMinTemp": ("Average Minimum Temperature", "°F"),
    "DepartureMinTemp": ("Minimum Temperature Departure", "°F"),
    "AvgTemp": ("Average Temperature", "°F"),
    "DeparturefromNormal": ("Departure from Normal Temperature", "°F"),
    "AvgDewPoint": ("Average Dew Point", "°F"),
    "AvgWetBulb": ("Average Wet Bulb Temperature", "°F"),
    "HDDSeasonToDate": ("Heating Degree Days to Date", "°F"),
    "CDDSeasonToDate": ("Cooling Degree Days to Date", "°F"),
    "HDDSeasonToDateDeparture": ("Heating Degree Days Seasonal Departure", "°F"),
    "CDDSeasonToDateDeparture": ("Cooling Degree Days Seasonal Departure", "°F"),
    "MeanStationPressure": ("Mean Station Pressure", "hPa"),
    "MeanSeaLevelPressure": ("Mean Sea Level Pressure", "hPa"),
    "MaxSeaLevelPressure": ("Maximum Sea Level Pressure", "hPa"),
    "MinSeaLevelPressure": ("Minimum Sea Level Pressure", "hPa"),
    "TotalMonthlyPrecip": ("Total Monthly Precipitation", "inches"),
    "DepartureFromNormalPrecip": ("Precipitation Departure from Normal", "inches"),
    "Max24HrPrecip": ("Maximum 24-Hour Precipitation", "inches"),
    "TotalSnowfall": ("Total Snowfall", "inches"),
    "Max24HrSnowfall": ("Maximum 24-Hour Snowfall", "inches"),
    "Max12ZSnowDepth": ("Maximum 12Z Snow Depth", "inches"),
    "WaterEquivalent": ("Water Equivalent of Precipitation", "inches"),
    "ResultantWindSpeed": ("Resultant Wind Speed", "km/h"),
    "ResultantWindDirection": ("Resultant Wind Direction", "°"),
    "AvgWindSpeed": ("Average Wind Speed", "km/h"),
}

# ---------------------------------------------------------------------------

METRICS = {
    "daily": DAILY_METRICS,
    "hourly": HOURLY_METRICS,
    "monthly": MONTHLY_METRICS,
}

# Type id (as the user picks it) -> kind name used throughout the library.
KIND_BY_TYPE = {type_id: label.lower() for type_id, label in KINDS.items()}

STATE_SCHEMA = T.StructType([
    T.StructField("state_code", T.StringType(), False),
    T.StructField("state_name", T.StringType(), False),
])

KIND_SCHEMA = T.StructType([
    T.StructField("type_id", T.IntegerType(), False),
    T.StructField("kind", T.StringType(), False),
])

CATALOG_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType(), False),
    T.StructField("metric", T.StringType(), False),
    T.StructField("description", T.StringType(), False),
    T.StructField("unit", T.StringType(), False),
])


def kind_of(kind_or_type) -> str:
    """Normalise a kind given as name ('daily') or type id (1, '1')."""
    key = str(kind_or_type).strip().lower()
    if key in METRICS:
        return key
    if key in KIND_BY_TYPE:
        return KIND_BY_TYPE[key]
    raise ValueError(f"unknown record kind {kind_or_type!r}; expected one of "
                     f"{sorted(METRICS)} or type ids {sorted(KIND_BY_TYPE)}")


def catalog_kind(type_id) -> str:
    """Catalog page selection: '1' daily, '2' hourly, anything else monthly."""
    return {"1": "daily", "2": "hourly"}.get(str(type_id).strip(), "monthly")


def unit_of(kind: str, metric: str) -> str | None:
    """Unit of a metric in the catalog of its own kind (None if unknown)."""
    return METRICS[kind_of(kind)].get(metric, (None, None))[1]


def catalog_rows(kind: str | None = None) -> list[tuple[str, str, str, str]]:
    kinds = [kind_of(kind)] if kind is not None else list(METRICS)
    return [(k, m, d, u) for k in kinds for m, (d, u) in METRICS[k].items()]


def state_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(STATES.items()), STATE_SCHEMA)


def kind_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(int(k), v.lower()) for k, v in KINDS.items()], KIND_SCHEMA)


def metric_catalog(spark: SparkSession, kind: str | None = None) -> DataFrame:
    """Metrics of one kind (or all 57) as ``(kind, metric, description, unit)``."""
    return spark.createDataFrame(catalog_rows(kind), CATALOG_SCHEMA)
