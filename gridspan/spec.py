"""Names, roles and fixed values of an hourly load panel.

A *panel* is a DataFrame with one row per (entity, hour).  Operators never hard-code
column names: they take a :class:`PanelSpec`.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T


class SchemaError(ValueError):
    """A required column is absent or has the wrong type."""


# Names and constants of the published gold panel.
HORIZON = 48
LAG_HOURS = (48, 49, 50, 51, 52, 72, 96, 120, 144, 168, 336)
ROLL_WINDOWS = (24, 48, 168)
TIME_ORIGIN_LOCAL = "2024-01-01 01:00:00"
TIME_ZONE = "Europe/Kyiv"
PRICE_COLUMNS = ("dam_price", "sell_bm_price", "buy_bm_price")
WEATHER_COLUMNS = (
    "temperature_2m", "apparent_temperature", "dew_point_2m", "relative_humidity_2m",
    "precipitation", "rain", "snowfall", "cloud_cover", "cloud_cover_low",
    "cloud_cover_mid", "cloud_cover_high", "surface_pressure", "wind_speed_10m",
    "wind_direction_10m", "wind_gusts_10m", "shortwave_radiation", "diffuse_radiation",
    "direct_normal_irradiance",
)
WEATHER_KEPT = (
    "temperature_2m", "precipitation", "cloud_cover", "wind_speed_10m",
    "shortwave_radiation", "direct_normal_irradiance",
)
CATEGORICAL_COLUMNS = ("eic_code", "dso_desc", "station_type", "oblast")
STATIC_COLUMNS = ("latitude", "longitude", "dso_desc", "station_type", "oblast")
CALENDAR_COLUMNS = ("Month", "Day", "Hour", "day_of_week", "season")
TOTAL_LABELS = ("Grand Total", "Загальний підсумок", "Total")
TRAIN_END = "2025-07-01"
VAL_END = "2025-08-01"

# Readings before the date are invalid for the entity.
DROP_BEFORE = {
    "62Z3584090129468": "2024-10-02",
    "62Z0101426517156": "2025-01-01",
    "62Z4869256917783": "2025-06-01",
    "62Z2655661084314": "2025-05-01",
    "62Z4948939192262": "2025-05-05",
    "62Z5644272506149": "2025-05-05",
    "62Z9512175266041": "2025-05-05",
    "62Z2986251549800": "2024-05-05",
    "62Z7878159195687": "2024-11-01",
    "62Z8521105012164": "2024-06-01",
}
# Upper bound of a reading for the entity.
VALUE_CAPS = {"62Z0101426517156": 210.0}
# Constant distribution price of the entity.
PRICE_OVERRIDES = {"62Z8937841078757": 2.31163}
# Coordinates (latitude, longitude) of entities whose dictionary entry lacks them.
COORDINATES = {
    "62Z0602349894257": (48.763904006776954, 28.077456990197557),
    "62Z6035944504754": (49.153510259625534, 23.049801982501872),
    "62Z8888861892130": (48.309249416757545, 25.11895645420284),
    "62Z1209368438999": (49.78531388363913, 24.927028292321978),
    "62Z1771663109656": (49.453445499775405, 23.020911411362146),
    "62Z2532379651825": (49.29362429838761, 23.41030049170128),
    "62Z3261331410025": (49.56421176098104, 23.304357225434188),
    "62Z3627036877597": (48.51882104530565, 28.760435421364264),
    "62Z5422632680702": (50.22822399875523, 24.83726310970472),
    "62Z0763594350330": (49.369735771908296, 23.47527668624802),
    "62Z7029546479880": (49.77948499692157, 24.013408048459073),
    "62Z7072263538637": (49.86242688799433, 24.062926768794956),
    "62Z7766151236986": (50.46762760936502, 24.26123769025777),
    "62Z5064314448909": (48.149046045899055, 23.322957181272095),
    "62Z9342951787758": (49.28552561066835, 23.534192240667057),
    "62Z8521105012164": (48.36054435942602, 29.536275478873062),
    "62Z1142387881356": (49.76402754584019, 31.39902598856454),
    "62Z6624735969589": (48.94419405940688, 24.149295411716132),
    "62Z5956494916290": (49.95178196130912, 25.31699531547816),
    "62Z0717322121288": (48.207039717684104, 23.522199099176),
    "62Z568600499251K": (49.74638889010666, 31.486251700927244),
}


@dataclass(frozen=True)
class PanelSpec:
    """Column roles of one panel and the length of its time step."""

    entity: str = "entity"
    ts: str = "ts"
    idx: str = "time_idx"
    y: str = "y"
    step_seconds: int = 3600
    horizon: int = HORIZON
    static: tuple[str, ...] = ()
    known_future: tuple[str, ...] = ()
    past_only: tuple[str, ...] = ()

    @property
    def key(self) -> list[str]:
        return [self.entity, self.ts]

    def with_(self, **changes) -> PanelSpec:
        return replace(self, **changes)

    def require(self, df: DataFrame, *more: str) -> DataFrame:
        return require_columns(df, [self.entity, self.ts, self.y, *more])


PANEL = PanelSpec()
GOLD = PanelSpec(
    entity="eic_code", ts="datetime", y="sum_of_kWh", static=STATIC_COLUMNS,
    known_future=WEATHER_KEPT + PRICE_COLUMNS,
)


def require_columns(df: DataFrame, names) -> DataFrame:
    """Raise :class:`SchemaError` before any job runs when a column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise SchemaError(f"missing columns {missing}; the frame has {df.columns}")
    return df


def readings_schema() -> T.StructType:
    """Raw meter readings as landed (one row per entity and hour)."""
    return T.StructType([
        T.StructField("entity", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("y", T.DoubleType()),
    ])


def gold_schema() -> T.StructType:
    """The published gold layout that keeps ``datetime`` and text categoricals."""
    floats = ["sum_of_kWh", "max_power", "max_solar", "max_ev", "latitude", "longitude"]
    fields = [T.StructField("eic_code", T.StringType(), False),
              T.StructField("datetime", T.TimestampType(), False)]
    fields += [T.StructField(c, T.FloatType()) for c in floats]
    fields += [T.StructField(c, T.StringType()) for c in ("dso_desc", "station_type", "oblast")]
    fields += [T.StructField(c, T.FloatType()) for c in WEATHER_COLUMNS]
    fields += [T.StructField(c, T.IntegerType()) for c in ("Month", "Day", "Hour", "day_of_week")]
    fields += [T.StructField("season", T.StringType()), T.StructField("time_idx", T.LongType())]
    fields += [T.StructField(c, T.FloatType()) for c in PRICE_COLUMNS]
    return T.StructType(fields)
