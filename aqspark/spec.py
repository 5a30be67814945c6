"""Column roles of an observation table, and the fixed values of the air-quality domain."""

from __future__ import annotations

from dataclasses import dataclass, replace

# They must be exactly these for results to agree.
POLLUTANTS = ("pm2_5", "pm10", "co", "no", "no2", "o3", "so2", "nh3")
WEATHER = ("temp", "humidity", "wind_speed", "pressure", "visibility")
LAGS = (1, 2, 3, 6, 12, 24)
LAGGED_POLLUTANTS = ("pm2_5", "pm10", "no2", "o3")
ROLLING_DAYS = (3, 7, 14)
EWM_SPANS = (12, 24, 72)
RATIOS = (("pm_ratio", "pm2_5", "pm10"), ("no2_o3_ratio", "no2", "o3"))
WINSORISED = ("aqi", "pm2_5", "pm10")
AQI_MIN, AQI_MAX = 0.0, 500.0
ALERT_THRESHOLD = 150.0
DANGER_THRESHOLD = 200.0
FORECAST_DAYS = 3
HORIZON = 72
TRAINING_DAYS = 90
CACHE_TTL_SECONDS = 3600
TEST_FRACTION = 0.2
CV_FOLDS = 5
MAX_CV_ROWS = 20000
SEED = 42
# (lower, upper, label, color, emoji), bounds inclusive
CATEGORIES = (
    (0, 50, "Good", "#00e400", "😊"),
    (51, 100, "Moderate", "#ffff00", "😐"),
    (101, 150, "Unhealthy for Sensitive", "#ff7e00", "😷"),
    (151, 200, "Unhealthy", "#ff0000", "🤢"),
    (201, 300, "Very Unhealthy", "#8f3f97", "🚨"),
    (301, 500, "Hazardous", "#7e0023", "☠️"),
)
# (concentration low, concentration high, index low, index high)
PM25_BREAKPOINTS = (
    (0.0, 12.0, 0, 50),
    (12.1, 35.4, 51, 100),
    (35.5, 55.4, 101, 150),
    (55.5, 150.4, 151, 200),
    (150.5, 250.4, 201, 300),
    (250.5, 500.4, 301, 500),
)
COARSE_AQI = {1: 25.0, 2: 75.0, 3: 125.0, 4: 175.0, 5: 300.0}
COARSE_AQI_DEFAULT = 50.0
# Values a forecast row takes when history lacks the column
FUTURE_DEFAULTS = {"aqi": 80.0, "pm_ratio": 0.6, "no2_o3_ratio": 0.5}


@dataclass(frozen=True)
class ObsSpec:
    """Which columns play which role, and how a long series is cut for parallel work.

    ``seq`` is the arrival order used to break ties between rows of equal time.
    ``bucket_days`` bounds the rows numbered by one task: a bucket of 30 days holds
    720 hourly readings of one entity, 43,200 at one per minute. Sensors that report
    many times per second want a smaller bucket, also of part of a day (1 / 24). ``block_rows`` bounds the rows of one
    window group, however many rows an entity has.
    """

    entity: str = "city"
    time: str = "timestamp"
    target: str = "aqi"
    seq: str | None = None
    bucket_days: float = 30
    block_rows: int = 16384

    @property
    def key(self) -> list[str]:
        return [self.entity, self.time]

    @property
    def order(self) -> list[str]:
        return [self.time] + ([self.seq] if self.seq else [])

    def with_(self, **changes) -> "ObsSpec":
        return replace(self, **changes)
