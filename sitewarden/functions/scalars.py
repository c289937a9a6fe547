"""Column functions for cleaning, codes, dates and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitewarden.constants import COASTAL_THRESHOLD_M, RISK_BINS, RISK_LEVELS


def clean(text: Column, max_len: int | None = None) -> Column:
    """Trimmed text, NULL when empty, truncated to `max_len` characters."""
    kept = F.nullif(F.trim(text), F.lit(""))
    return kept if max_len is None else F.substring(kept, 1, max_len)


def first_nonempty(*texts: Column, max_len: int | None = None) -> Column:
    """First argument that is not blank."""
    return clean(F.coalesce(*[clean(t) for t in texts]), max_len)


def to_day(text: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Date, or NULL when the text does not match."""
    return F.try_to_date(text, fmt)


def to_minutes(hhmm: Column) -> Column:
    """'5', '905', '1330' -> minutes after midnight; NULL outside 00:00..23:59."""
    number = F.regexp_replace(F.trim(hhmm), r"\.0+$", "").try_cast("int")
    hour, minute = F.floor(number / 100).cast("int"), (number % 100).cast("int")
    return F.when((number >= 0) & (hour < 24) & (minute < 60), hour * 60 + minute)


def from_epoch_ms(ms: Column) -> Column:
    """Epoch milliseconds -> timestamp, in UTC."""
    return F.timestamp_millis(ms.cast("long"))


def normalize_confidence(value: Column) -> Column:
    """Word or number -> 0..100. NULL is 0, unreadable text is 50."""
    text = F.lower(value.cast("string"))
    number = F.trim(text).try_cast("double").try_cast("int")
    return (
        F.when(value.isNull(), 0)
        .when(text.contains("low"), 30)
        .when(text.contains("nominal"), 50)
        .when(text.contains("high"), 80)
        .otherwise(F.coalesce(number, F.lit(50)))
    )


def coastal_score(elevation_m: Column) -> Column:
    """1 below sea level, falling to 0 at the threshold; NULL is 0."""
    sloped = F.round(F.greatest(F.lit(0.0), 1.0 - elevation_m / COASTAL_THRESHOLD_M), 4)
    return F.when(elevation_m.isNull(), F.lit(0.0)).when(elevation_m < 0, F.lit(1.0)).otherwise(sloped)


def clip01(value: Column) -> Column:
    return F.when(value.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))


def risk_level(score: Column, bins: tuple[float, ...] = RISK_BINS) -> Column:
    """Right-closed bins over [0, 1]; NULL outside."""
    low, medium, high = bins
    return (
        F.when((score < 0) | (score > 1), F.lit(None).cast("string"))
        .when(score <= low, RISK_LEVELS[0])
        .when(score <= medium, RISK_LEVELS[1])
        .when(score <= high, RISK_LEVELS[2])
        .when(score <= 1, RISK_LEVELS[3])
    )


def feature_info(tags: Column) -> tuple[Column, Column]:
    """(feature_type, feature_value) of a tag map: building first, then landuse."""
    building, landuse = tags.getItem("building"), tags.getItem("landuse")
    kind = F.when(building.isNotNull(), "building").when(landuse.isNotNull(), "landuse").otherwise("unknown")
    value = (
        F.when(F.lower(building) == "true", "yes")
        .when(building.isNotNull(), building)
        .when(landuse.isNotNull(), landuse)
        .otherwise("unknown")
    )
    return kind, value
