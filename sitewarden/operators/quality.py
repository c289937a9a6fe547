"""Validation: every check is one aggregate, offenders stay distributed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitewarden.constants import CATEGORIES, CLIMATE_SOURCES, RISK_LEVELS, SCORE_COLUMNS
from sitewarden.operators.filters import first_per_key


def _valid_place() -> Column:
    inside = F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180)
    return F.coalesce(inside, F.lit(False))


def validate_sites(df: DataFrame, order: str = "ord") -> tuple[DataFrame, DataFrame]:
    """(valid sites, offenders).

    The first copy of a whc_id claims it even when its coordinates are bad; later copies are
    duplicates. A bad category is reported but does not reject. Offenders are rows of
    (issue, whc_id, records), so nothing is collected.
    """
    firsts = first_per_key(df, ["whc_id"], [order])
    valid = firsts.where(_valid_place())
    per_id = df.groupBy("whc_id").agg(
        (F.count(F.lit(1)) - 1).alias("duplicate_whc_id"),
        F.count_if(~_valid_place()).alias("invalid_geometry"),
        F.count_if(F.col("category").isNotNull() & (F.col("category") != "") & ~F.col("category").isin(*CATEGORIES)).alias(
            "invalid_category"
        ),
    )
    offenders = (
        per_id.unpivot("whc_id", ["duplicate_whc_id", "invalid_geometry", "invalid_category"], "issue", "records")
        .where(F.col("records") > 0)
        .select("issue", "whc_id", "records")
    )
    return valid, offenders


def site_report(df: DataFrame, order: str = "ord") -> DataFrame:
    """One row: total, valid and invalid records, and the number of each issue."""
    per_id = df.groupBy("whc_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(_valid_place(), F.col(order)).alias("first_ok"),
        F.count_if(~_valid_place()).alias("bad_place"),
        F.count_if(F.col("category").isNotNull() & (F.col("category") != "") & ~F.col("category").isin(*CATEGORIES)).alias(
            "bad_category"
        ),
    )
    valid = F.count_if("first_ok")
    total = F.coalesce(F.sum("n"), F.lit(0))
    return per_id.agg(
        total.alias("total_records"),
        valid.alias("valid_records"),
        (total - valid).alias("invalid_records"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_whc_ids"),
        F.coalesce(F.sum("bad_place"), F.lit(0)).alias("invalid_geometries"),
        F.coalesce(F.sum("bad_category"), F.lit(0)).alias("invalid_categories"),
    )


# fixed values: right-closed magnitude bins
_MAGNITUDE_BINS = ((0, 3), (3, 4), (4, 5), (5, 6), (6, 7), (7, 10))


def profile_quakes(df: DataFrame) -> DataFrame:
    """One row: magnitude and time range, suspicious rows and the magnitude histogram."""
    magnitude = F.col("magnitude")
    bins = [
        F.count_if((magnitude > low) & (magnitude <= high)).alias(f"mag_{low}_{high}")
        for low, high in _MAGNITUDE_BINS
    ]
    return df.agg(
        F.count(F.lit(1)).alias("events"),
        F.min(magnitude).alias("min_magnitude"),
        F.max(magnitude).alias("max_magnitude"),
        F.count_if(F.col("depth_km") < 0).alias("negative_depth"),
        F.count_if(F.col("lon").isNull() | F.col("lat").isNull()).alias("empty_geometry"),
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
        *bins,
    )


def _mentions(text: str) -> Column:
    return F.coalesce(F.lower(F.col("place_desc")).contains(text.lower()), F.lit(False))


def find_events(df: DataFrame, year: int, min_magnitude: float, text: str) -> DataFrame:
    """Events of a year and size whose place mentions the text."""
    return df.where((F.year("event_time") == year) & (F.col("magnitude") >= min_magnitude) & _mentions(text))


def count_mentions(df: DataFrame, texts: Sequence[str]) -> DataFrame:
    """One row: how many events mention each text."""
    return df.agg(*[F.count_if(_mentions(t)).alias(f"{t.lower()}_events") for t in texts])


def date_gap_report(
    df: DataFrame,
    partition_cols: Sequence[str] = ("site_id", "source"),
    date: str = "event_date",
    limit_days: int = 7,
) -> DataFrame:
    """Rows, first and last date, number of gaps above the limit and the largest gap per series.

    `partition_cols=()` treats the whole frame as one series. Dates are made distinct first (equal
    dates only add gaps of 0), so a series never holds more rows than there are calendar days.
    """
    keys = list(partition_cols)
    days = df.groupBy(*keys, date).agg(F.count(F.lit(1)).alias("n"))
    window = Window.partitionBy(*keys).orderBy(date) if keys else Window.orderBy(date)
    gaps = days.withColumn("gap", F.datediff(date, F.lag(date).over(window)))
    # copies of a date are steps of 0 days; a series of one row has no step at all
    step = F.greatest(F.coalesce(F.max("gap"), F.lit(0)), F.lit(0))
    return gaps.groupBy(*keys).agg(
        F.sum("n").alias("total_records"),
        F.min(date).alias("start_date"),
        F.max(date).alias("end_date"),
        F.count_if(F.col("gap") > limit_days).alias("num_large_gaps"),
        step.cast("long").alias("largest_gap_days"),
    )


def _between01(column: str) -> Column:
    return F.col(column).between(0, 1) | F.col(column).isNull()


def _in_or_null(column: str, values: Sequence[str]) -> Column:
    return F.col(column).isin(*values) | F.col(column).isNull()


def domain_rules(table: str) -> tuple[dict[str, Column], list[str]]:
    """(row rules, unique key) of a stored table."""
    rules: dict[str, dict[str, Column]] = {
        "sites": {
            "whc_id_not_null": F.col("whc_id").isNotNull(),
            "name_not_null": F.col("name").isNotNull(),
            "category_domain": _in_or_null("category", CATEGORIES),
        },
        "climate_events": {
            "event_date_not_null": F.col("event_date").isNotNull(),
            "source_domain": _in_or_null("source", CLIMATE_SOURCES),
        },
        "earthquake_events": {
            "usgs_id_not_null": F.col("usgs_id").isNotNull(),
            "magnitude_not_null": F.col("magnitude").isNotNull(),
            "event_time_not_null": F.col("event_time").isNotNull(),
        },
        "fire_events": {"acq_date_not_null": F.col("acq_date").isNotNull()},
        "risk_scores": {
            **{f"{c}_domain": _between01(c) for c in (*SCORE_COLUMNS, "composite_risk_score")},
            "risk_level_domain": _in_or_null("risk_level", RISK_LEVELS),
        },
    }
    keys = {
        "sites": ["whc_id"],
        "climate_events": ["site_id", "event_date", "source"],
        "earthquake_events": ["usgs_id"],
        "risk_scores": ["site_id"],
    }
    if table not in rules:
        raise ValueError(f"no rules for table {table}")
    return rules[table], keys.get(table, [])


def check_domains(df: DataFrame, table: str) -> DataFrame:
    """Violations per rule: (rule, violations). Row rules are one pass, uniqueness one grouped count."""
    rules, key = domain_rules(table)
    row = df.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()])
    checks = row.unpivot([], list(rules), "rule", "violations")
    if key:
        extra = df.groupBy(*key).agg((F.count(F.lit(1)) - 1).alias("extra"))
        checks = checks.unionByName(
            extra.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("violations")).select(
                F.lit(f"{'_'.join(key)}_unique").alias("rule"), "violations"
            )
        )
    return checks


def _check(df: DataFrame, name: str, value: Column, passed) -> DataFrame:
    out = df.agg(value.cast("double").alias("value"))
    return out.select(F.lit(name).alias("check"), "value", passed(F.col("value")).alias("passed"))


def pipeline_checks(
    sites: DataFrame,
    scores: DataFrame,
    hazards: dict[str, DataFrame],
    expected_sites: tuple[int, int] | None = None,
    max_level_share: float = 0.60,
) -> DataFrame:
    """Post-run checks as rows (check, value, passed)."""
    low, high = expected_sites or (1, 2**62)
    shares = scores.groupBy("risk_level").agg(F.count(F.lit(1)).alias("n"))
    rows = [
        _check(sites, "site_count", F.count(F.lit(1)), lambda v: v.between(low, high)),
        _check(sites, "invalid_geometries", F.count_if(~_valid_place()), lambda v: v == 0),
        _check(
            shares,
            "largest_level_share",
            F.coalesce(F.try_divide(F.max("n"), F.sum("n")), F.lit(0.0)),
            lambda v: v <= max_level_share,
        ),
    ]
    for name, hazard in hazards.items():
        unlinked = F.count_if(F.col("nearest_site_id").isNull())
        rows.append(_check(hazard, f"{name}_without_site", unlinked, lambda v: v == 0))
    return reduce(lambda a, b: a.unionByName(b), rows)
