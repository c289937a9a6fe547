"""The registered queries over the TPC-H style tables, each with its SQL counterpart where one exists."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewarden.constants import PLACES_MAX_ROWS, RISK_LEVELS, SCORE_COLUMNS
from sitewarden.operators.filters import coalesce_scores
from sitewarden.operators.isolation import attach_anomalies, isolation_forest
from sitewarden.plans import fixtures
from sitewarden.plans.scoring import risk_scores
from sitewarden.session import fits, new_path, resolve_strategy, stage

SCORES = list(SCORE_COLUMNS)

_stored: dict[tuple[str, str, str], str] = {}


class Tables:
    """Domain tables of one data folder, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def sites(self) -> DataFrame:
        return fixtures.sites(self.spark, self.sf_dir)

    @cached_property
    def strategy(self) -> str:
        return resolve_strategy(self.sites)

    @cached_property
    def quakes(self) -> DataFrame:
        return fixtures.quakes(self.spark, self.sf_dir)

    @cached_property
    def fires(self) -> DataFrame:
        return fixtures.fires(self.spark, self.sf_dir)

    @cached_property
    def floods(self) -> DataFrame:
        return fixtures.floods(self.spark, self.sf_dir)

    @cached_property
    def hazards(self) -> DataFrame:
        return fixtures.hazards(self.spark, self.sf_dir)

    @cached_property
    def climate(self) -> DataFrame:
        return fixtures.climate(self.spark, self.sf_dir)

    @cached_property
    def urban_raw(self) -> DataFrame:
        return fixtures.urban_raw(self.spark, self.sf_dir)

    @cached_property
    def urban(self) -> DataFrame:
        # a site's place is three numbers; a feature's shape should not move for them, nor gather with all others of its site
        strategy = "broadcast" if self.strategy == "broadcast" or fits(self.sites, PLACES_MAX_ROWS) else "shuffle"
        return fixtures.urban(self.spark, self.sf_dir, strategy)

    def compute_scores(self) -> DataFrame:
        return risk_scores(
            self.sites, self.urban, self.climate, self.quakes, self.fires, self.floods, strategy=self.strategy
        )

    def _stored_table(self, name: str, compute: Callable[[], DataFrame]) -> DataFrame:
        """A table that is computed once per session and data folder, then read back."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _stored:
            path = new_path(self.spark, name)
            compute().write.parquet(path)
            _stored[key] = path
        return self.spark.read.parquet(_stored[key])

    @cached_property
    def scores(self) -> DataFrame:
        """The stored risk_scores table."""
        return self._stored_table("risk_scores", self.compute_scores)

    @cached_property
    def flagged(self) -> DataFrame:
        """Stored scores with the forest's score and flag."""
        return self._stored_table("flagged_scores", lambda: attach_anomalies(self.scores, isolation_forest(self.scores)))

    @cached_property
    def view(self) -> DataFrame:
        """Sites joined with the flagged scores."""
        return coalesce_scores(self.sites.drop("coastal_risk_score").join(self.flagged, "site_id"))

    def landed(self, df: DataFrame, name: str, fmt: str, **options) -> str:
        """Write `df` as a raw feed and return its path."""
        path = new_path(self.spark, name)
        df.write.format(fmt).options(**options).save(path)
        return path

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        return stage(df, name)


Query = Callable[[Tables], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register a query and its SQL."""

    def add(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn

    return add


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round float columns for comparison; adding 0.0 removes negative zero."""
    return df.withColumns({c: F.round(F.col(c), digits) + 0.0 for c in columns})


def texts(df: DataFrame, *columns: str, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Dates and timestamps as text."""
    return df.withColumns({c: F.date_format(c, fmt) for c in columns})


LEVELS = list(RISK_LEVELS)


def callable_of(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Tables(spark, sf_dir))

    return run


def load_all() -> None:
    """Import the query modules, which register themselves."""
    from sitewarden.plans import (  # noqa: F401
        queries_model,
        queries_report,
        queries_scalar,
        queries_source,
        queries_spatial,
        queries_table,
    )
