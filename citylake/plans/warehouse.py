"""The whole model graph over one set of inputs, built lazily.

``Warehouse`` wires sources -> silver -> dims -> facts -> aggregate for either the
reference-shaped bronze tables or the driver-table fixtures (``from_testdata``).
Each property is a DataFrame plan; nothing runs until an action. Dimensions are
built once per instance so their size checks run once.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from citylake.config import Rules
from citylake.plans import dims, facts, silver
from citylake.sources import fixtures
from citylake.sources.seeds import seed

# Rules used with the driver fixtures: the fixture zones use region names as boroughs,
# the audit timestamp is fixed so results can be compared, and float sums are made
# independent of addition order (inputs have at most two decimals).
FIXTURE_RUN_TS = _dt.datetime(2024, 3, 1, 0, 0, 0)
FIXTURE_RULES = Rules(core_borough=fixtures.FIXTURE_CORE_BOROUGH, run_ts=FIXTURE_RUN_TS, sum_scale=2)


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        raw_trips: DataFrame,
        raw_weather: DataFrame,
        raw_zones: DataFrame,
        rules: Rules = Rules(),
        emission_factors: DataFrame | None = None,
        calendar: DataFrame | None = None,
    ):
        self.spark = spark
        self.raw_trips = raw_trips
        self.raw_weather = raw_weather
        self.raw_zones = raw_zones
        self.rules = rules
        self._ef = emission_factors
        self._calendar = calendar

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, rules: Rules = FIXTURE_RULES) -> "Warehouse":
        events = fixtures.table(spark, sf_dir, "events")
        return cls(
            spark,
            raw_trips=fixtures.trips_from_events(events),
            raw_weather=fixtures.weather_from_events(events),
            raw_zones=fixtures.zones_from_nations(
                fixtures.table(spark, sf_dir, "nation"), fixtures.table(spark, sf_dir, "region")
            ),
            rules=rules,
        )

    def between(self, start: str, end: str) -> "Warehouse":
        """The same models over the trips picked up in [start, end): the range reaches the raw scan.
        All copies of a trip share its pickup time, so deduplication sees all of them."""
        raw = silver.picked_up_between(self.raw_trips, start, end, self.rules)
        return Warehouse(self.spark, raw, self.raw_weather, self.raw_zones, self.rules, self._ef, self._calendar)

    # ------------------------------------------------------------ seeds and dims
    @cached_property
    def emission_factors(self) -> DataFrame:
        return self._ef if self._ef is not None else seed(self.spark, "seed_emission_factors")

    @cached_property
    def calendar(self) -> DataFrame:
        return self._calendar if self._calendar is not None else dims.dim_calendar(self.spark, self.rules)

    @cached_property
    def weather(self) -> DataFrame:
        return silver.stg_weather_hourly(self.raw_weather, self.rules)

    @cached_property
    def zones(self) -> DataFrame:
        return silver.stg_zone_lookup(self.raw_zones, self.rules)

    @cached_property
    def dim_zones(self) -> DataFrame:
        return dims.dim_zones(self.zones, self.rules)

    @cached_property
    def dim_weather_lookup(self) -> DataFrame:
        return dims.dim_weather_lookup(self.weather)

    @cached_property
    def dim_vendors(self) -> DataFrame:
        return dims.dim_vendors(self.spark, self.rules)

    @cached_property
    def dim_rate_codes(self) -> DataFrame:
        return dims.dim_rate_codes(self.spark, self.rules)

    @cached_property
    def dim_payment_types(self) -> DataFrame:
        return dims.dim_payment_types(self.spark, self.rules)

    # ------------------------------------------------------------ silver
    @cached_property
    def latest_trips(self) -> DataFrame:
        return silver.latest_trips(self.raw_trips, self.rules)

    @cached_property
    def stg_trips(self) -> DataFrame:
        return silver.stg_taxi_trips(self.raw_trips, self.emission_factors, self.rules)

    # ------------------------------------------------------------ gold
    @cached_property
    def fact_trips(self) -> DataFrame:
        return facts.gold_fact_trips(self.stg_trips, self.weather, self.zones, self.calendar, self.rules)

    @cached_property
    def fact_trips_with_code(self) -> DataFrame:
        return facts.gold_fact_trips(
            self.stg_trips, self.weather, self.zones, self.calendar, self.rules, with_weather_code=True
        )

    @cached_property
    def fact_financials(self) -> DataFrame:
        return facts.gold_fact_financials(self.stg_trips, self.rules)

    @cached_property
    def fact_sustainability(self) -> DataFrame:
        return facts.gold_fact_sustainability(self.stg_trips, self.rules)

    @cached_property
    def agg_demand_weather(self) -> DataFrame:
        return facts.gold_agg_demand_weather(self.fact_trips, self.rules)

    @cached_property
    def fact_trips_labeled(self) -> DataFrame:
        return facts.fact_trips_labeled(
            self.fact_trips_with_code,
            self.dim_vendors,
            self.dim_rate_codes,
            self.dim_payment_types,
            self.dim_zones,
            self.dim_weather_lookup,
            self.rules,
        )
