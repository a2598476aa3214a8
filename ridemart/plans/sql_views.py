"""SQL entry point (SNK7, section 3.2 of the survey): gold tables as temp views, questions put to them as
measures by keys, and the feature view by name."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ridemart.operators import features
from ridemart.plans.warehouse import Warehouse

#: Dimension tables with the fact's key and their own.
LINKS = {"dim_date": ("trip_booked_for_date_key", "date_key"), "dim_zone": ("pickup_zone_key", "zone_key")}


@dataclass(frozen=True)
class Question:
    """Measures of the trips by keys, both SQL expressions by their alias, over the fact and one dimension."""
    dimension: str
    keys: dict[str, str]
    measures: dict[str, str]
    where: str = "true"
    order: list[str] = field(default_factory=list)
    top: int | None = None
    digits: dict[str, int] = field(default_factory=dict)

    def sql(self, views: dict[str, str]) -> str:
        fk, pk = LINKS[self.dimension]
        columns = [f"{e} AS {a}" for a, e in (self.keys | self.measures).items()]
        inner = (f"SELECT {', '.join(columns)} FROM {views['fact_trip']} JOIN {views[self.dimension]} ON {fk} = {pk} "
                 f"WHERE {self.where} GROUP BY ALL")
        if self.order:
            inner += f" ORDER BY {', '.join(self.order)}"
        if self.top is not None:
            inner += f" LIMIT {self.top}"
        shown = [f"round({a}, {self.digits[a]}) AS {a}" if a in self.digits else a for a in self.keys | self.measures]
        # rounding comes after the cut, so that it never decides it
        return f"SELECT {', '.join(shown)} FROM ({inner})"


REVENUE, TRIPS = "sum(fare_amount)", "count(trip_key)"
WAIT = "expected_vs_actual_pickup_minutes_difference"
QUESTIONS = {
    "monthly_revenue": Question("dim_date", {"year": "year", "month_name": "month_name", "month": "month"},
                                {"total_revenue": REVENUE, "total_trips": TRIPS}, order=["year", "month"],
                                digits={"total_revenue": 2}),
    "trips_per_hour_weekday": Question("dim_date", {"pickup_hour": "hour(pickup_due_timestamp)", "day_name": "day_name"},
                                       {"num_trips": "count(*)"}, order=["num_trips DESC", "pickup_hour", "day_name"]),
    "revenue_by_zone_payment": Question("dim_zone", {"zone_code": "zone_code", "payment_type": "payment_type"},
                                        {"revenue": REVENUE}, order=["revenue DESC", "zone_code", "payment_type"],
                                        digits={"revenue": 2}),
    "top_zones": Question("dim_zone", {"pickup_zone": "zone_code"}, {"trips": TRIPS, "revenue": REVENUE},
                          order=["revenue DESC", "pickup_zone"], top=15, digits={"revenue": 2}),
    "wait_by_weekday": Question("dim_date", {"day_name": "day_name"},
                                {"avg_wait_min": f"avg({WAIT})", "avg_trip_duration": "avg(trip_duration_minutes)"},
                                where=f"{WAIT} IS NOT NULL", digits={"avg_wait_min": 2, "avg_trip_duration": 2}),
}


def register_views(wh: Warehouse, prefix: str = "rm_") -> dict[str, str]:
    """Register the built tables as temp views; returns table -> view name."""
    for t in wh.tables:
        wh.read(t).createOrReplaceTempView(f"{prefix}{t}")
    return {t: f"{prefix}{t}" for t in wh.tables}


def saved_question(wh: Warehouse, name: str) -> DataFrame:
    return wh.spark.sql(QUESTIONS[name].sql(register_views(wh)))


def feature_view(wh: Warehouse, view: str = "ml_trip_features_view") -> DataFrame:
    """SNK7: create or replace the feature view and read it back by name."""
    features.trip_features_view(wh["fact_trip"], wh["dim_date"], wh["dim_zone"]).createOrReplaceTempView(view)
    return wh.spark.table(view)
