"""ridemart: a Spark-first lakehouse for ride-booking analytics.

Raw bookings and weather readings go bronze -> silver -> a star schema (fact_trip, dim_date,
dim_zone) -> marts, saved queries, dashboard aggregates, data-quality reports and Spark ML
models. Every operator is a function from DataFrames to DataFrames built from Spark's own
expressions, so Catalyst plans, prunes and pushes down the whole chain.
"""

__version__ = "0.1.0"
