import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ridemart.session import get_spark
    s = get_spark(master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


def booking_row(**kw):
    """A raw booking line (all strings) with sensible defaults."""
    from ridemart.sources.schemas import BOOKING_RAW_COLUMNS
    base = {
        "Booking ID": "B1", "Source": "completed", "Pickup Due": "16/08/2025 09:00",
        "Time Dispatched": "16/08/2025 08:50", "Time Vehicle Arrived": "16/08/2025 08:58",
        "Time Picked Up": "16/08/2025 09:05", "Completed": "16/08/2025 09:17",
        "Driver": "D1", "Vehicle": "V1", "Payment Type": "cash", "Priority": "1",
        "Capabilities": "A", "Booking source": "app", "Price": "12.50", "Distance": "3.2",
        "Pickup Zone": "Air37", "Destination Zone": "Ald44", "Pickup Latitude": "55.03",
        "Pickup Longitude": "-7.16", "Destination Latitude": "54.65",
        "Destination Longitude": "-6.20", "Booked by": "op1",
    }
    base.update(kw)
    return tuple(base[c] for c in BOOKING_RAW_COLUMNS)


def bronze_df(spark, rows):
    from ridemart.sources.schemas import BOOKING_RAW_SCHEMA
    return spark.createDataFrame(rows, BOOKING_RAW_SCHEMA)
