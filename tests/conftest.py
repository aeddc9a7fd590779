import pytest

from innlake.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", 4, "4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session


def booking_row(**changes):
    """One historical booking with plain values."""
    row = {
        "Booking_ID": 1, "hotel": "City Hotel", "is_canceled": 0, "lead_time": 10,
        "arrival_date_year": 2016, "arrival_date_month": "July", "arrival_date_week_number": 27,
        "arrival_month": "7", "arrival_date_day_of_month": 1, "stays_in_weekend_nights": 1,
        "stays_in_week_nights": 2, "adults": 2, "children": 0, "babies": 0, "meal": "BB",
        "country": "PRT", "market_segment": "Direct", "distribution_channel": "Direct",
        "is_repeated_guest": 0, "previous_cancellations": 0, "previous_bookings_not_canceled": 0,
        "reserved_room_type": "A", "assigned_room_type": "A", "booking_changes": 0,
        "deposit_type": "No Deposit", "agent": None, "company": None, "days_in_waiting_list": 0,
        "customer_type": "Transient", "adr": 100.0, "required_car_parking_spaces": 0,
        "total_of_special_requests": 0, "reservation_status": "Check-Out",
        "reservation_status_date": "2016-07-03",
    }
    return {**row, **changes}


def frame(spark, rows, schema):
    return spark.createDataFrame([tuple(r[f.name] for f in schema) for r in rows], schema)
