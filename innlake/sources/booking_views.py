"""Booking, listing and message views over the star-schema tables.

The views are projections of one table each, so reading them never shuffles
and only the referenced columns are scanned. Rates and cancellations depend on
the other columns plus noise from the order price, so models have something to
learn. The same definitions exist as SQL in innlake.plans.oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innlake.functions.sqltext import text
from innlake.operators.frames import END, START
from innlake.schemas import BOOKING_COLUMNS, LISTING_COLUMNS, MONTHLY_COLUMNS, MONTHS
from innlake.sources.messages import frame_rows

# Room between two months in the message log; far more than bookings a month.
MONTH_SPAN = 10 ** 13

_LEAD = "(o_orderkey * 37) % 444"
_ADULTS = "1 + o_orderkey % 3"
_ROOM = "(o_orderkey div 5) % 8"
_SPECIAL = "o_orderkey % 5"
_CANCELED = f"""
    cast(floor(o_totalprice) as bigint) % 100
    < 10 + if({_LEAD} > 220, 50, 0) + if({_SPECIAL} = 0, 30, 0)"""

_BOOKINGS = {
    "Booking_ID": "o_orderkey",
    "hotel": "if(o_custkey % 3 = 0, 'Resort Hotel', 'City Hotel')",
    "is_canceled": f"if({_CANCELED}, 1, 0)",
    "lead_time": _LEAD,
    "arrival_date_year": "year(o_orderdate)",
    "arrival_date_month": f"element_at(array({', '.join(map(text, MONTHS))}), month(o_orderdate))",
    "arrival_date_week_number": "weekofyear(o_orderdate)",
    "arrival_month": "cast(month(o_orderdate) as string)",
    "arrival_date_day_of_month": "day(o_orderdate)",
    "stays_in_weekend_nights": "(o_orderkey div 3) % 3",
    "stays_in_week_nights": "(o_orderkey div 9) % 6",
    "adults": _ADULTS,
    "children": "if(o_orderkey % 50 = 0, null, (o_orderkey div 7) % 3)",
    "babies": "if(o_orderkey % 17 = 0, 1, 0)",
    "meal": """case o_orderpriority when '1-URGENT' then 'BB' when '2-HIGH' then 'FB'
               when '3-MEDIUM' then 'HB' when '4-NOT SPECIFIED' then 'Undefined' else 'SC' end""",
    "country": """case when o_custkey % 40 = 0 then null when o_custkey % 41 = 0 then 'NA'
                  else element_at(array('PRT', 'GBR', 'FRA', 'ESP', 'DEU'), cast(o_custkey % 5 + 1 as int)) end""",
    "market_segment": """element_at(array('Aviation', 'Complementary', 'Corporate', 'Direct', 'Groups',
                         'Offline TA/TO', 'Online TA', 'Online TA', 'Undefined'), cast(o_custkey % 9 + 1 as int))""",
    "distribution_channel": "element_at(array('TA/TO', 'Direct', 'Corporate', 'GDS'), cast(o_custkey % 4 + 1 as int))",
    "is_repeated_guest": "if(o_orderkey % 10 = 0, 1, 0)",
    "previous_cancellations": "(o_orderkey div 2) % 2",
    "previous_bookings_not_canceled": "0",
    "reserved_room_type": f"char(65 + {_ROOM})",
    "assigned_room_type": "char(65 + (o_orderkey div 11) % 8)",
    "booking_changes": "o_orderkey % 4",
    "deposit_type": "if(o_orderkey % 13 = 0, 'Non Refund', 'No Deposit')",
    "agent": "if(o_custkey % 6 = 0, null, cast(o_custkey % 300 as string))",
    "company": "if(o_custkey % 10 = 0, cast(o_custkey % 50 as string), null)",
    "days_in_waiting_list": "if(o_orderkey % 25 = 0, o_orderkey % 90, 0)",
    "customer_type": "element_at(array('Transient', 'Contract', 'Transient-Party', 'Group'), cast(o_custkey % 4 + 1 as int))",
    "adr": f"""floor(2D * (50 * ({_ADULTS}) - 40 + 0.25D * ({_LEAD}) + 8 * ({_ROOM})
               + 4 * month(o_orderdate) + o_totalprice / 5000D)) / 2D""",
    "required_car_parking_spaces": "(o_orderkey div 13) % 4",
    "total_of_special_requests": _SPECIAL,
    "reservation_status": f"if({_CANCELED}, 'Canceled', 'Check-Out')",
    "reservation_status_date": "date_format(o_orderdate, 'yyyy-MM-dd')",
}

_LISTINGS = {
    "listing_id": "p_partkey", "host_id": "p_partkey % 97",
    "room_type": "element_at(array('Entire home/apt', 'Private room', 'Shared room'), p_size % 3 + 1)",
    "neighbourhood": "p_brand", "reviews": "p_size * 3",
    "overall_satisfaction": "(p_size % 11) / 2D",
    "accommodates": "if(p_partkey % 20 = 0, null, p_size % 14)",
    "bedrooms": "if(p_partkey % 30 = 0, null, p_size % 8)",
    "price": "p_retailprice",
    "minstay": "if(p_partkey % 40 = 0, null, p_size % 7)",
    "latitude": "38.5D + (p_partkey % 100) / 1000D",
    "longitude": "-9.5D + (p_partkey % 90) / 1000D",
    "date": "date_add(date'2017-01-01', cast(p_partkey % 365 as int))",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(df: DataFrame, definitions: dict[str, str], types: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[
        f"cast({sql} as {types[name]}) as {name}" for name, sql in definitions.items()
    ])


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Historical bookings, one per order."""
    return _view(read_table(spark, sf_dir, "orders"), _BOOKINGS, BOOKING_COLUMNS)


def monthly_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same bookings in the layout of the monthly feed ('INN...' ids)."""
    number = "concat('INN', lpad(cast(Booking_ID as string), greatest(12, length(Booking_ID)), '0'))"
    return (bookings(spark, sf_dir).withColumn("Booking_ID", F.expr(number))
            .select(*MONTHLY_COLUMNS))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(read_table(spark, sf_dir, "part"), _LISTINGS, LISTING_COLUMNS)


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a four-partition log where signups start and purchases end a
    frame; event ids follow the event time and serve as offsets."""
    return read_table(spark, sf_dir, "events").select(
        F.lit("events").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.when(F.col("event_type") == "signup", START)
        .when(F.col("event_type") == "purchase", END)
        .otherwise(F.col("event_type")).alias("value"),
    )


def booking_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly feed as messages: per month START, header, rows, END.

    Months alternate between two log partitions. Offsets come from the month
    and the booking number; every other one is free.
    """
    feed = monthly_bookings(spark, sf_dir)
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.col("arrival_date_month"))
    numbered = feed.withColumns({
        "feed_month": (F.col("arrival_date_year") * 12 + month - 1).cast("bigint"),
        "feed_number": F.expr("cast(substring(Booking_ID, 4) as bigint)"),
    })
    return frame_rows(numbered, feed.columns, "feed_month", "feed_number").select(
        F.lit("bookings").alias("topic"),
        (F.col("group") % 2).cast("int").alias("partition"),
        (F.col("group") * MONTH_SPAN + 2 * (F.col("position") + 2)).alias("offset"),
        "value",
    )


def booking_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text lines of the monthly files, headers included."""
    return booking_messages(spark, sf_dir).filter(~F.col("value").isin(START, END)).select("value")
