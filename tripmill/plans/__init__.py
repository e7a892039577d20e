"""The operators put together: raw feeds to trips, and a month of trips into the table."""

from tripmill.plans.monthly import FEEDS, TRIP_SCHEMA, Feed, run_month, trip_table
from tripmill.plans.trips import MERGE_KEYS, TRIP_KEYS, conform_feeds, to_trips

__all__ = [
    "FEEDS",
    "MERGE_KEYS",
    "TRIP_KEYS",
    "TRIP_SCHEMA",
    "Feed",
    "conform_feeds",
    "run_month",
    "to_trips",
    "trip_table",
]
