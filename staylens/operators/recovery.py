"""Listings that were never available before and are available now."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens import schemas
from staylens.functions import stay, text
from staylens.operators.lookup import skew_join

KEYS = ["search_area", "facility_id"]
# The accepted shapes of the two arguments.
AREA_SHAPE = re.compile(r"[\w\s\-,.]+")
TIMESTAMP_SHAPE = re.compile(r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}")


def check_area(area: str) -> str:
    if not AREA_SHAPE.fullmatch(area):
        raise ValueError(f"not a search area: {area!r}")
    return area


def check_timestamp(timestamp: str) -> str:
    if not TIMESTAMP_SHAPE.fullmatch(timestamp):
        raise ValueError(f"not a YYYY-MM-DDTHH:MM:SS timestamp: {timestamp!r}")
    return timestamp


def first_sightings(rows: DataFrame) -> DataFrame:
    """Per area and facility: first seen unavailable, first seen available, last seen.

    Fixed-width timestamps keep this a hash aggregation with partial results
    per task, so a hot facility costs one row per task in the shuffle.
    """
    at = F.col("scraped_at").try_cast("timestamp")
    keyed = rows.where("search_area IS NOT NULL AND facility_id IS NOT NULL")
    return keyed.groupBy(*KEYS).agg(
        F.min(F.when(~F.col("is_available"), at)).alias("first_unavailable_at"),
        F.min(F.when(F.col("is_available"), at)).alias("first_available_at"),
        F.max(at).alias("last_seen_at"),
    )


def merged(sightings: DataFrame) -> DataFrame:
    """Combine the sightings of several parts of the rows, which may overlap."""
    return sightings.groupBy(*KEYS).agg(
        F.min("first_unavailable_at").alias("first_unavailable_at"),
        F.min("first_available_at").alias("first_available_at"),
        F.max("last_seen_at").alias("last_seen_at"),
    )


def recovered(sightings: DataFrame) -> DataFrame:
    """Facilities whose first available scrape follows an unavailable one.

    "Never available on any earlier day, available now" holds exactly at that
    first available scrape, so no anti-join with past availability is needed.
    """
    return sightings.where("first_unavailable_at < first_available_at").select(
        *KEYS,
        F.col("first_unavailable_at").cast("date").cast("string").alias("first_unavailable_date"),
        F.col("first_available_at").alias("_at"),
    )


def alerts(rows: DataFrame, recoveries: DataFrame) -> DataFrame:
    """Every available row of a recovered facility's first available scrape."""
    nights = stay.num_nights(F.col("checkin_date"), F.col("checkout_date"))
    available = rows.where("is_available").select(
        *KEYS,
        F.col("scraped_at").try_cast("timestamp").alias("_at"),
        "name",
        "url",
        F.col("scraped_at").alias("recovered_at"),
        stay.price_per(F.col("total_price"), nights).alias("price_per_night"),
        "currency",
        "rating",
    )
    return skew_join(available, recoveries, [*KEYS, "_at"], "inner").select(*schemas.ALERT.names)


def availability_recovery(bronze: DataFrame, search_area: str, latest_scraped_at: str) -> DataFrame:
    """Alerts for one area at one scrape, as a lazy DataFrame."""
    area = text.sanitise_area(F.lit(check_area(search_area)))
    latest = F.lit(check_timestamp(latest_scraped_at))
    rows = bronze.where((F.col("search_area") == area) & (F.col("scraped_at") <= latest))
    return alerts_at(first_sightings(rows), rows, latest_scraped_at)


def alerts_at(sightings: DataFrame, rows: DataFrame, latest_scraped_at: str) -> DataFrame:
    """Alerts at one scrape. Sightings after it change nothing: what came first up to it is first overall."""
    latest = F.lit(check_timestamp(latest_scraped_at))
    found = recovered(sightings).where(F.col("_at") == latest.cast("timestamp"))
    return alerts(rows.where(F.col("scraped_at") == latest), found)


def availability_recovery_all_areas(bronze: DataFrame) -> DataFrame:
    """Alerts for every area at its own newest scrape, in one plan."""
    return newest_alerts(first_sightings(bronze), bronze)


def newest_alerts(sightings: DataFrame, rows: DataFrame) -> DataFrame:
    """Alerts at every area's newest scrape; ``rows`` holds at least those of it.

    The newest scrape per area comes from the per-facility aggregate, not from
    another pass over the observations: taking the maximum of whole sightings
    keeps both uses of the aggregate identical, so they share its shuffle.
    """
    latest = F.max(F.struct("last_seen_at", "first_unavailable_at", "first_available_at"))
    newest = sightings.groupBy("search_area").agg(latest["last_seen_at"].alias("_newest"))
    just_now = sightings.where("first_available_at = last_seen_at")
    found = skew_join(recovered(just_now), newest, ["search_area"], "inner")
    return alerts(rows, found.where("_at = _newest").drop("_newest"))


def alert_text() -> Column:
    """The message of an alert row."""
    price = F.when(
        F.col("price_per_night").isNotNull(),
        F.concat_ws(" ", F.col("price_per_night").cast("string"), F.coalesce("currency", F.lit("None"))),
    ).otherwise("price unknown")
    return F.format_string(
        "[ALERT] '%s' (id=%s) in %s is AVAILABLE again as of %s. Price: %s. URL: %s",
        F.coalesce("name", F.lit("None")),
        "facility_id",
        "search_area",
        "recovered_at",
        price,
        F.coalesce("url", F.lit("None")),
    )
