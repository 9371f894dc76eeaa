"""The analyst questions asked of the lake, as DataFrame plans.

Sorted answers break ties by further columns: the order is repeatable, and rows
that share one score (or have none) spread over several sort ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions import stay
from staylens.operators.scale import with_min_max_scaled


def facility_detail_for_city(silver: DataFrame, facilities: DataFrame, city: str | None = None) -> DataFrame:
    """Silver stays with every detail scrape of their facility.

    A facility scraped several times repeats its stays, as the question asks.
    Both inputs are shuffled directly into the join, so adaptive execution can
    split a hot facility on either side. Listings without an id have no detail page:
    their common placeholder joins nothing.
    """
    silver = silver.where("facility_id <> 'unknown'")
    stays = silver if city is None else silver.where(F.col("city") == city)
    detail = facilities.select(
        "facility_id",
        "num_bedrooms",
        "num_guests",
        "is_superhost",
        "amenity_pool",
        "amenity_wifi",
        "cancellation_policy",
    )
    narrow = stays.select(
        "facility_id",
        "city",
        "total_price",
        "price_per_night",
        F.col("rating").alias("search_rating"),
    )
    return narrow.join(detail, "facility_id").select(
        "facility_id",
        "city",
        "total_price",
        "price_per_night",
        "search_rating",
        "num_bedrooms",
        "num_guests",
        "is_superhost",
        "amenity_pool",
        "amenity_wifi",
        "cancellation_policy",
    )


def bargains(silver: DataFrame, below: float = 50.0) -> DataFrame:
    """Cheap stays per adult and night, best quality for money first."""
    return silver.where(F.col("price_per_adult_per_night") < below).orderBy(
        F.col("quality_price_score").desc_nulls_last(), "_pk"
    )


def best_near_centre(
    silver: DataFrame, city: str, below: float = 50.0, min_score: float = 0.7
) -> DataFrame:
    """Available, cheap and well-scored stays of a city, closest first.

    The score is scaled over the whole table, so the filters come after it.
    """
    return silver.where(
        (F.col("city") == city)
        & F.col("is_available")
        & (F.col("price_per_adult_per_night") < below)
        & (F.col("quality_price_score") > min_score)
    ).orderBy(F.col("distance_from_center_km").asc_nulls_last(), "_pk")


def _per(units: Column) -> Column:
    return stay.price_per(F.col("total_price"), units)


def with_observed_prices(bronze: DataFrame) -> DataFrame:
    """Bronze rows with nights and per-night / per-person prices, NULL for zero units."""
    nights, adults = F.col("num_nights"), F.col("num_adults")
    return bronze.withColumn(
        "num_nights", stay.num_nights(F.col("checkin_date"), F.col("checkout_date"))
    ).withColumns(
        {
            "price_per_night": _per(nights),
            "price_per_person": _per(adults),
            "price_per_night_per_person": _per(nights * adults),
        }
    )


def country_scores(bronze: DataFrame, country: str) -> DataFrame:
    """Quality for money of all observations of a country, scaled to 0..1."""
    local = bronze.where(F.col("search_area").like(f"%{country}"))
    rated = (
        with_observed_prices(local)
        .withColumn(
            "quality_score",
            stay.round_places(
                stay.quality_per_price(F.col("rating"), F.col("price_per_night_per_person")), 2
            ),
        )
        .where("quality_score IS NOT NULL")
        .select(
            "name",
            "search_area",
            "total_price",
            "price_per_night",
            "price_per_person",
            "price_per_night_per_person",
            "rating",
            "quality_score",
            "num_reviews",
            "distance_from_center_km",
            "num_rooms_available",
            "neighbourhood",
            "accommodation_type",
            "tags",
        )
    )
    return with_min_max_scaled(rated, "quality_score").orderBy(
        F.col("quality_score").desc_nulls_last(), "search_area", "name", "total_price"
    )


def affordable(bronze: DataFrame, at_most: float = 80.0) -> DataFrame:
    """Observations up to a price per person and night."""
    return (
        with_observed_prices(bronze)
        .where(F.col("price_per_night_per_person") <= at_most)
        .select(
            "facility_id",
            "name",
            "currency",
            "search_area",
            "neighbourhood",
            "accommodation_type",
            "tags",
            "distance_from_center_km",
            "num_nights",
            "total_price",
            "price_per_night",
            "price_per_person",
            "price_per_night_per_person",
            "url",
        )
    )


def cheapest_available(bronze: DataFrame, search_area: str) -> DataFrame:
    """Available listings of an area by price per night."""
    return (
        with_observed_prices(
            bronze.where((F.col("search_area") == search_area) & F.col("is_available"))
        )
        .select("name", "price_per_night", "rating")
        .orderBy(F.col("price_per_night").asc_nulls_last(), "name", "rating")
    )
