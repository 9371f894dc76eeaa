"""Bronze to silver: newest scrape per stay, price metrics, score, distance, key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens import schemas
from staylens.functions import geo, stay, text
from staylens.operators.coerce import align_to
from staylens.operators.lookup import skew_join
from staylens.operators.pick import latest_located_facility, latest_per, name_if_unknown, with_packed, with_unpacked
from staylens.operators.scale import with_min_max_scaled

# Most selective first: the sort behind the aggregation compares this prefix.
STAY_KEYS = ["facility_id", "checkin_date", "checkout_date", "city", "country", "_name_key"]


def newest_stays(bronze: DataFrame, *carried: str) -> DataFrame:
    """Newest scrape per (city, country, facility, check-in, check-out).

    Only ``carried`` columns travel through the shuffle, never the page text.
    """
    observed = bronze.select(
        text.city_of(F.col("search_area")).alias("city"),
        text.country_of(F.col("search_area")).alias("country"),
        "facility_id",
        name_if_unknown(F.col("facility_id"), F.col("name")).alias("_name_key"),
        "checkin_date",
        "checkout_date",
        F.col("scrape_date").cast("date").alias("scrape_date"),
        "scraped_at",
        *carried,
    )
    return latest_per(observed, STAY_KEYS, ["scrape_date", "scraped_at"])


def with_price_metrics(stays: DataFrame, rating: Column) -> DataFrame:
    """Add nights, the three price metrics and the raw quality/price score."""
    nights, adults, total = F.col("num_nights"), F.col("num_adults"), F.col("total_price")
    return (
        stays.withColumn("rating", rating)
        .withColumn("num_nights", stay.num_nights(F.col("checkin_date"), F.col("checkout_date")))
        .withColumns(
            {
                "price_per_night": stay.price_per(total, nights),
                "price_per_adult": stay.price_per(total, adults),
                "price_per_adult_per_night": stay.price_per(total, adults * nights),
            }
        )
        .withColumn(
            "quality_price_score",
            stay.quality_per_price(F.col("rating"), F.col("price_per_adult_per_night")),
        )
    )


def _finish(scored: DataFrame, tag: str, currencies: dict[str, str]) -> DataFrame:
    named = scored.withColumns(
        {
            "currency": stay.currency_code(F.col("currency"), currencies),
            "_pk": stay.surrogate_key(
                tag,
                F.col("city"),
                F.col("country"),
                F.col("facility_id"),
                F.col("checkin_date"),
                F.col("checkout_date"),
                F.col("scrape_date"),
            ),
            "_source": F.lit(tag),
        }
    )
    return align_to(named, schemas.SILVER)


def booking_silver(bronze: DataFrame) -> DataFrame:
    """The 24 silver columns for Booking search results."""
    stays = newest_stays(
        bronze,
        "url",
        "name",
        "accommodation_type",
        "neighbourhood",
        "distance_from_center_km",
        "num_adults",
        "currency",
        "total_price",
        "rating",
        "num_reviews",
        "num_rooms_available",
        "is_available",
    )
    scored = with_min_max_scaled(
        with_price_metrics(stays, F.col("rating")), "quality_price_score"
    )
    return _finish(scored, "BOOK", stay.BOOKING_SILVER_CURRENCIES)


def with_distance(
    stays: DataFrame, facilities: DataFrame, city_centres: DataFrame, bronze: DataFrame
) -> DataFrame:
    """Add km to the city centre, preferring the facility page's coordinates.

    What a stay shows travels to the lookup as one text. ``bronze`` is what ``stays`` was reduced from: its listing counts bound theirs.
    """
    precise = latest_located_facility(facilities).select(
        "facility_id",
        F.col("latitude").alias("_lat"),
        F.col("longitude").alias("_lon"),
    )
    # The keys stay columns: a condition on one is moved below the lookup, and would have to take the texts apart twice.
    shown = [f.name for f in stays.schema.fields if f.dataType == T.StringType() and f.name not in STAY_KEYS]
    groups = {"_shown": shown} if len(shown) > 1 else {}
    placed = with_unpacked(skew_join(with_packed(stays, groups), precise, ["facility_id"]), groups)
    centred = skew_join(placed, city_centres, ["city", "country"])
    return centred.withColumn(
        "distance_from_center_km",
        geo.haversine_km(
            F.coalesce("_lat", "latitude"),
            F.coalesce("_lon", "longitude"),
            F.col("centre_lat"),
            F.col("centre_lon"),
        ),
    )


def airbnb_silver(bronze: DataFrame, facilities: DataFrame, city_centres: DataFrame) -> DataFrame:
    """The 24 silver columns for Airbnb search results.

    Ratings are doubled to the 0-10 scale; the two lookups run after the
    de-duplication, which neither of them can change. The price metrics follow
    the lookups, so that their numbers do not travel through the lookups' shuffle.
    """
    stays = newest_stays(
        bronze,
        "url",
        "name",
        "accommodation_type",
        "neighbourhood",
        "latitude",
        "longitude",
        "num_adults",
        "currency",
        "total_price",
        "rating",
        "num_reviews",
        "is_available",
    ).drop("scraped_at", "_name_key")
    rating = F.col("rating") * 2.0
    scored = with_min_max_scaled(
        with_price_metrics(with_distance(stays, facilities, city_centres, bronze), rating),
        "quality_price_score",
        over=with_price_metrics(stays, rating),
    )
    return _finish(scored, "ABNB", stay.AIRBNB_SILVER_CURRENCIES)


def cities(bronze: DataFrame) -> DataFrame:
    """Distinct (city, country) pairs, the keys a centre table must cover."""
    return bronze.select(
        text.city_of(F.col("search_area")).alias("city"),
        text.country_of(F.col("search_area")).alias("country"),
    ).distinct()


def silver_union(booking: DataFrame, airbnb: DataFrame) -> DataFrame:
    """Both sources under the shared schema."""
    return booking.unionByName(airbnb)
