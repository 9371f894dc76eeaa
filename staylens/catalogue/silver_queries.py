"""Silver tables, their building blocks and the analyst questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from staylens import schemas
from staylens.catalogue import tables as t
from staylens.functions import geo, stay, text
from staylens.operators import lookup, pick, scale
from staylens.operators.coerce import align_to
from staylens.plans import analyst, silver

# --- comparison SQL --------------------------------------------------------

_KEYS = "city, country, facility_id, name_key, checkin_date, checkout_date"


def _newest(columns: str) -> str:
    order = ", ".join(f"{c.strip()} DESC NULLS LAST" for c in columns.split(","))
    return (
        f"QUALIFY row_number() OVER (PARTITION BY {_KEYS} "
        f"ORDER BY scrape_date DESC, scraped_at DESC, {order}) = 1"
    )


_BOOKING_CARRIED = (
    "url, name, accommodation_type, neighbourhood, distance_from_center_km, num_adults, currency, "
    "total_price, rating, num_reviews, num_rooms_available, is_available"
)
_AIRBNB_CARRIED = (
    "url, name, accommodation_type, neighbourhood, latitude, longitude, num_adults, currency, "
    "total_price, rating, num_reviews, is_available"
)
_PRICES = """
    round(total_price / nullif(num_nights, 0), 2) AS price_per_night,
    round(total_price / nullif(num_adults, 0), 2) AS price_per_adult,
    round(total_price / nullif(num_adults * num_nights, 0), 2) AS price_per_adult_per_night"""


def _pk(tag: str) -> str:
    return (
        f"'{tag}/' || replace(lower(city), ' ', '_') || replace(upper(country), ' ', '_') || '/' || "
        "replace(lower(facility_id), '-', '_') || '/' || replace(checkin_date, '-', '') || '_' || "
        "replace(checkout_date, '-', '') || '/' || replace(CAST(scrape_date AS VARCHAR), '-', '')"
    )


_SCALED = (
    "(score - min(score) OVER ()) / nullif(max(score) OVER () - min(score) OVER (), 0)"
)

_BOOKING_CTES = f"""{t.SQL['booking']},
stays AS (SELECT * FROM booking {_newest(_BOOKING_CARRIED)}),
priced AS (SELECT *, {_PRICES} FROM stays),
scored AS (SELECT *, rating / nullif(price_per_adult_per_night, 0) AS score FROM priced),
booking_silver AS (SELECT facility_id, url, name, accommodation_type, city, country, neighbourhood,
  distance_from_center_km, checkin_date, checkout_date, num_nights, num_adults,
  CASE currency WHEN '€' THEN 'EUR' WHEN '$' THEN 'USD' ELSE currency END AS currency,
  total_price, price_per_night, price_per_adult, price_per_adult_per_night, rating,
  {_SCALED} AS quality_price_score, num_reviews, num_rooms_available, is_available,
  {_pk('BOOK')} AS _pk, 'BOOK' AS _source FROM scored)"""

_LOCATED = """located AS (SELECT facility_id, latitude, longitude FROM facility
  WHERE latitude IS NOT NULL AND longitude IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY facility_id
    ORDER BY scraped_at DESC, latitude DESC, longitude DESC) = 1)"""
_DISTANCE = """round(2.0 * 6371.0 * asin(sqrt(
    power(sin(radians(lat - centre_lat) / 2.0), 2)
    + cos(radians(centre_lat)) * cos(radians(lat)) * power(sin(radians(lon - centre_lon) / 2.0), 2))), 3)"""

_AIRBNB_CTES = f"""{t.SQL['airbnb']}, {t.SQL['facility']}, {t.SQL['centres']}, {_LOCATED},
a_stays AS (SELECT * REPLACE (rating * 2.0 AS rating) FROM (SELECT * FROM airbnb {_newest(_AIRBNB_CARRIED)})),
a_priced AS (SELECT *, {_PRICES} FROM a_stays),
a_scored AS (SELECT *, rating / nullif(price_per_adult_per_night, 0) AS score FROM a_priced),
a_placed AS (SELECT a_scored.*, coalesce(located.latitude, a_scored.latitude) AS lat,
    coalesce(located.longitude, a_scored.longitude) AS lon, centre_lat, centre_lon
  FROM a_scored LEFT JOIN located USING (facility_id)
  LEFT JOIN centres ON a_scored.city = centres.city AND a_scored.country = centres.country),
airbnb_silver AS (SELECT facility_id, url, name, accommodation_type, city, country, neighbourhood,
  {_DISTANCE} AS distance_from_center_km, checkin_date, checkout_date, num_nights, num_adults,
  CASE currency WHEN '€' THEN 'EUR' WHEN '$' THEN 'USD' WHEN '£' THEN 'GBP' ELSE currency END AS currency,
  total_price, price_per_night, price_per_adult, price_per_adult_per_night, rating,
  {_SCALED} AS quality_price_score, num_reviews, CAST(NULL AS BIGINT) AS num_rooms_available, is_available,
  {_pk('ABNB')} AS _pk, 'ABNB' AS _source FROM a_placed)"""

_OBSERVED_PRICES = """
    round(total_price / nullif(num_nights, 0), 2) AS price_per_night,
    round(total_price / nullif(num_adults, 0), 2) AS price_per_person,
    round(total_price / nullif(num_nights * num_adults, 0), 2) AS price_per_night_per_person"""


# --- Spark side ------------------------------------------------------------


def booking_silver(spark, sf_dir):
    return silver.booking_silver(t.booking_bronze(spark, sf_dir))


def airbnb_silver(spark, sf_dir):
    return silver.airbnb_silver(
        t.airbnb_bronze(spark, sf_dir),
        t.facility_bronze(spark, sf_dir),
        t.city_centres(spark, sf_dir),
    )


def silver_union(spark, sf_dir):
    return silver.silver_union(booking_silver(spark, sf_dir), airbnb_silver(spark, sf_dir))


def dedup_latest(spark, sf_dir):
    stays = silver.newest_stays(t.booking_bronze(spark, sf_dir), "num_adults", "total_price")
    return stays.select(
        "city",
        "country",
        "facility_id",
        "checkin_date",
        "checkout_date",
        F.col("scrape_date").cast("string").alias("scrape_date"),
        "scraped_at",
        "num_adults",
        "total_price",
    )


def price_metrics(spark, sf_dir):
    priced = silver.with_price_metrics(t.booking_bronze(spark, sf_dir), F.col("rating"))
    return priced.select(
        "facility_id",
        "scraped_at",
        "num_nights",
        "price_per_night",
        "price_per_adult",
        "price_per_adult_per_night",
        F.col("quality_price_score").alias("raw_score"),
    )


def minmax_score(spark, sf_dir):
    rows = t.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("score")
    )
    return scale.with_min_max_scaled(rows, "score")


def haversine_centre(spark, sf_dir):
    placed = t.airbnb_bronze(spark, sf_dir).select(
        "facility_id",
        "latitude",
        "longitude",
        text.city_of(F.col("search_area")).alias("city"),
        text.country_of(F.col("search_area")).alias("country"),
    )
    centred = lookup.skew_join(placed, t.city_centres(spark, sf_dir), ["city", "country"])
    return centred.select(
        "facility_id",
        "city",
        geo.haversine_km(
            F.col("latitude"), F.col("longitude"), F.col("centre_lat"), F.col("centre_lon")
        ).alias("distance_km"),
    )


def latest_located_facility(spark, sf_dir):
    return pick.latest_located_facility(t.facility_bronze(spark, sf_dir))


def located_listings(spark, sf_dir):
    listings = t.airbnb_bronze(spark, sf_dir).select("facility_id", "scraped_at", "num_adults")
    located = pick.latest_located_facility(t.facility_bronze(spark, sf_dir))
    return lookup.skew_join(listings, located, ["facility_id"])


def hot_listing_lookup(spark, sf_dir):
    """Located listings where one listing holds a third of all observations."""
    third = F.col("l_orderkey") % 3 == 0
    listings = t.table(spark, sf_dir, "lineitem").select(
        F.when(third, "P-1").otherwise(F.concat(F.lit("P-"), "l_partkey")).alias("facility_id"), "l_orderkey", "l_linenumber"
    )
    located = pick.latest_located_facility(t.facility_bronze(spark, sf_dir))
    return lookup.skew_join(listings, located, ["facility_id"])


def surrogate_key(spark, sf_dir):
    rows = t.booking_bronze(spark, sf_dir)
    return rows.select(
        "scraped_at",
        "num_adults",
        "total_price",
        stay.surrogate_key(
            "BOOK",
            text.city_of(F.col("search_area")),
            text.country_of(F.col("search_area")),
            F.col("facility_id"),
            F.col("checkin_date"),
            F.col("checkout_date"),
            F.col("scrape_date"),
        ).alias("pk"),
    )


def city_pairs(spark, sf_dir):
    return silver.cities(t.booking_bronze(spark, sf_dir))


def silver_alignment(spark, sf_dir):
    """Text columns and missing columns brought to the silver schema."""
    loose = t.booking_bronze(spark, sf_dir).select(
        "facility_id",
        F.when(F.col("num_adults") == 3, "three")
        .otherwise(F.col("num_adults").cast("string"))
        .alias("num_adults"),
        F.col("total_price").cast("string").alias("total_price"),
        F.col("is_available").cast("string").alias("is_available"),
        "scraped_at",
    )
    return align_to(loose, schemas.SILVER).select(
        "facility_id", "num_adults", "total_price", "is_available", "city", "num_nights", "rating"
    )


def silver_facility_detail(spark, sf_dir):
    stays = booking_silver(spark, sf_dir)
    return analyst.facility_detail_for_city(stays, t.facility_bronze(spark, sf_dir), "NATION_3")


def airbnb_facility_detail(spark, sf_dir):
    return analyst.facility_detail_for_city(airbnb_silver(spark, sf_dir), t.facility_bronze(spark, sf_dir), "NATION_3")


def airbnb_bargains(spark, sf_dir):
    return analyst.bargains(airbnb_silver(spark, sf_dir), 500.0).select(
        "_pk", "price_per_adult_per_night", "quality_price_score", "distance_from_center_km"
    )


def bargains_by_score(spark, sf_dir):
    return analyst.bargains(booking_silver(spark, sf_dir), 500.0).select(
        "_pk", "price_per_adult_per_night", "quality_price_score"
    )


def silver_near_centre(spark, sf_dir):
    return analyst.best_near_centre(booking_silver(spark, sf_dir), "NATION_3", 2000.0, 0.01).select(
        "_pk", "distance_from_center_km", "price_per_adult_per_night", "quality_price_score"
    )


def country_like_scores(spark, sf_dir):
    return analyst.country_scores(t.booking_bronze(spark, sf_dir), "ASIA")


def affordable_observations(spark, sf_dir):
    return analyst.affordable(t.booking_bronze(spark, sf_dir), 2000.0)


def cheapest_available(spark, sf_dir):
    return analyst.cheapest_available(t.booking_bronze(spark, sf_dir), "NATION_3__EUROPE")


def top_prices(spark, sf_dir):
    """The 25 most expensive observations, ties broken by the other columns."""
    rows = t.booking_bronze(spark, sf_dir).select("total_price", "facility_id", "scraped_at")
    return rows.orderBy(
        F.col("total_price").desc_nulls_last(), "facility_id", "scraped_at"
    ).limit(25)


QUERIES = {
    "booking_silver": (booking_silver, f"WITH {_BOOKING_CTES} SELECT * FROM booking_silver"),
    "airbnb_silver": (airbnb_silver, f"WITH {_AIRBNB_CTES} SELECT * FROM airbnb_silver"),
    "silver_union": (
        silver_union,
        f"WITH {_BOOKING_CTES}, {_AIRBNB_CTES} "
        "SELECT * FROM booking_silver UNION ALL BY NAME SELECT * FROM airbnb_silver",
    ),
    "dedup_latest": (
        dedup_latest,
        f"{t.with_tables('booking')} SELECT city, country, facility_id, checkin_date, checkout_date, "
        "CAST(scrape_date AS VARCHAR) AS scrape_date, scraped_at, num_adults, total_price "
        f"FROM booking {_newest('num_adults, total_price')}",
    ),
    "price_metrics": (
        price_metrics,
        f"{t.with_tables('booking')}, priced AS (SELECT *, {_PRICES} FROM booking) "
        "SELECT facility_id, scraped_at, num_nights, price_per_night, price_per_adult, "
        "price_per_adult_per_night, rating / nullif(price_per_adult_per_night, 0) AS raw_score FROM priced",
    ),
    "minmax_score": (
        minmax_score,
        "SELECT l_orderkey, l_linenumber, (l_extendedprice - min(l_extendedprice) OVER ()) / "
        "nullif(max(l_extendedprice) OVER () - min(l_extendedprice) OVER (), 0) AS score FROM lineitem",
    ),
    "haversine_centre": (
        haversine_centre,
        f"{t.with_tables('airbnb', 'centres')}, placed AS (SELECT facility_id, airbnb.city, "
        "latitude AS lat, longitude AS lon, centre_lat, centre_lon FROM airbnb LEFT JOIN centres "
        "ON airbnb.city = centres.city AND airbnb.country = centres.country) "
        f"SELECT facility_id, city, {_DISTANCE} AS distance_km FROM placed",
    ),
    "latest_located_facility": (
        latest_located_facility,
        f"{t.with_tables('facility')}, {_LOCATED} SELECT * FROM located",
    ),
    "located_listings": (
        located_listings,
        f"{t.with_tables('airbnb', 'facility')}, {_LOCATED} SELECT facility_id, scraped_at, num_adults, "
        "located.latitude, located.longitude FROM airbnb LEFT JOIN located USING (facility_id)",
    ),
    "hot_listing_lookup": (
        hot_listing_lookup,
        f"{t.with_tables('facility')}, {_LOCATED}, listings AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'P-1' "
        "ELSE 'P-' || l_partkey END AS facility_id, l_orderkey, l_linenumber FROM lineitem) SELECT facility_id, "
        "l_orderkey, l_linenumber, located.latitude, located.longitude FROM listings LEFT JOIN located USING (facility_id)",
    ),
    "surrogate_key": (
        surrogate_key,
        f"{t.with_tables('booking')} SELECT scraped_at, num_adults, total_price, {_pk('BOOK')} AS pk FROM booking",
    ),
    "city_pairs": (
        city_pairs,
        f"{t.with_tables('booking')} SELECT DISTINCT city, country FROM booking",
    ),
    "silver_alignment": (
        silver_alignment,
        f"{t.with_tables('booking')} SELECT facility_id, CASE WHEN num_adults <> 3 THEN num_adults END AS num_adults, "
        "total_price, is_available, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS BIGINT) AS num_nights, "
        "CAST(NULL AS DOUBLE) AS rating FROM booking",
    ),
    "silver_facility_detail": (
        silver_facility_detail,
        f"WITH {_BOOKING_CTES}, {t.SQL['facility']} SELECT s.facility_id, s.city, s.total_price, "
        "s.price_per_night, s.rating AS search_rating, f.num_bedrooms, f.num_guests, f.is_superhost, "
        "f.amenity_pool, f.amenity_wifi, f.cancellation_policy FROM booking_silver s "
        "JOIN facility f USING (facility_id) WHERE s.city = 'NATION_3'",
    ),
    "airbnb_facility_detail": (
        airbnb_facility_detail,
        f"WITH {_AIRBNB_CTES} SELECT s.facility_id, s.city, s.total_price, "
        "s.price_per_night, s.rating AS search_rating, f.num_bedrooms, f.num_guests, f.is_superhost, "
        "f.amenity_pool, f.amenity_wifi, f.cancellation_policy FROM airbnb_silver s "
        "JOIN facility f USING (facility_id) WHERE s.city = 'NATION_3'",
    ),
    "airbnb_bargains": (
        airbnb_bargains,
        f"WITH {_AIRBNB_CTES} SELECT _pk, price_per_adult_per_night, quality_price_score, distance_from_center_km "
        "FROM airbnb_silver WHERE price_per_adult_per_night < 500",
    ),
    "bargains_by_score": (
        bargains_by_score,
        f"WITH {_BOOKING_CTES} SELECT _pk, price_per_adult_per_night, quality_price_score FROM booking_silver "
        "WHERE price_per_adult_per_night < 500 ORDER BY quality_price_score DESC NULLS LAST",
    ),
    "silver_near_centre": (
        silver_near_centre,
        f"WITH {_BOOKING_CTES} SELECT _pk, distance_from_center_km, price_per_adult_per_night, quality_price_score "
        "FROM booking_silver WHERE 1 = 1 AND city = 'NATION_3' AND is_available "
        "AND price_per_adult_per_night < 2000 AND quality_price_score > 0.01 "
        "ORDER BY distance_from_center_km ASC NULLS LAST",
    ),
    "country_like_scores": (
        country_like_scores,
        f"{t.with_tables('booking')}, p AS (SELECT *, {_OBSERVED_PRICES} FROM booking WHERE search_area LIKE '%ASIA'), "
        "q AS (SELECT *, round(rating / nullif(price_per_night_per_person, 0), 2) AS score FROM p) "
        "SELECT name, search_area, total_price, price_per_night, price_per_person, price_per_night_per_person, "
        f"rating, {_SCALED} AS quality_score, num_reviews, distance_from_center_km, num_rooms_available, "
        "neighbourhood, accommodation_type, tags FROM q WHERE score IS NOT NULL "
        "ORDER BY quality_score DESC NULLS LAST",
    ),
    "affordable_observations": (
        affordable_observations,
        f"{t.with_tables('booking')}, p AS (SELECT *, {_OBSERVED_PRICES} FROM booking) "
        "SELECT facility_id, name, currency, search_area, neighbourhood, accommodation_type, tags, "
        "distance_from_center_km, num_nights, total_price, price_per_night, price_per_person, "
        "price_per_night_per_person, url FROM p WHERE price_per_night_per_person <= 2000",
    ),
    "cheapest_available": (
        cheapest_available,
        f"{t.with_tables('booking')} SELECT name, round(total_price / nullif(num_nights, 0), 2) AS price_per_night, "
        "rating FROM booking WHERE search_area = 'NATION_3__EUROPE' AND is_available "
        "ORDER BY price_per_night ASC NULLS LAST",
    ),
    "top_prices": (
        top_prices,
        f"{t.with_tables('booking')} SELECT total_price, facility_id, scraped_at FROM booking "
        "ORDER BY total_price DESC NULLS LAST, facility_id, scraped_at LIMIT 25",
    ),
}
