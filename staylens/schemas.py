"""Declared schemas of every dataset, as ``StructType`` constants.

Dates and timestamps stay ISO-8601 strings at rest; expressions cast them
where they need calendar arithmetic.
"""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
}


def _schema(columns: str) -> T.StructType:
    """A schema from "name type, name type"; needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


BOOKING_BRONZE = _schema(
    """
    facility_id string, name string, url string, search_area string,
    checkin_date string, checkout_date string, scraped_at string,
    num_adults bigint, total_price double, currency string,
    rating double, rating_category string, num_reviews bigint,
    distance_from_center_km double, num_rooms_available bigint,
    neighbourhood string, accommodation_type string, tags string,
    is_available boolean, raw_html_snippet string
    """
)

AIRBNB_BRONZE = _schema(
    """
    facility_id string, name string, url string, search_area string,
    checkin_date string, checkout_date string, scraped_at string,
    num_adults bigint, description string, accommodation_type string,
    neighbourhood string, num_bedrooms bigint, num_beds bigint,
    host_type string, total_price double, currency string,
    price_is_per_night boolean, rating double, num_reviews bigint,
    is_superhost boolean, is_free_cancellation boolean, tags string,
    latitude double, longitude double, is_available boolean,
    raw_html_snippet string
    """
)

FACILITY_BRONZE = _schema(
    """
    facility_id string, url string, scraped_at string,
    name string, accommodation_type string, description string,
    num_guests bigint, num_bedrooms bigint, num_beds bigint,
    num_bathrooms double, label string, is_guest_favourite boolean,
    rating double, num_reviews bigint, rating_cleanliness double,
    rating_accuracy double, rating_checkin double,
    rating_communication double, rating_location double,
    abnb_price_quality_score double, host_name string, host_id string,
    is_superhost boolean, host_since_year bigint,
    host_response_rate string, host_response_time string,
    latitude double, longitude double, min_nights bigint,
    max_nights bigint, check_in_time string, check_out_time string,
    cancellation_policy string, house_rules string,
    amenity_wifi boolean, amenity_kitchen boolean,
    amenity_washing_machine boolean, amenity_dryer boolean,
    amenity_free_parking boolean, amenity_air_conditioning boolean,
    amenity_heating boolean, amenity_tv boolean,
    amenity_dedicated_workspace boolean, amenity_pool boolean,
    amenity_hot_tub boolean, amenity_gym boolean,
    amenity_bbq_grill boolean, amenity_breakfast boolean,
    amenity_pets_allowed boolean, amenity_smoking_allowed boolean,
    amenities_raw string, raw_json_snippet string
    """
)

AVAILABILITY_BRONZE = _schema(
    """
    facility_id string, date string, is_available boolean,
    min_nights bigint, scraped_at string
    """
)

SILVER = _schema(
    """
    facility_id string, url string, name string,
    accommodation_type string, city string, country string,
    neighbourhood string, distance_from_center_km double,
    checkin_date string, checkout_date string, num_nights bigint,
    num_adults bigint, currency string, total_price double,
    price_per_night double, price_per_adult double,
    price_per_adult_per_night double, rating double,
    quality_price_score double, num_reviews bigint,
    num_rooms_available bigint, is_available boolean,
    _pk string, _source string
    """
)

CITY_CENTRES = _schema(
    "city string, country string, centre_lat double, centre_lon double"
)

RAW_PAGES = _schema(
    """
    facility_id string, url string, search_area string,
    checkin_date string, checkout_date string, num_adults bigint,
    scraped_at string, page bigint, html string
    """
)

ALERT = _schema(
    """
    facility_id string, name string, url string, search_area string,
    first_unavailable_date string, recovered_at string,
    price_per_night double, currency string, rating double
    """
)
