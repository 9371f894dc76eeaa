"""Stay length, price metrics, currency names and the surrogate key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Currency symbols and their ISO codes, per layer.
BOOKING_SILVER_CURRENCIES = {"€": "EUR", "$": "USD"}
AIRBNB_SILVER_CURRENCIES = {"$": "USD", "€": "EUR", "£": "GBP"}
PAGE_CURRENCIES = {
    "$": "USD",
    "€": "EUR",
    "£": "GBP",
    "¥": "JPY",
    "₹": "INR",
    "A$": "AUD",
    "C$": "CAD",
    "NZ$": "NZD",
}


def currency_code(currency: Column, names: dict[str, str]) -> Column:
    """Replace known symbols by ISO codes and keep everything else."""
    table = F.create_map(*[F.lit(part) for pair in names.items() for part in pair])
    return F.coalesce(F.try_element_at(table, currency), currency)


def round_places(value: Column, places: int) -> Column:
    """Round the scaled double half away from zero.

    Spark's ``round(x, n)`` rounds the printed decimal instead, which gives
    1.01 for 1.005; SQL engines that scale the binary value give 1.0.
    """
    scale = F.lit(float(10**places))
    return F.round(value * scale) / scale


def num_nights(checkin_date: Column, checkout_date: Column) -> Column:
    return F.datediff(
        checkout_date.try_cast("date"), checkin_date.try_cast("date")
    ).cast("bigint")


def price_per(total_price: Column, units: Column) -> Column:
    """Price per unit to the cent; NULL for zero units (same-day stays, no adults)."""
    return round_places(F.try_divide(total_price, units), 2)


def quality_per_price(rating: Column, price_per_adult_per_night: Column) -> Column:
    """Raw quality/price ratio over the already rounded price."""
    return F.try_divide(rating, price_per_adult_per_night)


def surrogate_key(
    tag: str,
    city: Column,
    country: Column,
    facility_id: Column,
    checkin_date: Column,
    checkout_date: Column,
    scrape_date: Column,
) -> Column:
    """``TAG/cityCOUNTRY/facility/checkin_checkout/scrape``; NULL if any part is."""
    blank, dash, bar, none = F.lit(" "), F.lit("-"), F.lit("_"), F.lit("")

    def compact(day: Column) -> Column:
        return F.replace(day.cast("string"), dash, none)

    return F.concat(
        F.lit(f"{tag}/"),
        F.replace(F.lower(city), blank, bar),
        F.replace(F.upper(country), blank, bar),
        F.lit("/"),
        F.replace(F.lower(facility_id), dash, bar),
        F.lit("/"),
        compact(checkin_date),
        bar,
        compact(checkout_date),
        F.lit("/"),
        compact(scrape_date),
    )
