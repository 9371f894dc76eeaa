"""Pages to bronze to silver to alerts, end to end."""

import json

from staylens import schemas
from staylens.plans import refresh
from staylens.sources import bronze, silver_store

CARD = """<div data-testid="property-card" data-hotelid="{id}"><span data-testid="title">Hotel {id}</span>
<span data-testid="price-and-discounted-price">€ {price}</span>{extra}</div>"""
ROOM = """<div data-testid="card-container"><a href="/rooms/{id}"><b data-testid="listing-card-title">Room</b></a>
<p aria-label="total">$ 300</p><i aria-label="4.5 out of 5 average rating, 10 reviews">4.5</i></div>"""


def pages(spark, *entries):
    rows = [
        (None, None, area, "2024-02-01", "2024-02-03", 2, at, page, html)
        for page, (area, at, html) in enumerate(entries)
    ]
    return spark.createDataFrame(rows, schemas.RAW_PAGES)


def test_booking_flow(spark, tmp_path):
    base = str(tmp_path)
    monday = CARD.format(id=1, price=100, extra="Sold out") + CARD.format(id=2, price=80, extra="")
    tuesday = CARD.format(id=1, price=90, extra="") + CARD.format(id=2, price=70, extra="")
    first = refresh.land_booking_pages(
        pages(spark, ("Rome, Italy", "2024-01-15T08:00:00", monday), ("", "2024-01-15T08:00:00", tuesday)), base
    )
    assert first.count() == 0
    second = refresh.land_booking_pages(pages(spark, ("Rome, Italy", "2024-01-16T08:00:00", tuesday)), base)
    (alert,) = second.collect()
    assert (alert.facility_id, alert.search_area, alert.price_per_night) == ("1", "Rome__Italy", 45.0)
    assert (alert.first_unavailable_date, alert.recovered_at) == ("2024-01-15", "2024-01-16T08:00:00")
    refresh.push_booking_silver(spark, base)
    table = silver_store.read_latest(spark, base, silver_store.BOOKING_FOLDER)
    assert sorted((r.facility_id, r.city, r.total_price) for r in table.collect()) == [
        ("1", "Rome", 90.0), ("2", "Rome", 70.0)]


def test_airbnb_flow(spark, tmp_path):
    base = str(tmp_path)
    at = "2024-01-15T08:00:00"
    refresh.land_airbnb_pages(pages(spark, ("Rome, Italy", at, ROOM.format(id=7) + ROOM.format(id=8))), base)
    sections = [{"sectionId": "LOCATION_DEFAULT", "sectionData": {"lat": 41.9, "lng": 12.5}}]
    html = f'<script id="__NEXT_DATA__">{json.dumps({"props": {"pageProps": {"sections": sections}}})}</script>'
    details = spark.createDataFrame(
        [("7", "/rooms/7", at, html), ("8", "/rooms/8", at, "<p/>")],
        "facility_id string, url string, scraped_at string, html string",
    )
    refresh.land_facility_pages(details, base)
    centres_path = f"{base}/centres"
    spark.createDataFrame([("Rome", "Italy", 41.9, 12.5), ("Rome", "Italy", 41.9, 12.5)], schemas.CITY_CENTRES).write.parquet(
        centres_path
    )
    refresh.push_airbnb_silver(spark, base, silver_store.read_centres(spark, centres_path))
    table = silver_store.read_latest(spark, base, silver_store.AIRBNB_FOLDER)
    assert sorted((r.facility_id, r.rating, r.total_price, r.distance_from_center_km) for r in table.collect()) == [
        ("7", 9.0, 300.0, 0.0), ("8", 9.0, 300.0, None)]
    calendar = json.dumps({"calendar_months": [{"days": [{"date": "2024-02-01", "available": True}]}]})
    refresh.land_calendars(
        spark.createDataFrame([("7", at, calendar)], "facility_id string, scraped_at string, json string"), base
    )
    row = bronze.read(spark, bronze.AVAILABILITY, base).first()
    assert (row.facility_id, row.date, row.is_available, row.min_nights) == ("7", "2024-02-01", True, None)
