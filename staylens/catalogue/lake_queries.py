"""Landing, snapshots, lake SQL and streams, written below the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from staylens import schemas
from staylens.catalogue import page_queries as pg
from staylens.catalogue import tables as t
from staylens.catalogue.value_queries import alert_sql
from staylens.functions import text
from staylens.operators.coerce import coerce_to
from staylens.plans import refresh
from staylens.session import scratch_path
from staylens.sources import bronze, silver_store
from staylens.sources.lake import DataLake
from staylens.streaming import landing
from staylens.streaming import recovery as stream_recovery

_KEPT = [
    "facility_id", "name", "url", "search_area", "checkin_date", "scraped_at",
    "num_adults", "total_price", "currency", "rating", "is_available", "tags",
]


def _land_weekly(spark, sf_dir, name: str) -> str:
    base = scratch_path(spark, name)
    bronze.append(t.weekly_availability(spark, sf_dir), bronze.BOOKING, base)
    return base


def _as_read(frame):
    return frame.select(*_KEPT, F.col("scrape_date").cast("string").alias("scrape_date"))


_WEEKLY_READ = (
    "SELECT facility_id, name, url, search_area, '2026-06-01' AS checkin_date, scraped_at, "
    "CAST(2 AS BIGINT) AS num_adults, total_price, currency, rating, is_available, "
    "CAST(NULL AS VARCHAR) AS tags, substr(scraped_at, 1, 10) AS scrape_date FROM weekly"
)


def bronze_round_trip(spark, sf_dir):
    """Search rows landed twice with the same timestamps and read back once."""
    base = _land_weekly(spark, sf_dir, "round-trip")
    bronze.append(t.weekly_availability(spark, sf_dir), bronze.BOOKING, base)
    return _as_read(bronze.read(spark, bronze.BOOKING, base))


def facility_round_trip(spark, sf_dir):
    """Detail rows of all facilities, then half of them again in the same runs."""
    base = scratch_path(spark, "facility")
    rows = (
        t.weekly_availability(spark, sf_dir)
        .groupBy("facility_id", "scraped_at")
        .agg(F.max("total_price").alias("rating"))
    )
    bronze.append(rows, bronze.FACILITY, base)
    again = rows.where("facility_id LIKE 'U-1%'").withColumn("rating", F.lit(5.0))
    bronze.append(again, bronze.FACILITY, base)
    return bronze.read(spark, bronze.FACILITY, base).select(
        "facility_id", "scraped_at", "rating", "amenity_wifi", F.col("scrape_date").cast("string")
    )


def calendar_round_trip(spark, sf_dir):
    base = scratch_path(spark, "calendar")
    rows = t.table(spark, sf_dir, "events").select(
        F.concat(F.lit("L-"), F.col("event_id") % 50).alias("facility_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date"),
        (F.col("value") > 9).alias("is_available"),
        (F.col("event_id") % 9).alias("min_nights"),
        F.concat(F.lit("2024-02-0"), F.col("event_id") % 3 + 1, F.lit("T08:00:00")).alias("scraped_at"),
    )
    bronze.append(rows, bronze.AVAILABILITY, base)
    return bronze.register(spark, bronze.AVAILABILITY, base).drop("scrape_date")


def older_files(spark, sf_dir):
    """Files of a schema version without coordinates, read with today's schema."""
    base = scratch_path(spark, "older")
    rows = t.weekly_availability(spark, sf_dir).withColumn("latitude", F.lit(1.5))
    landed = bronze.landed_columns(coerce_to(rows, schemas.AIRBNB_BRONZE), bronze.AIRBNB)
    old = landed.where("search_area = 'Area0__Web'").drop("latitude", "longitude", "run")
    new = landed.where("search_area <> 'Area0__Web'").withColumn("promo", F.lit("x")).drop("run")
    for part in (old, new):
        part.write.mode("append").partitionBy("search_area", "scrape_date").parquet(
            bronze.AIRBNB.root(base)
        )
    found = bronze.read(spark, bronze.AIRBNB, base, extras=True)
    return found.select("facility_id", "scraped_at", "search_area", "total_price", "latitude", "promo")


def older_layout_append(spark, sf_dir):
    """Runs landed beside the files of a lake laid out by area and date, of which nothing is moved."""
    base = scratch_path(spark, "older-layout")
    rows = t.weekly_availability(spark, sf_dir)
    old = bronze.landed_columns(rows.where("scraped_at < '2024-01-08'"), bronze.BOOKING)
    old.drop("run", *bronze.DIGEST).write.partitionBy("search_area", "scrape_date").parquet(bronze.BOOKING.root(base))
    for _ in range(2):
        bronze.append(rows.where("scraped_at >= '2024-01-08'"), bronze.BOOKING, base)
    return _as_read(bronze.read(spark, bronze.BOOKING, base))


def compacted_runs(spark, sf_dir):
    """Runs landed by a stream in many small files, rewritten into few and read back."""
    base = scratch_path(spark, "compacted")
    t.weekly_availability(spark, sf_dir).repartition(4).write.parquet(f"{base}/raw")
    rows = landing.raw_stream(spark, f"{base}/raw", spark.read.parquet(f"{base}/raw").schema, files_per_batch=2)
    landing.start_landing(rows, bronze.BOOKING, base, f"{base}/checkpoint").awaitTermination()
    bronze.compact(spark, bronze.BOOKING, base, files=2)
    return _as_read(bronze.read(spark, bronze.BOOKING, base))


def stream_redelivery(spark, sf_dir):
    """The same scrapes delivered twice, cut into other files the second time, and once more as a batch."""
    base = scratch_path(spark, "redelivery")
    rows = t.weekly_availability(spark, sf_dir)
    bronze.append(rows.where("search_area = 'Area0__Web'"), bronze.BOOKING, base)
    for cut in ("facility_id", "total_price"):
        rows.repartition(3, cut).write.mode("append").parquet(f"{base}/raw")
        stream = landing.raw_stream(spark, f"{base}/raw", spark.read.parquet(f"{base}/raw").schema, files_per_batch=3)
        landing.start_landing(stream, bronze.BOOKING, base, f"{base}/checkpoint").awaitTermination()
    return _as_read(bronze.read(spark, bronze.BOOKING, base))


def silver_snapshots(spark, sf_dir):
    """Two pushes: the lake shows the newest, the history both."""
    base = _land_weekly(spark, sf_dir, "snapshots")
    for stamp in ("2026-01-01T00:00:00", "2026-01-02T00:00:00"):
        refresh.push_booking_silver(spark, base, stamp)
    newest = silver_store.read_latest(spark, base, silver_store.BOOKING_FOLDER)
    history = silver_store.read_history(spark, base, silver_store.BOOKING_FOLDER)
    return newest.select("_pk", F.lit("newest").alias("scope")).unionByName(
        history.select("_pk", F.lit("history").alias("scope"))
    )


_NEWEST_STAYS = """newest AS (SELECT * FROM weekly QUALIFY row_number() OVER (
    PARTITION BY search_area, facility_id ORDER BY scraped_at DESC, url DESC, name DESC, currency DESC,
    total_price DESC, rating DESC, is_available DESC) = 1)"""
_WEEKLY_PK = """'BOOK/' || lower(split_part(search_area, '__', 1)) || upper(split_part(search_area, '__', 2))
    || '/' || replace(lower(facility_id), '-', '_') || '/20260601_202606' || lpad(CAST(1 + num_nights AS VARCHAR), 2, '0')
    || '/' || replace(substr(scraped_at, 1, 10), '-', '')"""

_LAKE_SQL = """
    SELECT s.facility_id, s.city, s.total_price, s.price_per_night,
           round(s.total_price / nullif(date_diff('day', cast(s.checkin_date as date),
                                                  cast(s.checkout_date as date)), 0), 2) AS nightly,
           'silver.booking.accommodations' AS origin
    FROM silver.booking.accommodations s
    WHERE s.city = :city AND s.is_available = true AND s.total_price < :below
    ORDER BY s.price_per_night
"""


def lake_sql(spark, sf_dir):
    """Analyst SQL with three-part names and parameters over a fresh lake."""
    base = _land_weekly(spark, sf_dir, "lake")
    refresh.push_booking_silver(spark, base, "2026-01-01T00:00:00")
    return DataLake(spark, base).query(_LAKE_SQL, {"city": "Area1", "below": 400.0})


def airbnb_snapshot(spark, sf_dir):
    """Search results and detail rows landed, pushed with a stored centre table."""
    base = scratch_path(spark, "airbnb")
    rows = t.weekly_availability(spark, sf_dir)
    number = F.regexp_extract("facility_id", r"U-(\d+)", 1).cast("bigint")
    bronze.append(rows, bronze.AIRBNB, base)
    detail = rows.groupBy("facility_id", "scraped_at").agg(F.max("total_price").alias("rating"))
    bronze.append(
        detail.withColumns(
            {
                "latitude": F.when(F.col("rating") < 100, 41 + number % 80 / 10.0),
                "longitude": 11 + F.month("scraped_at") + F.day("scraped_at") / 10.0,
            }
        ),
        bronze.FACILITY,
        base,
    )
    centres = rows.select(text.city_of(F.col("search_area")).alias("city")).distinct()
    centres.select(
        "city",
        F.lit("Web").alias("country"),
        (40 + F.substring("city", 5, 1).cast("int") / 2.0).alias("centre_lat"),
        F.lit(12.5).alias("centre_lon"),
    ).write.parquet(f"{base}/city_centres")
    refresh.push_airbnb_silver(
        spark, base, silver_store.read_centres(spark, f"{base}/city_centres"), "2026-01-01T00:00:00"
    )
    newest = silver_store.read_latest(spark, base, silver_store.AIRBNB_FOLDER)
    return newest.select("_pk", "rating", "price_per_adult_per_night", "distance_from_center_km")


_AIRBNB_SNAPSHOT = """detail AS (SELECT facility_id, scraped_at, max(total_price) AS worst FROM weekly GROUP BY ALL),
located AS (SELECT facility_id, 41 + (CAST(split_part(facility_id, '-', 2) AS BIGINT) % 80) / 10.0::DOUBLE AS lat,
    11 + 1 + CAST(substr(scraped_at, 9, 2) AS INTEGER) / 10.0::DOUBLE AS lon FROM detail WHERE worst < 100
  QUALIFY row_number() OVER (PARTITION BY facility_id ORDER BY scraped_at DESC) = 1),
placed AS (SELECT newest.*, lat, lon,
    40 + CAST(substr(search_area, 5, 1) AS INTEGER) / 2.0::DOUBLE AS centre_lat, 12.5::DOUBLE AS centre_lon
  FROM newest LEFT JOIN located USING (facility_id))"""


def _watched_lake(spark, sf_dir, name: str) -> str:
    """Weeks landed in turn with an alert run after each; one run is landed wrong at first, and again."""
    base = scratch_path(spark, name)
    rows = t.weekly_availability(spark, sf_dir)
    weeks = [row[0] for row in rows.select("scraped_at").distinct().orderBy("scraped_at").collect()]
    first, rest = weeks[:-2], weeks[-2:]
    history = rows.where(F.col("scraped_at").isin(first))
    wrong = F.when(F.col("scraped_at") == first[-1], F.lit(True)).otherwise(F.col("is_available"))
    for part in (
        history.withColumn("is_available", wrong),
        history.where(F.col("scraped_at") == first[-1]),
        *[rows.where(F.col("scraped_at") == week) for week in rest],
    ):
        bronze.append(part, bronze.BOOKING, base)
        refresh.newest_alerts(spark, bronze.BOOKING, base)
    return base


def watched_alerts(spark, sf_dir):
    """Alerts of every area's newest scrape from kept sightings."""
    return refresh.newest_alerts(spark, bronze.BOOKING, _watched_lake(spark, sf_dir, "watched"))


def watched_alerts_at(spark, sf_dir):
    """Alerts of one area at an earlier scrape from kept sightings."""
    base = _watched_lake(spark, sf_dir, "watched-at")
    return refresh.alerts_at(spark, bronze.BOOKING, base, "Area1, Web", "2024-01-15T00:00:00")


def lake_count(spark, sf_dir):
    base = _land_weekly(spark, sf_dir, "count")
    return DataLake(spark, base).query(
        "SELECT search_area, count(*) AS n FROM bronze.booking.accommodations "
        "WHERE search_area IN ('Area0__Web', 'Area2__Web') GROUP BY search_area"
    )


def _raw_inputs(spark, sf_dir):
    """Result pages, detail pages and calendars of every part, some of which cannot be placed."""
    key = F.col("page")
    pages = pg.booking_pages(spark, sf_dir).withColumns(
        {
            "search_area": F.when(key % 10 == 0, "").otherwise(F.col("search_area")),
            "scraped_at": F.when(key % 10 == 1, "yesterday").otherwise(F.col("scraped_at")),
            "checkin_date": F.when(key % 10 == 2, "2026-06-09").when(key % 10 == 3, "soon").otherwise(F.col("checkin_date")),
        }
    )
    number = F.substring("facility_id", 3, 20).cast("bigint")
    details = pg.facility_html(spark, sf_dir).withColumns(
        {"url": F.col("facility_id"), "html": F.when(number % 8 == 3, "").otherwise(F.col("html"))}
    ).withColumn("facility_id", F.when(number % 8 == 5, None).otherwise(F.col("facility_id")))
    calendars = t.table(spark, sf_dir, "part").select(
        F.concat(F.lit("K-"), "p_partkey").alias("facility_id"),
        F.lit("2024-02-01T08:00:00").alias("scraped_at"),
        F.when(F.col("p_partkey") % 6 == 0, '{"calendar_months":[{"days"')
        .when(F.col("p_partkey") % 6 == 1, '{"error":"busy"}')
        .otherwise('{"calendar_months":[{"days":[{"date":"2024-02-01","available":true,"min_nights":2.5}]}]}')
        .alias("json"),
    )
    return (refresh.BOOKING_PAGES, pages), (refresh.FACILITY_PAGES, details), (refresh.CALENDARS, calendars)


def landed_pages(spark, sf_dir):
    """Pages, details and calendars landed twice; what of them bronze holds."""
    base = scratch_path(spark, "landed")
    found = []
    for source, raw in _raw_inputs(spark, sf_dir):
        for _ in range(2):
            refresh.land(raw, source, base)
        found.append(bronze.read(spark, source.dataset, base).select(F.lit(source.dataset.folder).alias("dataset"), "facility_id", "scraped_at"))
    return found[0].union(found[1]).union(found[2])


def landing_rejects(spark, sf_dir):
    """What could not be landed, with the reason, after landing the same inputs twice."""
    base = scratch_path(spark, "rejects")
    found = []
    for (source, raw), key in zip(_raw_inputs(spark, sf_dir), ("page", "url", "facility_id")):
        for _ in range(2):
            refresh.set_aside(raw, source, base)
        rows = refresh.rejects(spark, source.dataset, base)
        found.append(rows.select(F.lit(source.dataset.folder).alias("dataset"), "reason", F.col(key).cast("string").alias("input")))
    return found[0].union(found[1]).union(found[2])


def landing_accounts(spark, sf_dir):
    """Inputs, of them extracted and rejected, and rows written, as the writes counted them."""
    base = scratch_path(spark, "accounts")
    counts = []
    for source, raw in _raw_inputs(spark, sf_dir):
        a = refresh.land(raw, source, base)
        counts.append((source.dataset.folder, a.pages, a.extracted, a.rejected, a.rows))
    return spark.createDataFrame(counts, "dataset string, pages bigint, extracted bigint, rejected bigint, row_count bigint")


_RAW = f"""cards AS ({pg.QUERIES['booking_cards'][1]}),
landed AS (
  SELECT 'bronze/booking/accommodations' AS dataset, facility_id, '2026-05-01T10:00:00' AS scraped_at FROM cards
  JOIN part ON name IN ('Casa <' || p_name || '> ' || p_partkey, 'Old ' || p_partkey) OR facility_id = 'g' || p_partkey WHERE p_partkey % 10 >= 4
  UNION ALL SELECT 'bronze/airbnb/facility', 'F-' || p_partkey, '2026-05-09T10:00:00' FROM part WHERE p_partkey % 8 NOT IN (3, 5)
  UNION ALL SELECT 'bronze/airbnb/availability', 'K-' || p_partkey, '2024-02-01T08:00:00' FROM part WHERE p_partkey % 6 > 1),
turned_down AS (
  SELECT 'bronze/booking/accommodations' AS dataset, list_extract(['no search area', 'unreadable timestamp',
    'stay ends before it begins', 'unreadable stay dates'], CAST(p_partkey % 10 + 1 AS INTEGER)) AS reason,
    CAST(p_partkey AS VARCHAR) AS input FROM part WHERE p_partkey % 10 < 4
  UNION ALL SELECT 'bronze/airbnb/facility', CASE WHEN p_partkey % 8 = 3 THEN 'no page' ELSE 'no facility id' END, 'F-' || p_partkey
  FROM part WHERE p_partkey % 8 IN (3, 5)
  UNION ALL SELECT 'bronze/airbnb/availability', 'unreadable calendar', 'K-' || p_partkey FROM part WHERE p_partkey % 6 < 2)"""


def stream_landing(spark, sf_dir):
    """Raw rows arriving as files, landed by a stream and read back."""
    base = scratch_path(spark, "stream-landing")
    t.weekly_availability(spark, sf_dir).repartition(4).write.parquet(f"{base}/raw")
    schema = spark.read.parquet(f"{base}/raw").schema
    rows = landing.raw_stream(spark, f"{base}/raw", schema, files_per_batch=2)
    landing.start_landing(rows, bronze.BOOKING, base, f"{base}/checkpoint").awaitTermination()
    return _as_read(bronze.read(spark, bronze.BOOKING, base))


def stream_availability_recovery(spark, sf_dir):
    """Alerts raised by a stream over the whole history, which arrives shuffled and file by file."""
    base = scratch_path(spark, "stream-recovery")
    t.weekly_availability(spark, sf_dir).repartition(4, "scraped_at", "facility_id").write.parquet(f"{base}/raw")
    schema = spark.read.parquet(f"{base}/raw").schema
    rows = landing.raw_stream(spark, f"{base}/raw", schema, files_per_batch=1)
    stream_recovery.start_recovery(rows, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return stream_recovery.read_alerts(spark, f"{base}/out")


_STREAM_ALERTS = f"""{t.with_tables('weekly')},
seen AS (SELECT search_area, facility_id, min(scraped_at) FILTER (NOT is_available) AS bad,
  min(scraped_at) FILTER (is_available) AS good FROM weekly GROUP BY ALL)
SELECT facility_id, name, url, search_area, substr(bad, 1, 10) AS first_unavailable_date,
  scraped_at AS recovered_at, round(total_price / nullif(num_nights, 0), 2) AS price_per_night, currency, rating
FROM weekly JOIN seen USING (search_area, facility_id) WHERE bad < good AND is_available AND scraped_at = good"""

QUERIES = {
    "bronze_round_trip": (bronze_round_trip, f"{t.with_tables('weekly')} {_WEEKLY_READ}"),
    "facility_round_trip": (
        facility_round_trip,
        f"{t.with_tables('weekly')} SELECT facility_id, scraped_at, "
        "CASE WHEN facility_id LIKE 'U-1%' THEN 5.0 ELSE max(total_price) END AS rating, "
        "false AS amenity_wifi, substr(scraped_at, 1, 10) AS scrape_date FROM weekly GROUP BY facility_id, scraped_at",
    ),
    "calendar_round_trip": (
        calendar_round_trip,
        "SELECT 'L-' || (event_id % 50) AS facility_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS date, "
        "value > 9 AS is_available, event_id % 9 AS min_nights, "
        "'2024-02-0' || (event_id % 3 + 1) || 'T08:00:00' AS scraped_at FROM events",
    ),
    "older_files": (
        older_files,
        f"{t.with_tables('weekly')} SELECT facility_id, scraped_at, search_area, total_price, "
        "CASE WHEN search_area <> 'Area0__Web' THEN 1.5::DOUBLE END AS latitude, "
        "CASE WHEN search_area <> 'Area0__Web' THEN 'x' END AS promo FROM weekly",
    ),
    "older_layout_append": (older_layout_append, f"{t.with_tables('weekly')} {_WEEKLY_READ}"),
    "compacted_runs": (compacted_runs, f"{t.with_tables('weekly')} {_WEEKLY_READ}"),
    "stream_redelivery": (stream_redelivery, f"{t.with_tables('weekly')} {_WEEKLY_READ}"),
    "landed_pages": (landed_pages, f"WITH {_RAW} SELECT * FROM landed"),
    "landing_rejects": (landing_rejects, f"WITH {_RAW} SELECT * FROM turned_down"),
    "landing_accounts": (
        landing_accounts,
        f"WITH {_RAW} SELECT dataset, parts AS pages, parts - rejected AS extracted, rejected, row_count "
        "FROM (SELECT dataset, count(*) AS row_count FROM landed GROUP BY dataset) "
        "JOIN (SELECT dataset, count(*) AS rejected FROM turned_down GROUP BY dataset) USING (dataset), "
        "(SELECT count(*) AS parts FROM part)",
    ),
    "silver_snapshots": (
        silver_snapshots,
        f"{t.with_tables('weekly')}, {_NEWEST_STAYS}, keys AS (SELECT {_WEEKLY_PK} AS _pk FROM newest) "
        "SELECT _pk, 'newest' AS scope FROM keys UNION ALL SELECT _pk, 'history' FROM keys "
        "UNION ALL SELECT _pk, 'history' FROM keys",
    ),
    "airbnb_snapshot": (
        airbnb_snapshot,
        f"{t.with_tables('weekly')}, {_NEWEST_STAYS}, {_AIRBNB_SNAPSHOT} SELECT "
        f"replace({_WEEKLY_PK}, 'BOOK/', 'ABNB/') AS _pk, rating * 2.0 AS rating, "
        "round(total_price / nullif(2 * num_nights, 0), 2) AS price_per_adult_per_night, "
        "round(2.0 * 6371.0 * asin(sqrt(power(sin(radians(lat - centre_lat) / 2.0), 2) + cos(radians(centre_lat)) "
        "* cos(radians(lat)) * power(sin(radians(lon - centre_lon) / 2.0), 2))), 3) AS distance_from_center_km FROM placed",
    ),
    "lake_sql": (
        lake_sql,
        f"{t.with_tables('weekly')}, {_NEWEST_STAYS} SELECT facility_id, 'Area1' AS city, total_price, "
        "round(total_price / nullif(num_nights, 0), 2) AS price_per_night, "
        "round(total_price / nullif(num_nights, 0), 2) AS nightly, 'silver.booking.accommodations' AS origin "
        "FROM newest WHERE search_area = 'Area1__Web' AND is_available AND total_price < 400",
    ),
    "lake_count": (
        lake_count,
        f"{t.with_tables('weekly')} SELECT search_area, count(*) AS n FROM weekly "
        "WHERE search_area IN ('Area0__Web', 'Area2__Web') GROUP BY search_area",
    ),
    "watched_alerts": (watched_alerts, alert_sql("max(scraped_at)") + " SELECT * FROM alerts"),
    "watched_alerts_at": (
        watched_alerts_at,
        alert_sql("'2024-01-15T00:00:00'") + " SELECT * FROM alerts WHERE search_area = 'Area1__Web'",
    ),
    "stream_landing": (stream_landing, f"{t.with_tables('weekly')} {_WEEKLY_READ}"),
    "stream_availability_recovery": (stream_availability_recovery, _STREAM_ALERTS),
}
