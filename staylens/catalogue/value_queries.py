"""Number parsing, coercion, de-duplication, unions, work lists and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from staylens import schemas
from staylens.catalogue import tables as t
from staylens.functions import stay, text
from staylens.operators import pick, recovery, worklist
from staylens.operators.coerce import coerce_to


def parse_number(spark, sf_dir):
    """Prices written in four styles and read back."""
    price, style = F.col("l_extendedprice"), F.col("l_orderkey") % 4
    english = F.format_number(price, 2)
    whole = F.format_number(F.floor(price), 0)
    written = (
        F.when(style == 0, F.translate(english, ",.", ".,"))
        .when(style == 1, F.concat(F.lit("US$ "), english))
        .when(style == 2, F.concat(F.lit("€ "), F.translate(F.replace(english, F.lit(",")), ".", ",")))
        .otherwise(F.translate(whole, ",", "."))
    )
    items = t.spread_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber")
    return items.select(
        "l_orderkey", "l_linenumber", "l_partkey", text.parse_number(written).alias("price")
    )


_PARSE_NUMBER = """SELECT l_orderkey, l_linenumber, l_partkey, CASE
    WHEN l_orderkey % 4 < 3 THEN round(l_extendedprice, 2)
    WHEN floor(l_extendedprice) >= 1000 AND floor(l_extendedprice) % 1000 = 0 THEN floor(l_extendedprice) / 1000
    ELSE floor(l_extendedprice) END AS price FROM lineitem"""


def parse_digits(spark, sf_dir):
    written = F.when(
        F.col("l_orderkey") % 5 != 0,
        F.concat(F.format_number(F.col("l_orderkey"), 0), F.lit(" reviews")),
    ).otherwise("no reviews")
    return t.table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_linenumber", text.parse_digits(written).alias("reviews")
    )


def sanitised_areas(spark, sf_dir):
    area = F.concat("c_mktsegment", F.lit(" é/"), "c_custkey", F.lit(", Land-"), "c_nationkey")
    clean = text.sanitise_area(area)
    return t.table(spark, sf_dir, "customer").select(
        "c_custkey",
        clean.alias("search_area"),
        text.city_of(clean).alias("city"),
        text.country_of(clean).alias("country"),
    )


def currency_codes(spark, sf_dir):
    symbols = F.array(*[F.lit(x) for x in ("€", "$", "£", "¥", "₹", "A$", "C$", "NZ$", "CHF", "EUR")])
    rows = t.table(spark, sf_dir, "customer").withColumn(
        "symbol", F.get(symbols, (F.col("c_custkey") % 10).cast("int"))
    )
    return rows.select(
        "c_custkey",
        stay.currency_code(F.col("symbol"), stay.BOOKING_SILVER_CURRENCIES).alias("booking"),
        stay.currency_code(F.col("symbol"), stay.AIRBNB_SILVER_CURRENCIES).alias("airbnb"),
        stay.currency_code(F.col("symbol"), stay.PAGE_CURRENCIES).alias("page"),
    )


_CURRENCY_CODES = """WITH s AS (SELECT c_custkey, CAST(c_custkey % 10 + 1 AS INTEGER) AS n FROM customer)
SELECT c_custkey,
  list_extract(['EUR', 'USD', '£', '¥', '₹', 'A$', 'C$', 'NZ$', 'CHF', 'EUR'], n) AS booking,
  list_extract(['EUR', 'USD', 'GBP', '¥', '₹', 'A$', 'C$', 'NZ$', 'CHF', 'EUR'], n) AS airbnb,
  list_extract(['EUR', 'USD', 'GBP', 'JPY', 'INR', 'AUD', 'CAD', 'NZD', 'CHF', 'EUR'], n) AS page FROM s"""


def _loose(spark, sf_dir):
    """Line items as badly typed rows: texts for numbers, gaps, junk."""
    line = F.col("l_linenumber")
    return t.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P-"), "l_partkey").alias("facility_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("scraped_at"),
        F.when(line == 1, "n/a").otherwise(F.col("l_extendedprice").cast("string")).alias("total_price"),
        F.when(line == 2, "two").otherwise(F.concat(line, F.lit(".0"))).alias("num_adults"),
        F.when(line == 3, F.lit("NaN")).otherwise(F.col("l_discount").cast("string")).alias("rating"),
        F.when(line != 4, F.col("l_linestatus") == "F").alias("is_available"),
        F.when(line != 5, F.col("l_returnflag") == "R").alias("is_superhost"),
        F.when(line == 6, "x").otherwise(line.cast("string")).alias("min_nights"),
        F.when(line != 5, F.col("l_linestatus") == "O").alias("amenity_wifi"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        F.lit("dropped").alias("not_in_the_schema"),
    )


_LOOSE = {
    "facility_id": "'P-' || l_partkey",
    "scraped_at": "strftime(l_shipdate, '%Y-%m-%d')",
    "total_price": "CASE WHEN l_linenumber <> 1 THEN l_extendedprice END",
    "num_adults": "CASE WHEN l_linenumber <> 2 THEN CAST(l_linenumber AS BIGINT) END",
    "rating": "CASE WHEN l_linenumber <> 3 THEN l_discount END",
    "is_available": "l_linenumber <> 4 AND l_linestatus = 'F'",
    "is_superhost": "l_linenumber <> 5 AND l_returnflag = 'R'",
    "min_nights": "CASE WHEN l_linenumber <> 6 THEN CAST(l_linenumber AS BIGINT) END",
    "amenity_wifi": "l_linenumber <> 5 AND l_linestatus = 'O'",
    "date": "strftime(l_shipdate, '%Y-%m-%d')",
}
_SQL_TYPES = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT"}


def _coerced(schema):
    def query(spark, sf_dir):
        return coerce_to(_loose(spark, sf_dir), schema)

    columns = []
    for field in schema.fields:
        kind = field.dataType.simpleString()
        missing = "false" if kind == "boolean" else f"CAST(NULL AS {_SQL_TYPES.get(kind)})"
        columns.append(f"{_LOOSE.get(field.name, missing)} AS {field.name}")
    return query, f"SELECT {', '.join(columns)} FROM lineitem"


def first_occurrence(spark, sf_dir):
    """Each listing once per search, from its first page and position."""
    key = F.col("l_partkey")
    cards = t.table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("search_area"),
        F.when(key % 50 == 0, "unknown").otherwise(F.concat(F.lit("P-"), key)).alias("facility_id"),
        F.concat(F.lit("Name "), key).alias("name"),
        F.col("l_linenumber").cast("bigint").alias("page"),
        F.col("l_orderkey").alias("position"),
        F.col("l_extendedprice").alias("total_price"),
    )
    return pick.first_occurrences(cards, ["search_area"])


_FIRST_OCCURRENCE = """WITH cards AS (SELECT l_returnflag AS search_area,
  CASE WHEN l_partkey % 50 = 0 THEN 'unknown' ELSE 'P-' || l_partkey END AS facility_id,
  'Name ' || l_partkey AS name, CAST(l_linenumber AS BIGINT) AS page, l_orderkey AS position,
  l_extendedprice AS total_price FROM lineitem)
SELECT * FROM cards QUALIFY row_number() OVER (PARTITION BY search_area,
  CASE WHEN facility_id = 'unknown' THEN 'n' || name ELSE 'f' || facility_id END
  ORDER BY page, position, name, total_price) = 1"""


def schema_versions(spark, sf_dir):
    """Rows of an older and a newer schema version, matched by column name."""
    rows = t.airbnb_bronze(spark, sf_dir).select(
        "facility_id", "scraped_at", "latitude", "total_price", "num_adults"
    )
    old = rows.where("num_adults <= 3").drop("latitude", "num_adults")
    new = rows.where("num_adults > 3").select("num_adults", "latitude", "total_price", "scraped_at", "facility_id")
    return old.unionByName(new, allowMissingColumns=True)


def discovered_listings(spark, sf_dir):
    rows = t.weekly_availability(spark, sf_dir)
    return worklist.discover_listings(
        rows.withColumn("url", F.when(F.col("search_area") != "Area2__Web", F.col("url")))
    )


def discovered_ids(spark, sf_dir):
    return worklist.discover_facility_ids(t.weekly_availability(spark, sf_dir))


def _collected(spark, sf_dir):
    return (
        t.weekly_availability(spark, sf_dir)
        .where("is_available")
        .withColumn("scrape_date", text.timestamp_to_date_text(F.col("scraped_at")).cast("date"))
    )


def pending_listings(spark, sf_dir):
    found = worklist.discover_listings(t.weekly_availability(spark, sf_dir))
    return worklist.pending(found, _collected(spark, sf_dir), "2024-01-08")


def pending_capped(spark, sf_dir):
    """The first 20 listings of the day's work list, as one run's budget."""
    found = worklist.discover_listings(t.weekly_availability(spark, sf_dir))
    return worklist.pending(found, _collected(spark, sf_dir), "2024-01-08", 20)


def pending_given_ids(spark, sf_dir):
    """The first 30 of the given ids, in their own order, that the day has not collected."""
    bronze = t.weekly_availability(spark, sf_dir)
    found = worklist.discover_facility_ids(bronze, GIVEN_IDS)
    return worklist.pending(found, _collected(spark, sf_dir), "2024-01-08", 30)


GIVEN_IDS = [f"U-{(37 * k) % 90}-{kind}" for k in range(60) for kind in ("view", "click", "view")]


_PENDING = f"""{t.with_tables('weekly')} SELECT DISTINCT facility_id, url FROM weekly
  WHERE facility_id NOT IN (SELECT facility_id FROM weekly
    WHERE is_available AND scraped_at = '2024-01-08T00:00:00')"""


def availability_recovery(spark, sf_dir):
    return recovery.availability_recovery(
        t.weekly_availability(spark, sf_dir), "Area1, Web", "2024-01-15T00:00:00"
    )


def availability_recovery_all_areas(spark, sf_dir):
    return recovery.availability_recovery_all_areas(t.weekly_availability(spark, sf_dir))


def alert_text(spark, sf_dir):
    alerts = availability_recovery_all_areas(spark, sf_dir)
    return alerts.select("facility_id", "price_per_night", recovery.alert_text().alias("message"))


def alert_sql(latest: str) -> str:
    """Alert rows at a scrape: a literal, or the newest of every area."""
    return f"""{t.with_tables('weekly')},
latest AS (SELECT search_area, {latest} AS newest_at FROM weekly GROUP BY search_area),
dated AS (SELECT * FROM weekly JOIN latest USING (search_area)),
history AS (SELECT search_area, facility_id, substr(scraped_at, 1, 10) AS scrape_date,
    max(CAST(is_available AS INTEGER)) AS ever FROM dated WHERE scraped_at < newest_at GROUP BY ALL),
unavailable AS (SELECT search_area, facility_id, min(scrape_date) AS first_unavailable_date FROM history
  WHERE ever = 0 GROUP BY ALL),
available AS (SELECT DISTINCT search_area, facility_id FROM history WHERE ever = 1),
alerts AS (SELECT w.facility_id, name, url, w.search_area, first_unavailable_date, scraped_at AS recovered_at,
    round(total_price / nullif(num_nights, 0), 2) AS price_per_night, currency, rating
  FROM dated w JOIN unavailable USING (search_area, facility_id)
  LEFT JOIN available a USING (search_area, facility_id)
  WHERE a.facility_id IS NULL AND w.is_available AND w.scraped_at = newest_at)"""


QUERIES = {
    "parse_number": (parse_number, _PARSE_NUMBER),
    "parse_digits": (
        parse_digits,
        "SELECT l_partkey, l_linenumber, CASE WHEN l_orderkey % 5 <> 0 THEN l_orderkey END AS reviews FROM lineitem",
    ),
    "sanitised_areas": (
        sanitised_areas,
        "SELECT c_custkey, c_mktsegment || '_é_' || c_custkey || '__Land-' || c_nationkey AS search_area, "
        "c_mktsegment || '_é_' || c_custkey AS city, 'Land-' || c_nationkey AS country FROM customer",
    ),
    "currency_codes": (currency_codes, _CURRENCY_CODES),
    "coerce_booking": _coerced(schemas.BOOKING_BRONZE),
    "coerce_airbnb": _coerced(schemas.AIRBNB_BRONZE),
    "coerce_facility": _coerced(schemas.FACILITY_BRONZE),
    "coerce_availability": _coerced(schemas.AVAILABILITY_BRONZE),
    "first_occurrence": (first_occurrence, _FIRST_OCCURRENCE),
    "schema_evolution_union": (
        schema_versions,
        f"{t.with_tables('airbnb')} SELECT facility_id, scraped_at, total_price, "
        "CASE WHEN num_adults > 3 THEN latitude END AS latitude, "
        "CASE WHEN num_adults > 3 THEN num_adults END AS num_adults FROM airbnb",
    ),
    "discovered_listings": (
        discovered_listings,
        f"{t.with_tables('weekly')} SELECT DISTINCT facility_id, url FROM weekly WHERE search_area <> 'Area2__Web'",
    ),
    "discovered_ids": (
        discovered_ids,
        f"{t.with_tables('weekly')} SELECT DISTINCT facility_id FROM weekly",
    ),
    "pending_listings": (pending_listings, _PENDING),
    "pending_capped": (pending_capped, f"{_PENDING} ORDER BY facility_id, url LIMIT 20"),
    "pending_given_ids": (
        pending_given_ids,
        f"{t.with_tables('weekly')}, given AS (SELECT id, row_number() OVER (ORDER BY min(pos)) - 1 AS rank FROM "
        f"(SELECT unnest({GIVEN_IDS}) AS id, unnest(range({len(GIVEN_IDS)})) AS pos) GROUP BY id) "
        "SELECT rank, id AS facility_id FROM given WHERE id NOT IN (SELECT facility_id FROM weekly "
        "WHERE is_available AND scraped_at = '2024-01-08T00:00:00') ORDER BY rank LIMIT 30",
    ),
    "availability_recovery": (
        availability_recovery,
        alert_sql("'2024-01-15T00:00:00'") + " SELECT * FROM alerts WHERE search_area = 'Area1__Web'",
    ),
    "availability_recovery_all_areas": (
        availability_recovery_all_areas,
        alert_sql("max(scraped_at)") + " SELECT * FROM alerts",
    ),
    "alert_text": (
        alert_text,
        alert_sql("max(scraped_at)") + " SELECT facility_id, price_per_night, '[ALERT] ''' || name || ''' (id=' || facility_id || "
        "') in ' || search_area || ' is AVAILABLE again as of ' || recovered_at || '. Price: ' || "
        "coalesce(price_per_night || ' ' || currency, 'price unknown') || '. URL: ' || url AS message FROM alerts",
    ),
}
