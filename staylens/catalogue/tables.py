"""Listing-shaped tables derived from the benchmark tables by Spark.

No listing data is supplied, so line items stand in for search observations and
detail scrapes, nations for city centres, events for an availability history.
Every row of the source tables takes part. ``SQL`` holds the same derivations
as common table expressions for the comparison queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, *keys: str) -> DataFrame:
    """A table whose rows are about to grow, on at least as many tasks as cores.

    Large inputs already arrive in more tasks than that and are not moved; a
    file of a single row group would keep all but one core idle.
    """
    frame = table(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    if frame._jdf.queryExecution().toRdd().getNumPartitions() >= cores:
        return frame
    return frame.repartition(cores, *keys)


def _day(value: Column) -> Column:
    return value.cast("date").cast("string")


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with order date, part, and the supplier's nation and region.

    Quantity and discount travel as one column: so the joins of a table that needs no
    discount shuffle the same columns as one that does, and a query over both shuffles once.
    The status travels as the flag it is read for.
    """
    lineitem = spread_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber")
    lineitem = lineitem.withColumns(
        {"_amounts": F.array("l_quantity", "l_discount"), "is_available": F.col("l_linestatus") == "F"}
    ).drop("l_quantity", "l_discount", "l_linestatus")
    orders = table(spark, sf_dir, "orders")
    part = table(spark, sf_dir, "part")
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumns({"l_quantity": F.get("_amounts", F.lit(0)), "l_discount": F.get("_amounts", F.lit(1))})
    )


def _search_columns(items: DataFrame) -> DataFrame:
    key = F.col("l_partkey")
    checkin = F.date_add(F.lit("2026-06-01").cast("date"), F.col("p_size") % 30)
    checkout = F.date_add(checkin, (key % 7).cast("int"))
    hour = F.lpad((F.col("l_linenumber") % 24).cast("string"), 2, "0")
    return items.select(
        F.when(key % 101 == 0, "unknown").otherwise(F.concat(F.lit("P-"), key)).alias("facility_id"),
        F.concat("p_name", F.lit(" "), key).alias("name"),
        F.concat(F.lit("/rooms/"), key).alias("url"),
        F.concat("n_name", F.lit("__"), "r_name").alias("search_area"),
        _day(checkin).alias("checkin_date"),
        _day(checkout).alias("checkout_date"),
        F.concat(_day(F.col("o_orderdate")), F.lit("T"), hour, F.lit(":00:00")).alias("scraped_at"),
        F.col("l_linenumber").cast("bigint").alias("num_adults"),
        F.when(F.col("l_quantity") != 13, F.col("l_extendedprice")).alias("total_price"),
        F.when(F.col("l_returnflag") == "A", "€")
        .when(F.col("l_returnflag") == "N", "$")
        .when(F.col("l_linenumber") % 2 == 0, "£")
        .otherwise("CHF")
        .alias("currency"),
        "p_size",
        F.col("l_quantity").cast("bigint").alias("num_reviews"),
        F.when(F.col("l_suppkey") % 5 != 0, F.col("l_suppkey") % 5).alias("num_rooms_available"),
        F.col("p_brand").alias("neighbourhood"),
        F.col("p_type").alias("accommodation_type"),
        F.concat("p_brand", F.lit("|"), "p_type").alias("tags"),
        "is_available",
        F.col("o_orderdate").cast("date").alias("scrape_date"),
        "l_suppkey",
        "l_discount",
    )


def booking_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search_columns(_items(spark, sf_dir)).select(
        "*",
        (F.col("p_size") / 10.0).alias("rating"),
        (F.col("l_discount") * 100).alias("distance_from_center_km"),
    ).drop("p_size", "l_suppkey", "l_discount")


def airbnb_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = F.col("l_suppkey") % 3 != 0
    return _search_columns(_items(spark, sf_dir)).select(
        "*",
        (F.col("p_size") / 10.0).alias("rating"),
        F.when(located, 40 + F.col("l_suppkey") % 90 / 10.0).alias("latitude"),
        F.when(located, 10 + F.col("l_suppkey") % 70 / 10.0).alias("longitude"),
    ).drop("p_size", "l_suppkey", "l_discount", "num_rooms_available")


def facility_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One detail scrape per line item."""
    line, supplier = F.col("l_linenumber"), F.col("l_suppkey")
    items = spread_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber")
    return items.select(
        F.concat(F.lit("P-"), "l_partkey").alias("facility_id"),
        F.concat(_day(F.col("l_shipdate")), F.lit("T0"), (line % 10).cast("string"), F.lit(":00:00")).alias(
            "scraped_at"
        ),
        F.when(line % 3 != 0, 41 + supplier % 80 / 10.0).alias("latitude"),
        F.when(line % 4 != 0, 11 + supplier % 60 / 10.0).alias("longitude"),
        line.cast("bigint").alias("num_bedrooms"),
        (line + 1).cast("bigint").alias("num_guests"),
        (F.col("l_returnflag") == "R").alias("is_superhost"),
        (F.col("l_linestatus") == "F").alias("amenity_pool"),
        (F.col("l_tax") > 0.04).alias("amenity_wifi"),
        F.col("l_returnflag").alias("cancellation_policy"),
        F.col("l_shipdate").cast("date").alias("scrape_date"),
    )


def city_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One centre per nation; some are missing, some without coordinates."""
    key = F.col("n_nationkey")
    return (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .where(key % 7 != 6)
        .select(
            F.col("n_name").alias("city"),
            F.col("r_name").alias("country"),
            F.when(key % 5 != 4, 42 + key / 10.0).alias("centre_lat"),
            F.when(key % 5 != 4, 12 + key / 20.0).alias("centre_lon"),
        )
    )


def weekly_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly scrapes of one facility per user and event type, available at a high value."""
    user = F.col("user_id")
    facility = F.concat(user, F.lit("-"), "event_type")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("U-"), facility).alias("facility_id"),
        F.concat(F.lit("User "), facility).alias("name"),
        F.concat(F.lit("/rooms/"), facility).alias("url"),
        F.concat(F.lit("Area"), user % 3, F.lit("__Web")).alias("search_area"),
        F.lit("2026-06-01").alias("checkin_date"),
        _day(F.date_add(F.lit("2026-06-01").cast("date"), (user % 4).cast("int"))).alias("checkout_date"),
        F.concat(_day(F.date_trunc("week", F.col("ts").cast("timestamp"))), F.lit("T00:00:00")).alias("scraped_at"),
        F.lit(2).cast("bigint").alias("num_adults"),
        F.col("value").alias("total_price"),
        F.lit("EUR").alias("currency"),
        (user % 50 / 5.0).alias("rating"),
        (F.col("value") >= 150).alias("is_available"),
    )


_SEARCH_SQL = """
    CASE WHEN l_partkey % 101 = 0 THEN 'unknown' ELSE 'P-' || l_partkey END AS facility_id,
    p_name || ' ' || l_partkey AS name,
    '/rooms/' || l_partkey AS url,
    n_name || '__' || r_name AS search_area,
    n_name AS city,
    r_name AS country,
    strftime(DATE '2026-06-01' + CAST(p_size % 30 AS INTEGER), '%Y-%m-%d') AS checkin_date,
    strftime(DATE '2026-06-01' + CAST(p_size % 30 + l_partkey % 7 AS INTEGER), '%Y-%m-%d') AS checkout_date,
    strftime(o_orderdate, '%Y-%m-%d') || 'T' || lpad(CAST(l_linenumber % 24 AS VARCHAR), 2, '0') || ':00:00' AS scraped_at,
    CAST(l_partkey % 7 AS BIGINT) AS num_nights,
    CAST(l_linenumber AS BIGINT) AS num_adults,
    CASE WHEN l_quantity <> 13 THEN l_extendedprice END AS total_price,
    CASE WHEN l_returnflag = 'A' THEN '€' WHEN l_returnflag = 'N' THEN '$'
         WHEN l_linenumber % 2 = 0 THEN '£' ELSE 'CHF' END AS currency,
    CAST(l_quantity AS BIGINT) AS num_reviews,
    p_brand AS neighbourhood,
    p_type AS accommodation_type,
    p_brand || '|' || p_type AS tags,
    l_linestatus = 'F' AS is_available,
    CAST(o_orderdate AS DATE) AS scrape_date,
    CASE WHEN l_partkey % 101 = 0 THEN p_name || ' ' || l_partkey END AS name_key
"""
_ITEMS_SQL = """
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
"""

SQL = {
    "booking": f"""booking AS (SELECT {_SEARCH_SQL},
        CASE WHEN l_suppkey % 5 <> 0 THEN CAST(l_suppkey % 5 AS BIGINT) END AS num_rooms_available,
        p_size / 10.0::DOUBLE AS rating, l_discount * 100 AS distance_from_center_km {_ITEMS_SQL})""",
    "airbnb": f"""airbnb AS (SELECT {_SEARCH_SQL},
        p_size / 10.0::DOUBLE AS rating,
        CASE WHEN l_suppkey % 3 <> 0 THEN 40 + (l_suppkey % 90) / 10.0::DOUBLE END AS latitude,
        CASE WHEN l_suppkey % 3 <> 0 THEN 10 + (l_suppkey % 70) / 10.0::DOUBLE END AS longitude {_ITEMS_SQL})""",
    "facility": """facility AS (SELECT 'P-' || l_partkey AS facility_id,
        strftime(l_shipdate, '%Y-%m-%d') || 'T0' || (l_linenumber % 10) || ':00:00' AS scraped_at,
        CASE WHEN l_linenumber % 3 <> 0 THEN 41 + (l_suppkey % 80) / 10.0::DOUBLE END AS latitude,
        CASE WHEN l_linenumber % 4 <> 0 THEN 11 + (l_suppkey % 60) / 10.0::DOUBLE END AS longitude,
        CAST(l_linenumber AS BIGINT) AS num_bedrooms, CAST(l_linenumber + 1 AS BIGINT) AS num_guests,
        l_returnflag = 'R' AS is_superhost, l_linestatus = 'F' AS amenity_pool,
        l_tax > 0.04 AS amenity_wifi, l_returnflag AS cancellation_policy,
        CAST(l_shipdate AS DATE) AS scrape_date FROM lineitem)""",
    "centres": """centres AS (SELECT n_name AS city, r_name AS country,
        CASE WHEN n_nationkey % 5 <> 4 THEN 42 + n_nationkey / 10.0::DOUBLE END AS centre_lat,
        CASE WHEN n_nationkey % 5 <> 4 THEN 12 + n_nationkey / 20.0::DOUBLE END AS centre_lon
        FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 7 <> 6)""",
    "weekly": """weekly AS (SELECT 'U-' || user_id || '-' || event_type AS facility_id,
        'User ' || user_id || '-' || event_type AS name, '/rooms/' || user_id || '-' || event_type AS url, 'Area' || (user_id % 3) || '__Web' AS search_area,
        CAST(user_id % 4 AS BIGINT) AS num_nights,
        strftime(date_trunc('week', ts), '%Y-%m-%d') || 'T00:00:00' AS scraped_at,
        value AS total_price, 'EUR' AS currency, (user_id % 50) / 5.0::DOUBLE AS rating,
        value >= 150 AS is_available FROM events)""",
}


def with_tables(*names: str) -> str:
    """The WITH clause that defines some of the derived tables."""
    return "WITH " + ",\n".join(SQL[name] for name in names)
