import pytest
from pyspark.sql import functions as F

from staylens import schemas
from staylens.operators.coerce import align_to, coerce_to
from staylens.operators.lookup import skew_join
from staylens.operators.pick import latest_located_facility
from staylens.operators.scale import with_min_max_scaled
from staylens.plans import analyst, silver

BASE = {
    "facility_id": "h1", "name": "Hotel", "url": "u", "search_area": "Tirana__Albania",
    "checkin_date": "2026-06-01", "checkout_date": "2026-06-03", "scraped_at": "2026-05-01T10:00:00",
    "num_adults": 2, "total_price": 120.0, "currency": "€", "rating": 8.5, "num_reviews": 10,
    "num_rooms_available": 3, "neighbourhood": "Centre", "accommodation_type": "Flat",
    "distance_from_center_km": 0.5, "is_available": True, "scrape_date": "2026-05-01",
}
EXTRA = {"latitude": None, "longitude": None}
DDL = (
    "facility_id string, name string, url string, search_area string, checkin_date string, "
    "checkout_date string, scraped_at string, num_adults bigint, total_price double, currency string, "
    "rating double, num_reviews bigint, num_rooms_available bigint, neighbourhood string, "
    "accommodation_type string, distance_from_center_km double, is_available boolean, scrape_date string, "
    "latitude double, longitude double"
)


def bronze(spark, *changes):
    names = [part.split()[0] for part in DDL.split(", ")]
    rows = [{**BASE, **EXTRA, **change} for change in changes]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], DDL)


def by_id(df):
    return {r.facility_id: r for r in df.collect()}


def test_booking_silver_golden(spark):
    rows = by_id(
        silver.booking_silver(
            bronze(
                spark,
                {},
                {"scraped_at": "2026-04-01T10:00:00", "scrape_date": "2026-04-01", "total_price": 1.0},
                {"facility_id": "h-2", "total_price": 100.0, "num_adults": 1, "currency": "$"},
                {"facility_id": "h3", "checkout_date": "2026-06-01"},
                {"facility_id": "h4", "num_adults": 0},
                {"facility_id": "h5", "total_price": None, "currency": "CHF"},
                {"facility_id": "h6", "total_price": 1005.0, "num_adults": 100},
            )
        )
    )
    assert list(rows["h1"].asDict()) == schemas.SILVER.names
    one = rows["h1"]
    assert (one.num_nights, one.total_price) == (2, 120.0)
    assert (one.price_per_night, one.price_per_adult, one.price_per_adult_per_night) == (60.0, 60.0, 30.0)
    assert (one.city, one.country, one.currency) == ("Tirana", "Albania", "EUR")
    assert one._pk == "BOOK/tiranaALBANIA/h1/20260601_20260603/20260501"
    assert one._source == "BOOK"
    assert rows["h-2"].currency == "USD" and "/h_2/" in rows["h-2"]._pk
    assert rows["h3"].num_nights == 0 and rows["h3"].price_per_night is None
    assert rows["h3"].price_per_adult == 60.0 and rows["h3"].quality_price_score is None
    assert rows["h4"].price_per_adult is None
    assert (rows["h5"].price_per_night, rows["h5"].quality_price_score, rows["h5"].currency) == (None, None, "CHF")
    raw = {"h1": 8.5 / 30, "h-2": 8.5 / 50, "h6": 8.5 / 5.03}
    low, high = min(raw.values()), max(raw.values())
    for name, value in raw.items():
        assert rows[name].quality_price_score == pytest.approx((value - low) / (high - low))


def test_single_row_has_no_score(spark):
    assert silver.booking_silver(bronze(spark, {})).first().quality_price_score is None


def test_ties_and_unknown_ids(spark):
    df = bronze(
        spark,
        {"scraped_at": "2026-05-01T08:00:00", "total_price": 1.0},
        {"scraped_at": "2026-05-01T09:00:00", "total_price": 2.0},
        {"facility_id": "unknown", "name": "A"},
        {"facility_id": "unknown", "name": "B"},
        {"facility_id": "unknown", "name": "B", "scraped_at": "2026-05-01T07:00:00"},
    )
    rows = silver.booking_silver(df).collect()
    assert sorted((r.facility_id, r.name, r.total_price) for r in rows) == [
        ("h1", "Hotel", 2.0),
        ("unknown", "A", 120.0),
        ("unknown", "B", 120.0),
    ]


def test_airbnb_silver(spark):
    observed = bronze(
        spark,
        {"facility_id": "a1", "rating": 4.8, "currency": "£", "latitude": 1.0, "longitude": 1.0},
        {"facility_id": "a2", "rating": 4.0, "latitude": 41.328, "longitude": 19.818},
        {"facility_id": "a3", "search_area": "Nowhere__Land", "latitude": 1.0, "longitude": 1.0},
        {"facility_id": "a4"},
    )
    facilities = spark.createDataFrame(
        [
            ("a1", "2026-05-03T00:00:00", None, 19.0),
            ("a1", "2026-05-02T00:00:00", 41.4, 19.9),
            ("a1", "2026-05-01T00:00:00", 50.0, 50.0),
        ],
        "facility_id string, scraped_at string, latitude double, longitude double",
    )
    centres = spark.createDataFrame([("Tirana", "Albania", 41.3275, 19.8187)], schemas.CITY_CENTRES)
    rows = by_id(silver.airbnb_silver(observed, facilities, centres))
    assert rows["a1"].rating == 9.6 and rows["a1"].currency == "GBP"
    assert rows["a1"].distance_from_center_km == pytest.approx(10.54, abs=0.2)
    assert rows["a2"].distance_from_center_km == pytest.approx(0.081, abs=0.01)
    assert rows["a3"].distance_from_center_km is None and rows["a4"].distance_from_center_km is None
    assert rows["a1"].num_rooms_available is None
    assert rows["a1"]._pk.startswith("ABNB/tiranaALBANIA/a1/")
    both = silver.silver_union(silver.booking_silver(observed), silver.airbnb_silver(observed, facilities, centres))
    assert both.count() == 8 and both.columns == schemas.SILVER.names


def test_coerce_to_fills_and_cleans(spark):
    df = spark.createDataFrame(
        [("3.0", "x", None, "extra"), ("2.5", "7.5", True, "extra"), ("9007199254740993", "NaN", False, "e")],
        "num_adults string, total_price string, is_available boolean, other string",
    )
    rows = coerce_to(df, schemas.BOOKING_BRONZE).collect()
    assert [r.num_adults for r in rows] == [3, None, 9007199254740993]
    assert [r.total_price for r in rows] == [None, 7.5, None]
    assert [r.is_available for r in rows] == [False, True, False]
    assert rows[0].name is None and "other" not in rows[0].asDict()
    facility = coerce_to(df, schemas.FACILITY_BRONZE).first()
    assert facility.amenity_wifi is False and facility.num_guests is None
    assert align_to(df, schemas.SILVER).first().is_available is None


def test_skew_join_equals_plain_join(spark):
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
    )
    lookup = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    for how in ("left", "inner"):
        want = sorted(map(tuple, rows.join(lookup, ["k"], how).select("k", "v", "w").collect()), key=repr)
        plain = skew_join(rows, lookup, ["k"], how).select("k", "v", "w")
        assert sorted(map(tuple, plain.collect()), key=repr) == want


def test_heavy_key_is_spread_over_tasks(spark):
    rows = spark.range(200_000).select(F.when(F.col("id") % 20 == 0, F.col("id")).otherwise(1).alias("k"), F.col("id").alias("v")).repartition(20)
    lookup = spark.range(100_000).select(F.col("id").alias("k"), F.lit("x").alias("w"))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        per_task = skew_join(rows, lookup, ["k"], "inner").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for key in small:
            spark.conf.unset(key)
    assert sum(r["count"] for r in per_task) == 195_000
    assert max(r["count"] for r in per_task) < 150_000  # the heavy key alone has 190,000


def test_heavy_key_is_split_beside_an_aggregated_lookup(spark):
    """A third of all rows has one key, another sixth has none; the lookup is an aggregation on the key."""
    rows = (
        spark.range(240_000)
        .select(F.when(F.col("id") % 3 == 0, "P-1").when(F.col("id") % 6 == 1, None).otherwise(F.concat(F.lit("P-"), F.col("id"))).alias("facility_id"), F.col("id").alias("v"))
        .repartition(24)
    )
    facilities = spark.range(60_000).select(
        F.concat(F.lit("P-"), F.col("id") % 20_000).alias("facility_id"), F.col("id").cast("string").alias("scraped_at"),
        F.col("id").cast("double").alias("latitude"), F.lit(1.0).alias("longitude"),
    )
    conf = {
        "spark.sql.shuffle.partitions": "12",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        joined = skew_join(rows, latest_located_facility(facilities), ["facility_id"])
        counts = joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.count("latitude").alias("found"), F.sum("v").alias("v"))
        tasks = counts.collect()
        plan = counts._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert "skew=true" in plan
    assert sum(t.n for t in tasks) == 240_000
    assert sum(t.found for t in tasks) == 80_000 + sum(1 for i in range(20_000) if i % 3 and i % 6 != 1)
    sizes = sorted(t.n for t in tasks)
    assert sizes[-1] <= 4 * sizes[len(sizes) // 2]


def test_coerce_does_not_cut_fractions(spark):
    df = spark.createDataFrame([(3.7,), (4.0,), (None,)], "num_adults double")
    assert [r.num_adults for r in coerce_to(df, schemas.BOOKING_BRONZE).collect()] == [None, 4, None]

def test_scaling_never_uses_one_partition_for_rows(spark):
    scaled = with_min_max_scaled(spark.range(10).select(F.col("id").cast("double").alias("x")), "x")
    plan = scaled._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "BroadcastExchange" in plan
    assert sorted(r.x for r in scaled.collect())[-1] == 1.0


def test_dedup_shuffle_is_partial_and_reused(spark, tmp_path):
    path = str(tmp_path / "bronze")
    bronze(spark, {}, {"facility_id": "h2", "total_price": 50.0}).write.parquet(path)
    out = silver.booking_silver(spark.read.parquet(path))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    assert "ReusedExchange" in plan
    assert "Window" not in plan


def test_analyst_plans(spark):
    df = bronze(
        spark,
        {"search_area": "Rome__Italy"},
        {"facility_id": "h2", "search_area": "Rome__Italy", "total_price": 480.0},
        {"facility_id": "h3", "search_area": "Rome__Italy", "checkout_date": "2026-06-01"},
        {"facility_id": "h4", "is_available": False},
    ).withColumn("tags", F.lit(None).cast("string"))
    italy = analyst.country_scores(df, "Italy").collect()
    assert [r.quality_score for r in italy] == [1.0, 0.0]
    assert sorted(r.facility_id for r in analyst.affordable(df, 80.0).collect()) == ["h1", "h4"]
    assert analyst.cheapest_available(df, "Tirana__Albania").count() == 0
    assert [r.price_per_night for r in analyst.cheapest_available(df, "Rome__Italy").collect()] == [60.0, 240.0, None]
    table = silver.booking_silver(df)
    assert [r.facility_id for r in analyst.bargains(table, 50.0).collect()][:1] in (["h1"], ["h4"])
    near = analyst.best_near_centre(table, "Rome", 50.0, 0.7).collect()
    assert [r.facility_id for r in near] == ["h1"]
    facilities = coerce_to(
        spark.createDataFrame([("h1", 2), ("h1", 3), ("h9", 1)], "facility_id string, num_guests int"),
        schemas.FACILITY_BRONZE,
    )
    detail = analyst.facility_detail_for_city(table, facilities, "Rome").collect()
    assert sorted(r.num_guests for r in detail) == [2, 3]
