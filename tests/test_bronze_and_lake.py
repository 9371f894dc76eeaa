import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from staylens import schemas
from staylens.plans import refresh
from staylens.sources import bronze, silver_store
from staylens.sources.lake import DataLake, spark_sql_text

ROW = "facility_id string, search_area string, scraped_at string, total_price string, is_available boolean"
STAY = {"checkin_date": "2026-06-01", "checkout_date": "2026-06-07", "num_adults": 2}


def rows(spark, *tuples):
    return spark.createDataFrame(list(tuples), ROW).withColumns(
        {name: F.lit(value) for name, value in STAY.items()}
    )


def test_append_layout_and_idempotence(spark, tmp_path):
    base = str(tmp_path)
    first = rows(
        spark,
        ("0123", "New York/Manhattan", "2024-01-15T08:00:00", "10", True),
        ("7", "Tirana, Albania", "2024-01-15T08:00:00", "bad", None),
    )
    bronze.append(first, bronze.BOOKING, base)
    bronze.append(first, bronze.BOOKING, base)
    bronze.append(
        rows(spark, ("0123", "New York/Manhattan", "2024-01-16T08:00:00", "11", True)), bronze.BOOKING, base
    )
    root = tmp_path / "bronze/booking/accommodations"
    assert sorted(p.name for p in root.glob("search_area=*")) == [
        "search_area=New_York_Manhattan",
        "search_area=Tirana__Albania",
    ]
    assert (root / "search_area=Tirana__Albania/scrape_date=2024-01-15/run=2024-01-15T08-00-00").is_dir()
    frame = bronze.read(spark, bronze.BOOKING, base)
    assert frame.columns == [*schemas.BOOKING_BRONZE.names, "scrape_date"]
    got = sorted((r.facility_id, r.search_area, str(r.scrape_date), r.total_price, r.is_available) for r in frame.collect())
    assert got == [
        ("0123", "New_York_Manhattan", "2024-01-15", 10.0, True),
        ("0123", "New_York_Manhattan", "2024-01-16", 11.0, True),
        ("7", "Tirana__Albania", "2024-01-15", None, False),
    ]
    raw = bronze.read(spark, bronze.BOOKING, base, extras=True)
    assert raw.columns[-3:] == ["run", "scrape_date", "search_area_raw"]


def test_empty_input_is_refused(spark, tmp_path):
    empty = rows(spark, ("a", "b", "2024-01-15T08:00:00", "1", True)).where("false")
    with pytest.raises(ValueError):
        bronze.append(empty, bronze.BOOKING, str(tmp_path))
    with pytest.raises(ValueError):
        silver_store.push(
            spark.createDataFrame([], schemas.SILVER), str(tmp_path), silver_store.BOOKING_FOLDER
        )
    assert silver_store.snapshots(spark, str(tmp_path), silver_store.BOOKING_FOLDER) == []


def test_area_filter_prunes_partitions(spark, tmp_path):
    bronze.append(
        rows(spark, ("1", "A", "2024-01-15T08:00:00", "1", True), ("2", "B", "2024-01-15T08:00:00", "1", True)),
        bronze.BOOKING,
        str(tmp_path),
    )
    frame = bronze.read(spark, bronze.BOOKING, str(tmp_path)).where("search_area = 'A'").select("facility_id")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(search_area" in plan
    assert "raw_html_snippet" not in plan
    assert [r.facility_id for r in frame.collect()] == ["1"]


def test_facility_runs_merge(spark, tmp_path):
    base = str(tmp_path)
    make = lambda *t: spark.createDataFrame(list(t), "facility_id string, scraped_at string, rating double")
    at = "2024-01-15T08:00:00"
    bronze.append(make(("a", at, 1.0), ("b", at, 1.0)), bronze.FACILITY, base)
    bronze.append(make(("b", at, 2.0), ("c", at, 2.0)), bronze.FACILITY, base)
    bronze.append(make(("a", "2024-01-16T08:00:00", 3.0)), bronze.FACILITY, base)
    got = sorted((r.facility_id, r.rating) for r in bronze.read(spark, bronze.FACILITY, base).collect())
    assert got == [("a", 1.0), ("a", 3.0), ("b", 2.0), ("c", 2.0)]


def test_directory_per_facility_layout_is_readable(spark, tmp_path):
    """Lakes with facility_id=/scrape_date= directories keep ids as text."""
    root = bronze.AVAILABILITY.root(str(tmp_path))
    spark.createDataFrame(
        [("0123", "2024-02-01", True, 2, "2024-01-15T08:00:00", "2024-01-15"),
         ("abc", "2024-02-01", False, None, "2024-01-15T08:00:00", "2024-01-15")],
        "facility_id string, date string, is_available boolean, min_nights bigint, scraped_at string, scrape_date string",
    ).write.partitionBy("facility_id", "scrape_date").parquet(root)
    got = bronze.read(spark, bronze.AVAILABILITY, str(tmp_path)).orderBy("facility_id").collect()
    assert [(r.facility_id, r.min_nights, str(r.scrape_date)) for r in got] == [
        ("0123", 2, "2024-01-15"), ("abc", None, "2024-01-15")]


def test_lake_registry_snapshots_and_sql(spark, tmp_path):
    base = str(tmp_path)
    bronze.append(
        rows(
            spark,
            ("1", "Tirana__Albania", "2024-01-15T08:00:00", "154.45", True),
            ("2", "Tirana__Albania", "2024-01-15T08:00:00", "300", True),
        ),
        bronze.BOOKING,
        base,
    )
    lake = DataLake(spark, base)
    assert lake.registered == ["bronze.booking.accommodations", "booking_accommodation_bronze"]
    with pytest.raises(AnalysisException):
        lake.query("SELECT * FROM silver.booking.accommodations")
    refresh.push_booking_silver(spark, base, "2024-01-15T09:00:00")
    refresh.push_booking_silver(spark, base, "2024-01-16T09:00:00")
    refresh.push_booking_silver(spark, base, "2024-01-16T09:00:00")
    lake.refresh()
    count = lambda sql, args=None: lake.query(sql, args).first()[0]
    assert count("SELECT count(*) FROM silver.booking.accommodations") == 2
    assert count("SELECT count(*) FROM silver_history.booking.accommodations") == 4
    assert count(
        "SELECT round(total_price / date_diff('day', cast(checkin_date as date), cast('2026-06-03' as date)), 2) "
        "FROM bronze.booking.accommodations WHERE facility_id = :id",
        {"id": "1"},
    ) == 77.22
    assert count("SELECT total_price / 0 FROM bronze.booking.accommodations") is None
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert lake.table("bronze.booking.accommodations").count() == 2
    assert count("SELECT count(*) FROM booking_accommodation_bronze") == 2
    assert DataLake(spark, str(tmp_path / "empty")).registered == []
    with pytest.raises(AnalysisException):
        lake.query("SELECT * FROM bronze.booking.accommodations")


def test_sql_text_leaves_literals_alone():
    text = spark_sql_text("SELECT 'bronze.airbnb.facility' -- silver.airbnb.accommodations\nFROM bronze.airbnb.facility")
    assert text == (
        "SELECT 'bronze.airbnb.facility' -- silver.airbnb.accommodations\nFROM `bronze.airbnb.facility`"
    )


def test_rejects_are_set_aside(spark):
    df = rows(
        spark,
        ("1", "A", "2024-01-15T08:00:00", "1", True),
        ("2", "", "2024-01-15T08:00:00", "1", True),
        ("3", None, "2024-01-15T08:00:00", "1", True),
        ("4", "A", "yesterday", "1", True),
    )
    good, bad = refresh.split_rejects(df)
    assert [r.facility_id for r in good.collect()] == ["1"]
    assert sorted(r.facility_id for r in bad.collect()) == ["2", "3", "4"]


def test_sql_text_leaves_comments_and_quotes_alone():
    for kept in (
        "/* bronze.airbnb.facility /* round(1) */ silver.booking.accommodations */",
        '"bronze.airbnb.facility"', "`silver.airbnb.accommodations`", "r'\\'", "'it\\'s round(2)'", "-- round(3)", "/* never closed round(4)",
    ):
        assert spark_sql_text(f"SELECT 1 {kept}") == f"SELECT 1 {kept}"
    assert spark_sql_text("SELECT r'\\', round(x) /* a */ FROM silver.airbnb.accommodations") == (
        "SELECT r'\\', round_scaled(x) /* a */ FROM `silver.airbnb.accommodations`"
    )


def test_two_lakes_and_the_session_do_not_disturb_each_other(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    lakes = []
    for name, price in (("a", "10"), ("b", "20")):
        base = str(tmp_path / name)
        bronze.append(rows(spark, ("1", "A", "2024-01-15T08:00:00", price, True)), bronze.BOOKING, base)
        lakes.append(DataLake(spark.newSession(), base))

    def ask(lake):
        return [lake.query("SELECT max(total_price), max(total_price / 0) FROM bronze.booking.accommodations").first()[:] for _ in range(5)]

    def strict(_):
        with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
            spark.sql("SELECT 1 / 0").collect()

    with ThreadPoolExecutor(4) as pool:
        answers = [pool.submit(ask, lake) for lake in lakes]
        list(pool.map(strict, range(5)))
    assert [set(a.result()) for a in answers] == [{(10.0, None)}, {(20.0, None)}]
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
