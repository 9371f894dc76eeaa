import pytest
from pyspark.sql import functions as F

from staylens import schemas
from staylens.operators import recovery, worklist
from staylens.sources import bronze
from staylens.streaming import landing
from staylens.streaming import recovery as streaming

ROW = "facility_id string, search_area string, scraped_at string, is_available boolean, total_price double"
D1, D2, D3 = "2024-01-14T08:00:00", "2024-01-15T08:00:00", "2024-01-16T08:00:00"


def history(spark, *tuples):
    return (
        spark.createDataFrame(list(tuples), ROW)
        .withColumn("name", F.concat(F.lit("Hotel "), "facility_id"))
        .withColumn("url", F.lit("http://x"))
        .withColumn("checkin_date", F.lit("2024-02-01"))
        .withColumn("checkout_date", F.lit("2024-02-03"))
        .withColumn("currency", F.lit("EUR"))
        .withColumn("rating", F.lit(8.0))
    )


ROWS = [
    ("back", "A__X", D1, False, None),
    ("back", "A__X", D2, True, 120.0),
    ("always", "A__X", D1, True, 1.0),
    ("always", "A__X", D2, True, 1.0),
    ("never", "A__X", D1, False, 1.0),
    ("never", "A__X", D2, False, 1.0),
    ("mixed", "A__X", "2024-01-13T08:00:00", True, 1.0),
    ("mixed", "A__X", D1, False, 1.0),
    ("mixed", "A__X", D2, True, 1.0),
    ("twice", "A__X", "2024-01-14T07:00:00", False, 1.0),
    ("twice", "A__X", D1, True, 1.0),
    ("twice", "A__X", D2, True, 1.0),
    ("new", "A__X", D2, True, 1.0),
    ("other", "B", D1, False, 1.0),
    ("other", "B", D3, True, None),
]


def test_recovery_cases(spark):
    alerts = recovery.availability_recovery(history(spark, *ROWS), "A, X", D2)
    assert alerts.columns == schemas.ALERT.names
    (row,) = alerts.collect()
    assert (row.facility_id, row.first_unavailable_date, row.recovered_at) == ("back", "2024-01-14", D2)
    assert row.price_per_night == 60.0
    message = alerts.select(recovery.alert_text().alias("m")).first().m
    assert message == (
        "[ALERT] 'Hotel back' (id=back) in A__X is AVAILABLE again as of 2024-01-15T08:00:00. "
        "Price: 60.0 EUR. URL: http://x"
    )


def test_recovery_in_all_areas(spark):
    alerts = recovery.availability_recovery_all_areas(history(spark, *ROWS))
    assert sorted((r.search_area, r.facility_id) for r in alerts.collect()) == [("A__X", "back"), ("B", "other")]
    text = alerts.where("facility_id = 'other'").select(recovery.alert_text().alias("m")).first().m
    assert "Price: price unknown" in text


def test_first_scrape_raises_nothing(spark):
    df = history(spark, ("a", "A__X", D2, False, 1.0))
    assert recovery.availability_recovery(df, "A__X", D2).isEmpty()


@pytest.mark.parametrize("area,at", [("A'; DROP", D2), ("A", "2024-01-15"), ("", D2), ("A", D2 + "\n")])
def test_arguments_are_checked(spark, area, at):
    with pytest.raises(ValueError):
        recovery.availability_recovery(history(spark, *ROWS), area, at)


def test_worklist(spark):
    found = spark.createDataFrame(
        [("a", "u1"), ("a", "u1"), ("b", "u2"), ("c", None), (None, "u"), ("d", "u4")], "facility_id string, url string"
    )
    landed = spark.createDataFrame([("a", "2024-01-15"), ("b", "2024-01-14")], "facility_id string, scrape_date string")
    landed = landed.withColumn("scrape_date", F.col("scrape_date").cast("date"))
    listings = worklist.discover_listings(found)
    assert sorted(r.facility_id for r in listings.collect()) == ["a", "b", "d"]
    assert [r.facility_id for r in worklist.discover_listings(found, ["d", "x"]).collect()] == ["d"]
    pending = worklist.pending(listings, landed, "2024-01-15")
    assert sorted(r.facility_id for r in pending.collect()) == ["b", "d"]
    assert [r.facility_id for r in worklist.pending(listings, landed, "2024-01-15", 1).collect()] == ["b"]
    given = worklist.discover_facility_ids(found, ["z", "a", "z", "b"])
    capped = worklist.pending(given, landed, "2024-01-15", 2).orderBy("rank")
    assert [r.facility_id for r in capped.collect()] == ["z", "b"]
    assert sorted(r.facility_id for r in worklist.discover_facility_ids(found).collect()) == ["a", "b", "c", "d"]


def test_stream_landing_over_several_batches(spark, tmp_path):
    base, raw = str(tmp_path / "lake"), str(tmp_path / "raw")
    history(spark, *ROWS).repartition(5).write.parquet(raw)
    schema = spark.read.parquet(raw).schema
    for _ in range(2):
        rows = landing.raw_stream(spark, raw, schema, files_per_batch=1)
        landing.start_landing(rows, bronze.BOOKING, base, str(tmp_path / "cp")).awaitTermination()
    assert bronze.read(spark, bronze.BOOKING, base).count() == len(ROWS)
    history(spark, ("late", "A__X", D2, True, 1.0)).write.mode("append").parquet(raw)
    rows = landing.raw_stream(spark, raw, schema)
    landing.start_landing(rows, bronze.BOOKING, base, str(tmp_path / "cp")).awaitTermination()
    assert bronze.read(spark, bronze.BOOKING, base).count() == len(ROWS) + 1


def test_stream_recovery_keeps_state_between_batches(spark, tmp_path):
    raw, out, cp = (str(tmp_path / name) for name in ("raw", "out", "cp"))
    schema = history(spark, *ROWS).schema
    for day in ("2024-01-13", "2024-01-14", "2024-01-15", "2024-01-16"):
        part = history(spark, *[r for r in ROWS if r[2].startswith(day)])
        part.write.mode("append").parquet(raw)
        rows = landing.raw_stream(spark, raw, schema)
        streaming.start_recovery(rows, out, cp).awaitTermination()
    alerts = sorted(
        (r.facility_id, r.first_unavailable_date, r.recovered_at) for r in streaming.read_alerts(spark, out).collect()
    )
    assert alerts == [
        ("back", "2024-01-14", D2),
        ("other", "2024-01-14", D3),
        ("twice", "2024-01-14", D1),
    ]


def test_stream_recovery_is_the_same_for_every_order(spark, tmp_path):
    schema = history(spark, *ROWS).schema
    want = None
    for number, order in enumerate(([0], list(range(len(ROWS))), list(reversed(range(len(ROWS)))))):
        raw, out, cp = (str(tmp_path / f"{name}{number}") for name in ("raw", "out", "cp"))
        for i in order:
            part = history(spark, *(ROWS if number == 0 else [ROWS[i]]))
            part.coalesce(1).write.mode("append").parquet(raw)
            rows = landing.raw_stream(spark, raw, schema)
            streaming.start_recovery(rows, out, cp).awaitTermination()
        got = sorted(map(str, streaming.read_alerts(spark, out).collect()))
        want = want or got
        assert got == want and got


def test_all_areas_share_one_aggregation(spark, tmp_path):
    path = str(tmp_path / "rows")
    history(spark, *ROWS).write.parquet(path)
    alerts = recovery.availability_recovery_all_areas(spark.read.parquet(path))
    assert alerts.count() == 2
    alerts.collect()
    plan = alerts._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan and "partial_min" in plan


def written(root, before=()):
    """Bytes of Parquet files below a folder that were not there before."""
    files = {p: p.stat().st_size for p in root.rglob("*.parquet")}
    return files, sum(size for p, size in files.items() if p not in before)


def test_a_batch_writes_in_proportion_to_itself(spark, tmp_path):
    """A large state, then small batches: none of them writes the state again."""
    schema = history(spark, *ROWS).schema
    big = spark.range(60_000).select(
        F.concat(F.lit("f"), F.col("id")).alias("facility_id"), F.lit("Z__Q").alias("search_area"), F.lit(D1).alias("scraped_at"),
        (F.col("id") % 2 == 0).alias("is_available"), F.sha2(F.col("id").cast("string"), 256).alias("name"),
    )
    for name in set(schema.names) - set(big.columns):
        big = big.withColumn(name, F.lit(None).cast(schema[name].dataType))
    out = tmp_path / "out"

    def run(frame):
        frame.select(*schema.names).coalesce(1).write.mode("append").parquet(str(tmp_path / "raw"))
        rows = landing.raw_stream(spark, str(tmp_path / "raw"), schema)
        streaming.start_recovery(rows, str(out), str(tmp_path / "cp")).awaitTermination()

    run(big)
    before, state_bytes = written(out)
    sizes = []
    for i in range(9):
        run(history(spark, ROWS[i % len(ROWS)]))
        before, new = written(out, before)
        sizes.append(new)
    large = [s for s in sizes if s > state_bytes / 10]
    assert len(large) <= 1, (state_bytes, sizes)  # the one merge that takes the large delta in
    from staylens.sources import commits

    deltas = streaming._deltas(commits.state(spark, f"{out}/recovery"))
    assert len(deltas) <= 2 * streaming.FAN


def test_a_lost_batch_is_made_up_for(spark, tmp_path, monkeypatch):
    from staylens.sources import commits, storage

    schema = history(spark, *ROWS).schema
    out, cp, raw = (str(tmp_path / n) for n in ("out", "cp", "raw"))
    for at, row in enumerate(ROWS):
        history(spark, row).coalesce(1).write.mode("append").parquet(raw)
        if at % 2:
            with monkeypatch.context() as m:
                m.setattr(storage, "create_text", lambda *a: 1 / 0)
                with pytest.raises(Exception):
                    streaming.start_recovery(landing.raw_stream(spark, raw, schema), out, cp).awaitTermination()
        streaming.start_recovery(landing.raw_stream(spark, raw, schema), out, cp).awaitTermination()
    alerts = sorted((r.facility_id, r.first_unavailable_date, r.recovered_at) for r in streaming.read_alerts(spark, out).collect())
    assert alerts == [("back", "2024-01-14", D2), ("other", "2024-01-14", D3), ("twice", "2024-01-14", D1)]
