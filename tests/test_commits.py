"""Writes that are visible whole or not at all, beside older layouts, and once per delivery."""

import pytest
from pyspark.sql import functions as F

from staylens import schemas
from staylens.operators.coerce import coerce_to
from staylens.plans import refresh
from staylens.sources import bronze, commits, silver_store, storage
from staylens.streaming import landing

AT, LATER = "2024-01-15T08:00:00", "2024-01-16T08:00:00"


def rows(spark, *entries):
    return spark.createDataFrame(list(entries), "facility_id string, search_area string, scraped_at string, total_price double")


def details(spark, *entries):
    return spark.createDataFrame(list(entries), "facility_id string, scraped_at string, rating double")


def found(spark, base, dataset=bronze.BOOKING, value="total_price"):
    return sorted((r.facility_id, r.scraped_at, r[value]) for r in bronze.read(spark, dataset, base).collect())


class Killed(Exception):
    pass


def killed(*args, **kwargs):
    raise Killed


def test_a_lost_job_leaves_the_old_answer(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    bronze.append(rows(spark, ("1", "A", AT, 1.0), ("2", "A", AT, 1.0)), bronze.BOOKING, base)
    before = found(spark, base)
    for step in ("create_text", "move"):  # between data and log, and while data moves
        with monkeypatch.context() as m:
            m.setattr(storage, step, killed)
            with pytest.raises(Killed):
                bronze.append(rows(spark, ("1", "A", AT, 9.0)), bronze.BOOKING, base)
        assert found(spark, base) == before
    bronze.append(rows(spark, ("1", "A", AT, 9.0)), bronze.BOOKING, base)
    assert found(spark, base) == [("1", AT, 9.0)]
    assert len(commits.vacuum(spark, bronze.BOOKING.root(base))) == 2  # the replaced run, and that of the lost job
    assert found(spark, base) == [("1", AT, 9.0)]


def test_a_lost_rewrite_leaves_the_run(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    bronze.append(details(spark, ("a", AT, 1.0), ("b", AT, 1.0)), bronze.FACILITY, base)
    with monkeypatch.context() as m:
        m.setattr(commits, "publish", killed)
        with pytest.raises(Killed):
            bronze.append(details(spark, ("b", AT, 2.0)), bronze.FACILITY, base)
    assert found(spark, base, bronze.FACILITY, "rating") == [("a", AT, 1.0), ("b", AT, 1.0)]


def test_a_lost_push_leaves_the_snapshot(spark, tmp_path, monkeypatch):
    base, stamp = str(tmp_path), "2024-01-16T00:00:00"
    silver = coerce_to(spark.createDataFrame([("k1",)], "_pk string"), schemas.SILVER)
    silver_store.push(silver, base, silver_store.BOOKING_FOLDER, stamp)
    with monkeypatch.context() as m:
        m.setattr(storage, "create_text", killed)
        with pytest.raises(Killed):
            silver_store.push(silver.withColumn("_pk", F.lit("k2")), base, silver_store.BOOKING_FOLDER, stamp)
    assert [r._pk for r in silver_store.read_latest(spark, base, silver_store.BOOKING_FOLDER).collect()] == ["k1"]
    silver_store.push(silver.withColumn("_pk", F.lit("k2")), base, silver_store.BOOKING_FOLDER, stamp)
    assert [r._pk for r in silver_store.read_history(spark, base, silver_store.BOOKING_FOLDER).collect()] == ["k2"]


def test_two_writers_of_one_run_both_land(spark, tmp_path, monkeypatch):
    """The second writer publishes while the first derives its data: the first derives it again."""
    base = str(tmp_path)
    bronze.append(details(spark, ("a", AT, 1.0)), bronze.FACILITY, base)
    merge, calls = bronze._with_other_facilities, []

    def between(landed, before):
        calls.append(1)
        if len(calls) == 1:
            bronze.append(details(spark, ("b", AT, 2.0)), bronze.FACILITY, base)
        return merge(landed, before)

    monkeypatch.setattr(bronze, "_with_other_facilities", between)
    bronze.append(details(spark, ("c", AT, 3.0)), bronze.FACILITY, base)
    assert len(calls) == 3
    assert found(spark, base, bronze.FACILITY, "rating") == [("a", AT, 1.0), ("b", AT, 2.0), ("c", AT, 3.0)]


def test_log_numbers_are_taken_once(spark, tmp_path):
    path = f"{tmp_path}/_log/000000000001.commit"
    assert storage.create_text(spark, path, "first")
    assert not storage.create_text(spark, path, "second")
    assert storage.read_text(spark, path) == "first"
    assert storage.children(spark, f"{tmp_path}/_log") == ["000000000001.commit"]


def test_input_is_evaluated_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x

    base = str(tmp_path)
    counted = counted.asNondeterministic()
    bronze.append(details(spark, ("a", AT, 1.0)), bronze.FACILITY, base)
    for dataset, frame in (
        (bronze.BOOKING, rows(spark, *[(str(i), "A", AT, 1.0) for i in range(10)])),
        (bronze.FACILITY, details(spark, *[(str(i), AT, 1.0) for i in range(10)])),
    ):
        seen.value = 0
        name = frame.columns[-1]
        bronze.append(frame.withColumn(name, counted(name)), dataset, base)
        assert seen.value == 10


def test_folded_state_equals_the_log(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "FOLD", 3)
    base, root = str(tmp_path), bronze.BOOKING.root(str(tmp_path))
    for day in range(1, 8):
        bronze.append(rows(spark, (str(day), "A", f"2024-01-0{day}T00:00:00", 1.0), ("x", "B", AT, float(day))), bronze.BOOKING, base)
    names = storage.children(spark, f"{root}/_log")
    assert [n for n in names if n.endswith(".state")] == ["000000000003.state", "000000000006.state"]
    read = []
    text = storage.read_text
    monkeypatch.setattr(storage, "read_text", lambda s, path: read.append(path) or text(s, path))
    state = commits.state(spark, root)
    assert len(read) == 3  # one state and two commits after it
    whole = commits.State()
    for name in names:
        if name.endswith(".commit"):
            import json

            whole.apply(json.loads(text(spark, f"{root}/_log/{name}")))
    assert state == whole
    assert found(spark, base)[-1] == ("x", AT, 7.0) and len(found(spark, base)) == 8


def test_appending_beside_a_directory_per_facility(spark, tmp_path):
    base, root = str(tmp_path), bronze.AVAILABILITY.root(str(tmp_path))
    old = spark.createDataFrame([("0123", "2024-02-01", True, 2, AT, "2024-01-15")], "facility_id string, date string, is_available boolean, min_nights bigint, scraped_at string, scrape_date string")
    old.write.partitionBy("facility_id", "scrape_date").parquet(root)
    new = spark.createDataFrame([("0123", "2024-02-02", False, LATER), ("9", "2024-02-02", True, LATER)], "facility_id string, date string, is_available boolean, scraped_at string")
    for _ in range(2):
        bronze.append(new, bronze.AVAILABILITY, base)
    want = [("0123", AT, "2024-02-01"), ("0123", LATER, "2024-02-02"), ("9", LATER, "2024-02-02")]
    assert found(spark, base, bronze.AVAILABILITY, "date") == want
    assert sorted(str(r.scrape_date) for r in bronze.read(spark, bronze.AVAILABILITY, base).collect()) == ["2024-01-15", "2024-01-16", "2024-01-16"]
    raw = bronze.read(spark, bronze.AVAILABILITY, base, extras=True)
    assert raw.columns[-2:] == ["run", "scrape_date"]


def test_appending_beside_earlier_nestings(spark, tmp_path):
    """Files by area and date, and by area, date and run, below one root; a run of the latter is replaced."""
    base, root = str(tmp_path), bronze.BOOKING.root(str(tmp_path))
    landed = bronze.landed_columns(rows(spark, ("1", "A", AT, 1.0)), bronze.BOOKING).drop(*bronze.DIGEST)
    landed.drop("run").write.partitionBy("search_area", "scrape_date").parquet(root)
    landed.withColumn("facility_id", F.lit("2")).write.mode("append").partitionBy("search_area", "scrape_date", "run").parquet(root)
    assert found(spark, base) == [("1", AT, 1.0), ("2", AT, 1.0)]
    bronze.append(rows(spark, ("2", "A", AT, 5.0), ("3", "B", LATER, 6.0)), bronze.BOOKING, base)
    assert found(spark, base) == [("1", AT, 1.0), ("2", AT, 5.0), ("3", LATER, 6.0)]
    bronze.append(rows(spark, ("4", "A", LATER, 7.0)), bronze.BOOKING, base)
    assert len(found(spark, base)) == 4


def test_compaction_changes_files_and_not_rows(spark, tmp_path):
    base = str(tmp_path)
    for epoch in range(6):
        bronze.append_epoch(rows(spark, (str(epoch), "A", AT, 1.0), (str(epoch), "B", LATER, 1.0)).coalesce(1), bronze.BOOKING, base, "s", epoch)
    bronze.append(rows(spark, ("z", "C", AT, 1.0)), bronze.BOOKING, base)
    reader = bronze.read(spark, bronze.BOOKING, base)
    before, files = found(spark, base), len(reader.inputFiles())
    assert len(bronze.compact(spark, bronze.BOOKING, base, files=3)) == 2
    assert found(spark, base) == before
    assert files == 13 and len(bronze.read(spark, bronze.BOOKING, base).inputFiles()) < 6
    assert reader.count() == len(before)  # planned on the version before
    assert bronze.compact(spark, bronze.BOOKING, base, files=3) == []
    commits.vacuum(spark, bronze.BOOKING.root(base))
    assert found(spark, base) == before


def deliver(spark, frame, raw, base, files, by=None):
    frame = frame.repartition(files, by) if by else frame.repartition(files)
    frame.write.mode("append").parquet(raw)
    stream = landing.raw_stream(spark, raw, frame.schema, files_per_batch=2)
    landing.start_landing(stream, bronze.BOOKING, base, f"{base}/checkpoint").awaitTermination()


def test_a_scrape_delivered_again_lands_once(spark, tmp_path):
    base, raw = str(tmp_path / "lake"), str(tmp_path / "raw")
    first = rows(spark, *[(str(i % 40), "A", AT, float(i % 40)) for i in range(50)])  # ten rows twice
    deliver(spark, first, raw, base, 3)
    want = found(spark, base)
    assert len(want) == 50
    deliver(spark, first, raw, base, 5, "facility_id")  # other files, other batches
    deliver(spark, first, raw, base, 1)
    assert found(spark, base) == want
    more = first.union(rows(spark, ("new", "A", LATER, 1.0)))
    deliver(spark, more, raw, base, 1)  # a file with an older and a new run
    assert found(spark, base) == sorted([*want, ("new", LATER, 1.0)])


def test_equal_files_of_one_batch_land_once(spark, tmp_path):
    base, raw = str(tmp_path / "lake"), str(tmp_path / "raw")
    first = rows(spark, *[(str(i), "A", AT, float(i)) for i in range(9)]).coalesce(1)
    first.write.parquet(raw)
    deliver(spark, first, raw, base, 1)
    assert len(found(spark, base)) == 9


def test_a_replayed_epoch_adds_nothing(spark, tmp_path):
    base = str(tmp_path)
    batch = rows(spark, ("1", "A", AT, 1.0), ("1", "A", AT, 1.0))
    assert bronze.append_epoch(batch, bronze.BOOKING, base, "s", 4)
    assert not bronze.append_epoch(batch, bronze.BOOKING, base, "s", 4)
    assert not bronze.append_epoch(batch, bronze.BOOKING, base, "s", 3)
    assert not bronze.append_epoch(batch, bronze.BOOKING, base, "other", 0)  # the same rows from elsewhere
    assert len(found(spark, base)) == 2


def pages(spark, *entries):
    return spark.createDataFrame([(None, None, area, "2024-02-01", "2024-02-03", 2, at, n, "<p>") for n, (area, at) in enumerate(entries)], schemas.RAW_PAGES)


def test_rejects_only_neither_fail_nor_repeat(spark, tmp_path):
    base = str(tmp_path)
    bad = pages(spark, ("", AT), ("A", "today"), ("A", "today"))
    for _ in range(2):
        assert refresh.land(bad, refresh.BOOKING_PAGES, base) == refresh.Account(3, 0, 3, 0)
        assert refresh.land_booking_pages(bad, base).count() == 0
    kept = refresh.rejects(spark, bronze.BOOKING, base)
    assert sorted((r.reason, r.page) for r in kept.collect()) == [("no search area", 0), ("unreadable timestamp", 1), ("unreadable timestamp", 2)]
    assert refresh.rejects(spark, bronze.AIRBNB, base).count() == 0


def test_calendars_that_cannot_be_read_are_kept(spark, tmp_path):
    base = str(tmp_path)
    good = '{"calendar_months":[{"days":[{"date":"2024-02-01","min_nights":3.7},{"date":"2024-02-02","min_nights":4}]}]}'
    texts = [good, "{", '{"calendar_months":null}', "", None, "[1]", '{"calendar_months":[]}', "[" * 5000]
    raw = spark.createDataFrame([(str(n), AT, text) for n, text in enumerate(texts)] + [(None, AT, good)], "facility_id string, scraped_at string, json string")
    account = refresh.land(raw, refresh.CALENDARS, base)
    assert account == refresh.Account(9, 2, 7, 2)
    kept = refresh.rejects(spark, bronze.AVAILABILITY, base).collect()
    assert sorted(r.facility_id or "" for r in kept) == ["", "1", "2", "3", "4", "5", "7"]
    assert sorted((r.date, r.min_nights) for r in bronze.read(spark, bronze.AVAILABILITY, base).collect()) == [("2024-02-01", None), ("2024-02-02", 4)]
