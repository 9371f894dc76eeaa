"""Sightings kept beside a dataset: the same alerts as from the history, with few files opened."""

import pytest
from pyspark.sql import functions as F

from staylens.operators import recovery
from staylens.plans import refresh
from staylens.sources import bronze, commits, sightings, storage

AREA = "Rome__Italy"


def day(n):
    return f"2024-01-{n:02d}T08:00:00"


def run(spark, at, free, area="Rome, Italy"):
    """One scrape: which listings can be booked."""
    rows = [(str(i), f"Stay {i}", area, at, "2024-02-01", "2024-02-03", 80.0 + i, "EUR", bool(f)) for i, f in enumerate(free)]
    names = "facility_id string, name string, search_area string, scraped_at string, checkin_date string, checkout_date string, "
    return spark.createDataFrame(rows, names + "total_price double, currency string, is_available boolean")


def told(frame):
    return sorted(tuple(r) for r in frame.collect())


def from_history(spark, base):
    return told(recovery.availability_recovery_all_areas(bronze.read(spark, bronze.BOOKING, base)))


def opened(frame, root):
    """Partition directories below ``root`` whose files a frame reads."""
    return sorted({f.split(f"{root}/")[1].split("/commit=")[0] for f in frame.inputFiles() if f"{root}/" in f})


def test_an_alert_run_reads_the_newest_day_only(spark, tmp_path):
    base = str(tmp_path)
    for n in range(1, 5):
        bronze.append(run(spark, day(n), [n == 4, n > 2, False]), bronze.BOOKING, base)
        alerts = refresh.newest_alerts(spark, bronze.BOOKING, base)
        assert told(alerts) == from_history(spark, base)
    assert [row[0] for row in told(alerts)] == ["0"]
    assert opened(alerts, bronze.BOOKING.root(base)) == [f"search_area={AREA}/scrape_date=2024-01-04/run=2024-01-04T08-00-00"]


def test_maintenance_reads_new_runs_only_and_merges(spark, tmp_path, monkeypatch):
    base, read = str(tmp_path), []
    plain = sightings.read_pieces
    monkeypatch.setattr(sightings, "read_pieces", lambda s, d, b, chosen: read.append(len(chosen)) or plain(s, d, b, chosen))
    for n in range(1, 7):
        bronze.append(run(spark, day(n), [n % 2]), bronze.BOOKING, base)
        sightings.maintain(spark, bronze.BOOKING, base)
    sightings.maintain(spark, bronze.BOOKING, base)
    assert read == [1] * 6
    state = commits.state(spark, sightings.root_of(bronze.BOOKING, base))
    sizes = sorted(len(note) for note in state.notes[f"search_area={AREA}"].values())
    assert sizes == [1, 1, 4]


@pytest.mark.parametrize("again", [[False, False], [True, False], [True, True]])
def test_a_run_landed_again(spark, tmp_path, again):
    base = str(tmp_path)
    for n, free in ((1, [True, False]), (2, [False, False]), (3, [False, True]), (4, [True, True])):
        bronze.append(run(spark, day(n), free), bronze.BOOKING, base)
        bronze.append(run(spark, day(n), [True], "Paris, France"), bronze.BOOKING, base)
        sightings.maintain(spark, bronze.BOOKING, base)
    before = commits.state(spark, sightings.root_of(bronze.BOOKING, base)).held["search_area=Paris__France"]
    for n in (1, 3):
        bronze.append(run(spark, day(n), again), bronze.BOOKING, base)
        assert told(refresh.newest_alerts(spark, bronze.BOOKING, base)) == from_history(spark, base)
    for n in (3, 4):
        history = recovery.availability_recovery(bronze.read(spark, bronze.BOOKING, base), "Rome, Italy", day(n))
        assert told(refresh.alerts_at(spark, bronze.BOOKING, base, "Rome, Italy", day(n))) == told(history)
    assert commits.state(spark, sightings.root_of(bronze.BOOKING, base)).held["search_area=Paris__France"] == before


def test_compaction_and_vacuum_keep_the_answer(spark, tmp_path):
    base = str(tmp_path)
    for n, free in ((1, [False, True]), (2, [True, True])):
        for part in range(3):
            rows = run(spark, day(n), free).withColumn("facility_id", F.concat("facility_id", F.lit(f"-{part}")))
            bronze.append_epoch(rows, bronze.BOOKING, base, f"s{n}", part)
    before = told(refresh.newest_alerts(spark, bronze.BOOKING, base))
    assert len(before) == 3
    assert bronze.compact(spark, bronze.BOOKING, base, files=1)
    commits.vacuum(spark, bronze.BOOKING.root(base))
    assert told(refresh.newest_alerts(spark, bronze.BOOKING, base)) == before == from_history(spark, base)


def test_older_layouts(spark, tmp_path):
    base = str(tmp_path)
    old = bronze.landed_columns(run(spark, day(1), [False, False]), bronze.BOOKING).drop("run", *bronze.DIGEST)
    old.write.partitionBy("search_area", "scrape_date").parquet(bronze.BOOKING.root(base))
    bronze.append(run(spark, day(2), [True, False]), bronze.BOOKING, base)
    assert [r[0] for r in told(refresh.newest_alerts(spark, bronze.BOOKING, base))] == ["0"]
    later = bronze.landed_columns(run(spark, day(1), [True, False]), bronze.BOOKING).drop("run", *bronze.DIGEST)
    later.write.mode("append").partitionBy("search_area", "scrape_date").parquet(bronze.BOOKING.root(base))
    assert told(refresh.newest_alerts(spark, bronze.BOOKING, base)) == from_history(spark, base) == []


def test_layouts_without_areas_are_read_whole(spark, tmp_path):
    base = str(tmp_path)
    old = bronze.landed_columns(run(spark, day(1), [False]), bronze.BOOKING).drop("run", *bronze.DIGEST)
    old.write.partitionBy("scrape_date").parquet(bronze.BOOKING.root(base))
    bronze.append(run(spark, day(2), [True]), bronze.BOOKING, base)
    assert sightings.maintain(spark, bronze.BOOKING, base) is None
    assert [r[0] for r in told(refresh.newest_alerts(spark, bronze.BOOKING, base))] == ["0"]
    assert [r[0] for r in told(refresh.alerts_at(spark, bronze.BOOKING, base, "Rome, Italy", day(2)))] == ["0"]


def test_offsets_nulls_and_nothing_landed(spark, tmp_path):
    base = str(tmp_path)
    assert told(refresh.newest_alerts(spark, bronze.BOOKING, base)) == []
    assert told(refresh.alerts_at(spark, bronze.BOOKING, base, "Rome, Italy", day(2))) == []
    bronze.append(run(spark, day(1), [False, False, None]), bronze.BOOKING, base)
    late = run(spark, "2024-01-02T23:30:00-05:00", [True, False])  # the newest, though of an earlier date
    bronze.append(late.unionByName(run(spark, "2024-01-03T01:00:00", [False, True])), bronze.BOOKING, base)
    bronze.append(run(spark, day(1), [False]).withColumn("facility_id", F.lit(None).cast("string")), bronze.AIRBNB, base)
    assert [r[0] for r in told(refresh.newest_alerts(spark, bronze.BOOKING, base))] == ["0"]
    assert told(refresh.newest_alerts(spark, bronze.BOOKING, base)) == from_history(spark, base)
    assert told(refresh.newest_alerts(spark, bronze.AIRBNB, base)) == []


class Killed(Exception):
    pass


def test_a_lost_job_leaves_the_answer(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    bronze.append(run(spark, day(1), [False]), bronze.BOOKING, base)
    sightings.maintain(spark, bronze.BOOKING, base)
    bronze.append(run(spark, day(2), [True]), bronze.BOOKING, base)

    def killed(*args, **kwargs):
        raise Killed

    for step in ("create_text", "move"):
        with monkeypatch.context() as m:
            m.setattr(storage, step, killed)
            with pytest.raises(Killed):
                sightings.maintain(spark, bronze.BOOKING, base)
    assert [r[0] for r in told(refresh.newest_alerts(spark, bronze.BOOKING, base))] == ["0"]
