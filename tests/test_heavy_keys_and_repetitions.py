"""When heavy keys are split, and what a repeated delivery makes Spark compute."""

from staylens.catalogue import tables
from staylens.session import configure
from staylens.sources import bronze

THRESHOLD = "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"


def test_a_heavy_key_is_split_above_one_advisory_partition(spark):
    fresh, own = spark.newSession(), spark.newSession()
    own.conf.set(THRESHOLD, "16k")
    assert configure(fresh).conf.get(THRESHOLD) == "64MB"
    assert configure(own).conf.get(THRESHOLD) == "16k"


def test_repeated_files_are_looked_for_once(spark, tmp_path, monkeypatch):
    rows = tables.weekly_availability(spark, "/root/testdata/sf0.001")
    for cut in ("facility_id", "total_price"):
        rows.repartition(2, cut).write.mode("append").parquet(f"{tmp_path}/raw")
    rows.write.mode("append").parquet(f"{tmp_path}/raw")
    rows.write.mode("append").parquet(f"{tmp_path}/raw")
    plans, write = [], bronze._write

    def noted(landed, *where):
        plans.append(landed._jdf.queryExecution().executedPlan().toString())
        return write(landed, *where)

    monkeypatch.setattr(bronze, "_write", noted)
    bronze.append(rows.where("search_area = 'Area0__Web'"), bronze.BOOKING, str(tmp_path))
    assert bronze.append_epoch(spark.read.parquet(f"{tmp_path}/raw"), bronze.BOOKING, str(tmp_path), "s", 0)
    assert len(plans) == 3 and "InMemoryTableScan" in plans[-1]
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()
