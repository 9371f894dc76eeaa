"""Silver tables: every push adds one complete snapshot."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens import schemas
from staylens.operators.coerce import align_to
from staylens.session import configure
from staylens.sources import commits

BOOKING_FOLDER = "silver/booking/accommodations"
AIRBNB_FOLDER = "silver/airbnb/accommodations"


def push(silver: DataFrame, base: str, folder: str, timestamp: str | None = None) -> str:
    """Add a snapshot and return its directory; a snapshot must not be empty.

    The snapshot shows as a whole once it is written; the emptiness check looks at
    the written files, so the plan runs only once. Re-pushing a timestamp replaces
    that snapshot: readers see the one before until then.
    """
    spark = configure(silver.sparkSession)
    stamp = timestamp or datetime.now(tz=timezone.utc).strftime("%Y-%m-%dT%H-%M-%S")
    root = f"{base.rstrip('/')}/{folder}"
    commit, directory = commits.new_directory(root)
    rows = align_to(silver, schemas.SILVER).withColumn("snapshot", F.lit(stamp.replace(":", "-")))
    rows.write.option("compression", "snappy").partitionBy("snapshot").parquet(directory)
    if not commits.publish(spark, root, commit, "replace"):
        raise ValueError("silver result is empty: nothing written")
    return f"{root}/snapshot={stamp.replace(':', '-')}/commit={commit}"


def snapshots(spark: SparkSession, base: str, folder: str) -> list[str]:
    """Names of the stored snapshots, oldest first."""
    return sorted(commits.state(spark, f"{base.rstrip('/')}/{folder}").held)


def _read(spark: SparkSession, root: str, state: commits.State, names: list[str]) -> DataFrame:
    paths = state.paths(root, names) + state.older(root, names)
    return spark.read.schema(schemas.SILVER).parquet(*paths).select(*schemas.SILVER.names)


def read_latest(spark: SparkSession, base: str, folder: str) -> DataFrame:
    """The newest snapshot."""
    root = f"{base.rstrip('/')}/{folder}"
    state = commits.state(spark, root)
    return _read(spark, root, state, [max(state.held)])


def read_history(spark: SparkSession, base: str, folder: str) -> DataFrame:
    """All snapshots ever pushed, unioned."""
    root = f"{base.rstrip('/')}/{folder}"
    state = commits.state(spark, root)
    return _read(spark, root, state, sorted(state.held))


def read_centres(spark: SparkSession, path: str) -> DataFrame:
    """The stored city-centre dimension, one row per city and country."""
    centres = spark.read.schema(schemas.CITY_CENTRES).parquet(path)
    return centres.groupBy("city", "country").agg(
        F.max(F.struct("centre_lat", "centre_lon")).alias("c")
    ).select("city", "country", "c.centre_lat", "c.centre_lon")
