"""Streaming alerts: listings seen unavailable first and available now.

A listing needs two facts, the first time it was seen unavailable and the first time
it was seen available, and the rows of that first available scrape. Facts are minima,
so they may be taken of any part of the rows and combined later: every micro-batch
writes a delta with the facts and candidate rows of its own rows only, and reading
combines the deltas. When ``FAN`` deltas of one size class have gathered, they are
merged into one of the next class: a listing is written once for every class, whatever
the state holds, and the number of deltas grows with the logarithm of the batches.

Deltas are published through :mod:`staylens.sources.commits`: a batch that dies leaves
what was there, a replayed one is left out. A late row may raise an alert for a row
that came before it, or withdraw one: the answer follows from the facts, and does not
depend on the order of arrival.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from staylens import schemas
from staylens.operators.coerce import coerce_to
from staylens.operators.recovery import KEYS, alerts, first_sightings, merged, recovered
from staylens.sources import commits

MOMENTS = ("first_unavailable_at", "first_available_at", "last_seen_at")
STATE = T.StructType(
    [T.StructField(name, T.StringType()) for name in KEYS]
    + [T.StructField(name, T.TimestampType()) for name in MOMENTS]
)
FAN = 4
#: What an alert needs of the rows of a first available scrape.
CANDIDATE = T.StructType(
    [
        schemas.BOOKING_BRONZE[name]
        for name in (*KEYS, "scraped_at", "name", "url", "checkin_date", "checkout_date", "total_price", "currency", "rating", "is_available")
    ]
)


def _first_rows(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """The available rows that stand at their listing's first available time."""
    first = facts.select(*KEYS, F.col("first_available_at").alias("_at"))
    at = rows.where("is_available").withColumn("_at", F.col("scraped_at").try_cast("timestamp"))
    return at.join(first, [*KEYS, "_at"], "left_semi").select(*CANDIDATE.names)


def _deltas(state: commits.State, size_class: int | None = None) -> list[str]:
    """The live deltas, of one size class or of all."""
    ending = "" if size_class is None else f"/class={size_class}"
    return sorted({c for p, held in state.held.items() if p.endswith(ending) for c in held})


def _read(spark: SparkSession, root: str, state: commits.State, deltas: list[str]) -> tuple[DataFrame, DataFrame]:
    """Facts and candidate rows of some deltas."""

    def table(kind: str, schema: T.StructType) -> DataFrame:
        held = [p for p in state.paths(root, [p for p in state.held if p.startswith(f"kind={kind}/")]) if p.split("commit=")[1] in deltas]
        return spark.read.schema(schema).parquet(*held).select(*schema.names) if held else spark.createDataFrame([], schema)

    return table("facts", STATE), table("candidates", CANDIDATE)


def _write(facts: DataFrame, rows: DataFrame, root: str, size_class: int) -> str:
    """A new delta, not yet published: facts, and of ``rows`` those at a first available time."""
    spark = facts.sparkSession
    commit, directory = commits.new_directory(root)
    place = f"{directory}/kind=facts/class={size_class}"
    facts.write.parquet(place)
    known = spark.read.schema(STATE).parquet(place)
    _first_rows(rows, known).write.parquet(f"{directory}/kind=candidates/class={size_class}")
    return commit


def _merge_full_classes(spark: SparkSession, root: str) -> None:
    """Merge the deltas of each size class that has gathered FAN of them, smallest first."""
    size_class = 0
    while True:
        state = commits.state(spark, root)
        deltas = _deltas(state, size_class)
        if not deltas:
            return
        if len(deltas) >= FAN:
            facts, rows = _read(spark, root, state, deltas)
            commit = _write(merged(facts), rows, root, size_class + 1)
            commits.publish(spark, root, commit, "add", retired=deltas)
        size_class += 1


def start_recovery(rows: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Process everything that has arrived; alerts are read from ``folder``."""
    root = f"{folder.rstrip('/')}/recovery"

    def step(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
        if commits.state(spark, root).epochs.get(stream, -1) < epoch:
            commit = _write(first_sightings(batch), coerce_to(batch, CANDIDATE), root, 0)
            commits.publish(spark, root, commit, "add", {stream: epoch})
        _merge_full_classes(spark, root)

    return (
        rows.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """The answer to all batches that have ended; empty before the first one."""
    root = f"{folder.rstrip('/')}/recovery"
    state = commits.state(spark, root)
    facts, rows = _read(spark, root, state, _deltas(state))
    facts = merged(facts)
    return alerts(_first_rows(rows, facts), recovered(facts))
