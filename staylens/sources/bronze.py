"""Bronze datasets: append-only Parquet under a commit log (:mod:`staylens.sources.commits`).

Partitions. Search results: ``search_area=/scrape_date=/run=``; detail pages and
calendars: ``scrape_date=/run=`` with files clustered by facility, because one
directory per facility would not survive millions of them. ``run`` is the scrape
timestamp: landing the same run again replaces it (a facility of it, where the dataset
is not laid out by area), a new run is added. Streams add to runs; a scrape that is
delivered again, in whatever files, is not landed again.

Every job writes its rows once, to a directory that becomes visible as a whole; a job
that dies leaves what was there. Lakes laid out otherwise below the same root stay
readable beside what is landed since.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens import schemas
from staylens.functions import text
from staylens.operators.coerce import coerce_to
from staylens.session import configure
from staylens.sources import commits, storage

DIGEST = ("_row_a", "_row_b")


@dataclass(frozen=True)
class BronzeDataset:
    """Where a dataset lives and how it is laid out."""

    name: str
    folder: str
    view: str
    schema: T.StructType
    by_area: bool

    @property
    def partitions(self) -> list[str]:
        return (["search_area"] if self.by_area else []) + ["scrape_date", "run"]

    def root(self, base: str) -> str:
        return f"{base.rstrip('/')}/{self.folder}"


BOOKING = BronzeDataset(
    "bronze.booking.accommodations",
    "bronze/booking/accommodations",
    "booking_accommodation_bronze",
    schemas.BOOKING_BRONZE,
    by_area=True,
)
AIRBNB = BronzeDataset(
    "bronze.airbnb.accommodations",
    "bronze/airbnb/accommodations",
    "airbnb_accommodation_bronze",
    schemas.AIRBNB_BRONZE,
    by_area=True,
)
FACILITY = BronzeDataset(
    "bronze.airbnb.facility",
    "bronze/airbnb/facility",
    "airbnb_facility_bronze",
    schemas.FACILITY_BRONZE,
    by_area=False,
)
AVAILABILITY = BronzeDataset(
    "bronze.airbnb.availability",
    "bronze/airbnb/availability",
    "airbnb_availability_bronze",
    schemas.AVAILABILITY_BRONZE,
    by_area=False,
)
DATASETS = (AIRBNB, AVAILABILITY, FACILITY, BOOKING)


def row_digest(names: list[str], seed: int) -> Column:
    """A hash of all columns of a row; 128 bits together with that of another seed."""
    empty = F.concat(*[F.col(name).isNull().cast("int").cast("string") for name in names])
    return F.xxhash64(F.lit(seed), *names, empty)


def landed_columns(rows: DataFrame, dataset: BronzeDataset, *kept: str) -> DataFrame:
    """Coerced rows plus their partition values and digest, derived row by row; ``kept`` columns stay."""
    typed = coerce_to(rows, dataset.schema, *kept)
    digests = {name: row_digest(dataset.schema.names, seed) for seed, name in enumerate(DIGEST)}
    typed = typed.withColumns(digests)
    if dataset.by_area:
        area = F.col("search_area")
        typed = typed.withColumn("search_area_raw", area).withColumn(
            "search_area", text.sanitise_area(area)
        )
    return typed.withColumns(
        {
            "scrape_date": text.timestamp_to_date_text(F.col("scraped_at")),
            "run": text.sanitise_area(text.timestamp_to_run(F.col("scraped_at"))),
        }
    )


def _write(landed: DataFrame, dataset: BronzeDataset, root: str) -> str:
    """Write rows to the directory of a new commit and return its id.

    The rebalance step lets adaptive execution split a large area over many files
    and merge small ones.
    """
    commit, directory = commits.new_directory(root)
    (
        landed.hint("rebalance", *dataset.partitions)
        .sortWithinPartitions(*dataset.partitions, "facility_id")
        .write.option("compression", "snappy")
        .partitionBy(*dataset.partitions)
        .parquet(directory)
    )
    return commit


def _staged(spark: SparkSession, dataset: BronzeDataset, root: str, commit: str) -> DataFrame:
    return spark.read.schema(_file_schema(dataset, T.StringType())).parquet(commits.staging(root, commit))


def _stored(spark: SparkSession, dataset: BronzeDataset, root: str, state: commits.State, partitions: list[str]) -> DataFrame | None:
    """The rows that some partitions hold, with their digests."""
    schema = _file_schema(dataset, T.StringType())
    paths = state.paths(root, partitions), state.older(root, partitions)
    found = [spark.read.schema(schema).option("basePath", root).parquet(*some).select(*schema.names) for some in paths if some]
    if not found:
        return None
    if paths[1]:  # files of earlier versions hold no digests
        computed = {name: row_digest(dataset.schema.names, seed) for seed, name in enumerate(DIGEST)}
        found[-1] = found[-1].withColumns(computed)
    return reduce(DataFrame.unionByName, found)


def _publish(rows: DataFrame, dataset: BronzeDataset, root: str, mode: str, merge, epochs=None) -> bool:
    """Write rows once and make them visible.

    ``merge`` gets the written rows and what their partitions hold already, and returns
    what to publish instead; None where the rows can stay as they are written.
    """
    spark = rows.sparkSession
    first = _write(rows, dataset, root)
    touched = storage.partition_directories(spark, commits.staging(root, first))
    while touched:
        state = commits.state(spark, root)
        before = _stored(spark, dataset, root, state, touched) if merge else None
        merged = merge(_staged(spark, dataset, root, first), before) if merge else None
        commit = first if merged is None else _write(merged, dataset, root)
        try:
            done = commits.publish(spark, root, commit, mode, epochs, state if merge else None)
        except commits.Conflict:
            continue
        if commit != first:
            storage.delete(spark, commits.staging(root, first))
        return done
    storage.delete(spark, commits.staging(root, first))
    return False


def _with_other_facilities(landed: DataFrame, before: DataFrame | None) -> DataFrame | None:
    """The landed rows, and what the same runs hold of other facilities."""
    if before is None:
        return None
    keys = ["scrape_date", "run", "facility_id"]
    kept = before.join(landed.select(*keys).distinct(), keys, "left_anti")
    return landed.unionByName(kept.select(*landed.columns))


def append(rows: DataFrame, dataset: BronzeDataset, base: str) -> str:
    """Land rows, coerced to the schema; there must be some. Landing a run again replaces it."""
    if not land(rows, dataset, base):
        raise ValueError("nothing to write: no rows")
    return dataset.root(base)


def land(rows: DataFrame, dataset: BronzeDataset, base: str) -> bool:
    """:func:`append`, but False where there are no rows; ``rows`` is evaluated once."""
    configure(rows.sparkSession)
    merge = None if dataset.by_area else _with_other_facilities
    return _publish(landed_columns(rows, dataset), dataset, dataset.root(base), "replace", merge)


def append_epoch(rows: DataFrame, dataset: BronzeDataset, base: str, stream: str, epoch: int) -> bool:
    """Add a micro-batch to its runs; False where nothing in it is new.

    A replayed epoch that was published is left out, and so is every file that is
    delivered again, see :func:`_redelivered`.
    """
    spark = configure(rows.sparkSession)
    root = dataset.root(base)
    if commits.state(spark, root).epochs.get(stream, -1) >= epoch:
        return False
    unit = [*dataset.partitions, "_file"]
    kept: list[DataFrame] = []

    def only_new(landed: DataFrame, before: DataFrame | None) -> DataFrame | None:
        again = _redelivered(landed, before, dataset.partitions).persist()  # asked for twice: is there any, and which
        kept.append(again)
        return None if again.isEmpty() else landed.join(again, unit, "left_anti").select(*landed.columns)

    named = rows.withColumn("_file", F.xxhash64(F.input_file_name()))
    try:
        return _publish(landed_columns(named, dataset, "_file"), dataset, root, "add", only_new, {stream: epoch})
    finally:
        for again in kept:
            again.unpersist()


def _redelivered(landed: DataFrame, before: DataFrame | None, run: list[str]) -> DataFrame:
    """(run, file) of what a batch delivers again.

    A file's part of a run is a repetition where the run holds all its rows already,
    each as often, however the earlier delivery was cut into files and batches; or
    where another file of the batch has the same rows, told by their number and the
    sums of their digests. Only digests are read, of runs that the batch touches.
    """
    parts = landed.groupBy(*run, "_file").agg(F.count("*").alias("n"), *[F.sum(F.col(d).cast("decimal(38,0)")).alias(d) for d in DIGEST])
    first = parts.groupBy(*run, "n", *DIGEST).agg(F.min("_file").alias("first"))
    again = parts.join(first, [*run, "n", *DIGEST]).where("_file <> first").select(*run, "_file")
    if before is None:
        return again
    rows = landed.groupBy(*run, "_file", *DIGEST).agg(F.count("*").alias("n"))
    held = before.groupBy(*run, *DIGEST).agg(F.count("*").alias("held"))
    known = rows.join(held, [*run, *DIGEST], "left").groupBy(*run, "_file").agg(F.min(F.coalesce("held", F.lit(0)) >= F.col("n")).alias("all_held"))
    return again.union(known.where("all_held").select(*run, "_file")).distinct()


def _file_schema(dataset: BronzeDataset, date_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            *dataset.schema.fields,
            *[T.StructField(name, T.LongType()) for name in (*DIGEST, "_file")],
            *([T.StructField("search_area_raw", T.StringType())] if dataset.by_area else []),
            T.StructField("scrape_date", date_type),
            T.StructField("run", T.StringType()),
        ]
    )


def exists(spark: SparkSession, dataset: BronzeDataset, base: str) -> bool:
    """Whether anything has been landed."""
    state = commits.state(spark, dataset.root(base))
    return bool(state.held or state.patterns)


def read(
    spark: SparkSession, dataset: BronzeDataset, base: str, extras: bool = False
) -> DataFrame:
    """The declared columns, then ``scrape_date``; absent ones read as NULL.

    One version of the dataset, whatever is landed meanwhile: files are listed from
    the commit log, and every older layout below the root is read in its own nesting.
    Files of any older schema version are covered by the declared schema without
    looking at their footers. ``extras`` additionally forwards, sorted by name, every
    other column found in any file (this does merge footers).
    """
    configure(spark)
    declared = _file_schema(dataset, T.DateType())
    root = dataset.root(base)
    state = commits.state(spark, root)
    sources = [state.paths(root), state.older(root), *[[f"{root}/{pattern}"] for pattern in state.patterns]]
    sources = [paths for paths in sources if paths]
    if not sources:
        return spark.createDataFrame([], declared).select(*dataset.schema.names, "scrape_date")
    forwarded = ["scrape_date"]
    if extras:
        known = {*declared.names, "commit"}
        additional = {}
        for paths in sources:
            merged = spark.read.option("mergeSchema", True).option("basePath", root).parquet(*paths).schema
            additional |= {field.name: field for field in merged.fields if field.name not in known}
        declared = T.StructType([*declared.fields, *additional.values()])
        internal = {*dataset.schema.names, *DIGEST, "_file"}
        forwarded = sorted(set(declared.names) - internal)
    frames = [spark.read.schema(declared).option("basePath", root).parquet(*paths) for paths in sources]
    return reduce(DataFrame.unionByName, [f.select(*dataset.schema.names, *forwarded) for f in frames])


def compact(spark: SparkSession, dataset: BronzeDataset, base: str, files: int = 8) -> list[str]:
    """Rewrite the partitions that more than ``files`` commits or files hold; returns them.

    The rows do not change. Readers see the files before or those after, and the ones
    before stay until :func:`staylens.sources.commits.vacuum`.
    """
    configure(spark)
    root = dataset.root(base)
    while True:
        state = commits.state(spark, root)
        small = [p for p in state.held if storage.count_files(spark, state.paths(root, [p]) + [f"{root}/{p}"]) > files]
        rows = _stored(spark, dataset, root, state, small) if small else None
        if rows is None:
            return []
        commit = _write(rows, dataset, root)
        try:
            commits.publish(spark, root, commit, "replace", based_on=state)
            return sorted(small)
        except commits.Conflict:
            continue


def register(spark: SparkSession, dataset: BronzeDataset, base: str) -> DataFrame:
    """Read a dataset and register its view."""
    frame = read(spark, dataset, base)
    frame.createOrReplaceTempView(dataset.view)
    return frame
