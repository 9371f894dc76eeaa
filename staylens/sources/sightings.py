"""First sightings of every listing, kept beside a search dataset: an alert run does not read the history.

The dataset is seen as pieces: what one commit holds of one partition, or the files that an
older layout has in one directory. A delta holds the sightings of some pieces of an area,
and the log notes which (:mod:`staylens.sources.commits`). Sightings are minima and maxima,
so deltas may be merged, and may overlap, without a change of the answer.

:func:`maintain` brings the deltas up to date with what is landed. It reads pieces that no
delta covers, which is the newest run in the daily course. Where a run was landed again or
rewritten, the deltas that cover its earlier pieces are dropped, for that area alone, and the
pieces of theirs that are still live are read again. When ``FAN`` deltas of an area have one
size class (the logarithm of their pieces), they become one: a listing is written once for
each class, and the deltas of an area grow with the logarithm of its runs.
"""

from __future__ import annotations

import datetime
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.operators.recovery import KEYS, first_sightings, merged
from staylens.session import configure
from staylens.sources import bronze, commits, storage

FAN = 4
STORED = T.StructType(
    [
        T.StructField("facility_id", T.StringType()),
        *[T.StructField(name, T.TimestampType()) for name in ("first_unavailable_at", "first_available_at", "last_seen_at")],
        T.StructField("search_area", T.StringType()),
    ]
)
#: A run whose label holds no offset from UTC, so that its day is the partition date.
PLAIN_RUN = re.compile(r"\d{4}-\d\d-\d\dT\d\d-\d\d-\d\d(\.\d+)?")
#: Spark's directory name of a missing partition value; rows without an area have no sightings.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def root_of(dataset: bronze.BronzeDataset, base: str) -> str:
    return f"{base.rstrip('/')}/sightings/{dataset.folder}"


def _value(piece: str, name: str) -> str | None:
    """The value of a partition column in the directories of a piece."""
    for level in piece.split("/"):
        if level.startswith(f"{name}="):
            return unquote(level.split("=", 1)[1])
    return None


def pieces(spark: SparkSession, dataset: bronze.BronzeDataset, base: str) -> dict[str | None, list[str]]:
    """The live pieces of every area; under None those of layouts whose directories do not name the area.

    A piece of an older layout is named by its files, because nothing records a change of them.
    """
    root = dataset.root(base)
    state = commits.state(spark, root)
    older = [p for p, held in state.held.items() if commits.LEGACY in held]
    for pattern in state.patterns:
        older += storage.directories(spark, f"{root}/{pattern.removesuffix('/*.parquet')}", root)
    named = [f"{p}/commit={c}" for p, held in state.held.items() for c in held if c != commits.LEGACY]
    named += [f"{p}/older={storage.fingerprint(spark, f'{root}/{p}')}" for p in older]
    found: dict[str | None, list[str]] = {}
    for piece in sorted(named):
        found.setdefault(_value(piece, "search_area"), []).append(piece)
    found.pop(NO_VALUE, None)
    return found


def read_pieces(spark: SparkSession, dataset: bronze.BronzeDataset, base: str, chosen: list[str]) -> DataFrame:
    """The rows of some pieces; no other file is opened."""
    root = dataset.root(base)
    nested: dict[tuple[str, ...], list[str]] = {}
    for piece in chosen:
        directory, last = piece.rsplit("/", 1)
        path = f"{root}/{directory}/*.parquet" if last.startswith("older=") else f"{root}/{piece}"
        nested.setdefault(tuple(level.split("=")[0] for level in piece.split("/")), []).append(path)
    schema = bronze._file_schema(dataset, T.StringType())
    frames = [spark.read.schema(schema).option("basePath", root).parquet(*paths) for paths in nested.values()]
    frames = frames or [spark.createDataFrame([], schema)]
    return reduce(DataFrame.unionByName, [frame.select(*dataset.schema.names) for frame in frames])


def _write(facts: DataFrame, root: str) -> str:
    """Sightings to the directory of a new commit, by area, sorted by listing."""
    commit, directory = commits.new_directory(root)
    ordered = facts.hint("rebalance", "search_area").sortWithinPartitions("search_area", "facility_id")
    ordered.write.partitionBy("search_area").parquet(directory)
    return commit


def _read_deltas(spark: SparkSession, root: str, deltas: dict[str, list[str]]) -> DataFrame:
    paths = [f"{root}/{p}/commit={c}" for p, held in sorted(deltas.items()) for c in held]
    found = spark.read.schema(STORED).option("basePath", root).parquet(*paths) if paths else spark.createDataFrame([], STORED)
    return found.select(*STORED.names)


def _usable(state: commits.State, live: dict[str, list[str]]) -> dict[str, dict[str, list[str]]]:
    """Per partition the deltas all of whose pieces are live, with these."""
    found = {}
    for partition, held in state.held.items():
        now, notes = set(live.get(_value(partition, "search_area"), [])), state.notes.get(partition, {})
        found[partition] = {c: notes[c] for c in held if c in notes and now.issuperset(notes[c])}
    return found


def _size_class(covered: list[str]) -> int:
    size, found = len(covered), 0
    while size >= FAN:
        size, found = size // FAN, found + 1
    return found


def _publish(facts: DataFrame, root: str, state: commits.State, covered: dict[str, list[str]], dropped: dict[str, list[str]]) -> None:
    """Write a delta and make it visible in place of ``dropped``; ``covered`` are its pieces of every area."""
    spark, commit = facts.sparkSession, _write(facts, root)
    written = storage.partition_directories(spark, commits.staging(root, commit))
    notes = {p: covered[_value(p, "search_area")] for p in written}
    try:
        commits.publish(spark, root, commit, "add", based_on=state, dropped=dropped, notes=notes)
    except commits.Conflict:
        storage.delete(spark, commits.staging(root, commit))
        raise


def _cover(spark: SparkSession, dataset: bronze.BronzeDataset, base: str, live: dict[str, list[str]]) -> None:
    """A delta for the live pieces that have none; those with pieces that are gone are dropped."""
    root = root_of(dataset, base)
    while True:
        state = commits.state(spark, root)
        usable = _usable(state, live)
        covered = {piece for by in usable.values() for some in by.values() for piece in some}
        missing = {area: [piece for piece in present if piece not in covered] for area, present in live.items()}
        wanted = [piece for some in missing.values() for piece in some]
        if not wanted:
            return
        dropped = {p: [c for c in state.held[p] if c not in by] for p, by in usable.items() if _value(p, "search_area") in live}
        rows = read_pieces(spark, dataset, base, wanted).select(*KEYS, "scraped_at", "is_available")
        try:
            return _publish(first_sightings(rows), root, state, missing, {p: some for p, some in dropped.items() if some})
        except commits.Conflict:  # another job has covered some of them meanwhile
            continue


def _merge(spark: SparkSession, root: str, live: dict[str, list[str]]) -> None:
    """Merge the deltas of every area and size class that has gathered FAN of them, smallest first."""
    size_class = 0
    while True:
        state = commits.state(spark, root)
        usable = _usable(state, live)
        classes = {p: {c: _size_class(some) for c, some in by.items()} for p, by in usable.items()}
        if size_class > max((k for by in classes.values() for k in by.values()), default=-1):
            return
        full = {p: [c for c, k in by.items() if k == size_class] for p, by in classes.items()}
        full = {p: held for p, held in full.items() if len(held) >= FAN}
        covered = {_value(p, "search_area"): sorted({piece for c in held for piece in usable[p][c]}) for p, held in full.items()}
        try:
            if full:
                _publish(merged(_read_deltas(spark, root, full)), root, state, covered, full)
        except commits.Conflict:  # left to the next run
            return
        size_class += 1


def maintain(
    spark: SparkSession, dataset: bronze.BronzeDataset, base: str, area: str | None = None
) -> tuple[DataFrame, dict[str, list[str]]] | None:
    """Sightings of all that is landed, of one area or of all, with the live pieces they stand for.

    None where an older layout does not name the area in its directories: there the
    sightings have to be taken from the rows.
    """
    configure(spark)
    live = pieces(spark, dataset, base)
    if None in live:
        return None
    if area is not None:
        live = {area: live[area]} if area in live else {}
    _cover(spark, dataset, base, live)
    root = root_of(dataset, base)
    _merge(spark, root, live)
    deltas = {p: list(by) for p, by in _usable(commits.state(spark, root), live).items()}
    return merged(_read_deltas(spark, root, deltas)), live


def on_day(live: list[str], day: str) -> list[str]:
    """The pieces that may hold rows of a day in UTC.

    Those of its partition; of the days beside it those whose times may have an offset; and
    those of layouts without dates.
    """
    given = datetime.date.fromisoformat(day)
    beside = {str(given + datetime.timedelta(days=n)) for n in (-1, 1)}
    found = []
    for piece in live:
        date, run = _value(piece, "scrape_date"), _value(piece, "run")
        if date in (day, None) or date in beside and not PLAIN_RUN.fullmatch(run or ""):
            found.append(piece)
    return found
