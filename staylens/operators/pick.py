"""Keep one row per key: the newest scrape, the first occurrence.

Both are a single aggregation over a struct that starts with the ordering
columns and carries the rest of the row. Map-side partial aggregation leaves at
most one row per key and input task before the shuffle, so a key holding a
large share of the table costs no more than any other. The whole row takes part
in the comparison, which makes ties deterministic under task retries.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.functions import text


def _one_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    choose: Callable[[Column], Column],
) -> DataFrame:
    leading = [name for name in order if name not in keys]
    trailing = [name for name in df.columns if name not in keys and name not in leading]
    chosen = choose(F.struct(*leading, *trailing)).alias("_chosen")
    picked = df.groupBy(*keys).agg(chosen)
    return picked.select(
        *[F.col(name) if name in keys else F.col(f"_chosen.{name}") for name in df.columns]
    )


def with_packed(df: DataFrame, groups: dict[str, Sequence[str]]) -> DataFrame:
    """Replace each group of text columns by one text, see :func:`staylens.functions.text.packed`."""
    taken = {name for names in groups.values() for name in names}
    return df.select(
        *[name for name in df.columns if name not in taken], *[text.packed(*names).alias(group) for group, names in groups.items()]
    )


def with_unpacked(df: DataFrame, groups: dict[str, Sequence[str]]) -> DataFrame:
    """Undo :func:`with_packed`; the columns come last."""
    parts = df.withColumns({group: text.packed_parts(F.col(group)) for group in groups})
    return parts.select(
        *[name for name in df.columns if name not in groups],
        *[text.unpacked(F.col(group), place).alias(name) for group, names in groups.items() for place, name in enumerate(names)],
    )


def _text_runs(names: Sequence[str], texts: set[str]) -> dict[str, list[str]]:
    """Text columns that stand beside each other."""
    runs = [list(run) for is_text, run in groupby(names, texts.__contains__) if is_text]
    return {f"_packed_{'_'.join(run)}": run for run in runs if len(run) > 1}


def latest_per(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """The row with the greatest ``newest`` columns per key (NULLs are oldest).

    Texts beside each other travel as one text, the keys and the rest apart; it has their order.
    """
    texts = {field.name for field in df.schema.fields if field.dataType == T.StringType()}
    leading = [name for name in newest if name not in keys]
    rest = [*leading, *[name for name in df.columns if name not in keys and name not in leading]]
    runs = [_text_runs(names, texts) for names in (keys, rest)]
    group_of = {run[0]: group for some in runs for group, run in some.items()}
    inside = {name for some in runs for run in some.values() for name in run}

    def slim(names: Sequence[str]) -> list[str]:
        return [group_of.get(name, name) for name in names if name in group_of or name not in inside]

    packed = with_packed(df, runs[0] | runs[1]).select(*slim(keys), *slim(rest))
    picked = _one_per_key(packed, slim(keys), slim(rest), F.max)
    return with_unpacked(picked, runs[0] | runs[1]).select(*df.columns)


def first_per(df: DataFrame, keys: Sequence[str], earliest: Sequence[str]) -> DataFrame:
    """The row with the smallest ``earliest`` columns per key."""
    return _one_per_key(df, keys, earliest, F.min)


def name_if_unknown(facility_id: Column, name: Column) -> Column:
    """Second part of a listing's identity: its name when the id is ``unknown``."""
    return F.when(facility_id == "unknown", name)


def latest_located_facility(facilities: DataFrame) -> DataFrame:
    """Newest record with both coordinates per facility: id, latitude, longitude."""
    located = facilities.where("latitude IS NOT NULL AND longitude IS NOT NULL").select(
        "facility_id", "scraped_at", "latitude", "longitude"
    )
    return latest_per(located, ["facility_id"], ["scraped_at"]).drop("scraped_at")


def first_occurrences(cards: DataFrame, search_keys: Sequence[str]) -> DataFrame:
    """Drop listings repeated on later result pages of the same search."""
    keyed = cards.withColumn("_name_key", name_if_unknown(F.col("facility_id"), F.col("name")))
    keys = ["facility_id", "_name_key", *search_keys]
    return first_per(keyed, keys, ["page", "position"]).drop("_name_key")
