"""What still has to be collected today."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def discover_listings(bronze: DataFrame, facility_ids: Sequence[str] | None = None) -> DataFrame:
    """Distinct (facility_id, url) of the search results, optionally only given ids."""
    found = bronze.where("facility_id IS NOT NULL AND url IS NOT NULL")
    if facility_ids:
        found = found.where(F.col("facility_id").isin(list(facility_ids)))
    return found.select("facility_id", "url").distinct()


def discover_facility_ids(bronze: DataFrame, facility_ids: Sequence[str] | None = None) -> DataFrame:
    """Distinct facility ids; an explicit list wins and keeps its first-seen order."""
    if facility_ids:
        unique = list(dict.fromkeys(facility_ids))
        return bronze.sparkSession.createDataFrame(
            list(enumerate(unique)), "rank bigint, facility_id string"
        )
    return bronze.where("facility_id IS NOT NULL").select("facility_id").distinct()


def collected_on(landed: DataFrame, scrape_date: str) -> DataFrame:
    """Ids already landed on a day; the day filter prunes partitions."""
    return (
        landed.where(F.col("scrape_date") == F.lit(scrape_date).cast("date"))
        .select("facility_id")
        .distinct()
    )


def pending(
    discovered: DataFrame,
    landed: DataFrame,
    scrape_date: str,
    max_listings: int | None = None,
) -> DataFrame:
    """Discovered rows without a landed record for the day, optionally capped.

    The cap is the caller's budget for one run; it takes the first ids in order
    (an explicit list in its own order), so a re-run continues where it ended.
    """
    left = discovered.join(collected_on(landed, scrape_date), "facility_id", "left_anti")
    if max_listings is None:
        return left
    return left.orderBy("rank" if "rank" in left.columns else "facility_id", *left.columns).limit(max_listings)
