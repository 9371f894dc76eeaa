"""All datasets of a lake as SQL relations."""

from __future__ import annotations

import re
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from staylens.session import configure
from staylens.sources import bronze, silver_store

SILVER = {
    "silver.airbnb.accommodations": silver_store.AIRBNB_FOLDER,
    "silver.booking.accommodations": silver_store.BOOKING_FOLDER,
}
HISTORY_PREFIX = "silver_history"

# What may not be touched: texts (raw ones too), quoted names, comments. Block comments
# nest, so they are matched by their borders and counted in spark_sql_text.
_SQL_PARTS = re.compile(
    r"""(?P<skip>\b[rR]'[^']*'|\b[rR]"[^"]*"|'(?:\\.|''|[^'\\])*'|"(?:\\.|""|[^"\\])*"|`(?:``|[^`])*`|--[^\n]*)
    |(?P<open>/\*)|(?P<close>\*/)
    |(?P<name>\b(?:bronze|silver|silver_history)\.(?:airbnb|booking)
        \.(?:accommodations|availability|facility)\b)
    |(?P<diff>\bdate_?diff\s*\(\s*)'(?P<unit>\w+)'
    |(?P<round>\bround\s*\()""",
    re.I | re.X | re.S,
)
_COMMENT_BORDER = re.compile(r"/\*|\*/")
_ROUND = """
CREATE OR REPLACE TEMPORARY FUNCTION round_scaled(x DOUBLE, places INT DEFAULT 0) RETURNS DOUBLE
RETURN round(x * power(10D, places)) / power(10D, places)
"""


def spark_sql_text(sql: str) -> str:
    """Adapt dataset names, ``date_diff('day', ...)`` and ``round`` to Spark's SQL.

    A dotted dataset name becomes one quoted identifier, a quoted day unit loses its
    quotes, and ``round()`` works on the scaled binary value, as everywhere else in the
    lake. Texts, quoted names and comments stay as they are.
    """
    out, at = [], 0
    while part := _SQL_PARTS.search(sql, at):
        out.append(sql[at : part.start()])
        at = part.end()
        if part["open"]:
            depth = 1
            while depth and (border := _COMMENT_BORDER.search(sql, at)):
                depth += 1 if border[0] == "/*" else -1
                at = border.end()
            at = len(sql) if depth else at
            out.append(sql[part.start() : at])
        elif part["name"]:
            out.append(f"`{part['name'].lower()}`")
        elif part["unit"]:
            out.append(f"{part['diff']}{part['unit'].upper()}")
        elif part["round"]:
            out.append("round_scaled(")
        else:
            out.append(part[0])
    return "".join([*out, sql[at:]])


class DataLake:
    """Registers the datasets below ``base`` and answers SQL over them.

    Bronze datasets and the newest silver snapshots keep their three-part
    names; ``silver_history.*`` holds all snapshots, and every bronze dataset
    also has its short view name. A dataset without files is skipped and only
    fails when a query names it. The names belong to the session: the lake
    registered last owns them, so lakes used side by side get a session each
    (``spark.newSession()``).

    Ad-hoc SQL gives NULL for a division by zero or an unreadable cast. It runs in a
    copy of the session, whose own settings never change, whatever other threads do.
    """

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark = configure(spark)
        self.base = base
        self.registered: list[str] = []
        self.spark.sql(_ROUND)
        self.refresh()

    def refresh(self) -> None:
        """Register what exists now; call again after new data has landed."""
        self.registered = []
        for dataset in bronze.DATASETS:
            stored = bronze.exists(self.spark, dataset, self.base)
            for name in (dataset.name, dataset.view):
                self._offer(
                    name, stored, lambda d=dataset: bronze.read(self.spark, d, self.base)
                )
        for name, folder in SILVER.items():
            stored = bool(silver_store.snapshots(self.spark, self.base, folder))
            self._offer(
                name, stored, lambda f=folder: silver_store.read_latest(self.spark, self.base, f)
            )
            self._offer(
                name.replace("silver", HISTORY_PREFIX, 1),
                stored,
                lambda f=folder: silver_store.read_history(self.spark, self.base, f),
            )

    def _offer(self, name: str, available: bool, frame) -> None:
        if available:
            frame().createOrReplaceTempView(f"`{name}`")
            self.registered.append(name)
        else:
            self.spark.catalog.dropTempView(name)

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"`{name}`")

    def query(self, sql: str, args: dict[str, Any] | list[Any] | None = None) -> DataFrame:
        """Run SQL, with ``:name`` or ``?`` parameters, as a lazy DataFrame."""
        lenient = SparkSession(self.spark.sparkContext, self.spark._jsparkSession.cloneSession())
        lenient.conf.set("spark.sql.ansi.enabled", "false")
        return lenient.sql(spark_sql_text(sql), args=args)
