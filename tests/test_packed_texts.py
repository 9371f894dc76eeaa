"""Texts that travel as one keep their values and their order, whatever they hold."""

from itertools import product

from pyspark.sql import functions as F

from staylens.catalogue import silver_queries
from staylens.functions import text
from staylens.operators.pick import latest_per, with_packed, with_unpacked
from tests.test_narrow_shuffles import DATA, without_broadcast

ODD = [None, "", "\x00", "\x01", "\x02", "\x00\x01", "\x01\x01\x02", "\x01\x03", "\x03", "a", "a\x00", "a\x01", "ab", "é", "￿", "😀"]


def test_packed_texts_come_back(spark):
    rows = list(product(ODD, ODD))
    frame = spark.createDataFrame(rows, "a string, b string")
    groups = {"_ab": ["a", "b"]}
    assert [tuple(r) for r in with_unpacked(with_packed(frame, groups), groups).collect()] == rows


def test_packed_texts_have_the_order_of_their_columns(spark):
    frame = spark.createDataFrame(list(product(ODD, ODD)), "a string, b string").withColumn("p", text.packed("a", "b"))
    ordered = [(r.a, r.b) for r in frame.orderBy(F.struct("a", "b")).collect()]
    assert [(r.a, r.b) for r in frame.orderBy("p").collect()] == ordered


def test_newest_row_of_odd_texts(spark):
    rows = [(k, j, when, a, n, b) for k in (None, "", "x\x00") for j in ("", "y") for when in (None, "1") for a, n, b in (("", 1, None), (None, 9, "z"), ("\x00", 2, "z"))]
    frame = spark.createDataFrame(rows, "k string, j string, at string, a string, n int, b string")
    plain = frame.groupBy("k", "j").agg(F.max(F.struct("at", "a", "n", "b")).alias("m")).select("k", "j", "m.*")
    got = latest_per(frame, ["k", "j"], ["at"])
    assert got.columns == frame.columns and got.count() == 6
    assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()


def test_a_stay_is_shuffled_with_few_texts(spark):
    """Each source's stays, with the texts of their keys and of their rows packed."""
    plan = without_broadcast(spark, lambda: silver_queries.silver_union(spark, DATA)._jdf.queryExecution().executedPlan().toString())
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert [line for line in moved if "_packed_facility_id_" in line]
    assert not [line for line in moved if "checkin_date#" in line and "facility_id#" not in line]
