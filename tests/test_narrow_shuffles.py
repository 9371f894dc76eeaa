"""What the silver tables move between tasks: each input once, and no number that can be made afterwards."""

import re

from pyspark.sql import functions as F

from staylens.catalogue import silver_queries, tables
from staylens.operators.lookup import skew_join

DATA = "/root/testdata/sf0.001"


def without_broadcast(spark, work):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return work()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_both_sources_share_the_shuffles_of_their_line_items(spark):
    plan = without_broadcast(spark, lambda: silver_queries.silver_union(spark, DATA)._jdf.queryExecution().executedPlan().toString())
    joins = [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\(l_(orderkey|partkey)#", line)]
    columns = {frozenset(re.findall(r"\b([lo]_\w+|_amounts|is_available)#", line)) for line in plan.splitlines() if "Project [l_orderkey#" in line}
    assert joins and len(columns) == 1, columns


def test_line_item_columns_keep_their_values(spark):
    items = tables._items(spark, DATA).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "is_available")
    given = tables.table(spark, DATA, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", (F.col("l_linestatus") == "F").alias("is_available"))
    assert items.count() == given.count() and items.exceptAll(given).isEmpty()


def test_price_metrics_do_not_travel_to_the_lookup(spark):
    plan = without_broadcast(spark, lambda: silver_queries.airbnb_silver(spark, DATA)._jdf.queryExecution().optimizedPlan().toString())
    depth = lambda word: min(len(line) - len(line.lstrip(" :+-")) for line in plan.splitlines() if word in line)
    assert depth("AS price_per_night") < min(len(line) - len(line.lstrip(" :+-")) for line in plan.splitlines() if "Join LeftOuter" in line)


def test_routes_of_a_lookup_are_few(spark):
    rows = spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    lookup = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    joined = skew_join(rows, lookup, ["k"])
    assert joined.where("w = 2 * k").count() == 1000
    assert "pmod(xxhash64" in joined._jdf.queryExecution().optimizedPlan().toString()
