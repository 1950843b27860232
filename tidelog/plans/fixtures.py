"""Changelogs derived from the driver's tables, as DataFrames and as DuckDB SQL for the comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.functions.kinds import DELETE, INSERT, KIND, SEQ, UPDATE_AFTER, UPDATE_BEFORE, kind


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key o_orderkey. One scan; each order's events are made in its row."""
    orders = table(spark, sf_dir, "orders")
    key, third, seventh = F.col("o_orderkey"), F.col("o_orderkey") % 3 == 0, F.col("o_orderkey") % 7 == 0

    def event(number: int, price) -> F.Column:
        return F.struct(*((price if c == "o_totalprice" else F.col(c)).alias(c) for c in orders.columns), kind(number).alias(KIND), (key * 4 + number).alias(SEQ))

    price = F.col("o_totalprice")
    events = F.array(event(INSERT, price), F.when(third, event(UPDATE_BEFORE, price)), F.when(third, event(UPDATE_AFTER, price + 1)), F.when(seventh, event(DELETE, F.when(third, price + 1).otherwise(price))))
    return orders.select(F.explode(F.array_compact(events)).alias("e")).select("e.*")


def lineitem_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key (l_orderkey, l_linenumber). The sequence is the place in a total order: numbered within orders, which needs no single task, as order key and place compare the same way."""
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"))
    return table(spark, sf_dir, "lineitem").withColumn(KIND, kind(INSERT)).withColumn(SEQ, F.shiftleft("l_orderkey", 20).bitwiseOR(place.cast("long")))


def events_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key user_id, sequence event_id."""
    value = F.when(F.col("event_type") == "signup", INSERT).when(F.col("event_type") == "error", DELETE).otherwise(UPDATE_AFTER)
    return table(spark, sf_dir, "events").withColumn(KIND, value.cast("tinyint")).withColumn(SEQ, F.col("event_id"))


ORDERS = """orders_cdc AS (
  SELECT *, CAST(0 AS TINYINT) AS _row_kind, o_orderkey * 4 AS _seq FROM orders
  UNION ALL SELECT *, CAST(1 AS TINYINT), o_orderkey * 4 + 1 FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT * REPLACE (o_totalprice + 1 AS o_totalprice), CAST(2 AS TINYINT), o_orderkey * 4 + 2 FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice), CAST(3 AS TINYINT), o_orderkey * 4 + 3 FROM orders WHERE o_orderkey % 7 = 0)"""
LINES = """lineitem_upsert AS (
  SELECT *, CAST(0 AS TINYINT) AS _row_kind, l_orderkey * 1048576 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS _seq FROM lineitem)"""
EVENTS = """events_cdc AS (
  SELECT *, CAST(CASE event_type WHEN 'signup' THEN 0 WHEN 'error' THEN 3 ELSE 2 END AS TINYINT) AS _row_kind, event_id AS _seq FROM events)"""


def live_sql(source: str, keys: str, name: str = "live") -> str:
    return f"{name} AS (SELECT * EXCLUDE (_row_kind, _seq) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY _seq DESC, _row_kind) AS rn_ FROM {source}) WHERE rn_ = 1 AND _row_kind NOT IN (1, 3))"
