"""Reads a star schema (customer, orders, lineitem, events) as campaign tables.

Orders before the campaign start are purchase history; an order on or after it is
the campaign outcome, so features and outcome never overlap in time.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CAMPAIGN_START = "2001-05-01 00:00:00"
# Orders that are broadcast to look for their lines.
BROADCAST_ORDERS = 100_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _history(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return orders.where(F.expr(f"o_orderdate < timestamp_ntz'{CAMPAIGN_START}'"))


def clients(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(
        "c_custkey AS client_id",
        "CAST(date_add(DATE'1994-01-01', CAST(c_custkey % 360 AS int)) AS timestamp_ntz)"
        " AS first_issue_date",
        "CASE WHEN c_custkey % 5 <> 0 THEN CAST(date_add(DATE'1994-01-01', CAST("
        "c_custkey % 360 + (c_custkey * 37) % 3000"
        " - CASE WHEN c_custkey % 11 = 0 THEN 3000 ELSE 0 END AS int)) AS timestamp_ntz)"
        " END AS first_redeem_date",
        "CAST(10 + c_custkey % 95 AS int) AS age",
        "CASE c_mktsegment WHEN 'BUILDING' THEN 'F' WHEN 'FURNITURE' THEN 'M'"
        " WHEN 'HOUSEHOLD' THEN 'F' WHEN 'MACHINERY' THEN 'U' END AS gender",
    )


def purchases(spark: SparkSession, folder: str) -> DataFrame:
    """One row per product line, header fields repeated on every line."""
    lines = table(spark, folder, "lineitem")
    return lines.join(_history(spark, folder), F.expr("l_orderkey = o_orderkey")).selectExpr(
        "o_custkey AS client_id",
        "o_orderkey AS transaction_id",
        "o_orderdate AS transaction_datetime",
        "o_totalprice * 0.01D AS regular_points_received",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN 10.0D ELSE 0.0D END"
        " AS express_points_received",
        "-CAST(o_orderkey % 3 * 10 AS double) AS regular_points_spent",
        "CASE WHEN o_orderpriority = '2-HIGH' THEN -5.0D ELSE 0.0D END"
        " AS express_points_spent",
        "o_totalprice AS purchase_sum",
        "o_orderkey % 40 AS store_id",
        "l_partkey AS product_id",
        "l_quantity AS product_quantity",
        "l_extendedprice AS trn_sum_from_iss",
        "CASE WHEN l_returnflag = 'R' THEN l_extendedprice * l_discount END"
        " AS trn_sum_from_red",
    )


def last_purchase(spark: SparkSession, folder: str) -> datetime | None:
    """The time of the last purchase line, if one of the newest orders has a line.

    Orders of the last day before the campaign are looked up among the lines, which stay where
    they are. Without a line there, or with too many such orders, None: all lines must be joined.
    """
    orders = _history(spark, folder).select("o_orderkey", "o_orderdate")
    newest = orders.agg(F.max("o_orderdate")).first()[0]
    if newest is None:
        return None
    since = F.lit(str(newest - timedelta(days=1))).cast("timestamp_ntz")
    recent = orders.where(F.col("o_orderdate") >= since)
    if recent.limit(BROADCAST_ORDERS + 1).count() > BROADCAST_ORDERS:
        return None
    lines = table(spark, folder, "lineitem").select("l_orderkey")
    sold = lines.join(F.broadcast(recent), F.expr("l_orderkey = o_orderkey"))
    return sold.agg(F.max("o_orderdate")).first()[0]


def labels(spark: SparkSession, folder: str) -> DataFrame:
    """Campaign arm and outcome of every customer."""
    buyers = (
        table(spark, folder, "orders")
        .where(F.expr(f"o_orderdate >= timestamp_ntz'{CAMPAIGN_START}'"))
        .groupBy(F.col("o_custkey").alias("client_id"))
        .agg(F.lit(1).alias("bought"))
    )
    return (
        table(spark, folder, "customer")
        .select(F.col("c_custkey").alias("client_id"))
        .join(buyers, "client_id", "left")
        .selectExpr(
            "client_id",
            "CAST(client_id % 2 AS tinyint) AS treatment_flg",
            "CAST(coalesce(bought, 0) AS tinyint) AS target",
        )
    )
