"""Parquet table access and the ``bookings`` view over the driver's tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _line_summary(lineitem: DataFrame) -> DataFrame:
    # Partial (map-side) aggregation first, so a hot order key never
    # reaches the reducer as raw lines.
    return (lineitem.groupBy("l_orderkey")
            .agg(F.count(F.lit(1)).alias("n_lines"),
                 F.sum(F.col("l_linenumber") % 3).alias("n_wk"),
                 F.min("l_shipdate").alias("first_ship"),
                 F.min("l_returnflag").alias("rf_min"),
                 F.max("l_returnflag").alias("rf_max")))


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hotel-booking rows derived from orders, customers, nations and lines.

    Plan: lines are aggregated per order (hash-partitioned on the order
    key) and outer-joined to orders on that same key, so the join reuses
    the aggregate's partitioning.  The nation table is 25 rows: Spark's own
    size estimate turns that join into a broadcast; no hint is forced.
    """
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal",
                                                "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    li = _line_summary(table(spark, sf_dir, "lineitem"))

    joined = (o.join(c, o.o_custkey == c.c_custkey)
              .join(n, c.c_nationkey == n.n_nationkey)
              .join(li, li.l_orderkey == o.o_orderkey, "left"))

    key = F.col("o_orderkey")
    country = (F.when(F.col("n_nationkey") == 0, F.lit("PRT"))
               .when(F.col("n_nationkey") == 1, F.lit(None).cast("string"))
               .otherwise(F.col("n_name")))
    deposit = (F.when(F.col("c_acctbal") < 0, "Non Refund")
               .when(F.col("c_acctbal") < 1000, "Refundable")
               .otherwise("No Deposit"))
    customer_type = (F.when(key % 3 == 0, "Transient")
                     .when(key % 3 == 1, "Group")
                     .otherwise("Contract"))
    return joined.select(
        key.alias("booking_id"),
        F.when(F.col("n_regionkey") < 3, "City Hotel").otherwise("Resort Hotel").alias("hotel"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("is_canceled"),
        F.abs(F.datediff(F.col("first_ship"), F.col("o_orderdate"))).cast("int").alias("lead_time"),
        F.year("o_orderdate").cast("int").alias("arrival_date_year"),
        F.month("o_orderdate").cast("string").alias("arrival_date_month"),
        F.weekofyear("o_orderdate").cast("int").alias("arrival_date_week_number"),
        F.dayofmonth("o_orderdate").cast("int").alias("arrival_date_day_of_month"),
        F.col("n_wk").cast("int").alias("stays_in_weekend_nights"),
        F.col("n_lines").cast("int").alias("stays_in_week_nights"),
        (F.lit(1) + key % 3).cast("int").alias("adults"),
        F.nullif(key % 5, F.lit(4)).cast("double").alias("children"),
        (key % 2).cast("int").alias("babies"),
        F.substring("o_orderpriority", 1, 1).alias("meal"),
        country.alias("country"),
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("market_segment"),
        F.col("o_orderpriority").alias("distribution_channel"),
        (F.col("c_custkey") % 2).cast("int").alias("is_repeated_guest"),
        (key % 4).cast("int").alias("previous_cancellations"),
        F.col("rf_min").alias("reserved_room_type"),
        F.col("rf_max").alias("assigned_room_type"),
        deposit.alias("deposit_type"),
        F.nullif(F.col("o_custkey") % 10, F.lit(0)).cast("string").alias("agent"),
        F.lit(None).cast("string").alias("company"),
        customer_type.alias("customer_type"),
        (F.col("o_totalprice") / 1000).alias("adr"),
        (key % 6).cast("int").alias("total_of_special_requests"),
        F.col("o_orderstatus").alias("reservation_status"),
        F.col("o_orderdate").alias("reservation_status_date"),
    )


def with_signal_label(df: DataFrame, id_col: str = "booking_id",
                      lead_col: str = "lead_time") -> DataFrame:
    """Learnable label for training checks (the raw status has no link to features)."""
    signal = ((F.coalesce(F.col(lead_col), F.lit(0)) > 900) != (F.col(id_col) % 10 == 7))
    return df.withColumn("label_signal", signal.cast("int"))


def deterministic_score(df: DataFrame, id_col: str = "booking_id") -> DataFrame:
    """Model-free score for evaluation checks: (id % 101) / 100, prediction = score >= 0.5."""
    score = ((F.col(id_col) % 101) / F.lit(100.0)).cast("double")
    return (df.withColumn("score", score)
            .withColumn("prediction", (F.col("score") >= 0.5).cast("int")))
