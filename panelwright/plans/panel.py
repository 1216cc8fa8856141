"""The panel (one row per entity and period) built from orders and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.rules import clip, logistic
from panelwright.sources.readers import scan_parquet

FEATURES = ["n_orders", "amt", "avg_amt", "max_amt", "acctbal"]


def order_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity, period) rows: order statistics of a customer in a year, with the customer's attributes.

    Orders are summed per (customer, year) before anything is joined: the map-side part of that
    aggregation removes a hot customer's rows, and after it a customer has at most one row per year.
    """
    orders = scan_parquet(spark, f"{sf_dir}/orders.parquet")
    customer = scan_parquet(spark, f"{sf_dir}/customer.parquet")
    nation = scan_parquet(spark, f"{sf_dir}/nation.parquet")
    yearly = (orders.groupBy(F.col("o_custkey").alias("entity"), F.year("o_orderdate").alias("period"))
              .agg(F.count("*").alias("n_orders"), F.sum("o_totalprice").alias("amt"),
                   F.avg("o_totalprice").alias("avg_amt"), F.max("o_totalprice").alias("max_amt"),
                   F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent")))
    attributes = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("entity"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation"))
    return (yearly.join(attributes, "entity")
            .withColumns({
                "label": (F.col("n_urgent") >= 1).cast("int"),
                "avg_amt": F.when(F.col("entity") % 10 != F.col("period") % 10, F.col("avg_amt")),
            })
            .select("entity", "period", *FEATURES, "segment", "nation", "label"))


def scored_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with a deterministic score full of ties and a 0/1 prediction at 0.5."""
    scored = order_panel(spark, sf_dir).withColumn(
        "score", F.round(logistic((F.col("amt") - 300000.0) / 150000.0), 4))
    return scored.withColumn("pred", (F.col("score") >= 0.5).cast("int"))


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents scored by length; slices are language and source."""
    documents = scan_parquet(spark, f"{sf_dir}/documents.parquet").select("doc_id", "lang", "source", "n_chars")
    labels = scan_parquet(spark, f"{sf_dir}/labels.parquet")
    return (documents.join(labels, "doc_id")
            .select("doc_id", "lang", "source", F.col("quality").alias("label"), "toxic",
                    F.round(clip(F.col("n_chars") / 20000.0, 0.0, 1.0), 3).alias("score"))
            .withColumn("pred", (F.col("score") >= 0.05).cast("int")))
