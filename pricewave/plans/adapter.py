"""The driver's star-schema tables as price histories, products, watchlists and names."""

from pyspark.sql import DataFrame, SparkSession, functions as F

AS_OF = "2001-06-30"
WEEK = "2001-06-27"  # the Wednesday on or before AS_OF


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def price_points(spark, sf_dir, pooled: bool = False, as_of: str | None = AS_OF) -> DataFrame:
    """(retailer, item, on_date, cents): unit prices of line items up to a day, the last order of a day counting.

    Without as_of all line items count. The date filter reaches the scan, and
    the last order is a maximum over a struct, so rows are combined before the
    shuffle.
    """
    li = table(spark, sf_dir, "lineitem")
    if as_of:
        li = li.where(F.col("l_shipdate") < F.date_add(F.lit(as_of).cast("date"), 1).cast("timestamp"))
    retailer = F.lit("X") if pooled else F.when(F.col("l_linestatus") == "F", "A").otherwise("B")
    last = F.max(F.struct("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")).alias("m")
    days = li.groupBy(retailer.alias("retailer"), F.col("l_partkey").alias("item"), F.to_date("l_shipdate").alias("on_date")).agg(last)
    return days.select("retailer", "item", "on_date", F.rint(F.col("m.l_extendedprice") / F.col("m.l_quantity") * 100).cast("bigint").alias("cents"))


def catalogue(spark, sf_dir) -> DataFrame:
    """(pid, name, cents, sku, category) with names that state a size."""
    p = table(spark, sf_dir, "part")
    name = F.concat_ws(" ", F.regexp_replace("p_brand", "#", ""), "p_name", "p_type", F.concat(F.col("p_size").cast("string"), F.lit("g")))
    return p.select(F.col("p_partkey").alias("pid"), name.alias("name"), F.rint(F.col("p_retailprice") * 100).cast("bigint").alias("cents"), F.col("p_partkey").cast("string").alias("sku"), F.col("p_type").alias("category"))


def watched(spark, sf_dir, kind: str = "view") -> DataFrame:
    """(device_id, product_id): what a user's events of this kind name."""
    e = table(spark, sf_dir, "events").where(F.col("event_type") == kind)
    return e.select(F.col("user_id").alias("device_id"), F.get_json_object("props", "$.k").cast("bigint").alias("product_id"))
