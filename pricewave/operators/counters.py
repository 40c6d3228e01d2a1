"""Counts of what a job does while it does it: rows and counters come from one pass."""

from pyspark.sql import Column, DataFrame, Observation, functions as F

from pricewave.operators.guards import DUMP_FLOOR


def counted(rows: DataFrame, **counters: Column) -> tuple[DataFrame, Observation]:
    """rows as they are, and an observation with a count of each condition once a job has read them (rows: all of them)."""
    seen = Observation()
    counts = [F.count_if(c).alias(name) for name, c in counters.items()]
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def with_product_ids(rows: DataFrame, products: DataFrame) -> tuple[DataFrame, Observation]:
    """rows (retailer, sku, ...) with their product_id, and an observation of rows and misses; rows without a product are left out and counted."""
    joined = rows.join(products.select("retailer", "sku", "product_id"), ["retailer", "sku"], "left")
    watched, seen = counted(joined, misses=F.col("product_id").isNull())
    return watched.where("product_id IS NOT NULL"), seen


def parsed(products: DataFrame) -> tuple[DataFrame, Observation]:
    """Parsed products (is_half, events, marketplace) without marketplace ones, and an observation of rows, half_now, half_ever, marketplace."""
    mine = ~F.coalesce(F.col("marketplace"), F.lit(False))
    watched, seen = counted(
        products, half_now=mine & F.col("is_half"), half_ever=mine & (F.size("events") > 0), marketplace=~mine
    )
    return watched.where(mine), seen


def store_dump(dump: DataFrame, path: str, least: int = DUMP_FLOOR) -> int:
    """Write a dump to path in one job that counts its items; with fewer than least, what was written goes again and the run fails."""
    watched, seen = counted(dump)
    staged = f"{path}.staged"
    watched.write.mode("overwrite").parquet(staged)
    items = seen.get["rows"]
    spark = dump.sparkSession
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (staged, path))
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if items < least:
        files.delete(source, True)
        raise ValueError(f"dump has {items} items, fewer than {least}")
    files.delete(target, True)
    files.rename(source, target)
    return items
