"""Past half-price events put into the stored tables, as if each had been seen when it happened."""

from pyspark.sql import DataFrame, functions as F

from pricewave.operators import merge

SPECIAL_KEYS = ["product_id", "week_start"]
OBSERVATION_KEYS = ["product_id", "observed_at", "source"]


def event_rows(parsed: DataFrame, products: DataFrame, current_week: str, source: str) -> DataFrame:
    """(product_id, pos, on_date, sale_cents, regular_cents, discount_pct, source): events before the current week, whose promotion the weekly run owns.

    parsed: retailer, item, events in the order of their history. Items without a stored product give none.
    """
    known = parsed.join(products.select("retailer", F.col("sku").alias("item"), "product_id"), ["retailer", "item"])
    each = known.select("product_id", F.posexplode("events").alias("pos", "e")).select("product_id", "pos", "e.*")
    return each.where(F.col("on_date") < F.lit(current_week).cast("date")).withColumn("source", F.lit(source))


def backfill(
    parsed: DataFrame, products: DataFrame, specials: DataFrame, observations: DataFrame, current_week: str, source: str = "dump"
) -> dict[str, DataFrame]:
    """products, specials, observations with the past of all items that ever were at half price, and counts (name, n).

    parsed: retailer, item, name, category, regular, image_url, events; item is
    the stock number. A product that is not stored gets the id retailer:item;
    names and regular prices of stored ones stay. An event is a special from its
    own day for a week, and an observation on that day; a key that is stored
    stays as it is, and of events on one day the first in the history counts.
    """
    ever = parsed.where(F.size("events") > 0)
    rows = ever.select(
        F.concat_ws(":", "retailer", "item").alias("product_id"), "retailer", F.col("item").alias("sku"), "name", "category",
        F.col("regular").alias("regular_price_cents"), "image_url",
    )
    stored = merge.upsert(
        products, merge.least_row(rows, ["retailer", "sku"]), ["retailer", "sku"],
        merge.catalogue_rules(products.columns) | {"product_id": F.col("o.product_id")},
    )
    past = event_rows(ever, stored, current_week, source)
    half = F.lit(True)
    new_specials = past.select(
        "product_id", F.col("on_date").alias("week_start"), F.date_add("on_date", 6).alias("week_end"), "regular_cents", "sale_cents", "discount_pct",
        half.alias("is_half_price"), "source", "pos",
    )
    new_observations = past.select(
        "product_id", F.col("sale_cents").alias("price_cents"), half.alias("is_special"), "discount_pct", F.col("on_date").alias("observed_at"), "source", "pos"
    )
    all_specials = merge.insert_absent(specials, new_specials, SPECIAL_KEYS, "pos")
    all_observations = merge.insert_absent(observations, new_observations, OBSERVATION_KEYS, "pos")
    n = lambda df, name: df.agg(F.lit(name).alias("name"), F.count("*").alias("n"))
    counts = (
        n(ever, "ever_half")
        .unionByName(n(past, "event_rows"))
        .unionByName(n(new_specials.select(*SPECIAL_KEYS).distinct().join(specials, SPECIAL_KEYS, "left_anti"), "specials_inserted"))
        .unionByName(n(new_observations.select(*OBSERVATION_KEYS).distinct().join(observations, OBSERVATION_KEYS, "left_anti"), "observations_inserted"))
    )
    return {"products": stored, "specials": all_specials, "observations": all_observations, "counts": counts}
