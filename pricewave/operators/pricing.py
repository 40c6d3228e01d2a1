"""Half-price events and current specials from price change points.

A history is an array<struct<on_date date, cents bigint>>, newest first, in file order.
"""

from pyspark.sql import DataFrame, functions as F

from pricewave.functions import scalars

EVENT_OFF, SPECIAL_OFF = 0.48, 0.30
REGULAR_DAYS, RECENT_DAYS = 300, 14
MARKETPLACE_ID_LENGTH = 8
# Category codes that are not groceries.
DENIED_CODES = ["778", "779", "10104", "10105", "11111", *map(str, range(13125, 13144))]


def history(points: DataFrame, *keys: str) -> DataFrame:
    """One row per key with its change points newest first: one shuffle, map-side arrays merged."""
    return points.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("on_date", "cents")), asc=False).alias("hist"))


def parse_history(raw: str = "priceHistory") -> F.Column:
    """Raw {date, price} entries to change points; entries whose price or date is malformed go, order stays."""
    return F.expr(
        f"""filter(transform(coalesce({raw}, array()), p -> struct(
              IF(p.date RLIKE r'^\\d{{4}}-\\d{{2}}-\\d{{2}}$', try_cast(p.date AS DATE), NULL) AS on_date,
              IF(rint(try_cast(p.price AS DOUBLE) * 100) > 0, try_cast(rint(try_cast(p.price AS DOUBLE) * 100) AS BIGINT), NULL) AS cents)),
            h -> h.on_date IS NOT NULL AND h.cents IS NOT NULL)"""
    )


def events(hist: str = "hist") -> F.Column:
    """array<struct<on_date, sale_cents, regular_cents, discount_pct>>: drops of 48 % or more from the entry before."""
    return F.expr(
        f"""filter(zip_with(slice({hist}, 1, greatest(size({hist}) - 1, 0)), slice({hist}, 2, greatest(size({hist}) - 1, 0)), (now, was) -> struct(
              now.on_date AS on_date, now.cents AS sale_cents, was.cents AS regular_cents,
              CAST(rint(100D * (1D - now.cents / was.cents)) AS BIGINT) AS discount_pct)),
            e -> e.sale_cents > 0 AND e.regular_cents > 0 AND (1D - e.sale_cents / e.regular_cents) >= {EVENT_OFF}D)"""
    )


def regular_cents(today: str, hist: str = "hist") -> F.Column:
    """Largest price of the last 300 days' change points, else of all, else 0."""
    best = lambda h: f"array_max(transform({h}, x -> x.cents))"
    recent = f"filter({hist}, x -> x.on_date >= date_sub(DATE '{today}', {REGULAR_DAYS}))"
    return F.expr(f"coalesce({best(recent)}, {best(hist)}, 0L)")


def products(histories: DataFrame, today: str) -> DataFrame:
    """Adds events, regular, current, changed, is_half, pct (at 30 % off or more) to each history; no shuffle."""
    off = F.when(F.col("regular") > 0, 1.0 - F.col("current") / F.col("regular")).otherwise(0.0)
    out = (
        histories.where(F.size("hist") > 0)
        .withColumn("events", events())
        .withColumn("regular", regular_cents(today))
        .withColumn("current", F.col("hist")[0]["cents"])
        .withColumn("changed", F.col("hist")[0]["on_date"])
        .withColumn("off", off)
    )
    drop = (F.size("events") > 0) & (F.get("events", F.lit(0))["on_date"] == F.col("changed"))
    deep = (F.col("regular") > 0) & (F.col("off") >= EVENT_OFF)
    fresh = F.datediff(F.lit(today).cast("date"), "changed") <= RECENT_DAYS
    return out.withColumn("is_half", (F.coalesce(drop, F.lit(False)) | deep) & fresh).withColumn(
        "pct", F.when(F.col("off") >= SPECIAL_OFF, F.rint(100.0 * F.col("off")).cast("bigint"))
    )


def specials(found: DataFrame, today: str) -> DataFrame:
    """Rows on special: sale, regular, discount, half-price flag and week."""
    day = F.lit(today).cast("date")
    return found.where("pct IS NOT NULL").select(
        "retailer", "item", F.col("regular").alias("regular_cents"), F.col("current").alias("sale_cents"), F.col("pct").alias("discount_pct"),
        (F.col("is_half") & (F.col("pct") >= 48)).alias("is_half_price"), scalars.week_start(day).alias("week_start"), scalars.week_end(day).alias("week_end"),
    )


def is_marketplace(retailer: str, item: str, code: str, strict_retailer: str = "woolworths") -> F.Column:
    long_id = (F.col(retailer) == strict_retailer) & (F.coalesce(F.length(F.col(item).cast("string")), F.lit(0)) >= MARKETPLACE_ID_LENGTH)
    return F.coalesce(long_id, F.lit(False)) | F.coalesce(F.col(code).cast("string").isin(DENIED_CODES), F.lit(False))


def fresh_items(histories: DataFrame, cutoff: str) -> DataFrame:
    """How many items have a change point on or after cutoff, whatever the order."""
    newest = F.array_max(F.transform("hist", lambda h: h["on_date"]))
    return histories.agg(F.count_if(newest >= F.lit(cutoff).cast("date")).alias("fresh"), F.count("*").alias("items"))


def category_labels(items: DataFrame, labels: DataFrame, code: str = "code", name: str = "name") -> DataFrame:
    """Label by code from the dimension (code, label), else by keywords in the name."""
    dim = labels.groupBy(F.col("code").alias("dim_code")).agg(F.min("label").alias("dim_label"))
    joined = items.join(dim, items[code] == dim["dim_code"], "left")
    return joined.withColumn("category", F.coalesce("dim_label", scalars.keyword_category(F.col(name)), F.lit(scalars.UNCATEGORISED))).drop("dim_code", "dim_label")
