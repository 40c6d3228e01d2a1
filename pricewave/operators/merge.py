"""Upserts and deletes as functions from tables to tables.

Each takes the stored table and new rows and returns the table that replaces it:
a full outer join on the key with a rule per column, or an anti-join and a union.
"""

from pyspark.sql import Column, DataFrame, functions as F

UNCATEGORISED = "Uncategorised"


def last_wins(rows: DataFrame, keys: list[str], position: str) -> DataFrame:
    """One row per key: that of the largest position."""
    return _one(rows, keys, F.max_by, F.struct(position))


def first_wins(rows: DataFrame, keys: list[str], position: str) -> DataFrame:
    return _one(rows, keys, F.min_by, F.struct(position))


def prefer_flag(rows: DataFrame, keys: list[str], flag: str, position: str) -> DataFrame:
    """One row per key: the first with the flag, else the first."""
    return _one(rows, keys, F.min_by, F.struct(~F.coalesce(F.col(flag), F.lit(False)), F.col(position)))


def least_row(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key where nothing says which came first: the least by all its columns, so that runs agree."""
    return _one(rows, keys, F.min_by, F.struct(*rows.columns))


def _one(rows, keys, pick, order):
    """Rows are combined before the shuffle: a key's rows never meet in one task."""
    rest = [c for c in rows.columns if c not in keys]
    picked = rows.groupBy(*keys).agg(pick(F.struct(*rest), order).alias("_row")) if rest else rows.distinct()
    return picked.select(*keys, "_row.*").select(*rows.columns) if rest else picked


def upsert(old: DataFrame, new: DataFrame, keys: list[str], rules: dict[str, Column] | None = None) -> DataFrame:
    """old with new's rows put in; columns without a rule take the new value.

    Rules are Columns over o.<name> and n.<name> for keys in both. new must hold
    each key once.
    """
    rules = rules or {}
    o, n = old.alias("o"), new.alias("n")
    match = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    joined = o.withColumn("_old", F.lit(True)).alias("o").join(n.withColumn("_new", F.lit(True)).alias("n"), match, "full_outer")
    out = []
    for c in old.columns:
        mine, given = F.col(f"o.{c}"), F.col(f"n.{c}") if c in new.columns else F.lit(None)
        if c in keys:
            out.append(F.when(F.col("o._old"), mine).otherwise(given).alias(c))
        else:
            both = rules.get(c, given if c in new.columns else mine)
            out.append(F.when(F.col("n._new").isNull(), mine).when(F.col("o._old").isNull(), given).otherwise(both).alias(c))
    return joined.select(*out)


def product_rules(category: str = "new", now: str | None = None) -> dict[str, Column]:
    """Rules for products: category "new" takes a new label unless it is a placeholder, "old" keeps one that is there."""
    o, n = (lambda c: F.col(f"o.{c}")), (lambda c: F.col(f"n.{c}"))
    real = n("category").isNotNull() & (n("category") != UNCATEGORISED)
    rules = {
        "category": F.when(real, n("category")).otherwise(o("category")) if category == "new" else F.coalesce(o("category"), n("category")),
        "regular_price_cents": F.greatest(o("regular_price_cents"), n("regular_price_cents")),
        "image_url": F.coalesce(o("image_url"), n("image_url")),
    }
    if now:
        stamp = F.lit(now).cast("timestamp")
        rules["image_fetched_at"] = F.when(o("image_url").isNull() & n("image_url").isNotNull(), stamp).otherwise(o("image_fetched_at"))
        rules["last_seen"] = stamp
    return rules


def catalogue_rules(columns: list[str]) -> dict[str, Column]:
    """Rules for products from a catalogue: names and regular prices stay as they are."""
    rules = {c: r for c, r in product_rules().items() if c in columns}
    rules |= {c: F.col(f"o.{c}") for c in ("name", "regular_price_cents") if c in columns}
    if "source_product_url" in columns:
        rules["source_product_url"] = F.coalesce(F.col("o.source_product_url"), F.col("n.source_product_url"))
    return rules


def upsert_catalogue(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return upsert(old, new, keys, catalogue_rules(old.columns))


def ingest_retailer(stored: DataFrame, parsed: DataFrame, position: str = "pos") -> DataFrame:
    """A retailer's whole catalogue put into the stored products (sku, name, category, regular_price_cents, image_url).

    parsed is what pricing.products gives of a dump's usable items, with item,
    name, category, image_url and its position in the dump; its regular price is
    the one derived from the history. Of repeated items the last counts.
    """
    rows = parsed.select(F.col("item").cast("string").alias("sku"), "name", "category", F.col("regular").alias("regular_price_cents"), "image_url", F.col(position).alias("_pos"))
    return upsert_catalogue(stored, last_wins(rows, ["sku"], "_pos").drop("_pos"), ["sku"])


def upsert_specials(old: DataFrame, new: DataFrame, keys: list[str] = ["product_id", "week_start"], position: str = "pos", keep_source: bool = False) -> DataFrame:
    """Specials with a pull's rows put in, the last of a key by position counting; with keep_source, a row that is there keeps its source, as when rows come one by one."""
    return upsert(old, last_wins(new, keys, position).drop(position), keys, {"source": F.col("o.source")} if keep_source else None)


def insert_absent(old: DataFrame, new: DataFrame, keys: list[str], position: str | None = None) -> DataFrame:
    """old and those new rows whose key it lacks; of new rows that share a key the first by position goes in, or without a position the least."""
    one = least_row(new, keys) if position is None else first_wins(new, keys, position)
    return old.unionByName(one.join(old.select(*keys).distinct(), keys, "left_anti").select(*old.columns))


def sync_week(specials: DataFrame, kept: DataFrame, week: str, source: str, retailers: list[str]) -> DataFrame:
    """Without the rows of this week, source and these retailers whose product is not in kept; an empty kept deletes nothing."""
    if kept.isEmpty():
        return specials
    scope = (F.col("week_start") == F.lit(week).cast("date")) & (F.col("source") == source) & F.col("retailer").isin(retailers)
    ids = kept.select("product_id").distinct().withColumn("_kept", F.lit(True))
    found = specials.join(ids, "product_id", "left")
    return found.where(~F.coalesce(scope, F.lit(False)) | F.col("_kept").isNotNull()).select(*specials.columns)


def sweep_sources(specials: DataFrame, week: str, retailer: str, written: str, partial: bool = False) -> DataFrame:
    """Without the retailer's rows of this week from other sources; a partial pull sweeps nothing."""
    if partial:
        return specials
    gone = (F.col("week_start") == F.lit(week).cast("date")) & (F.col("retailer") == retailer) & (F.col("source") != written)
    return specials.where(~F.coalesce(gone, F.lit(False)))


def purge(tables: dict[str, DataFrame], gone: DataFrame, confirm: bool = False) -> dict[str, DataFrame]:
    """Each table without the rows of the product ids in gone; unless confirmed, how many rows would go."""
    ids = gone.select("product_id").distinct()
    if confirm:
        return {name: t.join(ids, "product_id", "left_anti").select(*t.columns) for name, t in tables.items()}
    return {name: t.join(ids, "product_id", "left_semi").agg(F.count("*").alias("rows")) for name, t in tables.items()}


def drop_orphans(watchlists: DataFrame, now: str, days: int = 60) -> DataFrame:
    return watchlists.where(~(F.col("last_synced_at") < F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(days))))


def replace_scope(old: DataFrame, new: DataFrame, scope: Column) -> DataFrame:
    """old without the rows in scope, and new: a full or per-week replacement."""
    return old.where(~F.coalesce(scope, F.lit(False))).unionByName(new.select(*old.columns))
