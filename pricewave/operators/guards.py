"""Guards over counts and dates, and the table of invariants.

Guards are columns, so a run over many weeks or sources judges all in one plan.
"""

from pyspark.sql import Column, DataFrame, functions as F

from pricewave.functions.scalars import week_start

FRESH_FLOOR, LIVE_FLOOR, DUMP_FLOOR = 200, 400, 10_000


def blocks_new_week(db_max: str, expected: str, fresh: str) -> Column:
    """A week not yet stored is held back while few items changed in it."""
    new = F.col(db_max).isNull() | (F.col(db_max) < F.col(expected))
    return new & (F.coalesce(F.col(fresh), F.lit(0)) < FRESH_FLOOR)


def solo_roll(db_max: str, expected: str, other_rows: str) -> Column:
    """One retailer alone must not open a week."""
    return (F.col(db_max).isNull() | (F.col(expected) > F.col(db_max))) & (F.col(other_rows) == 0)


def keeps_live(from_dump: str, live_rows: str) -> Column:
    return F.col(from_dump) & (F.col(live_rows) >= LIVE_FLOOR)


def exit_code(written: str) -> Column:
    """0 for rows written and for -1, a run that rightly wrote nothing; 1 for a run that found nothing."""
    return F.when(F.col(written) == 0, 1).otherwise(0)


def digest_proceeds(db_max: str, expected: str, forced: str) -> Column:
    """The newest week must be the expected one, unless forced; without a week never."""
    return F.col(db_max).isNotNull() & (F.col(forced) | (F.col(db_max) == F.col(expected)))


def trickle_complete(got, total) -> Column:
    """Nearly all was collected; never without a total."""
    got, total = (F.col(c) if isinstance(c, str) else c for c in (got, total))
    known = F.coalesce(total, F.lit(0)) > 0
    return known & ((got >= 0.9 * total) | (got >= total - 40))


def trickle_writes(got: str, total: str, forced: str) -> Column:
    """Whether a collection may take the place of the old one: complete, or forced with half of the total at least."""
    enough = (F.coalesce(F.col(total), F.lit(0)) <= 0) | (F.col(got) >= 0.5 * F.col(total))
    return trickle_complete(got, total) | (F.col(forced) & enough)


MIN_CANDIDATES, MIN_BUNDLES = 20, 2


def bundle_source(candidates: str, drafted: str, seeded: str) -> Column:
    """Where a week's bundles come from: "draft" if enough drafts hold, else "seed" if enough seeds do, else "none"; too few candidates make none."""
    few = F.coalesce(F.col(candidates), F.lit(0)) < MIN_CANDIDATES
    return F.when(few, "none").when(F.col(drafted) >= MIN_BUNDLES, "draft").when(F.col(seeded) >= MIN_BUNDLES, "seed").otherwise("none")


def revalidate(expected: str, actual: str, existing: str, stale: str) -> Column:
    """What a daily check does to a week's bundles: "skip" another week's, "keep" good ones, "make" missing or stale ones."""
    return F.when(F.col(actual).isNull() | (F.col(expected) != F.col(actual)), "skip").when((F.col(existing) > 0) & (F.col(stale) == 0), "keep").otherwise("make")


def enough_items(dump: DataFrame, least: int = DUMP_FLOOR) -> DataFrame:
    """The dump, failing when read if it holds fewer items than it should."""
    n = dump.count()
    if n < least:
        raise ValueError(f"dump has {n} items, fewer than {least}")
    return dump


#: Expectations of the checks; a table's size and a retailer's habits decide the numbers.
FLOORS = {
    "half": 400, "ratio": 0.4, "catalogue": (15_000, 12_000), "run_hours": 26, "predictions": 3_000, "days": 9, "links": 3_000,
    "uncategorised": 40, "recall": 70, "bundles": 2, "live_days": 8, "dormant": 99,
}


def _stacked(row: DataFrame, checks: dict[str, tuple]) -> DataFrame:
    """(name, value, passed, expect) from one row; checks gives value, how it is compared, and the bound. A null value passes."""
    parts = []
    for name, (value, how, bound) in checks.items():
        v = value.cast("double")
        holds = {">=": v >= bound, "<=": v <= bound, "=": v == bound}[how]
        parts.append(F.struct(F.lit(name).alias("name"), v.alias("value"), F.coalesce(holds, F.lit(True)).alias("passed"), F.lit(f"{how} {bound}").alias("expect")))
    return row.select(F.inline(F.array(*parts)))


def standard_checks(tables: dict[str, DataFrame], now: str, retailers: tuple[str, str] = ("coles", "woolworths"), sources: tuple = (("dump",), ("live", "dump")), audit_source: str = "catalogue", floors: dict | None = None) -> DataFrame:
    """The invariants over stored tables, each table read in one aggregate.

    tables are specials, products, runs, predictions, accuracy, links, audits and
    bundles; retailers and the sources of their runs come in the same order.
    Ages count from now in days; a table that was never written is 999 days old,
    but an audit that never ran is 0, and bundles not made lately are dormant.
    """
    floors = FLOORS | (floors or {})
    at = F.lit(now).cast("timestamp")
    one, two = retailers
    age = lambda c: (F.unix_timestamp(at) - F.unix_timestamp(F.max(c))) / 86400.0
    c = F.col

    def newest(df, week, **counts):
        """The counts of the newest week alone; zeros and no week if the table is empty."""
        by_week = df.groupBy(week).agg(*[e.alias(k) for k, e in counts.items()])
        return by_week.agg(F.max(week).alias("week"), *[F.coalesce(F.max_by(k, week), F.lit(0)).alias(k) for k in counts])

    half = c("is_half_price")
    specials = newest(tables["specials"], "week_start", a=F.count_if(half & (c("retailer") == one)), b=F.count_if(half & (c("retailer") == two)), inverted=F.count_if(c("sale_cents") > c("regular_cents")))
    products = tables["products"].agg(
        F.count_if(c("sku").startswith("stockup:")).alias("synthetic"), F.count_if((c("retailer") == two) & (F.length(F.split_part("sku", F.lit(":"), F.lit(2))) >= 8)).alias("marketplace"),
        F.count_if(c("retailer") == one).alias("a"), F.count_if(c("retailer") == two).alias("b"), F.rint(100.0 * F.count_if(c("category") == "Uncategorised") / F.greatest(F.count("*"), F.lit(1))).alias("share"),
    )
    lately = c("status").isin("success", "partial") & (c("run_at") > at - F.make_dt_interval(F.lit(0), F.lit(floors["run_hours"])))
    runs = tables["runs"].agg(*[F.count_if(lately & c("source").isin(list(names))).alias(k) for k, names in zip("ab", sources)])
    mine = c("retailer") == one
    audits = tables["audits"].agg(F.coalesce(F.max_by(c("recall_pct"), F.when(mine & (c("source") == audit_source), c("measured_at"))), F.lit(100.0)).alias("recall"), F.coalesce(age(F.when(mine, c("measured_at"))), F.lit(0.0)).alias("age"))
    week = tables["specials"].agg(F.max("week_start").alias("week"))  # one row
    live = F.count_if(c("generated_at") > at - F.make_dt_interval(F.lit(floors["live_days"])))
    now_on = tables["bundles"].join(F.broadcast(week), c("week_start") == c("week"), "left")
    bundles = now_on.agg(F.when(live == 0, floors["dormant"]).otherwise(F.count_if(c("week").isNotNull())).alias("fresh"))
    heroes = now_on.where("week IS NOT NULL").select(c("week_start"), F.explode("ingredients").alias("i")).select("week_start", c("i.product_id").alias("product_id"))
    heroes = heroes.join(tables["specials"].where(half).select("week_start", "product_id").distinct(), ["week_start", "product_id"], "left_anti").agg(F.count("*").alias("n"))
    checks = [
        _stacked(specials, {
            "a_current_half": (c("a"), ">=", floors["half"]), "b_current_half": (c("b"), ">=", floors["half"]),
            "half_ratio": (F.when(c("a") == 0, 1.0).otherwise(F.rint(100.0 * c("b") / c("a")) / 100), ">=", floors["ratio"]),
            "week_is_current": (F.coalesce(F.datediff("week", week_start(at.cast("date"))), F.lit(-1)), "=", 0), "no_inverted_prices": (c("inverted"), "=", 0)}),
        _stacked(products, {
            "no_synthetic_products": (c("synthetic"), "=", 0), "no_marketplace_products": (c("marketplace"), "=", 0), "a_catalogue_floor": (c("a"), ">=", floors["catalogue"][0]),
            "b_catalogue_floor": (c("b"), ">=", floors["catalogue"][1]), "uncategorised_share": (c("share"), "<=", floors["uncategorised"])}),
        _stacked(runs, {"a_scraped_recently": (c("a"), ">=", 1), "b_scraped_recently": (c("b"), ">=", 1)}),
        _stacked(tables["predictions"].agg(F.coalesce(age("computed_at"), F.lit(999.0)).alias("age"), F.count("*").alias("n")), {"predictions_fresh": (c("age"), "<=", floors["days"]), "predictions_floor": (c("n"), ">=", floors["predictions"])}),
        _stacked(tables["accuracy"].agg(F.coalesce(age("computed_at"), F.lit(999.0)).alias("age")), {"accuracy_fresh": (c("age"), "<=", floors["days"])}),
        _stacked(tables["links"].agg(F.count_if(c("kind") == "counterpart").alias("n")), {"counterpart_links_floor": (c("n"), ">=", floors["links"])}),
        _stacked(audits, {"recall_floor": (c("recall"), ">=", floors["recall"]), "audit_fresh": (c("age"), "<=", floors["days"])}),
        _stacked(bundles, {"bundles_fresh_when_live": (c("fresh"), ">=", floors["bundles"])}),
        _stacked(heroes, {"heroes_half_price": (c("n"), "=", 0)}),
    ]
    out = checks[0]
    for more in checks[1:]:
        out = out.unionByName(more)
    return out
