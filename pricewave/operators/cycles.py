"""Sale cycles: intervals, predictions and the walk-forward backtest.

Dates closer than a week to the last kept date are dropped by a greedy fold. The
fold of a prefix is a prefix of the fold, so it runs once per series and leaves
at every date the running count, sum and sum of squares of the intervals, from
which any window's mean and deviation follow exactly.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

NEAR_DAYS, MIN_WEEKS, MAX_CONFIDENCE = 7, 2, 0.95


def sale_dates(entries: str = "entries") -> Column:
    """Sorted dates of array<struct<week_start, hint_weeks>>, a positive hint adding the sale so many weeks before."""
    return F.expr(
        f"array_sort(flatten(transform({entries}, e -> concat(array(e.week_start), IF(e.hint_weeks > 0, array(date_sub(e.week_start, 7 * e.hint_weeks)), CAST(array() AS ARRAY<DATE>))))))"
    )


_STATE = "STRUCT<last: DATE, n: BIGINT, s: BIGINT, q: BIGINT>"


def _step(last: str) -> str:
    """The state after date d, last being the state before it: null for the first date."""
    gap = f"datediff(d, {last}.last)"
    weeks = f"CAST(rint({gap} / 7D) AS BIGINT)"
    counted = f"IF({weeks} >= {MIN_WEEKS}, 1L, 0L)"
    kept = f"named_struct('last', d, 'n', {last}.n + {counted}, 's', {last}.s + {counted} * {weeks}, 'q', {last}.q + {counted} * {weeks} * {weeks})"
    return f"CASE WHEN {last} IS NULL THEN named_struct('last', d, 'n', 0L, 's', 0L, 'q', 0L) WHEN {gap} < {NEAR_DAYS} THEN {last} ELSE {kept} END"


def running(dates: str = "dates") -> Column:
    """For each sorted date: struct(last kept date, n, s, q) of the prefix up to and with it."""
    return F.expr(f"aggregate({dates}, CAST(array() AS ARRAY<{_STATE}>), (acc, d) -> concat(acc, array({_step('try_element_at(acc, -1)')})))")


def final(dates: str = "dates") -> Column:
    """The last of running(), without the others."""
    return F.expr(f"aggregate({dates}, CAST(NULL AS {_STATE}), (acc, d) -> {_step('acc')})")


def onward(before: str, dates: str = "dates") -> Column:
    """final() that starts from the struct before, null where there is none."""
    return F.expr(f"aggregate({dates}, CAST({before} AS {_STATE}), (acc, d) -> {_step('acc')})")


def intervals(dates: str = "dates") -> Column:
    """Whole weeks between kept dates, two or more."""
    fold = f"aggregate({dates}, CAST(array() AS ARRAY<DATE>), (acc, d) -> IF(size(acc) > 0 AND datediff(d, element_at(acc, -1)) < {NEAR_DAYS}, acc, concat(acc, array(d))))"
    return F.expr(
        f"transform(array({fold}), k -> filter(zip_with(slice(k, 1, greatest(size(k) - 1, 0)), slice(k, 2, greatest(size(k) - 1, 0)), (a, b) -> CAST(rint(datediff(b, a) / 7D) AS INT)), w -> w >= {MIN_WEEKS}))[0]"
    )


def with_window(df: DataFrame, today: str) -> DataFrame:
    """From n, s, q and last_sale: mean, sd, win_start, win_end, confidence, tier. today is a date column."""
    n, s, q = (F.col(c).cast("double") for c in "nsq")
    sd = F.when(F.col("n") == 1, 1.5).otherwise(F.sqrt((n * q - s * s) / (n * F.when(F.col("n") > 1, n - 1).otherwise(1.0))))
    step = F.expr("CAST((7 * s) DIV n AS INT)")
    df = df.withColumn("mean", s / n).withColumn("sd", F.when(F.col("n").between(2, 3), F.greatest(sd, F.lit(1.0))).otherwise(sd))
    half = F.greatest(F.lit(1.0), F.least("sd", F.lit(4.0)))
    df = df.withColumn("half_days", F.floor(F.rint(half * 7.0 * 86400e6) / 86400e6).cast("int")).withColumn("next", F.date_add("last_sale", step))
    df = df.withColumn("next", F.when(F.date_add("next", F.col("half_days")) < F.col(today), F.date_add("next", step)).otherwise(F.col("next")))
    raw = F.least(F.lit(MAX_CONFIDENCE), 0.5 * F.least(n / 8.0, F.lit(1.0)) + 0.5 * (1.0 - F.least(F.col("sd") / F.greatest("mean", F.lit(1.0)), F.lit(1.0))))
    df = df.withColumn("win_start", F.date_sub("next", F.col("half_days"))).withColumn("win_end", F.date_add("next", F.col("half_days"))).withColumn("confidence", F.rint(raw * 100) / 100)
    tier = F.when((F.col("n") < 3) | (F.col("confidence") < 0.45), "low").when(F.col("confidence") >= 0.75, "high").otherwise("medium")
    return df.withColumn("tier", tier).drop("half_days", "next")


def rationale(today: str) -> Column:
    since = F.datediff(F.col(today), "last_sale")
    status = F.when(since <= 7, "Currently half-price").otherwise(F.concat(F.lit("Last seen half-price "), F.floor(since / 7).cast("string"), F.lit(" weeks ago")))
    span = lambda word: F.concat(F.col("win_start").cast("string"), F.lit(word), F.col("win_end").cast("string"))
    one = F.concat(status, F.lit(". Only one historical cycle observed so far — predicted window "), span(" to "), F.lit(" is a rough estimate."))
    many = F.concat(
        status, F.lit(". Half-price about every "), F.rint("mean").cast("bigint").cast("string"), F.lit(" weeks on average over "), F.col("n").cast("string"),
        F.lit(" cycles (±"), F.format_string("%.1f", F.rint(F.col("sd") * 10) / 10), F.lit(" weeks). Predicted next window: "), span(" to "), F.lit("."),
    )
    return F.when(F.col("n") == 1, one).otherwise(many)


def series(sales: DataFrame, *keys: str) -> DataFrame:
    """Sales (keys, week_start, hint_weeks) to one row per key: dates, intervals' n, s, q, and the last observed sale."""
    grouped = sales.groupBy(*keys).agg(F.collect_list(F.struct("week_start", "hint_weeks")).alias("entries"), F.max("week_start").alias("last_sale"))
    return grouped.withColumn("dates", sale_dates()).withColumn("state", final()).select(*keys, "dates", "last_sale", "state.n", "state.s", "state.q")


def predictions(sales: DataFrame, today: str, min_cycles: int = 1, keys=("retailer", "name")) -> DataFrame:
    """Next sale window per retailer and stripped name; groups with fewer intervals than min_cycles give none."""
    day = F.lit(today).cast("date")
    found = series(sales.withColumn(keys[-1], F.trim(keys[-1])), *keys).where((F.col("n") >= min_cycles) & (F.col("n") > 0)).withColumn("today", day)
    return with_window(found, "today").withColumn("rationale", rationale("today"))


def prediction_summary(sales: DataFrame, min_cycles: int = 1, keys=("retailer", "name")) -> DataFrame:
    kept = F.col("n") >= max(min_cycles, 1)
    return series(sales, *keys).agg(F.count("*").alias("considered"), F.count_if(kept).alias("emitted"), F.count_if(~kept).alias("gated"))


def backtest(sales: DataFrame, key: str = "item") -> DataFrame:
    """Every later sale two weeks or more after the one before it, predicted from the sales before it."""
    dates = sales.groupBy(key).agg(F.array_sort(F.collect_list("week_start")).alias("dates")).where(F.size("dates") >= 3)
    walked = dates.withColumn("state", running()).select(key, F.expr("explode(transform(sequence(2, size(dates) - 1), k -> struct(dates[k] AS actual, dates[k - 1] AS last_sale, state[k - 1] AS p)))").alias("w"))
    tests = walked.select(key, "w.actual", "w.last_sale", "w.p.n", "w.p.s", "w.p.q").where((F.datediff("actual", "last_sale") >= 7 * MIN_WEEKS) & (F.col("n") > 0))
    return with_window(tests.withColumn("today", F.date_add("last_sale", 1)), "today").withColumn("hit", F.col("actual").between(F.col("win_start"), F.col("win_end")))


def by_product(tests: DataFrame, key: str = "item") -> DataFrame:
    """Tested, hits, and the same of the latest six windows."""
    last = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("actual"))) <= 6
    return tests.withColumn("recent", last).groupBy(key).agg(
        F.count("*").alias("tested"), F.count_if("hit").alias("hits"), F.count_if("recent").alias("last6_tested"), F.count_if(F.col("recent") & F.col("hit")).alias("last6_hits")
    )


def by_tier(tests: DataFrame) -> DataFrame:
    """Tested, hits and hit rate per tier and overall, tiers without a test too."""
    spark = tests.sparkSession
    names = spark.createDataFrame([("high",), ("medium",), ("low",), ("overall",)], "tier string")
    sums = tests.rollup("tier").agg(F.count("*").alias("tested"), F.count_if("hit").alias("hits")).withColumn("tier", F.coalesce("tier", F.lit("overall")))
    out = names.join(sums, "tier", "left").select("tier", F.coalesce("tested", F.lit(0)).alias("tested"), F.coalesce("hits", F.lit(0)).alias("hits"))
    return out.withColumn("rate", F.when(F.col("tested") > 0, F.lit(100.0) * F.col("hits") / F.col("tested")))
