"""Cycles kept up to date: a row of running sums for each series, advanced by new sales alone."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pricewave.operators import cycles

SUMS = ("last", "n", "s", "q", "last_sale")


def _same(a: DataFrame, b: DataFrame, keys: tuple[str, ...]) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def from_scratch(sales: DataFrame, *keys: str) -> DataFrame:
    """(keys, last, n, s, q, last_sale) of all sales (keys, week_start, hint_weeks): the last kept date and the sums over the intervals between kept dates."""
    grouped = sales.groupBy(*keys).agg(F.collect_list(F.struct("week_start", "hint_weeks")).alias("entries"), F.max("week_start").alias("last_sale"))
    return grouped.withColumn("dates", cycles.sale_dates()).withColumn("state", cycles.final()).select(*keys, "state.last", "state.n", "state.s", "state.q", "last_sale")


def advance(state: DataFrame, new: DataFrame, history: Callable[[], DataFrame], *keys: str) -> DataFrame:
    """state after new sales (keys, week_start, hint_weeks), equal to from_scratch() over all of them.

    A date on or after a series' last kept date goes on from its sums: dates that
    were dropped since lie within a week of that date, and so would it. Only a
    series with a new date before its last kept one is folded again, from
    history(), all sales with the new ones; where there is none, history is not read.
    """
    got = new.groupBy(*keys).agg(F.collect_list(F.struct("week_start", "hint_weeks")).alias("entries"), F.max("week_start").alias("newest"))
    got = got.withColumn("dates", cycles.sale_dates()).drop("entries")
    met = got.join(state, _same(got, state, keys), "left").select(*[got[k] for k in keys], "dates", "newest", *SUMS)
    behind = F.coalesce(F.element_at("dates", 1) < F.col("last"), F.lit(False))
    sums = F.when(F.col("last").isNotNull(), F.struct("last", "n", "s", "q"))
    forward = met.where(~behind).withColumn("before", sums).withColumn("after", cycles.onward("before"))
    gone_on = forward.select(*keys, "after.last", "after.n", "after.s", "after.q", F.greatest("newest", "last_sale").alias("last_sale"))
    untouched = state.join(got, _same(state, got, keys), "left_anti").select(*keys, *SUMS)
    out = untouched.unionByName(gone_on)
    late = met.where(behind).select(*keys)
    if late.isEmpty():
        return out
    every = history()
    return out.unionByName(from_scratch(every.join(late, _same(every, late, keys), "left_semi"), *keys))


def predictions(state: DataFrame, today: str, min_cycles: int = 1) -> DataFrame:
    """Next sale windows from a state, as cycles.predictions() gives them from all sales."""
    found = state.where((F.col("n") >= min_cycles) & (F.col("n") > 0)).withColumn("today", F.lit(today).cast("date"))
    return cycles.with_window(found, "today").withColumn("rationale", cycles.rationale("today"))


class CycleTable:
    """The state on disk, a version for each run that advanced it; a run that is repeated changes nothing."""

    def __init__(self, spark: SparkSession, path: str, *keys: str) -> None:
        self.spark, self.path, self.keys = spark, path, keys

    def versions(self) -> list[str]:
        """The runs in order."""
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/runs")
        if not target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target):
            return []
        return [r.run_id for r in self.spark.read.parquet(f"{self.path}/runs").orderBy("version").collect()]  # a row for each run

    def read(self) -> DataFrame | None:
        done = self.versions()
        return self.spark.read.parquet(f"{self.path}/state-{len(done) - 1}") if done else None

    def advance(self, run_id: str, new: DataFrame, history: Callable[[], DataFrame]) -> bool:
        """Put new sales in; False if the run is in already. A run that fails leaves the last version."""
        done = self.versions()
        if run_id in done:
            return False
        state = self.read()
        made = from_scratch(new, *self.keys) if state is None else advance(state, new, history, *self.keys)
        made.write.mode("overwrite").parquet(f"{self.path}/state-{len(done)}")
        self.spark.createDataFrame([(len(done), run_id)], "version int, run_id string").coalesce(1).write.mode("append").parquet(f"{self.path}/runs")
        return True
