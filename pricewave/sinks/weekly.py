"""A stored table that is partitioned by week and rewritten week by week.

Layout: ``data`` (Parquet, one folder for each week), ``runs`` (one row for each
run that has been put in), ``staged`` (what a run is about to put in). A run
reads the weeks that it touches, changes them, writes the result aside, and only
then has Spark's dynamic partition overwrite put the staged weeks in place. Weeks
that it does not touch keep their files. A run that fails before that leaves the
table as it was; one that is repeated after it finds its id and does nothing.
"""

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricewave.operators import merge


class WeeklyTable:
    """A table of a given schema at path; week is its date column of weeks, of which it has so few that the driver can name those that a run touches."""

    def __init__(self, spark: SparkSession, path: str, schema: str, week: str = "week_start") -> None:
        self.spark, self.path, self.schema, self.week = spark, path, schema, week

    def _read(self, part: str, schema: str) -> DataFrame:
        if not self._exists(f"{self.path}/{part}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{part}")

    def _files(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def _exists(self, path: str) -> bool:
        files, target = self._files(path)
        return files.exists(target)

    def read(self) -> DataFrame:
        """All rows; a filter on the week reads that week's files only."""
        return self._read("data", self.schema)

    def runs(self) -> DataFrame:
        """(run_id, weeks, rows) of the runs that have been put in."""
        return self._read("runs", "run_id string, weeks array<date>, rows long")

    def apply(self, run_id: str, weeks: list, change: Callable[[DataFrame], DataFrame]) -> bool:
        """Replace the rows of these weeks by what change makes of them; False if the run is in already.

        change may read the table; it must give rows of these weeks only, and may leave a week empty.
        """
        weeks = sorted({date.fromisoformat(str(w)) for w in weeks})
        if not self.runs().where(F.col("run_id") == run_id).isEmpty():
            return False
        old = self.read().where(F.col(self.week).isin(weeks)) if weeks else self.read().limit(0)
        staged = f"{self.path}/staged/{run_id}"
        columns = old.columns
        change(old).select(*columns).write.mode("overwrite").parquet(staged)
        made = self.spark.read.parquet(staged)
        counts = {r[self.week]: r["n"] for r in made.groupBy(self.week).agg(F.count("*").alias("n")).collect()}  # a row for each week
        if set(counts) - set(weeks):
            raise ValueError(f"rows of other weeks: {sorted(set(counts) - set(weeks))}")
        dealt = made.hint("rebalance", self.week)  # few files for each week, and several tasks for a large one
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.week).parquet(f"{self.path}/data")
        for week in set(weeks) - set(counts):
            files, target = self._files(f"{self.path}/data/{self.week}={week}")
            files.delete(target, True)
        done = self.spark.createDataFrame([(run_id, weeks, sum(counts.values()))], "run_id string, weeks array<date>, rows long")
        done.coalesce(1).write.mode("append").parquet(f"{self.path}/runs")
        files, target = self._files(staged)
        files.delete(target, True)
        return True

    def apply_rows(self, run_id: str, rows: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame]) -> bool:
        """apply() over the weeks that rows have, with change(old rows of these weeks, rows)."""
        weeks = [r[0] for r in rows.select(self.week).distinct().collect()]  # weeks, not rows
        return self.apply(run_id, weeks, lambda old: change(old, rows))


def put_pull(table: WeeklyTable, run_id: str, pull: DataFrame, week, source: str, retailers: list[str], partial: bool = False) -> bool:
    """A retailer's pull of the week put into stored specials (product_id, retailer, week_start, ..., source; pull has pos too).

    Its rows go in, the last of a key by position counting. Unless the pull is
    partial, rows of the week, source and retailers that it does not have go, and so do
    the retailers' rows of the week from other sources. An empty pull changes nothing.
    """
    rows = pull.where(F.col("week_start") == F.lit(week).cast("date"))
    if rows.isEmpty():
        return False

    def change(old: DataFrame) -> DataFrame:
        new = merge.upsert_specials(old, rows, ["product_id", "retailer", "week_start"])
        if partial:
            return new
        for retailer in retailers:
            new = merge.sweep_sources(new, str(week), retailer, source)
        return merge.sync_week(new, rows, str(week), source, retailers)

    return table.apply(run_id, [week], change)


def replace_week(table: WeeklyTable, run_id: str, rows: DataFrame, week) -> bool:
    """The whole week replaced by rows."""
    return table.apply(run_id, [week], lambda old: merge.replace_scope(old, rows.where(F.col(table.week) == F.lit(week).cast("date")), F.lit(True)))
