"""Streaming forms: weekly counts with a Wednesday origin, and half-price drops as prices arrive."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

_DAY_MS = 86_400_000


def weekly(stream: DataFrame, time: str = "ts", late: str = "1 day") -> DataFrame:
    """Counts per Wednesday-to-Tuesday week; 1970-01-01 was a Thursday, so weeks start six days after it."""
    week = F.window(time, "7 days", "7 days", "6 days")
    return stream.withWatermark(time, late).groupBy(week).agg(F.count("*").alias("n")).select(F.to_date("window.start").alias("week_start"), "n")


def once_per_key(stream: DataFrame, keys: list[str], time: str = "ts", within: str = "7 days") -> DataFrame:
    """Each key at most once within the watermark, as for alerts."""
    return stream.withWatermark(time, within).dropDuplicatesWithinWatermark(keys)


class _Drops(StatefulProcessor):
    """State of an item: prices of days that the watermark has not passed, and the last price of a day that it has."""

    def __init__(self, min_off: float, keep_days: int | None) -> None:
        self.min_off, self.keep = min_off, keep_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "day int", "cents long")
        self.last = handle.getValueState("last", "day int, cents long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        judged = self.last.get()[0] if self.last.exists() else None
        for batch in rows:
            for day, cents in zip(batch.day, batch.cents):
                if judged is not None and day <= judged:
                    continue  # Spark lets rows through that are late by one batch
                at = (int(day),)
                known = self.waiting.getValue(at)[0] if self.waiting.containsKey(at) else None
                if known is None:
                    self.handle.registerTimer(int(day) * _DAY_MS)
                self.waiting.updateValue(at, (max(int(cents), known or 0),))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        due = sorted((k[0], v[0]) for k, v in self.waiting.iterator() if k[0] * _DAY_MS <= passed)
        before, out = (self.last.get() if self.last.exists() else None), []
        for day, now in due:
            was = before[1] if before else None
            if was and now > 0 and 1 - now / was >= self.min_off:
                out.append((key[0], day, now, was))
            before = (day, now)
            self.waiting.removeKey((day,))
        if due:
            self.last.update(before)
            if self.keep is not None:
                self.handle.registerTimer((before[0] + self.keep) * _DAY_MS)
        elif before and self.keep is not None and (before[0] + self.keep) * _DAY_MS <= passed:
            self.last.clear()
        if out:
            yield pd.DataFrame(out, columns=["item", "day", "sale_cents", "regular_cents"])

    def close(self) -> None:
        pass


def half_price_drops(stream: DataFrame, late: str = "30 days", min_off: float = 0.48, keep_days: int | None = None) -> DataFrame:
    """(item, on_date, sale_cents, regular_cents) when a price is at least min_off below that of the day before it in the item's history.

    Input columns: item string, on_date date, cents long. A day is judged once the
    watermark, late behind the newest day, has passed it; until then it waits in
    the item's state, so the drops are those of the whole history in order of its
    days, whatever order its rows come in. Rows behind the watermark, or
    behind a day of the item that has been judged, are dropped;
    of several prices of one day the highest counts. With keep_days, an item of
    which nothing was heard for so long is forgotten. The session needs a state store that has several states for each key: RocksDB.
    """
    days = stream.select("item", F.col("on_date").cast("timestamp").alias("ts"), F.unix_date("on_date").alias("day"), "cents").withWatermark("ts", late)
    found = days.groupBy("item").transformWithStateInPandas(
        _Drops(min_off, keep_days), "item string, day int, sale_cents long, regular_cents long", "Append", "EventTime"
    )
    return found.select("item", F.date_from_unix_date("day").alias("on_date"), "sale_cents", "regular_cents")


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
