"""Cycles that are advanced, and counts that come with the rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pricewave.operators import counters, cycle_state
from pricewave.operators.cycle_state import CycleTable

KIND = "name string, week_start date, hint_weeks int"


def as_rows(df):
    return sorted((r["name"], r["last"], r.n, r.s, r.q, r.last_sale) for r in df.collect())


def test_advancing_equals_folding(spark, tmp_path):
    """Weeks of sales, some late and some with hints, put in one after another: after each the state is that of all sales so far."""
    rng = random.Random(3)
    day = lambda k: dt.date(2001, 1, 3) + dt.timedelta(days=k)
    sales, kept = [], CycleTable(spark, f"{tmp_path}/cycles", "name")
    for run in range(5):
        new = [(f"i{rng.randint(0, 12)}", day(60 * run + rng.randint(0, 60)), rng.choice([None, None, 0, 3])) for _ in range(25)]
        new += [(f"i{rng.randint(0, 12)}", day(rng.randint(0, 60 * run)), None) for _ in range(3)] if run % 2 else []
        sales += new
        every = spark.createDataFrame(sales, KIND)
        assert kept.advance(f"r{run}", spark.createDataFrame(new, KIND), lambda: every)
        assert as_rows(kept.read()) == as_rows(cycle_state.from_scratch(every, "name"))
    assert not kept.advance("r4", spark.createDataFrame(new, KIND), lambda: every) and len(kept.versions()) == 5


def test_history_is_read_for_late_dates_only(spark):
    state = cycle_state.from_scratch(spark.createDataFrame([("a", dt.date(2001, 1, 3), 0), ("a", dt.date(2001, 2, 7), 0), ("a", dt.date(2001, 2, 10), 0), (None, dt.date(2001, 2, 7), 0)], KIND), "name")

    def never():
        raise AssertionError("history was read")

    new = spark.createDataFrame([("a", dt.date(2001, 2, 8), 0), ("a", dt.date(2001, 3, 7), None), ("b", dt.date(2000, 1, 1), None), (None, dt.date(2001, 3, 7), None)], KIND)
    got = {r["name"]: (str(r["last"]), r.n, r.s) for r in cycle_state.advance(state, new, never, "name").collect()}
    assert got == {"a": ("2001-03-07", 2, 9), "b": ("2000-01-01", 0, 0), None: ("2001-03-07", 1, 4)}
    with pytest.raises(AssertionError, match="history"):
        cycle_state.advance(state, spark.createDataFrame([("a", dt.date(2001, 1, 20), 0)], KIND), never, "name")


def jobs_of(spark, name, action):
    spark.sparkContext.setJobGroup(name, name)
    out = action()
    spark.sparkContext.setJobGroup("others", "others")
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_rows_and_counts_in_one_job(spark):
    rows = spark.createDataFrame([("A", "1", 5), ("A", "2", 6), ("B", "1", 7)], "retailer string, sku string, cents int").coalesce(1)
    products = spark.createDataFrame([("A", "1", 10), ("B", "2", 11)], "retailer string, sku string, product_id int").coalesce(1)
    plain, alone = jobs_of(spark, "plain", lambda: rows.join(products, ["retailer", "sku"], "left").collect())
    found, seen = counters.with_product_ids(rows, products)
    got, jobs = jobs_of(spark, "counted", found.collect)
    assert [(r.product_id, r.cents) for r in got] == [(10, 5)] and seen.get == {"rows": 3, "misses": 2}
    assert jobs == alone


def test_parse_counters(spark):
    items = spark.range(10).select((F.col("id") % 2 == 0).alias("is_half"), F.when(F.col("id") < 3, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")).alias("events"), (F.col("id") == 9).alias("marketplace"))
    found, seen = counters.parsed(items)
    assert found.count() == 9 and seen.get == {"rows": 10, "half_now": 5, "half_ever": 3, "marketplace": 1}


def test_dump_is_written_and_counted_at_once(spark, tmp_path):
    dump = spark.range(0, 30, 1, 3)
    n, jobs = jobs_of(spark, "dump", lambda: counters.store_dump(dump, f"{tmp_path}/dump", 10))
    assert (n, jobs) == (30, 1) and spark.read.parquet(f"{tmp_path}/dump").count() == 30
    with pytest.raises(ValueError, match="5 items"):
        counters.store_dump(spark.range(5), f"{tmp_path}/dump", 10)
    assert spark.read.parquet(f"{tmp_path}/dump").count() == 30
