"""Tables on disk, purges and repeated rows."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from pricewave.operators import backfill, digests, merge, purges
from pricewave.sinks.weekly import WeeklyTable, put_pull, replace_week

SCHEMA = "product_id long, retailer string, sale_cents long, source string, week_start date"
ROWS = [(1, "A", 100, "dump", "2001-06-06"), (1, "A", 100, "dump", "2001-06-13"), (2, "A", 200, "live", "2001-06-13"), (3, "B", 300, "dump", "2001-06-13"), (4, "B", 400, "dump", "2001-06-20")]


def specials(spark, rows, extra=""):
    names = ["product_id", "retailer", "sale_cents", "source", "week_start"] + (["pos"] if extra else [])
    return spark.createDataFrame(rows, names).withColumns({"product_id": F.col("product_id").cast("long"), "sale_cents": F.col("sale_cents").cast("long"), "week_start": F.col("week_start").cast("date")})


@pytest.fixture
def stored(spark, tmp_path):
    t = WeeklyTable(spark, f"{tmp_path}/specials", SCHEMA)
    assert t.apply_rows("base", specials(spark, ROWS), lambda old, new: old.unionByName(new))
    return t


def held(t):
    return sorted((r.product_id, r.retailer, r.sale_cents, r.source, str(r.week_start)) for r in t.read().collect())


def files(t):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{t.path}/data/**/*.parquet", recursive=True)}


def pull(spark, *rows):
    return specials(spark, list(rows), "pos")


def test_pull_rewrites_its_week_only(spark, stored):
    before = files(stored)
    new = pull(spark, (1, "A", 90, "dump", "2001-06-13", 1), (1, "A", 95, "dump", "2001-06-13", 2), (5, "A", 500, "dump", "2001-06-13", 3))
    assert put_pull(stored, "r1", new, "2001-06-13", "dump", ["A"])
    wanted = sorted([ROWS[0], (1, "A", 95, "dump", "2001-06-13"), (5, "A", 500, "dump", "2001-06-13"), ROWS[3], ROWS[4]])
    assert held(stored) == wanted
    after = files(stored)
    for week in ("2001-06-06", "2001-06-20"):
        assert {f: t for f, t in before.items() if week in f} == {f: t for f, t in after.items() if week in f} != {}
    assert not put_pull(stored, "r1", pull(spark, (9, "A", 1, "dump", "2001-06-13", 1)), "2001-06-13", "dump", ["A"])
    assert held(stored) == wanted and files(stored) == after
    assert sorted((r.run_id, len(r.weeks), r.rows) for r in stored.runs().collect()) == [("base", 3, 5), ("r1", 1, 3)]


def test_partial_and_empty_pulls_delete_nothing(spark, stored):
    assert put_pull(stored, "p", pull(spark, (1, "A", 90, "dump", "2001-06-13", 1)), "2001-06-13", "dump", ["A"], partial=True)
    assert held(stored) == sorted([ROWS[0], (1, "A", 90, "dump", "2001-06-13"), *ROWS[2:]])
    assert not put_pull(stored, "e", pull(spark, (1, "A", 90, "dump", "2001-06-27", 1)), "2001-06-13", "dump", ["A"])
    assert len(held(stored)) == 5


def test_a_run_that_fails_leaves_the_table(spark, stored):
    before, wanted = files(stored), held(stored)
    broken = F.when(F.col("product_id") == 3, F.raise_error(F.lit("stopped halfway"))).otherwise(F.col("sale_cents") + 1).cast("long")
    with pytest.raises(Exception, match="stopped halfway"):
        stored.apply("bad", ["2001-06-13", "2001-06-20"], lambda old: old.withColumn("sale_cents", broken))
    with pytest.raises(ValueError, match="other weeks"):
        stored.apply("bad", ["2001-06-13"], lambda old: old.withColumn("week_start", F.lit("2001-06-06").cast("date")))
    assert held(stored) == wanted and files(stored) == before
    assert stored.apply("bad", ["2001-06-13", "2001-06-20"], lambda old: old.withColumn("sale_cents", F.col("sale_cents") + 1))
    assert sum(r[2] for r in held(stored)) == sum(r[2] for r in ROWS) + 4


def test_replaced_and_emptied_weeks(spark, stored):
    assert replace_week(stored, "x", specials(spark, [(7, "A", 1, "live", "2001-06-13"), (8, "A", 1, "live", "2001-06-06")]), "2001-06-13")
    assert held(stored) == sorted([ROWS[0], (7, "A", 1, "live", "2001-06-13"), ROWS[4]])
    assert stored.apply("y", ["2001-06-20"], lambda old: old.limit(0))
    assert held(stored) == sorted([ROWS[0], (7, "A", 1, "live", "2001-06-13")])
    plan = stored.read().where("week_start = DATE '2001-06-06'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(week_start" in plan


def test_repeats_go_by_position(spark):
    rows = spark.createDataFrame([(1, 300, 1), (1, 200, 2), (1, 250, 0), (2, 5, None), (None, 7, 1), (None, 8, 2)], "k int, c int, pos int")
    assert sorted(((r.k or 0), r.c) for r in merge.last_wins(rows, ["k"], "pos").collect()) == [(0, 8), (1, 200), (2, 5)]
    assert sorted(((r.k or 0), r.c) for r in merge.first_wins(rows, ["k"], "pos").collect()) == [(0, 7), (1, 250), (2, 5)]
    old = spark.createDataFrame([(2, 1)], "k int, c int")
    assert sorted(((r.k or 0), r.c) for r in merge.insert_absent(old, rows, ["k"], "pos").where("k IS NOT NULL").collect()) == [(1, 250), (2, 1)]
    assert [r.c for r in merge.insert_absent(old, rows.drop("pos"), ["k"]).where("k = 1").collect()] == [200]


def test_corrections_leave_flagged_rows(spark):
    s = spark.createDataFrame([(1, "2001-06-27", 400, 180, 50, True, "live"), (2, "2001-06-27", 400, 300, 25, False, "live"), (1, "2001-06-20", 1, 1, 1, False, "x")], "product_id long, week_start string, regular_cents long, sale_cents long, discount_pct long, is_half_price boolean, source string")
    s = s.withColumns({"week_start": F.to_date("week_start"), "week_end": F.to_date("week_start")}).select("product_id", "week_start", "week_end", "regular_cents", "sale_cents", "discount_pct", "is_half_price", "source")
    truth = spark.createDataFrame([(1, True, 200, None), (2, True, 150, 300), (3, True, 50, 0), (4, False, 50, 100)], "id long, is_half boolean, sale_cents long, was_cents long")
    got = sorted((r.product_id, str(r.week_start), r.regular_cents, r.sale_cents, r.source) for r in digests.corrections(s, truth, "2001-06-27").collect())
    assert got == [(1, "2001-06-20", 1, 1, "x"), (1, "2001-06-27", 400, 180, "live"), (2, "2001-06-27", 400, 150, "catalogue"), (3, "2001-06-27", 100, 50, "catalogue")]


def test_cascade_follows_references(spark):
    make = spark.createDataFrame
    tables = {"a": make([(1,), (2,), (3,)], "id int"), "c": make([(10, 1), (11, 3)], "cid int, bid int"), "b": make([(1, 1), (2, 2), (3, None)], "bid int, aid int")}
    links = (("c", "bid", "b", "bid"), ("b", "aid", "a", "id"))
    counts = {n: d.first()["rows"] for n, d in purges.cascade(tables, "a", make([(1,), (1,)], "id int"), references=links).items()}
    assert counts == {"a": 1, "b": 1, "c": 1}
    left = purges.cascade(tables, "a", make([(1,)], "id int"), confirm=True, references=links)
    assert {n: sorted(tuple(r) for r in d.collect()) for n, d in left.items()} == {"a": [(2,), (3,)], "b": [(2, 2), (3, None)], "c": [(11, 3)]}
    with pytest.raises(ValueError):
        purges.cascade(tables, "a", make([(1,)], "id int"), references=(("b", "x", "c", "x"), ("c", "x", "b", "x")))


def test_denied_labels(spark):
    labels = spark.createDataFrame([("778", "Toys"), ("779", "Shared"), ("1", "Shared"), ("2", "Tea"), ("10104", "Toys")], "code string, label string")
    assert [r.label for r in purges.denied_labels(labels).collect()] == ["Toys"]


def test_backfill_counts_nothing_twice(spark):
    events = "array<struct<on_date: date, sale_cents: bigint, regular_cents: bigint, discount_pct: bigint>>"
    one = [("A", "7", "n", "Tea", 400, None, "[{\"on_date\": \"2001-06-01\", \"sale_cents\": 200, \"regular_cents\": 400, \"discount_pct\": 50}, {\"on_date\": \"2001-06-30\", \"sale_cents\": 100, \"regular_cents\": 400, \"discount_pct\": 75}]"), ("A", "8", "n", "Tea", 1, None, "[]")]
    parsed = spark.createDataFrame(one, "retailer string, item string, name string, category string, regular long, image_url string, e string").withColumn("events", F.from_json("e", events)).drop("e")
    products = spark.createDataFrame([], "product_id string, retailer string, sku string, name string, category string, regular_price_cents long, image_url string")
    s = spark.createDataFrame([], "product_id string, week_start date, week_end date, regular_cents long, sale_cents long, discount_pct long, is_half_price boolean, source string")
    o = spark.createDataFrame([], "product_id string, price_cents long, is_special boolean, discount_pct long, observed_at date, source string")
    first = backfill.backfill(parsed, products, s, o, "2001-06-27")
    assert [(r.product_id, str(r.week_start), str(r.week_end)) for r in first["specials"].collect()] == [("A:7", "2001-06-01", "2001-06-07")]
    again = backfill.backfill(parsed, first["products"], first["specials"], first["observations"], "2001-06-27")
    assert {r.name: r.n for r in again["counts"].collect()} == {"ever_half": 1, "event_rows": 1, "specials_inserted": 0, "observations_inserted": 0}
    assert again["specials"].count() == 1 and again["observations"].count() == 1
