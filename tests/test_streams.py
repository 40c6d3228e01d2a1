"""Streams: drops by event time whatever the order of arrival, and a collection that stops and goes on."""

import datetime as dt
import itertools
import json
import os

import pytest
from pyspark.sql import functions as F

from pricewave.operators import pricing
from pricewave.streaming import changes, collection

KIND = "item string, on_date date, cents long"


def day(text):
    return dt.date.fromisoformat(text)


def drops(spark, tmp_path, name, batches, **options):
    """The drops of a stream that gets these batches one after another."""
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, KIND).coalesce(1).write.parquet(f"{tmp_path}/{name}/in/{n:03}")
    stream = spark.readStream.schema(KIND).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/{name}/in")
    found = changes.half_price_drops(stream, **options)
    run = found.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{tmp_path}/{name}/state").trigger(availableNow=True).start()
    assert run.awaitTermination(300)
    return sorted((r["item"], str(r.on_date), r.sale_cents, r.regular_cents) for r in spark.table(name).collect())


@pytest.fixture(scope="module")
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    changes.use_rocksdb(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield spark
    spark.conf.set(key, before)
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_any_arrival_order_gives_the_batch_events(rocks, tmp_path):
    """Ten items have the orders of arrival of five prices, each row in a batch of its own; the events are those of the histories."""
    prices = [("2026-01-01", 1000), ("2026-01-08", 400), ("2026-01-15", 900), ("2026-01-22", 450), ("2026-01-29", 440)]
    orders = list(itertools.permutations(range(5)))[:: 12]
    items = {f"i{k}": order for k, order in enumerate(orders)}
    batches = [[(i, day(prices[order[n]][0]), prices[order[n]][1]) for i, order in items.items()] for n in range(5)]
    batches += [[("end", day("2026-06-01"), 1)], [("end", day("2026-06-02"), 1)]]
    got = drops(rocks, tmp_path, "orders", batches, late="60 days")
    history = rocks.createDataFrame([r for b in batches for r in b], KIND)
    found = pricing.history(history, "item").select("item", F.explode(pricing.events()).alias("e")).select("item", "e.*")
    assert got == sorted((r["item"], str(r.on_date), r.sale_cents, r.regular_cents) for r in found.collect())
    assert len(got) == 2 * len(items)


def test_late_days_and_forgotten_items(rocks, tmp_path):
    """The late 400 of the 8th lies between its neighbours; rows behind the watermark do not count; a price that is too old is no price before."""
    batches = [
        [("a", day("2026-01-01"), 1000), ("old", day("2026-01-01"), 1000)],
        [("a", day("2026-01-15"), 900)],
        [("a", day("2026-01-08"), 400)],
        [("a", day("2026-04-01"), 800), ("x", day("2026-04-01"), 1)],
        [("x", day("2026-04-02"), 1)],
        [("x", day("2026-04-03"), 1)],
        [("a", day("2026-01-10"), 1), ("old", day("2026-04-03"), 100), ("x", day("2026-06-01"), 1)],
        [("x", day("2026-07-01"), 1)],
    ]
    assert drops(rocks, tmp_path, "late", batches, late="20 days", keep_days=30) == [("a", "2026-01-08", 400, 1000)]


def page(folder, number, ids, total=47):
    folder.mkdir(exist_ok=True)
    rows = [json.dumps({"_type": "PRODUCT", "id": i, "name": f"n{i}", "page": number}) for i in ids] + [json.dumps({"_type": "AD", "id": 99}), "no json"]
    file = folder / f"page{number:03}.json"
    file.write_text(json.dumps({"page": number, "total": total, "results": rows}))
    os.utime(file, (1_000_000 + number, 1_000_000 + number))  # files are read in order of their time


def collected(c):
    return sorted((int(r.id), r.page) for r in c.products().collect())


def test_collection_stops_and_goes_on(spark, tmp_path):
    c = collection.Collection(spark, str(tmp_path / "landing"), str(tmp_path / "kept"))
    for n, ids in enumerate([[1, 2], [2, 3], [3, 4, 5]], 1):
        page(tmp_path / "landing", n, ids)
    assert not c.run(most_batches=1)
    assert collected(c) == [(1, 1), (2, 1)] and not c.status().first().complete
    assert c.run()
    wanted = [(1, 1), (2, 1), (3, 2), (4, 3), (5, 3)]
    assert collected(c) == wanted
    assert c.run() and collected(c) == wanted
    page(tmp_path / "landing", 4, [6, 7])
    assert c.run()
    status = c.status().first()
    assert (status.pages, status.last_page, status.total, status.collected, status.complete) == (4, 4, 47, 7, True)
    assert [r.added for r in c.pages().orderBy("page").collect()] == [2, 1, 2, 2]


def test_a_batch_that_fails_halfway_is_run_again(spark, tmp_path, monkeypatch):
    c = collection.Collection(spark, str(tmp_path / "landing"), str(tmp_path / "kept"))
    for n, ids in enumerate([[1], [2, 1], [3]], 1):
        page(tmp_path / "landing", n, ids, total=100)
    put = collection.Collection._put

    def broken(self, rows, name, batch):
        if name == "pages" and batch == 1:
            raise OSError("lost")
        put(self, rows, name, batch)

    monkeypatch.setattr(collection.Collection, "_put", broken)
    with pytest.raises(Exception, match="lost"):
        c.run()
    assert collected(c) == [(1, 1), (2, 2)] and c.pages().count() == 1
    monkeypatch.undo()
    assert c.run()
    assert collected(c) == [(1, 1), (2, 2), (3, 3)] and c.pages().count() == 3
    assert not c.status().first().complete
