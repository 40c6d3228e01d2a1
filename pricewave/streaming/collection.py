"""Collection of result pages that can stop anywhere and go on later.

A fetcher drops each page that it gets as a JSON file into a folder. A streaming
query reads what is there, some files at a time; its checkpoint is the progress
file. Each batch writes the products that it adds under its own number, so a
batch that is run again after a crash replaces what it had written.
"""

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pricewave.operators import guards
from pricewave.sources import variants

PAGE = "page int, total long, results array<string>"


class Stopped(Exception):
    """A run has read as many batches as it may."""


class Collection:
    """Products by id, first seen first, of the pages in landing; products and counts are kept in folder."""

    def __init__(self, spark: SparkSession, landing: str, folder: str, pages_at_once: int = 1) -> None:
        self.spark, self.landing, self.folder, self.pages_at_once = spark, landing, folder, pages_at_once

    def _stored(self, name: str, schema: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def products(self) -> DataFrame:
        """(id, page, pos, body, batch): body is the product's JSON."""
        return self._stored("products", "id string, page int, pos int, body string, batch int")

    def pages(self) -> DataFrame:
        """(page, total, found, added, batch): what each page had, and how many of its products were new."""
        return self._stored("pages", "page int, total long, found long, added long, batch int")

    def _put(self, rows: DataFrame, name: str, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder}/{name}/batch={batch}")

    def _add(self, read: DataFrame, batch: int) -> None:
        body = F.col("body")
        parsed = variants.parsed(body)
        each = read.select("page", F.posexplode("results").alias("pos", "body")).select(
            "page", "pos", "body", variants.text(variants.member(parsed, "id")).alias("id"), variants.text(variants.member(parsed, "_type")).alias("kind")
        )
        goods = each.where("kind = 'PRODUCT' AND id IS NOT NULL").drop("kind")
        known = self.products().where(F.col("batch") < batch).select("id")
        first = F.row_number().over(Window.partitionBy("id").orderBy("page", "pos"))
        new = goods.join(known, "id", "left_anti").withColumn("_first", first).where("_first = 1").select("id", "page", "pos", "body")
        self._put(new, "products", batch)
        added = self.spark.read.parquet(f"{self.folder}/products/batch={batch}").groupBy("page").agg(F.count("*").alias("added"))
        counts = read.groupBy("page").agg(F.max("total").alias("total"), F.sum(F.coalesce(F.size("results"), F.lit(0))).cast("long").alias("found"))
        self._put(counts.join(added, "page", "left").select("page", "total", "found", F.coalesce("added", F.lit(0)).cast("long").alias("added")), "pages", batch)

    def run(self, most_batches: int | None = None) -> bool:
        """Read all pages that are there and were not read; with most_batches no more than so many batches. False if some are left."""
        done = 0

        def batch(read: DataFrame, number: int) -> None:
            nonlocal done
            if most_batches is not None and done >= most_batches:
                raise Stopped()
            self._add(read, number)
            done += 1

        pages = self.spark.readStream.schema(PAGE).option("maxFilesPerTrigger", self.pages_at_once).option("multiLine", True).json(self.landing)
        query = pages.writeStream.foreachBatch(batch).option("checkpointLocation", f"{self.folder}/progress").trigger(availableNow=True).start()
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if most_batches is not None and done >= most_batches:
                return False
            raise
        return True

    def status(self) -> DataFrame:
        """(pages, last_page, total, collected, complete): complete if nearly all of the first page's total have been collected."""
        pages = self.pages().agg(F.count("*").alias("pages"), F.max("page").alias("last_page"), F.min_by("total", "page").alias("total"))
        both = pages.crossJoin(self.products().agg(F.count("*").alias("collected")))  # one row each
        return both.withColumn("complete", F.coalesce(guards.trickle_complete(F.col("collected"), F.col("total")), F.lit(False)))
