"""Purges of products by condition, with the rows of the tables that refer to them.

A purge is a dry run unless confirmed: it then says how many rows of each table
would go. References are followed from table to table, in the order of their keys.
"""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from pricewave.operators.pricing import DENIED_CODES, MARKETPLACE_ID_LENGTH

# The prefix of made-up stock numbers, and the sources of the posted lists.
SYNTHETIC_PREFIX = "stockup:"
STOCKUP_SOURCES = ("stockup_post", "stockup_sheet")

#: Columns of each table that refer to another: table, column, table referred to, its key.
REFERENCES = (
    ("specials", "product_id", "products", "product_id"),
    ("observations", "product_id", "products", "product_id"),
    ("predictions", "product_id", "products", "product_id"),
    ("accuracy", "product_id", "products", "product_id"),
    ("aliases", "canonical", "products", "product_id"),
    ("aliases", "variant", "products", "product_id"),
)


def synthetic(products: DataFrame) -> DataFrame:
    """(product_id) of products whose stock number was made of their name."""
    return products.where(F.startswith("sku", F.lit(SYNTHETIC_PREFIX))).select("product_id")


def denied_labels(labels: DataFrame, denied: list[str] = DENIED_CODES) -> DataFrame:
    """(label) of the codes that are denied and of no other; labels is (code, label)."""
    mine = labels.where(F.col("code").isin(denied)).select("label")
    return mine.subtract(labels.where(~F.col("code").isin(denied)).select("label"))


def marketplace(products: DataFrame, labels: DataFrame, retailer: str = "woolworths", denied: list[str] = DENIED_CODES) -> DataFrame:
    """(product_id) of the retailer's products with a long stock number, and of any retailer's products under a label that only denied codes have."""
    gone = denied_labels(labels, denied).select(F.col("label").alias("category"), F.lit(True).alias("_denied"))
    long = (F.col("retailer") == retailer) & (F.length(F.split_part("sku", F.lit(":"), F.lit(2))) >= MARKETPLACE_ID_LENGTH)
    marked = products.join(gone, "category", "left")
    return marked.where(F.coalesce(long, F.lit(False)) | F.col("_denied").isNotNull()).select("product_id")


def cascade(tables: dict[str, DataFrame], root: str, gone: DataFrame, confirm: bool = False, references=REFERENCES) -> dict[str, DataFrame]:
    """What a deletion of the root table's rows by the keys in gone does to each table: the rows that stay if confirmed, else one row (rows) that counts those that go.

    A table's rows go if any of its references names a key that goes; references
    must not form a circle. gone has the root's key as its only column.
    """
    key = gone.columns[0]
    going = {root: tables[root].join(gone.distinct(), key, "left_semi")}
    staying = {root: tables[root].join(gone.distinct(), key, "left_anti").select(*tables[root].columns)}
    waiting = [name for name in tables if name != root]
    while waiting:
        ready = [n for n in waiting if all(r[2] not in waiting for r in references if r[0] == n and r[2] in tables)]
        if not ready:
            raise ValueError(f"references form a circle: {waiting}")
        for name in ready:
            waiting.remove(name)
            marked, marks = tables[name], []
            for k, (_, column, parent, parent_key) in enumerate(r for r in references if r[0] == name and r[2] in going):
                keys = going[parent].select(F.col(parent_key).alias(f"_key{k}")).distinct()
                marked = marked.join(keys, F.col(column) == F.col(f"_key{k}"), "left")
                marks.append(F.col(f"_key{k}").isNotNull())
            hit = reduce(lambda a, b: a | b, marks, F.lit(False))
            going[name] = marked.where(hit).select(*tables[name].columns)
            staying[name] = marked.where(~hit).select(*tables[name].columns)
    if confirm:
        return staying
    return {name: rows.agg(F.count("*").alias("rows")) for name, rows in going.items()}


def drop_sources(tables: dict[str, DataFrame], products: DataFrame, retailer: str | None = None, sources=STOCKUP_SOURCES, confirm: bool = False) -> dict[str, DataFrame]:
    """Each table (product_id, source, ...) without the rows of these sources whose product is known, of one retailer if it is named; unless confirmed, how many would go."""
    mine = products if retailer is None else products.where(F.col("retailer") == retailer)
    mine = mine.select("product_id").distinct().withColumn("_mine", F.lit(True))
    out = {}
    for name, rows in tables.items():
        gone = F.col("_mine").isNotNull() & F.coalesce(F.col("source").isin(list(sources)), F.lit(False))
        marked = rows.join(mine, "product_id", "left")
        out[name] = marked.where(~gone).select(*rows.columns) if confirm else marked.agg(F.count_if(gone).alias("rows"))
    return out
