"""Helpers that the text operators share."""

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: ASCII white space, the class [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only key and text, so extra columns never clash with working names; null text is empty."""
    return docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def words(text) -> list[bytes]:
    """The maximal runs outside ASCII white space, as UTF-8; bytes.split() cuts at exactly that class."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def row_key(text: str = "text"):
    """With the doc_id it tells rows apart that repeat a doc_id with other texts."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row), ids being whole numbers or null."""
    return texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", row_key().alias("row"))


def rows_in(docs: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of docs whose (doc_id, row) is among keys, null ids being equal; with left_anti the others."""
    keys = keys.select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"))
    return docs.join(keys, docs["doc_id"].eqNullSafe(keys["_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == keys["_row"]), how)


def once(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """docs with one row only for each (doc_id, row) of repeated; repeated is a written table."""
    if repeated.isEmpty():
        return docs
    return rows_in(docs, repeated, "left_anti").union(rows_in(docs, repeated).dropDuplicates(["doc_id", "text"]))


def shared_folder(spark) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where it is unset and all runs on one machine, as in tests."""
    found = spark.sparkContext._jsc.sc().getCheckpointDir()
    if found.isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint"))
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
    return found.get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared folder and cut its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Write df as Parquet in the shared folder and read it again; compressed, unlike a checkpoint, and read by column."""
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def arrow_rows(make, schema: pa.Schema):
    """mapInArrow function from make(batch) -> columns (a list in the schema's order)."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                columns = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(make(batch), schema)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected edges (u, v), both long and not null.

    Returns (node, root), root being the least node of the component; nodes
    without an edge to another node are absent. Alternates the large-star and
    small-star steps until each node with an edge to a lesser one has no other
    edge, which neither step would change: every round is two
    grouped minima and two joins, and a node with many neighbours is never
    gathered in one row. Each round is checkpointed, and the minima are written
    before their joins, so that Spark can split the edges of a star's centre;
    so is the first join, which both the second minima and the second join read.
    """
    pair = lambda a, b: F.struct(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    flat = lambda df: df.where("u <> v").select(pair(F.col("u"), F.col("v")).alias("e")).select("e.u", "e.v").distinct()
    now = cut(flat(edges))
    while not _is_stars(now):
        both = now.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.u", "e.v")
        low = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = cut(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut(flat(small.union(least.select("u", F.col("m").alias("v")))))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _is_stars(edges: DataFrame) -> bool:
    """Whether each u of the edges (u, v) is in one edge only."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))).alias("e"))
    return ends.select("e.*").groupBy("node").agg(F.max("up").alias("up"), F.count("*").alias("n")).where("up = 1 AND n > 1").isEmpty()
