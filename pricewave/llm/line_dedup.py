"""Removal of lines that several documents share."""

from pyspark.sql import DataFrame, functions as F

from pricewave.llm.common import BLANKS, LOWER, UPPER, cut, texts


def drop_lines(docs: DataFrame, min_docs: int = 2, min_chars: int = 10) -> DataFrame:
    """One row per row of docs: doc_id, kept (text), n_lines, n_dropped.

    Lines are cut at \\n; a null or empty text is one empty line. A line's key is
    the line without ASCII white space at its ends, A-Z lower-cased. Keys of at
    least min_chars code points that occur in at least min_docs documents lose
    their lines everywhere but in the smallest doc_id holding them, where all of
    them stay. The rest is joined by \\n in order. Rows that repeat a doc_id count
    as one document. Lines of a null doc_id are never the ones to stay unless no
    other document has them. Empty tables give no rows.

    Only 16-byte line hashes are shuffled for counting, after map-side
    combination, so a line in a third of all documents costs a row per map task.
    """
    rows = texts(docs).withColumn("lines", F.split("text", "\n", -1)).withColumn("tag", F.xxhash64("text"))
    key = F.translate(F.btrim(F.col("line"), F.lit(BLANKS)), UPPER, LOWER)
    held = (
        rows.select("doc_id", "tag", F.posexplode("lines").alias("pos", "line"))
        .select("doc_id", "tag", "pos", key.alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("doc_id", "tag", "pos", F.xxhash64("key").alias("h"), F.xxhash64(F.lit(1), "key").alias("g"))
    )
    by_doc = F.count_distinct("doc_id") if min_docs > 2 else F.when(F.min("doc_id") < F.max("doc_id"), 2).otherwise(1)
    nulls = F.max(F.when(F.col("doc_id").isNull(), 1).otherwise(0))
    shared = cut(  # so that the join below has an exchange of its own on both sides, which Spark splits where a line is hot
        held.groupBy("h", "g")
        .agg(F.min("doc_id").alias("first_id"), by_doc.alias("n"), nulls.alias("nulls"))
        .where((F.col("n") + F.when(F.col("first_id").isNull(), 0).otherwise(F.col("nulls"))) >= min_docs)
        .select("h", "g", "first_id")
    )
    drops = (
        held.join(shared, ["h", "g"])
        .where(~F.col("doc_id").eqNullSafe(F.col("first_id")))
        .groupBy("doc_id", "tag")
        .agg(F.collect_set("pos").alias("drops"))
        .select(F.col("doc_id").alias("id"), F.col("tag").alias("t"), "drops")
    )
    joined = rows.drop("lines").join(drops, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("tag") == F.col("t")), "left")
    lines = F.split("text", "\n", -1)
    kept = F.when(F.col("drops").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "drops"), lambda i: F.get(lines, i)), "\n")
    )
    return joined.select(
        "doc_id",
        kept.alias("kept"),
        F.size(lines).cast("long").alias("n_lines"),
        F.when(F.col("drops").isNull(), 0).otherwise(F.size("drops")).cast("long").alias("n_dropped"),
    )
