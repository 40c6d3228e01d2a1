"""Exact duplicates by content-defined chunk recipes."""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from pricewave.llm.common import BLANKS, cut, once, row_key, rows_in, texts

#: The rolling hash sees this many bytes; a cut falls where its low bits are zero.
WINDOW = 16
MEAN_CHUNK = 2048
MAX_CHUNK = 16384
_GEAR = np.random.default_rng(7).integers(0, 1 << 32, 256, dtype=np.uint32)
_BLANK = tuple(BLANKS.encode())


def normalise(raw: bytes) -> bytes:
    """Each run of ASCII white space becomes one space; it is not stripped at the ends."""
    words = raw.split()
    if not words:
        return b" " if raw else b""
    return b" " * (raw[0] in _BLANK) + b" ".join(words) + b" " * (raw[-1] in _BLANK)


def cuts(data: bytes) -> list[int]:
    """Chunk ends: a function of the bytes just before a cut, and of the last cut for the length limit."""
    if len(data) <= MEAN_CHUNK:
        return [len(data)] if data else []
    h = _GEAR[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 8):  # sums of 2, 4, 8, 16 shifted terms
        h[step:] += h[:-step] << np.uint32(step)
    ends = (np.flatnonzero((h >> np.uint32(16)) % np.uint32(MEAN_CHUNK) == 0) + 1).tolist()
    out, last = [], 0
    for end in [*ends, len(data)]:
        while end - last > MAX_CHUNK:
            last += MAX_CHUNK
            out.append(last)
        if end > last:
            out.append(end)
            last = end
    return out


_PARTS = {"keys": pa.list_(pa.binary()), "bodies": pa.list_(pa.struct([("key", pa.binary()), ("bytes", pa.binary())]))}


def _recipes(part: str, exact: bool = False):
    """Per row: doc_id, row key, SHA-256 of the normalised text, and its chunks in order, as identifiers or with their bytes."""

    def ids(chunks):
        if part == "bodies":
            return [{"key": xxhash.xxh3_128_digest(c), "bytes": c} for c in chunks]
        return [xxhash.xxh3_128_digest(c) + (hashlib.sha256(c).digest() if exact else b"") for c in chunks]

    def run(batches):
        for batch in batches:
            held, size = [], 0
            for doc, row, text in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), batch.column("text")):
                data = normalise(text.as_buffer().to_pybytes())
                at = cuts(data)
                held.append((doc, row, hashlib.sha256(data).hexdigest(), ids([data[a:b] for a, b in zip([0, *at], at)])))
                size += len(data)
                if size > 4 << 20:
                    yield out(batch, held)
                    held, size = [], 0
            if held:
                yield out(batch, held)

    def out(batch, held):
        doc, row, sha, chunks = zip(*held)
        return pa.RecordBatch.from_arrays([pa.array(doc, batch.schema.field("doc_id").type), pa.array(row, pa.int64()), pa.array(sha), pa.array(chunks, _PARTS[part])], names=["doc_id", "row", "sha", "chunks"])

    return run


def groups(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of ASCII white space is
    replaced by one space; null counts as empty. keep_id is the smallest doc_id
    of the equal texts and group_size their number. Rows that repeat both a
    doc_id and a text are all kept if it is the smallest; null doc_ids come
    last. An empty table gives no rows.

    Long texts move once at most, as chunks: chunks are told apart by a 128-bit
    fingerprint, and of each fingerprint the distinct bytes, which map-side
    combination reduces to one row per task, are compared; if any two differ, the
    identifiers also take the bytes' SHA-256. Documents are then compared by
    their ordered lists of identifiers.
    """
    return _grouped(docs).drop("row")


def _grouped(docs: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = texts(docs).withColumn("row", row_key())
    bodies = rows.mapInArrow(_recipes("bodies"), f"doc_id {kind}, row long, sha string, chunks array<struct<key: binary, bytes: binary>>")
    distinct = bodies.select(F.explode("chunks").alias("c")).select("c.key", "c.bytes").distinct()
    clash = not distinct.groupBy("key").count().where("count > 1").isEmpty()
    lists = rows.mapInArrow(_recipes("keys", exact=clash), f"doc_id {kind}, row long, sha string, chunks array<binary>")
    lists = lists.select("doc_id", "row", "sha", F.sha2(F.array_join(F.transform("chunks", F.hex), ","), 256).alias("recipe"), F.size("chunks").alias("n"))
    lists = cut(lists)
    firsts = cut(lists.groupBy("recipe", "n").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")))  # the join can then split a hot recipe
    return lists.join(firsts, ["recipe", "n"]).select(
        "doc_id", "row", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256")
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay when of equal texts one row with the smallest doc_id is kept; columns unchanged.

    Decisions hold for rows, not for ids: a row that repeats a doc_id with
    another text stays, a row without an id goes if any other row has its text,
    and of rows that repeat a doc_id and an equal text one stays.
    """
    found = _grouped(docs)
    stay = found.where("kept")
    again = cut(stay.groupBy("doc_id", "text_sha256").agg(F.min("row").alias("least"), F.count("*").alias("k")).where("k > 1"))
    lost = found.where(~F.col("kept")).select("doc_id", "row")
    if again.isEmpty():
        return rows_in(docs, lost, "left_anti")
    same = stay["doc_id"].eqNullSafe(again["doc_id"]) & (stay["text_sha256"] == again["text_sha256"])
    lost = lost.union(stay.join(again, same).where(F.col("row") != F.col("least")).select(stay["doc_id"], "row"))
    return once(rows_in(docs, lost, "left_anti"), again.select("doc_id", F.col("least").alias("row")))
