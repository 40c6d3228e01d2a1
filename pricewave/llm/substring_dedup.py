"""Repeated passages by seed and extend.

Seeds are winnowed anchors: of the 16 five-word grams in every window of 20
words the one of least hash, so equal windows choose equal anchors. An anchor is
extended both ways as far as the windows that chose it reach; occurrences with
equal extensions form a class, whose first occurrence alone may be new. Only
firsts of anchors with several classes are compared window by window. Covered
windows are merged into maximal repeats.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from pricewave.llm.common import cut, partitions, row_key, texts

#: Odd multipliers of the polynomial word hashes, modulo 2**64.
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _B
    return h ^ (h >> np.uint64(29))


def _powers(n: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.full(max(n - 1, 0), _A)]).cumprod(dtype=np.uint64)[: max(n, 1)]


class Hashes:
    """Hashes of any word range of one document, from prefix sums: O(1) numpy work per range."""

    def __init__(self, ws: list[bytes]):
        h = _mix(np.fromiter(map(xxhash.xxh3_64_intdigest, ws), dtype=np.uint64, count=len(ws)))
        self.n = len(ws)
        self.sums = np.concatenate([[np.uint64(0)], (h * _powers(self.n)[: self.n]).cumsum(dtype=np.uint64)])
        inverse = np.uint64(pow(int(_A), -1, 1 << 64))
        self.back = np.concatenate([[np.uint64(1)], np.full(self.n, inverse)]).cumprod(dtype=np.uint64)

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64) * _B)


def anchors(ws: list[bytes], window: int, gram: int):
    """(anchor hash, context hash, anchor position, first and last window start) of a document's anchors."""
    n = len(ws) - window + 1
    if n <= 0:
        return None
    hs, slots = Hashes(ws), window - gram + 1
    at = np.arange(len(ws) - gram + 1)
    g = hs.ranges(at, at + gram)
    # Position of the leftmost least gram of each window, by doubling spans.
    best, where, span = g, at, 1
    while span * 2 <= slots:
        a, b = best[:-span], best[span:]
        take = b < a
        where = np.where(take, where[span:], where[:-span])
        best = np.where(take, b, a)
        span *= 2
    rest = slots - span
    if rest:
        a, b = best[: len(best) - rest], best[rest:]
        where = np.where(b < a, where[rest:], where[: len(best) - rest])
    chosen = where[:n]
    edge = np.flatnonzero(np.diff(chosen)) + 1
    lo, hi = np.concatenate([[0], edge]), np.concatenate([edge, [n]]) - 1
    q = chosen[lo]
    context = hs.ranges(lo, hi + window) ^ _mix(((q - lo) * 64 + (hi - q + 64)).astype(np.uint64) * _A)
    return g[q], context, q, lo, hi


_OCC = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("lo", pa.int32()), ("n", pa.int32()), ("a", pa.int64()), ("c", pa.int64())])
_OCC_SQL = "doc_id long, tag long, lo int, n int, a long, c long"


def _texts(batch):
    return (t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column("text"))


def _occurrences(window, gram):
    def run(batches):
        for batch in batches:
            held: list[tuple] = []
            for doc, tag, raw in zip(batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist(), _texts(batch)):
                found = doc is not None and anchors(raw.split(), window, gram)
                if found:
                    a, c, _, lo, hi = found
                    held.append((np.full(len(a), doc, np.int64), np.full(len(a), tag, np.int64), lo.astype(np.int32), (hi - lo + 1).astype(np.int32), a.view(np.int64), c.view(np.int64)))
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held)], schema=_OCC)

    return run


_BODY_SQL = "doc_id long, tag long, body binary"


def _packed(batches):
    """Texts leave as compressed bytes, so that moving them to their spans costs a third."""
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        bodies = pa.array([pack.compress(t) for t in _texts(batch)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tag"), bodies], names=["doc_id", "tag", "body"])


def _windows(window):
    """Hashes of the windows asked for: two 64-bit values each."""
    schema = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("start", pa.int32()), ("w", pa.int64()), ("x", pa.int64())])

    def run(batches):
        for batch in batches:
            unpack, held = zstandard.ZstdDecompressor(), []
            for doc, tag, body, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "tag")), batch.column("body"), batch.column("spans").to_pylist()):
                hs = Hashes(unpack.decompress(body.as_buffer().to_pybytes()).split())
                at = np.unique(np.concatenate([np.arange(s["lo"], s["lo"] + s["n"]) for s in spans]))
                w = hs.ranges(at, at + window)
                mid = _mix(hs.ranges(at, at + window // 2) + _B) ^ w
                held.append((np.full(len(at), doc, np.int64), np.full(len(at), tag, np.int64), at.astype(np.int32), w.view(np.int64), mid.view(np.int64)))
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held)], schema=schema)

    return run


#: One document in so many is looked at to find hot anchors.
SAMPLE = 32


def _tagged(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """(doc_id, text, tag) and the columns that tell rows apart: the doc_id alone, or with a hash of the text where a doc_id comes with several texts."""
    rows = texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", row_key().alias("tag"))
    several = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg((F.min("tag") < F.max("tag")).alias("s")).where("s")
    return rows, ["doc_id"] if several.isEmpty() else ["doc_id", "tag"]


def _hot(rows: DataFrame, window: int, gram: int, spread: int) -> DataFrame:
    """(a, hot) of anchors frequent enough to fill a task, estimated from a sample; it decides only how rows are dealt out.

    At most 2 * spread anchors can each hold more than a (2 * spread)th of the sample, which bounds the broadcast.
    """
    some = rows.where(F.pmod(F.xxhash64(F.lit(17), "doc_id"), F.lit(SAMPLE)) == 0).mapInArrow(_occurrences(window, gram), _OCC_SQL)
    counts = cut(some.groupBy("a").count())
    total = counts.agg(F.sum("count")).first()[0] or 0
    return cut(counts.where(F.col("count") > max(20, total // (2 * spread))).select("a", F.lit(True).alias("hot")))


def repeats(docs: DataFrame, window: int = 20, gram: int = 5) -> DataFrame:
    """(doc_id, lo, hi), and tag where doc_ids come with several texts: word ranges, not yet merged, covered by windows whose words also start earlier."""
    return _repeats(*_tagged(docs), window, gram)


def _repeats(rows: DataFrame, keys: list[str], window: int, gram: int) -> DataFrame:
    columns = [*keys, "lo", "n", "a", "c"]
    occ = rows.mapInArrow(_occurrences(window, gram), _OCC_SQL).select(*columns)
    spread = partitions(rows)
    route = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id", "lo"), F.lit(spread))).otherwise(0)
    by_anchor = Window.partitionBy("a", "route").orderBy("c", *keys, "lo")
    by_class = Window.partitionBy("a", "route", "c").orderBy(*keys, "lo")
    whole = by_anchor.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    told = cut(
        occ.join(F.broadcast(_hot(rows, window, gram, spread)), "a", "left")
        .withColumn("hot", F.coalesce("hot", F.lit(False)))
        .withColumn("route", route)
        .repartition("a", "route")
        .withColumn("head", F.rank().over(by_class) == 1)
        .withColumn("several", F.min("c").over(whole) < F.max("c").over(whole))
        .where("several or hot or not head")
        .select(*columns, "head", "hot")
    )
    # Each share of a hot anchor has named its own firsts; the first of those is the class's.
    firsts = told.where("hot and head")
    place = F.struct(*keys, "lo")
    classes = cut(firsts.groupBy("a", "c").agg(F.min(place).alias("first")))
    plural = classes.groupBy("a").agg((F.min("c") < F.max("c")).alias("several"))  # a row per hot anchor, of which there are 2 * spread at most
    again = firsts.join(classes, ["a", "c"]).join(F.broadcast(plural), "a").withColumn("head", place == F.col("first"))
    kept = [*keys, "lo", "n", "head"]
    told = told.where("not (hot and head)").select(*kept).union(again.where("several or not head").select(*kept))
    covered = told.where("not head").select(*keys, "lo", (F.col("lo") + F.col("n") - 1 + window).alias("hi"))
    open_ = told.where("head").groupBy(*keys).agg(F.collect_set(F.struct("lo", "n")).alias("spans"))
    bodies = rows.where("doc_id is not null").mapInArrow(_packed, _BODY_SQL)
    if keys == ["doc_id"]:
        bodies = bodies.select("doc_id", F.lit(0).cast("long").alias("tag"), "body")
    wins = cut(bodies.join(open_, keys).mapInArrow(_windows(window), "doc_id long, tag long, start int, w long, x long").select(*keys, "start", "w", "x"))
    # Written, so that the join can split a window that stands in many contexts.
    early = cut(wins.groupBy("w", "x").agg(F.min(F.struct(*keys, "start")).alias("m"), F.count("*").alias("k")).where("k > 1"))
    late = wins.join(early, ["w", "x"]).where(F.struct(*keys, "start") > F.col("m"))
    return covered.union(late.select(*keys, F.col("start").alias("lo"), (F.col("start") + window).alias("hi")))


def _kept():
    kinds = pa.schema([("doc_id", pa.int64()), ("kept", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])

    def run(batches):
        for batch in batches:
            unpack, out = zstandard.ZstdDecompressor(), []
            for body, spans in zip(batch.column("body"), batch.column("spans").to_pylist()):
                ws = unpack.decompress(body.as_buffer().to_pybytes()).split()
                n = len(ws)
                if spans:
                    edge = np.zeros(n + 1, np.int64)
                    np.add.at(edge, np.minimum([s["lo"] for s in spans], n), 1)
                    np.add.at(edge, np.minimum([s["hi"] for s in spans], n), -1)
                    ws = [ws[i] for i in np.flatnonzero(edge.cumsum()[:n] == 0)]
                text = b" ".join(ws)
                out.append((text.decode("utf-8", "replace"), n, n - len(ws), hashlib.sha256(text).hexdigest()))
            cols = [batch.column("doc_id"), *(list(c) for c in zip(*out))]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, kinds)], schema=kinds)

    return run


def drop_repeats(docs: DataFrame, window: int = 20, gram: int = 5) -> DataFrame:
    """One row per row of docs: doc_id, kept (text), n_words, n_removed, kept_sha256.

    Words are runs outside ASCII white space, unchanged. A word goes if it lies
    in a window of that many words whose sequence also starts earlier, in a
    smaller doc_id or earlier in the same document; windows are judged on the
    input. Null and empty texts, and texts shorter than a window, lose nothing.
    Rows that repeat a doc_id and text lose the same words, equal starts not
    being earlier; of rows that repeat a doc_id with other texts each loses its own
    words, and the texts' hashes say which is the earlier. doc_ids must be whole numbers, and rows
    without one are kept whole and make no others go. An empty table gives no rows.
    """
    rows, keys = _tagged(docs)
    spans = _repeats(rows, keys, window, gram).groupBy(*keys).agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    joined = rows.mapInArrow(_packed, _BODY_SQL).select(*keys, "body").join(spans, keys, "left").select("doc_id", "body", "spans")
    return joined.mapInArrow(_kept(), "doc_id long, kept string, n_words long, n_removed long, kept_sha256 string")
