"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from pricewave.llm.common import arrow_rows, cut, keyed, rows_in, texts

_WORD = re.compile(r"\w+")
#: Smith-Waterman scores for equal words, differing words and a gap.
MATCH, MISMATCH, GAP = 2, -1, -1


def tokens(text) -> list[str]:
    """Lower-cased runs of letters, digits and underscores."""
    return _WORD.findall((text or "").lower())


def gram_hashes(ws: list[str], gram: int) -> np.ndarray:
    """Hash of each run of gram words; fewer words: one hash of them all; none: none."""
    if not ws:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, ws), dtype=np.uint64, count=len(ws))
    size = min(gram, len(h))
    out = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(out)]
    return out.view(np.int64)


def align(item: list[str], passage: list[str]) -> tuple[int, int, int]:
    """Best local alignment of two word lists: (score, start, end) in the passage, end exclusive; the first of equal scores.

    Row by row over the item, vectorised over the passage: gaps along the row
    are a running maximum of scores made level by the gap cost.
    """
    n = len(passage)
    if not n or not item:
        return 0, 0, 0
    code = {w: i for i, w in enumerate(dict.fromkeys(item))}
    p = np.array([code.get(w, -1) for w in passage])
    level = np.arange(n) * -GAP
    score, start = np.zeros(n + 1, np.int64), np.arange(n + 1)
    top, span = 0, (0, 0)
    for w in item:
        diag = score[:-1] + np.where(p == code[w], MATCH, MISMATCH)
        up = score[1:] + GAP
        new = np.maximum(np.maximum(diag, up), 0)
        begin = np.where(new == 0, np.arange(1, n + 1), np.where(diag >= up, start[:-1], start[1:]))
        # A gap in the item: carry the best score to the left, less the gap cost per word.
        raised = new + level
        best = np.maximum.accumulate(raised)
        at = np.maximum.accumulate(np.where(raised == best, np.arange(n), 0))
        carried = best - level
        moved = carried > new
        new, begin = np.where(moved, carried, new), np.where(moved, begin[at], begin)
        score, start = np.concatenate([[0], new]), np.concatenate([[0], begin])
        k = int(new.argmax())
        if new[k] > top:
            top, span = int(new[k]), (int(begin[k]), k + 1)
    return top, *span


def _seeds(gram):
    schema = pa.schema([("item", pa.int64()), ("h", pa.int64())])

    def run(batches):
        for batch in batches:
            out = [(i, h) for i, t in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()) for h in set(gram_hashes(tokens(t), gram).tolist())]
            cols = list(zip(*out)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return run


def _hits(gram, sorted_grams):
    """Per document: the benchmark grams it holds, with their positions."""
    known = np.array(sorted_grams, np.int64)

    def make(batch):
        kept = ([], [], [])
        for k, t in enumerate(batch.column("text").to_pylist()):
            h = gram_hashes(tokens(t), gram)
            pos = np.flatnonzero(known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h)
            if len(pos):
                for out, v in zip(kept, (k, h[pos].tolist(), pos.tolist())):
                    out.append(v)
        rows = pa.array(kept[0], pa.int64())
        return [batch.column("row").take(rows), kept[1], kept[2]]

    return make


#: Benchmark grams up to this many go to the tasks with the code (8 bytes each); beyond it they are joined.
MAX_SHIPPED_GRAMS = 4_000_000
#: Candidate pairs up to this many are broadcast to the texts; beyond it both are shuffled.
MAX_BROADCAST_PAIRS = 100_000
#: Places of seeds up to this many (32 bytes each) are broadcast to the hits, so that a seed that many documents hold is not dealt to one task.
MAX_BROADCAST_PLACES = 1_000_000


def _grams(gram):
    def make(batch):
        found = [gram_hashes(tokens(t), gram) for t in batch.column("text").to_pylist()]
        return [batch.column("row"), [f.tolist() for f in found], [list(range(len(f))) for f in found]]

    return make


def _scored(margin, least):
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])

    def regions(starts, length):
        """Merge the places that the seeds point to, with room for edits."""
        room, out = length // 2 + margin, []
        for s in sorted(starts):
            lo, hi = max(0, s - room), s + length + room
            if out and lo <= out[-1][1]:
                out[-1][1] = max(out[-1][1], hi)
            else:
                out.append([lo, hi])
        return out

    def run(batches):
        for batch in batches:
            rows, text, ws = [], None, []
            for doc, row, t, item, body, offsets in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row", "text", "item_id", "body", "offsets"))):
                if t is not text:
                    text, ws = t, tokens(t)
                words = tokens(body)
                best, wanted = (0, 0, 0), Counter(words)
                for lo, hi in regions(set(offsets), len(words)):
                    # Long regions, of passages repeated many times, are aligned in overlapping pieces.
                    step = max(4096, 4 * len(words))
                    # Each word beyond the item's costs a gap, which bounds the length of a passage that reaches the threshold.
                    longest = int(len(words) * (3 - 2 * least)) + 1
                    for a in range(lo, min(hi, len(ws)), step):
                        piece = ws[a : min(hi, a + step + longest)]
                        # No alignment scores more than a match for each word of the item that the piece holds.
                        most = MATCH * (wanted & Counter(w for w in piece if w in wanted)).total()
                        if most <= best[0] or most / (MATCH * len(words)) < least:
                            continue
                        score, s, e = align(words, piece)
                        if score > best[0]:
                            best = (score, a + s, a + e)
                rows.append((doc, row, item, best[0] / (MATCH * len(words)), best[1], best[2]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def rare_grams(grams: DataFrame, shared: int, score: float, min_seeds: int) -> DataFrame:
    """The seeds among grams (item, h): those that at most shared items hold.

    An item of which too few are so rare also takes the rarest of the others,
    ties included, until any part of it that is long enough to reach the score
    holds min_seeds of them: all but the last score * n - min_seeds of its n.
    Rarity is counted over items, so an item's copies in the corpus do not
    change its seeds, and a place in the corpus meets few items.
    """
    held = grams.groupBy("h").agg(F.count("*").alias("held"))
    of_item = Window.partitionBy("item")
    ranked = grams.join(held, "h").withColumn("n", F.count("*").over(of_item)).withColumn("r", F.rank().over(of_item.orderBy("held")))
    return ranked.where((F.col("held") <= shared) | (F.col("r") <= F.ceil((1 - score) * F.col("n")) + min_seeds)).select("item", "h")


def matches(docs: DataFrame, bench: DataFrame, gram: int = 3, score: float = 0.5, margin: int = 8, min_seeds: int = 2, shared: int = 8) -> DataFrame:
    """(doc_id, item_id, score, start, end): documents holding an exact, edited or paraphrased benchmark item.

    The seeds of an item are its rare grams, by the number of items that hold
    them; see rare_grams. A document with at least min_seeds seeds of an item
    (or with all, if the item has fewer) is aligned to it around them, so a copy
    is missed only if edits leave fewer than that many of its seeds whole; a pair
    whose shared words cannot reach the threshold is not aligned. score is the Smith-Waterman
    score over that of a perfect copy and must reach the threshold; start and end
    count the document's words. Words are lower-cased runs of letters, digits and
    underscores. Null or empty texts and items match nothing; repeated items are
    matched once by (item_id, text); of rows repeating a doc_id the best score
    counts. Rows whose id is null match nothing. Ids are whole numbers.
    """
    found = _matched(docs, bench, gram, score, margin, min_seeds, shared).where("doc_id is not null")
    best = found.groupBy("doc_id", "item_id").agg(F.max_by(F.struct("score", "start", "end"), F.struct("score", -F.col("start"), "end")).alias("m"))
    return best.select("doc_id", "item_id", "m.score", "m.start", "m.end")


def _matched(docs, bench, gram=3, score=0.5, margin=8, min_seeds=2, shared=8) -> DataFrame:
    """(doc_id, row, item_id, score, start, end) for each row of docs, with or without an id, that holds an item."""
    rows = keyed(docs)
    items = cut(texts(bench, "item_id").select(F.col("doc_id").cast("long").alias("item_id"), F.col("text").alias("body")).where("item_id is not null").distinct().withColumn("item", F.xxhash64("item_id", "body")))
    grams = cut(rare_grams(items.select("item", F.col("body").alias("text")).mapInArrow(_seeds(gram), "item long, h long"), shared, score, min_seeds))
    known = grams.select("h").distinct()
    schema = pa.schema([("row", pa.int64()), ("hs", pa.list_(pa.int64())), ("at", pa.list_(pa.int64()))])
    n = known.count()
    if not n:
        return rows.selectExpr("doc_id", "row", "cast(null as long) item_id", "0D score", "0L start", "0L end").where("false")
    ship = n <= MAX_SHIPPED_GRAMS
    make = _hits(gram, sorted(r.h for r in known.collect())) if ship else _grams(gram)
    found = rows.mapInArrow(arrow_rows(make, schema), "row long, hs array<long>, at array<long>")
    hits = found.select("row", F.explode(F.arrays_zip("hs", "at")).alias("g")).select("row", F.col("g.hs").alias("h"), F.col("g.at").alias("at"))
    hits = cut(hits if ship else hits.join(known, "h", "left_semi"))
    seeds = cut(grams.join(hits.select("h").distinct(), "h", "left_semi").select("item", "h", F.count("*").over(Window.partitionBy("item")).alias("n_seeds")))
    places = cut(grams_at(items, gram).join(seeds, ["item", "h"]))
    if places.count() <= MAX_BROADCAST_PLACES:
        places = F.broadcast(places)
    pairs = (
        hits.join(places, "h")
        .groupBy("row", "item")
        .agg(F.count_distinct("h").alias("k"), F.max("n_seeds").alias("n_seeds"), F.collect_set(F.col("at") - F.col("pos")).alias("offsets"))
        .where(F.col("k") >= F.least(F.lit(min_seeds), F.col("n_seeds")))
        .select("row", "item", "offsets")
    )
    pairs = cut(pairs)
    if pairs.count() <= MAX_BROADCAST_PAIRS:
        pairs = F.broadcast(pairs)
    held = rows.join(pairs, "row").join(items, "item").select("doc_id", "row", "text", "item_id", "body", "offsets")
    scored = held.mapInArrow(_scored(margin, score), "doc_id long, row long, item_id long, score double, start long, end long")
    return scored.where(F.col("score") >= score)


def grams_at(items: DataFrame, gram: int) -> DataFrame:
    """(item, h, pos) of every gram of the items."""
    schema = pa.schema([("item", pa.int64()), ("hs", pa.list_(pa.int64()))])
    make = lambda b: [b.column("item"), [gram_hashes(tokens(t), gram).tolist() for t in b.column("body").to_pylist()]]
    return items.select("item", "body").mapInArrow(arrow_rows(make, schema), "item long, hs array<long>").select("item", F.posexplode("hs").alias("pos", "h"))


def clean(docs: DataFrame, bench: DataFrame, **how) -> DataFrame:
    """The rows of docs without those that hold a benchmark item, rows without an id included; columns unchanged."""
    return rows_in(docs, _matched(docs, bench, **how).select("doc_id", "row").distinct(), "left_anti")
