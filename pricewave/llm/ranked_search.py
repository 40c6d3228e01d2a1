"""Ranked lexical search over a hierarchy of maxima: best-first branch and bound.

The documents are dealt into segments. A segment holds for each of its terms the
documents with it and their impacts (what a document's score gets from the term,
before the term's weight), and above them a tree over document ranges: each node
has the greatest impact of the term in its range of FANOUT nodes below. The sum
over an item's terms of weight times node maximum bounds every score in the
range, so a search opens the range with the highest sum first, down to single
documents, and ends when no sum reaches its k-th best score.
"""

import functools
import heapq
import math
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from pricewave.llm.common import LOWER, UPPER, cut, shared_folder

#: Nodes under one node, and levels of nodes above the documents.
FANOUT, LEVELS = 16, 3
#: Documents and term occurrences of a segment at most: the least that a task reads.
SEGMENT_DOCS, SEGMENT_TERMS = FANOUT**LEVELS, 1 << 19
#: Terms of the items that are searched at once: what a task is sent.
BLOCK_TERMS = 200_000
#: A text as UTF-8 with this table holds a term's bytes, A-Z lower-cased, and blanks between terms.
_TERMS = bytes(
    ord(LOWER[UPPER.index(chr(b))]) if chr(b) in UPPER else b if b > 0x7F or chr(b).isalnum() else 0x20 for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """The maximal runs of ASCII letters, digits and characters above U+007F, only A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERMS).split()


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """(documents with a term, occurrences of terms)."""

    def run(batches):
        for batch in batches:
            counts = [len(terms(t.as_py())) for t in batch.column("text")]
            yield pa.RecordBatch.from_pydict({"n": [sum(c > 0 for c in counts)], "l": [sum(counts)]})

    sizes = docs.select("text").mapInArrow(run, "n long, l long").agg(F.sum("n"), F.sum("l")).first()
    return int(sizes[0] or 0), int(sizes[1] or 0)


def _segment(ids: list, lengths: list, counts: list[Counter], docs: int, total: int) -> dict:
    """The row of a segment.

    Documents are numbered by their most frequent term and their length, so that a
    range holds documents of one language and alike lengths, and its bounds are
    close. Terms that several documents have come first, then those of one; each
    with its postings (document and impact). Only the former have a tree: level k
    lists for each of them, in order, its nodes, their greatest impacts and how
    many nodes of the level below each has.
    """
    order = sorted(range(len(ids)), key=lambda i: (max(counts[i], key=counts[i].get), lengths[i]))
    counts, lengths = [counts[i] for i in order], [lengths[i] for i in order]
    words = [w for c in counts for w in c]
    tf = np.fromiter((x for c in counts for x in c.values()), np.int64, len(words))
    sizes = np.array([len(c) for c in counts])
    m = np.array([10 + 90 * n * docs // total for n in lengths], np.int64)
    impact = 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, sizes))
    found = pa.array(words, pa.binary()).dictionary_encode()
    term, doc = found.indices.to_numpy(), np.repeat(np.arange(len(ids)), sizes)
    df = np.bincount(term, minlength=len(found.dictionary))
    shared = np.argsort(df == 1, kind="stable")
    rank = np.empty(len(df), np.int64)
    rank[shared] = np.arange(len(df))
    term = rank[term]
    by = np.argsort(term, kind="stable")  # a term's documents stay in order
    term, node, most = term[by], doc[by], impact[by]
    many = int((df > 1).sum())
    cut = int(df[df > 1].sum())
    row = {
        "doc_ids": [ids[i] for i in order], "terms": found.dictionary.take(pa.array(shared)), "df": df[shared][:many],
        "doc0": node[:cut], "most0": most[:cut], "one_doc": node[cut:], "one_most": most[cut:],
    }
    term, node, most = term[:cut], node[:cut], most[:cut]
    for level in range(1, LEVELS + 1):
        at = term * SEGMENT_DOCS + node // FANOUT
        starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if cut else np.zeros(0, np.int64)
        kids = np.diff(np.append(starts, len(at)))
        most = np.maximum.reduceat(most, starts) if cut else most
        term, node = term[starts], node[starts] // FANOUT
        row |= {f"node{level}": node, f"most{level}": most, f"kids{level}": kids}
    return row


_SHORT, _INT = pa.list_(pa.int16()), pa.list_(pa.int32())
#: What the highest level and the counts of documents need, and what is read only where a search descends.
_TOP = pa.schema([("terms", pa.list_(pa.binary())), ("df", _SHORT), ("one_doc", _SHORT), ("one_most", _INT), (f"most{LEVELS}", _INT)])
_REST = pa.schema(
    [("doc_ids", pa.list_(pa.int64())), ("doc0", _SHORT), ("most0", _INT), (f"kids{LEVELS}", _SHORT)]
    + [(f"{name}{level}", kind) for level in range(1, LEVELS) for name, kind in (("node", _SHORT), ("most", _INT), ("kids", _SHORT))]
)


def _packed(row: dict, schema: pa.Schema) -> bytes:
    """The named arrays as one compressed Arrow record: a segment is two values to Spark, not some twenty nested columns."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in schema], schema=schema))
    return sink.getvalue().to_pybytes()


def _unpacked(blob: pa.Scalar) -> pa.RecordBatch:
    return pa.ipc.open_stream(blob.as_buffer()).read_next_batch()


def _segments(docs: int, total: int, most_docs: int, most_terms: int):
    def run(batches):
        from pyspark import TaskContext

        key, ids, lengths, counts, held = TaskContext.get().partitionId() << 32, [], [], [], 0

        def close():
            row = _segment(ids, lengths, counts, docs, total)
            return pa.RecordBatch.from_pydict({"segment": [key], "top": [_packed(row, _TOP)], "rest": [_packed(row, _REST)]})

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                found = terms(text.as_py())
                if not found:
                    continue
                ids.append(doc_id)
                lengths.append(len(found))
                counts.append(Counter(found))
                held += len(found)
                if len(ids) >= most_docs or held >= most_terms:
                    yield close()
                    key, ids, lengths, counts, held = key + 1, [], [], [], 0
        if ids:
            yield close()

    return run


def item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, term): the terms of each row of items (item_id, text), once each; item tells rows apart that share an item_id."""

    def run(batches):
        for batch in batches:
            found = [sorted(set(terms(t.as_py()))) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), batch.column("item"), pa.array(found, pa.list_(pa.binary()))], names=["item_id", "item", "terms"])

    kind = items.schema["item_id"].dataType.simpleString()
    rows = items.select("item_id", F.xxhash64("item_id", "text").alias("item"), "text").dropDuplicates(["item", "item_id"])
    return rows.mapInArrow(run, f"item_id {kind}, item long, terms array<binary>").select("item", "item_id", F.explode("terms").alias("term"))


class Index:
    """A written index: the folder of its segments, and the corpus's documents and occurrences."""

    def __init__(self, segments: DataFrame, docs: int, total: int) -> None:
        self.segments, self.docs, self.total = segments, docs, total


def build(docs: DataFrame, folder: str | None = None, segment_docs: int = SEGMENT_DOCS, segment_terms: int = SEGMENT_TERMS) -> Index:
    """Index all terms of docs (doc_id, text) and write it to folder, one that all executors share.

    A segment is a run of rows of one partition, so documents are not shuffled;
    they are read twice, first for the size of the corpus. Null and empty texts
    have no terms and are not in it. Each row is a document of its own, also one that repeats a doc_id.
    """
    if segment_docs > SEGMENT_DOCS:
        raise ValueError(f"a tree spans {SEGMENT_DOCS} documents")
    count, total = corpus_size(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    made = rows.mapInArrow(_segments(count, total, segment_docs, segment_terms), "segment long, top binary, rest binary")
    folder = folder or f"{shared_folder(docs.sparkSession)}/index-{uuid.uuid4().hex}"
    made.write.option("parquet.block.size", 8 << 20).parquet(folder)
    return Index(docs.sparkSession.read.parquet(folder), count, total)


class _Tree:
    """A segment as a task reads it; its arrays are opened when they are asked for."""

    def __init__(self, batch: pa.RecordBatch, row: int, words: pa.Array) -> None:
        self.batch, self.row, self.held = batch, row, {}
        self.read(_unpacked(batch.column("top")[row]))
        self.place = pc.fill_null(pc.index_in(words, self.terms), -1).to_numpy().astype(np.int64)  # of each searched word
        self.many = len(self.held["df"])

    def read(self, record: pa.RecordBatch) -> None:
        for name, column in zip(record.schema.names, record.columns):
            if name == "terms":
                self.terms = column.values
            elif name == "doc_ids":
                self.ids = column.values
            else:
                found = column.values.to_numpy()
                self.held[name] = np.concatenate([[0], np.cumsum(found, dtype=np.int64)]) if name.startswith("kids") else found

    def array(self, name: str) -> np.ndarray:
        if name not in self.held:
            self.read(_unpacked(self.batch.column("rest")[self.row]))
        return self.held[name]

    def start(self, places: np.ndarray, weights: np.ndarray) -> tuple:
        """What a node carries: its entries in its level and their weights; documents and values of the terms that one document has."""
        many = places < self.many
        ones = places[~many] - self.many
        return places[many], weights[many], self.array("one_doc")[ones], weights[~many] * self.array("one_most")[ones]

    def bound(self, entries, weights, _, values) -> int:
        """The root's sum of weight times greatest impact; entries of the highest level are terms."""
        return int((weights * self.array(f"most{LEVELS}")[entries]).sum() + values.sum())

    def open(self, level: int, node: int, entries, weights, docs, values) -> tuple:
        """(sums over the FANOUT nodes below, and what is needed to pick one of them)."""
        first = self.array(f"kids{level}")
        low = first[entries]
        sizes = first[entries + 1] - low
        ends = np.cumsum(sizes)
        below = np.repeat(low - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        child = self.array(f"node{level - 1}" if level > 1 else "doc0")[below] - node * FANOUT
        weights = np.repeat(weights, sizes)
        # Sums of whole numbers below 2**53 are exact in doubles.
        sums = np.bincount(child, weights * self.array(f"most{level - 1}")[below], FANOUT)
        one = (docs // FANOUT ** (level - 1)) - node * FANOUT
        sums = sums + np.bincount(one, values, FANOUT)
        return sums.astype(np.int64), (child, below, weights, one, docs, values)

    @staticmethod
    def pick(opened: tuple, k: int) -> tuple:
        """What the k-th node below carries."""
        child, below, weights, one, docs, values = opened
        mine, single = child == k, one == k
        return below[mine], weights[mine], docs[single], values[single]


def _last(doc_id: int | None) -> int:
    """Order of equal scores: by doc_id, rows without one last."""
    return 1 << 63 if doc_id is None else doc_id


class _Best:
    """The k best (score, doc_id) so far, of scores of at least floor."""

    def __init__(self, k: int, floor: int) -> None:
        self.k, self.floor, self.held = k, max(1, floor), []

    def least(self) -> int:
        """A lower score can't be among the best; an equal one can, with a smaller doc_id."""
        return max(self.floor, self.held[0][0]) if len(self.held) == self.k else self.floor

    def offer(self, score: int, doc_id: int | None) -> None:
        if score >= self.least():
            entry = (score, -_last(doc_id))
            (heapq.heappush if len(self.held) < self.k else heapq.heappushpop)(self.held, entry)


def _search(tree: _Tree, places: np.ndarray, weights: np.ndarray, best: _Best, opened: list[int]) -> None:
    """Open ranges in order of their bounds, the highest first, until none reaches the k-th best score; ranges with an equal bound are opened too."""
    root = tree.start(places, weights)
    waiting = [(-tree.bound(*root), LEVELS, 0, root)]
    while waiting and -waiting[0][0] >= best.least():
        _, level, node, carried = heapq.heappop(waiting)
        opened[0] += 1
        sums, below = tree.open(level, node, *carried)
        for k in np.flatnonzero(sums >= best.least()).tolist():
            if level > 1:
                heapq.heappush(waiting, (-int(sums[k]), level - 1, node * FANOUT + k, tree.pick(below, k)))
            else:
                best.offer(int(sums[k]), tree.ids[node * FANOUT + k].as_py())


class _Items:
    """A block of items as arrays: the distinct terms, and for each item its ids, the places of its terms among them and their weights."""

    def __init__(self, rows: pa.Table) -> None:
        encoded = rows.column("term").combine_chunks().dictionary_encode()
        self.words, place = encoded.dictionary, encoded.indices.to_numpy()
        item = rows.column("item").to_numpy()
        order = np.argsort(item, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], item[order][1:] != item[order][:-1]]))
        ids = rows.column("item_id").take(pa.array(order[starts])).to_pylist()
        self.each = [(int(item[c[0]]), name, place[c]) for name, c in zip(ids, np.split(order, starts[1:]))]
        self.weights = np.zeros(len(self.words), np.int64)

    def weigh(self, df: dict[int, int], docs: int) -> None:
        """floor(1000 ln((2 N + 2) / (2 df + 1))) for each term that is anywhere."""
        for place, n in df.items():
            self.weights[place] = math.floor(1000 * math.log((2 * docs + 2) / (2 * n + 1)))

    def here(self, tree: _Tree, which: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of an item's terms in a segment, and their weights."""
        at = self.each[which][2]
        at = at[tree.place[at] >= 0]
        return tree.place[at], self.weights[at]


def _frequencies(words: pa.Array):
    """(place, n): in how many documents of what a task reads the words are."""

    def run(batches):
        n = np.zeros(len(words), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                tree = _Tree(batch, row, words)
                here = np.flatnonzero(tree.place >= 0)
                n[here] += np.append(tree.array("df"), 1)[np.minimum(tree.place[here], tree.many)]
        there = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(n[there])], names=["place", "n"])

    return run


def _roots(items: _Items):
    """For each item the segment whose root has the highest bound, of those that a task reads."""

    def run(batches):
        best: dict[int, tuple] = {}
        for batch in batches:
            for row, segment in enumerate(batch.column("segment").to_pylist()):
                tree = _Tree(batch, row, items.words)
                for which in range(len(items.each)):
                    bound = tree.bound(*tree.start(*items.here(tree, which)))
                    best[which] = max(best.get(which, (0, 0)), (bound, segment))
        rows = [(which, *found) for which, found in best.items() if found[0]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * 3, names=["which", "bound", "segment"])

    return run


def _searcher(items: _Items, k: int, floors: dict[int, int], only: dict[int, int] | None, schema: pa.Schema):
    """The best of what a task reads, for each item; with only, of the one segment named for the item."""

    def run(batches):
        best, opened = {}, [0]
        for batch in batches:
            for row, segment in enumerate(batch.column("segment").to_pylist()):
                tree = _Tree(batch, row, items.words)
                for which in range(len(items.each)):
                    if only is None or only.get(which) == segment:
                        places, weights = items.here(tree, which)
                        if len(places):
                            found = best.setdefault(which, _Best(k, floors.get(which, 1)))
                            _search(tree, places, weights, found, opened)
        rows = [(which, *items.each[which][:2], None if doc == -(1 << 63) else -doc, score) for which, found in best.items() for score, doc in found.held]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)

    return run


def search(index: Index, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The k documents with the highest scores above 0 for each item: item_id, rank, doc_id, score.

    items: item_id, text. A score sums weight times impact over the item's terms,
    once each. Equal scores rank by ascending doc_id, those without one last; a
    doc_id that several rows have may appear several times. Rows of items that
    repeat item_id and text are one item; those that repeat an item_id with
    another text are ranked each. Null and empty items, and an empty index, give no rows.

    Items are searched in blocks of about block_terms terms, each block against
    all segments. First the segment with the highest bound of each item is
    searched; its k-th best score is where the search of all the others starts,
    and each task carries its own from segment to segment. A task returns at
    most k rows for each item.
    """
    spark = index.segments.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    wanted = cut(item_terms(items))
    out = f"which long, item long, item_id {kind}, doc_id long, score long"
    blocks = -(-wanted.count() // block_terms)
    found = []
    for block in range(blocks):
        chosen = wanted.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).toArrow()
        if not chosen.num_rows:
            continue
        held = _Items(chosen)
        schema = pa.schema([("which", pa.int64()), ("item", pa.int64()), ("item_id", chosen.schema.field("item_id").type), ("doc_id", pa.int64()), ("score", pa.int64())])
        counts = index.segments.select("top").mapInArrow(_frequencies(held.words), "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
        held.weigh({r["place"]: r["n"] for r in counts.collect()}, index.docs)  # a row for each term of the block
        roots = index.segments.select("segment", "top").mapInArrow(_roots(held), "which long, bound long, segment long")
        first = {r["which"]: r["s"] for r in roots.groupBy("which").agg(F.max_by("segment", F.struct("bound", "segment")).alias("s")).collect()}
        seeds = index.segments.where(F.col("segment").isin(sorted(set(first.values()))))
        scores = seeds.mapInArrow(_searcher(held, k, {}, first, schema), out).groupBy("which").agg(F.min("score").alias("least"), F.count("*").alias("n"))
        floors = {r["which"]: r["least"] for r in scores.where(F.col("n") == k).collect()}
        found.append(index.segments.mapInArrow(_searcher(held, k, floors, None, schema), out))
    if not found:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    best = Window.partitionBy("item_id", "item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = functools.reduce(DataFrame.union, found).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
