"""Token ids as Parquet list columns with chosen encodings, row groups and pages, for selective reads.

A folder of token files holds ``tokens`` (part, place, doc_id, offset, n_tokens,
meta, tokens), each part being a range of doc_ids in ascending order, and
``parts`` (part, docs, ids, base), one row for each part, that turns an offset
within a part into the number of ids before it in the whole corpus.
"""

import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pricewave.llm.common import partitions

#: Bytes of a row group and of a page, and rows of a page at most: a page is the least that a selective read decodes.
GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 32 << 20, 64 << 10, 500
#: Words whose ids a Python worker remembers; when they are more, it keeps the frequent ones.
WORDS_HELD = 1 << 19
#: Characters, about, of the texts that are encoded together and make an Arrow batch.
BATCH_CHARS = 8 << 20

#: What stands between words that are encoded together; words with it are encoded alone.
_MARK = "\x01"
#: ASCII marks that never join a letter or digit before them; the apostrophe may.
_TAILS = "".join(chr(b) for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'")

_LOADED: dict = {}


def _gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ranges of flat, one after another."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


class Encoder:
    """ids(texts) by a tokenizers file, added special tokens not being put in.

    With by_word, words (runs outside ASCII white space) are encoded apart and
    remembered. That gives the same ids for files that drop white space and cut
    at it. Words not yet seen are encoded many at a time, and without the ASCII
    marks that follow their last letter or digit: the file cuts there, so word
    and marks are looked up apart. Words of letters alone are told apart in the
    result by the ids that end a word, others by a control character between
    them. A word is a number, its ids a range of one array.
    """

    def __init__(self, path: str, by_word: bool) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task, as Spark counts them
        self.tokenizer, self.by_word = Tokenizer.from_file(path), by_word
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        mark = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items() if suffix else ():
            self.ends[i] = token.endswith(suffix)
        self.words, self.flat, self.starts, self.sizes = pa.array([], pa.string()), np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def forget(self, but: pa.Array) -> None:
        """Remember those words only that are among these and were known: the frequent ones."""
        kept = pc.index_in(but, self.words).drop_null()
        words, at = self.words.take(kept), kept.to_numpy()
        ids, sizes = _gathered(self.flat, self.starts[at], self.sizes[at]), self.sizes[at]
        self.words, self.flat, self.starts, self.sizes = pa.array([], pa.string()), np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.add(words, ids, sizes)

    def add(self, words: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Remember words whose ids follow each other in ids."""
        starts = len(self.flat) + np.cumsum(sizes) - sizes
        self.words = pa.concat_arrays([self.words, words])
        self.flat, self.starts, self.sizes = np.concatenate([self.flat, ids]), np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes])

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def alone(self, words: pa.Array) -> None:
        found = [self.whole(w) for w in words.to_pylist()]
        self.add(words, np.concatenate([np.zeros(0, "<u4"), *found]), np.array([len(f) for f in found], np.int64))

    def together(self, words: pa.Array) -> None:
        """Remember the ids of distinct new words, none of which holds the mark or an added token."""
        letters = pc.and_(pc.utf8_is_alpha(words), pc.invert(pc.match_substring(words, "\u0130")))  # the one letter whose lower case holds a mark
        waiting = [(words.filter(letters), True), (words.filter(pc.invert(letters)), False)]
        while waiting:
            these, letters = waiting.pop()
            for k in range(0, len(these), 5000):
                some = these.slice(k, 5000)
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some), "\n" if letters else f"\n{_MARK}\n")[0].as_py()
                ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
                if letters:
                    cuts = np.flatnonzero(self.ends[ids]) + 1
                    sizes = np.diff(cuts, prepend=0)
                else:
                    cuts = np.append(np.flatnonzero(ids == self.mark), len(ids))
                    sizes = np.diff(cuts, prepend=-1) - 1
                    ids = ids[ids != self.mark]
                if len(sizes) == len(some):
                    self.add(some, ids, sizes.astype(np.int64))
                elif letters:
                    waiting.append((some, False))
                else:
                    self.alone(some)

    def learn(self, words: pa.Array) -> None:
        """Remember the ids of distinct new words."""
        odd = pc.match_substring(words, _MARK)
        for token in self.added:
            odd = pc.or_(odd, pc.match_substring(words, token))
        if self.mark is None or not self.ends.any():
            odd = pa.array(np.ones(len(words), bool))
        self.alone(words.filter(odd))
        words = words.filter(pc.invert(odd))
        cores = pc.ascii_rtrim(words, characters=_TAILS)
        cut = pc.and_(pc.less(pc.binary_length(cores), pc.binary_length(words)), pc.match_substring_regex(cores, "[0-9A-Za-z]$"))
        wanted, cores = words.filter(cut), cores.filter(cut)
        tails = pc.replace_substring_regex(wanted, "(?s)^.*[0-9A-Za-z]", "")
        parts = pc.unique(pa.concat_arrays([words.filter(pc.invert(cut)), cores, tails]))
        self.together(parts.filter(pc.is_null(pc.index_in(parts, self.words))))
        wanted, cores, tails = (x.filter(pc.is_null(pc.index_in(wanted, self.words))) for x in (wanted, cores, tails))
        pairs = np.stack([pc.index_in(x, self.words).to_numpy() for x in (cores, tails)], 1)
        sizes = self.sizes[pairs]
        self.add(wanted, _gathered(self.flat, self.starts[pairs].ravel(), sizes.ravel()), sizes.sum(1))

    def numbers(self, words: pa.Array) -> np.ndarray:
        """The number of each of these distinct words."""
        new = words.filter(pc.is_null(pc.index_in(words, self.words)))
        if len(new):
            self.learn(new)
        return pc.index_in(words, self.words).to_numpy()

    def ids(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, one text after another, and end after each; their number in each text); texts are not null."""
        if not self.by_word:
            found = [self.whole(t) for t in texts.to_pylist()]
            flat, counts = np.concatenate([np.zeros(0, "<u4"), *found]), np.array([len(f) for f in found], np.int64)
        else:
            split = pc.ascii_split_whitespace(texts)
            encoded = split.flatten().dictionary_encode()
            if len(self.words) > WORDS_HELD:
                self.forget(encoded.dictionary)
            number = self.numbers(encoded.dictionary)[encoded.indices.to_numpy()] if len(encoded) else np.zeros(0, np.int64)
            sizes = self.sizes[number]
            flat = _gathered(self.flat, self.starts[number], sizes)
            upto = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(split.value_lengths().to_numpy())])]
            counts = np.diff(upto)
        if end is not None:
            flat, counts = np.insert(flat, np.cumsum(counts), end), counts + 1
        return flat.astype("<u4", copy=False), counts


def encoder(path: str, by_word: bool) -> Encoder:
    if (path, by_word) not in _LOADED:
        _LOADED[path, by_word] = Encoder(path, by_word)
    return _LOADED[path, by_word]


def _tokenise(path: str, end_id: int | None, by_word: bool):
    def run(batches):
        from pyspark import TaskContext

        enc, part = encoder(path, by_word), TaskContext.get().partitionId()
        place = offset = 0
        for batch in batches:
            texts, first = batch.column("text"), 0
            sizes = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))])
            while first < batch.num_rows:
                # As many texts as have BATCH_CHARS bytes, one at least.
                n = max(1, int(np.searchsorted(sizes[first + 1 :], sizes[first] + BATCH_CHARS)))
                n = min(n, batch.num_rows - first)
                flat, counts = enc.ids(texts.slice(first, n), end_id)
                before = np.concatenate([[0], np.cumsum(counts)])
                columns = {
                    "part": pa.array(np.full(n, part, np.int32)),
                    "place": pa.array(np.arange(place, place + n)),
                    "doc_id": batch.column("doc_id").slice(first, n),
                    "offset": pa.array(offset + before[:-1]),
                    "n_tokens": pa.array(counts),
                    "meta": batch.column("meta").slice(first, n),
                    "tokens": pa.ListArray.from_arrays(pa.array(before.astype(np.int32)), pa.array(flat.view("<i4"))),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
                place, offset, first = place + n, offset + int(before[-1]), first + n

    return run


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int | None = None,
    metadata: tuple[str, ...] = (),
    encoding: str = "dictionary",
    by_word: bool = False,
    group_bytes: int = GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Encode each row of docs (doc_id, text) and write its ids, then end_id, to token files in folder.

    Rows are in ascending doc_id order, those without a doc_id first, and rows
    that repeat a doc_id in the order of a hash of their text. Null texts are
    empty: they hold end_id only. doc_ids are whole numbers. metadata names columns of docs that are
    kept beside the ids, in the struct ``meta``; so they never clash with the
    format's own. The ids are dictionary- or delta-encoded ("dictionary",
    "delta"); the ascending columns are always delta-encoded. Every row group
    has a page index. An empty table gives files without rows. folder must be
    one that all executors share, and must not hold token files yet.

    The texts are dealt by ranges of doc_id and of the text's hash, so that rows
    which repeat one doc_id, or have none, are spread; only a part's running
    count of ids is carried from row to row.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"no such encoding: {encoding}")
    meta = F.struct(*[F.col(c).alias(c) for c in metadata]) if metadata else F.lit(None).cast("boolean")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), meta.alias("meta"))
    order = ["doc_id", F.xxhash64("text")]
    dealt = rows.repartitionByRange(partitions(docs), *order).sortWithinPartitions(*order)
    kinds = f"part int, place long, doc_id long, offset long, n_tokens long, meta {rows.schema['meta'].dataType.simpleString()}, tokens array<int>"
    written = dealt.mapInArrow(_tokenise(tokenizer, end_id, by_word), kinds).write
    options = {
        "parquet.writer.version": "v2",  # ascending numbers without a dictionary are then delta-encoded
        "parquet.block.size": group_bytes,
        "parquet.page.size": page_bytes,
        "parquet.page.row.count.limit": page_rows,
        "parquet.enable.dictionary": "true",
        "parquet.enable.dictionary#tokens.list.element": str(encoding == "dictionary").lower(),
        **{f"parquet.enable.dictionary#{c}": "false" for c in ("place", "doc_id", "offset")},
    }
    written.options(**options).parquet(f"{folder}/tokens")
    held = docs.sparkSession.read.parquet(f"{folder}/tokens").groupBy("part").agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition, not for each document
    held.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0))).write.parquet(f"{folder}/parts")


def read_tokens(spark: SparkSession, folder: str, first: int | None = None, last: int | None = None, columns: tuple[str, ...] = ("tokens",)) -> DataFrame:
    """doc_id, start, n_tokens and the columns named (tokens, meta) of the documents with first <= doc_id <= last.

    start is the number of ids of all documents before. Both bounds reach the
    scan: row groups and pages without such doc_ids are not read, and columns
    not named are not touched.
    """
    rows = spark.read.parquet(f"{folder}/tokens")
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.where(F.col("doc_id") <= last)
    parts = F.broadcast(spark.read.parquet(f"{folder}/parts").select("part", "base"))  # a row for each partition of the writing job
    return rows.join(parts, "part").select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", *columns)


def read_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and meta of all documents; no page of ids is read."""
    return read_tokens(spark, folder, columns=("meta",))


def checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of rows that read_tokens gives: the ids as little-endian unsigned 32-bit integers."""

    def run(batches):
        for batch in batches:
            ids = batch.column("tokens")
            flat, at = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4"), np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())])
            sums = pa.array([zlib.crc32(flat[a:b]) for a, b in zip(at, at[1:])], pa.int64())
            counts = pa.array(np.diff(at).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), counts, sums], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "tokens").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
