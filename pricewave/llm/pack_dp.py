"""Packing of token sequences by an order-preserving dynamic program."""

import json
import re
import zlib
from bisect import bisect_left
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricewave.llm.common import partitions, texts

#: Costs in padded tokens of a cut at a document's end, a sentence's end and elsewhere.
DOC_CUT, SENTENCE_CUT, HARD_CUT = 0.0, 1.0, 6.0
#: A stretch of about this many tokens is solved at once; its last sequence is carried into the next.
STRETCH = 1 << 18

_ENCODERS: dict = {}


def encoder(path: str):
    """ids(text) -> uint32 array, with the vocabulary of a tokenizers file; special strings in a text are ordinary text to it; encode() cuts them out first.

    The file's byte-level BPE is run by tiktoken, which gives the same ids about
    five times as fast; the tests compare the two.
    """
    if path not in _ENCODERS:
        import tiktoken

        spec = json.load(open(path, encoding="utf-8"))
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in w): i for w, i in spec["model"]["vocab"].items() if w not in special}
        pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        enc = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        ends = np.zeros(max([*ranks.values(), *(t["id"] for t in spec["added_tokens"])]) + 1, bool)
        for w, i in ranks.items():
            ends[i] = w[-1:] in b".!?\n" if w else False
        _ENCODERS[path] = enc, ends
    return _ENCODERS[path]


def _encode(enc, text: str) -> np.ndarray:
    try:
        return np.array(enc.encode_to_numpy(text, disallowed_special=()), dtype="<u4")
    except UnicodeEncodeError:
        return np.array(enc.encode_ordinary(text), dtype="<u4")


def added_tokens(path: str) -> dict[str, int]:
    """The strings that the tokenizers file takes out of a text as one token each, and their ids."""
    return {t["content"]: t["id"] for t in json.load(open(path, encoding="utf-8"))["added_tokens"]}


def encode(enc, added: dict[str, int], text: str) -> np.ndarray:
    """The ids that the tokenizers file gives as loaded: added tokens, leftmost and then longest first, split the text and have their own ids."""
    if not any(w in text for w in added):
        return _encode(enc, text)
    parts = re.split("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")", text)
    return np.concatenate([np.array([added[t]], "<u4") if k % 2 else _encode(enc, t) for k, t in enumerate(parts)])


def choose(length: int, places: np.ndarray, costs: np.ndarray, size: int) -> list[int]:
    """Ends of the sequences that cover length tokens at least padding plus cut cost.

    places are the allowed cuts in increasing order, the last being length; no
    two neighbours, nor the first and 0, are more than size apart. With f(j) the
    least cost up to place j, f(j) = cost(j) + size - j + min(f(i) + i) over the
    places i in [j - size, j): the minimum of a sliding window, kept by a
    monotone queue. The last sequence is not padded, since more tokens follow
    or, at the very end, it is split into powers of two.
    """
    at, cost = [0, *places.tolist()], [0.0, *costs.tolist()]
    last = len(at) - 1
    back, value = [0] * len(at), [0.0] * len(at)  # value[j] = f(j) + at[j]
    queue = deque([0])  # places within reach, value increasing
    for j in range(1, last):
        while at[queue[0]] < at[j] - size:
            queue.popleft()
        back[j] = queue[0]
        value[j] = v = cost[j] + size + value[queue[0]]
        while queue and value[queue[-1]] >= v:
            queue.pop()
        queue.append(j)
    if last:
        back[last] = min(range(bisect_left(at, length - size), last), key=lambda i: value[i] - at[i])
    ends, j = [], last
    while j:
        ends.append(at[j])
        j = back[j]
    return ends[::-1]


def _pack(path: str, size: int, with_ids: bool, stretch: int, every: int):
    fields = [("doc_id", pa.int64())] + [(n, pa.int64()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    schema = pa.schema(fields + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def run(batches):
        from pyspark import TaskContext

        enc, is_end = encoder(path)
        added = added_tokens(path)
        sequence = TaskContext.get().partitionId() << 40
        held: list[list] = []  # [doc_id, ids, first id not yet placed, all ids]
        waiting = 0

        def solve(final: bool):
            nonlocal sequence, waiting, held
            ids = np.concatenate([d[1] for d in held])
            length = len(ids)
            kind = np.where(is_end[ids], SENTENCE_CUT, HARD_CUT)
            doc_ends = np.cumsum([len(d[1]) for d in held])
            kind[doc_ends - 1] = DOC_CUT
            free = kind < HARD_CUT
            free[every - 1 :: every] = True  # cuts elsewhere, so that no stretch is without one
            free[-1] = True
            places = np.flatnonzero(free) + 1
            ends = choose(length, places, kind[places - 1], size)
            if not final:
                ends = ends[:-1]
            elif ends:
                a = ends[-2] if len(ends) > 1 else 0
                rest = ends.pop() - a
                for k in reversed(range(rest.bit_length())):
                    if rest >> k & 1:
                        a += 1 << k
                        ends.append(a)
            rows, start, d = [], 0, 0
            base = np.concatenate([[0], doc_ends])
            for end in ends:
                while start < end:
                    doc = held[d]
                    a, b = start - base[d], min(end, base[d + 1]) - base[d]
                    piece = doc[1][a:b]
                    rows.append((doc[0], doc[2] + int(a), int(b - a), zlib.crc32(piece.tobytes()), doc[3], sequence, 0, piece.tolist() if with_ids else None))
                    start += int(b - a)
                    if base[d] + b == base[d + 1]:
                        d += 1
                sequence += 1
            # What is left is carried on.
            if d < len(held) and start > base[d]:
                cut = start - int(base[d])
                held[d] = [held[d][0], held[d][1][cut:], held[d][2] + cut, held[d][3]]
            held = held[d:]
            waiting = length - start
            at, prev = 0, None
            out = []
            for r in rows:
                at = at if r[5] == prev else 0
                out.append((*r[:6], at, *([r[7]] if with_ids else [])))
                at, prev = at + r[2], r[5]
            cols = list(zip(*out)) or [[] for _ in schema]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.append(encode(enc, added, text or ""), np.array([0], "<u4")).astype("<u4")
                held.append([doc, ids, 0, len(ids)])
                waiting += len(ids)
                if waiting >= stretch:
                    yield solve(False)
        if held:
            yield solve(True)

    return run


def pack(docs: DataFrame, tokenizer: str, size: int = 1024, with_ids: bool = False, stretch: int = STRETCH, every: int = 32) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    A document is its token ids, by the tokenizers file whose path is given, and
    an id 0. Documents stay in doc_id order, and each partition of that order is
    packed on its own into sequences of at most size tokens. Cuts fall at
    document ends or sentence ends, or elsewhere at a higher cost; a dynamic
    program minimises padding plus cut costs over each stretch of about that many
    tokens, cuts elsewhere being offered at every so many tokens: it is optimal
    for a partition with a stretch longer than that and every = 1, and every
    must not exceed size. What is packed together depends on the number of
    partitions; that each id lies in one piece does not. Sequences whose length is a power
    of two need no padding, so a partition's last tokens become such sequences.
    Null and empty texts are the single id 0. Repeated rows are packed each;
    rows without a doc_id come first. doc_ids are whole numbers. An empty table
    gives no rows.
    """
    rows = texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dealt = rows.repartitionByRange(partitions(docs), "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    kinds = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + (", ids array<int>" if with_ids else "")
    return dealt.mapInArrow(_pack(tokenizer, size, with_ids, stretch, every), kinds)
